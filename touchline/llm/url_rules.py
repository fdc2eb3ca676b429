"""URL filters by association rules.

A URL is the set of its tokens: scheme, host labels, path segments (runs of
digits as ``#``), argument names and fragment.  Spark's FP-growth mines the
token combinations of labelled URLs together with their label.  A combination
becomes a rule for a label if it has that label in at least ``SUPPORT`` of all
labelled URLs (and in ``LEAST`` of them), with a confidence of at least
``CONFIDENCE``, and more of it than the label has in each combination of one
token less; the empty combination has the share of the label.

Rules are kept in an inverted index: each is posted under its rarest token, a
URL looks its tokens up and a posted rule fits if the URL has all its tokens.
The most confident fitting rule decides, then the one of larger support, of
fewer tokens, and the first in order.  Without one the verdict is ``allow``.

Given rules of host and path go before mined ones: a rule fits its host and all
subdomains if the path starts with the rule's, and the longest wins.

A labelled URL goes into mining with all its tokens; those that are rarer than
the support can't be part of a rule.  Tokens that exactly the same labelled URLs
have are mined as one item, as no rule can hold two of them (the combination
without one of them has the same confidence), and its rules are then written out
for each of them.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits
no given rule, and has its whole text as path tokens; repeated rows are judged
alike; an empty table gives no rows; fewer than ``LEAST`` labelled URLs give no
mined rules; a label is ``block`` where toxic is 1 or quality is 0, ``allow`` where
one of them says otherwise, and none where both are null.  Other columns of the
input are carried in ``row`` and can't clash.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

SUPPORT = 0.01
LEAST = 20
CONFIDENCE = 0.5

#: the given rules: host, path, verdict (fixed values)
GIVEN = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: items that stand for a label; no token has this form
LABEL = "label="


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL, in order."""
    text = F.coalesce(url, F.lit(""))
    whole = F.instr(text, "://") > 0
    body = F.when(whole, path_of(text)).otherwise(F.regexp_extract(text, r"(?s)^([^?#]*)", 1))
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(text, r"(?s)^[^#]*#(.*)$", 1)

    def parts(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))

    digits = F.transform(F.split(body, "/"), lambda x: F.regexp_replace(x, r"[0-9]+", "#"))
    names = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"(?s)^([^=]*)", 1))
    scheme = F.when(whole, F.regexp_extract(text, r"(?s)^(.*?)://", 1)).otherwise("")
    kinds = [parts("s", F.array(scheme)), parts("h", F.split(host_of(text), r"\.")), parts("p", digits), parts("q", names), parts("f", F.array(fragment))]
    return F.array_sort(F.array_distinct(F.concat(*kinds)))


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """rule and verdict of the longest given rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def token_classes(rows: DataFrame, least: int) -> DataFrame:
    """token, item: the tokens that ``least`` of the rows (id, tokens) have, and
    the smallest token that exactly the same rows have."""
    each = rows.select("id", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("mark")).where(F.col("n") >= least)
    alike = Window.partitionBy("n", "mark")
    frequent = stored(counts.select("token", F.min("token").over(alike).alias("item"), F.count("*").over(alike).alias("size")), "frequent")
    # marks may collide: a class stands if every row that has one of it has all
    had = each.join(frequent.where("size > 1"), "token").groupBy("id", "item", "size").agg(F.count("*").alias("had"))
    same = had.groupBy("item").agg((F.min("had") == F.first("size")).alias("same"))
    joined = frequent.join(same, "item", "left")
    return stored(joined.select("token", F.when(F.col("same"), F.col("item")).otherwise(F.col("token")).alias("item")), "classes")


def transactions(labelled: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """items: the classes of the tokens that ``least`` labelled URLs have, and
    the label; and the classes (token, item)."""
    rows = labelled.select(F.monotonically_increasing_id().alias("id"), url_tokens(F.col("url")).alias("tokens"), "label")
    rows = stored(rows, "labelled")
    classes = token_classes(rows, least)
    each = rows.select("id", "label", F.explode("tokens").alias("token")).join(classes, "token")
    kept = each.groupBy("id", "label").agg(F.collect_set("item").alias("items"))
    return kept.select(F.concat("items", F.array(F.concat(F.lit(LABEL), "label"))).alias("items")), classes


def written_out(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The rules of classes for every choice of a token from each class."""
    members = classes.groupBy("item").agg(F.collect_list("token").alias("members"))
    each = rules.select("*", F.posexplode("tokens").alias("place", "item")).join(members, "item")
    parts = each.groupBy("tokens", "label", "n", "confidence").agg(F.sort_array(F.collect_list(F.struct("place", "members"))).alias("parts"))
    none = F.array(F.array().cast("array<string>"))
    choices = F.aggregate("parts", none, lambda made, part: F.flatten(F.transform(made, lambda m: F.transform(part["members"], lambda t: F.array_append(m, t)))))
    return parts.select(F.explode(choices).alias("tokens"), "label", "n", "confidence").select(F.array_sort("tokens").alias("tokens"), "label", "n", "confidence")


RULES = "tokens array<string>, label string, n long, confidence double"


def mined_rules(labelled: DataFrame, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE) -> DataFrame:
    """tokens, label, n (labelled URLs with all of them), confidence."""
    spark = labelled.sparkSession
    labelled = stored(labelled.select("url", "label").where("label is not null"), "labels")
    total = labelled.count()
    if total < least:
        return spark.createDataFrame([], RULES)
    least = max(least, math.ceil(round(total * support, 6)))
    items, classes = transactions(labelled, least)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total).fit(items)
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
    label = F.filter("items", lambda x: x.startswith(LABEL))
    tokens = F.filter("items", lambda x: ~x.startswith(LABEL))
    sets = stored(sets.select(tokens.alias("tokens"), F.substring(F.get(label, F.lit(0)), len(LABEL) + 1, 100).alias("label"), "n"), "itemsets")
    alone = sets.where("label is null and size(tokens) > 0").select("tokens", F.col("n").alias("covered"))
    shares = labelled.groupBy("label").agg(F.count("*").alias("n")).select(F.array().cast("array<string>").alias("tokens"), "label", (F.col("n") / total).alias("confidence"))
    both = sets.where("label is not null and size(tokens) > 0").join(alone, "tokens")
    rated = stored(both.select("tokens", "label", "n", (F.col("n") / F.col("covered")).alias("confidence")), "rated")
    # each rule against its combinations of one token less
    less = rated.where(F.col("confidence") >= confidence).select("*", F.posexplode("tokens").alias("place", "token"))
    less = less.select("tokens", "label", "n", "confidence", F.expr("filter(tokens, (x, i) -> i != place)").alias("fewer"))
    base = rated.select("tokens", "label", "confidence").unionByName(shares)
    base = base.select(F.col("tokens").alias("fewer"), "label", F.col("confidence").alias("general"))
    general = less.join(base, ["fewer", "label"], "left").groupBy("tokens", "label", "n", "confidence").agg(F.max("general").alias("general"))
    better = general.where("general is null or confidence > general").select("tokens", "label", "n", "confidence")
    return stored(written_out(better, classes), "rules")


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, best (minus_confidence, minus_n, size, tokens, label): the deciding
    rule of every URL that has one."""
    posted = rules.select("*", F.explode("tokens").alias("token"))
    many = posted.groupBy("token").agg(F.count("*").alias("many"))
    # a rule is posted under the token that the fewest rules have
    rarest = posted.join(many, "token").groupBy("tokens", "label", "n", "confidence").agg(F.min(F.struct("many", "token")).alias("at"))
    index = rarest.select(F.col("at.token").alias("token"), "tokens", "label", "n", "confidence")
    looked = urls.select("url", url_tokens(F.col("url")).alias("has")).select("url", "has", F.explode("has").alias("token"))
    fitting = looked.join(index, "token").where(F.size(F.array_except("tokens", "has")) == 0)
    order = F.struct((-F.col("confidence")).alias("minus_confidence"), (-F.col("n")).alias("minus_n"), F.size("tokens").alias("size"), "tokens", "label")
    return fitting.groupBy("url").agg(F.min(order).alias("best"))


def judged(pages: DataFrame, labelled: DataFrame, given=GIVEN, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE) -> DataFrame:
    """row (all columns of ``pages``), host, path, rule, verdict, mined (tokens of
    the deciding mined rule) and confidence, for the column ``url`` of ``pages``
    and labelled URLs (url, label)."""
    rules = mined_rules(labelled, support, least, confidence)
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col("url").cast("string").alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    rows = rows.select("*", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), verdict.alias("given"))
    open_urls = rows.where("rule is null and url is not null").select("url").distinct()
    best = stored(best_rules(open_urls, rules), "best")
    joined = rows.join(best, "url", "left")
    fallen = F.when(F.col("rule").isNull(), F.col("best"))
    return joined.select(
        "row",
        "host",
        "path",
        "rule",
        F.coalesce("given", fallen["label"], F.lit("allow")).alias("verdict"),
        fallen["tokens"].alias("mined"),
        (-fallen["minus_confidence"]).alias("confidence"),
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url, label: a page is labelled as the document that its path ends with."""
    number = F.regexp_extract_all(path_of(F.col("url")), F.lit("([0-9]+)"), F.lit(1))
    of_page = pages.select("url", number.alias("numbers")).where("size(numbers) > 0")
    of_page = of_page.select("url", F.element_at("numbers", -1).try_cast("bigint").alias("doc_id"))
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    known = F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    said = labels.where(known).select(F.col("doc_id").cast("long").alias("doc_id"), F.when(bad, "block").otherwise("allow").alias("label"))
    return of_page.join(said, "doc_id").select("url", "label")


def op11_url_rules(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judged(pages, page_labels(pages, table(spark, sf_dir, "labels")))
    return out.select("row.page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"), "confidence")
