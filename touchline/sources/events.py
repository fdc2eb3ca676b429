"""The ``hits`` frame derived from the driver's ``events`` table.

Test inputs hold no hit file, so a deterministic hit-level frame is derived
from ``events`` (one hit per event).  The rules live in FIXTURES.md §5; the
oracle SQL in ``__spark_entry__`` derives the same frame in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation recipe (FIXTURES.md §5).
SEARCH_REFERRERS = (
    "http://www.google.com/search?hl=en&q=Shoes",
    "http://google.com/search?q=shoes",
    "http://www.bing.com/search?q=red+shoes",
    "http://search.yahoo.com/search?p=cd%20player",
    "http://yahoo.com/?p=Hat",
    "http://www.msn.com/search?q=phone",
    "http://www.google.com/search?hl=en",
    "http://partner.example.org/x",
    "http://[bad/",
    "",
    "http://www.google.com/search?q=&q=Second",
    "http://www.esshopzilla.com/",
)
SAME_HIT_REFERRER = "http://www.bing.com/search?q=Same+Hit"
CHECKOUT_REFERRER = "https://www.esshopzilla.com/checkout/"
CART_REFERRER = "http://www.esshopzilla.com/cart/"
BLANK_TIME_EVERY = 97
PADDED_AGENT_EVERY = 5
IP_VISITORS = 50
AGENT_VISITORS = 7


def _pick(idx: Column, values) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def derive_hits(events: DataFrame) -> DataFrame:
    """Hit-level frame (all-string hit columns + numeric ``seq``) from ``events``."""
    # k, v and the epoch are used by many branches: project them once first.
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("_k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("_v"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("_epoch"),
    )
    eid = F.col("event_id")
    etype = F.col("event_type")
    k = F.col("_k")
    v = F.col("_v")
    epoch = F.col("_epoch")
    agent = F.concat(F.lit("UA "), (F.col("user_id") % AGENT_VISITORS).cast("string"))
    purchase_products = (
        F.when(k % 10 == 0, F.lit("C;P;1;;"))
        .when(k % 10 == 1, F.lit("C;P;1;abc;"))
        .when(k % 10 == 2, F.concat(F.lit("C;P;1;"), v, F.lit(";200|201,O;F;4;4.00;205")))
        .when(k % 10 == 3, F.concat(F.lit("C;P;1;-"), v, F.lit(";")))
        .otherwise(F.concat(F.lit("C;P;1;"), v, F.lit(";")))
    )
    return base.select(
        eid.alias("seq"),
        F.when(eid % BLANK_TIME_EVERY == 0, F.lit("")).otherwise(epoch.cast("string")).alias("hit_time_gmt"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % IP_VISITORS).cast("string")).alias("ip"),
        F.when(eid % PADDED_AGENT_EVERY == 0, F.concat(F.lit(" "), agent, F.lit(" ")))
        .otherwise(agent)
        .alias("user_agent"),
        F.when(etype == "purchase", F.when(eid % 2 == 0, F.lit("1,200")).otherwise(F.lit(" 2 , 1 ")))
        .when(etype == "click", F.lit("2"))
        .when(etype == "view", F.lit("12,11"))
        .when(etype == "error", F.lit("10"))
        .otherwise(F.lit(""))
        .alias("event_list"),
        F.when(etype == "purchase", purchase_products)
        .when(etype == "view", F.concat(F.lit("C;P;1;"), v, F.lit(";")))
        .otherwise(F.lit(""))
        .alias("product_list"),
        F.when(etype.isin("signup", "click"), _pick(k % 12, SEARCH_REFERRERS))
        .when(
            etype == "purchase",
            F.when(k % 15 == 14, F.lit(SAME_HIT_REFERRER)).otherwise(F.lit(CHECKOUT_REFERRER)),
        )
        .otherwise(F.lit(CART_REFERRER))
        .alias("referrer"),
    )


#: starts and ends of referrers that try the URL rules: user info and port, upper
#: case, no host, look-alike delimiters, Unicode spaces, brackets, no scheme
ODD_REFERRERS = (
    ("http://user:pw@www.google.com:8080/search?q=", ""),
    ("HTTPS://WWW.Bing.COM:443/search?q=", "&q=Second"),
    ("mailto:buyer", "@example.org"),
    ("http://shop\u2100.example.org/", ""),
    ("http://example.org\uff1a80/", ""),
    ("\u2003http://www.esshopzilla.com/", "\u00a0"),
    ("http://[::1]:80/", ""),
    ("http://[fe80::1/", ""),
    ("//partner.example.org/", ""),
    ("/search?q=", ""),
    ("http://caf\u00e9", ".example.org/"),
    ("http://msn.com@example.org/?q=", ""),
)


def odd_referrers(events: DataFrame) -> DataFrame:
    """seq, referrer: a referrer of every kind in ``ODD_REFERRERS`` in turn."""
    number, kind = F.col("event_id").cast("string"), F.col("event_id") % len(ODD_REFERRERS)
    text = _pick(kind, [x for x, _ in ODD_REFERRERS]), _pick(kind, [x for _, x in ODD_REFERRERS])
    return events.select(F.col("event_id").alias("seq"), F.concat(text[0], number, text[1]).alias("referrer"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hits_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_hits(read_table(spark, sf_dir, "events"))
