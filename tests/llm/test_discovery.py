"""URL rules, collocations and spelling variants against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF01
from touchline.llm import collocations, spelling, url_rules
from touchline.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_documents():
    """Few words in many phrases, single edits of some, and every odd row."""
    rng = random.Random(5)
    base = ["letter", "lettre", "letters", "paper", "papers", "papier", "aaaaa", "aaaaaa", "été", "marché", "marche", "the", "of", "Ab"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(base) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", " ; "]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "fr", None]), f"p{i}", 1.0))
    rows += [(500, None, "en", "x", None), (501, "", None, "x", None), (502, " \t\n.,", "en", None, None), (None, "letter paper letter", "en", "x", 2.0)]
    rows += [(503, "the paper of letters " * 4000, "en", "long", 0.0), (504, "x" * 30_000 + " " + "x" * 30_001, "en", "long", 0.0)]
    return rows + [rows[7], rows[7], (505, "x" * 30_000 + " y " + "x" * 30_001 + "," + "x" * 30_000 + "!" + "x" * 30_001, "en", "long", 0.0)]


ODD = "doc_id long, text string, lang string, word string, n double"


def same_words(docs):
    counts = Counter()
    for doc, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes, near = defaultdict(set), defaultdict(set)
    for w in known:
        for i in range(len(w)) if len(w) < 100 else (0, len(w) - 1):
            holes[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in known:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        if best and known[best] >= 2 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), known.get(form.get(w))) for w, n in known.items()}


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_of_whole_table_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF01, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in spelling.op13_spelling_variants(spark, SF01).collect()]
    assert len(got) == len(set(got)) and set(got) == same_words(docs)


def test_spelling_with_odd_rows_and_small_tiles(spark, monkeypatch):
    rows = odd_documents()
    monkeypatch.setattr(spelling, "TILE", 12)
    monkeypatch.setattr(spelling, "CELLS", 64)
    got = [tuple(r) for r in spelling.variants(spelling.counted(spelling.spelled_words(spark.createDataFrame(rows, ODD)))).select(*COLUMNS).collect()]
    assert len(got) == len(set(got)) and set(got) == same_words([r[:2] for r in rows])
    assert ("x" * 30_000, None, "x" * 30_000, 3, 1, None) in got
    none = spelling.variants(spelling.counted(spelling.spelled_words(spark.createDataFrame([], ODD))))
    assert none.count() == 0


def test_spelling_follows_a_chain_of_forms(spark):
    words = [("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("abbbb", 16), ("bbbbb", 32), ("zzzzz", 3)]
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["aaaaa"] == ("aaaab", "bbbbb", 1) and got["aaabb"] == ("aabbb", "bbbbb", 2)
    assert got["bbbbb"] == (None, "bbbbb", 1) and got["zzzzz"] == (None, "zzzzz", 0)


def best_phrases(docs, least, top, replaces=80):
    count, before, after, total = (defaultdict(Counter) for _ in range(4))
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"][()] += len(w)
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    x = tuple(w[i : i + k])
                    count[lang or "und"][x] += 1
                    before[lang or "und"][x] += i > 0
                    after[lang or "und"][x] += i + k < len(w)
    out = set()
    for lang, c in count.items():
        found = {x: a for x, a in c.items() if len(x) > 1 and a >= least}
        gone = {q[i : i + m] for q, b in found.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * b >= replaces * c[q[i : i + m]]}
        rows = []
        for x, a in found.items():
            if x not in gone:
                score, _, left, right = min((2_000_000 * a // (c[x[:k]] + c[x[k:]]), k, c[x[:k]], c[x[k:]]) for k in range(1, len(x)))
                rows.append((-score, -a, " ".join(x).encode(), left, right, before[lang][x], after[lang][x]))
        for rank, r in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, r[2].decode(), -r[1], r[3], r[4], total[lang][()], -r[0], r[5], r[6]))
    return out


@pytest.mark.parametrize("size", [50, 1 << 19])
def test_collocations_with_odd_rows(spark, size):
    rows = odd_documents()
    docs = spark.createDataFrame(rows, ODD)
    got = [tuple(r) for r in collocations.collocations(docs, least=4, top=150, size=size).collect()]
    assert len(got) == len(set(got)) and set(got) == best_phrases([(r[2], r[1]) for r in rows], 4, 150)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], ODD)).count() == 0


def test_collocation_products_pass_64_bits(spark, monkeypatch):
    """Counts near 2**62 as a shard of them would give."""
    big = 1 << 62
    rows = [("en", "a", 1, big + 1, 0, 0), ("en", "b", 1, big, 0, 0), ("en", "a b", 2, big, 0, 0)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, f long, left long, right long")
    totals = spark.createDataFrame([("en", 3)], "lang string, n long")
    monkeypatch.setattr(collocations, "counted", lambda docs, least, size: (found, totals))
    [row] = collocations.collocations(spark.createDataFrame([], ODD)).collect()
    assert row.score == 2_000_000 * big // (2 * big + 1)


def tokens_of(url):
    url = url or ""
    host, path = "", re.match("(?s)[^?#]*", url).group()
    out = set()
    if "://" in url:
        scheme, rest = url.split("://", 1)
        host = re.match("(?s)[^/?#]*", rest).group().translate(LOWER)
        path = re.match("(?s)[^?#]*", rest[len(host) :]).group()
        out |= {"s:" + scheme} if scheme else set()
    out |= {"h:" + x for x in host.split(".") if x}
    out |= {"p:" + re.sub("[0-9]+", "#", x) for x in path.split("/") if x}
    query = re.match(r"(?s)[^?#]*\?([^#]*)", url)
    out |= {"q:" + x.split("=")[0] for x in (query.group(1) if query else "").split("&") if x.split("=")[0]}
    out |= {"f:" + url.split("#", 1)[1]} if "#" in url and url.split("#", 1)[1] else set()
    return frozenset(out), host if "://" in url else "", path if "://" in url else ""


GIVEN = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def verdicts(urls, labelled, support, least, confidence):
    """Every subset of the tokens of the labelled URLs, counted."""
    total, rules = len(labelled), []
    if total >= least:
        least = max(least, math.ceil(round(total * support, 6)))
        covered, both = Counter(), Counter()
        for url, label in labelled:
            tokens = sorted(tokens_of(url)[0])
            for k in range(len(tokens) + 1):
                for x in itertools.combinations(tokens, k):
                    covered[x] += 1
                    both[x, label] += 1
        for (x, label), n in both.items():
            if x and n >= least and n / covered[x] >= confidence:
                fewer = [x[:i] + x[i + 1 :] for i in range(len(x))]
                if all(n / covered[x] > both[y, label] / covered[y] for y in fewer):
                    rules.append((-n / covered[x], -n, len(x), list(x), label))
    out = Counter()
    for page, url in urls:
        tokens, host, path = tokens_of(url)
        fits = [(len(h + p), h + p, v) for h, p, v in GIVEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = min((r for r in rules if url is not None and tokens.issuperset(r[3])), default=None)
        rule, verdict = max(fits)[1:] if fits else (None, best[4] if best else "allow")
        out[page, host, path, rule, verdict, None if fits or not best else " ".join(best[3])] += 1
    return out


def judgements(out):
    return Counter((r[0], r[1], r[2], r[3], r[4], r[5]) for r in out.collect())


def test_url_verdicts_of_whole_table(spark):
    pages = [(r.page_id, r.url) for r in table(spark, SF01, "pages").select("page_id", "url").collect()]
    said = {r.doc_id: r for r in table(spark, SF01, "labels").collect()}
    labelled = []
    for _, url in pages:
        number = int(re.findall("[0-9]+", tokens_of(url)[2])[-1])
        if number in said:
            labelled.append((url, "block" if said[number].toxic == 1 or said[number].quality == 0 else "allow"))
    assert judgements(url_rules.op11_url_rules(spark, SF01)) == verdicts(pages, labelled, 0.01, 20, 0.5)


URLS = [None, "", "no scheme/en/1?x=1", "http://", "HTTP://Example.COM/en/", "https://www.example.com/en/7#top", "x://a.net/es/1", "x://a.net/es", "x://net/fr/a?b=/c#d?e"]
URLS += ["http://notexample.com/en/", "http://example.com.org/en/1", "a://b://com/", "://com/", "http://com:80/", "x://m.example.org/" + "a/" * 30_000, "x://É.org/é\n/1"]


def test_url_verdicts_with_many_tokens(spark):
    """URLs of up to 17 frequent tokens whose label follows the two that tell least
    alone; some tokens always come together."""
    rng = random.Random(8)
    rows, labelled = [], []
    for i in range(240):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        label = "block" if a and b or not (a or b) else "allow"
        names = [f"n{k}" for k in range(8) if rng.random() < (0.8 if label == "block" else 0.6)]
        names += ["twin1", "twin2"] * (rng.random() < 0.6) + ["z1"] * a + ["z2"] * b
        url = f"http://some.site.org/?{'&'.join(names)}"
        rows.append((i, url))
        if i < 160:
            labelled.append((url, label))
    rows += [(300, "http://some.site.org/?z1&z2&twin2"), (301, "http://some.site.org/?twin1&z1"), (302, "z://z?twin2")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labelled, "url string, label string")
    out = url_rules.judged(pages, known, support=0.05, least=5, confidence=0.6)
    got = out.selectExpr("row.page_id", "host", "path", "rule", "verdict", "array_join(mined, ' ')")
    assert max(len(tokens_of(u)[0]) for u, _ in labelled) > 13
    assert judgements(got) == verdicts(rows, labelled, 0.05, 5, 0.6)


def test_tokens_of_the_same_rows_are_one_item(spark, monkeypatch):
    sets = [["a", "b", "c"], ["a", "b"], ["a", "b", "c", "d"], ["d", "e"], ["d", "e", "x"]]
    rows = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<string>")
    want = [("a", "a"), ("b", "a"), ("c", "c"), ("d", "d"), ("e", "e")]
    assert sorted(map(tuple, url_rules.token_classes(rows, 2).collect())) == want
    # where all marks collide, equal counts alone make no class
    monkeypatch.setattr(url_rules.F, "bit_xor", lambda c: url_rules.F.lit(0).cast("long"))
    assert sorted(map(tuple, url_rules.token_classes(rows, 2).collect())) in (want, [("a", "a"), ("b", "b"), *want[2:]])


def test_url_verdicts_with_odd_rows(spark):
    """Labels that follow two tokens together, odd URLs, repeated rows."""
    rng = random.Random(3)
    rows, labelled = [], []
    for i in range(300):
        host, section, ref = rng.choice(["spam", "news", "shop"]), rng.choice(["win", "read"]), rng.choice(["?ref=1", "", "#top"])
        url = f"http://{host}.example.org/{section}/{i}{ref}"
        rows.append((i, url, "x", "clash"))
        if i % 2:
            labelled.append((url, "block" if (host == "spam" and section == "win") or rng.random() < 0.1 else "allow"))
    rows += [(400 + i, u, None, None) for i, u in enumerate(URLS)] + rows[:3] + [(None, rows[5][1], "x", None)]
    labelled += [(None, "allow"), ("", "block"), labelled[0], labelled[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    known = spark.createDataFrame(labelled + [("x://y", None)], "url string, label string")
    out = url_rules.judged(pages, known, support=0.02, least=5, confidence=0.6)
    got = out.selectExpr("row.page_id", "host", "path", "rule", "verdict", "array_join(mined, ' ')")
    want = verdicts([r[:2] for r in rows], labelled, 0.02, 5, 0.6)
    assert judgements(got) == want
    assert {k[4] for k in want if k[1].startswith("spam") and k[2].startswith("/win/")} == {"block"}
    none = url_rules.judged(pages, spark.createDataFrame([], "url string, label string"))
    assert none.where("rule is null and verdict <> 'allow'").count() == 0 and none.count() == len(rows)
    assert url_rules.judged(pages.limit(0), known).count() == 0


def test_url_labels_come_from_the_document_in_the_path(spark):
    pages = spark.createDataFrame([(1, "http://a/en/7.html?x=8"), (2, "http://a/9"), (3, "http://a/99999999999999999999"), (4, None), (5, "http://b/8")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 0, None), (8, None, 1), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.url, r.label) for r in url_rules.page_labels(pages, labels).collect()}
    assert got == {("http://a/en/7.html?x=8", "block"), ("http://b/8", "block")}


def test_phrase_hashes_are_short_and_in_order(spark):
    """What a shard sends of its phrases: 32 bits of each hash, in order, and no text's length."""
    docs = spark.createDataFrame([(i, f"alpha beta w{i % 7} gamma w{i % 5} delta", "en") for i in range(60)], "doc_id long, text string, lang string")
    index = collocations.shards(docs.coalesce(1))
    got = [r.hash for r in collocations.phrase_hashes(index, []).collect()]
    assert len(got) == 11 and got == sorted(got) and 0 <= got[0] and got[-1] < 1 << 32
    assert collocations.phrase_texts(index, []).columns == ["lang", "phrase", "f", "starts", "ends"]
