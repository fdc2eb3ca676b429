"""Scalar parsing: referrer, event list, product revenue, strip, decode."""

import random
from decimal import Decimal

import pytest

from touchline.functions import (
    is_purchase,
    product_revenue,
    query_param,
    referrer_class,
    referrer_host,
    register_sql_functions,
    search_referrer,
    strip_text,
    to_cents,
    url_authority,
    url_decode,
    url_hostname,
    url_is_malformed,
    url_query,
)

REFERRERS = [
    # each engine, under its own host, with and without www and sub-domains
    ("https://google.com/?q=oak+table", ("google.com", "oak table")),
    ("https://www.bing.com/results?cc=fi&q=Sauna", ("bing.com", "Sauna")),
    ("http://fi.search.yahoo.com/?fr=x&p=kettle", ("yahoo.com", "kettle")),
    ("http://de.yahoo.com/?p=Kessel", ("yahoo.com", "Kessel")),
    ("http://msn.com/spresults?q=rye%2Dbread", ("msn.com", "rye-bread")),
    ("HTTP://WWW.BING.COM/results?q=Wok", ("bing.com", "Wok")),
    # the parameter of another engine, none, an empty one, white space around it
    ("http://bing.com/results?p=tea", None),
    ("http://yahoo.com/?q=tea", None),
    ("https://www.msn.com/weather", None),
    ("http://bing.com/?q=&cc=fi", None),
    ("http://msn.com/?q=++green+tea+", ("msn.com", "green tea")),
    # hosts that aren't engines, texts that aren't URLs
    ("https://www.esshopzilla.com/?q=sale", None),
    ("bing", None),
    ("", None),
    # extra cases (behaviour of a standard URL splitter and query parser)
    ("http://google.com/?q=&q=b", ("google.com", "b")),
    ("http://google.com/?q=%20&q=b", None),
    ("http://notgoogle.com/?q=x", None),
    ("http://images.google.com/?q=x", ("google.com", "x")),
    ("http://www.google.co.uk/?q=x", None),
    ("http://www.www.google.com/?q=x", ("google.com", "x")),
    ("http://user:pw@www.google.com:8080/?q=x", ("google.com", "x")),
    ("//google.com/?q=x", ("google.com", "x")),
    ("google.com/?q=x", None),
    ("http://google.com/?q=100%", ("google.com", "100%")),
    ("http://google.com/?q=a%zzb", ("google.com", "a%zzb")),
    ("http://google.com/?q=x%FFy", ("google.com", "x�y")),
    ("http://google.com/?%71=enc", ("google.com", "enc")),
    ("http://google.com/?q=a=b", ("google.com", "a=b")),
    ("http://[bad/?q=1", None),
    ("http://g_o|o.google.com/?q=x", ("google.com", "x")),
    ("http://google.com/?q=x#frag?q=y", ("google.com", "x")),
    ("http://google.com/#?q=y", None),
    ("http://search.yahoo.com/?q=x&p=y", ("yahoo.com", "y")),
]


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_search_referrer_cases(spark):
    df = _one_col(spark, [r for r, _ in REFERRERS], "r")
    got = [row.t for row in df.select(search_referrer("r").alias("t")).collect()]
    for (url, want), t in zip(REFERRERS, got):
        have = (t.domain, t.keyword) if t is not None else None
        assert have == want, url


MALFORMED = [
    "http://[bad/", "http://[::1]:80/x", "http://[v1.x]/", "http://[1.2.3.4]/", "http://a[::1]/",
    "http://[::1]x/", "http://[fe80::1%25eth0]/", "http://[fe80::1%eth0]/", "http://u[x]@host/",
    "http://host]/", "http://www.google.com/", "http://[:]/", "http://[1::2::3]/", "http://[vz.x]/",
]


def _splitter_rejects(url):
    from urllib.parse import urlparse

    try:
        urlparse(url).hostname
    except ValueError:
        return True
    return False


def test_malformed_brackets(spark):
    df = _one_col(spark, MALFORMED, "u")
    got = [r[0] for r in df.select(url_is_malformed("u")).collect()]
    assert got == [_splitter_rejects(u) for u in MALFORMED]


def test_random_bracket_urls_match_standard_library(spark):
    import random
    from urllib.parse import urlparse

    from touchline.functions import with_referrer_parts

    rnd = random.Random(3)
    parts = ["[", "]", "::1", "1.2.3.4", "v1.x", "vz.x", "fe80::1%eth0", "a", "@", "u:p@", ":80", ":x",
             "google.com", "[::ffff:1.2.3.4]", "[1::2::3]", "[::]", "[:]", ".", "www."]
    urls = [rnd.choice(["http://", "//", "https://"]) + "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4)))
            + rnd.choice(["/", "/x?q=1", ""]) for _ in range(3000)]

    def python_view(url):
        try:
            return False, (urlparse(url).hostname or "").lower() or None
        except ValueError:
            return True, None

    df = spark.createDataFrame([(u,) for u in urls], "referrer string")
    rows = with_referrer_parts(df).select("referrer", "ref_malformed", "ref_host").collect()
    bad = [r for r in rows if (r.ref_malformed, None if r.ref_malformed else r.ref_host) != python_view(r.referrer)]
    assert bad == []


def test_hosts_that_normalise_to_delimiters_match_standard_library(spark):
    """Every code point beyond ASCII whose compatibility form differs, a sample
    of the others, and mixtures with user info, ports and brackets."""
    import random
    import unicodedata

    rnd = random.Random(13)
    beyond = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    changed = [c for c in beyond if unicodedata.normalize("NFKC", c) != c]
    holding = [c for c in changed if set("/?#@:") & set(unicodedata.normalize("NFKC", c))]
    urls = [f"http://a{c}b.org/x" for c in changed + rnd.sample(beyond, 2000)]
    urls += [f"//{rnd.choice(['u@', '', 'é', '['])}x{rnd.choice(holding + ['é'])}{rnd.choice(['', ':80', ']'])}/{c}?{c}#{c}" for c in holding * 5]
    got = [r[0] for r in _one_col(spark, urls, "u").select(url_is_malformed("u")).collect()]
    assert len(holding) > 10 and [u for u, bad in zip(urls, got, strict=True) if bad != _splitter_rejects(u)] == []


def test_hostname_and_class(spark):
    urls = ["http://User@WWW.Shop.COM:81/x", "not-a-url", "http://[bad/", "", "https://notesshopzilla.com/",
            "http://partner.example.org/x", "http://www.google.com/search?hl=en"]
    df = _one_col(spark, urls, "u").withColumn("t", search_referrer("u"))
    rows = df.select(url_hostname("u").alias("h"), referrer_class("u", "t").alias("c")).collect()
    assert [r.h for r in rows] == ["www.shop.com", None, None, None, "notesshopzilla.com",
                                   "partner.example.org", "www.google.com"]
    assert [r.c for r in rows] == ["unknown_external", "hostless", "malformed", "none", "internal",
                                   "unknown_external", "unknown_external"]


@pytest.mark.parametrize(
    "events,want",
    [("1", True), ("14,1", True), ("1 ,20", True), ("3, 1 ,3", True), ("1,1", True),
     ("21", False), ("100,10", False), ("1.0", False), ("-1", False), (",", False), ("", False), ("one", False)],
)
def test_event_list(spark, events, want):
    assert _one_col(spark, [events]).select(is_purchase("v")).first()[0] is want


PRODUCTS = [
    ("Camping;Tent;1;310.5;", Decimal("310.5")),
    ("Camping;Tent;1;310.5;,Camping;Stove;1;42.25;200=1;x", Decimal("352.75")),
    ("Camping;Tent;7;12", Decimal("12")),  # the amount is the line's, whatever the quantity
    ("Camping;Tent;1;;,Camping;Stove;1;6;", Decimal("6")),
    ("Camping;Tent;1;free;,Camping;Stove;1;-2.75;", Decimal("-2.75")),
    ("Camping;Tent", Decimal("0")),
    (",,", Decimal("0")),
    ("", Decimal("0")),
    ("Camping;Tent;1;\t8.125 ;", Decimal("8.125")),
    ("A;B;1;2E2;,A;B;1;5e-1;", Decimal("200.5")),
    ("A;B;1;+5;,A;B;1;.5;", Decimal("5.5")),
    ("A;B;1;NaN;,A;B;1;3;", Decimal("3")),
    ("A;B;1;Infinity;", Decimal("0")),
]


def test_product_revenue(spark):
    df = _one_col(spark, [p for p, _ in PRODUCTS])
    got = [r[0] for r in df.select(product_revenue("v")).collect()]
    assert got == [w for _, w in PRODUCTS]


def test_half_even_cents(spark):
    df = spark.createDataFrame([(Decimal("2.125"),), (Decimal("2.135"),), (Decimal("-2.125"),)], "v decimal(38,10)")
    assert [str(r[0]) for r in df.select(to_cents("v")).collect()] == ["2.12", "2.14", "-2.12"]


def test_strip_unicode(spark):
    df = _one_col(spark, ["　\x1f a b\t\x85", "", None, "\x00x\x00"])
    assert [r[0] for r in df.select(strip_text("v")).collect()] == ["a b", "", None, "\x00x\x00"]


def test_query_param_and_decode(spark):
    df = _one_col(spark, ["http://h/p?page=2&ref=x#top", "http://h/p", "http://h/?a=1&a=2&b=%E2%82%AC+1"], "u")
    rows = df.select(
        query_param(url_query("u"), "page").alias("page"),
        query_param(url_query("u"), "a").alias("a"),
        query_param(url_query("u"), "b").alias("b"),
        url_decode(url_query("u")).alias("d"),
    ).collect()
    assert [(r.page, r.a, r.b) for r in rows] == [("2", None, None), (None, None, None), (None, "1", "€ 1")]
    assert rows[0].d == "page=2&ref=x" and rows[1].d == ""


def test_random_urls_match_standard_library(spark):
    """Differential test: staged native parse vs urllib on random hostile URLs."""
    import random

    from tests.fold import touch_of
    from touchline.functions import with_referrer_parts

    rnd = random.Random(7)
    hosts = ["google.com", "www.google.com", "WWW.Google.COM", "images.google.com", "notgoogle.com", "bing.com",
             "search.yahoo.com", "yahoo.com", "msn.com", "www.msn.com", "google.co.uk", "[::1]", "[bad",
             "u:p@google.com:80", "google.com:x", "", "www.www.bing.com", "go_ogle.com"]
    schemes = ["http://", "https://", "HTTP://", "//", "", "ftp://", "http:/", "h t://"]
    keys = ["q", "p", "Q", "%71", "q+", "q%20", "hl", "p%3D"]
    vals = ["shoes", "Red+Shoes", "%20x%20", "", "%E2%82%AC", "100%", "a%zz", "x=y", "+", "%FF", "caf%C3%A9", "  "]

    def url():
        q = "&".join(f"{rnd.choice(keys)}={rnd.choice(vals)}" if rnd.random() < 0.9 else rnd.choice(keys)
                     for _ in range(rnd.randint(0, 3)))
        return (rnd.choice(schemes) + rnd.choice(hosts) + rnd.choice(["/search", "/", "", "/a;b", "/x#y"])
                + ("?" + q if rnd.random() < 0.8 else "") + rnd.choice(["", "#top", "#?q=z"])).strip()

    urls = [url() for _ in range(3000)]
    df = spark.createDataFrame([(u,) for u in urls], "referrer string")
    got = with_referrer_parts(df).select("referrer", "touch").collect()
    bad = [(r.referrer, r.touch) for r in got
           if ((r.touch.domain, r.touch.keyword) if r.touch else None) != touch_of(r.referrer)]
    assert bad == []


def test_random_products_and_events_match_python(spark):
    import random
    from decimal import Decimal

    from tests.fold import revenue_of

    rnd = random.Random(11)
    amounts = ["10", "0.1", "-3.25", "", " 7 ", "abc", "1e2", "+4", ".5", "2.", "0", "99.999", "NaN"]
    codes = ["1", "2", "10", "11", " 1 ", "12", "", "01", "1 1"]

    def product():
        return ",".join(";".join(["C", "N", "1", rnd.choice(amounts), ""][: rnd.randint(2, 5)])
                        for _ in range(rnd.randint(1, 3)))

    rows = [(product(), ",".join(rnd.choice(codes) for _ in range(rnd.randint(0, 3)))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "p string, e string")
    got = df.select("p", "e", product_revenue("p").alias("r"), is_purchase("e").alias("b")).collect()
    for r in got:
        assert r.r == revenue_of(r.p), r.p
        assert r.b is ("1" in {x.strip() for x in r.e.split(",")}), r.e
    assert isinstance(got[0].r, Decimal)


def test_sql_functions_equal_column_functions(spark):
    """Every SQL function against the Column function of the same rule, over odd
    and random input; the plan holds no Python."""
    rng = random.Random(17)
    register_sql_functions(spark, prefix="t_")
    parts = ["http:", "//", "www.", "google.com", "x.bing.com", "/", "?", "#", "&", "q=", "p=", "%71=", "a", "%2", "%41", "+", "%ff", "@", ":", "[", "]", "::1", "v1.a", " ", "\t", "\x00", "／", "é", "'", '"', "\\", "yahoo.com", "1", ",", ";", "-2.50", "1e3", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))) for _ in range(1500)]
    texts += [f"http://{rng.choice(['www.', '', 'u@'])}{rng.choice(['google.com', 'search.yahoo.com', 'msn.com:8', '[::1]', '[v.]'])}/s?{''.join(rng.choice(parts) for _ in range(8))}" for _ in range(1500)]
    texts += ["", None, " 1 ,2", "a;b;1;2.345,c;d;1;;,e;f;1; 7 ;x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, u string").repartition(4)
    both = {
        "t_strip_text(u)": strip_text("u"), "t_lenient_decode(u)": url_decode("u"), "t_url_authority(u)": url_authority("u"),
        "t_url_query(u)": url_query("u"), "t_url_is_malformed(u)": url_is_malformed("u"), "t_url_host(u)": url_hostname("u"),
        "t_referrer_host(u)": referrer_host("u"), "t_query_param(u, 'q')": query_param("u", "q"),
        "t_search_referrer(u)": search_referrer("u"), "t_is_purchase(u)": is_purchase("u"),
        "t_to_cents(t_product_revenue(u))": to_cents(product_revenue("u")),
    }
    for text, column in both.items():
        by_sql = spark.sql("SELECT i, {call} AS v FROM {df}".replace("{call}", text), df=df)
        assert "Python" not in by_sql._jdf.queryExecution().toString()
        got, want = by_sql.collect(), df.select("i", column.alias("v")).collect()
        assert sorted(got, key=lambda r: r.i) == sorted(want, key=lambda r: r.i), text
