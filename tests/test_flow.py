"""End-to-end attribution cases on small hit frames."""

from decimal import Decimal

import pytest

from touchline import AttributionOptions
from touchline.errors import ParsingError
from touchline.plans.attribution import attribute
from tests.hits import SHOP_DAY, SHOP_DAY_IN_30_MINUTES, SHOP_DAY_RESULT, frame, hit, results

M = "http://www.msn.com/?q="
Y = "http://yahoo.com/?p="
OWN = "https://www.esshopzilla.com/a"


def run(spark, rows, **opts):
    return attribute(frame(spark, rows), AttributionOptions(**opts))


def buy(t, amount, **more):
    return hit(t, events="1", products=f"Kitchen;Pot;1;{amount};", **more)


# rows, and the report that they give without a timeout
CASES = {
    "a search, then a purchase": ([hit(7, referrer=M + "pot"), hit(8, referrer=OWN), buy(9, "17.35")], [("msn.com", "pot", "17.35")]),
    "events other than a purchase": ([hit(7, referrer=M + "pot"), hit(9, events="11,12", products="K;P;1;17.35;")], []),
    "nothing searched": ([hit(7, referrer=OWN), buy(9, "17.35")], []),
    "the later of two searches": ([hit(1, referrer=M + "pan"), hit(2, referrer=Y + "wok"), buy(3, "23.10")], [("yahoo.com", "wok", "23.10")]),
    "search on the purchase page": ([hit(1, referrer=M + "pan"), buy(2, "4.40", referrer=Y + "lid")], [("yahoo.com", "lid", "4.40")]),
    "two purchases after one search": ([hit(1, referrer=M + "pan"), buy(2, "11.11"), hit(3, referrer=OWN), buy(4, "22.22")], [("msn.com", "pan", "33.33")]),
    "agents tell visitors apart": ([hit(1, ua="A", referrer=M + "pan"), buy(2, "5", ua="B")], []),
    "one keyword in two cases, shown as first searched": (
        [hit(1, ip="v", referrer=M + "WOK"), hit(2, ip="w", referrer=M + "wok"), hit(3, ip="u", referrer=M + "Wok"), buy(4, "6.5", ip="w"), buy(5, "0.25", ip="u")],
        [("msn.com", "WOK", "6.75")],
    ),
    "highest revenue first, then engine, then keyword": (
        [hit(1, ip="a", referrer=Y + "b"), hit(2, ip="b", referrer=Y + "A"), hit(3, ip="c", referrer=M + "z"), hit(4, ip="d", referrer=M + "y"),
         buy(5, "2", ip="a"), buy(6, "2", ip="b"), buy(7, "2", ip="c"), buy(8, "2.01", ip="d")],
        [("msn.com", "y", "2.01"), ("msn.com", "z", "2.00"), ("yahoo.com", "A", "2.00"), ("yahoo.com", "b", "2.00")],
    ),
    "half a cent goes to the even one, once, after the sum": ([hit(1, referrer=M + "k"), buy(2, "0.3025"), buy(3, "0.3025")], [("msn.com", "k", "0.60")]),
    "returns and free items earn nothing": ([hit(1, referrer=M + "k"), buy(2, "-3"), buy(3, ""), buy(4, "0"), buy(5, "1.5")], [("msn.com", "k", "1.50")]),
}


def test_reports(spark):
    for name, (rows, want) in CASES.items():
        assert results(run(spark, rows)) == want, name


@pytest.mark.parametrize("gap,timeout,kept", [(901, 900, False), (900, 900, True), (899, 900, True), (1, 0, False), (0, 0, True), (10**7, None, True)])
def test_timeout_is_a_strict_gap(spark, gap, timeout, kept):
    rows = [hit(50, referrer=M + "k"), buy(50 + gap, "2.20")]
    assert results(run(spark, rows, session_timeout=timeout)) == ([("msn.com", "k", "2.20")] if kept else [])


def test_sessions(spark):
    pages = [hit(0, referrer=M + "k"), *[hit(t, referrer=OWN) for t in (800, 1600, 2400)]]
    assert results(run(spark, [*pages, buy(3200, "7")], session_timeout=900)) == [("msn.com", "k", "7.00")]
    again = [*pages, hit(9000, referrer=Y + "new"), buy(9001, "8")]
    assert results(run(spark, again, session_timeout=900)) == [("yahoo.com", "new", "8.00")]


def test_order_modes(spark):
    rows = [buy(90, "31"), hit(20, referrer=Y + "early")]
    assert results(run(spark, rows)) == []
    assert results(run(spark, rows, order="time")) == [("yahoo.com", "early", "31.00")]
    unset = [buy(90, "32"), hit("", referrer=Y + "unset")]
    assert results(run(spark, unset, order="time")) == [("yahoo.com", "unset", "32.00")]


def test_times_that_are_none(spark):
    rows = [hit(4000, referrer=M + "k"), hit("", referrer=OWN), buy(4001, "1"), hit("soon", referrer=OWN), hit("12.5")]
    r = run(spark, rows, session_timeout=900)
    assert results(r) == []
    q = r.quality.first()
    assert (q.blank_timestamps, q.bad_timestamps) == (1, 2)
    assert run(spark, rows).quality.first().bad_timestamps == 2
    with pytest.raises(ParsingError):
        run(spark, rows, strict_time=True)
    assert results(run(spark, rows[:1], strict_time=True)) == []


@pytest.mark.parametrize("timeout,want,live,credited", [(None, SHOP_DAY_RESULT, 3, 4), (1800, SHOP_DAY_IN_30_MINUTES, 2, 3)])
def test_shop_day(spark, timeout, want, live, credited):
    r = run(spark, SHOP_DAY, session_timeout=timeout)
    assert results(r) == want
    c = r.run_counts.first()
    assert (c.rows_processed, c.visitors_with_live_touch, c.keyword_groups) == (14, live, len(want))
    assert c.total_attributed_revenue == sum(Decimal(x) for *_, x in want)
    q = r.quality.first()
    assert (q.rows_with_search_referrer, q.total_purchase_events, q.attributed_purchase_events) == (4, 6, credited)
    assert (q.unattributed_purchases, q.malformed_referrers, q.unknown_referrer_domains) == (5 - credited, 0, 1)


def test_quality_counters(spark):
    rows = [buy(1, "61", ip="u"), hit(2, ip="a", referrer=Y + "k"), buy(3, "13", ip="a"), buy(4, "", ip="b"), buy(5, "x", ip="a"),
            *[hit(6, ip="c", referrer=x) for x in ("http://[no", "http://[1:2", "https://blog.example.org/", "no url", "http://yahoo.com/?q=1", OWN)]]
    for more in ({}, {"prefilter": False}, {"session_timeout": 10}):
        q = run(spark, rows, **more).quality.first()
        assert (q.unattributed_purchases, q.total_revenue_unattributed) == (1, Decimal(61))
        assert (q.attributed_purchase_events, q.total_revenue_attributed) == (1, Decimal(13))
        assert (q.purchases_without_revenue, q.total_purchase_events, q.rows_with_search_referrer) == (2, 4, 1)
        assert (q.malformed_referrers, q.unknown_referrer_domains) == (2, 2)


def test_no_internal_suffixes(spark):
    r = run(spark, [hit(1, referrer=OWN), hit(2, referrer="http://x.y/")], internal_suffixes=())
    assert r.quality.first().unknown_referrer_domains == 2


def test_options_validation():
    assert AttributionOptions().session_timeout is None
    for bad in ({"session_timeout": -1}, {"order": "random"}, {"skew_threshold": 0}, {"block_rows": 0}, {"engines": ()}):
        with pytest.raises(ValueError):
            AttributionOptions(**bad)


@pytest.mark.parametrize("timeout,skew", [(None, None), (1800, None), (None, 3), (1800, 3)])
def test_materialized_equals_lazy(spark, timeout, skew):
    rows = [*SHOP_DAY, hit(1_700_008_000, ip="z", referrer="http://[no/"), buy("", "", ip="z")]
    lazy = run(spark, rows, session_timeout=timeout, skew_threshold=skew, block_rows=2)
    done = lazy.materialize()
    assert results(done) == results(lazy) == results(run(spark, rows, session_timeout=timeout, skew_threshold=None))
    assert done.quality.first().asDict() == lazy.quality.first().asDict()
    assert done.run_counts.first().asDict() == lazy.run_counts.first().asDict()
