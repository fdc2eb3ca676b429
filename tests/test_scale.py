"""Skew split equals the one-level scan and a plain-Python fold; plan shape."""

import random

import pytest

from touchline import AttributionOptions
from touchline.operators.touch import last_touch
from touchline.plans.attribution import attribute
from touchline.plans.catalog import keyword_revenue
from tests.fold import fold
from tests.hits import frame, hit, results

REFS = ["http://www.google.com/search?q=Alpha", "http://www.google.com/search?q=alpha",
        "http://www.bing.com/search?q=Beta", "http://search.yahoo.com/search?p=gamma",
        "http://www.esshopzilla.com/x", "", "http://[bad/", "http://other.org/"]


def random_hits(seed, n=400, visitors=4):
    rnd = random.Random(seed)
    rows, t = [], 1000
    for _ in range(n):
        t += rnd.choice([1, 50, 500, 3000, 9000])
        tt = "" if rnd.random() < 0.03 else str(t + rnd.choice([0, 0, 0, -4000]))
        v = rnd.randrange(visitors) if rnd.random() < 0.7 else 0  # visitor 0 is hot
        buy = rnd.random() < 0.3
        rows.append(hit(tt, ip=f"10.0.0.{v}", ua="UA", events="1" if buy else rnd.choice(["", "2", "12"]),
                        products=f"E;N;1;{rnd.choice(['5', '-1', '', '2.345'])};" if buy else "",
                        referrer=rnd.choice(REFS)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("timeout,order", [(None, "file"), (2000, "file"), (2000, "time")])
def test_split_matches_fold(spark, seed, timeout, order):
    rows = random_hits(seed)
    want, live = fold(rows, timeout, order)
    expect = sorted((d, disp, str(rev)) for (d, _), (disp, rev) in want.items())
    for opts in (dict(skew_threshold=None), dict(skew_threshold=30, block_span=37 if order == "file" else 5000),
                 dict(skew_threshold=30, block_rows=16)):
        r = attribute(frame(spark, rows), AttributionOptions(session_timeout=timeout, order=order, **opts))
        assert sorted(results(r)) == expect, opts
        assert r.run_counts.first().visitors_with_live_touch == live


def test_split_row_level_equal(spark):
    rows = random_hits(7, n=300)
    from touchline.operators.normalize import prepare_hits

    p = prepare_hits(frame(spark, rows))
    cols = ["seq", "live_touch", "session_id", "new_session", "gap"]
    o = AttributionOptions(session_timeout=2000)
    one = last_touch(p, o.with_(skew_threshold=None), with_gaps=True).select(cols).collect()
    two = last_touch(p, o.with_(skew_threshold=20, block_span=25), with_gaps=True).select(cols).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_one_visitor_exchange_no_python(spark):
    from tests.conftest import SF001

    for opts in ({}, {"session_timeout": 1800}):
        df = keyword_revenue(spark, SF001, **opts)
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert "BatchEvalPython" not in final and "ArrowEvalPython" not in final
        # exactly one shuffle on the visitor key, and one sort feeding the window
        assert final.count("Exchange hashpartitioning(ip#") == 1, final
        assert final.count("Window [") >= 1
        # the map side of the report aggregation is a hash aggregation
        assert "HashAggregate(keys=[search_engine_domain" in final


def test_window_scan_prunes_columns(spark):
    from tests.conftest import SF001

    plan = _plan(keyword_revenue(spark, SF001))
    read = [line for line in plan.split("\n") if "ReadSchema" in line or "FileScan parquet" in line]
    assert read and all("props" in line for line in read)
    assert not any("value:double,props:string,extra" in line for line in read)


def _as_expected(rows, timeout=None, order="file"):
    return sorted((d, disp, str(rev)) for (d, _), (disp, rev) in fold(rows, timeout, order)[0].items())


@pytest.mark.parametrize("times", ["even", "blank", "burst", "tied"])
@pytest.mark.parametrize("order", ["file", "time"])
def test_blocks_of_a_hot_visitor_stay_small(spark, times, order):
    """Quantile cuts: one blank time in 97, a burst, or one time for all."""
    from touchline.operators.normalize import normalize_hits
    from touchline.operators.touch import block_number, heavy_visitors

    at = {"even": lambda i: 10**6 + i, "blank": lambda i: "" if i % 97 == 0 else 10**6 + i, "burst": lambda i: 10**6 + (i if i < 100 else 9 * 10**6 + i // 50), "tied": lambda i: 77}[times]
    rows = [hit(at(i), ip="hot" if i % 4 else f"v{i}", referrer=REFS[i % len(REFS)],
                events="1" if i % 7 == 0 else "", products="E;N;1;3;" if i % 7 == 0 else "")
            for i in range(4000)]
    opts = AttributionOptions(skew_threshold=1000, block_rows=300, order=order)
    hits = normalize_hits(frame(spark, rows))
    heavy = heavy_visitors(hits, opts)
    assert [r.ip for r in heavy.collect()] == ["hot"]
    blocks = hits.join(heavy, ["ip", "user_agent"]).groupBy(block_number(hits, opts, "_bounds").alias("b")).count().collect()
    assert len(blocks) >= 8 and max(b["count"] for b in blocks) < 600
    for timeout in (None, 50):
        assert sorted(results(attribute(frame(spark, rows), opts.with_(session_timeout=timeout)))) == _as_expected(rows, timeout, order)


def test_run_counts_has_one_visitor_exchange(spark):
    from tests.conftest import SF001
    from touchline.plans.catalog import run_counts

    df = run_counts(spark, SF001, session_timeout=1800)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    shuffles = [x for x in final.split("\n") if "Exchange hashpartitioning(ip#" in x and "ReusedExchange" not in x and "Reused" not in x]
    assert len(shuffles) == 1, final


def test_visitor_partitions_reuses_the_exchange(spark):
    rows = random_hits(5, n=200)
    r = attribute(frame(spark, rows), AttributionOptions(visitor_partitions=3, skew_threshold=None))
    want, _ = fold(rows)
    assert sorted(results(r)) == sorted((d, disp, str(rev)) for (d, _), (disp, rev) in want.items())
    final = r.attributed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("hashpartitioning(ip#") == 1 and ", 3)" in final


def test_rank_across_partitions(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from touchline.operators.aggregate import result_order, with_rank

    df = spark.range(1000).select(
        F.concat(F.lit("e"), (F.col("id") % 3).cast("string")).alias("search_engine_domain"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("keyword_lower"),
        F.concat(F.lit("K"), F.col("id").cast("string")).alias("search_keyword"),
        ((F.col("id") * 7919) % 97).cast("decimal(38,2)").alias("revenue"),
    ).repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = with_rank(df)
        assert ranked.rdd.getNumPartitions() > 1
        got = {r.keyword_lower: r["rank"] for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = {r.keyword_lower: r.rn for r in df.select(
        "keyword_lower", F.row_number().over(Window.orderBy(*result_order())).alias("rn")).collect()}
    assert got == want
