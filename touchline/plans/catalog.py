"""Registered queries over the driver's tables: one per operator.

Every query derives the hit frame from ``events`` (or reads ``pages``), so its
work grows with the tables.  The file-facing queries (hit files, report,
intake, streams) first write what they need under the session's checkpoint
folder and read it back.  Output columns are snake_case, counts BIGINT,
money DECIMAL(38,2), to line up with the DuckDB oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    MONEY_TYPE,
    blank_to_empty,
    classify_referrer,
    engine_lookup,
    money_text,
    product_revenue,
    query_param,
    referrer_host,
    strip_text,
    to_cents,
    url_decode,
    url_query,
    with_referrer_parts,
)
from ..operators.aggregate import keyword_revenue as keyword_report
from ..operators.aggregate import with_rank
from ..operators.classify import attributed_purchases, purchase_hits, search_hits, with_referrer_class
from ..operators.normalize import VISITOR, normalize_hits, prepare_hits
from ..operators.touch import last_touch
from ..options import AttributionOptions
from ..sources.events import hits_from_events, odd_referrers, read_table
from .attribution import attribute

TIMEOUT = 21600

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(spark, sf_dir) -> DataFrame:
    return prepare_hits(hits_from_events(spark, sf_dir))


def _result(spark, sf_dir, **opts):
    return attribute(hits_from_events(spark, sf_dir), AttributionOptions(**opts))


def _money(c):
    return F.col(c).cast(MONEY_TYPE)


def keyword_revenue(spark, sf_dir, **opts) -> DataFrame:
    return _result(spark, sf_dir, **opts).results.drop("keyword_lower")


def keyword_revenue_ranked(spark, sf_dir, **opts) -> DataFrame:
    return with_rank(_result(spark, sf_dir, **opts).results).drop("keyword_lower")


def keyword_display(spark, sf_dir) -> DataFrame:
    """First-seen casing for every (engine, keyword) group over search hits (A2)."""
    from ..operators.aggregate import first_seen_display

    return first_seen_display(search_hits(_prepared(spark, sf_dir)), AttributionOptions())


def quality_metrics(spark, sf_dir, **opts) -> DataFrame:
    q = _result(spark, sf_dir, **opts).quality
    return q.withColumns(
        {"total_revenue_attributed": _money("total_revenue_attributed"),
         "total_revenue_unattributed": _money("total_revenue_unattributed")}
    )


def run_counts(spark, sf_dir, **opts) -> DataFrame:
    return _result(spark, sf_dir, **opts).run_counts


def search_share(spark, sf_dir) -> DataFrame:
    """Share of hits with a search referrer, percent (A5)."""
    p = _prepared(spark, sf_dir)
    a = p.agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("touch").isNotNull()).alias("search_rows"),
    )
    pct = F.when(F.col("rows_processed") > 0, F.lit(100.0) * F.col("search_rows") / F.col("rows_processed"))
    return a.withColumn("search_share_pct", F.coalesce(F.bround(pct, 4), F.lit(0.0)).cast("decimal(10,4)"))


def purchase_outcomes(spark, sf_dir, **opts) -> DataFrame:
    r = _result(spark, sf_dir, **opts)
    return (
        r.attributed.filter(F.col("is_purchase"))
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("purchases"), to_cents(F.sum("revenue")).alias("revenue"))
    )


def referrer_classes(spark, sf_dir) -> DataFrame:
    c = with_referrer_class(_prepared(spark, sf_dir))
    return c.groupBy("referrer_class").agg(F.count(F.lit(1)).alias("hits"))


def referrer_rules(spark, sf_dir) -> DataFrame:
    """Host, class, engine and keyword of odd referrers."""
    odd = odd_referrers(read_table(spark, sf_dir, "events")).withColumn("referrer", blank_to_empty("referrer"))
    parts = with_referrer_parts(odd)
    cls = classify_referrer("referrer", "touch", "ref_host", "ref_malformed")
    host = F.when(~F.col("ref_malformed"), F.col("ref_host")).alias("ref_host")
    return parts.select("seq", host, cls.alias("referrer_class"), "touch.domain", "touch.keyword")


def sql_functions(spark, sf_dir) -> DataFrame:
    """Touch, host and purchase revenue of every hit, in SQL over SQL functions."""
    from ..functions import register_sql_functions

    register_sql_functions(spark, prefix="touchline_")
    return spark.sql(
        """
        SELECT seq, touch.domain AS search_engine_domain, touch.keyword AS search_keyword, referrer_host, is_purchase,
               if(is_purchase, touchline_to_cents(touchline_product_revenue(touchline_strip_text(product_list))), 0.00) AS revenue
        FROM (SELECT seq, product_list, touchline_search_referrer(touchline_strip_text(referrer)) AS touch,
                     touchline_url_host(touchline_strip_text(referrer)) AS referrer_host,
                     touchline_is_purchase(event_list) AS is_purchase
              FROM {hits})
        """,
        hits=hits_from_events(spark, sf_dir),
    ).withColumn("revenue", F.col("revenue").cast(MONEY_TYPE))


def hit_normalize(spark, sf_dir) -> DataFrame:
    n = normalize_hits(hits_from_events(spark, sf_dir))
    return n.select("seq", "ip", "user_agent", "referrer", "event_list", "product_list")


def hit_time_coerce(spark, sf_dir) -> DataFrame:
    n = normalize_hits(hits_from_events(spark, sf_dir))
    return n.select("seq", "hit_time", "time_blank", "time_bad")


def visitor_key(spark, sf_dir) -> DataFrame:
    n = normalize_hits(hits_from_events(spark, sf_dir))
    return n.groupBy(*VISITOR).agg(F.count(F.lit(1)).alias("hits"))


def search_hit_rows(spark, sf_dir) -> DataFrame:
    s = search_hits(_prepared(spark, sf_dir))
    return s.select("seq", F.col("touch.domain").alias("search_engine_domain"),
                    F.col("touch.keyword").alias("search_keyword"))


def purchase_hit_rows(spark, sf_dir) -> DataFrame:
    p = purchase_hits(_prepared(spark, sf_dir))
    return p.select("seq", _money("revenue").alias("revenue"))


def _touch_cols(prefix="live_touch"):
    return [F.col(f"{prefix}.domain").alias("search_engine_domain"),
            F.col(f"{prefix}.keyword").alias("search_keyword")]


def attributed_purchase_rows(spark, sf_dir, **opts) -> DataFrame:
    a = attributed_purchases(_result(spark, sf_dir, **opts).attributed)
    return a.select("seq", *VISITOR, *_touch_cols(), _money("revenue").alias("revenue"))


def last_touch_asof(spark, sf_dir, **opts) -> DataFrame:
    """Each purchase with the latest touch at or before it, left outer."""
    a = _result(spark, sf_dir, **opts).attributed.filter(F.col("is_purchase"))
    return a.select("seq", *_touch_cols())


def _all_hits_window(spark, sf_dir, options: AttributionOptions, with_gaps=False) -> DataFrame:
    visitors = normalize_hits(hits_from_events(spark, sf_dir)).select("seq", *VISITOR, "hit_time")
    return last_touch(_prepared(spark, sf_dir), options, with_gaps=with_gaps, visitors=visitors)


def last_touch_ffill(spark, sf_dir) -> DataFrame:
    w = _all_hits_window(spark, sf_dir, AttributionOptions())
    return w.select("seq", *_touch_cols())


def hit_gaps(spark, sf_dir) -> DataFrame:
    w = _all_hits_window(spark, sf_dir, AttributionOptions(), with_gaps=True)
    return w.select("seq", "gap")


def session_starts(spark, sf_dir) -> DataFrame:
    w = _all_hits_window(spark, sf_dir, AttributionOptions(session_timeout=TIMEOUT))
    return w.select("seq", "new_session")


def session_ids(spark, sf_dir) -> DataFrame:
    w = _all_hits_window(spark, sf_dir, AttributionOptions(session_timeout=TIMEOUT))
    return w.select("seq", "session_id")


def session_last_touch(spark, sf_dir) -> DataFrame:
    w = _all_hits_window(spark, sf_dir, AttributionOptions(session_timeout=TIMEOUT))
    return w.select("seq", *_touch_cols())


def _pages(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url")


def page_hosts(spark, sf_dir) -> DataFrame:
    """URL host of every page (F1)."""
    return _pages(spark, sf_dir).select("page_id", referrer_host("url").alias("host"))


def page_query_params(spark, sf_dir) -> DataFrame:
    """Query parameters ``page``, ``ref`` and ``utm_source`` of every page."""
    q = url_query("url")
    return _pages(spark, sf_dir).select(
        "page_id",
        query_param(q, "page").alias("page"),
        query_param(q, "ref").alias("ref"),
        query_param(q, "utm_source").alias("utm_source"),
    )


def _referrers(spark, sf_dir) -> DataFrame:
    n = normalize_hits(hits_from_events(spark, sf_dir)).select("seq", F.col("referrer").alias("url"))
    return n


def engine_matches(spark, sf_dir) -> DataFrame:
    """Engine of every referrer host and page host, counted per host."""
    refs = _referrers(spark, sf_dir).select("url")
    pages = _pages(spark, sf_dir).select("url")
    u = refs.unionByName(pages).select(referrer_host("url").alias("host"))
    e = u.withColumn("engine", engine_lookup("host"))
    return e.groupBy("host").agg(
        F.first(F.col("engine.domain")).alias("engine_domain"),
        F.count(F.lit(1)).alias("urls"),
    )


def decoded_queries(spark, sf_dir) -> DataFrame:
    """Lenient decoding of every referrer's query string."""
    r = _referrers(spark, sf_dir)
    return r.select("seq", url_decode(url_query("url")).alias("decoded_query"))


def referrer_touches(spark, sf_dir) -> DataFrame:
    """(engine, keyword) per distinct referrer with its hit count."""
    from ..functions import with_referrer_parts

    t = with_referrer_parts(_referrers(spark, sf_dir), "url")
    return t.groupBy(F.col("url").alias("referrer")).agg(
        F.first("touch.domain").alias("search_engine_domain"),
        F.first("touch.keyword").alias("search_keyword"),
        F.count(F.lit(1)).alias("hits"),
    )


def product_revenue_rows(spark, sf_dir) -> DataFrame:
    """Product-list revenue of every hit, purchase or not."""
    h = hits_from_events(spark, sf_dir)
    return h.select("seq", product_revenue(strip_text("product_list")).cast(MONEY_TYPE).alias("revenue"))


def agent_strip(spark, sf_dir) -> DataFrame:
    """Raw user agent to its stripped form, counted."""
    h = hits_from_events(spark, sf_dir)
    return h.groupBy(F.col("user_agent").alias("raw_agent")).agg(
        F.first(strip_text("user_agent")).alias("stripped_agent"),
        F.count(F.lit(1)).alias("hits"),
    )


def registry() -> dict[str, Query]:
    t = TIMEOUT
    return {
        "keyword_revenue": keyword_revenue,
        "keyword_revenue_ranked": keyword_revenue_ranked,
        "keyword_revenue_timeout": lambda s, d: keyword_revenue(s, d, session_timeout=t),
        "keyword_revenue_skew_split": lambda s, d: keyword_revenue(s, d, skew_threshold=20, block_rows=16),
        "keyword_revenue_skew_split_timeout": lambda s, d: keyword_revenue(
            s, d, session_timeout=t, skew_threshold=20, block_span=512),
        "last_touch_time_order": lambda s, d: keyword_revenue(s, d, order="time", session_timeout=t),
        "last_touch_time_order_no_timeout": lambda s, d: keyword_revenue(s, d, order="time"),
        "keyword_display": keyword_display,
        "quality_metrics": quality_metrics,
        "quality_metrics_timeout": lambda s, d: quality_metrics(s, d, session_timeout=t),
        "run_counts": run_counts,
        "run_counts_timeout": lambda s, d: run_counts(s, d, session_timeout=t),
        "search_share": search_share,
        "business_summary": lambda s, d: business_summary(s, d),
        "business_summary_timeout": lambda s, d: business_summary(s, d, session_timeout=t),
        "purchase_outcomes": purchase_outcomes,
        "purchase_outcomes_timeout": lambda s, d: purchase_outcomes(s, d, session_timeout=t),
        "referrer_class": referrer_classes,
        "referrer_rules": referrer_rules,
        "sql_functions": sql_functions,
        "hit_normalize": hit_normalize,
        "hit_time_coerce": hit_time_coerce,
        "visitor_key": visitor_key,
        "search_hits": search_hit_rows,
        "purchase_hits": purchase_hit_rows,
        "attributed_purchases": attributed_purchase_rows,
        "last_touch_asof": last_touch_asof,
        "last_touch_ffill": last_touch_ffill,
        "hit_gaps": hit_gaps,
        "session_starts": session_starts,
        "session_ids": session_ids,
        "session_last_touch": session_last_touch,
        "referrer_host": page_hosts,
        "query_param": page_query_params,
        "engine_lookup": engine_matches,
        "url_decode": decoded_queries,
        "search_referrer": referrer_touches,
        "product_revenue": product_revenue_rows,
        "strip_text": agent_strip,
        "stream_keyword_revenue": lambda s, d: stream_keyword_revenue(s, d),
        "stream_session_timeout": lambda s, d: stream_keyword_revenue(s, d, session_timeout=t),
        "stream_idle_limit": lambda s, d: stream_idle_limit(s, d),
        "stream_live_visitors": lambda s, d: stream_live_visitors(s, d),
        "stream_order_policy": lambda s, d: stream_keyword_revenue(s, d, order="time", session_timeout=t),
        "stream_last_touch": stream_last_touch_rows,
        "hit_file_scan": lambda s, d: hit_file_scan(s, d),
        "hit_file_scan_gzip_timeout": lambda s, d: hit_file_scan(s, d, codec="gzip", session_timeout=t),
        "hit_file_scan_mixed_headers": lambda s, d: hit_file_scan(s, d, mixed=True),
        "schema_contract": schema_contract,
        "last_touch_time_order_skew_split": lambda s, d: keyword_revenue(
            s, d, order="time", session_timeout=t, skew_threshold=20, block_rows=16),
        "stream_running_totals": lambda s, d: stream_running_totals(s, d),
        "stream_running_totals_time_order": lambda s, d: stream_running_totals(s, d, order="time", session_timeout=t),
        "stream_chained_totals": lambda s, d: stream_chained_totals(s, d),
        "stream_hit_files": lambda s, d: stream_hit_files(s, d),
        "stream_hit_files_timeout": lambda s, d: stream_hit_files(s, d, session_timeout=t),
        "report_file": lambda s, d: report_file(s, d),
        "intake_anti_join": intake_anti_join,
        "run_manifest": lambda s, d: run_manifest(s, d),
        "run_manifest_timeout": lambda s, d: run_manifest(s, d, session_timeout=t),
    }


def run_manifest(spark, sf_dir, **opts) -> DataFrame:
    """The manifest's stable fields beside each row of its result list (S7,
    A4, A6): one row a result."""
    r = _result(spark, sf_dir, **opts).materialize()
    counts = r.run_counts.select(
        F.lit("v1").alias("schema_version"),
        "rows_processed",
        F.col("visitors_with_live_touch").alias("unique_visitors"),
        "keyword_groups",
        F.col("total_attributed_revenue").cast("string").alias("total_attributed_revenue"),
    )
    rows = with_rank(r.results).select(
        "rank", F.col("search_engine_domain").alias("domain"), F.col("search_keyword").alias("keyword"), money_text("revenue").alias("revenue")
    )
    # counts are one row: every result row is paired with it by a constant key
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(counts.withColumn("_one", F.lit(1))), "_one").drop("_one")


def stream_keyword_revenue(spark, sf_dir, **opts) -> DataFrame:
    """Keyword revenue from the stateful streaming form."""
    from ..streaming.runner import running_keyword_revenue

    return running_keyword_revenue(spark, sf_dir, AttributionOptions(**opts))


def stream_idle_limit(spark, sf_dir) -> DataFrame:
    """Keyword revenue of the stream that frees the state of idle visitors."""
    from ..streaming.runner import stream_attributed
    from ..streaming.stateful import as_attributed

    options = AttributionOptions(session_timeout=TIMEOUT)
    out = stream_attributed(spark, sf_dir, options, idle_limit=2 * TIMEOUT)
    return keyword_report(as_attributed(out), options).drop("keyword_lower")


def stream_live_visitors(spark, sf_dir) -> DataFrame:
    """Visitors with a live touch, read from the state store of a stopped stream (T4, A4)."""
    from ..session import scratch_path
    from ..streaming.runner import live_touches, stream_attributed

    root = scratch_path(spark, "stream")
    stream_attributed(spark, sf_dir, AttributionOptions(session_timeout=TIMEOUT), root=root)
    return live_touches(spark, f"{root}/chk").agg(F.count("*").alias("visitors_with_live_touch"))


def stream_running_totals(spark, sf_dir, **opts) -> DataFrame:
    """Running totals merged batch by batch and read back."""
    from ..streaming.runner import stream_running_totals as run

    return run(spark, sf_dir, AttributionOptions(**opts)).drop("keyword_lower")


def stream_chained_totals(spark, sf_dir, **opts) -> DataFrame:
    """Running totals from an aggregation chained to the visitor state."""
    from ..streaming.runner import stream_chained_totals as run

    return run(spark, sf_dir, AttributionOptions(**opts)).drop("keyword_lower")


def stream_hit_files(spark, sf_dir, **opts) -> DataFrame:
    """Keyword revenue of hit files with odd headers that arrive in several runs,
    with visitor state kept between them (S9, T1)."""
    from ..streaming.runner import stream_hit_files as run
    from ..streaming.stateful import as_attributed

    options = AttributionOptions(**opts)
    folder = _hits_as_files(spark, sf_dir, mixed=True).removesuffix("/*")
    per_run = max(1, -(-len(spark.read.text(f"{folder}/*").inputFiles()) // 3))
    rows = run(spark, folder, options=options, max_files=per_run, by_name=True)
    return keyword_report(as_attributed(rows), options).drop("keyword_lower")


def stream_last_touch_rows(spark, sf_dir) -> DataFrame:
    """Each purchase with its live touch, from the streaming form."""
    from ..streaming.runner import stream_attributed

    out = stream_attributed(spark, sf_dir, AttributionOptions())
    return out.filter(F.col("is_purchase")).select(
        "seq", F.col("live_domain").alias("search_engine_domain"), F.col("live_keyword").alias("search_keyword")
    )


def _hits_as_files(spark, sf_dir, codec: str = "none", mixed: bool = False) -> str:
    """Write the derived hits as tab-separated hit files (header, quoted) in the
    scratch folder: range-partitioned on arrival order, so part files in name
    order hold the hits in order, written in parallel.  ``mixed`` writes the
    later half with its columns in another order and one more."""
    from ..session import scratch_path
    from ..sources.hits import HIT_COLUMNS

    folder = scratch_path(spark, "hitfiles")
    hits = hits_from_events(spark, sf_dir)

    def write(rows, path, columns):
        (
            rows.repartitionByRange("seq")
            .sortWithinPartitions("seq")
            .select(*columns)
            .write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("compression", codec)
            .csv(path)
        )

    if not mixed:
        write(hits, folder, HIT_COLUMNS)
        return folder
    middle = hits.agg(F.percentile_approx("seq", 0.5)).first()[0] or 0
    write(hits.filter(F.col("seq") <= middle), f"{folder}/1", HIT_COLUMNS)
    write(hits.filter(F.col("seq") > middle), f"{folder}/2", ["seq", *reversed(HIT_COLUMNS)])
    return f"{folder}/*"


def hit_file_scan(spark, sf_dir, codec: str = "none", mixed: bool = False, **opts) -> DataFrame:
    """Keyword revenue over hit files scanned with the contract check."""
    from .attribution import attribute_files

    folder = _hits_as_files(spark, sf_dir, codec, mixed)
    return attribute_files(spark, folder, AttributionOptions(**opts)).results.drop("keyword_lower")


def schema_contract(spark, sf_dir) -> DataFrame:
    """Each required column and the hits in files whose header names it (S4):
    the hits of clicks are written without ``product_list``."""
    from ..session import scratch_path
    from ..sources.hits import HIT_COLUMNS, file_headers, read_hits

    folder = scratch_path(spark, "contract")
    hits = hits_from_events(spark, sf_dir)
    clicks = F.col("event_list") == "2"
    for name, rows, columns in (
        ("whole", hits.filter(~clicks), HIT_COLUMNS),
        ("short", hits.filter(clicks), [c for c in HIT_COLUMNS if c != "product_list"]),
    ):
        rows.select(*columns).write.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")
    headers = file_headers(spark, [f"{folder}/*"])
    named = spark.createDataFrame([(p.rsplit("/", 2)[1], c) for p, names in headers.items() for c in names], "folder string, column_name string")
    rows = read_hits(spark, [f"{folder}/*"], validate_schema=False)
    counted = rows.groupBy(F.element_at(F.split("seq.file", "/"), -2).alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    return named.distinct().join(counted, "folder").groupBy("column_name").agg(F.sum("n").alias("hits"))


def report_file(spark, sf_dir, **opts) -> DataFrame:
    """The published one-file report read back with its line order."""
    import datetime as _dt

    from ..session import scratch_path
    from .sinks import write_report

    folder = scratch_path(spark, "report")
    path = write_report(_result(spark, sf_dir, **opts), folder, _dt.date(2026, 1, 1))
    back = spark.read.option("sep", "\t").option("header", True).csv(path)
    # one small file is one partition: the row id is the line order
    return back.select(
        F.col("Search Engine Domain").alias("search_engine_domain"),
        F.col("Search Keyword").alias("search_keyword"),
        F.col("Revenue").alias("revenue_text"),
        (F.monotonically_increasing_id() + 1).alias("rank"),
    )


def business_summary(spark, sf_dir, **opts) -> DataFrame:
    """Business metrics of a run with data-quality warning flags.

    Attributed revenue (sum of the rounded groups), keyword groups, attributed
    and unattributed purchases, search-referred share, and flags raised when
    malformed referrers, blank hit times (with a timeout) or zero-revenue
    purchases occurred.
    """
    r = _result(spark, sf_dir, **opts)
    c, q = r.run_counts, r.quality
    both = c.unionByName(q, allowMissingColumns=True)
    one = both.agg(*[F.max(x).alias(x) for x in both.columns])
    share = F.when(F.col("rows_processed") > 0, F.lit(100.0) * F.col("rows_with_search_referrer") / F.col("rows_processed"))
    return one.select(
        F.col("total_attributed_revenue").alias("attributed_revenue"),
        "keyword_groups",
        F.col("attributed_purchase_events").alias("attributed_purchases"),
        "unattributed_purchases",
        (F.col("malformed_referrers") > 0).alias("warn_malformed_referrers"),
        (F.col("blank_timestamps") > 0).alias("warn_blank_timestamps"),
        (F.col("purchases_without_revenue") > 0).alias("warn_zero_revenue_purchases"),
        F.coalesce(F.round(share, 4), F.lit(0.0)).cast("decimal(10,4)").alias("search_share_pct"),
    )


UPLOADS = ("day 0", "day+0", "day%200")


def intake_anti_join(spark, sf_dir) -> DataFrame:
    """Ledger anti-join over real uploads.

    The derived hits are dealt to three uploads whose names look alike when
    they are decoded; the first is uploaded and recorded in the ledger, then
    the others arrive.  The query returns what is pending: each other upload
    (its name as a URI has it) with its hits.
    """
    from ..session import scratch_path
    from ..sources.hits import HIT_COLUMNS, literal_path, read_hits
    from ..sources.intake import list_inputs, pending_inputs, read_ledger, record_processed

    root = scratch_path(spark, "intake")
    inbox, ledger = f"{root}/in", f"{root}/ledger"
    hits = hits_from_events(spark, sf_dir)

    def pending():
        return pending_inputs(list_inputs(spark, inbox, "*.csv"), read_ledger(spark, ledger))

    for n, name in enumerate(UPLOADS):
        hits.filter(F.pmod("seq", F.lit(len(UPLOADS))) == n).select(*HIT_COLUMNS).write.option("sep", "\t").option("header", True).option(
            "quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{inbox}/{name}")
        if n == 0:
            record_processed(pending().select("input_key", "content_tag"), ledger, f"{root}/out")
    paths = [literal_path(r["path"]) for r in pending().select("path").collect()]  # one row a file
    if not paths:
        return spark.createDataFrame([], "input_name string, hits long")
    name = F.element_at(F.split("seq.file", "/"), -2)
    return read_hits(spark, paths, validate_schema=False).groupBy(name.alias("input_name")).agg(F.count(F.lit(1)).alias("hits"))
