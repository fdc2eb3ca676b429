"""Hit normalisation (P1, P2, P3) and per-hit parsing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import blank_to_empty, is_purchase, product_revenue, strip_text, with_referrer_parts
from ..functions.commerce import SUM_TYPE
from ..options import INTERNAL_SUFFIXES, SEARCH_ENGINES

VISITOR = ("ip", "user_agent")
TEXT_FIELDS = ("ip", "user_agent", "referrer", "event_list", "product_list")


def normalize_hits(raw: DataFrame) -> DataFrame:
    """Strip the five text fields (missing becomes ``''``) and coerce hit time.

    ``hit_time`` is epoch seconds; blank reads as 0 (``time_blank``); text that
    is not an integer also reads as 0 and is flagged ``time_bad``.
    """
    stripped = raw.select(
        "seq",
        *[blank_to_empty(c).alias(c) for c in TEXT_FIELDS],
        strip_text("hit_time_gmt").alias("_t"),
    )
    timed = stripped.withColumn("_tn", F.col("_t").try_cast("bigint"))
    return timed.select(
        "seq",
        *TEXT_FIELDS,
        F.coalesce(F.col("_tn"), F.lit(0).cast("bigint")).alias("hit_time"),
        F.coalesce(F.col("_t") == "", F.lit(True)).alias("time_blank"),
        ((F.coalesce(F.col("_t"), F.lit("")) != "") & F.col("_tn").isNull()).alias("time_bad"),
    )


def parse_hits(hits: DataFrame, engines=SEARCH_ENGINES) -> DataFrame:
    """Add ``touch`` (struct domain, keyword or NULL), ``ref_host``,
    ``ref_malformed``, ``is_purchase`` and ``revenue`` (parsed on purchases only).
    """
    parsed = with_referrer_parts(hits, "referrer", engines)
    parsed = parsed.withColumn("is_purchase", is_purchase("event_list"))
    return parsed.withColumn(
        "revenue",
        F.when(F.col("is_purchase"), product_revenue("product_list")).otherwise(
            F.lit(0).cast(SUM_TYPE)
        ),
    )


HIT_COUNTERS = (
    "rows_processed",
    "rows_with_search_referrer",
    "total_purchase_events",
    "malformed_referrers",
    "unknown_referrer_domains",
    "blank_timestamps",
    "bad_timestamps",
)


def _internal(host, suffixes=INTERNAL_SUFFIXES):
    out = F.lit(False)
    for sfx in suffixes:
        out = out | host.endswith(sfx)
    return out


def fence(parsed: DataFrame) -> DataFrame:
    """Keep later filters (relevance, search hits, purchases) above the parse:
    pushed below it they would hold the whole URL parse a second time.  The
    observation that does so counts rows and is never read."""
    return parsed.observe(Observation(f"fence_{uuid.uuid4().hex[:12]}"), F.count(F.lit(1)).alias("rows"))


def observe_hits(parsed: DataFrame, name: str, internal_suffixes=INTERNAL_SUFFIXES) -> DataFrame:
    """A stream of hits with live counters (T6) observed under ``name``."""
    metrics = [
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("touch").isNotNull()).alias("rows_with_search_referrer"),
        F.count_if(F.col("is_purchase")).alias("total_purchase_events"),
        F.count_if(F.col("touch").isNull() & (F.col("referrer") != "") & F.col("ref_malformed")).alias(
            "malformed_referrers"
        ),
        F.count_if(
            F.col("touch").isNull()
            & (F.col("referrer") != "")
            & ~F.col("ref_malformed")
            & F.col("ref_host").isNotNull()
            & ~_internal(F.col("ref_host"), internal_suffixes)
        ).alias("unknown_referrer_domains"),
        F.count_if(F.col("time_blank")).alias("blank_timestamps"),
        F.count_if(F.col("time_bad")).alias("bad_timestamps"),
    ]
    return parsed.observe(name, *metrics)


def prepare_hits(raw: DataFrame, engines=SEARCH_ENGINES) -> DataFrame:
    """Normalise, parse and fence the hits."""
    from ..sources.hits import spread_input

    return fence(parse_hits(normalize_hits(spread_input(raw)), engines))
