"""Reports over attributed hits."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import SUM_TYPE, to_cents
from ..options import AttributionOptions
from .classify import ATTRIBUTED, UNATTRIBUTED, outcome
from .touch import order_keys, order_number

RESULT_COLUMNS = ("search_engine_domain", "search_keyword", "revenue")


def per_file_order(df: DataFrame, order: str):
    """``(file, order number inside the file)`` for a file-order arrival
    sequence ``(file, start, pos)``, or None.

    ``start * 10^19 + pos`` (pos < 2^63) keeps the order of splits and of rows
    inside a split in one fixed-width DECIMAL(38,0).
    """
    if order != "file":
        return None
    t = df.schema["seq"].dataType
    if t.typeName() != "struct" or [f.name for f in t.fields] != ["file", "start", "pos"]:
        return None
    shift = F.lit(Decimal(10**19)).cast("decimal(38,0)")
    num = (F.col("seq.start").cast("decimal(38,0)") * shift + F.col("seq.pos").cast("decimal(38,0)")).cast(
        "decimal(38,0)"
    )
    return F.col("seq.file"), num


def keyword_revenue(attributed: DataFrame, options: AttributionOptions) -> DataFrame:
    """Revenue per (engine, lower-cased keyword), shown with the first-seen casing.

    Aggregated straight from the window output: search hits contribute display
    candidates (earliest in processing order, A2), attributed purchases the
    revenue (A1).  Groups without revenue are dropped; the sum is exact and
    rounded once, half-even, to cents (F10).

    With a numeric order key the first level groups by the exact keyword
    variant with hash aggregation (sum, min of a packed order number) and only
    the much smaller variant table is folded to one row per group.
    """
    is_attr = F.col("is_purchase") & (F.col("revenue") > 0) & F.col("live_touch").isNotNull()
    key = F.when(F.col("touch").isNotNull(), F.col("touch")).otherwise(F.col("live_touch"))
    relevant = attributed.filter(F.col("touch").isNotNull() | is_attr)
    ordnum = order_number(attributed, options.order)
    if ordnum is not None:
        variants = relevant.select(
            key["domain"].alias("search_engine_domain"),
            key["keyword"].alias("variant"),
            F.when(F.col("touch").isNotNull(), ordnum).alias("seen_at"),
            F.when(is_attr, F.col("revenue")).alias("credit"),
        ).groupBy("search_engine_domain", "variant").agg(
            F.sum("credit").alias("credit"), F.min("seen_at").alias("seen_at")
        )
        grouped = variants.groupBy(
            "search_engine_domain", F.lower("variant").alias("keyword_lower")
        ).agg(
            F.sum("credit").alias("revenue_exact"),
            F.min_by("variant", "seen_at").alias("search_keyword"),
        )
    elif per_file_order(attributed, options.order) is not None:
        # arrival order of hit files: hash-aggregate per (variant, file), then
        # fold the per-file table, which is small, by (file, order in file)
        file_col, num = per_file_order(attributed, options.order)
        per_file = relevant.select(
            key["domain"].alias("search_engine_domain"),
            key["keyword"].alias("variant"),
            file_col.alias("_file"),
            F.when(F.col("touch").isNotNull(), num).alias("seen_at"),
            F.when(is_attr, F.col("revenue")).alias("credit"),
        ).groupBy("search_engine_domain", "variant", "_file").agg(
            F.sum("credit").alias("credit"), F.min("seen_at").alias("seen_at")
        )
        variants = per_file.groupBy("search_engine_domain", "variant").agg(
            F.sum("credit").alias("credit"),
            F.min(F.when(F.col("seen_at").isNotNull(), F.struct("_file", "seen_at"))).alias("seen"),
        )
        grouped = variants.groupBy(
            "search_engine_domain", F.lower("variant").alias("keyword_lower")
        ).agg(
            F.sum("credit").alias("revenue_exact"),
            F.min_by("variant", "seen").alias("search_keyword"),
        )
    else:
        rows = relevant.select(
            key["domain"].alias("search_engine_domain"),
            F.lower(key["keyword"]).alias("keyword_lower"),
            F.when(
                F.col("touch").isNotNull(),
                F.struct(*order_keys(options.order), F.col("touch.keyword").alias("kw")),
            ).alias("seen"),
            F.when(is_attr, F.col("revenue")).alias("credit"),
        )
        grouped = rows.groupBy("search_engine_domain", "keyword_lower").agg(
            F.sum("credit").alias("revenue_exact"),
            F.min("seen")["kw"].alias("search_keyword"),
        )
    return grouped.filter(F.col("revenue_exact").isNotNull()).select(
        "search_engine_domain",
        "search_keyword",
        "keyword_lower",
        to_cents("revenue_exact").alias("revenue"),
    )


def first_seen_display(search: DataFrame, options: AttributionOptions) -> DataFrame:
    """First-seen keyword casing per (engine, lower-cased keyword) over search hits (A2).

    Hash aggregation per exact keyword variant first (min of the packed order
    number), then a small fold per group; sort-based only without a numeric order.
    """
    ordnum = order_number(search, options.order)
    pf = per_file_order(search, options.order) if ordnum is None else None
    if pf is not None:
        file_col, num = pf
        per_file = search.groupBy(
            F.col("touch.domain").alias("search_engine_domain"),
            F.col("touch.keyword").alias("variant"),
            file_col.alias("_file"),
        ).agg(F.min(num).alias("seen_at"))
        variants = per_file.groupBy("search_engine_domain", "variant").agg(
            F.min(F.struct("_file", "seen_at")).alias("seen")
        )
        return variants.groupBy("search_engine_domain", F.lower("variant").alias("keyword_lower")).agg(
            F.min_by("variant", "seen").alias("search_keyword")
        )
    if ordnum is None:
        return search.groupBy(
            F.col("touch.domain").alias("search_engine_domain"),
            F.lower("touch.keyword").alias("keyword_lower"),
        ).agg(F.min(F.struct(*order_keys(options.order), F.col("touch.keyword").alias("kw")))["kw"].alias("search_keyword"))
    variants = search.groupBy(
        F.col("touch.domain").alias("search_engine_domain"), F.col("touch.keyword").alias("variant")
    ).agg(F.min(ordnum).alias("seen_at"))
    return variants.groupBy("search_engine_domain", F.lower("variant").alias("keyword_lower")).agg(
        F.min_by("variant", "seen_at").alias("search_keyword")
    )


def result_order() -> list[Column]:
    """Report order (O1): revenue desc, domain, lower-cased keyword."""
    return [F.col("revenue").desc(), F.col("search_engine_domain"), F.col("keyword_lower")]


QUALITY_COLUMNS = (
    "malformed_referrers",
    "purchases_without_revenue",
    "unattributed_purchases",
    "blank_timestamps",
    "bad_timestamps",
    "unknown_referrer_domains",
    "total_purchase_events",
    "attributed_purchase_events",
    "total_revenue_attributed",
    "total_revenue_unattributed",
    "rows_with_search_referrer",
)


def _hit_counters(malformed: Column, unknown: Column, blank: Column, bad: Column, options: AttributionOptions) -> dict[str, Column]:
    """Counters of single hits, from their flags."""
    return {
        "malformed_referrers": F.count_if(malformed),
        "unknown_referrer_domains": F.count_if(unknown),
        # a blank time only matters where times are compared
        "blank_timestamps": F.count_if(blank) if options.session_timeout is not None else F.lit(0),
        "bad_timestamps": F.count_if(bad),
        "rows_with_search_referrer": F.count_if(F.col("touch").isNotNull()),
        "total_purchase_events": F.count_if(F.col("is_purchase")),
    }


def _purchase_counters() -> dict[str, Column]:
    """Counters of purchases, which need the live touch."""
    o = outcome()
    money = lambda kind: F.coalesce(F.sum(F.when(o == kind, F.col("revenue"))), F.lit(0))
    return {
        "purchases_without_revenue": F.count_if(F.col("is_purchase") & (F.col("revenue") == 0)),
        "unattributed_purchases": F.count_if(o == UNATTRIBUTED),
        "attributed_purchase_events": F.count_if(o == ATTRIBUTED),
        "total_revenue_attributed": money(ATTRIBUTED),
        "total_revenue_unattributed": money(UNATTRIBUTED),
    }


def _typed(name: str, value: Column) -> Column:
    return value.cast(SUM_TYPE if name.startswith("total_revenue") else "long").alias(name)


def quality_counters(prepared: DataFrame, attributed: DataFrame, options: AttributionOptions) -> DataFrame:
    """The data-quality counters as one row (A3), by plain aggregation.

    If the window holds every hit (``q_*`` flags) one pass gives them all.
    Otherwise the counters of single hits come from all hits, those of
    purchases from the window; two one-row aggregates are then added up.
    """
    from .classify import with_referrer_class

    if "q_malformed" in attributed.columns:
        flags = [F.col(f"q_{n}") for n in ("malformed", "unknown", "blank", "bad")]
        return attributed.agg(*[_typed(n, c) for n, c in {**_hit_counters(*flags, options), **_purchase_counters()}.items()]).select(*QUALITY_COLUMNS)
    kind = F.col("referrer_class")
    flags = [kind == "malformed", kind == "unknown_external", F.col("time_blank"), F.col("time_bad")]
    hits = with_referrer_class(prepared, options.internal_suffixes).agg(*[_typed(n, c) for n, c in _hit_counters(*flags, options).items()])
    purchases = attributed.filter("is_purchase").agg(*[_typed(n, c) for n, c in _purchase_counters().items()])
    both = hits.unionByName(purchases, allowMissingColumns=True)
    return both.agg(*[_typed(n, F.max(n)) for n in QUALITY_COLUMNS])


def window_counts(attributed: DataFrame) -> DataFrame:
    """Live visitors, keyword groups and their revenue as one row, in one pass
    over the window: the first level groups by keyword and also counts the last
    hits that still have a touch."""
    is_attr = F.col("is_purchase") & (F.col("revenue") > 0) & F.col("live_touch").isNotNull()
    groups = attributed.groupBy(
        F.when(is_attr, F.col("live_touch.domain")).alias("domain"), F.when(is_attr, F.lower("live_touch.keyword")).alias("keyword_lower")
    ).agg(F.sum(F.when(is_attr, F.col("revenue"))).alias("credit"), F.count_if(F.col("last_hit") & F.col("live_touch").isNotNull()).alias("live"))
    return groups.agg(
        F.coalesce(F.sum("live"), F.lit(0)).cast("long").alias("visitors_with_live_touch"),
        F.count("credit").alias("keyword_groups"),
        F.coalesce(F.sum(to_cents("credit")), F.lit(0)).cast("decimal(38,2)").alias("total_attributed_revenue"),
    )


def with_rank(results: DataFrame) -> DataFrame:
    """Dense 1-based position in report order, computed without one global task.

    The result is range-partitioned and sorted by the report order; each
    partition's row count gives an offset (a table with one row per partition,
    so its size is bounded by the partition count) that is added to the row's
    position inside its partition.  The sorted result is checkpointed first so
    both passes see the same partitions.
    """
    from ..session import reliable_checkpoint

    ordered = reliable_checkpoint(results.orderBy(*result_order()))
    pos = ordered.withColumns(
        {"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}
    )
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast("long"),
        ),
    ).select("_pid", "_off")
    ranked = pos.join(F.broadcast(offsets), "_pid")
    return ranked.withColumn(
        "rank",
        (F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33) + 1).cast("long"),
    ).drop("_pid", "_mid", "_off")
