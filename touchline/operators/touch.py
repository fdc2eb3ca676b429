"""Last-touch state over visitor windows.

One pass per visitor in processing order, expressed as window functions over
``partitionBy(ip, user_agent)``: previous-hit gap (W2), session boundary with a
strict ``>`` (W3), running session id (W4) and the forward-filled touch tagged
with its session id, so a touch from an earlier session is dropped without a
second partitioning (W5).  The order is the arrival sequence, or
(hit time, arrival sequence) in time order (W6).

Skew: a visitor with more hits than ``skew_threshold`` would put all its rows
in one task.  Such visitors are split into blocks of the order key; each block
is scanned on its own, a per-block summary (first/last time, session breaks,
last touch) is carried across blocks with a window over the small summary,
and the carry is joined back.  The result is identical to the one-level scan.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..options import AttributionOptions
from .normalize import VISITOR

BLOCK = "_blk"


def order_keys(order: str) -> list[Column]:
    """Window order for a processing mode; never hit time alone (ties keep file order)."""
    if order == "file":
        return [F.col("seq")]
    return [F.col("hit_time"), F.col("seq")]


def order_struct(order: str) -> Column:
    """The processing order as one orderable value (for min/max aggregates)."""
    return F.struct(*order_keys(order))


def order_value(order: str) -> Column:
    """The processing order as a value to cut blocks at."""
    return F.col("seq") if order == "file" else order_struct(order)


def order_number(df: DataFrame, order: str) -> Optional[Column]:
    """The processing order packed into one DECIMAL(38,0), or None.

    Possible when ``seq`` is a non-negative integer: file order is ``seq``;
    time order is ``hit_time * 10^19 + seq`` (seq < 2^63 < 10^19, so the pair
    order is kept).  A fixed-width number lets aggregations keep hash buffers.
    """
    if not _is_numeric_seq(df):
        return None
    seq = F.col("seq").cast("decimal(38,0)")
    if order == "file":
        return seq
    shift = F.lit(Decimal(10**19)).cast("decimal(38,0)")
    return (F.col("hit_time").cast("decimal(38,0)") * shift + seq).cast("decimal(38,0)")


def _running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _is_numeric_seq(df: DataFrame) -> bool:
    return df.schema["seq"].dataType.typeName() in ("long", "integer", "short", "byte")


def block_number(df: DataFrame, options: AttributionOptions, bounds: str) -> Column:
    """Block of the processing order, non-decreasing along it: how many of a
    visitor's sorted ``bounds`` are not beyond the hit (a binary search), or
    with ``block_span`` fixed spans of a numeric order key."""
    if options.block_span and (options.order == "time" or _is_numeric_seq(df)):
        return F.floor((F.col("hit_time") if options.order == "time" else F.col("seq")) / options.block_span)
    steps = F.array(*[F.lit(1 << i) for i in range(24, -1, -1)])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(F.col(bounds), at + step - 1) <= order_value(options.order), at + step).otherwise(at),
    ).cast("long")


def _scan(df: DataFrame, parts: list, options: AttributionOptions, with_gaps: bool) -> DataFrame:
    """One-level scan inside each window partition.

    Adds ``last_hit``, ``prev_time`` (if gaps are wanted or a timeout is set), ``brk``,
    ``sid`` (session breaks so far in the partition) and ``tag`` (last touch so
    far with the sid it was seen in).
    """
    w = Window.partitionBy(*parts).orderBy(*order_keys(options.order))
    run = _running(w)
    timeout = options.session_timeout
    df = df.withColumn("last_hit", F.lead(F.lit(True)).over(w).isNull())
    if timeout is not None or with_gaps:
        df = df.withColumn("prev_time", F.lag("hit_time").over(w))
    if timeout is None:
        df = df.withColumns({"brk": F.lit(False), "sid": F.lit(0).cast("long")})
        return df.withColumn("tag", F.last("touch", ignorenulls=True).over(run))
    df = df.withColumn(
        "brk", F.coalesce(F.col("hit_time") - F.col("prev_time") > F.lit(timeout), F.lit(False))
    )
    df = df.withColumn("sid", F.sum(F.col("brk").cast("long")).over(run))
    tagged = F.when(
        F.col("touch").isNotNull(),
        F.struct(F.col("sid").alias("sid"), F.col("touch").alias("touch")),
    )
    return df.withColumn("tag", F.last(tagged, ignorenulls=True).over(run))


def _finish_single(df: DataFrame, options: AttributionOptions, with_gaps: bool) -> DataFrame:
    if options.session_timeout is None:
        live = F.col("tag")
    else:
        live = F.when(F.col("tag.sid") == F.col("sid"), F.col("tag.touch"))
    out = df.withColumns({"live_touch": live, "new_session": F.col("brk"), "session_id": F.col("sid")})
    return _with_gap(out, with_gaps or options.session_timeout is not None).drop("brk", "sid", "tag")


def _with_gap(df: DataFrame, has_prev: bool) -> DataFrame:
    if not has_prev:
        return df
    return df.withColumn("gap", F.col("hit_time") - F.col("prev_time"))


# Expected sampled hits of a visitor exactly at the skew threshold; visitors
# with at least half of that in the sample are split.
SKEW_SAMPLE_HITS = 200
SKEW_SAMPLE_SEED = 17


def heavy_visitors(hits: DataFrame, options: AttributionOptions) -> Optional[DataFrame]:
    """(visitor, ``_bounds``) of visitors with more than ``skew_threshold``
    hits, or None.

    With no more hits than that in all, nobody has.  Otherwise a seeded sample
    of all hits, by the raw key columns only, is counted per visitor: one at
    the threshold has ``SKEW_SAMPLE_HITS`` expected sampled hits, one with half
    of them is split.  Block bounds are quantiles of a visitor's sampled order
    keys, so blank times, bursts and ties make no larger blocks.  The sample
    only decides where to cut: every hit is processed, and the result is the
    same wherever the cuts are.  The table is stored and stays distributed;
    Spark decides by its size how to join it.
    """
    from ..session import checkpoint_table

    if hits.count() <= options.skew_threshold:
        return None
    rate = min(1.0, SKEW_SAMPLE_HITS / options.skew_threshold)
    floor = SKEW_SAMPLE_HITS // 2 if rate < 1.0 else options.skew_threshold + 1
    sampled = hits.select(*VISITOR, order_value(options.order).alias("_key"))
    if rate < 1.0:
        sampled = sampled.sample(fraction=rate, seed=SKEW_SAMPLE_SEED)
    hot = sampled.groupBy(*VISITOR).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= floor)
    every = max(1, round(options.block_rows * rate))
    nth = F.row_number().over(Window.partitionBy(*VISITOR).orderBy("_key"))
    cuts = sampled.join(hot.select(*VISITOR), list(VISITOR)).withColumn("_nth", nth).filter(F.col("_nth") % every == 0)
    bounds = cuts.groupBy(*VISITOR).agg(F.array_sort(F.collect_list("_key")).alias("_bounds"))
    heavy = checkpoint_table(hot.select(*VISITOR).join(bounds, list(VISITOR), "left"), "heavy")
    return None if heavy.isEmpty() else heavy


def _scan_split(
    prepared: DataFrame,
    heavy: DataFrame,
    options: AttributionOptions,
    with_gaps: bool,
) -> DataFrame:
    """Two-level scan: blocks for heavy visitors, carry across blocks."""
    timeout = options.session_timeout
    marked = heavy.withColumn("_heavy", F.lit(True))
    flagged = prepared.join(marked, list(VISITOR), "left")
    flagged = flagged.withColumn(
        BLOCK, F.when(F.col("_heavy"), block_number(prepared, options, "_bounds"))
    ).drop("_heavy", "_bounds")
    local = _scan(flagged, [*VISITOR, BLOCK], options, with_gaps=True)

    ordk = order_struct(options.order)
    summary = (
        local.filter(F.col(BLOCK).isNotNull())
        .groupBy(*VISITOR, BLOCK)
        .agg(
            F.min_by("hit_time", ordk).alias("first_time"),
            F.max_by("hit_time", ordk).alias("last_time"),
            F.max("sid").alias("n_brk"),
            F.max_by("tag", ordk).alias("last_tag"),
        )
    )
    wv = Window.partitionBy(*VISITOR).orderBy(BLOCK)
    before = wv.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("prev_last", F.lag("last_time").over(wv))
    if timeout is None:
        summary = summary.withColumn("head_brk", F.lit(False))
    else:
        summary = summary.withColumn(
            "head_brk",
            F.coalesce(F.col("first_time") - F.col("prev_last") > F.lit(timeout), F.lit(False)),
        )
    summary = summary.withColumn("span", F.col("head_brk").cast("long") + F.col("n_brk"))
    summary = summary.withColumn(
        "base",
        F.coalesce(F.sum("span").over(before), F.lit(0).cast("long"))
        + F.col("head_brk").cast("long"),
    )
    if timeout is None:
        carry_out = F.col("last_tag")
    else:
        carry_out = F.when(
            F.col("last_tag").isNotNull(),
            F.struct(
                (F.col("base") + F.col("last_tag.sid")).alias("sid"),
                F.col("last_tag.touch").alias("touch"),
            ),
        )
    summary = summary.withColumn("carry_out", carry_out)
    summary = summary.withColumn("carry_in", F.last("carry_out", ignorenulls=True).over(before))
    summary = summary.withColumn("last_block", F.lead(F.lit(True)).over(wv).isNull())
    carry = summary.select(*VISITOR, BLOCK, "prev_last", "head_brk", "base", "carry_in", "last_block")

    # The carry table has one row per block of a split visitor; AQE broadcasts
    # it when its measured size is small and shuffles it otherwise.
    joined = local.join(carry, [*VISITOR, BLOCK], "left")
    first_in_block = F.col("prev_time").isNull()
    sid_g = F.coalesce(F.col("base"), F.lit(0).cast("long")) + F.col("sid")
    if timeout is None:
        live = F.coalesce(F.col("tag"), F.col("carry_in"))
        new_session = F.lit(False)
    else:
        live = F.when(
            F.col("tag").isNotNull(), F.when(F.col("tag.sid") == F.col("sid"), F.col("tag.touch"))
        ).otherwise(F.when(F.col("carry_in.sid") == sid_g, F.col("carry_in.touch")))
        new_session = F.col("brk") | (first_in_block & F.coalesce(F.col("head_brk"), F.lit(False)))
    out = joined.withColumns(
        {
            "live_touch": live,
            "new_session": new_session,
            "session_id": sid_g,
            "last_hit": F.col("last_hit") & F.coalesce("last_block", F.lit(True)),
            "prev_time": F.coalesce(F.col("prev_time"), F.col("prev_last")),
        }
    )
    out = _with_gap(out, True)
    if not (with_gaps or timeout is not None):
        out = out.drop("prev_time", "gap")
    return out.drop("brk", "sid", "tag", "prev_last", "head_brk", "base", "carry_in", "last_block", BLOCK)


def last_touch(
    prepared: DataFrame,
    options: Optional[AttributionOptions] = None,
    with_gaps: bool = False,
    visitors: Optional[DataFrame] = None,
) -> DataFrame:
    """Add ``live_touch`` (the session-scoped last touch, own referrer included),
    ``new_session``, ``session_id`` and ``last_hit`` (no later hit of the
    visitor in this frame); with a timeout or ``with_gaps`` also
    ``prev_time`` and ``gap``.

    Every input row is kept; filter *before* calling only when no timeout is set.
    ``visitors`` is the frame the skew guard counts on (default ``prepared``);
    pass the normalised hits so the counting pass never parses URLs.
    """
    options = options or AttributionOptions()
    if options.skew_threshold is not None:
        heavy = heavy_visitors(visitors if visitors is not None else prepared, options)
        if heavy is not None:
            return _scan_split(prepared, heavy, options, with_gaps)
    if options.visitor_partitions:
        # explicit size for the one visitor shuffle; the window reuses it
        prepared = prepared.repartition(options.visitor_partitions, *VISITOR)
    return _finish_single(_scan(prepared, list(VISITOR), options, with_gaps), options, with_gaps)


def relevant_only(prepared: DataFrame, options: AttributionOptions) -> DataFrame:
    """Relevance pre-filter: with no timeout only search hits and purchases can
    change a result, so the rest is dropped before the visitor shuffle."""
    if options.session_timeout is None and options.prefilter:
        return prepared.filter(F.col("touch").isNotNull() | F.col("is_purchase"))
    return prepared
