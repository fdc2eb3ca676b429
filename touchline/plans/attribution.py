"""The attribution plan: raw hits -> parsed hits -> visitor window -> reports.

Everything is a lazy ``DataFrame``; nothing runs until an action, except the
skew guard's one small counting pass inside :func:`last_touch`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Optional, Sequence, Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ParsingError
from ..operators.aggregate import keyword_revenue, quality_counters, result_order, window_counts, with_rank
from ..functions import classify_referrer
from ..operators.classify import with_outcome
from ..operators.normalize import fence, normalize_hits, parse_hits
from ..operators.touch import last_touch, relevant_only
from ..options import REPORT_HEADERS, AttributionOptions
from ..sources.hits import read_hits, spread_input


@dataclass
class AttributionResult:
    """Lazy outputs of one run."""

    normalized: DataFrame
    prepared: DataFrame
    options: AttributionOptions
    window_output: Optional[DataFrame] = None

    @cached_property
    def attributed(self) -> DataFrame:
        """Window output: every relevant hit with ``live_touch`` and ``outcome``."""
        if self.window_output is not None:
            return self.window_output
        keep = ["seq"]
        flags = []
        if self.options.session_timeout is not None or not self.options.prefilter:
            # every hit goes through the window: carry the row-level quality
            # flags so the counters need no second scan
            cls = classify_referrer(
                "referrer", "touch", "ref_host", "ref_malformed", self.options.internal_suffixes
            )
            flags = [
                (cls == "malformed").alias("q_malformed"),
                (cls == "unknown_external").alias("q_unknown"),
                F.col("time_blank").alias("q_blank"),
                F.col("time_bad").alias("q_bad"),
            ]
        narrowed = relevant_only(self.prepared, self.options).select(
            *keep, "ip", "user_agent", "hit_time", "touch", "is_purchase", "revenue", *flags,
        )
        visitors = self.normalized.select(*keep, "ip", "user_agent", "hit_time")
        return with_outcome(last_touch(narrowed, self.options, visitors=visitors))

    def materialize(self) -> "AttributionResult":
        """Run the scan and the visitor window once and keep the narrow window
        output as a Parquet table in the shared checkpoint folder; the reports
        of the returned result read that table."""
        from ..session import checkpoint_table

        return AttributionResult(self.normalized, self.prepared, self.options, checkpoint_table(self.attributed, "window"))

    @cached_property
    def results(self) -> DataFrame:
        """(search_engine_domain, search_keyword, keyword_lower, revenue DECIMAL(38,2))."""
        return keyword_revenue(self.attributed, self.options)

    @property
    def hits(self) -> DataFrame:
        return self.prepared

    def ranked(self) -> DataFrame:
        return with_rank(self.results)

    def report(self) -> DataFrame:
        """The three-column report in report order, with the display headers."""
        return self.results.orderBy(*result_order()).select(
            F.col("search_engine_domain").alias(REPORT_HEADERS[0]),
            F.col("search_keyword").alias(REPORT_HEADERS[1]),
            F.col("revenue").alias(REPORT_HEADERS[2]),
        )

    @property
    def quality(self) -> DataFrame:
        return quality_counters(self.prepared, self.attributed, self.options)

    @property
    def run_counts(self) -> DataFrame:
        """rows_processed, visitors_with_live_touch, keyword_groups, total_attributed_revenue (A4)."""
        # the normalised hits: counting the parsed ones would parse every URL
        rows = self.normalized.agg(F.count(F.lit(1)).alias("rows_processed"))
        both = rows.unionByName(window_counts(self.attributed), allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])


def attribute(raw_hits: DataFrame, options: Optional[AttributionOptions] = None) -> AttributionResult:
    """Build the lazy attribution plan over a raw hits frame."""
    options = options or AttributionOptions()
    # ``normalized`` reads the scan as it is (skew guard, row count: cheap
    # columns only); the CPU-heavy parse runs on the spread scan.
    normalized = normalize_hits(raw_hits)
    if options.strict_time:
        bad = normalized.filter("time_bad").limit(1).collect()
        if bad:
            raise ParsingError(f"the hit at {bad[0]['seq']} has no whole number as its time")
    prepared = fence(parse_hits(normalize_hits(spread_input(raw_hits)), options.engines))
    return AttributionResult(normalized, prepared, options)


def attribute_files(
    spark: SparkSession,
    paths: Union[str, Sequence[str]],
    options: Optional[AttributionOptions] = None,
) -> AttributionResult:
    """Scan hit files (S1-S5) and build the attribution plan."""
    options = options or AttributionOptions()
    return attribute(read_hits(spark, paths, options.validate_schema), options)
