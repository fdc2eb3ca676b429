"""Report sink (S6) and run manifest."""

from __future__ import annotations

import datetime as _dt
import time
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import OutputWriteError
from ..functions import money_text
from ..operators.aggregate import result_order
from ..options import OUTPUT_SCHEMA_VERSION, REPORT_HEADERS
from .attribution import AttributionResult

REPORT_SUFFIX = "_SearchKeywordPerformance.tab"
MANIFEST_SUFFIX = "_SearchKeywordPerformance_metadata.json"
SUMMARY_SUFFIX = "_SearchKeywordPerformance_results.jsonl"


def report_name(run_date: Optional[_dt.date] = None) -> str:
    """``YYYY-mm-dd_SearchKeywordPerformance.tab``."""
    d = run_date or _dt.date.today()
    return d.strftime("%Y-%m-%d") + REPORT_SUFFIX


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target`` over whatever is there.

    A file replaces a file in one rename.  A folder (or a file where a folder
    stood) is first moved beside, so the old report is never gone before the
    new one is in place under one of the two names.
    """
    jvm = spark.sparkContext._jvm
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    old = None
    if fs.exists(dst) and (fs.getFileStatus(dst).isDirectory() or fs.getFileStatus(src).isDirectory()):
        old = _fs(spark, f"{target}.__old")[1]
        fs.delete(old, True)
        if not fs.rename(dst, old):
            raise OutputWriteError(f"could not move {target} aside")
    try:
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(src), fs.makeQualified(dst), options)
    except Exception as e:  # noqa: BLE001
        raise OutputWriteError(f"could not publish {source} as {target}: {e}") from e
    if old is not None:
        fs.delete(old, True)


def _publish_single_part(spark: SparkSession, folder: str, target: str, prefix: str = "part-") -> None:
    """Publish the one part file of ``folder`` as ``target``, drop ``folder``."""
    fs, src = _fs(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(src) if s.getPath().getName().startswith(prefix)]
    if len(parts) != 1:
        raise OutputWriteError(f"expected one part file in {folder}, found {len(parts)}")
    _replace(spark, str(parts[0].toString()), target)
    fs.delete(src, True)


def _one_after_another(df: DataFrame) -> DataFrame:
    """A sorted frame whose partitions one task writes in turn.  Aggregation
    and range exchange stay distributed; the task holds one range at a time."""
    return df.repartitionByRange(*result_order()).sortWithinPartitions(*result_order()).coalesce(1)


def _tab_writer(df: DataFrame):
    return (
        df.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
    )


def write_report(
    result: AttributionResult,
    out_dir: str,
    run_date: Optional[_dt.date] = None,
    layout: str = "file",
) -> str:
    """Write the three-column tab report in report order and return its path.

    ``layout="file"`` gives one file named ``YYYY-mm-dd_SearchKeywordPerformance.tab``,
    ``layout="folder"`` a folder of that name whose part files, in part order,
    hold the report in order.  Either replaces what is there.
    """
    if layout not in ("file", "folder"):
        raise ValueError(f"layout must be file or folder, not {layout!r}")
    spark = result.prepared.sparkSession
    target = f"{out_dir.rstrip('/')}/{report_name(run_date)}"
    staging = f"{target}.__staging"
    columns = ("search_engine_domain", "search_keyword", "revenue")
    headers = [F.col(c).alias(h) for c, h in zip(columns, REPORT_HEADERS, strict=True)]
    try:
        if layout == "file":
            _tab_writer(_one_after_another(result.results).select(*headers)).csv(staging)
            _publish_single_part(spark, staging, target)
        else:
            _tab_writer(result.results.orderBy(*result_order()).select(*headers)).csv(staging)
            _replace(spark, staging, target)
    except OutputWriteError:
        raise
    except Exception as e:  # noqa: BLE001
        raise OutputWriteError(f"Failed to write output to {target}: {e}") from e
    return target


def summary_rows(result: AttributionResult) -> DataFrame:
    """(domain, keyword, revenue text) of every result, in report order."""
    return result.results.orderBy(*result_order()).select(
        F.col("search_engine_domain").alias("domain"),
        F.col("search_keyword").alias("keyword"),
        money_text("revenue").alias("revenue"),
    )


def manifest(
    result: AttributionResult,
    input_file: str,
    started: Optional[float] = None,
    results_path: Optional[str] = None,
) -> dict:
    """The run manifest (S7) as a dict built from one-row aggregates; the
    complete result list is written beside it by :func:`write_manifest`."""
    o = result.options
    counts, quality = _counts_and_quality(result)
    return {
        "schema_version": OUTPUT_SCHEMA_VERSION,
        "input_file": input_file,
        "execution_timestamp_utc": _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "elapsed_seconds": round(time.monotonic() - started, 3) if started is not None else None,
        "rows_processed": counts["rows_processed"],
        "unique_visitors": counts["visitors_with_live_touch"],
        "keyword_groups": counts["keyword_groups"],
        "total_attributed_revenue": str(counts["total_attributed_revenue"]),
        "config": {
            "session_timeout": o.session_timeout,
            "order": o.order,
            "validate_schema": o.validate_schema,
            "skew_threshold": o.skew_threshold,
        },
        "data_quality": {
            k: (str(v.quantize(_dt_cents())) if k.startswith("total_revenue") else v)
            for k, v in quality.items()
        },
        "results_path": results_path,
    }


def _counts_and_quality(result: AttributionResult) -> tuple[dict, dict]:
    """Run counts and quality counters in one query (two one-row aggregates
    as JSON text in a union, so the plan is shared and nothing is joined)."""
    import json
    from decimal import Decimal

    def as_json(df, tag):
        return df.select(F.lit(tag).alias("t"), F.to_json(F.struct(*df.columns)).alias("j"))

    rows = as_json(result.run_counts, "c").unionByName(as_json(result.quality, "q")).collect()
    got = {r["t"]: json.loads(r["j"], parse_float=Decimal, parse_int=int) for r in rows}
    counts, quality = got["c"], got["q"]
    counts["total_attributed_revenue"] = Decimal(counts["total_attributed_revenue"])
    return counts, {k: (Decimal(v) if k.startswith("total_revenue") else v) for k, v in quality.items()}


def _dt_cents():
    from decimal import Decimal

    return Decimal("0.01")


def write_manifest(
    spark: SparkSession,
    doc: dict,
    out_dir: str,
    run_date: Optional[_dt.date] = None,
    result: Optional[AttributionResult] = None,
) -> str:
    """Write the manifest dict as one JSON file next to the report.

    With ``result`` the complete result list, one JSON object a line in report
    order, is written beside it and named as ``results_summary``, at any size.
    """
    import json

    d = (run_date or _dt.date.today()).strftime("%Y-%m-%d")
    base = f"{out_dir.rstrip('/')}/{d}"
    target = f"{base}{MANIFEST_SUFFIX}"
    staging = f"{target}.__staging"
    try:
        if result is not None:
            rows = _one_after_another(result.results).select(
                F.col("search_engine_domain").alias("domain"), F.col("search_keyword").alias("keyword"), money_text("revenue").alias("revenue")
            )
            rows.write.mode("overwrite").json(f"{base}{SUMMARY_SUFFIX}.__staging")
            _publish_single_part(spark, f"{base}{SUMMARY_SUFFIX}.__staging", f"{base}{SUMMARY_SUFFIX}")
            doc = {**doc, "results_summary": f"{d}{SUMMARY_SUFFIX}"}
        # a small driver-side document: written with the FileSystem client
        # (temp name, then rename), no Spark job
        text = json.dumps(doc, indent=2, default=str)
        fs, tmp = _fs(spark, staging)
        stream = fs.create(tmp, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        _replace(spark, staging, target)
    except OutputWriteError:
        raise
    except Exception as e:  # noqa: BLE001
        raise OutputWriteError(f"Failed to write metadata to {target}: {e}") from e
    return target


def write_results_partitioned(result: AttributionResult, out_dir: str, partitions: int = 0) -> str:
    """Large-result form: Parquet, range-partitioned in report order."""
    df = result.results
    ordered = df.repartitionByRange(partitions, *result_order()) if partitions else df.orderBy(*result_order())
    ordered.sortWithinPartitions(*result_order()).write.mode("overwrite").parquet(out_dir)
    return out_dir
