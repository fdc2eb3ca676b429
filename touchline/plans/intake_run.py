"""One intake run: pending files -> attribution -> report + manifest -> ledger."""

from __future__ import annotations

import datetime as _dt
import time
from typing import Optional

from pyspark.sql import SparkSession

from ..errors import DuplicateRunError
from ..options import AttributionOptions
from ..sources.hits import literal_path
from ..sources.intake import list_inputs, pending_inputs, read_ledger, record_processed
from .attribution import attribute_files
from .sinks import manifest, write_manifest, write_report


def run_pending(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    ledger_path: str,
    options: Optional[AttributionOptions] = None,
    run_date: Optional[_dt.date] = None,
    idempotent: bool = True,
    raise_if_nothing: bool = False,
) -> Optional[dict]:
    """Attribute every not-yet-processed file under ``input_dir`` as one run.

    Returns the manifest, or ``None`` when nothing is pending (or raises
    :class:`DuplicateRunError` with ``raise_if_nothing``).  The file list is
    metadata (one row per file), so bringing the paths to the driver is bounded
    by the number of files, not their size.
    """
    started = time.monotonic()
    pending = pending_inputs(list_inputs(spark, input_dir), read_ledger(spark, ledger_path), idempotent)
    rows = pending.select("input_key", "content_tag", "path").collect()
    if not rows:
        if raise_if_nothing:
            raise DuplicateRunError(f"all inputs under {input_dir} were already processed")
        return None
    paths = sorted(literal_path(r["path"]) for r in rows)
    result = attribute_files(spark, paths, options).materialize()
    report = write_report(result, out_dir, run_date)
    doc = manifest(result, ",".join(sorted(r["path"] for r in rows)), started, results_path=report)
    write_manifest(spark, doc, out_dir, run_date, result)
    done = spark.createDataFrame([(r["input_key"], r["content_tag"]) for r in rows],
                                 "input_key string, content_tag string")
    record_processed(done, ledger_path, report)
    return doc
