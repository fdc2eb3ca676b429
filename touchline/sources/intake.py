"""Idempotent intake (S8, J4): process each (input key, content tag) once.

Candidates come from a file listing (``binaryFile`` source; the content column
is read only when a content hash is asked for).  The ledger is a Parquet table
in shared storage; candidates already in it are removed with a ``left_anti``
join, and entries are appended only after the outputs were written.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url_decode

LEDGER_SCHEMA = "input_key string, content_tag string, processed_at timestamp, output_path string"


def list_inputs(
    spark: SparkSession,
    location: str,
    glob: Optional[str] = None,
    content_hash: bool = False,
) -> DataFrame:
    """(input_key, content_tag, size, path, modified) per file under ``location``.

    ``input_key`` is the path as listed; a listing's names are not encoded (keys
    that come from upload events are, see :func:`event_key`).  ``content_tag`` is size plus
    modification time, or the SHA-256 of the bytes when ``content_hash`` is set
    (reads every byte; only for files under the 2 GB binary-file limit).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(location)
    if content_hash:
        tag = F.sha2(F.col("content"), 256)
    else:
        tag = F.concat_ws(
            "-", F.col("length").cast("string"), F.unix_millis(F.col("modificationTime")).cast("string")
        )
    return files.select(
        F.col("path").alias("input_key"),
        tag.alias("content_tag"),
        F.col("length").alias("size"),
        F.col("path").alias("path"),
        F.col("modificationTime").alias("modified"),
    )


def event_key(key) -> Column:
    """The object key of an upload event, which encodes it."""
    return url_decode(key)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(ledger_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def pending_inputs(candidates: DataFrame, ledger: DataFrame, enabled: bool = True) -> DataFrame:
    """Candidates whose (key, tag) is not yet in the ledger (left anti join)."""
    if not enabled:
        return candidates
    seen = ledger.select("input_key", "content_tag")
    return candidates.join(seen, ["input_key", "content_tag"], "left_anti")


def record_processed(processed: DataFrame, ledger_path: str, output_path: str) -> None:
    """Append ledger entries for inputs whose outputs were written."""
    processed.select(
        "input_key",
        "content_tag",
        F.current_timestamp().alias("processed_at"),
        F.lit(output_path).alias("output_path"),
    ).write.mode("append").parquet(ledger_path)
