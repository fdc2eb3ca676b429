"""Hit-file scan (S1-S5): tab-separated text with a header, all columns text.

Every reader returns the *raw hits* frame: the six required hit columns as
STRING (NULL allowed) and ``seq``, the arrival order key (orderable; never
re-derived later).

Each file is read by its own header.  One small job brings every file's first
line; files with the same columns are scanned together and the groups are
joined by column name, so files may order their columns differently.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InputSchemaError, StorageIOError
from ..options import REQUIRED_COLUMNS

HIT_COLUMNS = REQUIRED_COLUMNS


def column_names(header: str) -> list[str]:
    """The columns that a header line names, stripped and in lower case."""
    fields = next(csv.reader([header.removeprefix("﻿")], delimiter="\t"), [])
    return [f.strip().lower() for f in fields]


def require_columns(found: dict[str, list[str]], required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Refuse files (path -> columns) that lack a required column or a header;
    the error names the first of them, what it lacks and how many there are."""
    lacking = {path: [c for c in required if c not in names] for path, names in found.items()}
    bad = sorted(path for path, gone in lacking.items() if gone)
    if not bad:
        return
    path, more = bad[0], f" ({len(bad) - 1} more files are refused)" if len(bad) > 1 else ""
    if not any(found[path]):
        raise InputSchemaError(f"{path}: no header line{more}")
    raise InputSchemaError(f"{path}: no column {', '.join(lacking[path])}; its header names {', '.join(found[path])}{more}")


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Columns of every input file, from a distributed read of first lines.

    Each file is one partition there, and its task stops after the first line,
    so the job reads the start of every file and no more.  Files that didn't
    answer (empty ones, or all but the first of a partition where a session packs
    files all the same) are read again, whole.  The answer has one row a file, as
    the file listing has.
    """
    own = spark.newSession()
    for key in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
        own.conf.set(key, str(1 << 40))
    lines = _placed_lines(own, paths)
    found = {plain_path(f): f for f in lines.inputFiles()}
    lead = _lines_at_start(lines, stop=True)
    silent = [plain for plain in found if plain not in lead]
    if silent:
        lead |= _lines_at_start(_placed_lines(own, list(map(literal_path, silent))), stop=False)
    return {plain: column_names(lead[plain]) if plain in lead else [] for plain in found}


def _placed_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _lines_at_start(lines: DataFrame, stop: bool) -> dict[str, str]:
    """The first line of files by plain path; with ``stop`` a task reads no further
    than the first line of its first file."""

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            places = list(zip(batch.column(0).to_pylist()[: 1 if stop else None], batch.column(1).to_pylist(), strict=False))
            new = [i for i, place in enumerate(places) if place != (places[i - 1] if i else last)]
            if new:
                yield batch.take(pa.array(new))
                if stop:
                    return
            last = places[-1] if places else last

    got = lines.mapInArrow(first_lines, lines.schema).where("start = 0").select("file", "value").collect()
    return {plain_path(r["file"]): r["value"] for r in got}


def plain_path(uri: str) -> str:
    """The path that a listed file's (percent-encoded) URI stands for."""
    return re.sub("^file:/+", "file:/", unquote(uri))


GLOB = str.maketrans({c: f"\\{c}" for c in "\\{}[]*?"})


def literal_path(path: str) -> str:
    """A path whose glob characters mean themselves."""
    return path.translate(GLOB)


def scan(spark: SparkSession, paths: Sequence[str], names: Sequence[str], multiline: bool = False) -> DataFrame:
    """Rows of files that share the columns ``names``, without their headers."""
    kept = [n if n and n not in names[:i] else f"_column_{i}" for i, n in enumerate(names)]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in kept)
    rows = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(list(paths))
    )
    meta = F.col("_metadata")
    return rows.select(
        *[F.col(c) if c in kept else F.lit("").alias(c) for c in HIT_COLUMNS],
        meta["file_path"].alias("_file"),
        meta["file_block_start"].alias("_start"),
    )


def read_hits(
    spark: SparkSession,
    paths: str | Sequence[str],
    validate_schema: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Scan one or more hit files (plain, ``.gz`` or ``.zst``), prefixes or globs.

    Quoting is ``"`` with doubled quotes inside fields.  No type inference.
    With ``validate_schema`` every file must name the required columns (S4);
    without it a column that a file doesn't name reads as ``''`` and a file
    without a header has no hits.  The arrival order of a row is (file path,
    split start, position in split), which stays right across many files and
    many splits of one file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        found = file_headers(spark, paths)
    except AnalysisException as e:
        raise StorageIOError(f"cannot read hit files {paths}: {e}") from e
    if validate_schema:
        require_columns(found)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in sorted(found.items()):
        if names:
            groups.setdefault(tuple(names), []).append(path)
    if not groups:
        if validate_schema:
            raise InputSchemaError(f"{', '.join(paths)}: no header line")
        schema = ", ".join(f"{c} string" for c in HIT_COLUMNS)
        return spark.createDataFrame([], f"{schema}, seq struct<file: string, start: long, pos: long>")
    # all files alike: the paths as given, so that Spark lists them, not we
    scans = [scan(spark, paths if len(groups) == 1 else list(map(literal_path, files)), names, multiline) for names, files in groups.items()]
    rows = scans[0]
    for other in scans[1:]:
        rows = rows.unionByName(other)
    seq = F.struct(F.col("_file").alias("file"), F.col("_start").alias("start"), F.monotonically_increasing_id().alias("pos"))
    return rows.select(*HIT_COLUMNS, seq.alias("seq"))


def spread_input(df: DataFrame) -> DataFrame:
    """Round-robin repartition of a raw scan that gives fewer tasks than cores.

    A compressed file (``.gz`` / ``.zst`` never split) or a small file is read
    by one task; the per-hit parsing that follows is CPU bound.  The number of
    tasks is estimated from the files and their size, without running anything.
    Arrival order is already a column (``seq``), so nothing depends on the
    placement, and round robin keeps a hot visitor from landing in one task.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    split = any(not f.endswith((".gz", ".zst")) for f in files)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) if split else 0
    widest = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df if max(len(files), size // widest) >= target else df.repartition(target)
