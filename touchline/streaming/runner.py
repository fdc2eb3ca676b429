"""Running the streaming forms: file streams into a Parquet sink."""

from __future__ import annotations

import re
from typing import Callable, Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..errors import CheckpointError
from ..functions import to_cents
from ..operators.aggregate import keyword_revenue
from ..operators.touch import order_struct
from ..options import AttributionOptions
from ..session import scratch_path
from ..sources.events import derive_hits
from .stateful import as_attributed, output_schema, stream_last_touch


def events_stream(spark: SparkSession, sf_dir: str, max_files: Optional[int] = None) -> DataFrame:
    """Streaming raw hits over ``events*.parquet`` files of ``sf_dir``."""
    pattern = f"{sf_dir.rstrip('/')}/events*.parquet"
    schema = spark.read.parquet(pattern).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return derive_hits(reader.parquet(pattern))


def run_to_parquet(stream: DataFrame, root: str, available_now: bool = True):
    """Start ``stream`` into ``root/out`` with its checkpoint in ``root/chk``."""
    w = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/chk")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def stream_attributed(
    spark: SparkSession,
    sf_dir: str,
    options: Optional[AttributionOptions] = None,
    root: Optional[str] = None,
    max_files: Optional[int] = None,
    emit_all: bool = False,
    idle_limit: Optional[int] = None,
) -> DataFrame:
    """Run the stateful stream to completion (available-now) and read the sink."""
    root = root or scratch_path(spark, "stream")
    hits = stream_last_touch(events_stream(spark, sf_dir, max_files), options, emit_all=emit_all, idle_limit=idle_limit)
    q = run_to_parquet(hits, root)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(f"{root}/out")


def running_keyword_revenue(
    spark: SparkSession,
    sf_dir: str,
    options: Optional[AttributionOptions] = None,
    root: Optional[str] = None,
) -> DataFrame:
    """Keyword revenue over everything the stream has produced so far."""
    options = options or AttributionOptions()
    out = stream_attributed(spark, sf_dir, options, root)
    return keyword_revenue(as_attributed(out), options).drop("keyword_lower")


#: the key of a keyword group
GROUP = ("search_engine_domain", "keyword_lower")


def keyword_parts(rows: DataFrame, options: AttributionOptions) -> DataFrame:
    """What each row of the stateful stream adds to its keyword group: ``seen``,
    its place and casing (search hits), and ``credit`` (attributed purchases)."""
    is_attr = F.col("is_purchase") & (F.col("revenue") > 0) & F.col("live_touch").isNotNull()
    key = F.when(F.col("touch").isNotNull(), F.col("touch")).otherwise(F.col("live_touch"))
    seen = F.struct(order_struct(options.order).alias("at"), F.col("touch.keyword").alias("kw"))
    return as_attributed(rows).filter(F.col("touch").isNotNull() | is_attr).select(
        key["domain"].alias("search_engine_domain"),
        F.lower(key["keyword"]).alias("keyword_lower"),
        F.when(F.col("touch").isNotNull(), seen).alias("seen"),
        F.when(is_attr, F.col("revenue")).alias("credit"),
    )


def group_totals() -> list[Column]:
    """Totals of a keyword group, from its parts or from earlier totals."""
    return [F.sum("credit").alias("credit"), F.min("seen").alias("seen")]


def totals_report(totals: DataFrame) -> DataFrame:
    """Totals as the keyword report: the groups that hold revenue."""
    return totals.filter(F.col("credit").isNotNull()).select(
        "search_engine_domain", F.col("seen.kw").alias("search_keyword"), "keyword_lower", to_cents("credit").alias("revenue")
    )


def chained_totals(hits: DataFrame, options: Optional[AttributionOptions] = None) -> DataFrame:
    """Running totals as a streaming aggregation behind the visitor state.

    ``hits`` is a stream from :func:`stream_last_touch`.  Its totals live in a
    second state store of the same query, so credit and visitor state are always
    of the same batch.  In update mode a batch brings each group that it
    changed, with its totals so far.
    """
    return keyword_parts(hits, options or AttributionOptions()).groupBy(*GROUP).agg(*group_totals())


def write_changes(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: the changed groups of batch n under ``path/batch=n``,
    which a replay of the batch writes again."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _write


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the last batch: each group as the last batch that changed it left it."""
    last = F.max_by(F.struct("credit", "seen"), "batch").alias("last")
    return spark.read.parquet(path).groupBy(*GROUP).agg(last).select(*GROUP, "last.*")


def stream_chained_totals(
    spark: SparkSession,
    sf_dir: str,
    options: Optional[AttributionOptions] = None,
    root: Optional[str] = None,
    max_files: Optional[int] = 1,
) -> DataFrame:
    """Run visitor state and totals as one streaming query and read the report."""
    options = options or AttributionOptions()
    root = root or scratch_path(spark, "chained")
    q = (
        chained_totals(stream_last_touch(events_stream(spark, sf_dir, max_files), options), options)
        .writeStream.foreachBatch(write_changes(f"{root}/changes"))
        .option("checkpointLocation", f"{root}/chk")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return totals_report(read_changes(spark, f"{root}/changes"))


def merge_totals(totals_path: str, options: Optional[AttributionOptions] = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink keeping running totals per keyword group.

    Each micro-batch's attributed revenue and display candidates are merged
    with the stored totals: sums add, the earliest display candidate in the
    processing order wins.  A version folder is written per batch id, so a
    replayed batch rewrites the same version; a missing predecessor is an
    error, and versions before it are removed.
    """
    opts = options or AttributionOptions()

    def _merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = keyword_parts(batch, opts)
        if batch_id > 0:
            previous = f"{totals_path}/v={batch_id - 1}"
            if not _exists(spark, previous):
                raise CheckpointError(f"running totals: {previous} is missing, batch {batch_id} can't be added")
            part = part.unionByName(spark.read.parquet(previous))
        merged = part.groupBy(*GROUP).agg(*group_totals())
        merged.write.mode("overwrite").parquet(f"{totals_path}/v={batch_id}")
        _remove(spark, f"{totals_path}/v={batch_id - 2}")

    return _merge


def read_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """The running totals after the last merged batch, as the keyword report."""
    fs, path = _file_system(spark, totals_path)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    versions = [int(n[2:]) for n in names if n.startswith("v=")]
    if not versions:
        raise CheckpointError(f"no running totals in {totals_path}")
    return totals_report(spark.read.parquet(f"{totals_path}/v={max(versions)}"))


def stream_running_totals(
    spark: SparkSession,
    sf_dir: str,
    options: Optional[AttributionOptions] = None,
    max_files: Optional[int] = 1,
) -> DataFrame:
    """Run the stateful stream into running totals and read them."""
    options = options or AttributionOptions()
    root = scratch_path(spark, "totals")
    q = (
        stream_last_touch(events_stream(spark, sf_dir, max_files), options)
        .writeStream.foreachBatch(merge_totals(f"{root}/totals", options))
        .option("checkpointLocation", f"{root}/chk")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_totals(spark, f"{root}/totals")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def live_touches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """ip, user_agent, domain, keyword: the live touch of every visitor that has
    one, after the last batch of the stream whose checkpoint this is.  Reads the
    state store, so the stream may be running, stopped or in another process."""
    state = _state(spark, checkpoint, "touch")
    return state.select("key.ip", "key.user_agent", "value.domain", "value.keyword")


def known_visitors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """ip, user_agent, last_time: every visitor that the stream holds state of."""
    return _state(spark, checkpoint, "last_time").select("key.ip", "key.user_agent", F.col("value.t").alias("last_time"))


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


class CounterTable(StreamingQueryListener):
    """Writes the live counters of every micro-batch to a table.

    ``path/query=<id>/batch=<id>`` holds the counters observed under ``name``.  A
    query keeps its id over restarts and a batch that is run again replaces its
    own row, so the sums count nothing twice.  Add it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "hits"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None:
            return
        counts = {k: int(v or 0) for k, v in seen.asDict().items()}
        row = self.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={progress.id}/batch={progress.batchId}")

    def onQueryTerminated(self, event) -> None:
        pass


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all batches so far, one row a query."""
    rows = spark.read.parquet(path)
    return rows.groupBy("query").agg(F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in rows.columns if c not in ("query", "batch")])


def attribute_each_batch(
    input_dir: str,
    out_dir: str,
    ledger_path: str,
    options: Optional[AttributionOptions] = None,
    run_date=None,
    max_files: int = 1,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: list the uploads, run those that the ledger hasn't.

    The ledger holds (path, content tag), so a file that was written anew is run
    once more and an untouched one is not.  Like a per-upload job each run of up
    to ``max_files`` files, oldest first, starts from empty visitor state.  Outputs go to
    ``out_dir/batch=<n>/`` for the n-th recorded run, and a run is recorded after
    its outputs are written: what fails before is run again into the same folder.
    """
    from ..plans.attribution import attribute_files
    from ..plans.sinks import manifest, write_manifest, write_report
    from ..sources.hits import literal_path
    from ..sources.intake import list_inputs, pending_inputs, read_ledger, record_processed

    def _run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        while True:
            ledger = read_ledger(spark, ledger_path)
            # at most max_files rows come to the driver
            files = pending_inputs(list_inputs(spark, input_dir), ledger).orderBy("modified", "path").limit(max_files).collect()
            if not files:
                return
            done = ledger.select("output_path").distinct().count()
            folder = f"{out_dir.rstrip('/')}/batch={done}"
            paths = sorted(r["path"] for r in files)
            result = attribute_files(spark, [literal_path(f) for f in paths], options).materialize()
            report = write_report(result, folder, run_date)
            doc = manifest(result, ",".join(paths), results_path=report)
            write_manifest(spark, doc, folder, run_date, result)
            seen = [(r["input_key"], r["content_tag"]) for r in files]
            record_processed(spark.createDataFrame(seen, "input_key string, content_tag string"), ledger_path, report)

    return _run


def continuous_intake(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    checkpoint: Optional[str] = None,
    options: Optional[AttributionOptions] = None,
    available_now: bool = True,
    run_date=None,
    max_files: int = 1,
):
    """Process each upload once, and again when its content changes.

    A file stream remembers paths only, so the stream is a heartbeat and every
    beat lists the folder and asks the ledger (``<checkpoint>/ledger``, by default
    under the shared checkpoint root), which also survives a restart.
    """
    checkpoint = (checkpoint or scratch_path(spark, "intake")).rstrip("/")
    beats = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    w = beats.writeStream.foreachBatch(
        attribute_each_batch(input_dir, out_dir, f"{checkpoint}/ledger", options, run_date, max_files)
    ).option("checkpointLocation", f"{checkpoint}/beats")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


#: hits of a landed file at most, so that parsing them is spread over all cores
LANDED_HITS = 100_000


def land_hit_files(
    spark: SparkSession,
    input_dir: str,
    root: str,
    options: Optional[AttributionOptions] = None,
    max_files: int = 1000,
    by_name: bool = False,
) -> int:
    """Bring the oldest ``max_files`` new hit files (or the first by name) into
    the table ``root/hits``; how many there were.

    Each file is read by its own header and in splits, and its hits get the arrival
    key ``seq`` (file number, split start, place): files are numbered as they are
    landed, so a later file's hits come after all of an earlier one's.  The ledger
    ``root/landed`` names each path once: visitor state can't be taken back, so a
    file that is written anew isn't landed again.  A run that fails before it is
    recorded is written again into the same folder.
    """
    from ..sources.hits import literal_path, read_hits
    from ..sources.intake import list_inputs, read_ledger, record_processed

    opts = options or AttributionOptions()
    ledger = read_ledger(spark, f"{root}/landed")
    new = list_inputs(spark, input_dir).join(ledger.select("input_key"), "input_key", "left_anti")
    order = ["path"] if by_name else ["modified", "path"]
    # at most max_files rows come to the driver
    files = [(r["path"], r["content_tag"]) for r in new.orderBy(*order).limit(max_files).collect()]
    if not files:
        return 0
    known = ledger.agg(F.count("*").alias("files"), F.count_distinct("output_path").alias("runs")).first()
    numbers = spark.createDataFrame([(re.sub("^file:/+", "file:/", p), known["files"] + i) for i, (p, _) in enumerate(files)], "path string, number long")
    hits = read_hits(spark, [literal_path(p) for p, _ in files], opts.validate_schema)
    # max_files bounds this side, so hits stay in the tasks that read them
    numbered = hits.join(F.broadcast(numbers), _plain(F.col("seq.file")) == F.col("path"))
    seq = F.struct(F.col("number").alias("file"), F.col("seq.start").alias("start"), F.col("seq.pos").alias("pos"))
    folder = f"{root}/hits/run={known['runs']}"
    landed = numbered.select(*[c for c in hits.columns if c != "seq"], seq.alias("seq"))
    # the stream reads a landed file in one task
    landed.write.mode("overwrite").option("maxRecordsPerFile", LANDED_HITS).parquet(folder)
    record_processed(spark.createDataFrame(files, "input_key string, content_tag string"), f"{root}/landed", folder)
    return len(files)


def _plain(uri: Column) -> Column:
    """The path, as a listing has it, that the URI of a row's file stands for."""
    return F.regexp_replace(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def stream_hit_files(
    spark: SparkSession,
    input_dir: str,
    root: Optional[str] = None,
    options: Optional[AttributionOptions] = None,
    max_files: int = 1000,
    by_name: bool = False,
    idle_limit: Optional[int] = None,
) -> DataFrame:
    """Attribute hit files as they arrive, with visitor state kept between files.

    Lands the new files of ``input_dir`` up to ``max_files`` at a time and runs the
    stateful stream over each landed run as one micro-batch; returns its rows
    so far (see :func:`stream_last_touch`).  Call it again, in this or another
    process, for files that came since: a touch of one file is credited with a
    purchase of a later one.
    """
    root = (root or scratch_path(spark, "hitstream")).rstrip("/")
    options = options or AttributionOptions()
    landed = land_hit_files(spark, input_dir, root, options, max_files, by_name)
    while True:
        if _exists(spark, f"{root}/hits"):
            # also what an earlier call landed and did not get to
            schema = spark.read.parquet(f"{root}/hits").drop("run").schema
            raw = spark.readStream.schema(schema).parquet(f"{root}/hits/run=*")
            q = run_to_parquet(stream_last_touch(raw, options, idle_limit=idle_limit), root)
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        if not landed:
            break
        landed = land_hit_files(spark, input_dir, root, options, max_files, by_name)
    if not _exists(spark, f"{root}/hits"):
        return spark.createDataFrame([], output_schema(["seq_file", "seq_start", "seq_pos"]))
    return spark.read.parquet(f"{root}/out")
