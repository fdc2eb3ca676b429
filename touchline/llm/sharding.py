"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass 1 scatters the records uniformly into buckets of bounded size with a
seeded hash.  Pass 2 holds one bucket at a time in memory, permutes it with
Spark's ``shuffle`` function (a seeded Fisher-Yates shuffle of an array) and
writes it.  The bucket order followed by the place in the bucket is then a
gapless random position, and position modulo the shard count gives shards
whose row counts differ by one at most (the ``rows`` law).

The scatter hashes the seed and the number of the record in its input, never
its content, so a key, a source or a group of copies that holds a third of the
rows is spread like any other record.  The shuffled buckets are stored in the
shared checkpoint folder before positions are dealt, so a lost executor can't
mix two different permutations.

Defined cases: an empty table gives no rows; null fields are kept as they are;
repeated rows are shuffled as separate records; a record larger than a bucket
makes its bucket that large; records are carried and written as one struct, so
their columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_parts, stored

BUCKET_BYTES = 16 << 20
#: up to this many buckets (16 bytes each) their bases are broadcast
BROADCAST_BUCKETS = 1_000_000
#: buckets whose sizes are summed up together first
SPAN = 4096


def record_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(16)


def shuffle_records(df: DataFrame, size, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``df`` (a stored table) as the struct ``record``, with
    ``position``: 0 to n - 1 in random order."""
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"),
        size.alias("bytes"),
        F.monotonically_increasing_id().alias("number"),
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scattered = rows.select(
        F.pmod(F.xxhash64(F.lit(seed), F.col("number")), F.lit(buckets)).cast("long").alias("bucket"),
        F.struct("number", "record").alias("numbered"),
    ).repartition(max(buckets, shuffle_parts(df.sparkSession)), "bucket")
    permuted = scattered.groupBy("bucket").agg(F.shuffle(F.sort_array(F.collect_list("numbered")), seed).alias("all"))
    written = stored(
        permuted.select("bucket", F.posexplode("all").alias("place", "numbered")).select("bucket", "place", "numbered.record"),
        "shuffled",
    )
    base = bases(written)
    if buckets <= BROADCAST_BUCKETS:
        base = F.broadcast(base)
    return written.join(base, "bucket").select("record", (F.col("base") + F.col("place")).alias("position"))


def bases(written: DataFrame) -> DataFrame:
    """bucket, base: the records in the buckets before it.  Sums of ``SPAN`` buckets
    each are added up first, so no task meets all buckets."""
    counts = written.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("span", F.floor(F.col("bucket") / SPAN))

    def before(order: str, *within: str):
        window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    spans = counts.groupBy("span").agg(F.sum("n").alias("n")).select("span", before("span").alias("start"))
    return counts.join(spans, "span").select("bucket", (F.col("start") + before("bucket", "span")).alias("base"))


def deal(shuffled: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``slot`` (gapless from 0) of each shuffled record."""
    return shuffled.select(
        "record",
        F.pmod(F.col("position"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder a shard; its rows are a ``slot`` and a ``record``, in slot order."""
    dealt.repartition("shard").sortWithinPartitions("shard", "slot").select("slot", "record", "shard").write.partitionBy("shard").parquet(path)


def op9_external_shuffle(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the ``rows`` law."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    dealt = deal(shuffle_records(docs, record_size()), 40)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return dealt.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(16)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
