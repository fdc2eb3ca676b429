"""Helpers shared by the training-data operators.

Text work in Python runs on Arrow batches (``mapInArrow``): the UTF-8 bytes of
a whole batch are one numpy array, so words, word hashes and n-gram hashes of
thousands of documents are found by a handful of vector operations.  Batches
are cut into chunks of bounded size first, always between documents.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import checkpoint_root, checkpoint_table

CHUNK_BYTES = 2 << 20

#: separators of ``[^\x20\x09-\x0D]+``
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def by_value(module_name: str) -> None:
    """Send the functions of a module to Python workers by value, so that the
    executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and
    read again: later jobs neither recompute it nor depend on one executor."""
    checkpoint_root(df.sparkSession)
    return checkpoint_table(df, name)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_body(docs: DataFrame) -> DataFrame:
    """doc_id, body (a hash of the text, which tells rows with one id apart), text."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))


def same_document(left: DataFrame, right: DataFrame):
    """Join condition on doc_id and body; a null doc_id equals another."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["body"] == right["body"])


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values."""
    start = (seed * 0xD1342543DE82EF95) & _M64
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start))


_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n, kept per process and grown by doubling."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, np.uint64(base & _M64))
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Record batches cut between rows to about ``limit`` bytes of text, with
    the text bytes and the row offsets (first 0).  One longer text is a chunk
    of its own.  Null texts count as empty."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if col.null_count:
            col = col.fill_null("")
        col = col.cast(pa.large_string())
        if not len(col):
            continue
        offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), len(col))
            yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to


def spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row number of each maximal run of ``inside`` bytes that
    stays within one row."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    full = offs[:-1] < offs[1:]
    first, last = offs[:-1][full], offs[1:][full] - 1
    start[first] = inside[first]
    end[last] = inside[last]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offs, s, side="right") - 1


def word_spans(data: np.ndarray, offs: np.ndarray):
    return spans(data, offs, ~SPACE[data])


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial in random byte
    values, from prefix sums, then scrambled."""
    n = len(data)
    if not len(s):
        return np.zeros(0, np.uint64)
    values = seeded(256, 11)[data]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power_table("up", _BASE, n), dtype=np.uint64, out=total[1:])
    h = (total[e] - total[s]) * _power_table("down", _BASE_INVERSE, n + 1)[s]
    return mix(h + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def gram_hashes(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of k consecutive values (one less than k shorter)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    keys = seeded(k, seed) | np.uint64(1)
    out = h[:n] * keys[0]
    for j in range(1, k):
        out += h[j : j + n] * keys[j]
    return mix(out)


FILTER_BITS = 25


def filter_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a Bloom filter for each (well mixed) 64-bit value."""
    values = values.view(np.uint64)
    return (values >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (values & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def filter_of(values: DataFrame):
    """A broadcast Bloom filter of a column ``value`` of well mixed longs.

    It has ``2**FILTER_BITS`` bits whatever the number of values, and at most
    ``2**FILTER_BITS / 64`` rows come to the driver.  A filter fuller than
    intended lets more rows through; what it lets through is joined exactly.
    """
    low = F.expr(f"value & {(1 << FILTER_BITS) - 1}L")
    high = F.shiftrightunsigned("value", 64 - FILTER_BITS)
    bit = values.select(F.explode(F.array(low, high)).alias("bit"))
    words = bit.groupBy(F.floor(F.col("bit") / 64).cast("long").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")
    )
    got = words.toArrow()
    out = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return values.sparkSession.sparkContext.broadcast(out)


def filter_bits(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def connected(edges: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id of its component, of every end of
    an edge (a, b).

    Large-star and small-star steps alternate until the edges stay the same:
    each replaces edges by edges to the smallest neighbour.  All steps are
    joins and grouped minima over edge rows; every round is stored.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(below.select("a", F.col("m").alias("b")))
        now = stored(small.where("a <> b").distinct(), "edges")
        sums = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(sums) == state:
            break
        state = tuple(sums)
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionAll(roots.select("id", F.col("id").alias("label")))
