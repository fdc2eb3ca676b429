"""Phrase collocations from an FM-index per shard.

A shard is about ``SHARD`` words of one language: its word ids, every piece
followed by a separator.  Its index is bidirectional: the Burrows-Wheeler
transform of the ids and that of the reversed ids, by suffixes sorted on their
first ``DEPTH`` words.  A phrase is an interval in both.  Extending it to the left by
a word is a step through the first transform (last-to-first mapping); how many
smaller words precede the phrase moves its interval in the second, where the
separators in the interval are the occurrences that can't be extended to the
right, as those in the first can't be extended to the left.  All intervals of
one length are extended at once by numpy.

Shards are summed length by length, first by a hash of the phrase.  A phrase can
only be as frequent as the phrases it holds, so the next pass extends a phrase
only by what was frequent over all shards.  A last pass sums the text of what was
frequent by hash.  Hashes reach the shards as broadcast Bloom filters of fixed
size; what they or a collision let through by mistake is counted by its text and
dropped, so results are exact.

A candidate is scored at each of its cuts by its count against those of both
sides, and dropped if a longer candidate that holds it is nearly as frequent.
All counts and products are exact integers.

Defined cases: a null text is empty, a null lang is ``und``; a text without words
gives nothing; repeated rows count again; a very long text is one shard; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import scratch_path

from .common import LOWER, by_value, chunks, filter_of, filter_places, mix, spans, stored, table, text_or_empty, word_hashes

by_value(__name__)

DEPTH = 4
LEAST = 30
TOP = 2000
#: percent of a phrase's count at which a longer one replaces it
REPLACES = 80
SCALE = 2_000_000
#: words of a shard
SHARD = 1 << 19

BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(10, 14)]] = True
BLANK = BREAK.copy()
BLANK[[9, 32]] = True

INDEX = "lang string, size long, words array<string>, counts binary, bwt binary, rbwt binary"
NAMES = ["lang", "size", "words", "counts", "bwt", "rbwt"]
TYPES = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
FOUND = "lang string, phrase string, f long, starts long, ends long"
FOUND_NAMES = ["lang", "phrase", "f", "starts", "ends"]
#: bits of a phrase's hash that are summed; fewer make fewer bytes to shuffle
HASH_BITS = 32


def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the next ``depth`` (a power of two) ids; the ids end
    with a separator, the smallest id, beyond which there are only separators."""
    rank, reach = ids.astype(np.int64), 1
    while True:
        after = np.zeros_like(rank)
        after[:-reach] = rank[reach:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        reach *= 2
        if reach >= depth:
            return order
        sorted_key = key[order]
        new = np.empty(len(key), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The id before each suffix, in suffix order."""
    order = suffix_order(ids, depth)
    return ids[order - 1].astype(np.int32)


def shard_row(lang: str, texts: list[np.ndarray]) -> list:
    """The index of the words of some texts (bytes, starts and ends of the words,
    which of them begin a piece)."""
    data = np.concatenate([t[0] for t in texts])
    shift = np.cumsum([0, *[len(t[0]) for t in texts[:-1]]])
    s = np.concatenate([t[1] + d for t, d in zip(texts, shift, strict=True)])
    e = np.concatenate([t[2] + d for t, d in zip(texts, shift, strict=True)])
    new_piece = np.concatenate([t[3] for t in texts])
    flat, ends = data[~BLANK[data]], np.cumsum(e - s)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(flat)).dictionary_encode()
    words, word = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
    # 0 is the separator, which stands before each piece and at the end
    at = np.arange(len(word)) + np.cumsum(new_piece)
    ids = np.zeros(len(word) + int(new_piece.sum()) + 1, np.int64)
    ids[at] = word + 1
    counts = np.bincount(ids, minlength=len(words) + 1)
    backward = ids[::-1].copy()
    return [lang, len(word), words, counts.astype(np.int64).tobytes(), transform(ids, DEPTH).tobytes(), transform(backward, DEPTH).tobytes()]


def shards(docs: DataFrame, size: int = SHARD) -> DataFrame:
    """The index rows of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        filled: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            del filled[lang]
            row = shard_row(lang, held.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, TYPES, strict=True)], names=NAMES)

        for batch, data, offs in chunks(batches, "text"):
            data = LOWER[data]
            s, e, row = spans(data, offs, ~BLANK[data])
            breaks = np.cumsum(BREAK[data])
            piece = np.zeros(0, np.int64) if not len(s) else breaks[s]
            fresh = np.ones(len(s), bool)
            fresh[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
            edges = np.searchsorted(row, np.arange(len(batch) + 1))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                a, b = edges[i], edges[i + 1]
                if a == b:
                    continue
                start, end = s[a], e[b - 1]
                held.setdefault(lang, []).append((data[start:end].copy(), s[a:b] - start, e[a:b] - start, fresh[a:b]))
                filled[lang] = filled.get(lang, 0) + int(b - a)
                if filled[lang] >= size:
                    yield flush(lang)
                elif sum(filled.values()) >= 2 * size:
                    yield flush(max(filled, key=filled.get))
        for lang in list(held):
            yield flush(lang)

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text")).mapInArrow(run, INDEX)


class Index:
    """The index of one shard, read from its row."""

    def __init__(self, lang: str, words: pa.Array, counts: bytes, bwt: bytes, rbwt: bytes):
        counts = np.frombuffer(counts, np.int64)
        self.bwt = np.frombuffer(bwt, np.int32)
        self.first = np.cumsum(counts) - counts
        # last-to-first mapping and the first id of every suffix
        self.lf = np.empty(len(self.bwt), np.int64)
        self.lf[np.argsort(self.bwt, kind="stable")] = np.arange(len(self.bwt))
        self.head = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.stops = np.concatenate([[0], np.cumsum(np.frombuffer(rbwt, np.int32) == 0)])
        named = pa.concat_arrays([pa.array([lang], pa.string()), words.cast(pa.string())])
        offs = np.frombuffer(named.buffers()[1], np.int32)[: len(named) + 1]
        self.hashes = word_hashes(np.frombuffer(named.buffers()[2], np.uint8), offs[:-1], offs[1:])
        self.lang = self.hashes[:1]
        self.phrases = named

    def singles(self) -> dict:
        """Intervals of all words: lo and rlo in either index, size, the word ids."""
        ids = np.arange(1, len(self.first))
        size = np.diff(np.append(self.first, len(self.bwt)))[1:]
        return {"lo": self.first[1:], "rlo": self.first[1:], "size": size, "ids": ids[:, None]}

    def extended(self, live: dict) -> dict:
        """All extensions to the left by one word of the given phrases, of
        which the phrase less its last word is given too."""
        lo, size = live["lo"], live["size"]
        total = int(size.sum())
        owner = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
        mark = np.full(len(self.bwt), -1, np.int32)
        mark[self.lf[rows]] = owner
        before = self.bwt[rows]
        none = np.bincount(owner[before == 0], minlength=len(lo))
        mark[: self.first[1]] = -1
        at = np.flatnonzero(mark >= 0)
        if not len(at):
            return {"lo": at, "rlo": at, "size": at, "ids": np.zeros((0, live["ids"].shape[1] + 1), np.int64)}
        new = np.ones(len(at), bool)
        new[1:] = (mark[at[1:]] != mark[at[:-1]]) | (self.head[at[1:]] != self.head[at[:-1]]) | (np.diff(at) != 1)
        start = np.flatnonzero(new)
        lo2, size2 = at[start], np.diff(np.append(start, len(at)))
        parent, word = mark[lo2], self.head[lo2]
        # in the other index, behind the extensions by separators and smaller words
        order = np.argsort(parent, kind="stable")
        ahead = np.empty(len(order), np.int64)
        ahead[order] = np.cumsum(size2[order]) - size2[order]
        base = np.full(len(lo), np.iinfo(np.int64).max)
        np.minimum.at(base, parent, ahead)
        rlo2 = live["rlo"][parent] + none[parent] + ahead - base[parent]
        head = np.searchsorted(lo, lo2, side="right") - 1
        inside = (head >= 0) & (lo2 < lo[head] + size[head])
        ids = np.concatenate([word[:, None], live["ids"][parent]], axis=1)
        return {"lo": lo2[inside], "rlo": rlo2[inside], "size": size2[inside], "ids": ids[inside]}

    def hash_of(self, level: dict) -> np.ndarray:
        """A hash of language and words of every phrase."""
        ids = level["ids"]
        out = np.repeat(self.lang, len(ids))
        for k in range(ids.shape[1]):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + self.hashes[ids[:, k]])
        return out >> np.uint64(64 - HASH_BITS)

    def rows(self, level: dict, lang: str) -> pa.RecordBatch:
        lo, rlo, size, ids = (level[k] for k in ("lo", "rlo", "size", "ids"))
        phrase = [self.phrases.take(pa.array(ids[:, k])) for k in range(ids.shape[1])]
        starts = np.concatenate([[0], np.cumsum(self.bwt == 0)])
        first, last = starts[lo + size] - starts[lo], self.stops[rlo + size] - self.stops[rlo]
        text = phrase[0] if len(phrase) == 1 else pc.binary_join_element_wise(*phrase, " ")
        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(ids)), text]
        return pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.int64()) for x in (size, first, last)], names=FOUND_NAMES)


def written(df: DataFrame, name: str) -> str:
    """The path of ``df`` as a Parquet table in the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def filtered(hashes: DataFrame):
    """A filter of the column ``hash``, whose bits are spread over 64."""
    low = (1 << 64 - HASH_BITS) - 1
    return filter_of(hashes.select(F.shiftleft("hash", 64 - HASH_BITS).bitwiseOR(F.col("hash").bitwiseAND(F.lit(low))).alias("value")))


def passing(level: dict, hashes: np.ndarray, words: np.ndarray) -> dict:
    """The phrases whose hashes pass a filter (its 64-bit words)."""
    keep = np.ones(len(hashes), bool)
    spread = np.uint64(64 - HASH_BITS)
    for places in filter_places(hashes << spread | hashes & ((np.uint64(1) << spread) - np.uint64(1))):
        keep &= (words[places >> 6] >> (places & 63) & 1).astype(bool)
    return {k: v[keep] for k, v in level.items()}


def reading(spark: SparkSession, rows: int) -> SparkSession:
    """A session that reads ``rows`` rows at a time, for tables of long rows."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key in ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        own.conf.set(key, str(rows))
    return own


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Index]]:
    for batch in batches:
        for i in range(len(batch)):
            lang, counts, bwt, rbwt = (batch.column(k)[i].as_py() for k in (0, 3, 4, 5))
            yield lang, Index(lang, batch.column(2)[i].values, counts, bwt, rbwt)


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), 1 << 15):
        yield batch.slice(at, 1 << 15)


def phrase_hashes(index: DataFrame, frequent: list) -> DataFrame:
    """hash, f of every phrase of one word more than there are filters in
    ``frequent``, in each shard, if its shorter phrases pass those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [f.value for f in frequent]
        for _, shard in opened(batches):
            level = shard.singles()
            for words in filters:
                level = shard.extended(passing(level, shard.hash_of(level), words))
            # in order, neighbours share their first byte, which shuffles smaller
            hashes = shard.hash_of(level)
            order = np.argsort(hashes)
            yield from sliced(pa.RecordBatch.from_arrays([pa.array(hashes[order].view(np.int64)), pa.array(level["size"][order], pa.int64())], names=["hash", "f"]))

    return index.mapInArrow(run, "hash long, f long")


def phrase_texts(index: DataFrame, frequent: list) -> DataFrame:
    """lang, phrase, f, starts and ends (occurrences that begin, end a piece) of
    the phrases of each shard that pass the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [f.value for f in frequent]
        for lang, shard in opened(batches):
            level = shard.singles()
            for k, words in enumerate(filters):
                level = shard.extended(level) if k else level
                level = passing(level, shard.hash_of(level), words)
                yield from sliced(shard.rows(level, lang))

    return index.mapInArrow(run, FOUND)


def counted(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, size: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, f, left, right (occurrences that a word goes before,
    comes after) of all phrases of up to ``depth`` words that occur ``least`` times in a language; and lang, n (all words)."""
    spark = docs.sparkSession
    path = written(shards(docs, size), "shards")
    index, frequent = reading(spark, 1).read.parquet(path), []
    for _ in range(depth):
        sums = phrase_hashes(index, frequent).groupBy("hash").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        frequent.append(filtered(spark.read.parquet(written(sums.select("hash"), "hashes"))))
    sums = [F.sum(c).alias(c) for c in ("f", "starts", "ends")]
    texts = phrase_texts(index, frequent).groupBy("lang", "phrase").agg(*sums).where(F.col("f") >= least)
    texts = texts.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f", (F.col("f") - F.col("starts")).alias("left"), (F.col("f") - F.col("ends")).alias("right"))
    totals = spark.read.parquet(path).groupBy("lang").agg(F.sum("size").alias("n"))
    return spark.read.parquet(written(texts, "phrases")), totals


def part(first, count) -> F.Column:
    """``count`` words of the phrase from word ``first`` (from 0)."""
    return F.array_join(F.slice(F.split("phrase", " "), first + 1, count), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, replaces: int = REPLACES, size: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, left, right: the ``top`` phrases
    of every language."""
    found, totals = counted(docs, least, size=size)
    wide = "decimal(20,0)"
    candidates = found.where("words > 1")
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", F.col("f").alias("a"), "left", "right", "k", part(F.lit(0), F.col("k")).alias("head"), part(F.col("k"), F.col("words") - F.col("k")).alias("tail"))
    side = found.where(F.col("words") < DEPTH).select("lang", "phrase", "f")
    cut = cut.join(side.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(side.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr(f"(cast(a as {wide}) * {SCALE}BD) div (cast(l as {wide}) + cast(r as {wide}))")
    cuts = cut.select("lang", "phrase", "a", "left", "right", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = cuts.groupBy("lang", "phrase", "a", "left", "right").agg(F.min("cut").alias("cut"))
    # the largest count of a longer candidate around each shorter one
    spot = F.explode(F.expr("flatten(transform(sequence(2, words - 1), w -> transform(sequence(0, words - w), i -> struct(i, w))))")).alias("spot")
    inner = candidates.where("words > 2").select("lang", "phrase", F.col("f").alias("around"), spot)
    inner = inner.select("lang", part(F.col("spot.i"), F.col("spot.w")).alias("phrase"), "around").groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(inner, ["lang", "phrase"], "left")
    kept = kept.where(F.expr(f"around is null or 100BD * cast(around as {wide}) < {replaces}BD * cast(a as {wide})"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"), "left", "right")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))
