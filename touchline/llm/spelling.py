"""Spelling variants by dense prefix-suffix tiling.

Two words that differ by one inserted, deleted or replaced code point have a
common prefix and a common suffix that together reach the longer length minus
one.  Blocks of words are laid out as padded code-point matrices, once aligned
at the start and once at the end, and two blocks are compared whole: the run of
equal columns from either side gives both lengths for all their pairs at once.

Which blocks meet: the shorter word of a pair, of L code points, is cut into
``SEGMENTS`` segments.  The edit lies in one of them, so all before and all
after it is the same in both words.  For every segment a word is put under what
lies outside it, among the words of its own length and among those one longer;
words under one such key form a group.  A pair is reported in the segment where
its common prefix ends and nowhere else, so none is lost and none comes twice.

A group of more than ``TILE`` code points is dealt by a hash of the word into
tiles, and every two tiles are compared in a row of their own, so no task holds
more than two tiles of a hot group, and very long words make small tiles.

Defined cases: a null text has no words; a null doc_id counts as an empty one;
repeated rows count again; an empty table gives no rows; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, stored, table, text_or_empty

by_value(__name__)

SEGMENTS = 4
#: code points of a tile
TILE = 4096
#: cells of a matrix, and of the pairs compared at a time
CELLS = 1 << 21
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: a form is so many times as frequent as the word
RATIO = 2
#: a word of one document in so many has a code point deleted, see ``spelled_words``
SPOILED = 97

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spelled_words(docs: DataFrame, spoiled: int = SPOILED) -> DataFrame:
    """word, one row an occurrence: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``
    of the whole text with A-Z in lower case.  Where ``spoiled`` divides the
    crc32 of ``<doc_id>:<word>``, the code point at crc32 modulo the word's
    length is deleted."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc")
    text = F.translate(text_or_empty(), UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit(r"([a-zÀ-ÿ]+)"), F.lit(1))
    hashed = docs.select(doc, F.explode(runs).alias("run")).withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    return hashed.select(F.when((F.col("h") % spoiled == 0) & at.isNotNull(), cut).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def segment_keys(words: DataFrame) -> DataFrame:
    """key (len, segment, left, right), word, n: what lies outside each segment
    of the word, among words of its own length and of one code point less."""
    shorter = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("len")
    cut = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("segment")
    rows = words.select("word", "n", shorter).select("*", cut)
    left = F.expr(f"substring(word, 1, cast(floor(len * segment / {SEGMENTS}) as int))")
    tail = F.expr(f"len - cast(floor(len * (segment + 1) / {SEGMENTS}) as int)")
    right = F.when(tail > 0, F.expr(f"right(word, len - cast(floor(len * (segment + 1) / {SEGMENTS}) as int))")).otherwise("")
    return rows.select(F.struct("len", "segment", left.alias("left"), right.alias("right")).alias("key"), "word", "n")


def tile_pairs(rows: DataFrame) -> DataFrame:
    """len, segment, a, b: the tiles (arrays of word, n) to compare; b is null
    where a tile is compared with itself."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") * (F.col("key.len") + 1) / TILE).cast("int")
    dealt = rows.join(sizes, "key").select("key", tiles.alias("tiles"), F.pmod(F.xxhash64("word"), tiles).cast("int").alias("tile"), "word", "n")
    made = stored(dealt.groupBy("key", "tiles", "tile").agg(F.collect_list(F.struct("word", "n")).alias("words")), "tiles")
    itself = made.select("key.len", "key.segment", F.col("words").alias("a"), F.lit(None).cast(made.schema["words"].dataType).alias("b"))
    split = made.where("tiles > 1")
    others = split.where("tile < tiles - 1").select("key", F.explode(F.expr("sequence(tile + 1, tiles - 1)")).alias("tile"), F.col("words").alias("a"))
    met = others.join(split.select("key", "tile", F.col("words").alias("b")), ["key", "tile"])
    return itself.unionAll(met.select("key.len", "key.segment", "a", "b"))


def code_points(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrices of code points aligned at the start and at the end, padded to
    ``width`` with zeros, and the lengths."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start, end = np.zeros((len(words), width), np.uint32), np.zeros((len(words), width), np.uint32)
    start[row, place] = flat
    end[row, width - sizes[row] + place] = flat
    return start, end, sizes


def common(a: np.ndarray, b: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Length of the run of equal columns from the left, at most ``reach``."""
    differ = np.concatenate([a != b, np.ones((len(a), 1), bool)], axis=1)
    return np.minimum(differ.argmax(axis=1), reach)


def near_rows(start, end, sizes, i, j, shorter, segment):
    """Which pairs (i, j) of rows are one edit apart and belong to ``segment``
    of the class of words of ``shorter`` code points."""
    li, lj = sizes[i], sizes[j]
    least, most = np.minimum(li, lj), np.maximum(li, lj)
    right = (least == shorter) & (most - least <= 1)
    i, j, least, most, segment = i[right], j[right], least[right], most[right], segment[right]
    front = common(start[i], start[j], least)
    back = common(end[i][:, ::-1], end[j][:, ::-1], least)
    one = (front + back >= most - 1) & ~((li[right] == lj[right]) & (front == least))
    # the segment that the common prefix ends in; at the very end the last one
    edges = np.stack([least * (s + 1) // SEGMENTS for s in range(SEGMENTS)])
    own = np.minimum((edges <= front).sum(axis=0), SEGMENTS - 1)
    keep = one & (own == segment)
    return i[keep], j[keep]


def blocks(counts_a: np.ndarray, counts_b: np.ndarray, limit: int):
    """(group, row in a, row in b) of every pair of every two blocks, some
    ``limit`` at a time; a count_b of -1 stands for the block a itself, whose
    pairs are taken once."""
    many = counts_a * np.where(counts_b < 0, counts_a, counts_b)
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        before = ends[at] - many[at]
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        group = np.repeat(np.arange(at, to), many[at:to])
        place = np.arange(len(group)) - np.repeat(ends[at:to] - many[at:to] - before, many[at:to])
        width = np.where(counts_b < 0, counts_a, counts_b)[group]
        x, y = place // np.maximum(width, 1), place % np.maximum(width, 1)
        once = (counts_b[group] >= 0) | (x < y)
        yield group[once], x[once], y[once]
        at = to


def alike(lengths: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in runs of similar lengths and at most some ``CELLS`` code points."""
    order = np.argsort(lengths, kind="stable")
    scale = np.frexp(lengths[order].astype(float))[1]
    cells = np.cumsum((words * (lengths + 1))[order]) // CELLS
    cuts = np.flatnonzero((np.diff(scale) != 0) | (np.diff(cells) != 0)) + 1
    yield from np.split(order, cuts)


def near_words(pairs: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair one edit apart."""

    def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [batch.column(2), batch.column(3)]
        counts = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
        flat = [x.flatten() for x in lists]
        words = [w for x in flat for w in x.field("word").to_pylist()]
        n = np.concatenate([x.field("n").to_numpy(zero_copy_only=False) for x in flat]).astype(np.int64)
        shorter, segment = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        start, end, sizes = code_points(words, int(shorter.max()) + 1)
        first = [np.cumsum(counts[0]) - counts[0], len(flat[0]) + np.cumsum(counts[1]) - counts[1]]
        alone = np.asarray(lists[1].is_null())
        other = np.where(alone, first[0], first[1])
        found = [
            near_rows(start, end, sizes, first[0][g] + x, other[g] + y, shorter[g], segment[g])
            for g, x, y in blocks(counts[0], np.where(alone, -1, counts[1]), CELLS // start.shape[1])
        ]
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        u, v = np.concatenate([i, j]), np.concatenate([j, i])
        texts = pa.array(words, pa.string())
        return pa.RecordBatch.from_arrays([texts.take(pa.array(u)), texts.take(pa.array(v)), pa.array(n[v])], names=["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                words = sum(batch.column(k).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
                for rows in alike(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), words):
                    yield compared(batch.take(pa.array(rows)))

    return pairs.select("len", "segment", "a", "b").mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that following (word, form) leads to.

    Pointer jumping: every round doubles the steps that a word has gone.  A form
    is ``RATIO`` times as frequent as its word, so there are no cycles and at
    most log2 of the largest count steps.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = now.join(further, "root", "left")
        if jumped.where("next is not null").isEmpty():
            return now
        now = stored(jumped.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of (word, n): its most
    frequent near word, if that is ``ratio`` times as frequent, and where the
    forms lead."""
    words = stored(words.select("word", "n"), "words")
    near = near_words(tile_pairs(segment_keys(words)))
    # of two words as frequent as each other the one earlier in code points
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    of_word = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(of_word, "word", "left")
    enough = -F.col("best.minus") >= F.col("n") * ratio
    found = stored(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")),
        "forms",
    )
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Every word of all documents with its form and root."""
    return variants(counted(spelled_words(table(spark, sf_dir, "documents")))).select("word", "form", "root", "n", "n_near", "form_n")
