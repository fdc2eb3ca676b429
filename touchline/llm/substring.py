"""Removal of passages that repeat, with Aho-Corasick automata.

A window is ``WINDOW`` consecutive words of a document.  A word goes if a
window that covers it also starts earlier: in a document with a smaller id, or
further up in the same one.

Three steps, all linear in the text:

* Seeds.  Each window has one anchor, the smallest hash among its ``SEED``-word
  runs; equal windows have equal anchors.  Only anchors travel (one for about
  six words).  An anchor whose hash occurs once can't belong to a window that
  occurs twice.
* Recurring passages.  The windows on recurring anchors are sorted by hash,
  document and start; those that aren't the first of their hash are the ones
  to remove, and their runs are the confirmed passages.
* Automata.  Documents meet their passages in blocks of bounded size.  Each
  block compiles an automaton over the word sequences of the passages that
  its documents can contain, in pieces of at most ``PIECE`` words, and streams
  all its documents through it.  Located windows go, unless they are the first.

Copies of a whole text are recognised up front: the one with the smallest id
holds the first window of each, so the others send no windows, and their whole
text is the passage.

Text moves compressed.  A seed that many documents share is sorted, not
collected: no step holds more than one block of documents or one document's
positions.

Defined cases: a null text has no words; texts with fewer words than a window
lose nothing; rows with the same doc_id count as one document (equal starts
aren't earlier); a null doc_id comes before all others; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, chunks, gram_hashes, same_document, stored, table, text_or_empty, with_body, word_hashes, word_spans

by_value(__name__)

WINDOW = 20
SEED = 10
PIECE = 256
BLOCK_BYTES = 2 << 20


def anchors(data: np.ndarray, offs: np.ndarray, window: int, seed: int):
    """Word hashes, row of each word, first word of each row, seed hashes,
    window starts and the anchor of each window (as word numbers)."""
    s, e, row = word_spans(data, offs)
    h = word_hashes(data, s, e)
    first = np.searchsorted(row, np.arange(len(offs)))
    n = len(h) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return h, row, first, none.astype(np.uint64), none, none
    grams = gram_hashes(h, seed, 3)
    starts = np.flatnonzero(row[:n] == row[window - 1 :])
    width = window - seed + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, width)
    at = np.empty(len(starts), np.int64)
    for a in range(0, len(starts), 1 << 16):
        part = starts[a : a + (1 << 16)]
        at[a : a + (1 << 16)] = part + least[part].argmin(axis=1)
    return h, row, first, grams, starts, at


def equal_runs(at: np.ndarray, value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of consecutive places with one value
    in one row."""
    if not len(at):
        return at, np.zeros(0, np.int32)
    new = np.flatnonzero((np.diff(at) != 1) | (value[1:] != value[:-1]) | (row[1:] != row[:-1])) + 1
    new = np.concatenate([[0], new])
    return at[new], np.diff(np.append(new, len(at))).astype(np.int32)


def expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


def seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """seed, doc_id, body, pos, run: the distinct anchors of each document; a
    run of places with one seed (a repeated word) is one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in chunks(batches, "text"):
            _, row, first, grams, _, at = anchors(data, offs, window, seed)
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]
            at, size = equal_runs(at, grams[at], row[at])
            rows = row[at]
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array((at - first[rows]).astype(np.int32)), pa.array(size)],
                names=["seed", "doc_id", "body", "pos", "run"],
            )

    return docs.select("doc_id", "body", "text").mapInArrow(run, "seed long, doc_id long, body long, pos int, run int")


def packed(docs: DataFrame) -> DataFrame:
    """The columns before text, and packed: the text compressed, for the way
    through a shuffle."""
    schema = docs.withColumn("packed", F.lit("").cast("binary")).drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch, data, offs in chunks(batches, "text"):
            raw = memoryview(data)
            out = pa.array([press.compress(raw[a:b]) for a, b in zip(offs[:-1], offs[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*batch.schema.names[:-1], "packed"])

    return docs.mapInArrow(run, schema)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is the text again, of bounded size."""
    import zstandard

    press = zstandard.ZstdDecompressor()

    def done(batch, lo, hi, texts):
        part = batch.slice(lo, hi - lo)
        return pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.large_binary()).cast(pa.large_string())], names=[*batch.schema.names[:-1], "text"])

    for batch in batches:
        column, texts, size, lo = batch.column(batch.num_columns - 1), [], 0, 0
        for i, x in enumerate(column):
            texts.append(press.decompress(x.as_buffer()))
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield done(batch, lo, i + 1, texts)
                texts, size, lo = [], 0, i + 1
        if texts:
            yield done(batch, lo, len(column), texts)


def window_rows(marked: DataFrame, window: int, seed: int) -> DataFrame:
    """hash, doc_id, body, start, run of the windows on recurring anchors (a run
    of starts with one hash is one row); marked: doc_id, body, positions
    (runs), packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in unpacked(batches):
            for batch, data, offs in chunks([whole], "text"):
                h, row, first, _, starts, at = anchors(data, offs, window, seed)
                recurring = np.zeros(len(h) + 1, bool)
                known = batch.column(2)
                flat = known.flatten()
                pos, size = flat.field("pos").to_numpy(), flat.field("run").to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(batch)), np.diff(known.offsets.to_numpy()))
                recurring[np.minimum(expand(first[owner] + pos, size), len(h))] = True
                starts = starts[recurring[at]]
                hashes = gram_hashes(h, window, 5)
                starts, size = equal_runs(starts, hashes[starts], row[starts])
                rows = row[starts]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[starts].view(np.int64)),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array((starts - first[rows]).astype(np.int32)),
                        pa.array(size),
                    ],
                    names=["hash", "doc_id", "body", "start", "run"],
                )

    return marked.select("doc_id", "body", "positions", "packed").mapInArrow(run, "hash long, doc_id long, body long, start int, run int")


def runs_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return [(int(x[0]), int(x[-1])) for x in np.split(starts, cut) if len(x)]


def locate(texts: list[list[bytes]], repeated: list[np.ndarray], window: int, piece: int = PIECE) -> list[np.ndarray]:
    """Which windows of each text occur in a passage of the block (runs of
    windows in ``repeated``): one automaton, all texts streamed through it."""
    import ahocorasick

    code: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for words, starts in zip(texts, repeated, strict=True):
        for a, b in runs_of(starts):
            for at in range(a, b + 1, piece - window + 1):
                phrase = words[at : min(at + piece, b + window)]
                automaton.add_word(tuple([code.setdefault(w, len(code) + 1) for w in phrase]), len(phrase))
    found = [np.zeros(max(0, len(words) - window + 1), bool) for words in texts]
    if len(automaton):
        automaton.make_automaton()
        known = code.get
        for words, hit in zip(texts, found, strict=True):
            for end, n in automaton.iter(tuple([known(w, 0) for w in words])):
                hit[end - n + 1 : end - window + 2] = True
    return found


def removed(joined: DataFrame, window: int, keep_spacing: bool) -> DataFrame:
    """The columns of joined before copy, starts and packed, then n_words,
    n_removed, kept: the words left with one space between, or with
    ``keep_spacing`` the text as it is where no word goes."""
    carried = joined.columns[:-3]
    schema = joined.select(*carried, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            copies, marks, column = batch.columns[-3:]
            raw = [t.as_buffer().to_pybytes() for t in column]
            texts = [t.split() for t in raw]
            later = []
            for words, copy, starts in zip(texts, copies.to_pylist(), marks, strict=True):
                n = max(0, len(words) - window + 1)
                if copy:
                    later.append(np.arange(n))
                elif starts.is_valid:
                    x = expand(starts.values.field("start").to_numpy().astype(np.int64), starts.values.field("run").to_numpy())
                    later.append(np.unique(x[x < n]))
                else:
                    later.append(np.zeros(0, np.int64))
            n_words, n_removed, kept = [], [], []
            for text, words, starts, found in zip(raw, texts, later, locate(texts, later, window), strict=True):
                edge = np.zeros(len(words) + 1, np.int64)
                go = starts[found[starts]]
                np.add.at(edge, go, 1)
                np.add.at(edge, go + window, -1)
                gone = np.cumsum(edge)[: len(words)] > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                if len(go):
                    words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                kept.append(text if keep_spacing and not len(go) else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*carried, "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, keep_spacing: bool = False) -> DataFrame:
    """row (all columns of a document but its text), n_words, n_removed, kept
    of every document; see ``removed``."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    text = text_or_empty()
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), rest.alias("row"), text.alias("text"))
    docs = with_body(docs)
    same = Window.partitionBy("seed").orderBy("doc_id", "pos")
    recurring = (
        seeds(docs, window, seed)
        .withColumn("_more", (F.col("run") > 1) | F.lead("seed").over(same).isNotNull() | F.lag("seed").over(same).isNotNull())
        .where("_more")
        .groupBy("doc_id", "body")
        .agg(F.collect_set(F.struct("pos", "run")).alias("positions"))
    )
    # a copy: the same text stands under a smaller id
    bodies = docs.select("doc_id", "body", F.xxhash64(F.lit("second"), "text").alias("_other"), F.length("text").alias("_n"))
    least = bodies.groupBy("body", "_other", "_n").agg(F.min(F.struct("doc_id")).alias("_least"))
    copies = (
        bodies.join(least, ["body", "_other", "_n"])
        .where(~F.col("_least.doc_id").eqNullSafe(F.col("doc_id")))
        .select("doc_id", "body")
        .distinct()
    )
    copies = stored(copies, "copies")
    wanted = stored(recurring.join(copies, same_document(recurring, copies), "left_anti"), "positions")
    text = packed(docs)
    marked = text.join(wanted, same_document(text, wanted)).select(text["doc_id"], text["body"], "positions", "packed")
    rows = window_rows(marked, window, seed)
    by_place = Window.partitionBy("hash").orderBy("doc_id", "start")
    own = F.struct("doc_id", "start")
    # of the run that holds the first window, the rest is later
    held = F.first(own).over(by_place).eqNullSafe(own).cast("int")
    later = rows.withColumn("_held", held).select("doc_id", "body", (F.col("start") + F.col("_held")).alias("start"), (F.col("run") - F.col("_held")).alias("run"))
    spans = later.where("run > 0").groupBy("doc_id", "body").agg(F.collect_set(F.struct("start", "run")).alias("starts"))
    facts = stored(
        spans.select("doc_id", "body", F.lit(False).alias("copy"), "starts").unionAll(
            copies.select("doc_id", "body", F.lit(True), F.lit(None).cast("array<struct<start:int,run:int>>"))
        ),
        "repeats",
    )
    again = packed(whole)
    joined = again.join(facts, same_document(again, facts), "left").select("row", F.coalesce("copy", F.lit(False)).alias("copy"), "starts", "packed")
    return removed(joined, window, keep_spacing)


def op4_repeated_phrases(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
