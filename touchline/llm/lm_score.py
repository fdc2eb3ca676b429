"""Cross-entropy difference scores from two matched n-gram models.

A target model (documents labelled of good quality) and a background model
(all documents) are interpolated bigram models with one vocabulary, one list
of bigrams and one smoothing; only their counts differ.  A document's score is
the mean over its words of the target loss less the background loss, in nats:
the lower, the more it resembles the target.

Every word and every bigram of the corpus is in the models, however rare, so
what scoring reads grows with the input.  Documents are dealt into parts of
about ``PART_BYTES`` of text.  A part sends its distinct n-grams with their
counts, a sorted run for each bucket of hashes; a bucket adds up the runs of
all parts and answers each with the sums in the order of its run; a part's
documents are then scored against the sums of its own n-grams.  A frequent
n-gram counts once a part, so no bucket is hot, and nothing is broadcast but
the size of the vocabulary.

Words are ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z).

Defined cases: a document without words has null losses; a repeated row is
counted and scored again; a document is a target if any of its labels has
quality 1; without a target both models still exist, the target's being
uniform; an empty table gives no rows; clashing names of other columns don't
matter, they aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, by_value, chunks, mix, seeded, shuffle_parts, table, text_or_empty, word_hashes, word_spans

by_value(__name__)

#: text of the documents that are counted and scored together
PART_BYTES = 8 << 20
#: text whose n-grams make up a bucket
BUCKET_BYTES = 32 << 20
#: weight of the bigrams against the unigrams
WEIGHT = 0.7
#: distinct keys that a task holds before it hands them on
HELD = 1_000_000


class Tally:
    """Sums by key, merged whenever enough parts have come together."""

    def __init__(self, columns: int):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.columns = columns

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        self.parts.append((keys, *values))
        self.size += len(keys)
        if self.size > 4 * HELD:
            self.merge()

    def merge(self) -> None:
        if not self.parts:
            return
        keys, inverse = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        sums = [np.bincount(inverse, np.concatenate([p[i + 1] for p in self.parts]), len(keys)).astype(np.int64) for i in range(self.columns)]
        self.parts, self.size = [(keys, *sums)], len(keys)

    def batches(self, names: list[str], only_above: int = 0) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.parts and self.size > only_above:
            columns = self.parts[0]
            for at in range(0, len(columns[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns], names=names)
            self.parts, self.size = [], 0


def lowered_words(data: np.ndarray, offs: np.ndarray):
    data = LOWER[data]
    s, e, row = word_spans(data, offs)
    return word_hashes(data, s, e), row


def word_counts(docs: DataFrame) -> DataFrame:
    """word (a hash), n, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(1)
        for _, data, offs in chunks(batches, "text"):
            words, n = np.unique(lowered_words(data, offs)[0].view(np.int64), return_counts=True)
            tally.add(words, n)
            if tally.size > 4 * HELD:
                yield from tally.batches(["word", "n"], HELD)
        yield from tally.batches(["word", "n"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


SCORES = "doc_id long, n_words long, loss_target double, loss_background double, score double"


def means(ids: pa.Array, row: np.ndarray, target: np.ndarray, background: np.ndarray) -> pa.RecordBatch:
    """The scores of documents from the losses of their words."""
    n = np.bincount(row, minlength=len(ids))
    mean = [np.bincount(row, x, len(ids)) / np.maximum(n, 1) for x in (target, background, target - background)]
    columns = [pa.array(x, pa.float64(), mask=n == 0) for x in mean]
    return pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), *columns], names=["doc_id", "n_words", "loss_target", "loss_background", "score"])


#: the n-gram of no word, which counts all of them; the start; what tells a
#: context from a word; the two places of a bigram
TOTAL, START, CONTEXT, FIRST, SECOND = seeded(5, 23) | np.uint64(1)


def packed(x: np.ndarray) -> bytes:
    """64-bit values as bytes, compressed place by place."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int, kind: type) -> np.ndarray:
    places = np.frombuffer(pa.decompress(raw, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(8, n).T).view(kind).ravel()


def gram_keys(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word, of the word before as a context and of both as a
    bigram, and the word's row."""
    words, row = lowered_words(data, offs)
    before = np.full(len(words), START)
    before[1:] = np.where(row[1:] == row[:-1], words[:-1], START)
    pairs = mix(before * FIRST + words * SECOND)
    return words, mix(before ^ CONTEXT), pairs, row


def summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order and their summed counts."""
    keys, inverse = np.unique(keys, return_inverse=True)
    return [keys, *(np.bincount(inverse, n, len(keys)).astype(np.int64) for n in counts)]


def part_grams(texts: pa.Table, targets: np.ndarray) -> list[np.ndarray]:
    """Distinct n-grams of a part in order, and how often they occur in all of
    its documents and in the targets."""
    out = [[np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]]
    for batch, data, offs in chunks(iter(texts.to_batches()), "text"):
        words, contexts, pairs, row = gram_keys(data, offs)
        ids = batch.column("doc_id")
        target = ids.is_valid().to_numpy(zero_copy_only=False) & np.isin(ids.fill_null(0).to_numpy(), targets)
        flags = np.tile(target[row], 4)
        total = np.full(len(words), TOTAL)
        out.append(summed(np.concatenate([words, contexts, pairs, total]), np.ones(len(flags)), flags))
    return summed(*map(np.concatenate, zip(*out, strict=True)))


def parted(docs: DataFrame, parts: int) -> DataFrame:
    """part, doc_id, text; a document's part follows from its id."""
    key = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return text.select(F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"), "doc_id", "text")


def gram_counts(docs: DataFrame, target_ids: DataFrame, parts: int, buckets: int) -> DataFrame:
    """part, bucket, n, counts: how often the ``n`` n-grams of the part in the
    bucket, in order, occur in all documents and in all targets."""

    def send(texts: pa.Table, labels: pa.Table) -> pa.Table:
        keys, n_all, n_target = part_grams(texts, labels.column("doc_id").to_numpy())
        # buckets are ranges of the upper half of the hash
        at = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        found, start = np.unique(at, return_index=True)
        runs = [slice(i, j) for i, j in zip(start, np.append(start[1:], len(keys)), strict=False)]
        part = texts.column("part")[0].as_py() if runs else 0
        return pa.table(
            {
                "part": pa.array([part] * len(runs), pa.int32()),
                "bucket": pa.array(found, pa.int32()),
                "n": pa.array([r.stop - r.start for r in runs], pa.int32()),
                "keys": pa.array([packed(np.diff(keys[r], prepend=np.uint64(0))) for r in runs], pa.binary()),
                "counts": pa.array([packed(np.concatenate([n_all[r], n_target[r]])) for r in runs], pa.binary()),
            }
        )

    def answer(runs: pa.Table) -> pa.Table:
        n = runs.column("n").to_pylist()
        keys = np.concatenate([np.cumsum(unpacked(raw, k, np.uint64), dtype=np.uint64) for raw, k in zip(runs.column("keys").to_pylist(), n, strict=True)])
        counts = [unpacked(raw, 2 * k, np.int64).reshape(2, k) for raw, k in zip(runs.column("counts").to_pylist(), n, strict=True)]
        distinct, inverse = np.unique(keys, return_inverse=True)
        sums = [np.bincount(inverse, np.concatenate([c[i] for c in counts]), len(distinct)).astype(np.int64)[inverse] for i in (0, 1)]
        ends = np.cumsum(n)
        back = [packed(np.concatenate([x[end - k : end] for x in sums])) for end, k in zip(ends, n, strict=True)]
        return runs.select(["part", "bucket", "n"]).append_column("counts", pa.array(back, pa.binary()))

    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    labels = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"), "doc_id")
    sent = parted(docs, parts).groupBy("part").cogroup(labels.groupBy("part")).applyInArrow(send, "part int, bucket int, n int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(answer, "part int, bucket int, n int, counts binary")


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_words, loss_target, loss_background, score, from every word and
    bigram of ``docs``."""
    size = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    # small inputs have parts and buckets for every task
    least = 2 * shuffle_parts(docs.sparkSession)
    parts, buckets = (max(-(-size // b), least) for b in (PART_BYTES, BUCKET_BYTES))
    kinds = word_counts(docs).count() + 1  # and a word never seen
    scored = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), *((c, pa.float64()) for c in ("loss_target", "loss_background", "score"))])

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = part_grams(texts, np.zeros(0, np.int64))[0]
        answers = answers.sort_by("bucket")
        got = [unpacked(raw, 2 * k, np.int64).reshape(2, k) for raw, k in zip(answers.column("counts").to_pylist(), answers.column("n").to_pylist(), strict=True)]
        n_all, n_target = np.concatenate([np.zeros((2, 0)), *got], axis=1)
        all_at = np.searchsorted(keys, TOTAL)
        out = []
        for batch, data, offs in chunks(iter(texts.to_batches()), "text"):
            *grams, row = gram_keys(data, offs)
            word, context, pair = (np.searchsorted(keys, k) for k in grams)
            losses = []
            for n in (n_target, n_all):
                before = n[context]
                left = np.where(before > 0, 1.0 - WEIGHT, 1.0)
                unigram = (n[word] + 1.0) / (n[all_at : all_at + 1].sum() + kinds)
                losses.append(-np.log(left * unigram + WEIGHT * n[pair] / np.maximum(before, 1.0)))
            out.append(means(batch.column("doc_id"), row, *losses))
        return pa.Table.from_batches(out, schema=scored)

    counted = gram_counts(docs, target_ids, parts, buckets)
    return parted(docs, parts).groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(run, SCORES)


def op1_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    """Every document's score; the target is the documents of quality 1."""
    labels = table(spark, sf_dir, "labels").where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    return score(table(spark, sf_dir, "documents"), labels)
