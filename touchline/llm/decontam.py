"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased; tokens are runs of ASCII letters and digits and of
non-ASCII characters.  A document's tokens matter only where ``MATCH``
consecutive ones also stand together in a benchmark item (a seed), so one pass
over the documents keeps just those stretches, and seeds join documents with
the items they share one with.  Each pair is then tiled: running Karp-Rabin
finds all common stretches, and the longest unmarked one is marked again and
again until none of ``MATCH`` tokens is left.  A pair counts if its tiles cover
at least ``COVERAGE`` of the item's tokens, in whatever order they stand, and at
least ``LEAST`` tokens (or all, if the item has no more): one common phrase is no
proof of a short item.  An item of fewer than ``MATCH`` tokens is a seed and a
tile as a whole: the document holds all of it as one run.

The pass over the documents tests seeds against a Bloom filter; its size doesn't depend on the benchmark, and the join decides, so a
fuller filter only lets more rows through.

Defined cases: null and empty texts, and items without a token, share nothing; an
item_id or doc_id that occurs with several texts counts with its best pair; a
text of any length is read whole; empty tables give no rows; other columns
aren't read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, chunks, filter_bits, filter_of, filter_places, gram_hashes, spans, table, text_or_empty, with_body, word_hashes

by_value(__name__)

MATCH = 5
COVERAGE = 0.5
#: tokens that the tiles of a pair cover at least
LEAST = 8

TOKEN = np.zeros(256, dtype=bool)
TOKEN[48:58] = TOKEN[97:123] = TOKEN[65:91] = TOKEN[128:] = True


def item_seeds(items: DataFrame, match: int = MATCH) -> DataFrame:
    """item_id, item (tokens with one space between), n_tokens, seeds; the only
    seed of an item of fewer than ``match`` tokens is the whole of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in chunks(batches, "text"):
            s, e, row = spans(data, offs, TOKEN[data])
            h = word_hashes(data, s, e)
            edges = np.searchsorted(row, np.arange(len(batch) + 1))
            raw = data.tobytes()
            items_, n, seeds = [], [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                items_.append(" ".join(raw[x:y].decode() for x, y in zip(s[a:b], e[a:b], strict=True)))
                n.append(b - a)
                seeds.append(np.unique(gram_hashes(h[a:b], max(min(match, b - a), 1))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(items_, pa.string()), pa.array(n, pa.int64()), pa.array(seeds, pa.list_(pa.int64()))],
                names=["item_id", "item", "n_tokens", "seeds"],
            )

    source = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower(text_or_empty()).alias("text"))
    return source.mapInArrow(run, "item_id long, item string, n_tokens long, seeds array<long>").where("n_tokens > 0")


def shared_stretches(docs: DataFrame, shared, sizes: list[int]) -> DataFrame:
    """doc_id, body, n_words (the document's tokens), stretches (token runs that hold
    nothing but seeds that pass the broadcast filter ``shared``), seeds; only
    documents that have any.  Seeds are runs of any of the ``sizes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits(shared.value)
        for batch, data, offs in chunks(batches, "text"):
            s, e, row = spans(data, offs, TOKEN[data])
            h = word_hashes(data, s, e)
            hits = []
            for size in sizes:
                grams = gram_hashes(h, size)
                high, low = filter_places(grams)
                at = np.flatnonzero(bits[high] & bits[low] & (row[: len(grams)] == row[size - 1 :][: len(grams)]))
                hits.append((at, at + size, grams[at]))
            hit, end, grams = map(np.concatenate, zip(*hits, strict=True))
            if not len(hit):
                continue
            order = np.argsort(hit, kind="stable")
            hit, end, grams = hit[order], end[order], grams[order]
            # a stretch ends where the next seed starts after it or in another row
            reach = np.maximum.accumulate(end)
            far = np.flatnonzero((hit[1:] > reach[:-1]) | (row[hit[1:]] != row[hit[:-1]])) + 1
            first = hit[np.concatenate([[0], far])]
            last = reach[np.concatenate([far - 1, [len(hit) - 1]])]
            raw = data.tobytes()
            texts = [" ".join(raw[x:y].decode() for x, y in zip(s[a:b], e[a:b], strict=True)) for a, b in zip(first, last, strict=True)]
            rows = row[first]
            edges = np.flatnonzero(np.diff(rows, prepend=-1))
            ends = [*edges[1:], len(rows)]
            of_hit = row[hit]
            seeds = [np.unique(grams[np.searchsorted(of_hit, r) : np.searchsorted(of_hit, r, "right")]).view(np.int64) for r in rows[edges]]
            n_words = np.bincount(row, minlength=len(batch))[rows[edges]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[edges])),
                    batch.column(1).take(pa.array(rows[edges])),
                    pa.array(n_words, pa.int64()),
                    pa.array([texts[a:b] for a, b in zip(edges, ends, strict=True)], pa.list_(pa.string())),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                names=["doc_id", "body", "n_words", "stretches", "seeds"],
            )

    source = with_body(docs).withColumn("text", F.lower("text"))
    return source.mapInArrow(run, "doc_id long, body long, n_words long, stretches array<string>, seeds array<long>")


_MOD = (1 << 61) - 1
_STEP = 1_000_003


def windows(ids: list[int], free: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """Start and rolling hash of each run of ``size`` unmarked tokens."""
    drop = pow(_STEP, size, _MOD)
    h = n = 0
    for i, (x, ok) in enumerate(zip(ids, free, strict=True)):
        if not ok:
            h = n = 0
            continue
        h = (h * _STEP + x + 1) % _MOD
        n += 1
        if n > size:
            h = (h - drop * (ids[i - size] + 1)) % _MOD
        if n >= size:
            yield i - size + 1, h


def tiles(item: list[str], stretches: list[list[str]], match: int = MATCH) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling: (length, place in the item, stretch, place in it),
    longest first, ties to the smallest places."""
    code: dict[str, int] = {}
    p = [code.setdefault(t, len(code)) for t in item]
    texts = [[code.get(t, -1) for t in s] for s in stretches]
    p_free = bytearray(b"\1" * len(p))
    t_free = [bytearray(x >= 0 for x in t) for t in texts]
    found: list[tuple[int, int, int, int]] = []
    size = max(match, min(len(p), max(map(len, texts), default=0)))
    while True:
        at: dict[int, list[int]] = {}
        for i, h in windows(p, p_free, size):
            at.setdefault(h, []).append(i)
        heap = []
        for k, t in enumerate(texts):
            for j, h in windows(t, t_free[k], size):
                for i in at.get(h, ()):
                    if p[i : i + size] != t[j : j + size]:
                        continue
                    if i and j and p_free[i - 1] and t_free[k][j - 1] and p[i - 1] == t[j - 1]:
                        continue  # not where the common stretch starts
                    n = size
                    while i + n < len(p) and j + n < len(t) and p_free[i + n] and t_free[k][j + n] and p[i + n] == t[j + n]:
                        n += 1
                    heap.append((-n, i, k, j))
        heapq.heapify(heap)
        while heap:
            n, i, k, j = heapq.heappop(heap)
            n = -n
            clear = [p_free[i + x] and t_free[k][j + x] for x in range(n)]
            if all(clear):
                found.append((n, i, k, j))
                p_free[i : i + n] = bytes(n)
                t_free[k][j : j + n] = bytes(n)
                continue
            a = 0
            while a < n:
                b = a
                while b < n and clear[b]:
                    b += 1
                if b - a >= size:
                    heapq.heappush(heap, (a - b, i + a, k, j + a))
                a = b + 1
        if size == match:
            return found
        size = max(match, size // 2)


def tile_pairs(pairs: DataFrame, match: int = MATCH) -> DataFrame:
    """doc_id, body, n_words, item_id, n_tokens, n_covered, n_tiles, longest of each
    pair (doc_id, body, n_words, stretches, item_id, item).  An item shorter than
    ``match`` is one tile or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, body, n_words, stretches, item_id, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = item.split(" ")
                found = tiles(tokens, [s.split(" ") for s in stretches], min(match, len(tokens)))
                rows.append((doc, body, n_words, item_id, len(tokens), sum(t[0] for t in found), len(found), max((t[0] for t in found), default=0)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)

    names = ["doc_id", "body", "n_words", "item_id", "n_tokens", "n_covered", "n_tiles", "longest"]
    return pairs.select("doc_id", "body", "n_words", "stretches", "item_id", "item").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def contaminated(docs: DataFrame, items: DataFrame, match: int = MATCH, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, body, n_words, item_id, n_tokens, n_covered, n_tiles, longest,
    coverage: pairs of a document and a benchmark item whose tiles cover at least
    ``coverage`` of the item and ``LEAST`` of its tokens, or all of them."""
    wanted = item_seeds(items, match)
    short = wanted.where(F.col("n_tokens") < match).select("n_tokens").distinct().collect()  # fewer rows than ``match``
    sizes = [match, *sorted(r["n_tokens"] for r in short)]
    seeds = wanted.select(F.explode("seeds").alias("seed"), "item_id", "item")
    found = shared_stretches(docs, filter_of(seeds.select(F.col("seed").alias("value")).distinct()), sizes)
    pairs = (
        found.select("doc_id", "body", "n_words", "stretches", F.explode("seeds").alias("seed"))
        .join(seeds, "seed")
        .select("doc_id", "body", "n_words", "stretches", "item_id", "item")
        .distinct()
    )
    share = F.col("n_covered") / F.col("n_tokens")
    enough = F.greatest(F.lit(coverage) * F.col("n_tokens"), F.least(F.col("n_tokens"), F.lit(LEAST)))
    return tile_pairs(pairs, match).where(F.col("n_covered") >= enough).withColumn("coverage", share)


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds."""
    pairs = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("coverage", "n_tokens", "n_covered", "n_tiles", "longest"))
    return pairs.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
