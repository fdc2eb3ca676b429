"""Language identification with a byte convolutional network in numpy.

A text is cut into windows of ``WINDOW`` bytes (the last one padded with byte
0).  Each byte has a learned embedding; filters of several widths run over it,
rectified and max-pooled over the window, and a softmax layer gives the
window's language.  A document's score for a language is the mean over all
windows of its whole text, weighted by their bytes.

Training takes windows of a bounded sample of labelled documents (``PER_LANG``
documents a language, ``WINDOWS_EACH`` windows of each, chosen by hash) and
runs on the driver; the trained arrays are about 30 kB.  Prediction is one
pass over the documents with no shuffle: as embedding and filter are linear,
a filter is a sum of one row lookup a byte, which numpy does for a block of
windows at a time.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any labelled text every document is; repeated rows are predicted
separately; labels are the non-null values of ``lang`` as they stand; an empty
table gives no rows; other columns are carried by position, so the columns asked
for may have any names but ``lang_pred`` and ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, by_value, chunks, seeded, stored, table, text_or_empty

by_value(__name__)

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PER_LANG = 1500
WINDOWS_EACH = 4
#: up to this many languages their counts are broadcast
BROADCAST_LANGS = 100_000
EPOCHS = 6
#: windows that are convolved at a time
BLOCK = 512
UNKNOWN = "und"
#: bytes that a byte's successors are smoothed by
PAIR_PRIOR = 5.0
#: usual bytes that a text is lengthened by, see ``recognised``
LIKE_PRIOR = 32.0
REJECT = 4.0
#: share of the named language's probability at which another is likely too
LIKELY = 0.1
#: least margin of ``recognised``, for a few documents that are all alike
LEAST_MARGIN = 1.0


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: list[np.ndarray]  # a width: width x EMBED x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray


def _random(shape: tuple[int, ...], seed: int, scale: float) -> np.ndarray:
    """Normal values from hashed counters: the same on every platform."""
    n = int(np.prod(shape))
    u = seeded(2 * n, seed).astype(np.float64) / 2.0**64
    z = np.sqrt(-2 * np.log(u[:n] + 1e-12)) * np.cos(2 * np.pi * u[n:])
    return (scale * z).reshape(shape).astype(np.float32)


def fit(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 5) -> Network:
    """Train on rows of ``WINDOW`` bytes with Adam; classes weigh the same."""
    net = Network(
        langs,
        _random((256, EMBED), seed, 0.5),
        [_random((w, EMBED, FILTERS), seed + w, (w * EMBED) ** -0.5) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        _random((FILTERS * len(WIDTHS), len(langs)), seed + 99, 0.2),
        np.zeros(len(langs), np.float32),
    )
    weight = 1.0 / np.maximum(np.bincount(labels, minlength=len(langs)), 1)
    weight = (weight * len(labels) / len(langs)).astype(np.float32)
    params = [net.embed, *net.filters, *net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = np.argsort(seeded(len(labels), seed + 1000 + epoch))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            step += 1
            for p, g, (m, v) in zip(params, _gradients(net, windows[rows], labels[rows], weight), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    e = net.embed[x]
    pooled, kept = [], []
    for f, b in zip(net.filters, net.bias, strict=True):
        w = len(f)
        slices = np.concatenate([e[:, j : WINDOW - w + 1 + j] for j in range(w)], axis=2)
        act = slices @ f.reshape(w * EMBED, FILTERS) + b
        best = act.argmax(axis=1)
        top = np.take_along_axis(act, best[:, None], axis=1)[:, 0]
        pooled.append(np.maximum(top, 0))
        kept.append((slices, best, top > 0))
    h = np.concatenate(pooled, axis=1)
    p = softmax(h @ net.out + net.out_bias)
    p[np.arange(n), y] -= 1
    d = p * weight[y][:, None] / n
    dh = d @ net.out.T
    d_embed, d_filters, d_bias = np.zeros_like(net.embed), [], []
    for i, (f, (slices, best, on)) in enumerate(zip(net.filters, kept, strict=True)):
        w = len(f)
        g = dh[:, i * FILTERS : (i + 1) * FILTERS] * on  # only the pooled place has a gradient
        at = np.take_along_axis(slices, best[:, :, None], axis=1)  # n x FILTERS x w*EMBED
        d_filters.append(np.einsum("nf,nfk->kf", g, at).reshape(f.shape))
        d_bias.append(g.sum(axis=0))
        back = np.einsum("nf,kf->nfk", g, f.reshape(w * EMBED, FILTERS)).reshape(n, FILTERS, w, EMBED)
        for j in range(w):
            byte = np.take_along_axis(x, best + j, axis=1)
            np.add.at(d_embed, byte.ravel(), back[:, :, j].reshape(-1, EMBED))
    return [d_embed, *d_filters, *d_bias, h.T @ d, d.sum(axis=0)]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def predict_windows(net: Network, tables: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Language probabilities of each row of ``WINDOW`` bytes."""
    out = np.empty((len(x), len(net.langs)), np.float32)
    for at in range(0, len(x), BLOCK):
        block = x[at : at + BLOCK]
        pooled = []
        for rows, b in zip(tables, net.bias, strict=True):
            n = WINDOW - len(rows) + 1
            act = rows[0][block[:, :n]]
            for j in range(1, len(rows)):
                act += rows[j][block[:, j : n + j]]
            pooled.append(np.maximum(act.max(axis=1) + b, 0))
        out[at : at + BLOCK] = softmax(np.concatenate(pooled, axis=1) @ net.out + net.out_bias)
    return out


def lookup_tables(net: Network) -> list[list[np.ndarray]]:
    """A filter's part for each of its places and each byte."""
    return [[np.ascontiguousarray(net.embed @ f[j]) for j in range(len(f))] for f in net.filters]


def cut_windows(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows of every row, the row of each and its bytes."""
    size = np.diff(offs)
    per = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), per)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    start = offs[doc] + nth * WINDOW
    used = np.minimum(offs[doc + 1] - start, WINDOW)
    x = np.zeros((len(doc), WINDOW), np.uint8)
    place = np.arange(WINDOW)
    inside = place < used[:, None]
    x[inside] = data  # windows lie one after another, so do the bytes
    return x, doc, used


def sample_windows(labelled: DataFrame, per_lang: int = PER_LANG) -> tuple[list[bytes], list[str]]:
    """Windows of a bounded sample of ``labelled`` (doc_id, text, lang) and the
    language of each."""
    rank = Window.partitionBy("lang").orderBy("key", "text")
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.lit("sample"), F.col("doc_id").cast("string")).alias("key")
    )
    span = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    picks = [F.expr("text").substr((F.lit(1) + F.pmod(F.xxhash64("key", F.lit(i)), span)).cast("int"), F.lit(WINDOW)) for i in range(WINDOWS_EACH)]
    # about twice as many as wanted of each language, so that no task meets all
    # documents of one
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    if counts.count() <= BROADCAST_LANGS:  # whole texts stay where they are
        counts = F.broadcast(counts)
    some = rows.join(counts, "lang").where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(float(2 * per_lang << 30)) / F.col("n"))
    small = some.select("lang", "key", F.array(*picks).alias("text"))
    sample = small.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= per_lang)
    got = sample.select("lang", F.explode("text").alias("text")).where(F.col("text").rlike(r"\p{L}")).toArrow()
    return [t.encode()[:WINDOW] for t in got.column("text").to_pylist()], got.column("lang").to_pylist()


def train(labelled: DataFrame, per_lang: int = PER_LANG) -> Network | None:
    """A network for the languages of ``labelled`` (doc_id, text, lang); None
    if there is nothing to learn from."""
    return trained(*sample_windows(labelled, per_lang))


def trained(raw: list[bytes], lang_of: list[str]) -> Network | None:
    """A network for sampled windows and their languages."""
    langs = sorted(set(lang_of))
    if not langs:
        return None
    x = np.frombuffer(b"".join(r.ljust(WINDOW, b"\0") for r in raw), np.uint8).reshape(len(raw), WINDOW)
    code = {lang: i for i, lang in enumerate(langs)}
    y = np.array([code[lang] for lang in lang_of])
    order = np.argsort(np.array([hash_of(r) for r in raw], np.uint64), kind="stable")
    return fit(x[order], y[order], langs)


def hash_of(raw: bytes) -> int:
    import zlib

    return zlib.crc32(raw)


def mean_probabilities(net: Network, tables: list[list[np.ndarray]], data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Each text's probability of every language: the mean over its windows,
    weighted by their bytes."""
    x, doc, used = cut_windows(data, offs)
    p = predict_windows(net, tables, x) * used[:, None]
    total = np.stack([np.bincount(doc, p[:, i], len(offs) - 1) for i in range(len(net.langs))], axis=1)
    return total / np.maximum(np.diff(offs), 1)[:, None]


def predict(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``, from
    the column ``text`` alone."""
    columns = [F.col(f"`{c}`") for c in keep]
    if net is None:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(*columns, text_or_empty().alias("_model_text"), letters.alias("_model_letters"))
    schema = source.select(*columns, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookup_tables(net)
        for batch, data, offs in chunks(batches, "_model_text"):
            total = mean_probabilities(net, tables, data, offs)
            best = total.argmax(axis=1)
            known = np.asarray(batch.column(len(keep) + 1).to_pylist(), bool)
            lang = pa.array([net.langs[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)], pa.string())
            score = pa.array(np.where(known, np.clip(total.max(axis=1), 0, 1), 0.0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lang, score], names=[*keep, "lang_pred", "score"])

    return source.mapInArrow(run, schema)


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def byte_pairs(raw: list[bytes], lang_of: list[str]) -> np.ndarray:
    """Logarithms of the chance of each byte after each other in every language of
    sampled windows, A-Z in lower case (byte 0 stands before the first)."""
    tables = []
    for lang in sorted(set(lang_of)):
        texts = [LOWER[np.frombuffer(r, np.uint8)] for r, own in zip(raw, lang_of, strict=True) if own == lang]
        n = np.zeros((256, 256))
        for t in texts:
            np.add.at(n, (t[:-1], t[1:]), 1)
        single = np.bincount(np.concatenate(texts), minlength=256) + 0.5
        n[0] = 0  # windows begin anywhere: any byte may be the first
        single /= single.sum()
        tables.append(np.log((n + PAIR_PRIOR * single) / (n.sum(axis=1, keepdims=True) + PAIR_PRIOR)))
    return np.stack(tables)


def likeness(docs: DataFrame, net: Network, pairs: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the network's ``lang_pred``, ``n_bytes`` and
    ``like``, the mean logarithm of the chance of the text's bytes in that language,
    or in one that the network finds ``LIKELY`` times as probable, if it fits better."""
    columns = [F.col(f"`{c}`") for c in keep]
    source = docs.select(*columns, text_or_empty().alias("_model_text"))
    schema = source.select(*columns, F.lit("").alias("lang_pred"), F.lit(0).cast("long").alias("n_bytes"), F.lit(0.0).alias("like")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, tables = pairs.reshape(len(pairs), -1), lookup_tables(net)
        for batch, data, offs in chunks(batches, "_model_text"):
            p = mean_probabilities(net, tables, data, offs)
            best, likely = p.argmax(axis=1), p >= LIKELY * p.max(axis=1, keepdims=True)
            n, data = np.diff(offs), LOWER[data]
            before = np.zeros(len(data), np.int64)
            before[1:] = data[:-1]
            before[offs[:-1][n > 0]] = 0
            pair = before * 256 + data
            row = np.repeat(np.arange(len(n)), n)
            like = np.full(len(n), -np.inf)
            for k, t in enumerate(flat):
                inside = likely[row, k]
                own = np.bincount(row[inside], t[pair[inside]], len(n))
                like = np.where(likely[:, k], np.maximum(like, own), like)
            like /= np.maximum(n, 1)
            lang = pa.array([net.langs[i] for i in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lang, pa.array(n), pa.array(like)], names=[*keep, "lang_pred", "n_bytes", "like"])

    return source.mapInArrow(run, schema)


def recognised(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``lang_pred`` of the documents (doc_id, text, lang)
    that are in one of the labelled languages: the network of ``learn_and_predict``
    names the language, and the text has to look like it, or like one that the
    network can't tell from it.

    Labelled documents that aren't held out train the network and give the chances
    of byte pairs in each language, held out ones (or all, if none is) what is
    usual: a document goes if it lies
    ``REJECT`` times as far below their median as the lowest hundredth of them
    begins, and by ``LEAST_MARGIN`` at least.  A short text counts as if ``LIKE_PRIOR`` usual bytes followed it.
    Texts without a letter go.  Without labelled text there is nothing to judge the
    others by, and all of them stay as ``UNKNOWN``."""
    columns = [f"`{c}`" for c in keep]
    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    labelled = docs.where(F.col("lang").isNotNull() & letters).select("doc_id", "text", "lang")
    for learn, usual in ((~held_out(), held_out()), (F.lit(True), F.lit(True))):
        sample = sample_windows(labelled.where(learn))
        net = trained(*sample)
        if net is None:
            continue
        pairs = byte_pairs(*sample)
        low, middle = likeness(labelled.where(usual), net, pairs, ["doc_id"]).agg(F.percentile_approx("like", [0.01, 0.5], 10_000)).first()[0] or (None, None)
        if low is not None:
            like = (F.col("like") * F.col("n_bytes") + LIKE_PRIOR * middle) / (F.col("n_bytes") + LIKE_PRIOR)
            return likeness(docs.where(letters), net, pairs, keep).where(like >= middle - max(REJECT * (middle - low), LEAST_MARGIN)).select(*columns, "lang_pred")
    return docs.where(letters).select(*columns, F.lit(UNKNOWN).alias("lang_pred"))


def learn_and_predict(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Train on the documents that aren't held out, then predict all."""
    return predict(docs, train(docs.where(~held_out()).select("doc_id", "text", "lang")), keep)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, by its whole text."""
    docs = table(spark, sf_dir, "documents")
    flagged = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    out = learn_and_predict(flagged, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")
