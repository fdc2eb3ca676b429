"""Best-fit packing of tokenized documents, planned on a length histogram.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (one row a length, so at most ``capacity``
rows) reaches the driver.  Best-fit decreasing runs there over counts: a step
places all pieces of one length into a run of equally filled sequences, and
the plan keeps the step, not the pieces.  The pieces then get a rank within
their length and take their planned place by a join on length and rank.

Ranks are counted in two levels, (length, bucket) and then the buckets of a
length, so a length that a third of all pieces share is not one task's work.

Defined cases: a null text is an empty one and gives a piece of the end token
alone; repeated rows are packed as separate documents; an empty table gives no
rows; only longer documents are cut, their first piece being the short one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, chunks, shuffle_parts, stored, table, text_or_empty

by_value(__name__)

CAPACITY = 1024
END = 2
#: bytes of text that are encoded at a time
ENCODE_BYTES = 4 << 20
#: encoded fragments and their ids that a task keeps (about 50 MB); more are
#: encoded anew
WORDS_KEPT = 600_000
IDS_KEPT = 8_000_000
#: words that are encoded as one string
RUN = 100
#: pieces that leave a task at a time
EMIT_PIECES = 1 << 14

#: kinds of bytes: white space of one byte, bytes that the pattern may or may not
#: take for it, first bytes of the other white space of Unicode, ASCII letters, and
#: all other visible ASCII
WHITE, UNSURE, WIDE, LETTER, MARK = 1, 2, 4, 8, 16
KIND = np.zeros(256, np.uint8)
KIND[33:127] = MARK
KIND[[9, 10, 11, 12, 13, 32]] = WHITE
KIND[[28, 29, 30, 31]] = UNSURE
KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = WIDE
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND = KIND.tobytes()


def wide_spaces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes of white space that is no single byte; it can only begin at ``at``."""
    out = np.zeros(len(data), bool)
    if len(at):
        padded = np.append(data, np.zeros(2, np.uint8))
        x, y, z = data[at], padded[at + 1], padded[at + 2]
        two = (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
        three = ((x == 0xE1) & (y == 0x9A) & (z == 0x80)) | ((x == 0xE3) & (y == 0x80) & (z == 0x80)) | ((x == 0xE2) & (y == 0x81) & (z == 0x9F))
        three |= (x == 0xE2) & (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
        for k, found in enumerate((two | three, two | three, three)):
            out[at[found] + k] = True
    return out


def fragments(data: np.ndarray, offs: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Where the fragments of texts start, which are encoded apart.

    The vocabulary's pattern begins a pre-token at every run of white space and
    at a mark or digit after a letter, and one behind a single white character that
    isn't a space; it looks ahead only to tell white space.  A text that
    holds a special string is one fragment."""
    start = np.zeros(len(data) + 1, bool)
    kind = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
    white = (kind & WHITE) != 0
    any_white = ((kind & (WHITE | UNSURE)) != 0) | wide_spaces(data, np.flatnonzero(kind & WIDE))
    start[1:-1] = white[1:] & ~any_white[:-1]
    start[2:-1] |= (white & (data != 32))[1:-1] & ~any_white[:-2] & ~any_white[2:]
    letter = kind == LETTER
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    start[1:-1] |= (kind[1:] == MARK) & letter[:-1]
    for s in special:
        raw, at = data.tobytes(), -1
        while (at := raw.find(s, at + 1)) >= 0:
            row = np.searchsorted(offs, at, side="right") - 1
            start[offs[row] : offs[row + 1]] = False
    start[offs] = True
    return np.flatnonzero(start[:-1])


class WordEncoder:
    """Token ids of whole texts.

    Texts are cut where this byte-level vocabulary always begins a new pre-token
    (:func:`fragments`), so each distinct fragment is encoded once; all others are
    found by Arrow's dictionary encoding and numpy.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        first = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.opens = np.fromiter((t.startswith("Ġ") for t in first), dtype=bool, count=size)
        #: the same vocabulary and merges without the pattern
        self.merger = Tokenizer(self.tokenizer.model)
        self.feed = self.tokenizer.token_to_id("Ċ")
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.ends = np.zeros(1, np.int64)

    @property
    def codes(self) -> list[str]:
        """The fragments kept, in order of their codes."""
        return self.words.to_pylist()

    def whole_ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def whole(self, text: str) -> bytes:
        return self.whole_ids(text).tobytes()

    def letter_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of fragments that are one pre-token each, and how many each has.

        They are merged as one string with a line feed behind each.  If every line
        feed stays a token of its own, no merge went past a word's end; else none
        are given."""
        if not len(words) or self.feed is None:
            return None
        ended = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        ends = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
        data = np.frombuffer(ended.buffers()[2], np.uint8)
        got = []
        for at in range(0, len(words), RUN):
            run = BYTE_SIGNS[data[ends[at] : ends[min(at + RUN, len(words))]]].tobytes().decode("utf-32-le")
            got += self.merger.encode_batch_fast([run], add_special_tokens=False)[0].ids
        ids = np.asarray(got, dtype="<u4")
        feeds = np.flatnonzero(ids == self.feed)
        if len(feeds) != len(words):
            return None
        return ids[ids != self.feed], np.diff(feeds, prepend=-1) - 1

    def learn(self, words: pa.Array) -> np.ndarray:
        """Encode new fragments and give their codes.  Fragments of letters go through
        the merges alone; of the others, plain words are encoded a run at a time, where
        an id that opens with a space marks where the next word starts."""
        simple = pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False)
        bare = self.letter_ids(words.filter(pa.array(simple)))
        if bare is None:
            simple[:] = False
            bare = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        left = np.flatnonzero(~simple)
        texts = words.take(pa.array(left)).to_pylist()
        is_plain = np.fromiter((_PLAIN.fullmatch(w) is not None and not any(s in w for s in self.special) for w in texts), bool, len(texts))
        plain = [texts[i] for i in np.flatnonzero(is_plain)]
        ids, counts = [self.ids, bare[0]], [bare[1]]
        for at in range(0, len(plain), RUN):
            run = plain[at : at + RUN]
            encoded = self.tokenizer.encode_batch_fast(["".join(run)], add_special_tokens=False)[0]
            got = np.asarray(encoded.ids, dtype="<u4")
            starts = np.flatnonzero(self.opens[got])
            if len(starts) == len(run) and starts[0] == 0:
                ids.append(got)
                counts.append(np.diff(starts, append=len(got)))
            else:
                each = [self.whole_ids(w) for w in run]
                ids += each
                counts.append([len(x) for x in each])
        each = [self.whole_ids(texts[i]) for i in np.flatnonzero(~is_plain)]
        counts.append([len(x) for x in each])
        self.ids = np.concatenate(ids + each)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(counts).astype(np.int64))])
        order = np.concatenate([np.flatnonzero(simple), left[is_plain], left[~is_plain]])
        code = np.empty(len(words), np.int64)
        code[order] = len(self.words) + np.arange(len(words))
        self.words = pa.concat_arrays([self.words, words.take(pa.array(order))])
        return code

    def known(self, words: pa.Array) -> np.ndarray:
        """The codes of distinct fragments, new ones learned."""
        code = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(code < 0)
        if len(self.words) + len(new) > WORDS_KEPT or len(self.ids) > IDS_KEPT:
            self.forget()
            new = np.arange(len(words))
        if len(new):
            code[new] = self.learn(words.take(pa.array(new)))
        return code

    def encode_bytes(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (their bytes and offsets) and how many each has."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offs) - 1, np.int64)
        at = fragments(data, offs, [s.encode() for s in self.special])
        edges = np.append(at, len(data)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        code = self.known(coded.dictionary)[coded.indices.to_numpy()]
        first = self.ends[code]
        count = np.diff(self.ends)[code]
        done = np.cumsum(count)
        ids = self.ids[np.repeat(first + count - done, count) + np.arange(done[-1])]
        upto = np.concatenate([[0], done])[np.searchsorted(at, offs)]
        return ids, np.diff(upto)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit bytes."""
        raw = [t.encode() for t in texts]
        offs = np.cumsum([0, *map(len, raw)])
        ids, count = self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), offs)
        return [x.tobytes() for x in np.split(ids, np.cumsum(count)[:-1])] if texts else []


#: a fragment that is a space and a word
_PLAIN = re.compile(r" \S+")
#: Latin, Greek and Cyrillic letters with or without a space: one pre-token
_LETTERS = "^ ?[A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁҊ-ԓ]+$"


def byte_signs() -> np.ndarray:
    """The character by which a byte-level vocabulary writes each byte: its own if
    that is visible, else one from U+0100 on."""
    seen = np.zeros(256, bool)
    seen[33:127] = seen[161:173] = seen[174:] = True
    return np.where(seen, np.arange(256), 255 + np.cumsum(~seen)).astype("<u4")


BYTE_SIGNS = byte_signs()


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        for batch, data, offs in chunks(batches, "text", ENCODE_BYTES):
            ids, count = encoder.encode_bytes(data, offs)
            size = count + 1
            last = np.cumsum(size) - 1
            tokens = np.full(last[-1] + 1, end, "<u4")
            inside = np.ones(len(tokens), bool)
            inside[last] = False
            tokens[inside] = ids
            many = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            head = (size - (many - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            edges = np.concatenate([[0], np.cumsum(length)])  # pieces lie one after another
            for a in range(0, len(doc), EMIT_PIECES):
                b = min(a + EMIT_PIECES, len(doc))
                raw = [None, pa.py_buffer(((edges[a : b + 1] - edges[a]) * 4).astype(np.int32)), pa.py_buffer(tokens[edges[a] : edges[b]])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc[a:b])),
                        pa.array(piece[a:b], pa.int32()),
                        pa.array(start[a:b], pa.int64()),
                        pa.array(length[a:b], pa.int64()),
                        pa.Array.from_buffers(pa.binary(), b - a, raw),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    A step (length, rank_from, rank_to, sequence, each, offset): the pieces of
    this length with ranks in [rank_from, rank_to) go ``each`` to a sequence,
    to consecutive sequences from ``sequence`` on, from ``offset`` on.
    """
    steps: list[tuple[int, int, int, int, int, int]] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
    made = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r, runs in open_runs.items() if r >= length and runs), default=None)
            if room is None:
                room, per = capacity, capacity // length
                first, n = made, -(-left // per)
                made += n
            else:
                first, n = open_runs[room].pop()
                per = room // length
            whole = min(n, left // per)
            for bins, each in ((whole, per), (1 if n > whole and left - whole * per else 0, left - whole * per)):
                if bins:
                    steps.append((length, rank, rank + bins * each, first, each, capacity - room))
                    open_runs.setdefault(room - each * length, []).append((first, bins))
                    rank, left = rank + bins * each, left - bins * each
                    first, n = first + bins, n - bins
            if n:
                open_runs.setdefault(room, []).append((first, n))
    return steps


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any other columns) with
    ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    buckets = shuffle_parts(spark)
    kept = stored(pieces.withColumn("_bucket", F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int")), "pieces")
    counts = kept.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = (
        kept.withColumn("_row", F.row_number().over(inside) - 1)
        .join(base, ["length", "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_row"))
    )
    # the plan grows with the number of lengths, not of pieces
    steps = spark.createDataFrame(
        [(a, b, c, d, e, f) for a, b, c, d, e, f in plan(histogram, capacity)],
        "_length long, _from long, _to long, _sequence long, _each long, _offset long",
    )
    taken = ranked.join(
        F.broadcast(steps),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    nth = F.col("_rank") - F.col("_from")
    return taken.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and ids: the packed sequences themselves, from placed pieces
    that still carry their ids.  A sequence holds ``capacity`` tokens at most."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda all_, part: F.concat(all_, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Placed pieces of ``docs`` with the checksum of their ids."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = cut(docs, tokenizer_path, capacity)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(digests, capacity)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))
