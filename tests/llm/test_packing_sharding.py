"""Packing and sharding against direct computations."""

import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import packing, sharding

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, piece string, sequence_id int"

TEXTS = [
    (1, "one two  three\n four \t five", "x", 1),
    (2, None, None, None),
    (3, "", "", 0),
    (4, " lead and trail ", "", 0),
    (5, "special <|endoftext|> string's it''s 12 34", "", 0),
    (6, "naïve   été\n\n\nüber\r\nx\u00a0y z\u2003 w " * 30, "", 0),
    (7, "word " * 3000, "", 0),
    (7, "word " * 3000, "", 0),
    (None, "no id here", "", 0),
    (8, "a.\nB c", "", 0),
]


def packed_as_expected(rows, texts, capacity=1024):
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in texts:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % capacity or capacity
        edges = [0, *range(head, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(edges, edges[1:])):
            want[doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == want
    end = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end[r.sequence_id]
        end[r.sequence_id] += r.length
    assert not end or max(end.values()) <= capacity
    return end


def test_packing_small(spark):
    docs = spark.createDataFrame(TEXTS, DOCS)
    out = packing.pack(docs, PATH)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    packed_as_expected(out.collect(), TEXTS)


def test_packing_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_sequences_hold_their_pieces(spark):
    docs = spark.createDataFrame(TEXTS[:5], DOCS)
    placed = packing.place(packing.cut(docs, PATH, 16), 16)
    rows = placed.collect()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(map(len, whole.values())) == 4 * sum(r.length for r in rows)


@given(st.lists(st.text(alphabet=" \n\tab.é'1\u00a0", max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_word_encoder_equals_tokenizer(texts):
    encoder = packing.WordEncoder(PATH)
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def test_fragments_equal_tokenizer():
    """White space of every kind, marks, letters beyond ASCII, special strings."""
    rng = random.Random(4)
    parts = [" ", " ", " ", "\n", "\t", "\r\n", "\x1c", "\x85", "\u00a0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "\u180e", ".", ",", "!", "?", ";", ":", "'", "'s", "'re", "a", "Ab", "é", "×", "à", "ß", "1", "23", "“", "…", "€", "漢", "\u0301", "<|endoftext|>", "<|", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    encoder = packing.WordEncoder(PATH)
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]
    # marks and line feeds aren't part of words, so each word is learned once
    encoder.forget()
    encoder.encode(["The house. The house, the\nhouse", " The house!\nhouse; house"])
    assert set(encoder.codes) == {"The", " house", ".", " The", ",", " the", "\n", "house", "!", ";"}


class Counted:
    """A tokenizer that counts the characters given to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode(self, text, **kw):
        self.chars += len(text)
        return self.tokenizer.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_words_of_letters_skip_the_pattern():
    """New words of letters take the merges alone, whatever marks or digits follow."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZàéßœłΑάωЖя"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    texts = [" ".join(words[i : i + 30]) for i in range(0, 3000, 30)]
    encoder = packing.WordEncoder(PATH)
    want = [encoder.whole(t) for t in texts]
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    assert encoder.encode(texts) == want
    assert counted.chars == 0
    encoder.forget()
    encoder.encode(["one word&&& word### word12", " word***"])
    assert set(encoder.codes) == {"one", " word", "&&&", "###", "12", "***"}


def test_letters_of_the_pattern():
    """Every letter that skips the pattern is one to it."""
    encoder = packing.WordEncoder(PATH)
    simple = [c for c in map(chr, range(33, 0x600)) if re.fullmatch(packing._LETTERS, c)]
    assert len(simple) == 52 + 62 + 336 + 61 + 268
    for c in simple:
        assert [w for w, _ in encoder.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}a a{c}")] == [
            "".join(map(chr, packing.BYTE_SIGNS[list(w.encode())])) for w in (f"a{c}a", f" a{c}")
        ]


def test_encoder_where_line_feeds_merge(tmp_path):
    """A vocabulary that merges a line feed with letters: words can't share a string."""
    made = json.load(open(PATH))
    model = made["model"]
    model["merges"] = [["t", "Ċ"], ["Ċ", "Ġ"], *model["merges"]]
    for n, token in enumerate(("tĊ", "ĊĠ")):
        model["vocab"][token] = 60000 + n
    (tmp_path / "odd.json").write_text(json.dumps(made))
    encoder = packing.WordEncoder(str(tmp_path / "odd.json"))
    texts = ["that cat sat", " at it\n that", "naïve"]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def test_encoder_forgets(monkeypatch):
    """More fragments than are kept, over several calls."""
    monkeypatch.setattr(packing, "WORDS_KEPT", 20)
    encoder = packing.WordEncoder(PATH)
    for k in range(6):
        texts = [" ".join(f"w{chr(97 + (k * 7 + i) % 26)}x 漢{i}" for i in range(n)) for n in (3, 9, 0, 5)]
        assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def best_fit(lengths, capacity):
    """Best-fit decreasing, piece by piece: room of each sequence."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= x]
        if fits:
            rooms[min(fits)[1]] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@given(st.lists(st.integers(1, 32), max_size=80))
@settings(max_examples=200, deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    count = Counter(lengths)
    used, placed = {}, Counter()
    for length, a, b, first, each, offset in packing.plan(dict(count), 32):
        assert a == placed[length]
        placed[length] = b
        for rank in range(a, b):
            at = first + (rank - a) // each
            assert used.get(at, 0) == offset + (rank - a) % each * length
            used[at] = used.get(at, 0) + length
    assert placed == count
    assert sorted(32 - x for x in used.values()) == best_fit(lengths, 32)


def test_sharding_laws(spark, workdir):
    path = f"{workdir}/docs"
    texts = [(i % 40, f"text {i}" * (i % 50) if i % 9 else None, "p", i) for i in range(501)]
    spark.createDataFrame(texts, DOCS).write.parquet(path)
    shuffled = sharding.shuffle_records(spark.read.parquet(path), sharding.record_size(), bucket_bytes=2000)
    rows = shuffled.collect()
    assert sorted(r.position for r in rows) == list(range(501))
    assert Counter(tuple(r.record) for r in rows) == Counter(texts)
    assert [r.record.sequence_id for r in sorted(rows, key=lambda r: r.position)] != list(range(501))
    dealt = sharding.deal(shuffled, 7).collect()
    by_shard = Counter(r.shard for r in dealt)
    assert set(by_shard) == set(range(7)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    assert all(sorted(r.slot for r in dealt if r.shard == s) == list(range(n)) for s, n in by_shard.items())


def test_sharding_empty(spark, workdir):
    spark.createDataFrame([], DOCS).write.parquet(f"{workdir}/docs")
    shuffled = sharding.shuffle_records(spark.read.parquet(f"{workdir}/docs"), F.lit(1).cast("long"))
    assert shuffled.count() == 0


def test_written_shards(spark, workdir):
    spark.createDataFrame([(i, str(i), "", 0) for i in range(25)], DOCS).write.parquet(f"{workdir}/docs")
    dealt = sharding.deal(sharding.shuffle_records(spark.read.parquet(f"{workdir}/docs"), sharding.record_size()), 4)
    sharding.write_shards(dealt, f"{workdir}/shards")
    back = spark.read.parquet(f"{workdir}/shards").collect()
    assert sorted(r.record.doc_id for r in back) == list(range(25)) and {r.shard for r in back} == set(range(4))


def test_records_may_have_any_column(spark, workdir, monkeypatch):
    """Columns named as the operator's own, a record larger than a bucket, and
    bases joined by shuffle over several spans of buckets."""
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 1)
    monkeypatch.setattr(sharding, "SPAN", 3)
    names = "shard int, slot int, bucket int, record int, position int, place int, number int, bytes int, base int, text string"
    rows = [(*[i] * 9, "x" * (5000 if i == 7 else i % 30)) for i in range(200)]
    spark.createDataFrame(rows, names).write.parquet(f"{workdir}/docs")
    shuffled = sharding.shuffle_records(spark.read.parquet(f"{workdir}/docs"), sharding.record_size(), bucket_bytes=500)
    assert sorted(r.position for r in shuffled.select("position").collect()) == list(range(200))
    sharding.write_shards(sharding.deal(shuffled, 3), f"{workdir}/shards")
    back = spark.read.parquet(f"{workdir}/shards").collect()
    assert sorted(tuple(r.record) for r in back) == sorted(rows)
    assert sorted((r.shard, r.slot) for r in back) == sorted((i % 3, i // 3) for i in range(200))
