"""Language identification, nearest neighbours, scores, licenses and chat
formatting."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.llm import ann, chat, langid, licenses, lm_score

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score int, lang_pred string"


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = langid.op8_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    rows = [(i, ("das ist ein haus " if i % 2 else "this house is the one ") * (1 + i % 7), "de" if i % 2 else "en", 0, "x") for i in range(40)]
    rows += [(100, None, "en", 0, "x"), (101, "", None, 0, "x"), (102, "123 !?", "de", 0, "x"), (103, "das ist " * 20_000, None, 0, "x"), (None, "das ist ein", None, 0, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    out = langid.learn_and_predict(docs.select("doc_id", "text", "lang"), ["doc_id"]).collect()
    by_id = {r.doc_id: r for r in out}
    assert [by_id[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by_id[100].score == 0
    assert by_id[103].lang_pred == by_id[None].lang_pred == "de"
    none = langid.learn_and_predict(docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")), ["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.learn_and_predict(docs.limit(0).select("doc_id", "text", "lang"), ["doc_id"]).count() == 0


def test_window_cutting():
    data = np.arange(1, 301, dtype=np.int64).astype(np.uint8)
    x, doc, used = langid.cut_windows(data, np.array([0, 0, 10, 300]))
    assert doc.tolist() == [1, 2, 2, 2] and used.tolist() == [10, 128, 128, 34]
    assert x[0, :10].tolist() == data[:10].tolist() and not x[0, 10:].any() and x[3, :34].tolist() == data[266:].tolist()


def test_windows_are_predicted_by_convolution():
    """The lookup form against filters moved over the window place by place."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (langid.BLOCK + 9, langid.WINDOW)).astype(np.uint8)
    x[3, 5:] = 0
    net = langid.fit(x[:300], rng.integers(0, 3, 300), ["a", "b", "c"])
    got = langid.predict_windows(net, langid.lookup_tables(net), x)
    for k in [0, 3, 17, langid.BLOCK - 1, langid.BLOCK, len(x) - 1]:
        e = net.embed[x[k]].astype(float)
        pooled = []
        for f, b in zip(net.filters, net.bias, strict=True):
            places = [np.einsum("we,wef->f", e[i : i + len(f)], f) + b for i in range(langid.WINDOW - len(f) + 1)]
            pooled.append(np.max(np.maximum(places, 0), axis=0))
        z = np.concatenate(pooled) @ net.out + net.out_bias
        np.testing.assert_allclose(got[k], np.exp(z - z.max()) / np.exp(z - z.max()).sum(), atol=1e-4)


def test_documents_take_the_mean_of_their_windows(spark):
    """A long text's score: the mean over its windows, weighted by their bytes."""
    rows = [(i, ("das ist ein haus " if i % 2 else "this house is the one ") * 9, "de" if i % 2 else "en") for i in range(30)]
    docs = spark.createDataFrame([*rows, (50, "das ist " * 40 + "this house " * 17, None)], "doc_id long, text string, lang string")
    net = langid.train(docs)
    got = langid.predict(docs.where("doc_id = 50"), net, ["doc_id"]).first()
    raw = ("das ist " * 40 + "this house " * 17).encode()
    cut = [raw[i : i + langid.WINDOW] for i in range(0, len(raw), langid.WINDOW)]
    x = np.stack([np.frombuffer(c.ljust(langid.WINDOW, b"\0"), np.uint8) for c in cut])
    mean = np.average(langid.predict_windows(net, langid.lookup_tables(net), x), axis=0, weights=[len(c) for c in cut])
    assert got.lang_pred == net.langs[mean.argmax()] and abs(got.score - mean.max()) < 1e-5


def brute_neighbours(ids, x, q, k=10):
    out = {}
    for own in q:
        d = np.sqrt(((x - x[ids == own][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:k]
        out[own] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_nearest_neighbours_recall(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    rows = ann.search(spark.read.parquet(f"{SF}/embeddings.parquet"), F.col("vec_id") % 5 == 0).collect()
    truth = brute_neighbours(ids, x, ids[ids % 5 == 0])
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(truth)
    assert sum(len(set(got[q]) & set(truth[q])) for q in truth) / sum(map(len, truth.values())) >= 0.9
    assert all(v == sorted(v, key=lambda p: (p[1], p[0])) for v in got.values())


def test_nearest_neighbours_odd_rows(spark, monkeypatch):
    """A hot vector, ties, and vectors that take no part; leaves in blocks."""
    monkeypatch.setattr(ann, "ROW_BLOCK", 30)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rng = random.Random(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [rng.random() for _ in range(3)], 0) for i in range(300)]
    bad = [(900, None, 0), (1000, [0.0, 0.0, 0.0], 0), (1100, [1.0, None, 2.0], 0), (1200, [1.0, float("nan"), 2.0], 0), (1300, [1.0, float("inf"), 0.0], 0), (1400, [1.0], 0), (None, [1.0, 1.0, 1.0], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, q int")
    out = ann.search(df, F.col("vec_id") % 50 == 0).collect()
    x = np.array([np.float32(r[1]) for r in rows], float)
    truth = brute_neighbours(np.arange(300), x, [q for q in range(0, 300, 50)])
    got = {q: [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q] for q in truth}
    assert {r.query_id for r in out} == set(truth)
    assert all(got[q] == truth[q] for q in truth if q % 3)  # the hot vector: all at distance 0, smallest ids first
    few = ann.search(df.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r.rank)] == [v for v, _ in brute_neighbours(np.arange(4), x[:4], [0])[0]]
    assert ann.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_nearest_neighbours_repeated_ids(spark, monkeypatch):
    """A row's twin, equal to it or not, is a candidate; the row itself isn't.
    One id holds a third of the rows and its leaf is split into blocks."""
    monkeypatch.setattr(ann, "ROW_BLOCK", 20)
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(50)) + 1, 1.0]) for i in range(200)]
    rows += [(100, [rows[100][1][0], 1.25]), (50, rows[50][1])] + [(7, [3.0, 1.0 + i / 128]) for i in range(100)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, leaf int, v int")
    asked = {0, 50, 100, 7}
    out = ann.search(df, F.col("vec_id").isin(*asked)).collect()
    for q in asked:
        own = min(v for i, v in rows if i == q)
        others = list(rows)
        others.remove((q, own))
        want = sorted((math.dist(v, own), i) for i, v in others)[:10]
        got = [(r.score, r.vec_id) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q]
        assert got == want


def test_sample_is_thinned_by_hash(spark):
    rows = spark.range(5000).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("v"))
    key = F.xxhash64(F.lit("sample"), "vec_id", "v")
    want = [r["vec_id"] for r in rows.where(F.pmod(key, F.lit(1 << 30)) < F.lit((200 << 30) // 5000)).orderBy(key).limit(100).collect()]
    assert ann.smallest_hashes(rows, 100, 5000, "sample").column("vec_id").to_pylist() == want
    alike = spark.range(5000).select(F.lit(3).cast("long").alias("vec_id"), F.array(F.lit(1.0)).alias("v"))
    assert ann.smallest_hashes(alike, 100, 5000, "sample").num_rows == 100


def test_best_bin_first_visits_every_leaf_once():
    x = np.array([[random.Random(i).gauss(0, 1) for _ in range(4)] for i in range(600)])
    tree = ann.grow(x, 4, 20)
    for q in x[:5]:
        order = list(ann.best_bins(tree, q))
        assert sorted(order) == list(range(tree.leaves))
        assert order[0] == ann.leaf_of(tree, q[None])[0]


def test_scores_know_every_word_and_bigram(spark):
    """Words and bigrams seen once among 400,000 words, in several parts."""
    rng = random.Random(8)
    docs = [(i, "the cat sat on a mat " * 22_000) for i in range(3)]
    docs += [(i, " ".join(rng.choice(["the", "cat", "mat", f"w{rng.randrange(300)}", f"Rare{i}"]) for _ in range(30))) for i in range(3, 40)]
    docs += [(40, None), (None, "the cat rareX"), (None, "the cat rareX"), docs[5]]
    targets = {1, 4, 5, 6, 7}
    texts = [(i, [w.lower() for w in (t or "").split()]) for i, t in docs]
    models = []
    for rows in ([t for i, t in texts if i in targets], [t for _, t in texts]):
        pairs = Counter(p for t in rows for p in zip(["", *t], t))
        words, contexts = Counter(), Counter()
        for (a, w), n in pairs.items():
            words[w] += n
            contexts[a] += n
        models.append((pairs, words, contexts, sum(words.values())))
    kinds = len(models[1][1]) + 1

    def loss(m, a, w):
        pairs, words, contexts, total = m
        known = lm_score.WEIGHT if contexts[a] else 0
        return -math.log((1 - known) * (words[w] + 1) / (total + kinds) + known * pairs[a, w] / max(contexts[a], 1))

    want = []
    for i, t in texts:
        t_loss, b_loss = (sum(n * loss(m, *p) for p, n in Counter(zip(["", *t], t)).items()) / max(len(t), 1) for m in models)
        want.append((-1 if i is None else i, len(t), t_loss, b_loss, t_loss - b_loss))
    ids = spark.createDataFrame([(i,) for i in [*targets, 5, None]], "doc_id long")
    rows = lm_score.score(spark.createDataFrame([(i, t, "x", 1, "") for i, t in docs], DOCS), ids).collect()
    assert [r.n_words for r in rows if r.doc_id == 40] == [0] and all((r.score is None) == (r.n_words == 0) for r in rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, *(x or 0 for x in r[2:])) for r in rows)
    assert np.allclose(got, sorted(want), atol=1e-9)
    none = lm_score.score(spark.createDataFrame([], DOCS), ids)
    assert none.count() == 0
    frame = spark.createDataFrame([(i, t, "x", 1, "") for i, t in docs[3:9]], DOCS)
    untargeted = lm_score.score(frame, ids.limit(0)).collect()
    assert len(untargeted) == 6 and all(math.isfinite(r.score) for r in untargeted)


def brute_licenses(docs, templates, stride):
    def tokens(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    found = {}
    for i, t in docs:
        w = tokens(t)
        for name, notice in templates:
            n = tokens(notice)
            want = {tuple(n[j : j + 3]) for j in range(len(n) - 2)}
            for at in range(0, max(len(w), 1), stride):
                part = w[at : at + 2 * stride]
                have = {tuple(part[j : j + 3]) for j in range(len(part) - 2)}
                share = len(want & have) / len(want)
                if share >= licenses.CONTAINED:
                    found[i, name] = max(found.get((i, name), 0), share)
    return found


def test_licenses_equal_brute_force(spark):
    rng = random.Random(6)
    docs = []
    for i in range(60):
        w = [f"w{rng.randrange(99)}" for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(licenses.TEMPLATES)[1].split()
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = "changed"
            w[(at := rng.randrange(len(w) + 1)) : at] = notice
        docs.append((i, " ".join(w)))
    docs += [(60, None), (61, ""), (62, "released under"), docs[0], (63, "RELEASED -- under, the\nMIT (license)" * 2000)]
    stride = max(len(re.findall(r"[^\W_]+", t)) for _, t in licenses.TEMPLATES)
    rows = licenses.scan(spark.createDataFrame([(i, t, "x", 1, "") for i, t in docs], DOCS)).collect()
    got = {(r.doc_id, r.license): r.containment for r in rows}
    assert len(rows) == len(got) and got == brute_licenses(docs, licenses.TEMPLATES, stride)
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_bands_guarantee():
    b = licenses.bands_for()
    assert 1 - (1 - licenses.SIMILAR) ** b >= licenses.CHANCE > 1 - (1 - licenses.SIMILAR) ** (b - 1)


CONV = "conv_id long, turn long, role string, text string, example int, formatted string"


@given(st.text(alphabet="\\ns<>/[]INST \n", max_size=30), st.text(alphabet="\\n<s>x\n", max_size=8))
@settings(max_examples=300, deadline=None)
def test_pieces_read_back(text, role):
    def escaped(t):
        t = t.replace("\\", "\\\\")
        for c in chat.CONTROLS:
            t = t.replace(c, c[0] + "\\" + c[1:])
        return t

    body = escaped(text)
    assert not any(c in body for c in chat.CONTROLS)
    for inner in (body, chat.OPEN + body + chat.CLOSE):
        head = escaped(role).replace("\n", "\\n")
        assert chat.parse_piece(f"<s>{head}\n{inner}</s>") == (role, text)


def test_chat_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "system", "be \\n kind"), (1, 1, "user", said), (1, 2, "assistant", said), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye"),
        (2, 0, "user", "only"), (3, 5, "assistant", "a\n\\b"), (3, 5, "assistant", "a\n\\b"), (None, 0, None, "x"), (None, None, "assistant", "y"), (4, 0, "a\nb<s>", "z" * 100_000),
    ]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], CONV)
    got = {r.conv_id: r for r in chat.digest(chat.format_turns(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        x = got[conv]
        assert (x.n_turns, x.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (x.loss_chars, x.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.format_turns(df.limit(0))).count() == 0
    examples = sorted(chat.example_texts(chat.format_turns(df.where("conv_id = 1"))).collect(), key=lambda r: r.example)
    assert [r.example for r in examples] == [0, 1]
    assert [chat.unescape(r.text[r.loss_start : r.loss_end]) for r in examples] == [said, ""]
    assert examples[1].text.startswith(examples[0].text) and examples[0].text.count("[INST]") == 2


def test_chat_digests_come_from_written_examples(spark, monkeypatch):
    """One whole example an assistant turn, and results that follow from these alone."""
    rows = [(1, i, "assistant" if i % 3 else "user", f"turn {i} <s>") for i in range(8)] + [(1, 8, "user", "bye"), (2, 0, "user", "alone")]
    rows += [(3, i, "assistant", "long " * 50_000) for i in range(12)]
    formatted = chat.format_turns(spark.createDataFrame([(*r, 0, "") for r in rows], CONV))
    whole, want, rest = {}, [], {}
    for r in sorted(formatted.collect(), key=lambda r: (r.conv_id, r.seq)):
        rest[r.conv_id] = whole[r.conv_id] = whole.get(r.conv_id, "") + r.formatted
        if r.loss_start is not None:
            want.append((r.conv_id, r.example, whole[r.conv_id], r.loss_start, r.loss_end))
            del rest[r.conv_id]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, chat.example_texts(formatted).collect()), key=key) == want
    loose = [(c, sum(w[0] == c for w in want), t, None, None) for c, t in rest.items()]
    assert [c for c, *_ in loose] == [1, 2]
    assert sorted(map(tuple, chat.example_texts(formatted, rest=True).collect()), key=key) == sorted(want + loose, key=key)
    right = {r.conv_id: r for r in chat.digest(formatted).collect()}
    written = chat.example_texts
    monkeypatch.setattr(chat, "example_texts", lambda f, rest=False: written(f, rest).withColumn("loss_end", F.col("loss_end") - 1))
    cut = {r.conv_id: r for r in chat.digest(formatted).collect()}
    assert cut[1].loss_sha256 != right[1].loss_sha256 and cut[1].loss_chars == right[1].loss_chars - 5
    assert cut[2] == right[2]
    # a context that isn't the example before is an error
    lost = F.when(F.col("example") == 1, F.expr("substring(text, 9)")).otherwise(F.col("text"))
    monkeypatch.setattr(chat, "example_texts", lambda f, rest=False: written(f, rest).withColumn("text", lost))
    with pytest.raises(Exception, match="doesn't go on"):
        chat.digest(formatted).collect()
