"""The corpus pipeline: its stages and the whole run."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import langid, neardup
from touchline.llm.common import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def junk():
    """Texts with letters in no learned language."""
    rng = random.Random(3)
    smash = ["".join(rng.choice("asdfghjklqwertyuiopzxcvbnm ;") for _ in range(rng.randrange(60, 900))) for _ in range(20)]
    noise = [bytes(rng.randrange(256) for _ in range(rng.randrange(60, 900))).decode("latin-1") + "x" for _ in range(20)]
    cyrillic = [" ".join("".join(chr(rng.randrange(0x430, 0x450)) for _ in range(rng.randrange(2, 9))) for _ in range(40)) for _ in range(20)]
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem "
    return [*smash, *noise, *cyrillic, polish * 3]


@pytest.mark.parametrize("langs", [1, 2, 4])
def test_language_rejects_what_was_not_learned(spark, langs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = ["de", "en", "es", "fr"][:langs]
    clean = docs.where(F.col("lang").isin(known))
    rows = [(100_000 + i, t, None, "x", len(t)) for i, t in enumerate(junk())]
    rows += [(200_000, None, None, "x", 0), (200_001, "12 !?", "en", "x", 5)]
    planted = spark.createDataFrame(rows, DOCS)
    mixed = clean.unionByName(planted.select(*[F.col(c).cast(clean.schema[c].dataType) for c in clean.columns]))
    out = corpus_pipeline.language(spark, mixed, "")
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert not {i for i in kept if i >= 100_000}
    assert kept == {r.doc_id for r in clean.select("doc_id").collect()}


def test_near_duplicate_takes_no_round_for_every_few_documents_of_a_group(spark, monkeypatch):
    """Documents that share a long line are one candidate group of different
    documents; copies among them go, in as many steps for any number of them."""
    rng = random.Random(12)
    line = " ".join(f"l{i}" for i in range(50))
    texts = [" ".join([line, *(f"w{i}x{j}" for j in range(14))]) for i in range(140)]
    texts += [t + " end" for t in rng.sample(texts, 20)]
    rows = [(i, t, "en", "x", len(t)) for i, t in enumerate(texts)]
    made, kept = [], neardup.stored
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 2000)
    monkeypatch.setattr(neardup, "stored", lambda df, name: made.append(name) or kept(df, name))
    out = corpus_pipeline.near_duplicate(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r.doc_id for r in out.collect()) == list(range(140))
    assert made.count("links") <= 4, made


def test_language_is_the_networks(spark, monkeypatch):
    """The stage judges a text by the language that op8's network names."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    named = {r.doc_id: r.lang_pred for r in langid.learn_and_predict(docs.select("doc_id", "text", "lang"), ["doc_id"]).collect()}
    got = {r.doc_id: r.lang_pred for r in langid.recognised(docs.select("doc_id", "text", "lang"), ["doc_id"]).collect()}
    assert got == {i: x for i, x in named.items() if x != langid.UNKNOWN} and len(set(got.values())) > 1
    fitted = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    corpus_pipeline.language(spark, docs, "")
    assert len(fitted) == 1 and fitted[0].langs == sorted(set(got.values()))


def test_language_odd_tables(spark):
    rows = [(i, "das ist ein haus und ein garten " * (1 + i % 3), "de", "x", 9) for i in range(4)]
    docs = spark.createDataFrame([*rows, rows[0], (None, "ein haus", None, "x", 8)], DOCS)
    assert corpus_pipeline.language(spark, docs, "").count() == 6
    # nothing is known of any language: nothing is rejected but text without a letter
    unlabelled = spark.createDataFrame([*rows, (9, "12 34", "de", "x", 5)], DOCS).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unlabelled, "").count() == 4
    assert corpus_pipeline.language(spark, docs.limit(0), "").count() == 0


def words(rng, n):
    return [f"{rng.choice(['haus', 'garten', 'strasse', 'wasser', 'himmel', 'kinder', 'vogel'])}{rng.choice('abcdefghijklmnop')}{rng.choice('abcdefghijklmnop')}{rng.choice('aeiou')}" for _ in range(n)]


def test_every_stage_and_run(spark, tmp_path):
    """Planted rejects, copies, a repeated passage and a benchmark passage: every
    stage gives exactly what is known of them, and so does ``run``."""
    rng = random.Random(11)
    clean = {i: words(rng, 150) for i in range(60)}
    passage, item = words(rng, 40), words(rng, 30)
    expected = {i: " ".join(w) for i, w in clean.items()}
    clean[7] = [*clean[7][:50], *passage, *clean[7][50:]]
    clean[31] = [*clean[31][:90], *passage, *clean[31][90:]]
    clean[40] = [*clean[40][:20], *item, *clean[40][20:]]
    texts = {i: " ".join(w) for i, w in clean.items()}
    copies = {100: texts[3], 101: " ".join([*clean[5][:-1], "anders"])}
    rows = [(i, t, "de", "x", len(t)) for i, t in {**texts, **copies}.items()]
    rows += [(200 + i, t, None, "x", len(t)) for i, t in enumerate(junk()[:40])] + [(300, None, "de", "x", None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").limit(1)
    bench.withColumn("text", F.lit(" ".join(item))).write.parquet(f"{tmp_path}/benchmark.parquet")

    cleaned = {**texts, 31: expected[31]}
    want = {
        "language": {**texts, **copies},
        "near_duplicate": texts,
        "repeated_passages": cleaned,
        "benchmark": {i: t for i, t in cleaned.items() if i != 40},
    }
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        got = docs.select("doc_id", "text", "n_chars").collect()
        assert len(got) == len(want[name]) and {r.doc_id: r.text for r in got} == want[name], name
        assert all(r.n_chars == len(r.text) for r in got)
    # each document's ids and the end token
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in want["benchmark"].items()}
    for out in (corpus_pipeline.packing(spark, docs, str(tmp_path)), corpus_pipeline.run(spark, str(tmp_path))):
        pieces = Counter()
        for r in out.collect():
            pieces[r.doc_id] += r.length
        assert pieces == lengths
