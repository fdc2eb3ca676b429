"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each on all that its predecessor kept.  A stage takes (spark,
docs, sf_dir); all but the last return the columns of documents.  ``run``
writes every stage's result as Parquet in the shared checkpoint folder and
reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import same_document, stored, table, text_or_empty
from touchline.llm.decontam import MATCH, contaminated
from touchline.llm.langid import recognised
from touchline.llm.neardup import near_duplicates
from touchline.llm.packing import pack
from touchline.llm.substring import remove_repeats

#: near-duplicates in the pipeline: five words a shingle
SHINGLE = 5


def whole_rows(docs: DataFrame) -> DataFrame:
    """row (all columns), doc_id, body: what other results join on."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("body"),
    )


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identify each document's language with op8's network and drop documents in
    none of the labelled ones."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "lang")
    return recognised(rows, ["row"]).select("row.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, once; documents without an id stay."""
    kept = near_duplicates(docs, shingle=SHINGLE).where("kept").select("doc_id", "body").distinct()
    rows = whole_rows(docs)
    joined = rows.join(kept, same_document(rows, kept)).select("row", rows["doc_id"], rows["body"])
    nth = F.row_number().over(Window.partitionBy("doc_id", "body").orderBy(F.lit(0)))
    return joined.withColumn("nth", nth).where("nth = 1 or doc_id is null").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages that occur earlier; documents that lose all their
    words go, those that lose none keep their text as it is."""
    out = remove_repeats(docs, keep_spacing=True).where((F.col("n_removed") == 0) | (F.col("kept") != ""))
    changed = F.col("n_removed") > 0
    columns = {
        "text": F.col("kept"),
        "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None,
    }
    return out.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item; one too short to be told from
    common words (fewer than ``MATCH`` tokens) counts where it is half of the document."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).where((F.col("n_tokens") >= MATCH) | (2 * F.col("n_tokens") >= F.col("n_words")))
    leaks = stored(found.select("doc_id", "body").distinct(), "leaks")
    rows = whole_rows(docs)
    return rows.join(leaks, same_document(rows, leaks), "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in the sequences."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicate", near_duplicate),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("packing", packing),
]

#: tests/llm/test_pipeline.py holds every stage and the whole run against what is
#: known of planted documents
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
