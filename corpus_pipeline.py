"""From raw documents to packed sequences: five stages, each stored before the next one reads it.

Each stage takes (spark, docs, sf_dir) and all documents that the one before kept; all but the last return
the columns of documents. Learned stages take their labels from the tables in sf_dir.

Rules: a document that a classifier rejects goes; NULL and empty texts are classified like others. A document is
an id and a text (known by 64 bits of their hash): rows that share both become one, and rows that share an id alone
are documents apart. Of each group of near-duplicates the document with the smallest id stays; those without an id
come last. A document that the mix takes several times is there as often, and one that it does not
take goes. Extra columns pass through all but the last stage, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.llm import mixing, packing, shingles
from riskmill.llm.quality import quality_score
from riskmill.llm.queries import quality_model, toxicity_model
from riskmill.llm.store import shared_folder, small_batches
from riskmill.llm.toxicity import toxicity_score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    small_batches(spark)
    return docs.filter(toxicity_score(toxicity_model(spark, sf_dir, docs), F.col("text")) < 0.5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality."""
    small_batches(spark)
    return docs.filter(quality_score(quality_model(spark, sf_dir, docs), F.col("text")) >= 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    small_batches(spark)
    mark = "mark"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.xxhash64("doc_id", "text"))  # a document is an id and a text
    groups = shingles.similar_documents(marked, mark, "text", n=5, percent=80).select(mark, "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(mark)))
    kept = groups.join(marked.select(mark, "doc_id").distinct(), mark).groupBy("component_id").agg(first.alias("kept"))
    kept = kept.select(F.col(f"kept.{mark}").alias("kept"))
    return marked.join(kept, marked[mark] == kept["kept"], "left_semi").dropDuplicates([mark]).drop(mark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    text = F.col("text")
    return mixing.mixed_documents(docs, "doc_id", "source", mixing.word_count(text), mixing.text_quality(text))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their places in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs, "doc_id", "text", packing.tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: Learned stages and tokens have no SQL; the tests hold the operators against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
