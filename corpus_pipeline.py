"""A training corpus from raw documents: quality, repeated lines, near copies, benchmark passages, packing.

Each stage gets the rows that the one before kept and returns the columns of ``documents``; the last returns the packed pieces. A stage
that shortens texts keeps ``n_chars`` right. Copies are judged after repeated lines are gone, as they are then what differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm.decontamination import decontaminate
from urbanweave.llm.jaccard import near_groups, without_copies
from urbanweave.llm.lines import drop_repeated_lines
from urbanweave.llm.packing import pack
from urbanweave.llm.quality import fit, keep_good
from urbanweave.llm.queries import held_out, tokenizer_file
from urbanweave.llm.shared import prepare, saved


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; one fold of the labels is left for judging it."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit(docs, labels, learn=lambda doc: ~held_out(doc, 0)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a document of smaller id holds."""
    prepare(spark)
    return _recounted(drop_repeated_lines(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    prepare(spark)
    return without_copies(docs, near_groups(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    prepare(spark)
    return _recounted(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    prepare(spark)
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: SQL can't train the classifier; the tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
