"""The corpus pipeline: language ID, quality, exact dedup, SimHash near-dedup, packing.

Every stage takes the documents that its predecessor kept and returns those that it keeps, with the same columns;
the last one packs them. Each stage numbers its rows once, in a table that it writes, and tells them apart by that
number: documents that share an id are judged each on its own, and the input may be any DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm import langid, quality
from tallyguard.llm.exact import exact_groups
from tallyguard.llm.packing import pack
from tallyguard.llm.simhash import simhash_groups
from tallyguard.session import scratch_path, stage

#: A document goes if the share of its letter n-grams that is of its best language is less than this part of the
#: share that the language's own texts reach.
LEAST_LANGUAGE = 0.3
ROW = "_pipeline_row"

#: Languages, labels and fingerprints can't be stated in SQL.
ORACLE_SQL = None


def _keep(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose number is in ``kept``, without the number."""
    return rows.join(kept.select(ROW), ROW, "left_semi").drop(ROW)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, written, so that every later pass sees the same numbers."""
    numbered, path = docs.withColumn(ROW, F.monotonically_increasing_id()), scratch_path(docs.sparkSession, "numbered")
    numbered.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(numbered.schema).parquet(path)


def _ordered(rows: DataFrame) -> DataFrame:
    """Texts under (id, number), NULL ids last: what decides which row of a group stays."""
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col(ROW).alias("row"))
    return rows.select(order.alias("order"), "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known. NULL texts, texts without letters and strange ones go."""
    rows = _numbered(docs)
    found = langid.identify(rows, id_col=ROW, relative=True)
    return _keep(rows, found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of the documents here, finds good.

    Where none of them has a label 0 or 1, nothing can be learnt and every document is kept.
    """
    rows = _numbered(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality").cast("double").isin(0.0, 1.0))
    labels = stage(rows.select("doc_id", ROW).join(labels.select("doc_id", "quality"), "doc_id"), "labels")
    if labels.isEmpty():
        return rows.drop(ROW)
    found = quality.classify(rows, labels, id_col=ROW, label_id=ROW)
    return _keep(rows, found.where("predicted = 1"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    rows = _numbered(docs)
    kept = exact_groups(_ordered(rows), id_col="order").where("kept")
    return _keep(rows, kept.select(F.col("order.row").alias(ROW)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    rows = _numbered(docs)
    kept = simhash_groups(_ordered(rows), id_col="order").where("component_id = order")
    return _keep(rows, kept.select(F.col("order.row").alias(ROW)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("quality", good),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
