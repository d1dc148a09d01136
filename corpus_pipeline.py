"""A training-data pipeline: documents of low quality go, near copies go, leaked benchmarks go, personal data is
masked, and what is left is packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it wrote. Rows may have
null ids or texts, repeated ids and more columns; each stage says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.llm import bootstrap_pii, knn_quality, partenum, template_leaks, two_fit_packing
from postsignal.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows that the nearest-neighbour vote scores at the threshold or above; null texts count as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = knn_quality.with_quality(docs, knn_quality.fit(docs, labels), "quality score of the row")
    return scored.filter(F.col("quality score of the row") >= knn_quality.THRESHOLD).select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row key``, a hash of id and text: rows that share an id, or have none, differ by it."""
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    return docs.withColumn("row key", key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of similar documents, that with the smallest id; one without an id is the last choice.

    Rows of one id and text are copies, of which one stays; different texts under one id are different documents.
    """
    keyed = _keyed(docs)
    groups = partenum.similar_groups(keyed.select(F.col("row key").alias("doc_id"), "text"))
    groups = staged(groups.select(F.col("doc_id").alias("row key"), "component_id").distinct(), "groups")
    ids = keyed.select("row key", F.col("doc_id").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row key"))
    chosen = groups.join(ids, "row key").groupBy("component_id").agg(first.alias("first")).select("first.row key")
    kept = keyed.join(chosen, "row key", "left_semi")
    repeated = staged(keyed.groupBy("row key").count().filter("count > 1").select("row key"), "repeated")
    once = kept.join(repeated, "row key", "left_semi").dropDuplicates(["row key"])
    return kept.join(repeated, "row key", "left_anti").unionByName(once).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold a benchmark item; each row is judged by its own text."""
    keyed = _keyed(docs)
    found = template_leaks.leaks(
        keyed.select(F.col("row key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    leaked = found.select(F.col("doc_id").alias("row key")).distinct()
    return keyed.join(leaked, "row key", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in every text; all rows stay."""
    return bootstrap_pii.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts with their places in sequences; a null text is the end token alone."""
    return two_fit_packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Tokens, votes and bootstrapped patterns have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
