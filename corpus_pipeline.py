"""A training-corpus pipeline over ``documents``: each stage works on what its predecessor kept, written as Parquet between.

Defined results: null texts and texts without letters are rejected by the first stage; texts are looked at whole, however long; every row
is judged by itself, also where rows share an id or have none; of rows with equal or near texts that with the smallest id stays, one
without an id only if none has one, and of equal ids the first in the table; further columns pass through all stages but the
last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, contamination, language, probminhash, quality
from millrace.llm.learning import unused
from millrace.llm.queries import vocabulary
from millrace.queries.registry import table
from millrace.session import delete_path, durable, scratch_path, ship_package, shuffles_removed

#: Times the score of chance, one over the number of languages, that a document must reach.
LEAST_ABOVE_CHANCE = 1.2
LEAST_QUALITY = 0.7


#: Rows of an Arrow batch; they carry whole texts.
BATCH_ROWS = 2000


def modest(spark: SparkSession) -> None:
    """The package on the executors, and batches of whole texts that leave room for the other stages in a worker that serves them all."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those that no learnt language fits better than chance."""
    modest(spark)
    model = language.train(docs)
    lang, score = unused("stage_lang", docs.columns), unused("stage_score", docs.columns)
    out = language.predicted(docs, model, into=lang, score=score)
    # With one language nothing can be told by the score.
    least = LEAST_ABOVE_CHANCE / len(model.languages) if len(model.languages) > 1 else 0.0
    return out.filter((F.col(lang) != language.UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a quality score below 0.7."""
    modest(spark)
    weights = quality.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", 4, 2)
    score = unused("stage_score", docs.columns)
    return quality.score(docs, "text", weights, into=score).filter(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def written(spark: SparkSession, docs: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The documents written once and read again, and their folder."""
    path = scratch_path(spark, purpose)
    docs.write.parquet(path)
    return spark.read.parquet(path), path


def keyed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents with a number of their own for every row, written once so that it stays the same, the name of its column, and the folder."""
    key = unused("row_key", docs.columns)
    rows, path = written(spark, docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    return rows, key, path


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near copies, that with the smallest id."""
    modest(spark)
    with shuffles_removed(spark):
        rows, key, path = keyed(spark, docs)
        classes, _ = probminhash.near_copies(rows, key)
        ranked = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key"))
        kept = classes.select(key, "class_id").join(rows.select(key, "doc_id"), key).groupBy("class_id").agg(F.min(ranked)["key"].alias(key))
        out, _ = written(spark, rows.join(durable(kept).select(key), key, "left_semi").select(*docs.columns), "copies")
    delete_path(spark, path)
    return out


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    modest(spark)
    with shuffles_removed(spark):
        rows, key, path = keyed(spark, docs)
        found = durable(contamination.flagged(rows, table(spark, sf_dir, "benchmark"), key))
        out, _ = written(spark, rows.join(found.select(key), key, "left_anti").select(*docs.columns), "clean")
    delete_path(spark, path)
    return out


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the kept documents and their digests; the decoded text is compared through its digest."""
    modest(spark)
    return bpe.digests(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language", language_stage), ("quality", quality_stage), ("near copies", copies_stage), ("decontamination", decontamination_stage), ("encoding", encoding_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; returns what the last one makes of the kept documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            delete_path(spark, before)  # nothing reads it any more
        before = path
    return docs
