"""The corpus pipeline: five stages, each a table of documents written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import lines, mixing, pieces, quality, simhash
from readloom.llm.common import documents, fresh, stage_table

#: A document with a lower quality score goes.
LEAST_QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, unchanged."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh("score", docs.columns)
    scored = quality.score(docs, model, keep=tuple(docs.columns), name=score)
    return scored.where(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts less cross-site boilerplate lines; n_chars is that of the text left."""
    clean = lines.remove_boilerplate(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; rows of one doc_id stay or go together.

    Near copies share four fifths of their five-word shingles or more; the contract of op9 binds that query alone.
    """
    found = simhash.near_copies(docs)
    own = fresh("id", docs.columns)
    drop = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(drop, F.col("doc_id") == F.col(own), "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix's epochs reach it, whole; a source so exceeds its target by a part of one document at most."""
    own, times, nth = (fresh(name, docs.columns) for name in ("id", "times", "nth"))
    copies = mixing.mix(docs).where("copies > 0").groupBy(F.col("doc_id").alias(own)).agg(F.max("copies").alias(times))
    mixed = docs.join(copies, F.col("doc_id").eqNullSafe(F.col(own)))
    return mixed.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digest."""
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("near duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: No SQL trains the classifier or applies the tokenizer; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
