"""The registered queries of the corpus operators, and their DuckDB counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import codes, fingerprint, html, langid, lines, mixing, pieces, pii, quality, recurrent, simhash, vectors, whitening
from readloom.llm.common import documents, fold


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-duplicate embeddings."""
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from each document when the sources are mixed to their target weights."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the recurrent model, beside that of smoothed word counts."""
    found = recurrent.score_documents(documents(spark, sf_dir))
    return found.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text less the lines that many sources carry."""
    return lines.remove_boilerplate(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's token ids, and whether decoding gives the text again."""
    return pieces.encode(documents(spark, sf_dir), pieces.load(), ids=False)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.learn(docs))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document, and the component of near copies that it is in."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; 1 from 0.7 on."""
    docs = documents(spark, sf_dir)
    odds = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality.score(docs, odds)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, with their errors."""
    return codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_html": op1_html,
    "op2_recurrent": op2_recurrent,
    "op3_lines": op3_lines,
    "op4_pieces": op4_pieces,
    "op5_language": op5_language,
    "op6_vectors": op6_vectors,
    "op7_mixing": op7_mixing,
    "op8_fingerprints": op8_fingerprints,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_codes": op11_codes,
    "op12_pii": op12_pii,
    "op13_whitening": op13_whitening,
}

ORACLES = {"op3_lines": lines.ORACLE, "op7_mixing": mixing.ORACLE, "op11_codes": codes.ORACLE}
