"""Reads that arrive while a run goes on: baited as they come, and counted per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readloom.operators.kmers import kmers

SCHEMA = "sample string, read_id long, seq string, qual string"


def incoming_reads(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files of reads that land in a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def baited(reads: DataFrame, ref: DataFrame, k: int = 31) -> DataFrame:
    """Rows (sample, read_id, n_kmers) of arriving reads that share k-mers with the reference, as ``bait_kmers`` gives them.

    Reads are looked up in a table of the reference's k-mers, a stream-static join; the state is one count per baited read.
    """
    bait = kmers(ref.select("seq"), k, []).select("kmer").distinct()
    hits = kmers(reads, k, ["sample", "read_id"]).join(bait, "kmer", "left_semi")
    return hits.groupBy("sample", "read_id").agg(F.count("*").alias("n_kmers"))


def running_totals(reads: DataFrame) -> DataFrame:
    """Rows (sample, n_reads, total_bases) so far; the state is one row per sample."""
    return reads.groupBy("sample").agg(F.count("*").alias("n_reads"), F.sum(F.length("seq")).alias("total_bases"))


def keep_totals(reads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Processes all that has arrived and writes the totals after each batch as ``batch=n`` folders."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    return running_totals(reads).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
