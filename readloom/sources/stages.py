"""Stage tables: a finished stage is a Parquet folder, and is not computed again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``); where none is set, a local one for a local session only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under a new name in the shared folder and read back: lineage ends here."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True where the stage's ``_SUCCESS`` file is there, on any file system that Spark writes."""
    jvm = spark.sparkContext._jvm
    flag = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return flag.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(flag)


def materialize_stage(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stage at ``path``: read if finished, else computed and written. Remove the folder to run it again."""
    if not exists(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Samples up to which a stage's list of them is broadcast to its rows; an entry is some 100 bytes.
FEW_SAMPLES = 500_000


def manifest_of(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows (sample, run): the finished samples of the stage at ``path`` and the run that computed each; None before the first."""
    if not exists(spark, f"{path}/manifest"):
        return None
    rows = spark.read.parquet(f"{path}/manifest").groupBy("sample").agg(F.max(F.struct("at", "run")).alias("last"))
    return rows.select("sample", F.col("last.run").alias("run")).where("run IS NOT NULL")


def note_samples(samples: DataFrame, path: str, run: str | None) -> None:
    """One more entry per sample in the manifest; the latest counts."""
    rows = samples.select("sample").distinct().select("sample", F.current_timestamp().alias("at"), F.lit(run).cast("string").alias("run"))
    rows.write.mode("append").parquet(f"{path}/manifest")


def forget_samples(samples: DataFrame, path: str) -> None:
    """The next use of the stage at ``path`` computes ``samples`` again."""
    note_samples(samples, path, None)


def by_sample(rows: DataFrame, samples: DataFrame, how: str) -> DataFrame:
    """The rows that have (``left_semi``) or lack (``left_anti``) their sample, and run if both have one, in ``samples``; null is a sample, too."""
    keys = ["sample", "run"] if {"sample", "run"} <= {*rows.columns} & {*samples.columns} else ["sample"]
    named = samples.select(*[F.col(c).alias(f"_{c}") for c in keys])
    if named.limit(FEW_SAMPLES + 1).count() <= FEW_SAMPLES:
        named = F.broadcast(named)
    return rows.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], how)


def materialize_samples(spark: SparkSession, path: str, inputs: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage at ``path`` for the samples of ``inputs``, of which only those that are not finished are computed.

    ``compute`` gets the rows of ``inputs`` of unfinished samples and returns rows with a column sample; what it makes of
    a sample must not depend on the others. Each run adds a folder of its own, then the manifest names its samples;
    what a run left that died in between has no entry and is never read. A sample without resulting rows is finished, too. Samples
    that are finished but not in ``inputs`` stay and are not returned. No samples give an empty table.
    """
    wanted = stage_table(inputs.select("sample").distinct(), "wanted-samples")
    done = manifest_of(spark, path)
    todo = wanted if done is None else stage_table(by_sample(wanted, done, "left_anti"), "open-samples")
    if done is None or not todo.isEmpty():
        run = f"r{uuid.uuid4().hex}"
        compute(inputs if done is None else by_sample(inputs, todo, "left_semi")).write.parquet(f"{path}/rows/run={run}")
        note_samples(todo, path, run)
    current = by_sample(manifest_of(spark, path), wanted, "left_semi")
    return by_sample(spark.read.parquet(f"{path}/rows"), current, "left_semi").drop("run")
