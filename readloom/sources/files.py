"""Readers and writers of sequence files: FASTQ, FASTA, XMFA, logs and statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.sequence import EXTENSIONS, accepted_extension, sample_name
from readloom.sources.records import opened, read_records, write_reads  # noqa: F401
from readloom.sources.stages import stage_table


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, length) of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def samples_of(files: DataFrame) -> DataFrame:
    """Rows (sample, path) from rows with a path: accepted files; of two with one sample name the last path stays."""
    return files.where(accepted_extension("path")).groupBy(sample_name("path").alias("sample")).agg(F.max("path").alias("path"))


def discover_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (sample, path): accepted files below the folder; of two with one sample name the last path stays.

    A file of zero bytes is no sample: scans do not list it.
    """
    found = samples_of(list_files(spark, folder))
    if found.isEmpty():
        raise ValueError(f"no file with one of the suffixes {EXTENSIONS} below {folder}")
    return found


def validate_inputs(spark: SparkSession, folder: str, reference: str) -> None:
    """ValueError unless every file has an accepted suffix and the reference begins with ``>``."""
    bad = list_files(spark, folder).where(~accepted_extension("path")).select("path").limit(5).collect()
    if bad:
        raise ValueError(f"files that are not sequence files: {[r.path for r in bad]}")
    first = spark.read.text(reference).limit(1).collect()
    if not first or not first[0].value.startswith(">"):
        raise ValueError(f"{reference} does not begin with '>'")


def list_assemblies(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (sample, path): one FASTA file per sample."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.fasta").load(folder).select("path")
    return files.select(sample_name("path").alias("sample"), "path")


def numbered_lines(spark: SparkSession, paths: str | list[str], name: str = "*") -> DataFrame:
    """Rows (path, line_no, value): 0-based line numbers of text files, gz or plain, whose names match the glob ``name``.

    Ids that grow within a block of a file are taken straight after the scan and kept in a stage table; a block's first
    line number is the number of lines in the file's blocks before it. Only counts per block are added up in order.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    )
    lines = stage_table(lines, "lines")
    blocks = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    w = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("ahead", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")
    return lines.join(blocks, ["path", "block"]).select("path", (F.col("ahead") + F.col("id") - F.col("first")).alias("line_no"), "value")


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows (sample, read_id, header, seq, qual, path, offset): records in the files' order by (path, offset)."""
    return read_records(spark, paths)


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows (sample, name, seq): records of a header line and any number of sequence lines. A bare header has an empty sequence."""
    records = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", True).text(paths)
    rows = records.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^>", "").alias("r")).where("trim(r) <> ''")
    header = F.split_part(F.regexp_replace("r", "\r", ""), F.lit("\n"), F.lit(1))
    return rows.select(sample_name("path").alias("sample"), F.regexp_extract(header, r"^(\S*)", 1).alias("name"), F.regexp_replace(F.expr("substr(r, instr(r || '\n', '\n') + 1)"), r"\s", "").alias("seq"))


def read_log_lines(spark: SparkSession, folder: str, name: str = "flye.log") -> DataFrame:
    """Rows (sample, line_no, line) of all logs of a name below a folder; the sample is the log's folder."""
    lines = numbered_lines(spark, folder, name)  # other files below the folder are not read
    return lines.select(F.element_at(F.split("path", "/"), -2).alias("sample"), "line_no", F.col("value").alias("line"))


def read_stdout_lines(spark: SparkSession, folder: str, suffix: str = "_shasta_stdout.txt") -> DataFrame:
    """Rows (sample, line_no, line) of files ``{sample}{suffix}`` in a folder itself."""
    lines = numbered_lines(spark, f"{folder}/*{suffix}")
    return lines.select(F.replace(F.element_at(F.split("path", "/"), -1), F.lit(suffix), F.lit("")).alias("sample"), "line_no", F.col("value").alias("line"))


def read_xmfa_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Rows (entry, aligned): the blocks of an XMFA alignment, which ``=`` lines end, joined per entry in file order."""
    blocks = spark.read.option("lineSep", "\n=").text(path).select(
        F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", r"(?m)^#.*\n?", "").alias("b")
    )
    entries = blocks.where(F.col("b").contains(">")).select("at", "id", F.explode(F.filter(F.split("b", r"(?m)^>"), lambda x: F.trim(x) != "")).alias("e")).where("instr(e, '\n') > 0 and trim(both '\n' from e) <> ''")
    rows = entries.select(F.regexp_extract("e", r"^\s*([^:\s]+)", 1).alias("entry"), "at", "id", F.regexp_replace(F.expr("substr(e, instr(e, '\n') + 1)"), r"[\s=]", "").alias("seq"))
    rows = rows.groupBy("entry").agg(F.array_sort(F.collect_list(F.struct("at", "id", "seq"))).alias("a"))
    return rows.select("entry", F.array_join(F.transform("a", lambda x: x["seq"]), "").alias("aligned"))


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """Rows of what ``write_reads`` wrote; the sample is the file's, whatever characters it has."""
    return read_records(spark, path, written=True)


def write_texts(rows: DataFrame, folder: str) -> None:
    """Rows (name, text) as one file each below ``folder``; a name may hold folders. Each text is one row, as a task holds it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(folder.rstrip("/"))
        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
                path = f"{top}/{name}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path, compression=None) as out:
                    out.write(text.encode())
            yield b.select(["name"])

    rows.select("name", "text").mapInArrow(write, "name string").count()


def write_contigs(contigs: DataFrame, path: str) -> None:
    """One folder of FASTA per sample, with headers ``>{contig_id}``."""
    record = F.concat(F.lit(">"), F.col("contig_id"), F.lit("\n"), F.col("seq")).alias("value")
    contigs.select("sample", record).write.partitionBy("sample").text(path)


def write_xmfa(aligned: DataFrame, path: str, block: int = 1000) -> None:
    """Rows (sample, aligned) as XMFA blocks of at most ``block`` columns; entries in order of sample."""
    rows = aligned.select("sample", F.explode(F.sequence(F.lit(0), F.greatest(F.length("aligned") - 1, F.lit(0)), F.lit(block))).alias("o"), "aligned")
    entry = F.concat(F.lit(">"), F.col("sample").cast("string"), F.lit(":"), (F.col("o") + 1).cast("string"), F.lit(" +\n"), F.substr(F.col("aligned"), F.col("o") + 1, F.lit(block)))
    blocks = rows.groupBy("o").agg(F.array_sort(F.collect_list(F.struct("sample", entry.alias("e")))).alias("a"))
    text = F.concat(F.array_join(F.transform("a", lambda x: x["e"]), "\n"), F.lit("\n="))
    blocks.select("o", text.alias("value")).orderBy("o").select("value").coalesce(1).write.text(path)


def write_stats_tsv(stats: DataFrame, path: str) -> None:
    """Statistics as tab-separated text with a header."""
    stats.write.option("sep", "\t").option("header", True).csv(path)


def read_stats_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)
