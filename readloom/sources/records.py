"""Sequence files as a Spark data source: records of FASTQ and FASTA by byte ranges, and one file per sample as output.

Paths are those that pyarrow's file systems know: shared folders, hdfs://, s3:// and the like.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from readloom.functions.sequence import EXTENSIONS

SCHEMA = "sample string, read_id string, header string, seq string, qual string, path string, offset long"
#: Bytes of a partition of a plain file, bytes that are read at once, and records of a batch.
SPLIT, CHUNK, BATCH = 64 << 20, 1 << 20, 4096
#: File name of reads without a sample; no quoted sample name is like it.
NO_SAMPLE = "%none"


@dataclass
class Slice(InputPartition):
    """Records that begin in the bytes ``lo`` to ``hi`` of a file; a compressed file is one slice."""

    path: str
    lo: int
    hi: int


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path inside it. Spark writes local paths as ``file:/x`` or ``file:///x``."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_below(path: str) -> list[tuple[str, int]]:
    """Path and size of the sequence files below a folder, or of one file; names that begin with _ or . are passed over."""
    store, inside = opened(path)
    info = store.get_file_info(inside)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inside, recursive=True))
    plain = lambda name: not any(p[:1] in ("_", ".") for p in name[len(inside) :].split("/"))
    head = path[: len(path) - len(inside)] if path.endswith(inside) and not path.startswith("file:") else ""
    rows = [(head + f.path, f.size) for f in found if f.type == fs.FileType.File and (f is info or (plain(f.path) and f.path.endswith(EXTENSIONS)))]
    return sorted(rows)


def sample_of(path: str, written: bool) -> str | None:
    """The file name up to its first dot: as written by this source, or without ``_pass`` and ``_filtered``."""
    name = path.rsplit("/", 1)[-1].split(".", 1)[0]
    if written:
        return None if name == NO_SAMPLE else unquote(name)
    return name.replace("_pass", "").replace("_filtered", "")


def lines_from(stream, at: int) -> Iterator[tuple[int, bytes]]:
    """Offset and text of every line of a stream that stands at offset ``at``."""
    rest = b""
    while chunk := stream.read(CHUNK):
        parts = (rest + chunk).split(b"\n")
        rest = parts.pop()
        for x in parts:
            yield at, x.rstrip(b"\r")
            at += len(x) + 1
    if rest:
        yield at, rest.rstrip(b"\r")


def fastq_records(lines: Iterator[tuple[int, bytes]], hi: int, resync: bool) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Records (offset, header, seq, qual) that begin before ``hi``.

    A line is a header if it begins with @ and the second one behind it with +. A quality may begin with @ too, but then a
    sequence stands there, which has no +. So a slice finds its first record among its first four lines.
    """
    held: list[tuple[int, bytes]] = []
    for line in lines:
        held.append(line)
        if resync:
            while len(held) >= 3 and not (held[0][1][:1] == b"@" and held[2][1][:1] == b"+"):
                held.pop(0)
            if len(held) < 3:
                continue
            resync = False
        if held[0][0] >= hi:
            return
        if not held[0][1] and len(held) == 1:
            held.clear()  # an empty line between records
        elif len(held) == 4:
            if held[0][1][:1] != b"@" or held[2][1][:1] != b"+":
                raise ValueError(f"no FASTQ record at byte {held[0][0]}")
            yield held[0][0], held[0][1], held[1][1], held[3][1]
            held.clear()
    if not resync and len(held) == 3 and not held[1][1]:  # the last record is empty, and no line ends it
        yield held[0][0], held[0][1], b"", b""
    elif held and not resync:
        raise ValueError(f"the record at byte {held[0][0]} is cut off")


def fasta_records(lines: Iterator[tuple[int, bytes]], hi: int) -> Iterator[tuple[int, bytes, bytes, None]]:
    """Records (offset, header, seq, None) that begin before ``hi``."""
    at, header, parts = 0, None, []
    for offset, line in lines:
        if line[:1] == b">":
            if header is not None:
                yield at, header, b"".join(parts), None
            header, parts, at = None, [], offset
            if offset >= hi:
                return
            header = line
        elif header is not None:
            parts.append(b"".join(line.split()))
    if header is not None:
        yield at, header, b"".join(parts), None


class ReadsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.split = int(options.get("splitbytes", SPLIT))
        self.written = options.get("written", "false").lower() == "true"

    def partitions(self) -> list[Slice]:
        out = []
        for top in self.paths:
            for path, size in files_below(top):
                step = size if path.endswith(".gz") else self.split
                out += [Slice(path, lo, min(lo + step, size)) for lo in range(0, size, max(step, 1))]
        return out

    def read(self, part: Slice | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no files
            return
        store, inside = opened(part.path)
        fasta = part.path.removesuffix(".gz").endswith((".fasta", ".fa", ".fna"))
        with store.open_input_file(inside) as file:
            if part.path.endswith(".gz"):
                lines, hi = lines_from(gzip.GzipFile(fileobj=file), 0), 1 << 62
            else:
                file.seek(max(part.lo - 1, 0))
                lines, hi = lines_from(file, max(part.lo - 1, 0)), part.hi
                if part.lo:
                    next(lines)  # to the first line that begins in the slice
            records = fasta_records(lines, hi) if fasta else fastq_records(lines, hi, part.lo > 0)
            sample, rows = sample_of(part.path, self.written), []
            size = 0
            for r in records:
                rows.append(r)
                size += len(r[2])
                if len(rows) == BATCH or size > 16 * CHUNK:
                    yield self.batch(part.path, sample, rows)
                    rows, size = [], 0
            if rows:
                yield self.batch(part.path, sample, rows)

    def batch(self, path: str, sample: str | None, rows: list) -> pa.RecordBatch:
        offset, header, seq, qual = zip(*rows, strict=True)
        text = lambda x: pa.array([v if v is None else v.decode() for v in x], pa.string())
        names = [h[1:].split(None, 1)[0] if h[1:].strip() else b"" for h in header]
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([sample] * n, pa.string()), text(names), text(header), text(seq), text(qual), pa.array([path] * n, pa.string()), pa.array(offset, pa.int64())],
            names=["sample", "read_id", "header", "seq", "qual", "path", "offset"],
        )


@dataclass
class Parts(WriterCommitMessage):
    """What a task wrote: (file name of the sample, path of the part)."""

    parts: list[tuple[str, str]]


class PartsWriter(DataSourceArrowWriter):
    """Compressed parts, one per sample and task, in file names of their own; the commit lists those that count."""

    def __init__(self, options: dict, schema):
        self.path, self.names = options["path"].rstrip("/"), schema.names

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        from pyspark import TaskContext

        store, inside = opened(self.path)
        store.create_dir(inside, recursive=True)
        task, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        done: dict[str, str] = {}
        current = out = sink = None
        for b in batches:
            for sample, fasta, record in zip(*(b.column(c).to_pylist() for c in ("sample", "fasta", "record")), strict=True):
                name = (NO_SAMPLE if sample is None else quote(sample, safe="").replace(".", "%2E")) + (".fasta.gz" if fasta else ".fastq.gz")
                if name != current:  # rows come sorted by sample, so one part is open at a time
                    if out:
                        out.close()
                        sink.close()
                    if name in done:
                        raise ValueError("rows are not sorted by sample within their partitions")
                    current, done[name] = name, f"{self.path}/{task:06d}-{len(done):06d}-{own}.gz"
                    sink = store.open_output_stream(opened(done[name])[1], compression=None)
                    out = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=4)
                out.write(record.encode() + b"\n")
        if out:
            out.close()
            sink.close()
        return Parts(sorted(done.items()))

    def commit(self, messages: list[Parts | None]) -> None:
        store, inside = opened(self.path)
        store.create_dir(inside, recursive=True)
        with store.open_output_stream(f"{inside}/manifest.jsonl") as f:
            for m in messages:
                for name, path in m.parts if m else ():
                    f.write((json.dumps({"name": name, "part": path}) + "\n").encode())

    def abort(self, messages: list[Parts | None]) -> None:
        for m in messages:
            for _, path in m.parts if m else ():
                store, inside = opened(path)
                store.delete_file(inside)


class ReadsSource(DataSource):
    """``spark.read.format("reads")`` for rows of SCHEMA; writing takes rows (sample, fasta, record), see ``write_reads``."""

    @classmethod
    def name(cls) -> str:
        return "reads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ReadsReader:
        return ReadsReader(self.options)

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options, schema)


def read_records(spark: SparkSession, paths: str | list[str], split: int = SPLIT, written: bool = False) -> DataFrame:
    """Rows (sample, read_id, header, seq, qual, path, offset) of FASTQ and FASTA files, plain or gz; FASTA has no qual.

    ``offset`` is the byte at which the record begins, of the text if the file is compressed: it orders a file's records.
    A plain file is cut every ``split`` bytes, and no record moves between tasks. Quality and sequence are one line each
    in FASTQ. ``written``: file names are those that ``write_reads`` gives.
    """
    spark.dataSource.register(ReadsSource)
    tops = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("reads").option("paths", json.dumps(tops)).option("splitBytes", split).option("written", str(written).lower()).load()


def write_reads(reads: DataFrame, path: str, order: str | None = None) -> None:
    """One ``{sample}.fastq.gz`` per sample below ``path``; reads without quality go to ``{sample}.fasta.gz``.

    The header line is kept where there is a column ``header``, else it is the read_id. With ``order`` each file has its
    reads in that order. Tasks compress parts, any number per sample; then one task per file puts the parts behind each
    other as they are, which gzip allows, under another name until it is whole. A folder that exists is an error.
    """
    spark = reads.sparkSession
    spark.dataSource.register(ReadsSource)
    store, inside = opened(path)
    if store.get_file_info(inside).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    fasta = F.col("qual").isNull()
    name = F.regexp_replace(F.col("header"), "^[@>]", "") if "header" in reads.columns else F.col("read_id").cast("string")
    text = F.when(fasta, F.concat(F.lit(">"), name, F.lit("\n"), "seq")).otherwise(F.concat(F.lit("@"), name, F.lit("\n"), "seq", F.lit("\n+\n"), "qual"))
    keys = ["sample", "fasta", *([order] if order else [])]
    rows = reads.withColumns({"sample": F.col("sample").cast("string"), "fasta": fasta, "record": text})
    if order:
        rows = rows.repartitionByRange(*keys)
    parts = f"{path.rstrip('/')}/_parts"
    rows.sortWithinPartitions(*keys).select("sample", "fasta", "record").write.format("reads").mode("append").save(parts)
    listed = spark.read.schema("name string, part string").json(f"{parts}/manifest.jsonl")
    files = listed.groupBy("name").agg(F.array_sort(F.collect_list("part")).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, some in zip(b.column("name").to_pylist(), b.column("parts").to_pylist(), strict=True):
                store, top = opened(path.rstrip("/"))
                part = f"{top}/_parts/{own}-{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    for p in some:
                        with store.open_input_stream(opened(p)[1], compression=None) as f:
                            while chunk := f.read(CHUNK):
                                out.write(chunk)
                store.move(part, f"{top}/{own}")
            yield pa.RecordBatch.from_arrays([b.column("name")], names=["name"])

    files.repartition(min(64, max(1, files.count())), "name").mapInArrow(join, "name string").count()
    store.delete_dir(opened(parts)[1])
