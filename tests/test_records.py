"""Files of records: byte ranges against plain parsing, round trips, order, and one file per sample."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import reads as rd
from readloom.sources import files, records


def fastq(rng, n):
    """Records whose qualities look like headers and separators."""
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 2, 5, 30])
        out.append((f"@q{i} {rng.choice(['', 'x y', '+', '@'])}", "".join(rng.choice("ACGT") for _ in range(size)), "".join(rng.choice("@+>I!") for _ in range(size))))
    return out


def test_slices_at_every_byte_give_every_record_once():
    rng = random.Random(1)
    for _ in range(12):
        want = fastq(rng, rng.randrange(1, 7))
        end = rng.choice(["\n", "\r\n"])
        text = "".join(f"{h}{end}{s}{end}+{end}{q}{end}" for h, s, q in want).encode()
        if rng.random() < 0.5:
            text = text[: -len(end)]
        for step in range(1, len(text) + 1):
            got = []
            for lo in range(0, len(text), step):
                file = io.BytesIO(text)
                file.seek(max(lo - 1, 0))
                lines = records.lines_from(file, max(lo - 1, 0))
                if lo:
                    next(lines)
                got += [(h.decode(), s.decode(), q.decode()) for _, h, s, q in records.fastq_records(lines, lo + step, lo > 0)]
            assert got == want, step


def test_broken_records_raise():
    for text in (b"@a\nAC\n+\n", b"@a\nAC\nII\n@b\n", b"x\nAC\n+\nII\n"):
        with pytest.raises(ValueError):
            list(records.fastq_records(records.lines_from(io.BytesIO(text), 0), 99, False))


def test_large_file_over_many_slices_is_read_without_a_shuffle(spark, tmp_path):
    text = "".join(f"@q{i}\n{'ACGT' * (i % 9)}\n+\n{'@+I!' * (i % 9)}\n" for i in range(4000))
    (tmp_path / "x.fastq").write_text(text)
    (tmp_path / "y.fa").write_text("".join(f">c{i} z\n{'ACGT' * (i % 9)}\n{'GG' * (i % 2)}\n" for i in range(900)))
    (tmp_path / "_x.fastq").write_text("not a record")
    rows = records.read_records(spark, str(tmp_path), split=4096)
    assert rows.rdd.getNumPartitions() > 30
    assert "Exchange" not in rows._jdf.queryExecution().toString()
    got = rows.collect()
    assert sorted((r.read_id, r.seq, r.qual) for r in got if r["sample"] == "x") == sorted((f"q{i}", "ACGT" * (i % 9), "@+I!" * (i % 9)) for i in range(4000))
    assert sorted((r.header, r.seq, r.qual) for r in got if r["sample"] == "y") == sorted((f">c{i} z", "ACGT" * (i % 9) + "GG" * (i % 2), None) for i in range(900))
    order = [r.read_id for r in sorted((r for r in got if r["sample"] == "x"), key=lambda r: r.offset)]
    assert order == [f"q{i}" for i in range(4000)]
    assert [r.read_id for r in rd.first_reads(rows.where("sample = 'x'"), 12).orderBy("nth").collect()] == order[:12]  # q10 before q2 by name


def test_mixed_reads_round_trip(spark, tmp_path):
    rows = [("a.b/c %", "1", "@1 whole header", "ACGT", "II@+"), ("a.b/c %", "2", "@2", "GG", None), (None, "3", ">3 x", "", ""), ("s", "4", "@4", "TT", "!!"), ("s", "4", "@4", "TT", "!!")]
    df = spark.createDataFrame(rows, "sample string, read_id string, header string, seq string, qual string")
    files.write_reads(df.repartition(4), str(tmp_path / "out"))
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == ["%none.fastq.gz", "a%2Eb%2Fc%20%25.fasta.gz", "a%2Eb%2Fc%20%25.fastq.gz", "s.fastq.gz"]
    got = files.read_written(spark, str(tmp_path / "out")).select("sample", "read_id", "seq", "qual").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((s, i, x, q) for s, i, _, x, q in rows), key=key)
    headers = {r.header for r in files.read_written(spark, str(tmp_path / "out")).collect()}
    assert headers == {"@1 whole header", ">2", "@3 x", "@4"}
    with pytest.raises(FileExistsError):
        files.write_reads(df, str(tmp_path / "out"))


def test_a_sample_of_many_tasks_is_one_ordered_file(spark, tmp_path):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("sample"), F.col("id").alias("read_id"), F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual"), (F.col("id") * 7919 % 5003).alias("place"))
    files.write_reads(df.repartition(8), str(tmp_path / "out"), "place")
    with gzip.open(tmp_path / "out" / "big.fastq.gz", "rt") as f:
        lines = f.read().splitlines()
    want = [r.read_id for r in df.where("sample = 'big'").orderBy("place").collect()]
    assert [int(x[1:]) for x in lines[::4]] == want and sorted(p.name for p in (tmp_path / "out").iterdir()) == ["big.fastq.gz", *(f"s{i}.fastq.gz" for i in range(5))]


def test_empty_tables_and_folders(spark, tmp_path):
    df = spark.createDataFrame([], "sample string, read_id string, seq string, qual string")
    files.write_reads(df, str(tmp_path / "out"))
    assert files.read_written(spark, str(tmp_path / "out")).count() == 0
    with pytest.raises(Exception, match="none"):
        files.read_fastq(spark, str(tmp_path / "none")).count()
