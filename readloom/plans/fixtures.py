"""Sequence tables derived from the given tables, in Spark and in SQL: reads, references, genomes, adapters and logs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.digests import numbered_heads
from readloom.functions.sequence import draw
from readloom.operators import packed

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "ACGT" * 13
QUALS = "".join(chr(38 + i * 7 % 30) for i in range(52))
ADAPTERS = [("A5", "ACGTTGCAAGTCCATGGTAC"), ("A3", "TTGACCAGTACGATCGGCAA")]
#: Length of the reads that are cut from genomes.
READ = 600
#: Reads per sample that are cut from genomes, and the number of genomes.
READS, NATIONS = 40, 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(column: str):
    return F.regexp_replace(F.col(column), "[^A-Za-z]", "")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (sample, read_id, seq, qual): one read per document."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("sample"), F.col("doc_id").alias("read_id"), letters("text").alias("x"))
    return d.select("sample", "read_id", F.translate("x", LETTERS, BASES).alias("seq"), F.translate("x", LETTERS, QUALS).alias("qual"))


def ref_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ref_id"), F.translate(letters("text"), LETTERS, BASES).alias("seq"))


def ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the items joined in order; some 200 items at most."""
    rows = ref_items(spark, sf_dir).agg(F.array_sort(F.collect_list(F.struct("ref_id", "seq"))).alias("a"))
    return rows.select(F.array_join(F.transform("a", lambda x: x["seq"]), "").alias("seq"))


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (sample, seq): the reference with changed bases, one genome per nation."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("sample")).crossJoin(F.broadcast(ref(spark, sf_dir)))  # one row
    changed = lambda i: (draw("c", F.col("sample") % 7, "|", i + 1) % 997 == 0) | (draw("x", F.col("sample"), "|", i + 1) % 3989 == 0)
    bases = F.transform(F.split("seq", ""), lambda b, i: F.when(changed(i), F.translate(b, "ACGT", "CGTA")).otherwise(b))
    return rows.select("sample", F.array_join(bases, "").alias("seq"))


def genome_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (sample, read_id, start, seq, qual): one read per document, 40 a sample; reads 2m and 2m+1 of a sample share a start.

    Samples grow with the documents, and each is drawn from the genome of one nation, so depth is the same at every size.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / READS).cast("int").alias("sample"), (F.col("doc_id") % READS).cast("int").alias("n"))
    # One row per nation, of which there are 25 at any size. As bytes, reads are cut without walking the text, whose length is taken once.
    own = genomes(spark, sf_dir).select(F.col("sample").alias("genome"), F.col("seq").cast("binary").alias("bases"), F.length("seq").alias("size"))
    rows = ids.repartition(parts, "sample").withColumn("genome", F.col("sample") % NATIONS).join(F.broadcast(own), "genome")
    rows = rows.withColumn("start", 1 + draw("r", F.col("sample"), "|", F.floor(F.col("n") / 2)) % (F.col("size") - (READ - 1)))
    rows = rows.select("sample", (F.col("sample").cast("long") * 1000 + F.col("n")).alias("read_id"), "start", F.expr(f"cast(substring(bases, cast(start as int), {READ}) as string)").alias("seq"))
    return rows.withColumn("qual", F.when(F.col("read_id") % 2 == 0, F.translate("seq", "ACGT", "5:?I")).otherwise(F.translate("seq", "ACGT", "I?:5")))


def varied_genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (sample, seq): the genomes with some bases lost and some texts of three bases put in."""
    at = lambda i: draw("v", F.col("sample"), "|", i + 1) % 1999
    bases = F.transform(F.split("seq", ""), lambda b, i: F.when(at(i) == 0, "").when(at(i) == 1, F.concat(b, F.lit("ACG"))).otherwise(b))
    return genomes(spark, sf_dir).withColumn("seq", F.array_join(bases, ""))


def mutated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genome reads with a fortieth of their bases changed, as ``draw("m", read_id, "|", place)`` has it, drawn side by side."""

    @F.arrow_udf("string")
    def mutated(ids: pa.Array, seqs: pa.Array) -> pa.Array:
        data, ends = packed.flat(seqs)
        data, size = data.copy(), np.diff(ends)
        prefixes = [f"m{i}|".encode() for i in ids.to_pylist()]
        for lo in range(0, len(size), 256):
            own = size[lo : lo + 256]
            drawn = numbered_heads(prefixes[lo : lo + 256], int(own.max()))
            row, at = np.nonzero((drawn % np.uint32(40) == 0) & (np.arange(drawn.shape[1]) < own[:, None]))
            at += ends[lo + row]
            data[at] = TURNED[data[at]]
        return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.string())

    return genome_reads(spark, sf_dir).withColumn("seq", mutated("read_id", "seq"))


#: Each byte, but A, C, G and T as C, G, T and A.
TURNED = np.arange(256, dtype=np.uint8)
TURNED[[ord(c) for c in "ACGT"]] = [ord(c) for c in "CGTA"]


def adapters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ADAPTERS, "name string, seq string")


def adapter_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with adapters in front, behind and inside, some with one changed base in front and behind, or one lost inside."""
    (_, a5), (_, a3) = ADAPTERS
    bad = lambda a: F.when(F.col("read_id") % 5 == 0, F.lit(a[:9] + ("A" if a[9] != "A" else "C") + a[10:])).otherwise(F.lit(a))
    half = F.floor(F.length("seq") / 2).cast("int")
    r = reads(spark, sf_dir)
    inside = F.col("read_id") % 50 == 0
    short = F.col("read_id") % 100 == 0
    put = lambda c, x: F.when(inside, F.concat(F.substr(F.col(c), F.lit(1), half), F.when(short, F.lit(x[:9] + x[10:])).otherwise(F.lit(x)), F.substr(F.col(c), half + 1))).otherwise(F.col(c))
    r = r.select("sample", "read_id", put("seq", a5).alias("s"), put("qual", "I" * 20).alias("q"))
    front, behind = F.col("read_id") % 3 == 0, F.col("read_id") % 4 == 0
    no = F.lit("")
    return r.select(
        "sample", "read_id",
        F.concat(F.when(front, bad(a5)).otherwise(no), "s", F.when(behind, bad(a3)).otherwise(no)).alias("seq"),
        F.concat(F.when(front, F.lit("I" * 20)).otherwise(no), "q", F.when(behind, F.lit("I" * 20)).otherwise(no)).alias("qual"),
    )


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (doc_id, path, header): file names and headers as input folders have them."""
    n = F.col("doc_id")
    tag = F.when(n % 3 == 0, "_pass").when(n % 3 == 1, "_filtered").otherwise("")
    ext = F.when(n % 5 == 0, ".fastq.gz").when(n % 5 == 1, ".fq").when(n % 5 == 2, ".fasta").when(n % 5 == 3, ".bam").otherwise(".fna.gz")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return d.select("doc_id", F.concat(F.lit("/in/run/"), "source", tag, F.lit(".r"), n.cast("string"), ext).alias("path"), F.concat(F.lit("@read"), n.cast("string"), F.lit(" len="), F.col("n_chars").cast("string")).alias("header"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (sample, line_no, line): assembly logs written from the documents' sizes; every third sample lacks a line, and lines repeat."""
    d = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("sample")).agg(F.sum("n_chars").alias("n"), F.count("*").alias("k"))
    third = F.col("k") % 3 == 0
    n, k = F.col("n").cast("string"), F.col("k").cast("string")
    text = [
        F.lit("[start] nothing"), F.concat(F.lit("Total read length: "), k), F.concat(F.lit("Total read length: "), n), F.concat(F.lit("Reads N50/N90: "), k, F.lit(" / 7")),
        F.concat(F.lit("\tTotal length:\t"), n), F.when(third, F.lit("none")).otherwise(F.concat(F.lit("\tFragments:\t"), k)), F.concat(F.lit("\tMean coverage:\t"), k),
        F.concat(F.lit("Total number of reads is "), k, F.lit(".")), F.concat(F.lit("Total number of raw bases is "), n, F.lit(".")), F.concat(F.lit("N50 for read length is "), k, F.lit(" bases.")),
        F.concat(F.lit("Total length of assembled sequence is "), n), F.when(third, F.lit("none")).otherwise(F.concat(F.lit("The assembly graph has "), k, F.lit(" vertices and"))),
    ]
    return d.select("sample", F.posexplode(F.array(*text)).alias("line_no", "line"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def sql_letters(column: str, to: str) -> str:
    return f"translate(regexp_replace({column}, '[^A-Za-z]', '', 'g'), '{LETTERS}', {quoted(to)})"


def sql_changed(seq: str, condition: str) -> str:
    """The bases of a text, changed where the condition on 1-based ``i`` holds."""
    return f"array_to_string(list_transform(string_split({seq}, ''), lambda b, i: CASE WHEN {condition} THEN translate(b, 'ACGT', 'CGTA') ELSE b END), '')"


def sql_bad(a: str) -> str:
    return f"CASE WHEN read_id % 5 = 0 THEN '{a[:9] + ('A' if a[9] != 'A' else 'C') + a[10:]}' ELSE '{a}' END"


A5, A3 = ADAPTERS[0][1], ADAPTERS[1][1]
PAD = "I" * 20
#: Common table expressions; each may use those before it.
SQL = {
    "reads": f"SELECT source AS sample, doc_id AS read_id, {sql_letters('text', BASES)} AS seq, {sql_letters('text', QUALS)} AS qual FROM documents",
    "ref_items": f"SELECT item_id AS ref_id, {sql_letters('text', BASES)} AS seq FROM benchmark",
    "ref": "SELECT string_agg(seq, '' ORDER BY ref_id) AS seq FROM ref_items",
    "genomes": "SELECT n_nationkey::INT AS sample, "
    + sql_changed("seq", f"{sql_draw("'c' || (n_nationkey % 7) || '|' || i")} % 997 = 0 OR {sql_draw("'x' || n_nationkey || '|' || i")} % 3989 = 0")
    + " AS seq FROM nation, ref",
    "genome_reads": f"""SELECT *, CASE WHEN read_id % 2 = 0 THEN translate(seq, 'ACGT', '5:?I') ELSE translate(seq, 'ACGT', 'I?:5') END AS qual FROM (
        SELECT sample, (sample * 1000 + n)::BIGINT AS read_id, start, substr(seq, start, {READ}) AS seq FROM (
        SELECT d.sample, seq, n, 1 + {sql_draw("'r' || d.sample || '|' || (n // 2)")} % (length(seq) - {READ - 1}) AS start
        FROM (SELECT (doc_id // {READS})::INT AS sample, (doc_id % {READS})::INT AS n FROM documents) d JOIN genomes g ON d.sample % {NATIONS} = g.sample))""",
    "varied_genomes": f"""SELECT sample, array_to_string(list_transform(list_transform(string_split(seq, ''), lambda b, i: {{'b': b, 'v': {sql_draw("'v' || sample || '|' || i")} % 1999}}),
        lambda x: CASE x.v WHEN 0 THEN '' WHEN 1 THEN x.b || 'ACG' ELSE x.b END), '') AS seq FROM genomes""",
    "mutated_reads": "SELECT sample, read_id, " + sql_changed("seq", f"{sql_draw("'m' || read_id || '|' || i")} % 40 = 0") + " AS seq FROM genome_reads",
    "inner_reads": f"""SELECT sample, read_id,
        CASE WHEN read_id % 50 = 0 THEN substr(seq, 1, length(seq) // 2) || CASE WHEN read_id % 100 = 0 THEN '{A5[:9] + A5[10:]}' ELSE '{A5}' END || substr(seq, length(seq) // 2 + 1) ELSE seq END AS s,
        CASE WHEN read_id % 50 = 0 THEN substr(qual, 1, length(qual) // 2) || CASE WHEN read_id % 100 = 0 THEN '{PAD[1:]}' ELSE '{PAD}' END || substr(qual, length(qual) // 2 + 1) ELSE qual END AS q FROM reads""",
    "adapter_reads": f"""SELECT sample, read_id,
        CASE WHEN read_id % 3 = 0 THEN {sql_bad(A5)} ELSE '' END || s || CASE WHEN read_id % 4 = 0 THEN {sql_bad(A3)} ELSE '' END AS seq,
        CASE WHEN read_id % 3 = 0 THEN '{PAD}' ELSE '' END || q || CASE WHEN read_id % 4 = 0 THEN '{PAD}' ELSE '' END AS qual FROM inner_reads""",
    "paths": """SELECT doc_id, '/in/run/' || source || CASE doc_id % 3 WHEN 0 THEN '_pass' WHEN 1 THEN '_filtered' ELSE '' END || '.r' || doc_id
        || CASE doc_id % 5 WHEN 0 THEN '.fastq.gz' WHEN 1 THEN '.fq' WHEN 2 THEN '.fasta' WHEN 3 THEN '.bam' ELSE '.fna.gz' END AS path,
        '@read' || doc_id || ' len=' || n_chars AS header FROM documents""",
}
NEEDS = {
    "ref": ["ref_items"], "genomes": ["ref"], "genome_reads": ["genomes"], "mutated_reads": ["genome_reads"], "varied_genomes": ["genomes"], "inner_reads": ["reads"], "adapter_reads": ["inner_reads"],
}


def with_fixtures(names: str, body: str) -> str:
    """``body`` behind the named fixtures and what they need. The body may start with ``, name AS (...)``."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    recursive = "RECURSIVE " if "UNION ALL SELECT" in body else ""
    head = ", ".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in order)
    return f"WITH {recursive}{head}{body}" if body.startswith(",") else f"WITH {recursive}{head} {body}"
