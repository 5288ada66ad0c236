"""The registered queries of the sequence operators, each with the SQL that it is compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import sequence as fn
from readloom.operators import adapters as ad
from readloom.operators import assembly as asm
from readloom.operators import chaining as ch
from readloom.operators import kmers as km
from readloom.operators import logs as lg
from readloom.operators import mapping as mp
from readloom.operators import reads as rd
from readloom.operators import trees as tr
from readloom.operators import variants as va
from readloom.plans import fixtures as fx
from readloom.plans.fixtures import with_fixtures as sql
from readloom.sources import files
from readloom.sources.stages import forget_samples, materialize_samples, materialize_stage, stage_path, stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


#: All k-mers of ``{t}`` with columns ``{c}`` and 0-based pos.
def sql_kmers(t: str, c: str, k: int) -> str:
    c = f"{c}, " if c else ""
    return f"SELECT {c}pos, substr(seq, pos + 1, {k}) AS kmer FROM (SELECT {c}seq, unnest(range(0, length(seq) - {k} + 1)) AS pos FROM {t} WHERE length(seq) >= {k})"


def sql_minimizers(t: str, c: str, w: int = 10, k: int = 15) -> str:
    return f"""SELECT DISTINCT {c}, m.pos AS pos, m.kmer AS kmer FROM (
        SELECT {c}, min({{'turn': turn, 'kmer': kmer, 'pos': pos}}) OVER x AS m, count(*) OVER x AS n
        FROM (SELECT *, substr(md5(kmer), 1, 8) AS turn FROM ({sql_kmers(t, c, k)})) WINDOW x AS (PARTITION BY {c} ORDER BY pos ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING)) WHERE n = {w}"""


# --- names, filters, metrics ---------------------------------------------------------------------------------------


@query("p1_sample_name", sql("paths", "SELECT doc_id, replace(replace(split_part(string_split(path, '/')[-1], '.', 1), '_pass', ''), '_filtered', '') AS sample FROM paths"))
def p1(spark, d):
    return fx.paths(spark, d).select("doc_id", fn.sample_name("path").alias("sample"))


@query("p2_read_id", sql("paths", r"SELECT doc_id, regexp_extract(header, '^@(\S+)', 1) AS read_id FROM paths"))
def p2(spark, d):
    return fx.paths(spark, d).select("doc_id", fn.read_id("header").alias("read_id"))


@query("p3_stem", sql("paths", r"SELECT doc_id, regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', '') AS stem FROM paths"))
def p3(spark, d):
    return fx.paths(spark, d).select("doc_id", fn.stem("path").alias("stem"))


@query("p4_read_metrics", sql("reads", """SELECT sample, read_id, length(seq)::BIGINT AS length,
    COALESCE(list_sum(list_transform(CASE WHEN qual = '' THEN [] ELSE string_split(qual, '') END, lambda c: ascii(c) - 33)), 0)::BIGINT AS phred_sum,
    CASE WHEN length(seq) > 0 THEN round(COALESCE(list_sum(list_transform(CASE WHEN qual = '' THEN [] ELSE string_split(qual, '') END, lambda c: ascii(c) - 33)), 0) / length(seq), 6) ELSE 0.0 END AS mean_phred FROM reads"""))  # fmt: skip
def p4(spark, d):
    return rd.read_metrics(fx.reads(spark, d))


@query("f1_accepted_extension", sql("paths", "SELECT doc_id, path FROM paths WHERE " + " OR ".join(f"ends_with(path, '{e}')" for e in fn.EXTENSIONS)))
def f1(spark, d):
    return fx.paths(spark, d).where(fn.accepted_extension("path")).select("doc_id", "path")


@query("f4_min_length", sql("reads", "SELECT sample, read_id, length(seq)::BIGINT AS length FROM reads WHERE length(seq) >= 500"))
def f4(spark, d):
    return rd.min_length(fx.reads(spark, d)).select("sample", "read_id", F.length("seq").cast("long").alias("length"))


@query("f5_assembly_min_size", sql("reads", "SELECT sample, count(*) AS n FROM reads WHERE length(seq) >= 3000 GROUP BY sample"))
def f5(spark, d):
    return rd.min_length(fx.reads(spark, d), 3000).groupBy("sample").agg(F.count("*").alias("n"))


@query("f7_require_min_samples", sql("genomes", "SELECT sample, length(seq)::BIGINT AS length FROM genomes"))
def f7(spark, d):
    return rd.require_min_samples(fx.genomes(spark, d)).select("sample", F.length("seq").cast("long").alias("length"))


@query("a1_fasta_length", sql("ref_items", "SELECT COALESCE(sum(length(seq)), 0)::BIGINT AS total_bases FROM ref_items"))
def a1(spark, d):
    return rd.fasta_length(fx.ref_items(spark, d))


SQL_NX = """, h AS (SELECT sample, length(seq)::BIGINT AS len, count(*) AS n FROM reads GROUP BY ALL),
 c AS (SELECT *, sum(len * n) OVER (PARTITION BY sample ORDER BY len DESC) AS cum, sum(len * n) OVER (PARTITION BY sample) AS total FROM h),
 nx AS (SELECT sample, max(len) FILTER (WHERE cum * 100 >= total * 50) AS n50, max(len) FILTER (WHERE cum * 100 >= total * 90) AS n90 FROM c GROUP BY sample)"""


@query("n4_nx", sql("reads", SQL_NX + " SELECT * FROM nx"))
def n4(spark, d):
    return rd.nx(fx.reads(spark, d))


@query("a2_read_stats", sql("reads", SQL_NX + " SELECT sample, count(*) AS n_reads, sum(length(seq))::BIGINT AS total_bases, n50, n90 FROM reads JOIN nx USING (sample) GROUP BY sample, n50, n90"))
def a2(spark, d):
    return rd.read_stats(fx.reads(spark, d))


@query("n1_first_reads", sql("reads", "SELECT sample, read_id::VARCHAR AS read_id, nth FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5('n' || read_id)) AS nth FROM reads) WHERE nth <= 1000"))
def n1(spark, d):
    """Files with their reads in an order of their own, of which the first ones are taken."""
    path = stage_path(spark, "fastq")
    files.write_reads(fx.reads(spark, d).withColumn("place", F.md5(F.concat(F.lit("n"), F.col("read_id").cast("string")).cast("binary"))), path, "place")
    return rd.first_reads(files.read_written(spark, path)).select("sample", "read_id", F.col("nth").cast("long").alias("nth"))


PHRED = "list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33))"
SQL_BEST = f""", s AS (SELECT *, length(seq)::BIGINT AS len, {PHRED} / length(seq) AS score FROM reads WHERE length(seq) >= 500),
 p AS (SELECT *, COALESCE(sum(len) OVER (PARTITION BY sample ORDER BY score DESC, len DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
   least(floor(sum(len) OVER (PARTITION BY sample) * 95 / 100), 100 * (SELECT sum(length(seq)) FROM ref_items)) AS target FROM s)"""


@query("n2_filter_best_bases", sql("reads ref_items", SQL_BEST + " SELECT sample, read_id, len FROM p WHERE prior < target"))
def n2(spark, d):
    n = rd.fasta_length(fx.ref_items(spark, d)).first().total_bases
    return rd.filter_best_bases(fx.reads(spark, d), n).select("sample", "read_id", F.length("seq").cast("long").alias("len"))


#: Sums of up to 250 neighbouring quality values, of which the least counts; the score weighs it with the mean.
SQL_WORST = """, q AS (SELECT sample, read_id, length(seq)::BIGINT AS len, unnest(range(1, length(qual) + 1)) AS i, unnest(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS v FROM reads WHERE length(seq) >= 500),
 w AS (SELECT sample, read_id, len, i, sum(v) OVER x AS part, sum(v) OVER (PARTITION BY sample, read_id) AS total FROM q WINDOW x AS (PARTITION BY sample, read_id ORDER BY i ROWS BETWEEN 249 PRECEDING AND CURRENT ROW)),
 s AS (SELECT sample, read_id, len, any_value(total)::BIGINT AS total, min(part)::BIGINT AS worst FROM w WHERE i >= 250 GROUP BY ALL),
 t AS (SELECT *, (worst / 250) * 0.5 + (total / len) * 0.5 AS score FROM s)"""


@query("n2_worst_windows", sql("reads", SQL_WORST + " SELECT sample, read_id, round(total / len, 6) AS mean_quality, round(worst / 250, 6) AS worst_window FROM t"))
def n2_worst(spark, d):
    rows = rd.min_length(fx.reads(spark, d)).withColumn("p", fn.quality_profile("qual"))
    return rows.select("sample", "read_id", F.round(F.col("p.total") / F.length("seq"), 6).alias("mean_quality"), F.round(F.col("p.worst") / F.col("p.width"), 6).alias("worst_window"))


@query("n2_filter_by_windows", sql("reads", SQL_WORST + """, p AS (SELECT *, COALESCE(sum(len) OVER (PARTITION BY sample ORDER BY score DESC, len DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
   floor(sum(len) OVER (PARTITION BY sample) * 60 / 100) AS target FROM t) SELECT sample, read_id, len FROM p WHERE prior < target"""))  # fmt: skip
def n2_windows(spark, d):
    kept = rd.filter_best_bases(fx.reads(spark, d), 1 << 40, keep_percent=60, score_expr="worst_window * 0.5D + mean_quality * 0.5D")
    return kept.select("sample", "read_id", F.length("seq").cast("long").alias("len"))


# --- k-mers ----------------------------------------------------------------------------------------------------------


@query("n5_kmer_windows", sql("genome_reads", f" SELECT sample, read_id, count(*) AS n, count(DISTINCT kmer) AS n_distinct, min(kmer) AS least FROM ({sql_kmers('genome_reads', 'sample, read_id', 31)}) GROUP BY ALL"))
def n5(spark, d):
    return km.kmer_counts(fx.genome_reads(spark, d), 31)


@query("n5_minimizers", sql("ref_items", f" SELECT * FROM ({sql_minimizers('ref_items', 'ref_id')})"))
def n5m(spark, d):
    return km.minimizers(fx.ref_items(spark, d), ["ref_id"]).select("ref_id", F.col("pos").cast("long").alias("pos"), "kmer")


SQL_BAIT = f", b AS (SELECT DISTINCT kmer FROM ({sql_kmers('ref', '', 31)})), hit AS (SELECT sample, read_id, count(*) AS n_kmers FROM ({sql_kmers('reads', 'sample, read_id', 31)}) WHERE kmer IN (SELECT kmer FROM b) GROUP BY ALL)"


@query("j2_bait_kmers", sql("reads ref", SQL_BAIT + " SELECT * FROM hit"))
def j2(spark, d):
    return km.bait_kmers(fx.reads(spark, d), fx.ref(spark, d))


@query("j1_extract_by_id", sql("reads ref", SQL_BAIT + " SELECT sample, read_id, md5(seq) AS seq_md5, md5(qual) AS qual_md5 FROM reads WHERE (sample, read_id) IN (SELECT (sample, read_id) FROM hit)"))
def j1(spark, d):
    r = fx.reads(spark, d)
    found = rd.extract_by_id(r, km.bait_kmers(r, fx.ref(spark, d)))
    return found.select("sample", "read_id", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.md5(F.col("qual").cast("binary")).alias("qual_md5"))


@query("j5_empty_samples", sql("reads ref", SQL_BAIT + " SELECT DISTINCT sample FROM reads WHERE sample NOT IN (SELECT sample FROM hit)"))
def j5(spark, d):
    r = fx.reads(spark, d)
    return rd.empty_samples(r, km.bait_kmers(r, fx.ref(spark, d)))


def sql_parts(c: str, k: int = 31) -> str:
    return "[" + ", ".join(f"{{'p': {i}, 'part': substr({c}, {a + 1}, {n})}}" for i, (a, n) in enumerate(km.part_bounds(k, 3))) + "]"


@query("j3_bait_kmers_hamming", sql("mutated_reads ref", f""", b AS (SELECT DISTINCT kmer FROM ({sql_kmers('ref', '', 31)})), bp AS (SELECT kmer AS bait, unnest({sql_parts('kmer')}, recursive := true) FROM b),
  own AS (SELECT sample, read_id, kmer, count(*) AS n FROM ({sql_kmers('mutated_reads', 'sample, read_id', 31)}) GROUP BY ALL),
  op AS (SELECT kmer, unnest({sql_parts('kmer')}, recursive := true) FROM (SELECT DISTINCT kmer FROM own)),
  near AS (SELECT DISTINCT op.kmer FROM op JOIN bp ON op.p = bp.p AND op.part = bp.part WHERE hamming(op.kmer, bait) <= 2)
  SELECT sample, read_id, sum(n)::BIGINT AS n_kmers FROM own WHERE kmer IN (SELECT kmer FROM near) GROUP BY ALL"""))  # fmt: skip
def j3(spark, d):
    return km.bait_kmers_hamming(fx.mutated_reads(spark, d), fx.ref(spark, d))


@query("u3_shared_kmers", sql("genomes", f" SELECT kmer FROM ({sql_kmers('genomes', 'sample', 31)}) GROUP BY kmer HAVING count(DISTINCT sample) = (SELECT count(*) FROM genomes)"))
def u3(spark, d):
    return km.shared_kmers(fx.genomes(spark, d), 31)


KS = [9, 11, 13, 15, 17, 19]


@query("a12_choose_k", sql("genomes", f""", med AS (SELECT min(sample) AS sample FROM genomes WHERE length(seq) = (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY length(seq)) FROM genomes)),
  own AS (SELECT * FROM genomes WHERE sample IN (SELECT sample FROM med)),
  c AS ({' UNION ALL '.join(f"SELECT {k} AS k, kmer, count(*) AS c FROM ({sql_kmers('own', 'sample', k)}) GROUP BY kmer" for k in KS)}),
  t AS (SELECT k, count(*) AS n_kmers, count(*) FILTER (WHERE c = 1) AS n_once FROM c GROUP BY k)
  SELECT *, round(n_once / n_kmers, 6) AS unique_share, COALESCE(k = (SELECT min(k) FROM t WHERE n_once >= 0.99 * n_kmers), false) AS chosen FROM t"""))  # fmt: skip
def a12(spark, d):
    return km.choose_k(fx.genomes(spark, d), KS)


@query("a13_kmer_pan_snps", sql("genomes", f""", o AS (SELECT DISTINCT sample, substr(kmer, 1, 12) AS "left", substr(kmer, 13, 1) AS base, substr(kmer, 14, 12) AS "right" FROM ({sql_kmers('genomes', 'sample', 25)})),
  u AS (SELECT sample, "left", "right", min(base) AS base FROM o GROUP BY ALL HAVING count(*) = 1)
  SELECT "left", "right", count(DISTINCT base) AS n_bases, count(*) AS n_samples, count(*) = (SELECT count(*) FROM genomes) AS core FROM u GROUP BY "left", "right" HAVING count(DISTINCT base) > 1"""))  # fmt: skip
def a13(spark, d):
    return km.kmer_pan_snps(fx.genomes(spark, d))


@query("a14_size_outliers", sql("reads", """, z AS (SELECT sample, sum(length(seq))::BIGINT AS length FROM reads GROUP BY sample), m AS (SELECT quantile_cont(length, 0.5) AS m FROM z)
  SELECT sample, length, round(length / m, 6) AS ratio FROM z, m WHERE round(length / m, 6) < 0.9 OR round(length / m, 6) > 1.1"""))  # fmt: skip
def a14(spark, d):
    return rd.size_outliers(fx.reads(spark, d), 0.9, 1.1)


# --- mapping ---------------------------------------------------------------------------------------------------------

def sql_chains(anchors: str, keys: str, least: int, k: int = 15) -> str:
    """CTEs that end in ``chains``: anchors numbered per pair, linked one after the other by recursion, and named by their chains.

    ``links`` carries the scores so far of every pair; the best predecessor is the nearest of the best ones. A chain keeps
    its beginning where its end, the best anchor below, is the best of all that branch off there.
    """
    on = " AND ".join(f"x.{c.strip()} = y.{c.strip()}" for c in keys.split(","))
    own = lambda t: ", ".join(f"{t}.{c.strip()}" for c in keys.split(","))
    cost = lambda g: f"CASE WHEN {g} > 0 THEN {ch.OPEN} + {g} // {ch.EXTEND} ELSE 0 END"
    value = f"""CASE WHEN dt <= 0 OR dq <= 0 OR dt > {ch.GAP} OR dq > {ch.GAP} OR abs(dt - dq) > {ch.BAND} THEN -1 ELSE f + least(dt, dq, {k}) - ({cost('abs(dt - dq)')}) END"""
    for name, text in (("dt", "(ts[i + 1] - ts[j])"), ("dq", "(qs[i + 1] - qs[j])")):
        value = re.sub(rf"\b{name}\b", text, value)
    value = re.sub(r"\bf\b", "fs[j]", value)
    return f""", an AS MATERIALIZED (SELECT {keys}, list(tpos ORDER BY tpos, qpos) AS ts, list(qpos ORDER BY tpos, qpos) AS qs, count(*) AS n FROM {anchors} GROUP BY {keys} HAVING count(*) >= {least}),
  links AS (SELECT {keys}, ts, qs, n, 1::BIGINT AS i, [{k}::BIGINT] AS fs, [0::BIGINT] AS ps FROM an
    UNION ALL SELECT {keys}, ts, qs, n, i + 1, list_append(fs, CASE WHEN list_max(vs) > {k} THEN list_max(vs) ELSE {k} END), list_append(ps, CASE WHEN list_max(vs) > {k} THEN i + 1 - list_position(list_reverse(vs), list_max(vs)) ELSE 0 END)
    FROM (SELECT *, list_transform(range(1, i + 1), lambda j: ({value})::BIGINT) AS vs FROM links WHERE i < n)),
  node AS MATERIALIZED (SELECT {keys}, i, ts[i] AS t, qs[i] AS q, fs[i] AS f, ps[i] AS p FROM (SELECT * EXCLUDE (i), unnest(range(1, n + 1)) AS i FROM links WHERE i = n)),
  up AS (SELECT {keys}, i, f, p FROM node UNION ALL SELECT {own('x')}, y.i, x.f, y.p FROM up x JOIN node y ON {on} AND x.p = y.i),
  heir AS MATERIALIZED (SELECT {own('y')}, y.p, arg_max(y.i, {{'w': x.w, 'i': -y.i}}) AS i FROM (SELECT {keys}, i, max(f) AS w FROM up GROUP BY {keys}, i) x JOIN node y ON {on} AND x.i = y.i WHERE y.p > 0 GROUP BY {own('y')}, y.p),
  walk AS (SELECT {own('y')}, y.i AS head, y.i, y.t, y.q FROM node y LEFT JOIN heir x ON {on} AND x.i = y.i AND x.p = y.p WHERE x.i IS NULL
    UNION ALL SELECT {own('x')}, x.head, y.i, y.t, y.q FROM walk x JOIN heir h ON {on.replace('y.', 'h.')} AND h.p = x.i JOIN node y ON {on} AND y.i = h.i),
  chains AS (SELECT {keys}, min(q) AS qstart, max(q) + {k} AS qend, min(t) AS tstart, max(t) + {k} AS tend, count(*) AS n_anchors FROM walk GROUP BY {keys}, head HAVING count(*) >= {least})"""


SQL_MAP = f""", tg AS (SELECT 'ref' AS ref_id, '+' AS strand, seq FROM ref UNION ALL SELECT 'ref', '-', translate(reverse(seq), 'ACGT', 'TGCA') FROM ref),
  rq AS (SELECT sample, read_id, CASE WHEN read_id % 3 = 0 THEN translate(reverse(seq), 'ACGT', 'TGCA') ELSE seq END AS seq, qual FROM genome_reads),
  t AS ({sql_minimizers('tg', 'ref_id, strand')}), q AS ({sql_minimizers('rq', 'sample, read_id')}),
  met AS (SELECT sample, read_id, ref_id, strand, q.pos AS qpos, t.pos AS tpos FROM q JOIN t USING (kmer)) {sql_chains('met', 'sample, read_id, ref_id, strand', 3)},
  nth AS (SELECT *, row_number() OVER (PARTITION BY sample, read_id ORDER BY n_anchors DESC, ref_id, strand, tstart) AS nth FROM chains),
  aln AS (SELECT g.sample, g.read_id, ref_id, strand, qstart, qend, tstart, tend, n_anchors,
    CASE WHEN nth IS NULL THEN 4 ELSE CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN nth > 1 THEN 256 ELSE 0 END END AS flag
    FROM (SELECT DISTINCT sample, read_id FROM rq) g LEFT JOIN nth ON g.sample = nth.sample AND g.read_id = nth.read_id)"""


def strands(spark, d):
    """Genome reads, every third one reversed."""
    r = fx.genome_reads(spark, d)
    return r.withColumn("seq", F.when(F.col("read_id") % 3 == 0, fn.reverse_complement("seq")).otherwise(F.col("seq")))


def alignments(spark, d):
    return mp.map_reads(strands(spark, d), fx.ref(spark, d).select(F.lit("ref").alias("ref_id"), "seq"))


@query("j4_map_reads", sql("genome_reads ref", SQL_MAP + " SELECT * FROM aln"))
def j4(spark, d):
    return alignments(spark, d)


@query("f2_mapped_only", sql("genome_reads ref", SQL_MAP + " SELECT sample, count(*) AS n FROM aln WHERE flag & 4 = 0 GROUP BY sample"))
def f2(spark, d):
    return rd.mapped_only(alignments(spark, d)).groupBy("sample").agg(F.count("*").alias("n"))


@query("f3_primary_only", sql("genome_reads ref", SQL_MAP + " SELECT sample, read_id, strand, tstart FROM aln WHERE flag & 256 = 0"))
def f3(spark, d):
    return rd.primary_only(alignments(spark, d)).select("sample", "read_id", "strand", "tstart")


@query("a6_mapped_ids", sql("genome_reads ref", SQL_MAP + " SELECT DISTINCT sample, read_id FROM aln WHERE flag & 4 = 0"))
def a6(spark, d):
    return mp.mapped_ids(alignments(spark, d))


SQL_SCORED = SQL_MAP + """, sc AS (SELECT aln.*, list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END))::BIGINT AS score
  FROM aln JOIN rq USING (sample, read_id) WHERE flag & 4 = 0 AND flag & 256 = 0)"""


@query("a7_mark_duplicates", sql("genome_reads ref", SQL_SCORED + " SELECT sample, read_id, ref_id, strand, score FROM (SELECT *, row_number() OVER (PARTITION BY sample, ref_id, strand, tstart - qstart ORDER BY score DESC, read_id) AS nth FROM sc) WHERE nth = 1"))
def a7(spark, d):
    scores = strands(spark, d).select("sample", "read_id", fn.phred_sum("qual", 15).alias("score"))
    rows = rd.primary_only(alignments(spark, d)).join(scores, ["sample", "read_id"])
    return mp.mark_duplicates(rows, "score").select("sample", "read_id", "ref_id", "strand", "score")


@query("n3_best_of_group", sql("reads", "SELECT sample, read_id FROM (SELECT *, row_number() OVER (PARTITION BY sample, length(seq) // 1000 ORDER BY length(seq) DESC, read_id) AS nth FROM reads) WHERE nth = 1"))
def n3(spark, d):
    r = fx.reads(spark, d).withColumn("len", F.length("seq")).withColumn("bin", F.floor(F.col("len") / 1000))
    return rd.best_of_group(r, ["sample", "bin"], [F.desc("len"), "read_id"]).select("sample", "read_id")


@query("o1_coordinate_sort", sql("genome_reads ref", SQL_MAP + " SELECT sample, read_id, row_number() OVER (PARTITION BY sample ORDER BY ref_id, tstart, read_id) AS place FROM aln WHERE flag & 4 = 0 AND flag & 256 = 0"))
def o1(spark, d):
    return mp.coordinate_sort(rd.primary_only(alignments(spark, d))).select("sample", "read_id", "place")


@query("j9_overlap_pairs", sql("genome_reads", f""", m AS ({sql_minimizers('genome_reads', 'sample, read_id')}),
  f AS (SELECT sample, kmer FROM m GROUP BY ALL HAVING count(DISTINCT read_id) >= 2), u AS (SELECT m.* FROM m JOIN f USING (sample, kmer)),
  met AS (SELECT a.sample, a.read_id AS a, b.read_id AS b, a.pos AS qpos, b.pos AS tpos FROM u a JOIN u b ON a.sample = b.sample AND a.kmer = b.kmer AND a.read_id < b.read_id) {sql_chains('met', 'sample, a, b', 1)}
  SELECT sample, a, b, max(least(qend - qstart, tend - tstart)) AS overlap FROM chains GROUP BY ALL HAVING max(least(qend - qstart, tend - tstart)) >= 200"""))  # fmt: skip
def j9(spark, d):
    return mp.overlap_pairs(fx.genome_reads(spark, d), least=200)


# --- adapters --------------------------------------------------------------------------------------------------------


def sql_edits(text: str, a: str, ends: bool = True, most: int = 2) -> str:
    """For every place of a text the least edits between the adapter and a part that ends there (or begins there)."""
    part = "substr(x, j - l + 1, l)" if ends else "substr(x, j, l)"
    fits = "l <= j" if ends else "j + l - 1 <= length(x)"
    lengths = f"range({len(a) - most}, {len(a) + most + 1})"
    return f"list_transform([{text}], lambda x: list_transform(range(1, length(x) + 1), lambda j: COALESCE(list_min(list_transform(list_filter({lengths}, lambda l: {fits}), lambda l: levenshtein({part}, '{a}'))), 99)))[1]"


def sql_best(d: str, earlier: bool = True, most: int = 2) -> str:
    """The places of a list of edits that are best among those within ``most``, the first of equals, or the last."""
    before, behind = (">", ">=") if earlier else (">=", ">")
    near = lambda lo, hi, op: f"COALESCE(list_min(d[{lo}:{hi}]), 99) {op} d[j]"
    return f"list_transform([{d}], lambda d: list_filter(range(1, len(d) + 1), lambda j: d[j] <= {most} AND {near(f'greatest(j - {most}, 1)', 'j - 1', before)} AND {near('j + 1', f'j + {most}', behind)}))[1]"


HEAD, TAIL = "substr(seq, 1, 150)", "substr(seq, greatest(length(seq) - 149, 1), 150)"


@query("j6_detect_adapters", sql("adapter_reads", ", f AS (SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY sample ORDER BY read_id) AS nth FROM adapter_reads) WHERE nth <= 1000) SELECT *, n_reads >= 0.01 * n_checked AS present FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) FILTER (WHERE list_min({sql_edits(HEAD, a)}) <= 2 OR list_min({sql_edits(TAIL, a)}) <= 2) AS n_reads, count(*) AS n_checked FROM f" for name, a in fx.ADAPTERS) + ")"))
def j6(spark, d):
    return ad.detect_adapters(fx.adapter_reads(spark, d), fx.adapters(spark))


@query("j7_trim_adapters", sql("adapter_reads", f""", c AS (SELECT *, greatest(0, {', '.join(f"COALESCE(list_max({sql_best(sql_edits(HEAD, a))}), 0)" for _, a in fx.ADAPTERS)}) AS lo,
  least(length(seq), {', '.join(f"COALESCE(list_min({sql_best(sql_edits(TAIL, a, False), False)}) - 1 + greatest(length(seq) - 150, 0), length(seq))" for _, a in fx.ADAPTERS)}) AS hi FROM adapter_reads)
  SELECT sample, read_id, md5(substr(seq, lo + 1, hi - lo)) AS seq_md5, md5(substr(qual, lo + 1, hi - lo)) AS qual_md5 FROM c WHERE hi > lo"""))  # fmt: skip
def j7(spark, d):
    rows = ad.trim_adapters(fx.adapter_reads(spark, d), fx.adapters(spark))
    return rows.select("sample", "read_id", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.md5(F.col("qual").cast("binary")).alias("qual_md5"))


@query("j8_split_chimeras", sql("adapter_reads", f""", e AS (SELECT sample, read_id, seq, qual, {sql_best(sql_edits('seq', fx.A5))} AS ends FROM adapter_reads),
  h AS (SELECT *, list_transform(ends, lambda j: j - list_min(list_transform(list_filter(range(18, 23), lambda l: l <= j), lambda l: {{'d': levenshtein(substr(seq, j - l + 1, l), '{fx.A5}'), 'o': abs(l - 20), 'l': l}})).l) AS starts FROM e),
  g AS (SELECT *, unnest(range(1, len(ends) + 2)) AS i FROM h),
  p AS (SELECT *, COALESCE(list_max(ends[1:i-1]), 0) AS lo, CASE WHEN i <= len(ends) THEN starts[i] ELSE length(seq) END AS hi FROM g)
  SELECT sample, read_id, read_id || '_' || i AS fragment_id, md5(substr(seq, lo + 1, hi - lo)) AS seq_md5, md5(substr(qual, lo + 1, hi - lo)) AS qual_md5 FROM p WHERE hi > lo"""))  # fmt: skip
def j8(spark, d):
    rows = ad.split_chimeras(fx.adapter_reads(spark, d), fx.A5)
    return rows.select("sample", "read_id", "fragment_id", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.md5(F.col("qual").cast("binary")).alias("qual_md5"))


# --- variants --------------------------------------------------------------------------------------------------------


def sql_flanks(t: str, c: str) -> str:
    keep = f"{c}, " if c else ""
    inner = sql_kmers(t, c, 25)
    return f"SELECT {keep}flanks, min(pos) AS pos, min(base) AS base FROM (SELECT {keep}pos + 12 AS pos, substr(kmer, 1, 12) || substr(kmer, 14, 12) AS flanks, substr(kmer, 13, 1) AS base FROM ({inner})) GROUP BY {keep}flanks HAVING count(*) = 1"


SQL_SITES = f", rf AS ({sql_flanks('ref', '')}), gf AS ({sql_flanks('genomes', 'sample')}), sites AS (SELECT sample, rf.pos, rf.base AS ref_base, gf.base FROM gf JOIN rf USING (flanks))"
SQL_CORE = SQL_SITES + ", core AS (SELECT pos, count(DISTINCT base) AS n_bases FROM sites GROUP BY pos HAVING count(DISTINCT sample) = (SELECT count(*) FROM genomes))"
SQL_PATTERNS = SQL_CORE + ", cols AS (SELECT pos, string_agg(base, '' ORDER BY sample) AS pattern FROM sites WHERE pos IN (SELECT pos FROM core) GROUP BY pos), pat AS (SELECT pattern, count(*) AS weight FROM cols GROUP BY pattern)"
SQL_NUM = ", num AS (SELECT sample, row_number() OVER (ORDER BY sample) AS i FROM genomes)"


def called(spark, d):
    """The called sites as a stage table: core sites, patterns and replicates all read them."""
    return stage_table(va.called_sites(fx.genomes(spark, d), fx.ref(spark, d)), "sites")


@query("j10_call_snps", sql("genomes", SQL_SITES + " SELECT * FROM sites WHERE base <> ref_base"))
def j10(spark, d):
    return va.call_snps(fx.genomes(spark, d), fx.ref(spark, d)).withColumn("pos", F.col("pos").cast("long"))


def sql_unique(t: str, c: str, pos: str, k: int = 21) -> str:
    keep = f"{c}, " if c else ""
    return f"SELECT {keep}kmer, min(pos) AS {pos} FROM ({sql_kmers(t, c, k)}) GROUP BY {keep}kmer HAVING count(*) = 1"


#: Runs by gaps and islands, each paired with the first later one that is near enough in both sequences.
SQL_GAPS = f""", anchor AS (SELECT sample, p, q, q - p AS d FROM ({sql_unique('ref', '', 'p')}) JOIN ({sql_unique('varied_genomes', 'sample', 'q')}) USING (kmer)),
  run AS (SELECT sample, d, min(p) AS ps, max(p) AS pe, min(q) AS qs, max(q) AS qe FROM (SELECT *, p - row_number() OVER (PARTITION BY sample, d ORDER BY p) AS island FROM anchor) GROUP BY sample, d, island),
  pair AS (SELECT a.sample, a.pe, a.qe, min({{'ps': b.ps, 'qs': b.qs}}) AS s FROM run a JOIN run b ON a.sample = b.sample AND b.ps > a.pe AND b.qs > a.qe AND b.ps - a.pe <= 221 AND b.qs - a.qe <= 221 GROUP BY ALL),
  cut AS (SELECT *, greatest(0, pe + 21 - s.ps, qe + 21 - s.qs) AS o FROM pair),
  gap AS (SELECT cut.sample, pe + 21 - o AS pos, substr(ref.seq, pe + 22 - o, s.ps - pe - 21 + o) AS x, substr(g.seq, qe + 22 - o, s.qs - qe - 21 + o) AS y FROM cut JOIN varied_genomes g USING (sample), ref),
  tail AS (SELECT sample, pos, x[:length(x) - n] AS x, y[:length(y) - n] AS y FROM (SELECT *, len(list_filter(range(1, least(length(x), length(y)) + 1), lambda i: right(x, i) = right(y, i))) AS n FROM gap WHERE length(x) <> length(y)))"""


@query("j10_gap_variants", sql("varied_genomes", SQL_GAPS + """ SELECT sample, pos + i - 1 AS pos, x[i] AS ref_text, y[i] AS text FROM (SELECT *, unnest(range(1, length(x) + 1)) AS i FROM gap WHERE length(x) = length(y)) WHERE x[i] <> y[i]
  UNION ALL SELECT sample, pos + n AS pos, x[n + 1:] AS ref_text, y[n + 1:] AS text FROM (SELECT *, len(list_filter(range(1, least(length(x), length(y)) + 1), lambda i: x[:i] = y[:i])) AS n FROM tail)"""))  # fmt: skip
def j10_gaps(spark, d):
    return va.gap_variants(fx.varied_genomes(spark, d), fx.ref(spark, d))


@query("f6_coverage_cutoff", sql("genomes", SQL_SITES + " SELECT sample, count(DISTINCT pos) AS covered, round(count(DISTINCT pos) / (SELECT length(seq) FROM ref), 6) AS share FROM sites GROUP BY sample HAVING count(DISTINCT pos) >= 0.1 * (SELECT length(seq) FROM ref)"))
def f6(spark, d):
    n = rd.fasta_length(fx.ref(spark, d)).first().total_bases
    return va.coverage_cutoff(called(spark, d), n)


@query("a9_core_sites", sql("genomes", SQL_CORE + " SELECT * FROM core"))
def a9(spark, d):
    return va.core_sites(called(spark, d), fx.genomes(spark, d)).withColumn("pos", F.col("pos").cast("long"))


@query("c1_core_alignment", sql("genomes", SQL_CORE + " SELECT sample, string_agg(base, '' ORDER BY pos) AS aligned FROM sites WHERE pos IN (SELECT pos FROM core) GROUP BY sample"))
def c1(spark, d):
    s = called(spark, d)
    return va.core_alignment(s, va.core_sites(s, fx.genomes(spark, d)))


def patterns(spark, d):
    s = called(spark, d)
    return va.site_patterns(s, va.core_sites(s, fx.genomes(spark, d)))


@query("c2_site_patterns", sql("genomes", SQL_PATTERNS + " SELECT * FROM pat"))
def c2(spark, d):
    return patterns(spark, d)


SQL_PAIRS = SQL_NUM + ", pr AS (SELECT x.sample AS a, y.sample AS b, x.i AS i, y.i AS j FROM num x JOIN num y ON x.sample < y.sample)"


@query("c3_snp_distance", sql("genomes", SQL_PATTERNS + SQL_PAIRS + """, n AS (SELECT a, b, COALESCE(sum(weight) FILTER (WHERE pattern[i] <> pattern[j]), 0)::BIGINT AS n_diff FROM pr, pat GROUP BY a, b),
  t AS (SELECT sum(weight) AS n FROM pat)
  SELECT a, b, n_diff, round(n_diff / n, 6) AS p_distance, round(CASE WHEN n_diff / n < 0.75 THEN -0.75 * ln(1 - 4 * (n_diff / n) / 3) END, 6) + 0.0 AS jc_distance FROM n, t"""))  # fmt: skip
def c3(spark, d):
    return va.snp_distance(patterns(spark, d), fx.genomes(spark, d))


REPS = 100
SQL_DRAWN = SQL_CORE + f""", nsite AS (SELECT count(*) AS n FROM core), dr AS (SELECT rep::INT AS rep, ({fx.sql_draw("'1234|' || rep || '|' || j")} % n)::INT AS site FROM nsite, range(1, {REPS + 1}) a(rep), LATERAL (SELECT unnest(range(0, n)) AS j)),
  boot AS (SELECT rep, site, count(*) AS weight FROM dr GROUP BY ALL UNION ALL SELECT 0, unnest(range(0, n))::INT, 1 FROM nsite)"""


@query("c4_bootstrap_sites", sql("genomes", SQL_DRAWN + " SELECT * FROM boot"))
def c4(spark, d):
    s = called(spark, d)
    return va.bootstrap_sites(spark, va.core_sites(s, fx.genomes(spark, d)).count(), REPS)


SQL_BOOT = SQL_DRAWN + SQL_PAIRS + """, cols AS (SELECT pos, string_agg(base, '' ORDER BY sample) AS pattern FROM sites WHERE pos IN (SELECT pos FROM core) GROUP BY pos),
  nc AS (SELECT pattern, row_number() OVER (ORDER BY pos) - 1 AS site FROM cols), bp AS (SELECT rep, pattern, sum(weight) AS weight FROM boot JOIN nc USING (site) GROUP BY ALL),
  vp AS (SELECT pattern FROM bp GROUP BY pattern HAVING len(list_distinct(string_split(pattern, ''))) > 1),
  dif AS (SELECT pattern, a, b FROM vp, pr WHERE pattern[i] <> pattern[j]),
  bd AS (SELECT rep, a, b, sum(weight)::BIGINT AS n_diff FROM bp JOIN dif USING (pattern) GROUP BY ALL)"""


def boot(spark, d):
    s, g = called(spark, d), fx.genomes(spark, d)
    return va.bootstrap_distance(va.bootstrap_patterns(s, va.core_sites(s, g), REPS), g)


@query("c5_bootstrap_distance", sql("genomes", SQL_BOOT + " SELECT * FROM bd"))
def c5(spark, d):
    return boot(spark, d)


@query("c6_nj_clades")
def c6(spark, d):
    return tr.nj_clades(boot(spark, d), fx.genomes(spark, d))


@query("c7_clade_support")
def c7(spark, d):
    return tr.clade_support(tr.nj_clades(boot(spark, d), fx.genomes(spark, d)), REPS)


@query("c8_nearest_neighbours", sql("genomes", SQL_BOOT + f""", ev AS (SELECT x.sample AS a, y.sample AS b, rep::INT AS rep FROM num x, num y, range(1, {REPS + 1}) t(rep) WHERE x.sample <> y.sample),
  both_ AS (SELECT rep, a, b, n_diff FROM bd UNION ALL SELECT rep, b, a, n_diff FROM bd),
  f AS (SELECT ev.rep, ev.a, min({{'n': COALESCE(n_diff, 0), 'b': ev.b}}).b AS nearest FROM ev LEFT JOIN both_ x ON ev.rep = x.rep AND ev.a = x.a AND ev.b = x.b GROUP BY ev.rep, ev.a)
  SELECT a AS sample, nearest, count(*) AS n_reps FROM f GROUP BY ALL"""))  # fmt: skip
def c8(spark, d):
    return va.nearest_neighbours(boot(spark, d), fx.genomes(spark, d), REPS)


# --- assembly --------------------------------------------------------------------------------------------------------

SQL_PILE = f""", rf AS ({sql_flanks('ref', '')}), pk AS (SELECT sample, substr(kmer, 1, 12) || substr(kmer, 14, 12) AS flanks, substr(kmer, 13, 1) AS base, count(*) AS n FROM ({sql_kmers('genome_reads', 'sample', 25)}) GROUP BY ALL),
  best AS (SELECT sample, rf.pos, max({{'n': pk.n, 'b': pk.base}}).b AS base FROM pk JOIN rf USING (flanks) GROUP BY sample, rf.pos),
  site AS (SELECT pos, substr(seq, pos + 1, 1) AS base FROM (SELECT seq, unnest(range(0, length(seq))) AS pos FROM ref)),
  cons AS (SELECT s.sample, string_agg(COALESCE(best.base, site.base), '' ORDER BY site.pos) AS seq, count(best.base) AS n_called
    FROM (SELECT DISTINCT sample FROM best) s CROSS JOIN site LEFT JOIN best ON best.sample = s.sample AND best.pos = site.pos GROUP BY s.sample)"""


@query("a8_pileup_consensus", sql("genome_reads", SQL_PILE + " SELECT sample, md5(seq) AS seq_md5, n_called FROM cons"))
def a8(spark, d):
    c = asm.pileup_consensus(fx.genome_reads(spark, d), fx.ref(spark, d))
    return c.select("sample", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), "n_called")


@query("a3_assembly_stats", sql("genome_reads", SQL_PILE + " SELECT cons.sample, 1::BIGINT AS n_contigs, length(cons.seq)::BIGINT AS assembly_length, round(b / length(cons.seq), 6) AS mean_coverage FROM cons JOIN (SELECT sample, sum(length(seq)) AS b FROM genome_reads GROUP BY sample) USING (sample)"))
def a3(spark, d):
    r = fx.genome_reads(spark, d)
    return asm.assembly_stats(asm.pileup_consensus(r, fx.ref(spark, d)), r)


@query("a10_renumber_contigs", sql("reads", "SELECT sample, read_id, sample || '_' || row_number() OVER (PARTITION BY sample ORDER BY read_id) AS contig_id FROM reads"))
def a10(spark, d):
    return asm.renumber_contigs(fx.reads(spark, d), "read_id").select("sample", "read_id", "contig_id")


@query("a11_unitigs", sql("ref_items", f""", e AS MATERIALIZED (SELECT DISTINCT kmer, kmer[1:14] AS src, kmer[2:15] AS dst FROM ({sql_kmers('ref_items', 'ref_id', 15)})),
  thr AS MATERIALIZED (SELECT i.node, i.prev FROM (SELECT dst AS node, min(kmer) AS prev, count(*) AS n FROM e GROUP BY dst) i JOIN (SELECT src AS node, count(*) AS n FROM e GROUP BY src) o ON i.node = o.node WHERE i.n = 1 AND o.n = 1),
  nxt AS MATERIALIZED (SELECT e.kmer, thr.prev FROM e LEFT JOIN thr ON e.src = thr.node)
  SELECT seq, n_kmers FROM (WITH RECURSIVE walk AS (
    SELECT kmer AS head, kmer AS at, kmer AS seq, 1::BIGINT AS n_kmers FROM nxt WHERE prev IS NULL
    UNION ALL SELECT head, nxt.kmer, seq || nxt.kmer[15], n_kmers + 1 FROM walk JOIN nxt ON nxt.prev = walk.at)
  SELECT head, arg_max(seq, n_kmers) AS seq, max(n_kmers) AS n_kmers FROM walk GROUP BY head)"""))  # fmt: skip
def a11(spark, d):
    return asm.unitigs(fx.ref_items(spark, d), 15)


SQL_LOG_SUMS = "SELECT source AS sample, sum(n_chars)::BIGINT AS n, count(*) AS k FROM documents GROUP BY source"
SQL_FLYE = f'SELECT sample AS "Sample", n AS "TotalBases", k AS "ReadsN50", n AS "AssemblyLength", CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS "Contigs", k AS "Coverage" FROM ({SQL_LOG_SUMS})'
SQL_SHASTA = f'SELECT sample AS "Sample", k AS "ReadNumber", n AS "TotalBases", k AS "ReadsN50", n AS "AssemblyLength", CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS "Contigs" FROM ({SQL_LOG_SUMS})'


@query("a4_flye_stats", SQL_FLYE)
def a4(spark, d):
    return lg.flye_stats(fx.log_lines(spark, d))


@query("a5_shasta_stats", SQL_SHASTA)
def a5(spark, d):
    return lg.shasta_stats(fx.log_lines(spark, d))


@query("u1_union_stats", f'SELECT *, NULL::BIGINT AS "ReadNumber" FROM ({SQL_FLYE}) UNION ALL SELECT "Sample", "TotalBases", "ReadsN50", "AssemblyLength", "Contigs", NULL, "ReadNumber" FROM ({SQL_SHASTA})')
def u1(spark, d):
    lines = fx.log_lines(spark, d)
    return rd.union_stats(lg.flye_stats(lines), lg.shasta_stats(lines))


@query("u2_add_reference", sql("genomes", "SELECT sample::VARCHAR AS sample, md5(seq) AS seq_md5 FROM genomes UNION ALL SELECT 'reference', md5(seq) FROM ref"))
def u2(spark, d):
    return rd.add_reference(fx.genomes(spark, d), fx.ref(spark, d)).select("sample", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


# --- files: what is written is read again, and equals the tables -------------------------------------------------------


def written_reads(spark, d):
    path = stage_path(spark, "fastq")
    files.write_reads(fx.reads(spark, d), path)
    return path


@query("r1_discover_samples", sql("paths", ", s AS (SELECT replace(replace(split_part(string_split(path, '/')[-1], '.', 1), '_pass', ''), '_filtered', '') AS sample, path FROM paths WHERE " + " OR ".join(f"ends_with(path, '{e}')" for e in fn.EXTENSIONS) + ") SELECT sample, max(path) AS path FROM s GROUP BY sample"))
def r1(spark, d):
    return files.samples_of(fx.paths(spark, d))


@query("r1_discover_folder", sql("reads", "SELECT DISTINCT sample, sample || '.fastq.gz' AS file FROM reads"))
def r1_folder(spark, d):
    """The samples of a folder of files."""
    found = files.discover_samples(spark, written_reads(spark, d))
    return found.select("sample", fn.base_name("path").alias("file"))


@query("r6_validate_inputs", sql("reads ref_items", "SELECT DISTINCT sample || '.fastq.gz' AS file, true AS accepted FROM reads UNION ALL SELECT 'ref.fasta', true"))
def r6(spark, d):
    """A folder of reads and a reference that pass; a folder with another file, and a reference that is none, are refused."""
    path, other = written_reads(spark, d), stage_path(spark, "inputs")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_id", "seq"))), lambda x: F.concat(F.lit(">"), x["ref_id"].cast("string"), F.lit("\n"), x["seq"])), "\n")
    files.write_texts(fx.ref_items(spark, d).agg(F.lit("ref.fasta").alias("name"), text.alias("text")), other)
    files.write_texts(spark.range(1).select(F.lit("bad/notes.txt").alias("name"), F.lit("no sequence").alias("text")), other)
    files.validate_inputs(spark, path, f"{other}/ref.fasta")
    for folder, reference in ((f"{other}/bad", f"{other}/ref.fasta"), (path, f"{other}/bad/notes.txt")):
        try:
            files.validate_inputs(spark, folder, reference)
        except ValueError:
            continue
        raise AssertionError("inputs that are wrong were accepted")
    names = files.list_files(spark, path).unionByName(files.list_files(spark, other).where(~F.col("path").contains("/bad/")))
    return names.select(fn.base_name("path").alias("file"), fn.accepted_extension("path").alias("accepted"))


@query("r7_list_assemblies", sql("genomes", "SELECT sample::VARCHAR AS sample, sample || '.fasta' AS file FROM genomes"))
def r7(spark, d):
    path = stage_path(spark, "assemblies")
    g = fx.genomes(spark, d).withColumn("sample", F.col("sample").cast("string"))
    files.write_texts(g.select(F.concat("sample", F.lit(".fasta")).alias("name"), F.concat(F.lit(">"), "sample", F.lit("\n"), "seq", F.lit("\n")).alias("text")), path)
    return files.list_assemblies(spark, path).select("sample", fn.base_name("path").alias("file"))


def log_folder(spark, d, name):
    """Each sample's log lines as one file, whose name the column gives."""
    path = stage_path(spark, "logs")
    rows = fx.log_lines(spark, d).groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("a"))
    files.write_texts(rows.select(name.alias("name"), F.array_join(F.transform("a", lambda x: x["line"]), "\n").alias("text")), path)
    return path


SQL_LINES = f"""SELECT sample, (i - 1)::BIGINT AS line_no, ls[i] AS line FROM (SELECT sample, unnest(range(1, 13)) AS i, ['[start] nothing', 'Total read length: ' || k, 'Total read length: ' || n, 'Reads N50/N90: ' || k || ' / 7',
  chr(9) || 'Total length:' || chr(9) || n, CASE WHEN k % 3 = 0 THEN 'none' ELSE chr(9) || 'Fragments:' || chr(9) || k END, chr(9) || 'Mean coverage:' || chr(9) || k, 'Total number of reads is ' || k || '.',
  'Total number of raw bases is ' || n || '.', 'N50 for read length is ' || k || ' bases.', 'Total length of assembled sequence is ' || n, CASE WHEN k % 3 = 0 THEN 'none' ELSE 'The assembly graph has ' || k || ' vertices and' END] AS ls FROM ({SQL_LOG_SUMS}))"""


@query("r4_read_log_lines", SQL_LINES)
def r4(spark, d):
    return files.read_log_lines(spark, log_folder(spark, d, F.concat("sample", F.lit("/flye.log"))))


@query("r5_read_stdout_lines", SQL_LINES)
def r5(spark, d):
    return files.read_stdout_lines(spark, log_folder(spark, d, F.concat("sample", F.lit("_shasta_stdout.txt"))))


@query("r3_read_fasta", sql("reads", "SELECT sum(length(seq))::BIGINT AS total_bases FROM reads"))
def r3(spark, d):
    path = stage_path(spark, "fasta")
    files.write_contigs(asm.renumber_contigs(fx.reads(spark, d), "read_id"), path)
    return rd.fasta_length(files.read_fasta(spark, path))


@query("r8_read_xmfa_blocks", sql("genomes", SQL_CORE + " SELECT sample::VARCHAR AS entry, string_agg(base, '' ORDER BY pos) AS aligned FROM sites WHERE pos IN (SELECT pos FROM core) GROUP BY sample"))
def r8(spark, d):
    s, path = called(spark, d), stage_path(spark, "xmfa")
    files.write_xmfa(va.core_alignment(s, va.core_sites(s, fx.genomes(spark, d))), path)
    return files.read_xmfa_blocks(spark, path)


@query("w1_write_reads", sql("reads", """SELECT sample, read_id::VARCHAR AS read_id, CASE WHEN read_id % 4 = 0 THEN '>' ELSE '@' END || read_id || ' of ' || sample AS header,
  md5(seq) AS seq_md5, md5(CASE WHEN read_id % 4 <> 0 THEN qual END) AS qual_md5 FROM reads"""))  # fmt: skip
def w1(spark, d):
    """Every fourth read is without quality, so that both formats are written; whole headers come back."""
    path = stage_path(spark, "fastq")
    r = fx.reads(spark, d).withColumn("header", F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit(" of "), F.col("sample")))
    files.write_reads(r.withColumn("qual", F.when(F.col("read_id") % 4 != 0, F.col("qual"))), path)
    rows = files.read_written(spark, path)
    return rows.select("sample", "read_id", "header", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.md5(F.col("qual").cast("binary")).alias("qual_md5"))


@query("r2_read_fastq", sql("reads", "SELECT read_id::VARCHAR AS read_id, '@' || read_id AS header, length(seq)::BIGINT AS n, md5(qual) AS qual_md5 FROM reads"))
def r2(spark, d):
    rows = files.read_fastq(spark, written_reads(spark, d))
    return rows.select("read_id", "header", F.length("seq").cast("long").alias("n"), F.md5(F.col("qual").cast("binary")).alias("qual_md5"))


@query("w2_write_contigs", sql("reads", "SELECT sample || '_' || row_number() OVER (PARTITION BY sample ORDER BY read_id) AS name, md5(seq) AS seq_md5 FROM reads"))
def w2(spark, d):
    path = stage_path(spark, "fasta")
    files.write_contigs(asm.renumber_contigs(fx.reads(spark, d), "read_id"), path)
    return files.read_fasta(spark, path).select("name", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query("w3_write_stats_tsv", SQL_FLYE)
def w3(spark, d):
    path = stage_path(spark, "stats")
    stats = lg.flye_stats(fx.log_lines(spark, d))
    files.write_stats_tsv(stats, path)
    return files.read_stats_tsv(spark, path, "Sample string, TotalBases long, ReadsN50 long, AssemblyLength long, Contigs long, Coverage long")


@query("w4_materialize_stage", sql("reads", SQL_NX + " SELECT * FROM nx"))
def w4(spark, d):
    path = stage_path(spark, "stage")
    materialize_stage(spark, path, lambda: rd.nx(fx.reads(spark, d)))
    return materialize_stage(spark, path, lambda: rd.nx(fx.reads(spark, d)).limit(0))


@query("w4_materialize_samples", sql("reads", SQL_NX + ", w AS (SELECT min(sample) AS low, max(sample) AS high FROM reads) SELECT nx.*, CASE WHEN sample = low THEN 3 WHEN sample = high THEN 2 ELSE 1 END AS computed FROM nx, w"))
def w4_samples(spark, d):
    """All samples but the last, then all, then all once more with the first one forgotten: each time, what is open is computed."""
    path, reads = stage_path(spark, "stage"), fx.reads(spark, d)
    named = reads.agg(F.min("sample").alias("low"), F.max("sample").alias("high"))  # one row
    step = lambda n: lambda own: rd.nx(own).withColumn("computed", F.lit(n))
    materialize_samples(spark, path, reads.join(F.broadcast(named), F.col("sample") != F.col("high"), "left_semi"), step(1))
    materialize_samples(spark, path, reads, step(2))
    forget_samples(named.select(F.col("low").alias("sample")), path)
    return materialize_samples(spark, path, reads, step(3))


# --- the five stages in one plan ----------------------------------------------------------------------------------------


@query("flagship_bait_filter_stats", sql("reads ref", SQL_BAIT + f""", k AS (SELECT * FROM reads WHERE (sample, read_id) IN (SELECT (sample, read_id) FROM hit) AND length(seq) >= 500),
  s AS (SELECT *, length(seq)::BIGINT AS len, {PHRED} / length(seq) AS score FROM k),
  p AS (SELECT *, COALESCE(sum(len) OVER (PARTITION BY sample ORDER BY score DESC, len DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
    least(floor(sum(len) OVER (PARTITION BY sample) * 95 / 100), 100 * (SELECT length(seq) FROM ref)) AS target FROM s),
  best AS (SELECT * FROM p WHERE prior < target)""" + SQL_NX.replace("FROM reads", "FROM best") + " SELECT sample, count(*) AS n_reads, sum(len)::BIGINT AS total_bases, n50, n90 FROM best JOIN nx USING (sample) GROUP BY sample, n50, n90"))  # fmt: skip
def flagship(spark, d):
    from readloom.plans.pipeline import bait_filter_stats

    return bait_filter_stats(fx.reads(spark, d), fx.ref(spark, d))
