"""Line dedup by distinct-site spread: sketches of sites per line, exact counts near the threshold, removal across sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import WORD, stage_table

#: From so many words on, so many distinct sites, and as many distinct texts, make a line boilerplate. Long lines do not
#: recur by chance; lines of a few words do, so they must be almost everywhere.
THRESHOLDS = ((0, 10), (8, 3), (51, 2))
#: White space around a line, which does not count.
BLANKS = " \t\r\x0b\x0c"


def line_rows(docs: DataFrame, thresholds: tuple[tuple[int, int], ...] = THRESHOLDS) -> DataFrame:
    """One row per line that is not blank: two hashes of the trimmed line, its threshold, its site, and its document and place."""
    lines = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("doc_hash"),
        F.coalesce(F.xxhash64(F.concat(F.lit("s"), F.col("source").cast("string"))), F.lit(0).cast("long")).alias("site"),
        F.posexplode(F.split("text", "\n", -1)).alias("place", "line"),
    ).withColumn("line", F.trim("line", F.lit(BLANKS)))
    need = F.lit(thresholds[0][1])
    if len(thresholds) > 1:
        words = F.regexp_count("line", F.lit(WORD))
        for least, sites in thresholds[1:]:
            need = F.when(words >= least, sites).otherwise(need)
    # The seed of the second hash is the hash of another column, so the two are not one hash twice.
    return lines.where("line <> ''").select("doc_id", "doc_hash", "site", "place", need.alias("need"), F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(1), "line").alias("l2"))


def boilerplate(lines: DataFrame, log_size: int = 12, band: float = 0.15) -> DataFrame:
    """Rows (l1, l2, first): lines on ``need`` distinct sites or more and in as many distinct texts, with the place that they have first.

    Sketches of a line's sites and texts are built where its rows lie and merged in the shuffle, so a line that a third
    of all documents carry is a few sketches by then. Estimates within ``band`` of the threshold (over nine standard
    errors of a sketch of ``2**log_size`` registers, and one site at least) are settled by counting exactly.
    """
    spread = lines.groupBy("l1", "l2").agg(
        F.count("*").alias("n"),
        F.min("need").alias("need"),
        F.hll_sketch_agg("site", F.lit(log_size)).alias("sites"),
        F.hll_sketch_agg("doc_hash", F.lit(log_size)).alias("texts"),
        F.min(F.struct("doc_id", "doc_hash", "place")).alias("first"),
    )
    # A line has no more sites than rows. The lesser of both counts decides.
    estimate = F.least(F.hll_sketch_estimate("sites"), F.hll_sketch_estimate("texts"))
    spread = stage_table(spread.where(F.col("n") >= F.col("need")).select("l1", "l2", "need", "first", estimate.alias("estimate")), "spread")
    width = F.greatest(F.lit(1.0), band * F.col("need"))
    near = F.abs(F.col("estimate") - F.col("need")) <= width
    exact = (
        lines.join(spread.where(near).select("l1", "l2"), ["l1", "l2"], "left_semi")
        .groupBy("l1", "l2")
        .agg(F.min("need").alias("need"), F.count_distinct("site").alias("sites"), F.count_distinct("doc_hash").alias("texts"))
        .where((F.col("sites") >= F.col("need")) & (F.col("texts") >= F.col("need")))
    )
    sure = spread.where(~near & (F.col("estimate") > F.col("need")))
    return sure.select("l1", "l2", "first").unionByName(spread.join(exact, ["l1", "l2"], "left_semi").select("l1", "l2", "first"))


def remove_boilerplate(docs: DataFrame, thresholds: tuple[tuple[int, int], ...] = THRESHOLDS) -> DataFrame:
    """``docs`` with its text less the lines that many distinct sources carry, and n_lines, n_removed.

    How many is many depends on the line's words, see ``thresholds``. As many distinct texts must hold the line, so that
    copies of whole documents, however many, do not lose their lines. Lines are compared without white space around
    them; blank lines are never boilerplate. Of each boilerplate line the first occurrence stays (smallest doc_id, null
    before all; then hash of the text; then place), so no passage is lost from the collection. All other lines stay as
    they are, in order. A null source is a site of its own. A null text stays null with 0 lines; an empty one is one
    blank line. Rows equal in doc_id and text are treated alike. Extra columns are kept, whatever their names; columns
    named n_lines or n_removed are replaced. An empty table gives an empty result. A document whose lines all go has
    an empty text; no row is dropped.
    """
    lines = stage_table(line_rows(docs, thresholds), "lines")
    drop = (
        lines.join(boilerplate(lines), ["l1", "l2"])
        .where(F.struct("doc_id", "doc_hash", "place") != F.col("first"))
        .groupBy("doc_id", "doc_hash")
        .agg(F.collect_set("place").alias("places"))
        .select(F.struct("doc_id", "doc_hash").alias("of"), "places")
    )
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    # The row goes along as one column, so that none of its names meets another.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    out = rows.join(drop, F.col("own_id").eqNullSafe(F.col("of.doc_id")) & (F.col("own_hash") == F.col("of.doc_hash")), "left")
    text = F.col("row.text")
    split = F.split(text, "\n", -1)
    clean = F.array_join(F.filter(split, lambda line, i: ~F.array_contains(F.col("places"), i)), "\n")
    return out.select(
        *[F.when(F.col("places").isNull(), text).otherwise(clean).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns],
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("places")).cast("long").alias("n_removed"),
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, source, generate_subscripts(a, 1) - 1 AS place, trim(unnest(a), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, text, source, string_split(text, chr(10)) AS a FROM documents)),
w AS (SELECT line, count(DISTINCT COALESCE('s' || source, '')) AS sites, count(DISTINCT text) AS texts,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
      FROM l WHERE line <> '' GROUP BY line),
b AS (SELECT line FROM w WHERE LEAST(sites, texts) >= CASE WHEN words >= 51 THEN 2 WHEN words >= 8 THEN 3 ELSE 10 END),
r AS (SELECT doc_id, place, row_number() OVER (PARTITION BY l.line ORDER BY doc_id, place) AS nth FROM l JOIN b ON l.line = b.line),
d AS (SELECT doc_id, list(place) AS places FROM r WHERE nth > 1 GROUP BY doc_id)
SELECT documents.doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, COALESCE(len(places), 0)::BIGINT AS n_removed,
       CASE WHEN places IS NULL THEN text
            ELSE COALESCE(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(places, i - 1)), chr(10)), '') END AS text
FROM documents LEFT JOIN d ON documents.doc_id = d.doc_id
"""
