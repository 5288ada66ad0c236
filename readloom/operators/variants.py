"""Core variants between samples: calls between unique flanks, alignments, site patterns, distances and bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.sequence import draw
from readloom.operators.kmers import broadcast_if_small, kmers, tiles
from readloom.operators.ranks import ranked


def unique_flanks(seqs: DataFrame, keep: list[str], h: int) -> DataFrame:
    """Rows (keep, pos, flanks, base): bases whose pair of flanks of ``h`` bases occurs once within ``keep``; pos is 0-based."""
    own = kmers(seqs, 2 * h + 1, keep).select(
        *keep, (F.col("pos") + h).alias("pos"), F.concat(F.substring("kmer", 1, h), F.substring("kmer", h + 2, h)).alias("flanks"), F.substring("kmer", h + 1, 1).alias("base")
    )
    return own.groupBy(*keep, "flanks").agg(F.count("*").alias("n"), F.min("pos").alias("pos"), F.min("base").alias("base")).where("n = 1").drop("n")


def called_sites(genomes: DataFrame, ref: DataFrame, h: int = 12) -> DataFrame:
    """Rows (sample, pos, ref_base, base): reference sites whose flanks the sample has, unique in both."""
    r = unique_flanks(ref.select("seq"), [], h).select("flanks", "pos", F.col("base").alias("ref_base"))
    own = unique_flanks(genomes, ["sample"], h).select("sample", "flanks", "base")
    return own.join(broadcast_if_small(r), "flanks").select("sample", "pos", "ref_base", "base")


def call_snps(genomes: DataFrame, ref: DataFrame, h: int = 12) -> DataFrame:
    """Called sites whose base differs from the reference. Substitutions only; a change within ``h`` bases hides a site."""
    return called_sites(genomes, ref, h).where("base <> ref_base")


def unique_kmers(seqs: DataFrame, keep: list[str], k: int) -> DataFrame:
    """Rows (keep, kmer, pos): k-mers that occur once within ``keep``, with their 0-based place."""
    own = kmers(seqs, k, keep).groupBy(*keep, "kmer").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    return own.where("n = 1").drop("n")


def parts_at(seqs: DataFrame, keep: list[str], places: DataFrame, at: str, size: str, longest: int, name: str, tile: int = 256) -> DataFrame:
    """``places`` with the ``size`` bases from the 0-based place ``at`` of their sequence on, ``longest`` at most, as ``name``.

    The sequence is joined in overlapping tiles, so that none is walked from its start for every place. The place behind
    its last base has a tile, too, as a part of no bases may lie there.
    """
    padded = seqs.select(*keep, F.concat("seq", F.repeat(F.lit("-"), F.lit(longest + 1))).alias("seq"))
    own = tiles(padded, keep, longest + 1, longest, tile=tile).withColumnRenamed("o", "_o").withColumnRenamed("t", "_t")
    found = places.withColumn("_o", (F.floor(F.col(at) / tile) * tile).cast("int")).join(own, [*keep, "_o"])
    return found.withColumn(name, F.substr("_t", F.col(at) - F.col("_o") + 1, F.col(size))).drop("_o", "_t")


def gap_variants(genomes: DataFrame, ref: DataFrame, k: int = 21, longest: int = 200) -> DataFrame:
    """Rows (sample, pos, ref_text, text): what differs between neighbouring runs of k-mers that are unique in reference and sample.

    A run is unbroken on one diagonal. The end of each is paired with the next start that lies behind it in both
    sequences, at most ``longest`` bases on; so changes need no unchanged flanks between them. Where the gap is as long in both,
    it is compared base by base; else what both texts begin and end with is cut off, and the rest is one change, placed
    as far left as the gap allows: an insertion has an empty ``ref_text``, a deletion an empty ``text``. Where runs overlap, as
    in repeats, the gap begins earlier by that overlap. ``pos`` is 0-based in the reference. Only the ends of runs are
    paired, by bins of the reference, so no window holds a genome. Null or short sequences give none.
    """
    r = unique_kmers(ref.select("seq"), [], k).withColumnRenamed("pos", "p")
    own = unique_kmers(genomes, ["sample"], k).withColumnRenamed("pos", "q")
    anchors = own.join(broadcast_if_small(r), "kmer").select("sample", "p", "q", (F.col("q") - F.col("p")).alias("d"))
    # Each anchor says of itself that it is there, and of both neighbours that they have one: one shuffle finds all ends.
    says = F.explode(F.array(*[F.struct((F.col("p") + x).alias("p"), F.lit(x).alias("x")) for x in (-1, 0, 1)]))
    near = anchors.select("sample", "d", says.alias("s")).groupBy("sample", "d", "s.p").agg(F.collect_set("s.x").alias("x"))
    edge = near.where(F.array_contains("x", 0) & (F.size("x") < 3))
    reach = k + longest
    last = edge.where(~F.array_contains("x", -1)).select("sample", F.floor(F.col("p") / reach).alias("bin"), F.col("p").alias("pe"), (F.col("p") + F.col("d")).alias("qe"))
    first = edge.where(~F.array_contains("x", 1)).select("sample", F.col("p").alias("ps"), (F.col("p") + F.col("d")).alias("qs"))
    bins = F.explode(F.array(F.floor(F.col("ps") / reach), F.floor(F.col("ps") / reach) - 1))
    met = last.join(first.withColumn("bin", bins), ["sample", "bin"])
    met = met.where((F.col("ps") > F.col("pe")) & (F.col("qs") > F.col("qe")) & (F.col("ps") - F.col("pe") <= reach) & (F.col("qs") - F.col("qe") <= reach))
    gaps = met.groupBy("sample", "pe", "qe").agg(F.min(F.struct("ps", "qs")).alias("s")).select("sample", "pe", "qe", "s.ps", "s.qs")
    gaps = gaps.withColumn("over", F.greatest(F.lit(0), F.col("pe") + k - F.col("ps"), F.col("qe") + k - F.col("qs")))
    gaps = gaps.select(
        "sample", (F.col("pe") + k - F.col("over")).alias("a"), (F.col("ps") - F.col("pe") - k + F.col("over")).alias("an"),
        (F.col("qe") + k - F.col("over")).alias("b"), (F.col("qs") - F.col("qe") - k + F.col("over")).alias("bn"),
    )
    gaps = parts_at(genomes, ["sample"], gaps, "b", "bn", reach, "y")
    gaps = parts_at(ref, [], gaps, "a", "an", reach, "x").select("sample", F.col("a").alias("pos"), "x", "y")
    places = F.filter(F.sequence(F.lit(1), F.length("x")), lambda i: F.substr("x", i, F.lit(1)) != F.substr("y", i, F.lit(1)))
    alike = gaps.where((F.length("x") == F.length("y")) & (F.length("x") > 0)).withColumn("i", F.explode(places))
    alike = alike.select("sample", (F.col("pos") + F.col("i") - 1).alias("pos"), F.expr("substr(x, i, 1)").alias("ref_text"), F.expr("substr(y, i, 1)").alias("text"))
    shorter = F.least(F.length("x"), F.length("y"))
    common = lambda cut: F.size(F.filter(F.sequence(F.lit(0), shorter), lambda n: cut("x", n) == cut("y", n))) - 1
    tail = common(lambda c, n: F.when(n > 0, F.right(F.col(c), n)).otherwise(""))
    other = gaps.where(F.length("x") != F.length("y")).withColumn("n", tail)
    other = other.select("sample", "pos", F.expr("left(x, length(x) - n)").alias("x"), F.expr("left(y, length(y) - n)").alias("y"))
    other = other.withColumn("n", common(lambda c, n: F.left(F.col(c), n)))
    other = other.select("sample", (F.col("pos") + F.col("n")).alias("pos"), F.expr("substr(x, n + 1)").alias("ref_text"), F.expr("substr(y, n + 1)").alias("text"))
    return alike.unionByName(other).select("sample", F.col("pos").cast("long").alias("pos"), "ref_text", "text")


def coverage_cutoff(sites: DataFrame, ref_len: int, least: float = 0.1) -> DataFrame:
    """Rows (sample, covered, share): samples that cover at least ``least`` of the reference."""
    rows = sites.groupBy("sample").agg(F.count_distinct("pos").alias("covered"))
    return rows.withColumn("share", F.round(F.col("covered") / ref_len, 6)).where(F.col("covered") >= least * ref_len)


def core_sites(sites: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows (pos, n_bases): sites that all samples have; more than one base makes a core SNP."""
    total = F.broadcast(samples.select("sample").distinct().agg(F.count("*").alias("total")))  # one row
    rows = sites.groupBy("pos").agg(F.count_distinct("sample").alias("n"), F.count_distinct("base").alias("n_bases"))
    return rows.join(total, F.col("n") == F.col("total")).select("pos", "n_bases")


def core_alignment(sites: DataFrame, core: DataFrame) -> DataFrame:
    """Rows (sample, aligned): the bases of the core sites in order, one text per sample."""
    rows = sites.join(core.select("pos"), "pos").groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("a"))
    return rows.select("sample", F.array_join(F.transform("a", lambda x: x["base"]), "").alias("aligned"))


def site_patterns(sites: DataFrame, core: DataFrame) -> DataFrame:
    """Rows (pattern, weight): equal columns of the alignment, samples in order, and how many there are."""
    column = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample", "base"))), lambda x: x["base"]), "")
    columns = sites.join(core.select("pos"), "pos").groupBy("pos").agg(column.alias("pattern"))
    return columns.groupBy("pattern").agg(F.count("*").alias("weight"))


def pattern_bases(patterns: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows (pattern, sample, base, weight): patterns spelled out by sample, for those with more than one base."""
    numbered = samples.select("sample").distinct().withColumn("i", F.row_number().over(Window.partitionBy().orderBy("sample")))  # one row per sample
    varied = patterns.where(F.size(F.array_distinct(F.split("pattern", ""))) > 1)
    return varied.crossJoin(F.broadcast(numbered)).select("pattern", "sample", F.expr("substr(pattern, i, 1)").alias("base"), "weight")


def pair_differences(bases: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows (keep, a, b, n_diff): weighted differences of each pair of samples over the varied patterns."""
    keep = keep or []
    x = bases.select(*keep, "pattern", "weight", F.col("sample").alias("a"), F.col("base").alias("ba"))
    y = bases.select(*keep, "pattern", F.col("sample").alias("b"), F.col("base").alias("bb"))
    pairs = x.join(y, [*keep, "pattern"]).where("a < b")
    return pairs.groupBy(*keep, "a", "b").agg(F.sum(F.when(F.col("ba") != F.col("bb"), F.col("weight")).otherwise(0)).alias("n_diff"))


def with_distances(pairs: DataFrame, n_sites: int) -> DataFrame:
    """Adds p_distance and the Jukes-Cantor distance, null from three quarters on."""
    p = F.col("n_diff") / n_sites if n_sites else F.lit(0.0)
    jc = F.when(p < 0.75, -0.75 * F.log(1 - 4 * p / 3))
    return pairs.withColumn("p_distance", F.round(p, 6)).withColumn("jc_distance", F.round(jc, 6) + 0.0)


def snp_distance(patterns: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows (a, b, n_diff, p_distance, jc_distance) from weighted patterns; pairs without any difference are included."""
    n = patterns.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    names = samples.select("sample").distinct()
    every = names.select(F.col("sample").alias("a")).join(names.select(F.col("sample").alias("b")), F.col("a") < F.col("b"))
    found = pair_differences(pattern_bases(patterns, samples))
    rows = every.join(found, ["a", "b"], "left").withColumn("n_diff", F.coalesce("n_diff", F.lit(0)))
    return with_distances(rows, n)


def bootstrap_sites(spark, n_sites: int, reps: int = 100, seed: int = 1234) -> DataFrame:
    """Rows (rep, site, weight): ``n_sites`` draws per replicate; replicate 0 has every site once."""
    draws = spark.range(1, reps + 1).select(F.col("id").cast("int").alias("rep"), F.explode(F.sequence(F.lit(0), F.lit(n_sites - 1))).alias("j"))
    drawn = draws.select("rep", (draw(seed, "|", F.col("rep"), "|", F.col("j")) % n_sites).cast("int").alias("site"))
    drawn = drawn.groupBy("rep", "site").agg(F.count("*").alias("weight"))
    plain = spark.range(n_sites).select(F.lit(0).alias("rep"), F.col("id").cast("int").alias("site"), F.lit(1).cast("long").alias("weight"))
    return plain.unionByName(drawn)


def bootstrap_patterns(sites: DataFrame, core: DataFrame, reps: int = 100, seed: int = 1234) -> DataFrame:
    """Rows (rep, pattern, weight): the core sites' patterns as each replicate draws them."""
    column = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample", "base"))), lambda x: x["base"]), "")
    columns = sites.join(core.select("pos"), "pos").groupBy("pos").agg(column.alias("pattern"))
    n = core.count()
    if not n:
        return columns.select(F.lit(0).alias("rep"), "pattern", F.lit(1).cast("long").alias("weight")).limit(0)
    numbered = ranked(columns, [], ["pos"], "site").withColumn("site", F.col("site") - 1)
    drawn = numbered.join(bootstrap_sites(sites.sparkSession, n, reps, seed), "site")
    return drawn.groupBy("rep", "pattern").agg(F.sum("weight").alias("weight"))


def bootstrap_distance(drawn: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows (rep, a, b, n_diff) of all pairs that differ anywhere in a replicate's varied patterns."""
    numbered = samples.select("sample").distinct().withColumn("i", F.row_number().over(Window.partitionBy().orderBy("sample")))
    varied = drawn.where(F.size(F.array_distinct(F.split("pattern", ""))) > 1)
    distinct = varied.select("pattern").distinct().crossJoin(F.broadcast(numbered)).select("pattern", "sample", F.expr("substr(pattern, i, 1)").alias("base"))
    x = distinct.select("pattern", F.col("sample").alias("a"), F.col("base").alias("ba"))
    y = distinct.select("pattern", F.col("sample").alias("b"), F.col("base").alias("bb"))
    differing = x.join(y, "pattern").where("a < b and ba <> bb").select("pattern", "a", "b")
    return varied.join(differing, "pattern").groupBy("rep", "a", "b").agg(F.sum("weight").alias("n_diff"))


def nearest_neighbours(distances: DataFrame, samples: DataFrame, reps: int) -> DataFrame:
    """Rows (sample, nearest, n_reps): how often each sample is the other's nearest over replicates 1 to ``reps``; ties by name."""
    names = samples.select("sample").distinct()
    every = names.select(F.col("sample").alias("a")).join(names.select(F.col("sample").alias("b")), F.col("a") != F.col("b"))
    every = every.crossJoin(samples.sparkSession.range(1, reps + 1).select(F.col("id").cast("int").alias("rep")))
    both = distances.select("rep", "a", "b", "n_diff").unionByName(distances.select("rep", F.col("b").alias("a"), F.col("a").alias("b"), "n_diff"))
    rows = every.join(both, ["rep", "a", "b"], "left").withColumn("n_diff", F.coalesce("n_diff", F.lit(0)))
    first = rows.groupBy("rep", "a").agg(F.min(F.struct("n_diff", "b"))["b"].alias("nearest"))
    return first.groupBy(F.col("a").alias("sample"), "nearest").agg(F.count("*").alias("n_reps"))
