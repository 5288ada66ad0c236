from readloom.operators.kmers import bait_kmers
from readloom.operators.reads import read_stats
from readloom.streaming.incoming import SCHEMA, baited, incoming_reads, keep_totals


def test_totals_follow_what_arrives(spark, tmp_path):
    first = [("a", i, "ACGT" * i, "") for i in range(5)]
    later = [("a", 9, "AC", ""), ("b", 1, "A", "")]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, (rows, every) in enumerate(((first, first), (later, first + later))):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        keep_totals(incoming_reads(spark, folder), out, str(tmp_path / "state")).awaitTermination()
        got = {(r["sample"], r.n_reads, r.total_bases) for r in spark.read.parquet(f"{out}/batch={n}").collect()}
        want = {(r["sample"], r.n_reads, r.total_bases) for r in read_stats(spark.createDataFrame(every, SCHEMA)).collect()}
        assert got == want


def test_stream_baits_like_a_table(spark, tmp_path):
    rows = [("a", 1, "ACGTACGTTTGACA", ""), ("a", 2, "CCCCCCCCCC", ""), ("b", 3, "TTGACAGG", "")]
    ref = spark.createDataFrame([("GGTTGACAGGA",)], "seq string")
    folder = str(tmp_path / "in")
    table = spark.createDataFrame(rows, SCHEMA)
    table.write.parquet(folder)
    q = baited(incoming_reads(spark, folder), ref, 5).writeStream.outputMode("complete").format("memory").queryName("hits").trigger(availableNow=True).start()
    q.awaitTermination()
    assert set(map(tuple, spark.table("hits").collect())) == set(map(tuple, bait_kmers(table, ref, 5).collect()))
