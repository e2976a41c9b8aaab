from driftscan.session import load
from driftscan.streaming import bins


def test_bins_and_segments(spark, sf, tmp_path):
    events = load(spark, sf, "events")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = bins.read_events(spark, str(tmp_path / "in"), events.schema)
    q = bins.bin_counts(stream, "ts", "event_type", "value", late="60 days").writeStream.format("memory").queryName("bins").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = events.groupBy("event_type").count().collect()
    got = {r["pred_label"]: r["n"] for r in spark.sql("select pred_label, sum(total_counts) n from bins group by 1").collect()}
    assert got == {r["event_type"]: r["count"] for r in want}
    q = bins.run_to(bins.segments(bins.read_events(spark, str(tmp_path / "in"), events.schema), "ts", "user_id"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 0
