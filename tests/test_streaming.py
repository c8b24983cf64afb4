"""The event log as a stream."""

from pyspark.sql import functions as F

from loomcat.streaming import events as E


def test_latest_states_follow_the_log(spark, tmp_path):
    schema = "event_id string, request_id string, occurred_at timestamp, new_status string"
    log = str(tmp_path / "log")

    def add(rows):
        spark.createDataFrame(rows, "event_id string, request_id string, at string, new_status string").select("event_id", "request_id", F.col("at").cast("timestamp").alias("occurred_at"), "new_status").write.mode("append").parquet(log)

    add([("e1", "q1", "2026-01-01 00:00:00", "draft"), ("e1", "q1", "2026-01-01 00:00:00", "draft"), ("e2", "q2", "2026-01-01 01:00:00", "draft")])
    source = E.event_stream(spark, log, spark.createDataFrame([], schema).schema)
    E.keep_latest(E.once(source), str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination(60)
    add([("e3", "q1", "2026-01-01 02:00:00", "sent")])
    source = E.event_stream(spark, log, spark.createDataFrame([], schema).schema)
    E.keep_latest(E.once(source), str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination(60)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "table").iterdir())
    assert {(r.request_id, r.status) for r in spark.read.parquet(f"{tmp_path}/table/version={last}").collect()} == {("q1", "sent"), ("q2", "draft")}


def test_windows_close_behind_the_watermark(spark, tmp_path):
    rows = [("2026-01-01 00:10:00", "a"), ("2026-01-01 00:50:00", "a"), ("2026-01-01 05:00:00", "b")]
    spark.createDataFrame(rows, "t string, k string").select(F.col("t").cast("timestamp").alias("ts"), "k").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in"))
    E.windowed(source, "ts", "k").writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(60)
    assert [(r.k, r["count"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", 2)]
