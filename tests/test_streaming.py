"""Streams give what their batch forms give on the same files."""

import pytest
from pyspark.sql import functions as F

from skuweave.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def source(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.repartition(3).write.parquet(str(tmp_path / "events"))
    return e, spark.readStream.schema(e.schema).parquet(str(tmp_path / "events"))


def result(df, tmp_path, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_tumbling_counts(spark, source, tmp_path):
    batch, stream = source
    got = result(jobs.tumbling_counts(stream, "1 day"), tmp_path, "complete", "tumble")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, jobs.tumbling_counts(batch, "1 day").collect()))


def test_latest_and_sliding(spark, source, tmp_path):
    batch, stream = source
    got = result(jobs.latest_per_day(stream), tmp_path, "complete", "latest")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, jobs.latest_per_day(batch).collect()))
    got = result(jobs.sliding_counts(stream, "30 days", "10 days"), tmp_path, "complete", "slide")
    assert got.count() == jobs.sliding_counts(batch, "30 days", "10 days").count()


def test_first_wins_and_velocity(spark, source, tmp_path):
    batch, stream = source
    got = result(jobs.first_wins(stream, ["user_id", "event_type"], late="60 days"), tmp_path, "append", "first")
    assert got.count() == batch.select("user_id", "event_type").distinct().count()
    s = stream.select("user_id", "ts", "value")
    got = result(jobs.velocity(s), tmp_path, "append", "velocity")
    assert got.count() == batch.count() and got.where(F.col("delta").isNull()).count() == batch.select("user_id").distinct().count()


def test_work_status(spark, tmp_path):
    rows = [("a", 1, "quota"), ("a", 2, "error"), ("a", 3, "done"), ("b", 1, "error"), ("b", 2, "quota")]
    spark.createDataFrame(rows, "uid string, seq int, outcome string").coalesce(1).write.parquet(str(tmp_path / "r"))
    stream = spark.readStream.schema("uid string, seq int, outcome string").parquet(str(tmp_path / "r"))
    got = {r["uid"]: (r["status"], r["attempts"]) for r in result(jobs.work_status(stream), tmp_path, "update", "work").collect()}
    assert got == {"a": ("done", 2), "b": ("pending", 1)}


def test_late_rows_go_to_their_side_and_come_back(spark, tmp_path):
    from skuweave.sources.keyed import KeyedTable
    from skuweave.streaming.jobs import daily_with_late_side, late_counts, late_rows, replay_late

    schema = "user_id long, day date, ts timestamp, value double"
    arrivals = [
        [(1, "2024-01-01", "2024-01-01 10:00:00", 1.0), (1, "2024-01-09", "2024-01-09 10:00:00", 2.0), (2, "2024-01-08", "2024-01-08 09:00:00", 5.0)],
        [(1, "2024-01-01", "2024-01-01 11:00:00", 3.0), (2, "2024-01-02", "2024-01-02 11:00:00", 4.0), (2, "2024-01-08", "2024-01-08 08:00:00", 6.0), (3, "2024-01-07", "2024-01-07 08:00:00", 7.0)],
        [(4, "2024-01-20", "2024-01-20 08:00:00", 8.0)],
    ]
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["user_id", "day"], spark.createDataFrame([], schema).schema, buckets=4)
    late = f"file://{tmp_path}/late"
    for rows in arrivals:
        df = spark.createDataFrame(rows, "user_id long, day string, ts string, value double").selectExpr("user_id", "cast(day as date) day", "cast(ts as timestamp) ts", "value")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        daily_with_late_side(spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in"), table, late, f"{tmp_path}/state").awaitTermination()
    got = {(r["user_id"], str(r["day"])): r["value"] for r in table.read().collect()}
    assert got == {(1, "2024-01-01"): 1.0, (1, "2024-01-09"): 2.0, (2, "2024-01-08"): 5.0, (3, "2024-01-07"): 7.0, (4, "2024-01-20"): 8.0}
    assert {(r["user_id"], str(r["day"]), r["batch"]) for r in late_rows(table, late).collect()} == {(1, "2024-01-01", 1), (2, "2024-01-02", 1)}
    assert {str(r["day"]): r["n_late"] for r in late_counts(table, late).collect()} == {"2024-01-01": 1, "2024-01-02": 1}
    for _ in range(2):  # a second replay changes nothing
        replay_late(table, late)
        now = {(r["user_id"], str(r["day"])): r["value"] for r in table.read().collect()}
        assert now == {**got, (1, "2024-01-01"): 3.0, (2, "2024-01-02"): 4.0}
