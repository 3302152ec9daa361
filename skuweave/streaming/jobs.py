"""Structured Streaming jobs; each takes a stream, or a table of the same columns as its batch form."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.sources.keyed import KeyedTable

LATE = "2 days"


def _marked(df: DataFrame, ts: str, late: str) -> DataFrame:
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, late) if df.isStreaming else df


def latest_per_day(events: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "value", late: str = LATE) -> DataFrame:
    """The last value of each key and day; of equal times the larger event_id."""
    day = F.window(ts, "1 day")
    out = _marked(events, ts, late).groupBy(day.alias("w"), key).agg(F.max(F.struct(ts, "event_id", value)).alias("m"))
    return out.select(key, F.to_date("w.start").alias("day"), F.col("m")[value].alias(value))


def tumbling_counts(events: DataFrame, length: str, key: str = "event_type", ts: str = "ts", late: str = LATE) -> DataFrame:
    return _marked(events, ts, late).groupBy(F.window(ts, length).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def sliding_counts(events: DataFrame, length: str, step: str, key: str = "event_type", ts: str = "ts", late: str = LATE) -> DataFrame:
    return _marked(events, ts, late).groupBy(F.window(ts, length, step).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_wins(events: DataFrame, keys: list[str], ts: str = "ts", late: str = LATE) -> DataFrame:
    """The first row of each key: of a stream the first arrival within the watermark, of a table the first by ts and all columns."""
    if events.isStreaming:
        return _marked(events, ts, late).dropDuplicatesWithinWatermark(keys)
    whole = F.struct(*events.columns)
    return events.groupBy(*keys).agg(F.min_by(whole, F.struct(ts, *[c for c in events.columns if c != ts])).alias("_row")).select("_row.*")


def new_keys(events: DataFrame, known: DataFrame, key: str, ts: str = "ts", late: str = LATE) -> DataFrame:
    """Keys that the static table does not have. Of a stream a key comes once within the watermark, and its state goes after it."""
    out = events.join(known.select(key).distinct(), key, "left_anti")
    return _marked(out, ts, late).dropDuplicatesWithinWatermark([key]).select(key) if events.isStreaming else out.select(key).distinct()


def upsert_batches(stream: DataFrame, table: KeyedTable, order: list[str], checkpoint: str):
    """Writes each micro-batch of a stream as an upsert of the table's buckets that it touches; returns the started query."""
    return stream.writeStream.foreachBatch(lambda batch, n: table.upsert(batch, order, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_with_late_side(stream: DataFrame, table: KeyedTable, late: str, checkpoint: str, ts: str = "ts", behind: int = 2):
    """Upserts the last row of each key of the table by time; rows of days more than `behind` days before the newest time seen go to `late`.

    stream: the table's columns, among them day and ts. The newest time is that of the batches before, and is published with the
    table's version, so a repeated batch parts its rows as before. Late rows are counted by late_counts and merged by replay_late.
    """

    def split(batch: DataFrame, number: int) -> None:
        if number in table.versions():
            return
        spark, batch = batch.sparkSession, batch.persist()
        seen = table.manifest().get("newest")
        old = F.lit(False) if seen is None else F.col("day") < F.date_sub(F.to_date(F.lit(seen)), behind)
        batch.where(old).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{late}/number={number}")
        newest = batch.agg(F.max(ts).cast("string")).first()[0]
        table.upsert(batch.where(~old), [ts], number, newest=max(x for x in (seen, newest, "") if x is not None) or None)
        batch.unpersist()

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(table: KeyedTable, late: str) -> DataFrame:
    """What came too late, with the number of the batch it came in."""
    return table.spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in table.schema)}, batch int").parquet(late)


def late_counts(table: KeyedTable, late: str) -> DataFrame:
    return late_rows(table, late).groupBy("day").agg(F.count("*").alias("n_late"))


def replay_late(table: KeyedTable, late: str, ts: str = "ts") -> int:
    """Merges the late rows into their days: only the buckets of their keys are rewritten; a second replay changes nothing."""
    return table.upsert(late_rows(table, late).drop("batch"), [ts])


def rerun_days(target: DataFrame, rerun: DataFrame, day: str = "day") -> DataFrame:
    """target with the days that a late run computed anew taken from that run only; all other days stay as they are."""
    return target.join(rerun.select(day).distinct(), day, "left_anti").unionByName(rerun)


def velocity(events: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "value") -> DataFrame:
    """Per arrival of a snapshot: (now - before) / days between, kept as state of each key."""
    schema, state = f"{key} bigint, {ts} timestamp, delta double", f"{ts} timestamp, {value} double"

    def step(k, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        before = held.get if held.exists else None
        rows = pd.concat(list(batches)).sort_values(ts)
        out = []
        for t, v in zip(rows[ts], rows[value], strict=True):
            days = max(1, (t - before[0]).days) if before else None
            out.append((k[0], t, (v - before[1]) / days if before else None))
            before = (t, float(v))
        held.update(before)
        yield pd.DataFrame(out, columns=[key, ts, "delta"])

    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.groupBy(key).applyInPandasWithState(step, schema, state, "append", "NoTimeout")


def work_status(results: DataFrame, key: str = "uid", cap: int = 5) -> DataFrame:
    """Per key the state of its work: done, empty or error ends it; quota failures do not count as attempts."""
    schema, state = f"{key} string, status string, attempts int", "status string, attempts int"

    def step(k, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        status, tries = held.get if held.exists else ("pending", 0)
        for what in pd.concat(list(batches)).sort_values("seq")["outcome"]:
            if status != "done" and what != "quota":
                tries += 1
                status = what if what in ("done", "empty") else "error" if tries >= cap else "pending"
        held.update((status, tries))
        yield pd.DataFrame([(k[0], status, tries)], columns=[key, "status", "attempts"])

    return results.groupBy(key).applyInPandasWithState(step, schema, state, "update", "NoTimeout")
