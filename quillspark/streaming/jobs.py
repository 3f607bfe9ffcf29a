"""Structured Streaming jobs over event files: windows with watermarks, incremental folds, per-key state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def source(spark: SparkSession, folder: str, files_per_batch: int = 1, pattern: str = "events*.parquet") -> DataFrame:
    """Event files as a stream; offsets live in the query's checkpoint, so that a file is read once."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).parquet(folder)


def drained(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and reads its Parquet sink back."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/out")


def folded(stream: DataFrame, path: str, fold) -> None:
    """Runs a stream with foreachBatch(fold): idempotent folds make replays harmless."""
    q = stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
    q.awaitTermination()


def daily_counts(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Tumbling days by type; a day closes when the watermark passes it."""
    e = events.withWatermark("ts", lateness)
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")


def failure_states(events: DataFrame, threshold: int = 3) -> DataFrame:
    """Failures in a row per user, kept as state: one more at an error, none after a purchase; a row a user and batch."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (count,) = state.get if state.exists else (0,)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for kind in rows["event_type"]:
            count = count + 1 if kind == "error" else 0
        state.update((count,))
        yield pd.DataFrame({"user_id": [key[0]], "last_event": [int(rows["event_id"].iloc[-1])], "last_ts": [rows["ts"].iloc[-1]], "failures": [count], "quarantined": [count >= threshold]})

    kept = events.where(F.col("event_type").isin("error", "purchase"))
    return kept.groupBy("user_id").applyInPandasWithState(step, "user_id long, last_event long, last_ts timestamp, failures long, quarantined boolean", "failures long", "append", GroupStateTimeout.NoTimeout)
