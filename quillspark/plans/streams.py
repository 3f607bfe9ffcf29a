"""Streaming queries, drained over the event table; each has a batch twin as its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.plans.registry import query
from quillspark.plans.views import EV, event_rows, with_sql
from quillspark.sources import files
from quillspark.sources.shared import scratch
from quillspark.streaming import jobs


def _parts(spark, d, n: int = 4) -> str:
    """The event table as files in order of time, written one after the other, as they would arrive."""
    path = scratch(spark)
    event = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")
    second = F.unix_timestamp("ts")
    cuts = event.select(second.alias("s")).approxQuantile("s", [k / n for k in range(1, n)], 0.01)
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = event.where(F.lit(True) if lo is None else second >= lo).where(F.lit(True) if hi is None else second < hi)
        part.coalesce(1).sortWithinPartitions("ts", "event_id").write.mode("append").parquet(path)
    return path


@query(with_sql(EV) + "SELECT CAST(day AS TIMESTAMP) AS day, event_type, count(*) AS n FROM ev GROUP BY 1, 2 HAVING CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM ev) - INTERVAL 1 DAY")
def stream_daily(spark, d):
    """Tumbling days out of a stream with a watermark: days that are closed by the end of the input."""
    return jobs.drained(jobs.daily_counts(jobs.source(spark, _parts(spark, d), pattern="*.parquet")), scratch(spark))


@query(with_sql(EV) + "SELECT user_id, count(*) AS n, max(event_id) AS last_event, round(max(value), 6) AS best FROM ev GROUP BY 1")
def stream_fold(spark, d):
    """A stream folded into durable state batch by batch; the state of a batch is a version that later batches build on."""
    base = scratch(spark)

    def fold(batch, number: int) -> None:
        now = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"), F.max("value").alias("best"))
        if number:
            now = batch.sparkSession.read.parquet(f"{base}/state/{number - 1}").unionByName(now)
        now.groupBy("user_id").agg(F.sum("n").alias("n"), F.max("last_event").alias("last_event"), F.max("best").alias("best")).write.mode("overwrite").parquet(f"{base}/state/{number}")
        latest.append(number)

    latest: list[int] = []
    jobs.folded(jobs.source(spark, _parts(spark, d), pattern="*.parquet"), base, fold)
    return spark.read.parquet(f"{base}/state/{max(latest)}").withColumn("best", F.round("best", 6))


@query(with_sql(EV) + """
, g AS (SELECT user_id, ts, event_id, event_type, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM ev WHERE event_type IN ('error', 'purchase')),
c AS (SELECT user_id, island, count(CASE WHEN event_type = 'error' THEN 1 END) AS failures FROM g GROUP BY 1, 2)
SELECT user_id, max_by(failures, island) AS failures, max_by(failures, island) >= 3 AS quarantined FROM c GROUP BY 1""")
def stream_quarantine(spark, d):
    """Failure counters kept as state; the last row of each user."""
    out = jobs.drained(jobs.failure_states(jobs.source(spark, _parts(spark, d), pattern="*.parquet")), scratch(spark))
    return files.latest(out, ["user_id"], "last_ts").select("user_id", "failures", "quarantined")


@query(with_sql(EV) + ", w AS (SELECT max(event_id) AS hw FROM ev WHERE event_id < 7000) SELECT event_id, user_id FROM ev WHERE event_id > (SELECT hw FROM w) OR (event_id % 500 = 3 AND event_id <= (SELECT hw FROM w))")
def watermark_backstop(spark, d):
    """Rows above a high-water mark, and a catch-up of those below it that were missed."""
    e = event_rows(spark, d).select("event_id", "user_id")
    hw = e.where("event_id < 7000").agg(F.max("event_id").alias("hw"))
    done = e.where("event_id < 7000 and event_id % 500 <> 3").select("event_id")
    above = e.join(F.broadcast(hw)).where("event_id > hw").drop("hw")
    missed = e.join(F.broadcast(hw)).where("event_id <= hw").drop("hw").join(done, "event_id", "left_anti")
    return above.unionByName(missed)
