"""Streaks, persistence, trailing windows, knees, caps and counters over event logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators.ranking import average_ranks, knee, streak, top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, EV, activities, event_rows, with_sql
from quillspark.sources.tables import table


@query(with_sql(EV) + """
, s AS (SELECT user_id, ts, event_id, event_type = 'error' AS hit FROM ev WHERE event_type <> 'view'),
m AS (SELECT user_id, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS miss FROM s)
SELECT user_id, CAST(sum(CASE WHEN miss = 0 THEN 1 ELSE 0 END) AS BIGINT) AS streak, sum(CASE WHEN miss = 0 THEN 1 ELSE 0 END) >= 1 AS alert FROM m GROUP BY 1""")
def stage_streak(spark, d):
    """Skips at the end of each scope's runs; work-empty runs neither break nor extend the streak."""
    e = event_rows(spark, d)
    out = streak(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], F.col("event_type") == "error", F.col("event_type") == "view")
    return out.withColumn("alert", F.col("streak") >= 1)


@query(with_sql(EV) + """
, dd AS (SELECT k, day, count(*) AS n FROM ev GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day DESC) AS rn FROM dd)
SELECT k, CAST(sum(CASE WHEN n >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS days, sum(CASE WHEN n >= 3 THEN 1 ELSE 0 END) = 3 AS persistent FROM r WHERE rn <= 3 GROUP BY 1""")
def persistence(spark, d):
    """Whether a condition held on each of the last three daily rows."""
    daily = event_rows(spark, d).groupBy("k", "day").agg(F.count("*").alias("n"))
    last = top_k(daily, ["k"], [F.col("day").desc()], 3)
    return last.groupBy("k").agg(F.sum((F.col("n") >= 3).cast("int")).alias("days")).withColumn("persistent", F.col("days") == 3)


@query(with_sql(EV) + "SELECT user_id, event_type, count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1, 2")
def trailing_window(spark, d):
    """Events in a window closed at both ends."""
    return event_rows(spark, d).where("ts >= timestamp '2024-01-10' and ts <= timestamp '2024-01-24'").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(with_sql(ACT) + """
, w AS (SELECT topic, primary_subtopic AS s, count(*) AS n FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2),
l AS (SELECT topic, n, row_number() OVER o AS i, lead(n) OVER o AS nx FROM w WINDOW o AS (PARTITION BY topic ORDER BY n DESC, s)),
r AS (SELECT topic, nx, i, CASE WHEN nx = 0 THEN CAST('Infinity' AS DOUBLE) ELSE n / nx END AS ratio FROM l WHERE nx IS NOT NULL)
SELECT topic, nx AS knee, round(ratio, 6) AS ratio, CAST(i AS INTEGER) AS position FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ratio DESC, i) AS k FROM r) WHERE k = 1""")
def knee_point(spark, d):
    """Where the sorted weights of a topic's subtopics drop most."""
    w = activities(spark, d).where("primary_subtopic is not null").groupBy("topic", F.col("primary_subtopic").alias("s")).agg(F.count("*").alias("n"))
    return knee(w, "n", "s", ["topic"]).withColumn("ratio", F.round("ratio", 6))


@query("""
WITH o AS (SELECT conv_id, turn, array_to_string(list_slice(string_split(text, ' '), 1, 1), ' ') AS opener FROM conversations WHERE role = 'assistant'),
r AS (SELECT *, row_number() OVER (PARTITION BY opener ORDER BY conv_id, turn) AS use FROM o)
SELECT conv_id, turn, opener, CAST(use AS INTEGER) AS use FROM r WHERE use > 2""")
def opener_cap(spark, d):
    """Uses of an opener beyond two, in order. Uses are counted within runs of conversations, and the runs before are added,
    so that a hot opener is spread over its runs."""
    o = table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.split("text", " ")[0].alias("opener"))
    o = o.withColumn("run", F.floor(F.col("conv_id") / 512))
    earlier = Window.partitionBy("opener").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = o.groupBy("opener", "run").agg(F.count("*").alias("n")).select("opener", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    use = F.row_number().over(Window.partitionBy("opener", "run").orderBy("conv_id", "turn"))
    counted = o.withColumn("use", use).join(runs, ["opener", "run"])
    return counted.select("conv_id", "turn", "opener", (F.col("use") + F.col("before")).cast("int").alias("use")).where("use > 2")


@query(with_sql(ACT) + """
, l AS (SELECT pmid, person, score FROM act)
SELECT pmid, person, CAST(rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS DOUBLE) AS avg_rank FROM l""")
def avg_ranks(spark, d):
    """Ranks with ties averaged, by way of counts per distinct score."""
    rows = activities(spark, d).select("pmid", "person", "score")
    return average_ranks(rows, "score").select("pmid", "person", F.col("avg_rank").cast("double"))


@query(with_sql(EV) + """
, g AS (SELECT user_id, ts, event_id, event_type, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM ev WHERE event_type IN ('error', 'purchase')),
c AS (SELECT user_id, island, count(CASE WHEN event_type = 'error' THEN 1 END) AS failures FROM g GROUP BY 1, 2)
SELECT user_id, max_by(failures, island) AS current_failures, max(failures) AS worst, max_by(failures, island) >= 3 AS quarantined FROM c GROUP BY 1""")
def failure_counter(spark, d):
    """Failures in a row since the last success (gaps and islands), with quarantine at three."""
    e = event_rows(spark, d).where(F.col("event_type").isin("error", "purchase"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = e.withColumn("island", F.sum((F.col("event_type") == "purchase").cast("int")).over(w))
    c = g.groupBy("user_id", "island").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("failures"))
    return c.groupBy("user_id").agg(F.max_by("failures", "island").alias("current_failures"), F.max("failures").alias("worst")).withColumn("quarantined", F.col("current_failures") >= 3)


@query(with_sql(EV) + """
, dd AS (SELECT DISTINCT day FROM ev), u AS (SELECT DISTINCT user_id FROM ev), la AS (SELECT user_id, max(day) AS last_day FROM ev WHERE event_type = 'signup' GROUP BY 1)
SELECT u.user_id, (SELECT count(*) FROM dd WHERE la.last_day IS NULL OR dd.day > la.last_day) AS quiet, CASE WHEN (SELECT count(*) FROM dd WHERE la.last_day IS NULL OR dd.day > la.last_day) >= 24 THEN 'archived' WHEN (SELECT count(*) FROM dd WHERE la.last_day IS NULL OR dd.day > la.last_day) >= 12 THEN 'demoted' ELSE 'active' END AS state
FROM u LEFT JOIN la ON u.user_id = la.user_id""")
def quiet_runs(spark, d):
    """Runs since a scope was last active, and its state: demoted from 12 quiet runs, archived from 24."""
    e = event_rows(spark, d)
    days = e.select("day").distinct().agg(F.array_sort(F.collect_set("day")).alias("days"))  # one a run, bounded by the calendar
    last = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "signup", F.col("day"))).alias("last_day"))
    quiet = F.size(F.filter("days", lambda x: F.col("last_day").isNull() | (x > F.col("last_day")))).cast("long")
    out = last.join(F.broadcast(days)).withColumn("quiet", quiet)
    return out.select("user_id", "quiet", F.when(F.col("quiet") >= 24, "archived").when(F.col("quiet") >= 12, "demoted").otherwise("active").alias("state"))


@query(with_sql(EV) + """
, s AS (SELECT user_id, k, count(DISTINCT day) AS seen FROM ev WHERE event_type = 'view' GROUP BY 1, 2)
SELECT k, count(*) AS candidates, count(CASE WHEN seen >= 2 THEN 1 END) AS minted FROM s GROUP BY 1""")
def mint_persistence(spark, d):
    """Candidates seen in at least two runs are minted."""
    s = event_rows(spark, d).where("event_type = 'view'").groupBy("user_id", "k").agg(F.countDistinct("day").alias("seen"))
    return s.groupBy("k").agg(F.count("*").alias("candidates"), F.count(F.when(F.col("seen") >= 2, 1)).alias("minted"))


@query(with_sql(EV) + """
, c AS (SELECT event_id, user_id, value, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS upto FROM ev WHERE event_type = 'click')
SELECT event_id, user_id, round(upto, 4) AS upto FROM c WHERE upto <= 200""")
def cost_guard(spark, d):
    """Work admitted until the running cost of its scope would pass a hard cap."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = event_rows(spark, d).where("event_type = 'click'").withColumn("upto", F.sum("value").over(w))
    return c.where("upto <= 200").select("event_id", "user_id", F.round("upto", 4).alias("upto"))


@query(with_sql(EV) + """
, t AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM ev),
s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM t)
SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, sess""")
def session_window(spark, d):
    """Sessions that end after 30 minutes of inactivity (extension)."""
    e = event_rows(spark, d)
    # the built-in window closes a session at exactly 30 minutes: one microsecond more keeps ties together
    gap = F.session_window("ts", "30 minutes 1 microsecond")
    return e.groupBy("user_id", gap.alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("started"), "n")


@query(with_sql(EV) + "SELECT day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM ev GROUP BY 1, 2")
def tumbling_window(spark, d):
    """Daily rows by type."""
    e = event_rows(spark, d)
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.to_date("w.start").alias("day"), "event_type", "n", "total")


@query(with_sql(EV) + """
, dd AS (SELECT DISTINCT CAST(x AS DATE) AS w FROM (SELECT unnest(generate_series((SELECT min(day) FROM ev) - 13, (SELECT max(day) FROM ev), INTERVAL 1 DAY)) AS x))
SELECT CAST(w AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM dd JOIN ev ON day >= w AND day < w + 14 GROUP BY 1, 2""")
def sliding_window(spark, d):
    """Fourteen-day windows that slide by a day."""
    w = F.window("ts", "14 days", "1 day", "0 seconds")
    return event_rows(spark, d).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")
