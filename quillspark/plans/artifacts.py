"""Round trips through sinks and sources: each query writes to the shared folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.scores import article_score
from quillspark.plans.registry import query
from quillspark.plans.rollups import AS
from quillspark.plans.views import ACT, EV, activities, event_rows, with_sql
from quillspark.sources import files, sinks
from quillspark.sources.shared import scratch


def _totals(spark, d):
    s = article_score(F.col("impact"), F.col("score"))
    return activities(spark, d).where("primary_subtopic is not null").groupBy("topic", F.col("primary_subtopic").alias("subtopic")).agg(F.round(F.sum(s), 6).alias("total"), F.count("*").alias("n"))


TOTALS = f", t AS (SELECT topic, primary_subtopic AS subtopic, round(sum({AS}), 6) AS total, count(*) AS n FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2)"


@query(with_sql(ACT) + TOTALS + " SELECT topic, subtopic, total, n FROM t")
def versioned_publish(spark, d):
    """A version with manifest and pointer, read back through the pointer."""
    base = scratch(spark)
    first = sinks.publish(_totals(spark, d).limit(0), base, "v1")
    sinks.publish(_totals(spark, d), base, "v2", previous=first["sha256"])
    return sinks.read_latest(spark, base)


@query(with_sql(ACT) + TOTALS + " SELECT subtopic, total, n, topic FROM t WHERE topic <> 'Brand#55' AND topic <> 'Brand#54' UNION ALL SELECT subtopic, 0.0, n, topic FROM t WHERE topic = 'Brand#54'")
def partition_replace(spark, d):
    """One partition replaced, one retired with all its rows, the others untouched."""
    path = scratch(spark)
    t = _totals(spark, d)
    sinks.replace_partitions(t, path, "topic")
    sinks.replace_partitions(t.where("topic = 'Brand#54'").withColumn("total", F.lit(0.0)), path, "topic")
    for row in sinks.orphans(spark, path, t.where("topic <> 'Brand#55'"), "topic").collect():  # partitions, not rows
        sinks.drop_partition(spark, path, "topic", row["topic"].replace("#", "%23"))
    return spark.read.parquet(path).select("subtopic", "total", "n", "topic")


@query(with_sql(ACT) + TOTALS + " SELECT subtopic, total, n FROM t WHERE n >= 5")
def csv_round_trip(spark, d):
    """A report as CSV and back, under either of two names of its id column."""
    path = scratch(spark)
    sinks.write_csv(_totals(spark, d).where("n >= 5").withColumnRenamed("subtopic", "subtopic_id"), path)
    back = spark.read.schema("topic string, subtopic_id string, total double, n long").csv(path, header=True)
    return back.select(files.either(back, "primary_subtopic_id", "subtopic_id").alias("subtopic"), "total", "n")


@query(with_sql(EV) + ", r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev) SELECT user_id, event_id, value FROM r WHERE rn = 1")
def log_replay(spark, d):
    """An append-only JSON log with a broken line, replayed: last write wins."""
    path = scratch(spark)
    e = event_rows(spark, d).select("user_id", "event_id", "value")
    lines = e.select(F.to_json(F.struct("user_id", "event_id", "value")).alias("value"))
    lines.unionByName(spark.createDataFrame([("{broken",)], "value string")).write.text(path)
    return files.replay_log(spark, path, "user_id long, event_id long, value double", "user_id", "event_id")


@query(with_sql(ACT) + TOTALS + ", o AS (SELECT subtopic, total FROM t WHERE n >= 3), w AS (SELECT subtopic, CASE WHEN n % 2 = 0 THEN total END AS total, 'run' AS note FROM t WHERE n <= 30) SELECT coalesce(o.subtopic, w.subtopic) AS subtopic, CASE WHEN o.total > 9 THEN o.total ELSE coalesce(w.total, o.total) END AS total, CASE WHEN o.total > 9 THEN NULL ELSE note END AS note FROM o FULL JOIN w ON o.subtopic = w.subtopic")
def owned_merge(spark, d):
    """A merge that keeps decided rows whole and old values where a run has none."""
    t = _totals(spark, d)
    old = t.where("n >= 3").select("subtopic", "total")
    new = t.where("n <= 30").select("subtopic", F.when(F.col("n") % 2 == 0, F.col("total")).alias("total"), F.lit("run").alias("note"))
    return sinks.merged(old, new, ["subtopic"], held=F.col("o_total") > 9)


@query()
def manifest(spark, d):
    """The content digest of an artifact: the same whatever the order of its rows."""
    t = _totals(spark, d)
    a, b = sinks.content_hash(t), sinks.content_hash(t.repartition(3, "n"))
    return a.select("rows", "digest").join(b.select(F.col("digest").alias("again"))).withColumn("stable", F.col("digest") == F.col("again"))
