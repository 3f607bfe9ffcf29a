"""Analytic entities over the warehouse tables, as DataFrames and, for the oracle, as SQL common table expressions.

publication: an order; activity: an order line, one a (publication, line), with topic, subtopics and relevance; person: a
supplier (author of activities) or a customer (owner of publications).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.shared import entity
from quillspark.sources.tables import table


def publications(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("pmid"), F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year"),
        F.least(F.lit(100.0), F.col("o_totalprice") / 5000).alias("impact"), (F.col("o_orderstatus") == "F").alias("academic"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("published"), F.col("o_orderpriority").alias("priority"),
    )


PUB = """pub AS (
  SELECT o_orderkey AS pmid, o_custkey AS owner, CAST(year(o_orderdate) AS INTEGER) AS year, least(100.0, o_totalprice / 5000) AS impact,
         o_orderstatus = 'F' AS academic, o_orderstatus AS status, o_orderdate AS published, o_orderpriority AS priority
  FROM orders)"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    """One line a (publication, line number): of repeated keys the smallest row.

    Dealt by publication, so that one exchange and one sort serve the aggregation and a later join with publications.
    """
    pick = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus", "l_discount"]
    one = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *pick).repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*pick)).alias("r"))
    return one.select("l_orderkey", "l_linenumber", "r.*")


def _activities(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    line = F.col("l_linenumber")
    sub = lambda n: F.concat(F.col("p_brand"), F.lit("_"), F.lpad(n.cast("string"), 3, "0"))
    rows = lines(spark, d).join(publications(spark, d).select("pmid", "year", "impact"), F.col("l_orderkey") == F.col("pmid")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        "pmid", line.alias("line"), F.col("l_suppkey").alias("person"), F.col("p_brand").alias("topic"),
        F.when(F.col("l_returnflag") != "N", sub(F.col("p_size"))).alias("primary_subtopic"), sub(1 + F.col("p_size") % 10).alias("other_subtopic"),
        F.round(F.col("l_discount") * 10, 1).alias("score"), "impact", "year",
        F.when(line == 1, "first").when(line >= 6, "last").otherwise("middle").alias("position"),
        (F.col("l_linestatus") == "F").alias("live"), F.col("l_shipdate").alias("created_at"),
    )


def activities(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated and joined once a session, so that each query's columns and filters reach a scan of the result."""
    return entity("activities", [f"{d}/{t}.parquet" for t in ("lineitem", "orders", "part")], lambda: _activities(spark, d), spark)


ACT = """act AS (
  SELECT l_orderkey AS pmid, l_linenumber AS line, l_suppkey AS person, p_brand AS topic,
         CASE WHEN l_returnflag <> 'N' THEN p_brand || '_' || lpad(CAST(p_size AS VARCHAR), 3, '0') END AS primary_subtopic,
         p_brand || '_' || lpad(CAST(1 + p_size % 10 AS VARCHAR), 3, '0') AS other_subtopic,
         round(l_discount * 10, 1) AS score, least(100.0, o_totalprice / 5000) AS impact, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN l_linenumber = 1 THEN 'first' WHEN l_linenumber >= 6 THEN 'last' ELSE 'middle' END AS position,
         l_linestatus = 'F' AS live, l_shipdate AS created_at
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag, l_linestatus, l_discount) AS rn FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE rn = 1)"""


def subtopic_members(spark: SparkSession, d: str) -> DataFrame:
    """(subtopic, topic, pmid): who is in a subtopic, by either of an activity's subtopics."""
    a = activities(spark, d)
    both = F.array_distinct(F.array_compact(F.array("primary_subtopic", "other_subtopic")))
    return a.select("topic", "pmid", F.explode(both).alias("subtopic")).distinct()


MEMBERS = """mem AS (
  SELECT DISTINCT topic, pmid, primary_subtopic AS subtopic FROM act WHERE primary_subtopic IS NOT NULL
  UNION SELECT DISTINCT topic, pmid, other_subtopic FROM act)"""


def event_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"), F.to_date("ts").alias("day"))


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS day
  FROM events)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
