"""Top-k, arg-max with ties, streaks and running windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.sources.shared import written


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    """The first k rows of each group; Spark's group limit prunes before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_latest").drop("_latest")


def epsilon_argmax(df: DataFrame, keys: list[str], value: str, tie: str, ident: str, eps: float) -> DataFrame:
    """The best row of each group. If another is within eps of the best value, all rows within eps of it contend, and the
    largest tie value (then the smallest id) wins; otherwise the best value alone decides."""
    best = Window.partitionBy(*keys)
    near = df.withColumn("_best", F.max(value).over(best)).where(F.col("_best") - F.col(value) <= eps)
    out = near.withColumn("_pick", F.row_number().over(best.orderBy(F.col(tie).desc(), F.col(ident).asc())))
    return out.where("_pick = 1").drop("_best", "_pick")


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with _range: rows dealt by sampled ranges of an order, equal rows together, ranges ascending. Written, so that
    every later read sees the same ranges."""
    return written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))


def _before(ranged: DataFrame, amount: Column) -> DataFrame:
    """(_range, _before): what the ranges before it amount to; a row for each partition."""
    sums = ranged.groupBy("_range").agg(F.sum(amount).alias("_n"))
    return F.broadcast(sums.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before")))


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Row numbers of a total order over all rows: within ranges, plus the ranges before; no task sees all rows."""
    ranged = in_ranges(df, order)
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, within).join(_before(ranged, F.lit(1)), "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def average_ranks(df: DataFrame, value: str, name: str = "avg_rank") -> DataFrame:
    """Ranks with ties averaged: counts per distinct value are summed within ranges of values, rows are joined to them."""
    ranged = in_ranges(df.groupBy(value).agg(F.count("*").alias("_c")), [F.col(value)])
    upto = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = ranged.withColumn("_upto", F.sum("_c").over(upto)).join(_before(ranged, F.col("_c")), "_range")
    return df.join(ranks.select(value, (F.col("_before") + F.col("_upto") - (F.col("_c") - 1) / 2).alias(name)), value)


def streak(df: DataFrame, keys: list[str], order: list[Column], hit: Column, transparent: Column) -> DataFrame:
    """Length of the run of hits that ends at each group's last row; transparent rows neither break nor extend it."""
    solid = df.where(~transparent).withColumn("_hit", hit.cast("int"))
    later = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = solid.withColumn("_miss", F.sum(1 - F.col("_hit")).over(later))
    return runs.groupBy(*keys).agg(F.sum(F.when(F.col("_miss") == 0, 1).otherwise(0)).alias("streak"))


def knee(df: DataFrame, value: str, ident: str, keys: list[str] | None = None) -> DataFrame:
    """In descending order, the value after the largest ratio of neighbours (zero next counts as infinite)."""
    w = Window.partitionBy(*(keys or [])).orderBy(F.col(value).desc(), F.col(ident))
    rows = df.withColumns({"_i": F.row_number().over(w), "_next": F.lead(value).over(w)}).where("_next is not null")
    ratio = F.when(F.col("_next") == 0, F.lit(float("inf"))).otherwise(F.col(value) / F.col("_next"))
    return top_k(rows.withColumn("ratio", ratio), keys or [], [F.col("ratio").desc(), F.col("_i")], 1, "_k").select(*(keys or []), F.col("_next").alias("knee"), "ratio", F.col("_i").alias("position"))
