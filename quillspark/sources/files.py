"""File sources: CSV under a banner, JSON bundles, append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_under_banner(spark: SparkSession, path: str, header: str, schema: str) -> DataFrame:
    """Rows of a CSV whose header row stands below banner lines: everything up to the header, in each file, is dropped.

    Lines are numbered within their file by the reader's split order, so that nothing is collected.
    """
    lines = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "\r\n?", "\n").alias("v"))
    body = lines.select(F.explode(F.split(F.regexp_replace("v", f"(?s)^.*?{header}\n", ""), "\n")).alias("line")).where("line <> ''")
    return body.select(F.from_csv("line", F.lit(schema)).alias("r")).select("r.*")


def either(df: DataFrame, *names: str) -> Column:
    """The first of several accepted header names that is there."""
    found = [F.col(n) for n in names if n in df.columns]
    if not found:
        raise ValueError(f"none of {names} in {df.columns}")
    return F.coalesce(*found)


def read_json_bundle(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def replay_log(spark: SparkSession, path: str, schema: str, key: str, order: str, strict: bool = False) -> DataFrame:
    """An append-only JSON log, last write by key wins. strict fails on a line that can't be read, else it is dropped; a strict
    log without any entry fails."""
    log = spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")
    if strict and not log.limit(1).count():
        raise ValueError(f"empty log {path}")
    last = Window.partitionBy(key).orderBy(F.col(order).desc())
    return log.where(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A warehouse table over JDBC, in parallel ranges of a numeric column if given."""
    if column and bounds:
        return spark.read.jdbc(url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def with_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of given ids (semi-join). An empty id list gives an empty result."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row by key, by a partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_m"))
    return best.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest])
