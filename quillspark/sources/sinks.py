"""Sinks: merges, partition replacement, versioned artifacts with manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def merged(old: DataFrame, new: DataFrame, keys: list[str], owned: list[str] | None = None, held: Column | None = None) -> DataFrame:
    """old with new over it by key. owned: columns that a run without a value clears; others keep their old value where the
    new one is null. held: a condition on old rows (columns prefixed o_) that keeps the whole old row."""
    owned = owned or []
    cols = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"o_{c}") for c in old.columns if c not in keys], F.lit(True).alias("o__in"))
    n = new.select(*keys, *[F.col(c).alias(f"n_{c}") for c in new.columns if c not in keys], F.lit(True).alias("n__in"))
    rows = o.join(n, keys, "full")
    keep = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)

    def pick(c: str) -> Column:
        was = F.col(f"o_{c}") if c in old.columns else F.lit(None)
        now = F.col(f"n_{c}") if c in new.columns else F.lit(None)
        fresh = F.when(F.col("n__in"), now).otherwise(was) if c in owned else F.coalesce(now, was)
        return F.when(keep, was).otherwise(fresh).alias(c)

    return rows.select(*keys, *[pick(c) for c in cols])


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrites exactly the partitions that df has; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def orphans(spark: SparkSession, path: str, live: DataFrame, by: str) -> DataFrame:
    """Partitions on disk that are not in live."""
    return spark.read.parquet(path).select(by).distinct().join(live.select(by), by, "left_anti")


def drop_partition(spark: SparkSession, path: str, by: str, value: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def canonical(df: DataFrame) -> DataFrame:
    """Rows as JSON with sorted keys."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])).alias("json"))


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, digest): a digest of the rows in any order. Rows are hashed where they lie and summed by 16 prefix groups, whose
    digests are then joined: nothing of the table's size meets in one task."""
    h = canonical(df).select(F.sha2("json", 256).alias("h"))
    part = h.select(F.conv(F.substring("h", 1, 13), 16, 10).cast("decimal(38,0)").alias("a"), F.conv(F.substring("h", 14, 13), 16, 10).cast("decimal(38,0)").alias("b"))
    s = part.agg(F.count("*").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return s.select("rows", F.sha2(F.concat_ws("/", F.col("rows").cast("string"), F.coalesce(F.col("a").cast("string"), F.lit("0")), F.coalesce(F.col("b").cast("string"), F.lit("0"))), 256).alias("digest"))


def publish(df: DataFrame, base: str, version: str, previous: str | None = None) -> dict:
    """Writes a version, then its manifest, then the pointer `latest`; an unchanged content is not published again."""
    spark = df.sparkSession
    seal = content_hash(df).first()
    manifest = {"version": version, "rows": seal["rows"], "sha256": seal["digest"], "schema": json.loads(df.schema.json())}
    if previous == seal["digest"]:
        return manifest | {"published": False}
    df.write.mode("overwrite").parquet(f"{base}/{version}/data")
    one = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1)
    one.write.mode("overwrite").text(f"{base}/{version}/manifest")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/latest")
    return manifest | {"published": True}


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    version = spark.read.text(f"{base}/latest").first()["value"]
    return spark.read.parquet(f"{base}/{version}/data")


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for small reports."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
