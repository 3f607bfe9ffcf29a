"""Typed reads of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
