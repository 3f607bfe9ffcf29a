"""Session construction and the settings every query relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that results depend on (time zone) or that bound memory in Python workers.
BASE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cpus: int | str | None = None, app: str = "quillspark", memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the session the cluster gives."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = BASE | {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
