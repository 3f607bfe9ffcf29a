"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_entities: dict[tuple, DataFrame] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset: a fresh local folder on one machine (tests), an error on a cluster, whose
    executors would not see such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet; deleted at the end of the process."""
    path = f"{shared_dir(spark)}/quill-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage: df written as Parquet in the shared folder and read back."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _state(spark: SparkSession, path: str) -> tuple:
    """What a rewritten table changes: newest change, bytes, files."""
    p, fs = _fs(spark, path)
    sum_ = fs.getContentSummary(p)
    return fs.getFileStatus(p).getModificationTime(), sum_.getLength(), sum_.getFileCount()


def entity(name: str, sources: list[str], build: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """build() written once a session, and read by all queries after it: an entity table, such as deduplicated activities.

    It is built again when one of its source tables has changed.
    """
    key = (spark.sparkContext.applicationId, name, *[(s, *_state(spark, s)) for s in sources])
    if key not in _entities:
        _entities[key] = written(build())
    return _entities[key]


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            return
