"""What the training-data operators share: tables in the shared folder, checked broadcasts, small helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.sources.shared import delete, shared_dir

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of at most so many bytes, counted before the join, may be broadcast; beyond it joins shuffle.
BROADCAST_BYTES = 8 << 20
#: Bytes of text that a Python function works on at once.
BATCH_BYTES = 8 << 20

_written: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, label: str = "t") -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back.

    Files live until drop_stored() or the end of the process. A lost executor loses nothing that a later stage needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quill-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._quill_path = path  # for drop_stored
    return out


def drop_stored(df: DataFrame) -> None:
    """Deletes a table of stored() that no later result reads."""
    path = getattr(df, "_quill_path", None)  # none, too, where df is None
    if path:
        delete(df.sparkSession, path)



@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            return


def _width(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.size(c), F.lit(0)) * 16 + 16
    return F.lit(16)


def small_side(df: DataFrame, size: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its rows take at most `size` bytes, unmarked otherwise. df should be cheap (a stored table)."""
    width = sum((_width(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    return F.broadcast(df) if (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= size else df


def batches_of_bytes(batch: pa.RecordBatch, rows: int, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most `rows` rows and about `size` bytes of text (one row at least)."""
    length = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            length += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(length), 0
    while start < batch.num_rows:
        room = np.searchsorted(ends, (ends[start - 1] if start else 0) + size, side="right")
        stop = min(start + rows, max(int(room), start + 1))
        yield batch.slice(start, stop - start)
        start = stop


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application: their Python workers import it by name."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="quill-py-")) / "quillspark_src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def tune(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of long texts must fit in a Python worker beside its results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def key_of(column: str) -> Column:
    """A non-null string key for a nullable column, so that nulls join as one value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of docs whole, as a struct _doc, beside computed columns: whatever the names of docs, none clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *[c.alias(name) for name, c in columns.items()])


def unused(docs: DataFrame, name: str) -> str:
    """A column name like `name` that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_rows(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents that stay. keyed: (_doc, _id, _sha) of packed(), with a row key; rows: (_id, _sha, kept) for each row.

    Keys of which some rows stay and others go belong to repeated rows: of these one is returned.
    """
    gone = stored(rows.where("not kept").select("_id", "_sha").distinct(), "gone")
    ties = stored(gone.join(rows.where("kept"), ["_id", "_sha"], "left_semi"), "ties")
    plain = keyed.join(small_side(gone), ["_id", "_sha"], "left_anti").select("_doc.*")
    again = keyed.join(small_side(ties), ["_id", "_sha"], "left_semi").groupBy("_id", "_sha").agg(F.min_by("_doc", F.to_json("_doc")).alias("_doc"))
    return plain.unionByName(again.select("_doc.*"))
