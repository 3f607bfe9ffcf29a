"""A stated query set against all rows, in blocks of a bounded size."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Queries of one block: the side that is broadcast.
BLOCK = 5_000


def against(rows: DataFrame, queries: DataFrame, key: str, on: Column, fold: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """fold(rows joined to a block of queries) for every block of the queries, in one result.

    Blocks are dealt by a hash of the query's key, so that each is broadcast with about `block` rows at most; fold must treat
    queries one by one (its groups don't span queries).
    """
    n = queries.count()
    # the comparisons are the work, not the bytes: few files of rows would leave them to few tasks
    rows = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = max(1, -(-n // block))
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    done = [fold(rows.join(F.broadcast(queries.where(part == k) if parts > 1 else queries), on)) for k in range(parts)]
    return reduce(DataFrame.unionByName, done)


#: Bytes of a side that may be broadcast.
SMALL_BYTES = 8 << 20


def small(df: DataFrame, size: int = SMALL_BYTES) -> DataFrame:
    """df marked for broadcast if its rows take at most `size` bytes (counted now), else left to the optimizer."""
    width = F.lit(16 * (1 + len(df.columns)))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            width = width + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + 16 * F.greatest(F.size(f"`{f.name}`"), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= size else df
