"""Pairs of alike vectors: a block of vectors at a time meets all rows as a matrix product."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.blocks import small
from quillspark.operators.overlap import components
from quillspark.sources.shared import written

#: Vectors of one block: what the driver holds and broadcasts at once.
BLOCK = 5_000


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a column of lists of one length, scaled to length one; zero vectors stay zero."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def alike_pairs(vectors: DataFrame, ident: str, vector: str, least: float, block: int = BLOCK) -> DataFrame:
    """(a, b, sim) for a < b whose cosine is at least `least` (above 0). All pairs are compared, so that work grows with the
    table's square; memory is a block of vectors and a batch of rows. Rows without a vector have no pairs."""
    spark = vectors.sparkSession
    own = vectors.where(F.col(vector).isNotNull()).select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])
    parts = max(1, -(-own.count() // block))
    spread = own.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def met(k: int) -> DataFrame:
        held = own.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == k).toArrow()  # about `block` rows
        data = spark.sparkContext.broadcast((held.column("id").to_numpy(), _unit(held.column("v").combine_chunks()) if held.num_rows else np.zeros((0, 1))))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, x = data.value
            for batch in batches:
                for lo in range(0, batch.num_rows if len(ids) else 0, 512):
                    part = batch.slice(lo, 512)
                    right, sim = part.column(0).to_numpy(), x @ _unit(part.column(1)).T
                    i, j = np.nonzero((sim >= least) & (ids[:, None] < right[None, :]))
                    yield pa.record_batch([pa.array(ids[i]), pa.array(right[j]), pa.array(sim[i, j])], schema=schema)

        return spread.mapInArrow(work, "a long, b long, sim double")

    return reduce(DataFrame.unionByName, [met(k) for k in range(parts)])


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each node's root, the least of its component) with the edges i-j added."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j = i[apart], j[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(label, above := label[label]):
            label = above
    return label


def _forest(ids: np.ndarray, v: pa.Array, least: float, rows: int | None = None) -> pa.RecordBatch:
    """(a, b): edges that join the same vectors as all pairs whose cosine is at least `least`, of the first `rows` of them
    with all. Memory is 512 rows of the product; at most one edge a vector is returned."""
    x, label = _unit(v), np.arange(len(ids))
    raw = np.asarray(v.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(v), -1)
    dot = lambda p, q: np.cumsum(p * q, axis=1)[:, -1]  # noqa: E731  summed in order
    for lo in range(0, len(ids) if rows is None else rows, 512):
        sim = x[lo : min(lo + 512, len(ids) if rows is None else rows)] @ x[lo:].T
        i, j = np.nonzero(sim >= least - 1e-12)
        near, keep = np.flatnonzero(sim[i, j] < least + 1e-12), np.ones(len(i), bool)
        p, q = raw[lo + i[near]], raw[lo + j[near]]
        keep[near] = dot(p, q) / (np.sqrt(dot(p, p)) * np.sqrt(dot(q, q))) >= least
        label = _joined(label, lo + i[keep], lo + j[keep])
    low = np.flatnonzero(label != np.arange(len(ids)))
    return pa.record_batch([pa.array(ids[low]), pa.array(ids[label[low]])], names=["a", "b"])


#: Vectors of a group that are compared at once, and about how many of each group go to all its blocks.
GROUP_BLOCK, PIVOTS = 4_096, 256


def alike_forest(vectors: DataFrame, ident: str, vector: str, group: str, least: float, block: int = GROUP_BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of a group with a cosine of at least `least` (above 0).

    Equal vectors are compared once and linked to their least id. Blocks of a group are compared within themselves and with
    the group's pivots. A pair within one component needs no comparison, so that only vectors outside their group's largest
    component then meet all rows of the group: nothing is left out. Where few vectors are alike, most do so, and work grows
    with the square of the group.
    """
    spark = vectors.sparkSession
    given = vectors.where(F.col(vector).isNotNull() & F.col(group).isNotNull()).select(F.col(ident).cast("long").alias("id"), F.col(group).alias("g"), F.col(vector).alias("v"))
    own = written(given.groupBy("g", "v").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    norm = F.exists("v", lambda e: e != 0)
    stars = given.join(small(own.where(norm & (F.col("n") > 1)).select("g", "v", F.col("id").alias("b"))), ["g", "v"]).where("id <> b").select(F.col("id").alias("a"), "b")
    sizes = own.groupBy("g").agg(F.ceil(F.count("*") / block).alias("_blocks"), F.ceil(F.count("*") / pivots).alias("_some"))
    k = F.when(F.pmod(F.xxhash64("id", F.lit(1)), "_some") == 0, F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), "_blocks")))
    sized = own.join(small(sizes), "g")
    within = lambda t: pa.Table.from_batches([_forest(t.column("id").to_numpy(), t.column("v").combine_chunks(), least)])
    first = written(sized.select("g", "id", "v", F.explode(k).alias("k")).groupBy("g", "k").applyInArrow(within, "a long, b long"))
    edges = stars.unionByName(first)
    large = sized.where("_blocks > 1").select("g", "id", "v")
    if not large.limit(1).count():
        return edges
    found = large.join(components(first), F.col("id") == F.col("node"), "left").select("g", "id", "v", F.coalesce("component", "id").alias("c"))
    main = found.groupBy("g", "c").agg(F.count("*").alias("m")).groupBy("g").agg(F.max_by("c", "m").alias("main"))
    rest = written(found.join(small(main), "g").where("c <> main").select("g", "id", "v"))
    parts = -(-rest.count() // block)
    spread = large.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def met(part: int) -> DataFrame:
        held = rest.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toArrow().combine_chunks()
        data = spark.sparkContext.broadcast(held)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            left = data.value
            for batch in batches:
                right = pa.Table.from_batches([batch])
                for g in set(left.column("g").unique().to_pylist()) & set(right.column("g").unique().to_pylist()):
                    some = left.filter(pc.equal(left.column("g"), g))
                    both = pa.concat_tables([some.select(["id", "v"]), right.filter(pc.equal(right.column("g"), g)).select(["id", "v"]).cast(some.select(["id", "v"]).schema)]).combine_chunks()
                    yield _forest(both.column("id").to_numpy(), both.column("v").combine_chunks(), least, some.num_rows)

        return spread.mapInArrow(work, "a long, b long")

    return reduce(DataFrame.unionByName, [met(p) for p in range(parts)], edges)
