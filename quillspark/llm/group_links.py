"""Links inside loose groups of shingle sets: exact counts, without a row for a pair.

A group that fits one block is compared outright. A larger group is read against a reference R (what most sets of a sample
hold; any R gives the same links): of a set x only its delta D counts, the shingles of R that it lacks and those it has
beyond R. With c(x) = 5 |R - x| + 4 |x - R|, two sets reach the similarity 0.8 exactly if

    9 |D(x) & D(y)| >= c(x) + c(y) - |R|.

Pairs with c(x) + c(y) <= |R| are links whatever they share: a histogram of c counts them. Others must share a delta shingle,
so that an inverted index over deltas, rarest first and only as many as the bound on c needs, finds all of them; hot shingles
are dealt into pairs of blocks, and a pair counts where its first shared shingle is. Near copies of one text and texts around
one boilerplate both cost in proportion to their number. A group whose deltas would cost more than its blocks (few long
texts) is compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import drop_stored, small_side, stored
from quillspark.llm.grouping import linked_groups, sorted_groups, whole_groups

#: Sets, and shingles, of one block.
BLOCK_SETS, BLOCK_SHINGLES = 512, 400_000
#: Sets, and shingles on average, of the sample that a reference is taken from.
SAMPLE_SETS, SAMPLE_SHINGLES = 64, 2_000_000
PARTIAL = pa.schema([("row", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets a with the sets b, by products of 0/1 matrices over shared values."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat = np.concatenate([*a, *b])
    if not len(flat):
        return out
    owner = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in [*a, *b]])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # a value of one set adds nothing
    column, owner = column[shared], owner[shared]
    if len(column):
        column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1
        top = int(column[-1]) + 1
        for lo in range(0, top, 2048):
            x = np.zeros((len(a) + len(b), min(2048, top - lo)), np.float32)
            i, j = np.searchsorted(column, [lo, lo + 2048])
            x[owner[i:j], column[i:j] - lo] = 1
            out += x[: len(a)] @ x[len(a) :].T
    return out


def _tallied(rows: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """near: which of the rows at `left` and at `right` link; a row and itself never do. Links of each row, and its root."""
    own = left is right
    if own:
        np.fill_diagonal(near, False)
    links = np.zeros(len(rows), np.int64)
    links[left] += near @ copies[right]
    if not own:
        links[right] += near.T @ copies[left]
    where, other = np.full(len(rows), -1), np.full(len(rows), -1)
    where[left], other[right] = np.arange(len(left)), np.arange(len(right))

    def similar(i: int, rest: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(rest), bool)
        if where[i] >= 0:
            ok = other[rest] >= 0
            hit[ok] |= near[where[i], other[rest[ok]]]
        if other[i] >= 0:
            ok = where[rest] >= 0
            hit[ok] |= near[where[rest[ok]], other[i]]
        return hit

    root = np.empty(len(rows), np.int64)
    for g in linked_groups(len(rows), similar):
        root[g] = rows[g].min()
    some = links > 0
    return pa.record_batch([pa.array(rows[some]), pa.array(links[some]), pa.array(root[some])], schema=PARTIAL)


def block_links(blocks: DataFrame) -> DataFrame:
    """blocks(comp, bi, bj, side, row, copies, shingles): (row, links, root) partial sums and stars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, 3):
            side, rows, copies = (t.column(n).to_numpy() for n in ("side", "row", "copies"))
            sets = [np.frombuffer(s, dtype="<u4") for s in t.column("shingles").to_pylist()]
            left = np.flatnonzero(side == 0)
            right = left if t.column("bi")[0].as_py() == t.column("bj")[0].as_py() else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            size = np.array([len(s) for s in sets], dtype=np.int64)
            common = intersections([sets[k] for k in left], [sets[k] for k in right]).astype(np.int64)
            # similarity >= 0.8 in whole numbers: 9 |a & b| >= 4 (|a| + |b|)
            yield _tallied(rows, copies, left, right, 9 * common >= 4 * (size[left][:, None] + size[right][None, :]))

    return sorted_groups(blocks, "comp", "bi", "bj").mapInArrow(work, "row long, links long, root long")


def _spread(sized: DataFrame, nb: str) -> DataFrame:
    """Deals the sets of a group into nb blocks; each block meets each."""
    placed = sized.withColumn("b", F.pmod(F.xxhash64("row"), F.col(nb)).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col(nb) - 1)))
    return placed.select("comp", F.least("b", "x").alias("bi"), F.greatest("b", "x").alias("bj"), F.when(F.col("b") <= F.col("x"), 0).otherwise(1).alias("side"), "row", "copies", "shingles")


def references(big: DataFrame) -> DataFrame:
    """big(comp, row, m, s, shingles) -> (comp, reference): shingles of more than half of a sample of the group's sets."""
    schema = pa.schema([("comp", pa.int64()), ("reference", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            value, times = np.unique(np.concatenate([np.frombuffer(s, dtype="<u4") for s in t.column("shingles").to_pylist()]), return_counts=True)
            yield pa.record_batch([t.column("comp").slice(0, 1).combine_chunks(), pa.array([value[2 * times > t.num_rows].tobytes()], pa.binary())], schema=schema)

    take = F.greatest(F.lit(1.0), F.least(F.lit(float(SAMPLE_SETS)), float(SAMPLE_SHINGLES) * F.col("m") / F.col("s")))
    sample = big.where(F.pmod(F.xxhash64("row"), F.col("m")) < take).select("comp", "shingles")
    return sorted_groups(sample, "comp").mapInArrow(work, "comp long, reference binary")


def deltas(big: DataFrame) -> DataFrame:
    """big(comp, row, copies, shingles, reference) -> comp, row, copies, c, r (size of R), tokens (what R has and the set
    lacks, and, from 2^32 on, what the set has beyond R)."""
    schema = pa.schema([("comp", pa.int64()), ("row", pa.int64()), ("copies", pa.int64()), ("c", pa.int64()), ("r", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cs, rs, tokens = [], [], []
            for s, ref in zip(batch.column("shingles"), batch.column("reference"), strict=True):
                own, r = np.frombuffer(s.as_buffer(), dtype="<u4"), np.frombuffer(ref.as_py() or b"", dtype="<u4")
                lacks, more = np.setdiff1d(r, own, assume_unique=True), np.setdiff1d(own, r, assume_unique=True)
                cs.append(5 * len(lacks) + 4 * len(more))
                rs.append(len(r))
                tokens.append(np.concatenate([lacks.astype(np.int64), more.astype(np.int64) + 2**32]))
            yield pa.record_batch([*[batch.column(n) for n in ("comp", "row", "copies")], pa.array(cs, pa.int64()), pa.array(rs, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], schema=schema)

    return big.select("comp", "row", "copies", "shingles", "reference").mapInArrow(work, "comp long, row long, copies long, c long, r long, tokens array<long>")


def certain_links(delta: DataFrame, ends: DataFrame) -> DataFrame:
    """Links of pairs with c(x) + c(y) <= |R|, counted by a histogram of c (at most a row for each value that c takes up to
    |R|, however many sets): (row, links, root). Any such set also links to the group's set of the smallest c, its root."""
    low = delta.where("c <= r")
    hist = low.groupBy("comp", "c").agg(F.sum("copies").alias("k"), F.first("r").alias("r"))
    asks = hist.select("comp", (F.col("r") - F.col("c")).alias("at"), F.lit(1).alias("ask"), F.lit(0).cast("long").alias("k"), "c")
    held = hist.select("comp", F.col("c").alias("at"), F.lit(0).alias("ask"), "k", "c")
    within = Window.partitionBy("comp").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, 0)
    found = asks.unionByName(held).withColumn("links", F.sum("k").over(within)).where("ask = 1 and links > 0").select("comp", "c", "links")
    own = F.when(2 * F.col("c") <= F.col("r"), F.col("copies")).otherwise(0)
    out = low.join(small_side(stored(found, "certain")), ["comp", "c"]).join(ends, "comp")
    return out.select("row", (F.col("links") - own).alias("links"), F.when(F.col("c") + F.col("cmin") <= F.col("r"), F.col("z")).otherwise(F.col("row")).alias("root")).where("links > 0")


def indexed(delta: DataFrame, ends: DataFrame) -> DataFrame:
    """The sets that may be in a pair with c(x) + c(y) > |R|: comp, row, copies, c, r, far, codes (shared delta shingles,
    rarest first, each with how many far and other sets hold it), need (how many of them a link must share at least).

    Of such a pair one set at least is far, c > |R| / 2; shingles that no far set holds, or only one set, can't be shared."""
    open_ = delta.join(ends, "comp").where("c + cmax > r").withColumn("far", F.col("c") * 2 > F.col("r"))
    token = open_.select("comp", "row", "copies", "c", "r", "cmin", "far", F.explode("tokens").alias("token"))
    held = token.groupBy("comp", "token").agg(F.count_if("far").alias("nf"), F.count_if(~F.col("far")).alias("nn")).where("nf > 0 and nf + nn > 1")
    coded = token.join(small_side(stored(held, "held")), ["comp", "token"])
    entry = F.struct((F.shiftleft(F.col("nf") + F.col("nn"), 33) + F.col("token")).alias("code"), "nf", "nn")
    out = coded.groupBy("comp", "row", "copies", "c", "r", "cmin", "far").agg(F.sort_array(F.collect_list(entry)).alias("codes"))
    # |D(y)| <= c(y) / 4 bounds what can be shared, and no c is below the group's smallest
    need = F.greatest(F.lit(1), F.ceil((F.col("c") - F.col("r")) / 5), F.ceil((F.col("c") + F.col("cmin") - F.col("r")) / 9))
    return out.withColumn("need", need).where(F.size("codes") >= F.col("need")).withColumn("prefix", F.slice("codes", 1, (F.size("codes") - F.col("need") + 1).cast("int")))


def _buckets(rows: DataFrame, block_sets: int) -> DataFrame:
    """One row for each prefix shingle and pair of blocks: far sets meet far sets (kind 0) and the others (kind 1)."""
    e = rows.select("comp", "row", "copies", "c", "r", "far", F.col("codes.code").alias("codes"), F.explode("prefix").alias("p"))
    e = e.withColumn("fb", F.ceil(F.col("p.nf") / block_sets).cast("int")).withColumn("nb", F.ceil(F.col("p.nn") / block_sets).cast("int"))
    h = F.xxhash64("row")
    e = e.withColumn("b", F.when(F.col("far"), F.pmod(h, F.col("fb"))).otherwise(F.pmod(h, F.greatest(F.col("nb"), F.lit(1)))).cast("int"))
    spot = lambda kind, bi, bj, side: F.struct(F.lit(kind).alias("kind"), bi.alias("bi"), bj.alias("bj"), side.alias("side"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    b = F.col("b")
    among = F.transform(upto("fb"), lambda x: spot(0, F.least(b, x), F.greatest(b, x), F.when(b <= x, 0).otherwise(1)))
    across = F.transform(upto("nb"), lambda x: spot(1, b, x, F.lit(0)))
    met = F.transform(upto("fb"), lambda x: spot(1, x, b, F.lit(1)))
    out = e.withColumn("at", F.explode(F.when(F.col("far"), F.concat(among, across)).otherwise(met)))
    return out.select("comp", F.col("p.code").alias("code"), F.col("at.kind").alias("kind"), F.col("at.bi").alias("bi"), F.col("at.bj").alias("bj"), F.col("at.side").alias("side"), "row", "copies", "c", "r", "codes")


def open_links(rows: DataFrame, block_sets: int = BLOCK_SETS) -> DataFrame:
    """Links of pairs with c(x) + c(y) > |R| among indexed() rows: (row, links, root). A pair counts at its first shared code."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, 5):
            if t.num_rows < 2:
                continue
            side, row, copies, c = (t.column(n).to_numpy() for n in ("side", "row", "copies", "c"))
            own = t.column("kind")[0].as_py() == 0 and t.column("bi")[0].as_py() == t.column("bj")[0].as_py()
            left = np.flatnonzero(side == 0)
            right = left if own else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            code, r = t.column("code")[0].as_py(), t.column("r")[0].as_py()
            sets = [np.asarray(x.values) for x in t.column("codes")]
            cut = [int(np.searchsorted(s, code)) for s in sets]
            before = intersections([sets[k][: cut[k]] for k in left], [sets[k][: cut[k]] for k in right])
            common = (before + intersections([sets[k][cut[k] :] for k in left], [sets[k][cut[k] :] for k in right])).astype(np.int64)
            over = c[left][:, None] + c[right][None, :] - r
            yield _tallied(row, copies, left, right, (before == 0) & (over > 0) & (9 * common >= over))

    return sorted_groups(_buckets(rows, block_sets), "comp", "code", "kind", "bi", "bj").mapInArrow(work, "row long, links long, root long")


def group_links(sized: DataFrame, block_sets: int = BLOCK_SETS) -> DataFrame:
    """sized(comp, row, n, copies, shingles), stored: a stored table (row, links, root) of partial sums and stars, of which the
    sums by row are the links and the connected parts the classes. Rows without links may be missing."""
    sums = stored(sized.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("s")), "sums")
    nb = F.ceil(F.greatest(F.col("m") / block_sets, F.col("s") / BLOCK_SHINGLES)).cast("int")
    placed = sized.join(small_side(sums.withColumn("nb", nb)), "comp")
    alone = placed.where("nb = 1").select("comp", F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.lit(0).alias("side"), "row", "copies", "shingles")
    parts, tables = [block_links(alone)], []
    if sums.where(nb > 1).limit(1).count():
        big = placed.where("nb > 1")
        reference = stored(references(big), "references")
        delta = stored(deltas(big.join(small_side(reference), "comp", "left")), "deltas")
        ends = stored(delta.groupBy("comp").agg(F.min("c").alias("cmin"), F.max("c").alias("cmax"), F.min(F.struct("c", "row"))["row"].alias("z")), "ends")
        rows = stored(indexed(delta, small_side(ends)), "indexed")
        # bytes that buckets and blocks would send, group by group
        each = F.aggregate("prefix", F.lit(0.0), lambda s, p: s + F.ceil((p["nf"] + p["nn"]) / block_sets))
        cost = rows.groupBy("comp").agg(F.sum(each * (8 * F.size("codes") + 64)).alias("cost"))
        dear = stored(sums.withColumn("nb", nb).where("nb > 1").join(cost, "comp").where(F.col("cost") > F.col("nb") * (4 * F.col("s") + 64 * F.col("m"))).select("comp", "nb"), "dear")
        tables += [reference, delta, ends, rows, dear]
        wide = small_side(dear)
        cheap = lambda df: df.join(wide.select("comp"), "comp", "left_anti")
        parts += [certain_links(cheap(delta), small_side(ends)), open_links(cheap(rows), block_sets), block_links(_spread(sized.join(wide, "comp"), "nb"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = stored(out, "partial")
    for t in [sums, *tables]:
        drop_stored(t)
    return out
