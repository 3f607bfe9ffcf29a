"""Exact deduplication with a log-structured merge index of text digests.

Write path: each task keeps a memtable from digest to (smallest key, rows); when full it is flushed as a sorted run that
keeps a Bloom filter over its digests. Incoming digests are tested against the filters of the runs that the task holds, and
a hit is looked up in its run and counted there, so that a digest is in one run of a task; eight runs merge into one.
Compaction across tasks reads all runs of a digest range as one sorted stream and keeps the smallest identifier. Read path:
each row looks its digest up under its own run, so that a hot digest is spread over as many keys as runs saw it. Every hit
is verified byte by byte against the normalised text of the row that stays; rows that fail (digest collisions) are grouped
by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import SPACE, packed, ship, small_side, stored, without_rows

#: Digests a memtable holds before it is flushed: about 15 MB of Python objects.
MEMTABLE = 50_000
#: Runs that merge into one, and digests (of 48 bytes with their values) that a task holds before it writes its runs out.
TIER, HELD = 8, 2_000_000


class Bloom:
    """A Bloom filter over digests: four probes from the digest's own bits, no further hashing; one bit a bit."""

    def __init__(self, n: int, bits_per_key: int = 12) -> None:
        self.m = 1 << max(6, int(np.ceil(np.log2(max(1, n) * bits_per_key))))
        self.bits = np.zeros(self.m // 8, dtype=np.uint8)

    def _probes(self, digests: np.ndarray) -> Iterator[np.ndarray]:
        raw = np.zeros((len(digests), 16), np.uint8)
        wide = digests.view(np.uint8).reshape(len(digests), -1)[:, :16]
        raw[:, : wide.shape[1]] = wide
        a, b = raw.view("<u8").T
        return ((a + np.uint64(k) * (b | np.uint64(1))) & np.uint64(self.m - 1) for k in range(4))

    def add(self, digests: np.ndarray) -> Bloom:
        for p in self._probes(digests):
            np.bitwise_or.at(self.bits, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        return self

    def may_hold(self, digests: np.ndarray) -> np.ndarray:
        out = np.ones(len(digests), dtype=bool)
        for p in self._probes(digests):
            out &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


class Run:
    """A sorted run: digests (fixed bytes) ascending, beside each the smallest identifier and the number of rows, and a filter."""

    def __init__(self, digests: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.digests, self.ids, self.counts = digests, ids, counts
        self.filter = Bloom(len(digests)).add(digests)

    def take(self, digests: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Counts the rows whose digests the run holds; True for them. The filter spares the others the search."""
        hit = self.filter.may_hold(digests)
        if hit.any():
            at = np.searchsorted(self.digests, digests[hit])
            at[at == len(self.digests)] = 0
            found = self.digests[at] == digests[hit]
            hit[hit] = found
            np.minimum.at(self.ids, at[found], ids[hit])
            np.add.at(self.counts, at[found], 1)
        return hit


def compact(runs: list[Run]) -> Run:
    """Merges sorted runs into one: of equal digests the smallest identifier stays, counts add."""
    digests = np.concatenate([r.digests for r in runs])
    order = np.argsort(digests, kind="stable")  # merges runs that are sorted
    digests, ids, counts = digests[order], np.concatenate([r.ids for r in runs])[order], np.concatenate([r.counts for r in runs])[order]
    first = np.flatnonzero(np.concatenate(([True], digests[1:] != digests[:-1])))
    return Run(digests[first], np.minimum.reduceat(ids, first), np.add.reduceat(counts, first))


class Index:
    """One task's part: a memtable and its runs."""

    def __init__(self, capacity: int = MEMTABLE) -> None:
        self.capacity, self.table, self.runs = capacity, {}, []

    def put(self, digests: np.ndarray, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            stop = start + max(1, self.capacity - len(self.table))
            own, key = digests[start:stop], ids[start:stop]
            for run in self.runs:
                if len(own):
                    hit = run.take(own, key)
                    own, key = own[~hit], key[~hit]
            for d, i in zip(own.tolist(), key.tolist(), strict=True):
                had = self.table.get(d)
                self.table[d] = (i, 1) if had is None else (min(had[0], i), had[1] + 1)
            if len(self.table) >= self.capacity:
                self.flush()
            start = stop

    def flush(self) -> None:
        if self.table:
            keys = sorted(self.table)
            values = np.array([self.table[k] for k in keys], dtype=np.int64)
            width = max(map(len, keys))
            self.runs.append(Run(np.array(keys, dtype=f"S{width}"), values[:, 0].copy(), values[:, 1].copy()))
            self.table = {}
        if len(self.runs) >= TIER:
            self.runs = [compact(self.runs)]

    def held(self) -> int:
        return sum(len(r.digests) for r in self.runs)


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """Digests as fixed bytes. Numpy drops zeros at the end of such bytes; as all are equally long, none is mistaken."""
    return np.array([d[:width] for d in column.to_pylist()], dtype=f"S{width}")


def _flushes(capacity: int, width: int, held: int = HELD):
    """Rows (doc_id, digest) -> the same rows with their run, and the runs' entries (entry = true)."""
    schema = pa.schema([("entry", pa.bool_()), ("run", pa.int64()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64())])

    def emit(entry: bool, run: int, digests: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        whole = [d.ljust(width, b"\0") for d in digests.tolist()]
        return pa.record_batch([pa.array(np.full(len(ids), entry)), pa.array(np.full(len(ids), run)), pa.array(whole, pa.binary()), pa.array(ids), pa.array(counts)], schema=schema)

    def entries(index: Index, run: int) -> Iterator[pa.RecordBatch]:
        index.flush()
        if index.runs:
            one = compact(index.runs)
            for lo in range(0, len(one.ids), 50_000):
                yield emit(True, run, *(x[lo : lo + 50_000] for x in (one.digests, one.ids, one.counts)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, index = TaskContext.get().partitionId() << 32, Index(capacity)
        for batch in batches:
            ids, digests = batch.column(0).to_numpy(), _fixed(batch.column(1), width)
            index.put(digests, ids)
            yield emit(False, run, digests, ids, np.ones(len(ids), np.int64))
            if index.held() > held:
                yield from entries(index, run)
                run, index = run + 1, Index(capacity)
        yield from entries(index, run)

    return work


def _compaction(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs' entries of a digest range, sorted by digest; out, for each entry of a digest with several rows, its final
    values. A digest has one entry a run, whatever its rows; only the last digest of a batch waits for the next one."""
    schema = pa.schema([("run", pa.int64()), ("digest", pa.binary()), ("keep", pa.int64()), ("n", pa.int64())])
    rest: pa.Table | None = None

    def merged(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        raw = np.frombuffer(b"".join(t.column("digest").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        first = np.flatnonzero(np.concatenate(([True], (raw[1:] != raw[:-1]).any(1))))
        size = np.diff(np.append(first, t.num_rows))
        keep, n = (np.repeat(f.reduceat(t.column(c).to_numpy(), first), size) for f, c in ((np.minimum, "doc_id"), (np.add, "n")))
        several = pa.array(n > 1)
        columns = [t.column("run").combine_chunks(), t.column("digest").combine_chunks(), pa.array(keep), pa.array(n)]
        return pa.RecordBatch.from_arrays([c.filter(several) for c in columns], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        last = t.column("digest")[-1]
        cut = t.num_rows
        while cut and t.column("digest")[cut - 1] == last:
            cut -= 1
        if cut:
            yield merged(t.slice(0, cut))
        rest = t.slice(cut)
    if rest is not None:
        yield merged(rest)


#: Null ids stand below every other; the contract's ids are never this small.
NULL_ID = -(2**63)


def normalised() -> F.Column:
    return F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")


def classes(docs: DataFrame, digest_bytes: int = 32, memtable: int = MEMTABLE) -> DataFrame:
    """docs(doc_id, text, ...): one row each: _id, _digest, _keep (id that stays), _n (rows equal to it), text_sha256.

    Null texts are empty texts; null ids count as smaller than all. digest_bytes may be lowered to provoke collisions.
    """
    ship(docs.sparkSession)
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), F.unhex(F.sha2(normalised(), 256)).alias("_sha"))
    log = stored(source.mapInArrow(_flushes(memtable, digest_bytes), "entry boolean, run long, digest binary, doc_id long, n long"), "lsmlog")
    entries, rows = log.where("entry").drop("entry"), log.where("not entry").select("run", "digest", "doc_id")
    # one sorted stream a digest range; hot digests are one entry a run here
    resolved = entries.repartition("digest").sortWithinPartitions("digest").mapInArrow(_compaction, "run long, digest binary, keep long, n long")
    found = rows.join(resolved, ["run", "digest"], "left")
    return found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.coalesce("keep", "doc_id").alias("_keep"), F.coalesce("n", F.lit(1)).alias("_n"))


def _texts(docs: DataFrame, digest_bytes: int) -> DataFrame:
    text = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), normalised().alias("_text"))
    return text.withColumn("_digest", F.substring(F.unhex(F.sha2("_text", 256)), 1, digest_bytes))


def verified(docs: DataFrame, digest_bytes: int = 32, memtable: int = MEMTABLE) -> tuple[DataFrame, DataFrame]:
    """The index's answer for each row, and for each row in a group whether its bytes are those of the row that stays."""
    hits = stored(classes(docs, digest_bytes, memtable), "lsmhits")
    several = stored(hits.where("_n > 1").select("_id", "_digest", "_keep").distinct(), "lsmseveral")
    text = _texts(docs, digest_bytes)
    kept = several.where("_id = _keep").select("_id", "_digest")  # read from the stored table, as small_side counts it first
    # the bytes of the rows that stay, one a digest: of rows with one id and several texts, the smallest text
    keeper = text.join(small_side(kept), ["_id", "_digest"], "left_semi").groupBy("_digest").agg(F.min("_text").alias("_kept_text"))
    # written, so that both sides of the next join are plain exchanges, of which a hot digest's can be split
    keeper = stored(keeper, "lsmkeeper")
    member = text.join(small_side(several), ["_id", "_digest"])
    same = F.col("_text").eqNullSafe(F.col("_kept_text"))
    checked = member.join(keeper, "_digest", "left").select("_id", "_digest", same.alias("_same"))
    return hits, stored(checked, "lsmchecked")


def dedup(docs: DataFrame, digest_bytes: int = 32, memtable: int = MEMTABLE) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows that share the smallest id and the text, one is kept. Empty tables give no rows; other columns don't matter.
    """
    hits, checked = verified(docs, digest_bytes, memtable)
    lies = checked.where("not _same")
    if digest_bytes >= 32 and lies.limit(1).count() == 0:
        # no digest lied: the index's answer is the answer
        rows = hits.withColumn("_sha", F.lower(F.hex("_digest")))
    else:
        # texts that share a digest with another text are grouped by their bytes, so that the result is exact
        text = _texts(docs, digest_bytes)
        bad = lies.select("_digest").distinct()
        exact = text.join(bad, "_digest", "left_semi")
        sizes = exact.groupBy("_text").agg(F.min("_id").alias("_keep"), F.count("*").alias("_n"))
        fixed = exact.join(sizes, "_text").select("_id", F.sha2("_text", 256).alias("_sha"), "_keep", "_n")
        fine = text.join(bad, "_digest", "left_anti").select("_id", "_digest", F.sha2("_text", 256).alias("_sha")).distinct()
        rows = hits.join(bad, "_digest", "left_anti").join(fine, ["_id", "_digest"]).select("_id", "_sha", "_keep", "_n").unionByName(fixed)
    return _first_of_ties(rows)


def _first_of_ties(rows: DataFrame) -> DataFrame:
    """Marks exactly one kept row a group, though the smallest id may repeat."""
    heads = rows.where("_id = _keep")
    ties = heads.groupBy("_id", "_sha", "_keep", "_n").agg(F.count("*").alias("_rows"))
    one = ties.select("_id", "_sha", "_keep", "_n", F.lit(True).alias("kept"))
    more = ties.where("_rows > 1").withColumn("_k", F.explode(F.sequence(F.lit(2), F.col("_rows").cast("int")))).select("_id", "_sha", "_keep", "_n", F.lit(False).alias("kept"))
    rest = rows.where("_id <> _keep").select("_id", "_sha", "_keep", "_n", F.lit(False).alias("kept"))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return one.unionByName(more).unionByName(rest).select(back("_id").alias("doc_id"), back("_keep").alias("keep_id"), F.col("_n").cast("long").alias("group_size"), "kept", F.col("_sha").alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with its columns: of rows equal in id and text, one."""
    rows = stored(dedup(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.col("text_sha256").alias("_sha"), "kept"), "lsmrows")
    keyed = packed(docs, _id=F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), _sha=F.sha2(normalised(), 256))
    return without_rows(keyed, rows)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with the row that stays for it."""
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
       doc_id = keep_id AND row_number() OVER (PARTITION BY d.t, doc_id) = 1 AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
