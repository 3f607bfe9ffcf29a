"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line that is not empty) is hashed to a wide vector: 8 lanes of 64 bits from its bytes, for equality, and 256
lanes of 32 bits to which its word pairs add +1 or -1 each, for likeness. A document's fingerprint is the sum of its
paragraphs' vectors modulo 2^64 and 2^32: the order of paragraphs doesn't matter, and paragraphs can be added to or taken
from a fingerprint without the rest of the text. The signed lanes are a linear sketch, so that the cosine of two
fingerprints estimates the cosine of the two bags of word pairs, with a standard error of about 1/16.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of_bytes, ship, small_side, stored, tune

LANES, WIDE = 256, 8
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, root: int) -> np.ndarray:
    """1, root, root^2, ... modulo 2^64."""
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(root)
        np.multiply.accumulate(out, out=out)
    return out


_BASE = 0x100000001B3 | 1
#: Bytes hashed at once; longer texts are read chunk by chunk, with the same tables of powers.
CHUNK = 1 << 16
_pow = _powers(CHUNK + 1, _BASE)
_inv = _powers(CHUNK + 1, pow(_BASE, -1, 1 << 64))


def _sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _pow[: len(data)], out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of the byte ranges [start, end), which ascend and don't overlap; memory beside the
    ranges doesn't grow with the text, nor with a word."""
    out, at = np.empty(len(starts), dtype=np.uint64), 0
    while at < len(starts):
        lo = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, side="right")))
        if ends[stop - 1] - lo > CHUNK:  # one long word: piece by piece, each moved to its place
            total, scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)
            for piece in range(lo, int(ends[at]), CHUNK):
                total += _sums(data[piece : min(piece + CHUNK, int(ends[at]))])[-1:] * scale
                scale *= _pow[CHUNK]
            out[at] = total[0]
        else:
            sums, s, e = _sums(data[lo : int(ends[stop - 1])]), starts[at:stop] - lo, ends[at:stop] - lo
            out[at:stop] = (sums[e] - sums[s]) * _inv[s]
        at = stop
    return _mix(out + (ends - starts).astype(np.uint64) * _ROOT)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than white space)."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


class Fingerprint:
    """Sum of paragraph vectors. add(), remove() and + keep the law f(a) + f(b) = f(a and b together)."""

    __slots__ = ("lanes", "wide")

    def __init__(self, wide: np.ndarray | None = None, lanes: np.ndarray | None = None) -> None:
        self.wide = np.zeros(WIDE, dtype=np.uint64) if wide is None else wide
        self.lanes = np.zeros(LANES, dtype=np.uint32) if lanes is None else lanes

    @classmethod
    def of(cls, text: bytes) -> Fingerprint:
        """The fingerprint of a text: the sum over its paragraphs."""
        wide = [0] * WIDE
        for line in text.split(b"\n"):
            if line := line.strip(b" \t\r\x0b\x0c"):
                h = hashlib.blake2b(line, digest_size=8 * WIDE).digest()
                for k in range(WIDE):
                    wide[k] += int.from_bytes(h[8 * k : 8 * k + 8], "little")
        lanes = np.zeros(LANES, dtype=np.uint32)
        data = np.frombuffer(text, dtype=np.uint8)
        if len(data):
            starts, ends = words_of(data)
            if len(starts):
                h = word_hashes(data, starts, ends)
                lines = np.cumsum(data == 10)[starts]
                first = np.concatenate(([True], lines[1:] != lines[:-1]))
                # a word's pair is the word before it in its paragraph; a paragraph's first word stands alone
                prev = np.concatenate((np.zeros(1, np.uint64), h[:-1]))
                pair = _mix(h + np.where(first, np.uint64(0), prev * _ROOT))
                sign = np.where((pair >> np.uint64(63)) == 1, 1.0, -1.0)
                total = np.bincount((pair & np.uint64(LANES - 1)).astype(np.int64), weights=sign, minlength=LANES)
                lanes = total.astype(np.int64).astype(np.uint32)
        return cls(np.array([w & (2**64 - 1) for w in wide], dtype=np.uint64), lanes)

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.lanes - other.lanes)

    def add(self, paragraphs: bytes) -> Fingerprint:
        return self + Fingerprint.of(paragraphs)

    def remove(self, paragraphs: bytes) -> Fingerprint:
        return self - Fingerprint.of(paragraphs)

    def text(self) -> str:
        return base64.b64encode(self.wide.astype("<u8").tobytes() + self.lanes.astype("<u4").tobytes()).decode()

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the signed lanes, 0 if negative or if one has no words."""
        if (self.wide == other.wide).all() and (self.lanes == other.lanes).all():
            return 1.0
        a, b = self.lanes.astype(np.int32).astype(np.float64), other.lanes.astype(np.int32).astype(np.float64)
        scale = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / scale)) if scale else 0.0


def edited_text(text: str, after: str) -> str:
    """The last half of the code points, rounded down, replaced by the first as many (or all) of the text after it."""
    n = len(text) // 2
    return text[: len(text) - n] + after[:n]


def edited_fingerprint(whole: Fingerprint, text: str, edited: str) -> Fingerprint:
    """From whole, the fingerprint of text: takes out the paragraphs that the edit touches, puts in those it makes."""
    same = len(text) - len(text) // 2
    cut = text.rfind("\n", 0, same) + 1  # the paragraphs before it stay
    return whole.remove(text[cut:].encode()).add(edited[cut:].encode())


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...): one fingerprint a row (base64).

    Null texts are empty, and empty texts have the fingerprint of nothing, all zeros; repeated rows have equal fingerprints,
    each in a row of its own; null ids stay; an empty table gives no rows; other columns are not read. Texts of any length
    are read chunk by chunk.
    """
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([Fingerprint.of(t.as_py().encode()).text() for t in batch.column(1)], pa.string())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, "doc_id long, fingerprint string")


#: Bytes of text of one range of ids at most, on average: a range is sorted and read as a stream by one task.
RANGE_BYTES = 256 << 20
#: Cuts at quantiles; between two cuts ranges are equally wide. Partitions at most: beyond it a task streams several ranges.
CUTS, PARTITIONS = 512, 50_000
NULL_ID = -(2**63)


def with_edits(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """docs(doc_id, text, ...): the contract's columns of op8, for each row and the row after it.

    Order: doc_id (null first), then text; after the last row comes the first. A single row is its own next. Null texts are
    empty; repeated rows follow one another; an empty table gives no rows; other columns are not read.
    Ranges of ids follow the bytes of the table, at least sixteen a shuffle partition; the first row of a range also travels to
    the range before it.
    """
    spark = docs.sparkSession
    ship(spark)
    table = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = table.where(F.col("_id") != NULL_ID)
    stats = table.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if stats["rows"] == 0:
        return spark.createDataFrame([], schema)
    partitions = min(PARTITIONS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stats["bytes"] // range_bytes)))
    ranges = max(16 * partitions, -(-stats["bytes"] // range_bytes))
    coarse = min(CUTS, ranges)
    cuts = sorted(set(known.agg(F.percentile_approx("_id", [k / coarse for k in range(coarse + 1)], 10 * coarse).alias("q")).first()["q"] or []))
    # equal ids never part: a range is an interval of ids
    placed = table.withColumn("_b", _bucket(cuts, -(-ranges // coarse)))
    firsts = placed.groupBy("_b").agg(F.min("_id").alias("_id"))  # a row for each range: bounded by the bytes
    order = Window.orderBy("_b")
    firsts = stored(firsts.select("_id", F.coalesce(F.lag("_b").over(order), F.last("_b").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to")), "firsts")
    lead = table.join(small_side(firsts), "_id").groupBy("_id", "_to").agg(F.min("text").alias("text"))
    both = placed.select("_b", "_id", "text", F.lit(0).alias("_tail")).unionByName(lead.select(F.col("_to").alias("_b"), "_id", "text", F.lit(1).alias("_tail")))
    dealt = both.repartition(partitions, "_b").sortWithinPartitions("_b", "_tail", "_id", "text")
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, with its fingerprint

        def close(row, after, print_after) -> tuple:
            ident, text, own = row[1], row[2], row[3]
            new = edited_text(text, after)
            sketch = edited_fingerprint(own, text, new)
            return (None if ident == NULL_ID else ident, len(text), hashlib.sha256(new.encode()).hexdigest(), own.text(), sketch.text(), own.likeness(sketch), own.likeness(print_after))

        for batch in (part for whole in batches for part in batches_of_bytes(whole, 500)):
            done = []
            for b, ident, text, tail in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                text = text.as_py()
                own = Fingerprint.of(text.encode())
                if held is not None:
                    done.append(close(held, text, own))
                held = None if tail else (b, ident, text, own)
            if done:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), out_schema, strict=True)], schema=out_schema)

    return dealt.mapInArrow(work, schema)


def _bucket(cuts: list[int], fine: int):
    """The interval between cuts that _id lies in, by a balanced tree of comparisons, and the equally wide part of it."""
    def tree(lo: int, hi: int):
        if hi - lo <= 1:
            width = max(1, -(-(cuts[lo + 1] - cuts[lo]) // fine)) if 0 <= lo < len(cuts) - 1 else None
            base = F.lit((lo + 1) * fine).cast("long")
            return base if width is None else base + F.floor((F.col("_id") - F.lit(cuts[lo])) / F.lit(width))
        mid = (lo + hi) // 2
        return F.when(F.col("_id") < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid, hi))

    return tree(-1, len(cuts))


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    """All documents, in order of their ids."""
    tune(spark)
    return with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
