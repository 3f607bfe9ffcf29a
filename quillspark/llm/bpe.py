"""Byte-level BPE encoding and decoding, with a segment tree over byte positions.

Leaf i of the tree holds the rank of the pair that starts at the live byte position i (or none) with that position; inner
nodes hold the smallest below them, the left one on ties. A merge takes the leftmost minimum at the root, joins two live
neighbours and updates the three leaves that changed, in logarithmic time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import ship, tune

#: Distinct matches of a generation of a worker's memo. A full generation becomes the old one, of which what is used again is
#: kept: at most two generations, about 120 MB, are remembered.
MEMO = 250_000
#: Longer matches are encoded each time: they rarely repeat and would fill the memo.
MEMO_CHARS = 64

NONE = 1 << 80


def load_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file's lines: base64 of a token's bytes, blank, rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: lowest rank first, leftmost on ties."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    bits = (n - 1).bit_length()
    size = 1 << bits
    end = list(range(1, n + 1))  # end[i]: where the live token that starts at i stops; also its right neighbour's start
    left = list(range(-1, n - 1))
    # a node holds rank * size + position of its smallest pair: the smaller key is the lower rank, then the leftmost
    tree = [NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << bits | i
    for v in range(size - 1, 0, -1):
        x, y = tree[2 * v], tree[2 * v + 1]
        tree[v] = x if x < y else y
    mask = size - 1
    while (low := tree[1]) != NONE:
        i = low & mask
        j = end[i]
        stop = end[j]
        end[i] = stop
        before = left[i]
        rank = None
        if stop < n:
            left[stop] = i
            rank = get(piece[i : end[stop]])
        b, c = size + i, size + j
        tree[c] = NONE
        tree[b] = NONE if rank is None else rank << bits | i
        if before >= 0:
            a = size + before
            rank = get(piece[before:stop])
            tree[a] = NONE if rank is None else rank << bits | before
        else:
            a = b
        # the three leaves' paths, level by level, each shared ancestor once
        while c > 1:
            a >>= 1
            b >>= 1
            c >>= 1
            x, y = tree[2 * c], tree[2 * c + 1]
            tree[c] = x if x < y else y
            if b != c:
                x, y = tree[2 * b], tree[2 * b + 1]
                tree[b] = x if x < y else y
            if a != b:
                x, y = tree[2 * a], tree[2 * a + 1]
                tree[a] = x if x < y else y
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class PairTable:
    """Ranks of pairs of tokens, looked up for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.width = max(ranks.values(), default=0) + 1
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    values.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys = np.concatenate([np.array(keys, dtype=np.int64)[order], [np.iinfo(np.int64).max]])
        self.values = np.concatenate([np.array(values, dtype=np.int64)[order], [-1]])
        self.bytes = np.array([ranks.get(bytes([k]), -1) for k in range(256)], dtype=np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each joined pair, -1 where there is none."""
        key = a * self.width + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)


def encode_pieces(pieces: list[bytes], table: PairTable) -> list[bytes]:
    """encode_piece() of many matches of like length at once: their segment trees are the rows of one array.

    Each round takes every row's root, merges one pair in each row that has one, and updates three leaves' paths.
    """
    n = np.array([len(p) for p in pieces])
    bits = int(n.max() - 1).bit_length() if len(n) else 0
    size, rows = 1 << bits, len(pieces)
    big = np.int64(1) << np.int64(60)
    tok = np.zeros((rows, size + 2), dtype=np.int64)
    inside = np.arange(size + 2)[None, :] < n[:, None]
    tok[inside] = table.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    live = inside.copy()
    end = np.tile(np.arange(1, size + 3, dtype=np.int64), (rows, 1))
    left = np.tile(np.arange(-1, size + 1, dtype=np.int64), (rows, 1))
    tree = np.full((rows, 2 * size), big, dtype=np.int64)
    if size > 1:
        rank = table.find(tok[:, :size], tok[:, 1 : size + 1])
        paired = inside[:, 1 : size + 1] & (rank >= 0)
        tree[:, size:] = np.where(paired, rank << bits | np.arange(size)[None, :], big)
        for v in range(bits - 1, -1, -1):
            lo = 1 << v
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
    r = np.flatnonzero(tree[:, 1] < big) if size > 1 else np.zeros(0, np.int64)
    while len(r):
        low = tree[r, 1]
        i, merged = low & (size - 1), low >> bits
        j = end[r, i]
        stop = end[r, j]
        end[r, i], tok[r, i], live[r, j], left[r, stop] = stop, merged, False, i
        before = left[r, i]
        right = np.where(stop < n[r], table.find(merged, tok[r, stop]), -1)
        prior = np.where(before >= 0, table.find(tok[r, before], merged), -1)
        tree[r, size + j] = big
        tree[r, size + i] = np.where(right >= 0, right << bits | i, big)
        has = before >= 0
        tree[r[has], size + before[has]] = np.where(prior >= 0, prior << bits | before, big)[has]
        paths = [size + np.where(has, before, i), size + i, size + j]
        for _ in range(bits):
            paths = [p >> 1 for p in paths]
            for p in paths:
                tree[r, p] = np.minimum(tree[r, 2 * p], tree[r, 2 * p + 1])
        r = r[tree[r, 1] < big]
    flat = tok[live].astype("<u4").tobytes()
    stops = np.cumsum(live.sum(axis=1)) * 4
    return [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


class Codec:
    """A rank file and a pattern, with a bounded memo of the ids of short matches."""

    def __init__(self, data: bytes, pattern: str, memo: int = MEMO) -> None:
        import regex

        self.ranks = load_ranks(data)
        self.pairs = PairTable(self.ranks)
        self.find = regex.compile(pattern).findall
        self.table = {v: k for k, v in self.ranks.items()}
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit = memo

    def _learn(self, fresh: set[str]) -> dict[str, bytes]:
        """Ids of matches that the young memo lacks: from the old one, or encoded in groups of like length."""
        out, groups = {}, {}
        for m in fresh:
            ids = self.old.get(m)
            if ids is None:
                piece = m.encode()
                whole = self.ranks.get(piece)
                if whole is not None:
                    ids = whole.to_bytes(4, "little")
                elif len(piece) > 128:
                    ids = np.array(encode_piece(piece, self.ranks), dtype="<u4").tobytes()
                else:
                    groups.setdefault((len(piece) - 1).bit_length(), []).append((m, piece))
                    continue
            out[m] = ids
        for group in groups.values():
            for k in range(0, len(group), 8192):
                part = group[k : k + 8192]
                out.update(zip((m for m, _ in part), encode_pieces([p for _, p in part], self.pairs), strict=True))
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        found = [self.find(t) for t in texts]
        memo = self.memo
        fresh = {m for m in set().union(*found) if m not in memo and m}
        learnt = self._learn(fresh)
        once = {m: ids for m, ids in learnt.items() if len(m) > MEMO_CHARS}
        if len(self.memo) + len(learnt) - len(once) > self.limit:
            self.old, self.memo = self.memo, {}
            learnt |= self._learn({m for m in set().union(*found) if m not in learnt and m})
        self.memo.update((m, ids) for m, ids in learnt.items() if len(m) <= MEMO_CHARS)
        get = self.memo.__getitem__ if not once else lambda m: self.memo.get(m) or once[m]
        return [b"".join(map(get, f)) for f in found]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_codecs: dict[tuple[int, int, str], Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    key = (len(data), hash(data), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def _portions(batches: Iterator[pa.RecordBatch], size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about `size` bytes of text: what is held at once doesn't depend on rows or lengths."""
    for batch in batches:
        lengths = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) if batch.num_rows else []
        start = 0
        while start < batch.num_rows:
            done = lengths[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(lengths, done + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def encoded(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """docs(doc_id, text, ...): doc_id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, ids array<int>.

    Null and empty texts have no ids; whole texts are encoded; special strings are ordinary text; repeated rows are encoded
    each; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: its size is fixed
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(data.value, pattern)
        for batch in _portions(batches):
            counts, shas, back, lists = [], [], [], []
            for ids in c.encode_batch(batch.column(1).to_pylist()):
                counts.append(len(ids) // 4)
                shas.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(c.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(np.frombuffer(ids, dtype="<i4"))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]
            yield pa.record_batch(columns + [pa.array(lists, pa.list_(pa.int32()))] * with_ids, schema=schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return source.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """byte_bpe_50k over all documents, encoded and decoded."""
    import public_tokenizers

    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)
