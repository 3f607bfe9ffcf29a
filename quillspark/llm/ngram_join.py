"""N-gram Jaccard join: a chosen-path join over sets of five-word shingles.

Every set is embedded as 128 tokens (position, minimum hash). A run starts at one root; a node splits a set's way into the
children of those tokens that the node's hash function samples, 1/similarity of them on average, so that similar sets keep
meeting in some child while others part. Nodes with few sets are compared outright. A crowded node is split again by tokens
that are not common in it: what its sets share (a hot passage, the body of a near copy) parts nobody, what is a set's own
does at once. Sets that mostly agree with the node's common tokens are linked to each other besides. Runs repeat until the
target recall.

Compared sets whose minima agree nearly often enough are joined to loose groups, inside which exact similarities decide
(see group_links), so that links are exact and no pairs are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of_bytes, drop_stored, packed, ship, small_side, stored, tune, without_rows
from quillspark.llm.fingerprint import _mix, word_hashes, words_of
from quillspark.llm.group_links import BLOCK_SETS, group_links
from quillspark.llm.grouping import linked_groups, sorted_groups, whole_groups

WORDS, SIMILARITY = 5, 0.8
TOKENS = 128
#: Probability with which a pair at the threshold should meet in a node at least, splits included.
RECALL = 0.999
#: Sets that a node may hold to be compared outright, and the splits after which all pairs of a crowded node's blocks are compared.
NODE, DEPTH = 800, 6
#: Children that a pair at the threshold shares on average where a crowded node splits.
SHARED = 3
#: A value that this share of a crowded node's sample has at a position is common there; sets of a sample.
COMMON, SAMPLE = 0.25, 256
#: Share of agreeing minima from which sets join a loose group: four standard deviations below the threshold.
LOOSE = SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / TOKENS) ** 0.5
NULL_ID = -(2**63)

_rng = np.random.default_rng(20240229)
_MUL = (_rng.integers(0, 2**31, TOKENS, dtype=np.uint32) * 2 + 1)[:, None]
_ADD = _rng.integers(0, 2**32, TOKENS, dtype=np.uint32)[:, None]


#: Bytes of words: ASCII letters and digits, and all bytes of other signs.
_WORDY = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def shingles(text: str) -> np.ndarray:
    """Distinct 32-bit hashes of the runs of five words; fewer words make one shingle, none make none.

    Words are runs of letters, digits and signs beyond ASCII, in lower case, so that an edit which moves a sentence's end
    doesn't change its neighbours; a text with no such word is read as runs of signs other than white space.
    """
    data = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint32)
    edge = np.diff(np.concatenate(([False], _WORDY[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = word_hashes(data, *((starts, ends) if len(starts) else words_of(data)))
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint32)
    k = min(WORDS, n)
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[j : n - k + 1 + j] + np.uint64(k))
    return np.unique((total >> np.uint64(32)).astype(np.uint32))


def minima(sh: np.ndarray) -> np.ndarray:
    """128 minimum hashes of a set."""
    out = np.full(TOKENS, 2**32 - 1, np.uint32)
    for lo in range(0, len(sh), 4096):
        part = sh[None, lo : lo + 4096] * _MUL + _ADD
        # the low bits of a product are weak: mix them before comparing
        part ^= part >> np.uint32(15)
        np.minimum(out, (part * np.uint32(0x2C1B3C6D)).min(axis=1), out=out)
    return out


def runs_for(recall: float = RECALL, splits: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with this probability, if nodes split so often on its way.

    The children that a pair shares are Poisson, 1 on average at a root and SHARED at a crowded node: it gets through one
    split with probability 1 - exp(-SHARED), through two with 1 - exp(-SHARED (1 - exp(-SHARED))), and so on.
    """
    met = 1.0
    for _ in range(splits):
        met = 1 - np.exp(-SHARED * met)
    return int(np.ceil(np.log(1 / (1 - recall)) / met))


def _draws(node: np.ndarray, minimum: np.ndarray) -> np.ndarray:
    """For each set at its node, and each token, a hash of both (64 bits)."""
    place = (np.arange(TOKENS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return _mix(_mix(node[:, None] + place[None, :]) ^ (minimum.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))


def _named(h: np.ndarray, chosen: np.ndarray) -> list[np.ndarray]:
    return [(_mix(h[i][chosen[i]]) >> np.uint64(1)).astype(np.int64) for i in range(len(h))]


def children(node: np.ndarray, minimum: np.ndarray) -> list[np.ndarray]:
    """node (n,), minimum (n, 128): for each set the ids of the children that its tokens choose at its root."""
    h = _draws(node, minimum)
    return _named(h, (h >> np.uint64(32)) < np.uint64(int(2**32 / (SIMILARITY * TOKENS))))


def own_children(node: np.ndarray, minimum: np.ndarray, common: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """node (n,), minimum and common (n, 128), common -1 where a position has no common value: for each set the children that
    its uncommon tokens choose, and how many of its tokens are common.

    A pair at the threshold agrees at 0.8 x 128 positions, at min(h, h') common ones at most: it shares 0.8 x 128 - min(h, h')
    uncommon tokens at least, of which SHARED are chosen on average.
    """
    own = minimum != common
    h = TOKENS - own.sum(1)
    rate = np.minimum(1.0, SHARED / np.maximum(SIMILARITY * TOKENS - h, (SIMILARITY - LOOSE) * TOKENS))
    draw = _draws(node, minimum)
    chosen = own & ((draw >> np.uint64(32)) < (rate * 2.0**32).astype(np.uint64)[:, None])
    return _named(draw, chosen), h


def _roots(runs: int) -> np.ndarray:
    return _mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def embedded(docs: DataFrame, runs: int) -> DataFrame:
    """docs -> row (unique), doc_id, sha (of the text), digest (of the set), n, minimum, nodes and shingles as bytes."""
    ship(docs.sparkSession)
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.binary()), ("digest", pa.binary()), ("n", pa.int64()), ("minimum", pa.binary()), ("nodes", pa.list_(pa.int64())), ("shingles", pa.binary())]
    schema = pa.schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, roots = TaskContext.get().partitionId() << 33, _roots(runs)
        for batch in batches:
            for part in batches_of_bytes(batch, 128):
                out = {"digest": [], "n": [], "minimum": [], "nodes": [], "shingles": []}
                for text in part.column(2):
                    sh = shingles(text.as_py())
                    low = minima(sh)
                    raw = sh.tobytes()
                    nodes = [c for i in range(runs) for c in children(roots[i : i + 1], low[None])[0].tolist()] if len(sh) else []
                    out["digest"].append(hashlib.blake2b(raw, digest_size=16).digest())
                    out["n"].append(len(sh))
                    out["minimum"].append(low.astype(np.uint16).tobytes())
                    out["nodes"].append(sorted(set(nodes)))
                    out["shingles"].append(raw)
                rows = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.record_batch([rows, part.column(0), part.column(1), *[pa.array(out[n], t) for n, t in fields[3:]]], schema=schema)

    text = F.coalesce("text", F.lit(""))
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))
    return source.mapInArrow(work, "row long, doc_id long, sha binary, digest binary, n long, minimum binary, nodes array<long>, shingles binary")


def loose_edges(met: DataFrame) -> DataFrame:
    """met(node, row, minimum): stars (row, root) of the loose groups in each node.

    A byte of each minimum travels: of the minima that differ 1 in 256 agree by chance, half a position of 128.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for t in whole_groups(batches):
            if t.num_rows > 1:
                rows = t.column("row").to_numpy()
                low = np.frombuffer(b"".join(t.column("minimum").to_pylist()), dtype=np.uint8).reshape(-1, TOKENS)
                for g in linked_groups(len(rows), lambda i, rest: (low[rest] == low[i]).sum(1) >= LOOSE * TOKENS):  # noqa: B023
                    if len(g) > 1:
                        root = rows[g].min()
                        own = rows[g][rows[g] != root]
                        us += own.tolist()
                        vs += [root] * len(own)
            if len(us) > 50_000:
                yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=schema)
                us, vs = [], []
        yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=schema)

    return sorted_groups(_bytes_of(met), "node").mapInArrow(work, "u long, v long")


def _bytes_of(met: DataFrame) -> DataFrame:
    """met(node, row, minimum) with the low byte of each minimum."""
    schema = pa.schema([("node", pa.int64()), ("row", pa.int64()), ("minimum", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = np.frombuffer(b"".join(batch.column("minimum").to_pylist()), dtype="<u2").astype(np.uint8).reshape(-1, TOKENS)
            yield pa.record_batch([batch.column("node"), batch.column("row"), pa.array([x.tobytes() for x in low], pa.binary())], schema=schema)

    return met.select("node", "row", "minimum").mapInArrow(work, "node long, row long, minimum binary")


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, root), root the smallest node of its component: alternating large and small stars, until nothing
    changes (a logarithmic number of rounds)."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seal = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    was = seal(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # smallest neighbours are written, so that both sides of the join are plain exchanges, of which a hub's can be split
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cclow")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "ccl")
        low2 = stored(large.groupBy("u").agg(F.min("v").alias("m")), "cclow")
        small = large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v"))).where("u <> v")
        new = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
        for t in (large, now, low, low2):
            drop_stored(t)
        now, seen = new, seal(new)
        if seen == was:
            break
        was = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def common_values(crowded: DataFrame) -> DataFrame:
    """crowded(node, c, row, minimum) -> (node, common): the most frequent value at each of the 128 positions where a share of
    COMMON of a sample of the node's sets has it, -1 elsewhere. A sample is SAMPLE sets on average; whatever it holds, the
    splits stay right: it only decides how fast a node empties."""
    schema = pa.schema([("node", pa.int64()), ("common", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, found = [], []
        for t in whole_groups(batches):
            low = np.sort(np.frombuffer(b"".join(t.column("minimum").to_pylist()), dtype="<u2").reshape(-1, TOKENS), axis=0)
            common = np.full(TOKENS, -1, np.int32)
            need = max(1, int(np.ceil(COMMON * len(low))))
            # a value that `need` sorted entries in a row hold is frequent; the longest such run wins
            for i in range(TOKENS):
                edges = np.flatnonzero(np.concatenate(([True], low[1:, i] != low[:-1, i], [True])))
                sizes = np.diff(edges)
                top = int(sizes.argmax())
                if sizes[top] >= need:
                    common[i] = low[edges[top], i]
            nodes.append(t.column("node")[0].as_py())
            found.append(common.tobytes())
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], schema=schema)

    sample = crowded.where(F.pmod(F.xxhash64("node", "row"), F.col("c")) < SAMPLE).select("node", "minimum")
    return sorted_groups(sample, "node").mapInArrow(work, "node long, common binary")


def _split(crowded: DataFrame) -> DataFrame:
    """crowded(node, row, minimum, common) -> (node, row, alike): a row for each chosen child, and one for its own node where
    the set agrees with the node's common values as often as a loose group asks."""
    schema = pa.schema([("node", pa.int64()), ("row", pa.int64()), ("alike", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, rows = batch.column("node").to_numpy(), batch.column("row").to_numpy()
            low = np.frombuffer(b"".join(batch.column("minimum").to_pylist()), dtype="<u2").reshape(-1, TOKENS)
            common = np.frombuffer(b"".join(batch.column("common").to_pylist()), dtype="<i4").reshape(-1, TOKENS)
            found, h = own_children(nodes.astype(np.uint64) + np.uint64(0x51ED), low, common)
            near = h >= LOOSE * TOKENS
            to = np.concatenate([*found, nodes[near]]) if len(nodes) else np.zeros(0, np.int64)
            own = np.concatenate([np.repeat(rows, [len(f) for f in found]), rows[near]])
            flag = np.arange(len(to)) >= len(to) - int(near.sum())
            yield pa.record_batch([pa.array(to, pa.int64()), pa.array(own, pa.int64()), pa.array(flag)], schema=schema)

    return crowded.select("node", "row", "minimum", "common").mapInArrow(work, "node long, row long, alike boolean")


def met_sets(reps: DataFrame, node_limit: int = NODE, depth: int = DEPTH) -> tuple[DataFrame, DataFrame | None, int]:
    """reps(row, minimum, nodes): (node, row), nodes of at least two and at most about node_limit sets; stars (u, v) of the
    sets that agree with a crowded node's common values, if any; the splits that occurred.

    No pair is lost but by a split's sampling, which runs_for() accounts for: nodes that are crowded after `depth` splits are
    dealt into blocks, and all pairs of blocks are compared.
    """
    level = stored(reps.select("row", F.explode("nodes").alias("node")), "level")
    parts, stars, used = [], None, []
    for d in range(depth + 1):
        used.append(level)
        counts = stored(level.groupBy("node").agg(F.count("*").alias("c")).where("c > 1"), "counts")
        used.append(counts)
        few, many = counts.where(F.col("c") <= node_limit).select("node"), counts.where(F.col("c") > node_limit)
        parts.append(level.join(few, "node").select("node", "row"))
        if not many.limit(1).count():
            break
        if d == depth:
            halves = F.ceil(2 * F.col("c") / node_limit)
            pairs = level.join(many, "node").withColumn("b", F.pmod(F.xxhash64("node", "row"), halves)).withColumn("x", F.explode(F.sequence(F.lit(0), halves - 1))).where("b <> x")
            parts.append(pairs.select(F.shiftrightunsigned(F.xxhash64("node", F.least("b", "x"), F.greatest("b", "x")), 1).alias("node"), "row"))
            break
        entries = stored(level.join(small_side(many), "node"), "entries")
        crowded = stored(entries.join(_minima_of(reps, entries), "row").select("node", "c", "row", "minimum"), "crowded")
        drop_stored(entries)
        common = stored(common_values(crowded), "common")
        split = stored(_split(crowded.join(small_side(common), "node")), "split")
        drop_stored(crowded)
        used += [common, split]
        near = split.where("alike")
        roots = stored(near.groupBy("node").agg(F.min("row").alias("root")), "roots")
        used.append(roots)
        found = near.join(small_side(roots), "node").select(F.col("row").alias("u"), F.col("root").alias("v")).where("u <> v")
        stars = found if stars is None else stars.unionByName(found)
        level = split.where("not alike").select("row", "node")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    met, stars = stored(out, "met"), None if stars is None else stored(stars.distinct(), "stars")
    for t in used:
        drop_stored(t)
    return _once(met), stars, d


def _once(met: DataFrame) -> DataFrame:
    """met(node, row) without the nodes whose sets are those of another node, which runs that repeat a meeting make. Sets are
    told apart by two 64-bit sums of their hashes."""
    marks = [F.bit_xor(F.xxhash64("row", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    nodes = met.groupBy("node").agg(F.count("*").alias("c"), *marks)
    kept = stored(nodes.groupBy("c", "x1", "x2").agg(F.min("node").alias("node")).select("node"), "once")
    out = stored(met.join(small_side(kept), "node", "left_semi"), "metonce")
    drop_stored(met)
    drop_stored(kept)
    return out


def _minima_of(reps: DataFrame, rows: DataFrame) -> DataFrame:
    """reps(row, minimum) of the rows that rows(row) names: the others' minima need not travel to a join."""
    return reps.select("row", "minimum").join(small_side(stored(rows.select("row").distinct(), "rows")), "row", "left_semi")


def classes(docs: DataFrame, recall: float = RECALL, node_limit: int = NODE, depth: int = DEPTH, block_sets: int = BLOCK_SETS) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, text, ...): the stored table of sets, and one row for each of docs: row, _id, _class (smallest id of the
    class), kept (first row of the class), _links, _size.

    Words are those of shingles(). Null texts are empty; texts without words are alone;
    texts of fewer than five words are one shingle; equal sets (copies) are one node of the graph and count as linked.
    """
    runs = runs_for(recall, depth)
    table = stored(embedded(docs, runs), "sets")
    narrow = table.select("row", "doc_id", "digest", "n")
    firsts = stored(narrow.where("n > 0").groupBy("digest").agg(F.min("row").alias("rep"), F.count("*").alias("copies")), "firsts")
    # rows that are not the first of their set stay out of the join; they follow their first
    owned = stored(narrow.join(firsts, "digest", "left").select("row", "doc_id", F.coalesce("rep", "row").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies")), "owned")
    later = stored(owned.where("row <> rep").select("row"), "later")
    reps = stored(table.where("n > 0").select("row", "minimum", "nodes").join(small_side(later), "row", "left_anti"), "reps")
    met, stars, _ = met_sets(reps, node_limit, depth)
    edges = loose_edges(met.join(_minima_of(reps, met), "row"))
    loose = components(edges if stars is None else edges.unionByName(stars))
    member = loose.select(F.col("node").alias("row"), F.col("root").alias("comp")).unionByName(loose.select(F.col("root").alias("row"), F.col("root").alias("comp")).distinct())
    member = stored(member, "member")
    for t in (met, reps, stars):
        drop_stored(t)
    counted = stored(member.join(owned.select("row", "copies"), "row"), "counted")  # narrow, so that shingles meet one join only
    sized = stored(table.select("row", "n", "shingles").join(small_side(counted), "row"), "sized")
    partial = group_links(sized, block_sets)
    stars = components(partial.where("row <> root").select(F.col("row").alias("u"), F.col("root").alias("v")).distinct())
    links = partial.groupBy("row").agg(F.sum("links").alias("links"))
    answer = stored(links.join(stars.select(F.col("node").alias("row"), "root"), "row", "left").select(F.col("row").alias("rep"), "links", F.coalesce("root", "row").alias("root")), "answer")
    drop_stored(sized)
    drop_stored(partial)
    joined = owned.join(small_side(answer), "rep", "left").select("row", "doc_id", F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    joined = stored(joined, "joined")
    for t in (firsts, owned, later, answer, member, counted):
        drop_stored(t)
    several = joined.where("links > 0")  # a class of one row has no links
    heads = stored(several.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("head"), F.count("*").alias("size")), "heads")
    out = joined.join(small_side(heads), "root", "left")
    head = F.coalesce("head", F.struct("doc_id", "row"))
    return table, out.select("row", F.col("doc_id").alias("_id"), head["doc_id"].alias("_class"), (head["row"] == F.col("row")).alias("kept"), F.col("links").alias("_links"), F.coalesce("size", F.lit(1)).alias("_size"))


def join(docs: DataFrame, recall: float = RECALL, node_limit: int = NODE, depth: int = DEPTH, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (smallest doc_id of its class), n_links (other rows at or above the
    similarity), class_size, kept (one row a class). Classes are connected groups of links. See classes() for odd rows."""
    _, out = classes(docs, recall, node_limit, depth, block_sets)
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(back("_id").alias("doc_id"), back("_class").alias("class_id"), F.col("_links").cast("long").alias("n_links"), F.col("_size").cast("long").alias("class_size"), "kept")


def distinct_documents(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """The rows of docs of which one a class stays, with its columns."""
    table, out = classes(docs, recall)
    rows = stored(out.select("row", "_id", "kept").join(table.select("row", F.lower(F.hex("sha")).alias("_sha")), "row").select("_id", "_sha", "kept"), "nearrows")
    drop_stored(table)
    keyed = packed(docs, _id=F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), _sha=F.sha2(F.coalesce("text", F.lit("")), 256))
    return without_rows(keyed, rows)


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    tune(spark)
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
