"""Quality classifier: a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote on every document (good, junk or abstain). Expectation-maximisation over the counts
of all vote patterns of the corpus estimates each labeller's accuracy; the posteriors label a bounded sample, on which a
logistic scorer over hashed word shapes and line statistics is trained. The scorer decides on every document.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import ship, stored, tune, unused

#: Word-shape buckets of the scorer, and documents it is trained on at most (those with the smallest digests).
BUCKETS, TRAIN = 1024, 6000
#: Documents whose probability of being good is below this are rejected.
THRESHOLD = 0.5

_SHAPE = bytes(ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("9") if 48 <= b <= 57 else b for b in range(256))
#: Frequent function words of English, German, French and Spanish (fixed values).
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that for it was on are as with be at by this from or an not have which "
    b"der die und das den von zu mit ist im auf ein eine dem nicht des als auch es an "
    b"de la le et les des un une du en que dans qui par pour est sur au il pas "
    b"el los las y del se con por una su para al lo como o".split()
)
LABELLERS = ("symbols", "shouting", "table", "stutter", "cycle", "function", "length")
STATS = 8


def _vote(x: float, good: float, junk: float) -> int:
    """1 (good) at or below `good`, 0 (junk) at or above `junk`, else -1."""
    return 1 if x <= good else 0 if x >= junk else -1


def describe(text: str) -> tuple[list[int], dict[int, float], list[float]]:
    """Votes, hashed shape counts and statistics of a text, in a few passes of native bytes operations."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    shapes = Counter(raw.translate(_SHAPE).split())
    hashed: dict[int, float] = {}
    symbol = shout = bars = 0
    for s, c in shapes.items():
        body = s.rstrip(b"#*%&$!~^=_<>@")
        tail = len(s) - len(body)
        if tail >= 2:
            symbol += c
        if s == b"|":
            bars += c
        letters = body.rstrip(b".,;:")
        if len(letters) > 1 and b"x" not in letters and letters.count(b"X") * 2 > len(letters):
            shout += c
        key = squeeze(s)
        k = zlib.crc32(key) % BUCKETS
        hashed[k] = hashed.get(k, 0.0) + c
    m = max(1, n)
    distinct = Counter(words)
    stutter = sum(map(bytes.__eq__, words[1:], words[:-1])) / m
    cycle = 1 - len(distinct) / m if n >= 40 else 0.0
    function = sum(c for w, c in distinct.items() if w in FUNCTION_WORDS) / m
    length = len(raw) / m
    lines = raw.split(b"\n")
    worst = max((_line(x) for x in lines), default=0.0)
    votes = [
        _vote(symbol / m, 0.01, 0.10),
        _vote(shout / m, 0.05, 0.15),
        _vote(bars / m, 0.0, 0.08),
        _vote(stutter, 0.05, 0.20),
        _vote(cycle, 0.75, 0.93) if n >= 40 else -1,
        -1 if n < 20 else 1 if function >= 0.12 else 0 if function < 0.03 else -1,
        _vote(length, 12.0, 40.0) if n else 0,
    ]
    stats = [symbol / m, shout / m, min(1.0, 4 * bars / m), stutter, cycle, function, min(1.0, length / 40), worst]
    return votes, hashed, stats


def squeeze(shape: bytes) -> bytes:
    """A shape with runs of one sign cut to two: words of any length share a shape."""
    out = bytearray()
    for b in shape[:64]:
        if len(out) < 2 or out[-1] != b or out[-2] != b:
            out.append(b)
    return bytes(out)


def _line(line: bytes) -> float:
    """The share of signs other than letters, digits, spaces and plain punctuation in a line of some length."""
    if len(line) < 24:
        return 0.0
    return 1 - len(line.translate(None, b"#*%&$!|~^=_<>@")) / len(line)


def features(described: list[tuple]) -> np.ndarray:
    """Dense rows: square roots of relative shape frequencies, statistics, bias."""
    x = np.zeros((len(described), BUCKETS + STATS + 1), dtype=np.float32)
    for i, (_, hashed, stats) in enumerate(described):
        total = sum(hashed.values()) or 1.0
        if hashed:
            x[i, list(hashed)] = np.sqrt(np.array(list(hashed.values())) / total)
        x[i, BUCKETS : BUCKETS + STATS] = stats
    x[:, -1] = 1
    return x


def pattern_code(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = 3 * code + v + 1
    return code


def decode(codes: np.ndarray) -> np.ndarray:
    return np.stack([(np.asarray(codes, dtype=np.int64) // 3 ** (len(LABELLERS) - 1 - j)) % 3 - 1 for j in range(len(LABELLERS))], axis=1)


def accuracies(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation: prior of good, P(good vote | class, not abstaining) as (2, labellers), posteriors of good.

    A junk vote is rare and specific, a good vote common: the start counts a document as junk if any labeller says so.
    """
    cast = votes >= 0
    post = np.where((votes == 0).any(1), 0.1, 0.9)
    prior, good = 0.5, np.empty((2, votes.shape[1]))
    for _ in range(rounds):
        prior = float((counts * post).sum() + 1) / float(counts.sum() + 2)
        for c, p in ((0, 1 - post), (1, post)):
            w = (counts * p)[:, None]
            good[c] = ((w * (votes == 1)).sum(0) + (2 if c else 1)) / ((w * cast).sum(0) + 3)
        log = [np.log(prior if c else 1 - prior) + np.where(votes == 1, np.log(good[c]), np.where(cast, np.log(1 - good[c]), 0)).sum(1) for c in (0, 1)]
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return prior, good, post


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels, both classes of like weight; scaled gradient steps over the whole sample."""
    w, g2 = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    weight = np.where(y >= 0.5, 0.5 / max(1e-9, (y >= 0.5).mean()), 0.5 / max(1e-9, (y < 0.5).mean())) if len(y) else y
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) / len(y) + decay * w
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
    return w


def fit(docs: DataFrame, sample: int = TRAIN) -> dict:
    """Votes of all documents, accuracies by EM, and the scorer's weights; what reaches the driver is bounded."""
    ship(docs.sparkSession)
    schema = pa.schema([("h", pa.int64()), ("code", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            codes = [pattern_code(describe(t.as_py())[0]) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(codes, pa.int32())], schema=schema)

    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("string"), text).alias("h"), text.alias("text"))
    voted = stored(keyed.mapInArrow(work, "h long, code int"), "votes")
    patterns = voted.groupBy("code").count().orderBy("code").collect()  # at most 3^labellers rows
    if not patterns:
        return {"weights": np.zeros(BUCKETS + STATS + 1), "prior": 0.5, "accuracy": {}}
    prior, good, post = accuracies(decode([r["code"] for r in patterns]), np.array([r["count"] for r in patterns], dtype=float))
    posterior = {r["code"]: float(p) for r, p in zip(patterns, post, strict=True)}
    # the documents with the smallest digests: half of them overall, half among the rarer class
    junk = [c for c, p in posterior.items() if p < 0.5]
    bound = lambda df, k: [r["h"] for r in df.select("h").distinct().orderBy("h").limit(k).collect()]
    wanted = set(bound(voted, sample // 2)) | set(bound(voted.where(F.col("code").isin(junk)), sample // 2)) if junk else set(bound(voted, sample // 2))
    # whole texts are described where they lie; only bounded feature rows reach the driver
    wide = docs.sparkSession.sparkContext.broadcast(wanted)

    def describe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [i for i, h in enumerate(batch.column(0).to_pylist()) if h in wide.value]
            if keep:
                found = [describe(batch.column(1)[i].as_py()) for i in keep]
                yield pa.record_batch([pa.array([batch.column(0)[i].as_py() for i in keep], pa.int64()), pa.array([pattern_code(d[0]) for d in found], pa.int32()), pa.array([list(d[1]) for d in found], pa.list_(pa.int32())), pa.array([list(d[1].values()) for d in found], pa.list_(pa.float64())), pa.array([d[2] for d in found], pa.list_(pa.float64()))], names=["h", "code", "k", "v", "s"])

    rows = keyed.mapInArrow(describe_rows, "h long, code int, k array<int>, v array<double>, s array<double>").groupBy("h").agg(F.first("code").alias("code"), F.first("k").alias("k"), F.first("v").alias("v"), F.first("s").alias("s")).orderBy("h").limit(sample).collect()
    x = features([(None, dict(zip(r["k"], r["v"], strict=True)), r["s"]) for r in rows])
    w = train(x, np.array([posterior[r["code"]] for r in rows]))
    return {"weights": w, "prior": prior, "accuracy": {n: good[:, j].tolist() for j, n in enumerate(LABELLERS)}}


def scored(docs: DataFrame, model: dict, name: str = "p_good") -> DataFrame:
    """docs with a column `name`, the probability that a document is good. Null texts are empty texts."""
    ship(docs.sparkSession)
    weights = model["weights"]

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(texts), 256):
            x = features([describe(t or "") for t in texts.iloc[start : start + 256]])
            out.append(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(name, score(F.coalesce("text", F.lit(""))))


def classify(docs: DataFrame, sample: int = TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """docs with p_good and good. Fitted on all documents' votes; empty texts get what the scorer says of them; ties at the
    threshold are good; repeated rows are scored each; an empty table stays empty; other columns pass
    through, but for those of the result's own names."""
    return scored(docs, fit(docs, sample)).withColumn("good", F.col("p_good") >= threshold)


def good_documents(docs: DataFrame, sample: int = TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the scorer finds good, with the columns of docs, whatever their names."""
    name = unused(docs, "p_good")
    return scored(docs, fit(docs, sample), name).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Every document with its probability and decision."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classify(docs).select("doc_id", F.round("p_good", 6).alias("p_good"), "good")
