"""Crowded nodes and large groups of the n-gram join: hot passages, boilerplate, near copies of one text."""

import numpy as np
import pandas as pd
import pytest

from quillspark.llm import group_links, ngram_join

VOCABULARY = [f"w{k}" for k in range(20000)]


def around_a_passage(n: int, share: float, words: int = 100) -> tuple[list, list]:
    """n texts of which `share` is one passage; every fortieth has a near copy (similarity over 0.9)."""
    rng = np.random.default_rng(11)
    hot, rows, pairs = list(rng.choice(VOCABULARY, int(words * share))), [], []
    while len(rows) < n:
        own = list(rng.choice(VOCABULARY, words - len(hot)))
        rows.append((len(rows), " ".join(hot + own)))
        if len(rows) % 40 == 1 and len(rows) < n:
            own[-3] = "changed"
            pairs.append((len(rows) - 1, len(rows)))
            rows.append((len(rows), " ".join(hot + own)))
    return rows, pairs


def edited(n: int, words: int = 60) -> list:
    """Copies of two texts, the second half of which is the same, with up to six words changed, some texts repeated."""
    rng = np.random.default_rng(5)
    one = list(rng.choice(VOCABULARY, words))
    two = list(rng.choice(VOCABULARY, words // 8)) + one[words // 8 :]
    rows = []
    for k in range(n):
        text = list(one if k % 3 else two)
        for _ in range(int(rng.integers(0, 7))):
            text[int(rng.integers(0, words))] = str(rng.choice(VOCABULARY[:50]))
        rows += [(len(rows) + j, " ".join(text)) for j in range(1 + (k % 9 == 0))]
    return rows


def brute(rows: list) -> dict[int, tuple[int, int]]:
    """doc_id -> (class, links), from all pairs of sets of true shingles."""
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for _, t in rows)]
    index = sorted(set().union(*sets))
    at = {s: i for i, s in enumerate(index)}
    x = np.zeros((len(sets), len(index)), np.float32)
    for i, s in enumerate(sets):
        x[i, [at[v] for v in s]] = 1
    size, common = x.sum(1), x @ x.T
    near = 9 * common >= 4 * (size[:, None] + size[None, :])
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(rows)).min(1))
        if (new == label).all():
            return {rows[i][0]: (int(rows[label[i]][0]), int(near[i].sum())) for i in range(len(rows))}
        label = new


def joined(spark, rows: list, **options) -> dict[int, tuple[int, int]]:
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"])).repartition(4)
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(docs, **options).collect()}


@pytest.mark.parametrize("share,n", [(2 / 3, 6000), (0.82, 1600)])
def test_pairs_under_a_hot_passage_meet(spark, share, n):
    """Similarity 0.5 and 0.7 of all texts; nodes above the production limit."""
    rows, pairs = around_a_passage(n, share)
    out = joined(spark, rows)
    assert sum(out[a] == (a, 1) and out[b] == (a, 1) for a, b in pairs) >= 0.99 * len(pairs)
    assert sum(links for _, links in out.values()) <= 2 * len(pairs)


def test_nested_crowds_split_again(spark):
    rows, pairs = around_a_passage(600, 2 / 3)
    out = joined(spark, rows, node_limit=24)
    assert sum(out[a] == (a, 1) and out[b] == (a, 1) for a, b in pairs) >= 0.95 * len(pairs)


@pytest.mark.parametrize("block_sets", [8, 64])
def test_links_of_large_groups_equal_brute_force(spark, block_sets):
    rows = edited(400)
    assert joined(spark, rows, block_sets=block_sets) == brute(rows)


@pytest.mark.parametrize("dear", [0.0, 1e9])
def test_deltas_and_blocks_give_the_same_links(spark, dear, monkeypatch):
    """The choice by cost never changes links: all groups by blocks, and all by deltas."""
    rows = edited(150) + [(k + 10_000, t) for k, t in around_a_passage(200, 0.82)[0]]
    aggregate = group_links.F.aggregate
    monkeypatch.setattr(group_links.F, "aggregate", lambda *a: aggregate(*a) * 0 + (1e9 if dear else 0))
    assert joined(spark, rows, block_sets=16) == brute(rows)


def test_what_the_exact_step_reads_grows_with_the_texts(spark):
    """Buckets of the exact step: in proportion to the number of texts around one passage, not to its square."""
    counts = []
    for n in (700, 2800):
        rows, _ = around_a_passage(n, 0.82)
        sets = [ngram_join.shingles(t) for _, t in rows]
        frame = pd.DataFrame({"comp": 1, "row": range(n), "n": [len(s) for s in sets], "copies": 1, "shingles": [s.tobytes() for s in sets]})
        sized = spark.createDataFrame(frame).withColumn("m", group_links.F.lit(n)).withColumn("s", group_links.F.lit(int(frame["n"].sum())))
        reference = group_links.references(sized)
        delta = group_links.deltas(sized.join(reference, "comp", "left")).cache()
        F = group_links.F
        ends = delta.groupBy("comp").agg(F.min("c").alias("cmin"), F.max("c").alias("cmax"), F.min(F.struct("c", "row"))["row"].alias("z"))
        counts.append(group_links._buckets(group_links.indexed(delta, ends), 512).count())
    assert 0 < counts[0] and counts[1] < 6 * counts[0]


@pytest.mark.parametrize("splits,runs", [(0, 7), (1, 8), (6, 8)])
def test_runs_bear_every_split(splits, runs):
    assert ngram_join.runs_for(0.999, splits) == runs
