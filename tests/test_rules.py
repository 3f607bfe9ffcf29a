"""Rules of merges, identity, versions and reviews on small fixtures; fits and covers against plain twins."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import containment, fitting, gates, overlap, ranking, vectors
from quillspark.operators.registry import match_or_mint
from quillspark.plans import stats
from quillspark.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_merge_plan(spark):
    rows = [
        ("a", "b", 10, 10, 4, None), ("a", "c", 10, 10, 3, None), ("a", "d", 10, 10, 0, 0.75), ("a", "e", 10, 10, 4, 0.9), ("a", "f", 10, 10, 0, 0.7),
        ("b", "c", 30, 10, 6, None), ("b", "d", 10, 30, 5, None), ("b", "e", 10, 30, 0, 0.8), ("b", "f", 29, 10, 4, None), ("c", "d", 0, 5, 0, 0.8), ("c", "e", 0, 0, 0, 0.8), ("c", "f", 0, 5, 0, None),
    ]
    pairs = spark.createDataFrame(rows, "a string, b string, size_a int, size_b int, shared int, cosine double")
    got = {r["a"] + r["b"]: (r["action"], r["signal"], r["parent"]) for r in overlap.merge_plan(pairs).collect()}
    assert got == {
        "ab": ("merge", "overlap", None), "ad": ("merge", "cosine", None), "ae": ("merge", "overlap+cosine", None), "bc": ("parent_child", "overlap", "b"), "be": ("parent_child", "cosine", "e"),
        "bf": ("merge", "overlap", None), "cd": ("parent_child", "cosine", "d"), "ce": ("parent_child", "cosine", "c"),
    }


def test_match_or_mint(spark):
    records = spark.createDataFrame([(7, "Magnetic Resonance Imaging (MRI)", [1.0, 0.0]), (3, "Flow cytometry", [0.0, 1.0]), (9, "mouse model", [0.6, 0.8])], "id long, name string, vector array<double>")
    mentions = spark.createDataFrame(
        [("mri", 4, "MRI", None), ("fluxing cell", 1, "Fluxing cell", [0.05, 1.0]), ("rat model", 2, "rat model", [0.6, 0.8]), ("facs", 1, "FACS", None), ("software", 9, "Software", [0.0, 1.0]), ("zeta", 1, "Zeta", [0.7, -0.7]), ("alpha", 1, "Alpha", None)],
        "form string, n int, name string, vector array<double>",
    )
    out = match_or_mint(mentions, records, ("software",), (("facs", "cytometry class"), ("flow cytometry", "cytometry class")), (("mouse", "rat"),))
    got = {r["form"]: (r["action"], r["via"], r["tool_id"]) for r in out.collect()}
    assert got == {
        "mri": ("attached", "surface", 7), "fluxing cell": ("attached", "embedding", 3), "rat model": ("minted", "kept apart", 11), "facs": ("attached", "surface", 3), "software": ("denied", None, None),
        "zeta": ("minted", None, 12), "alpha": ("minted", None, 10),
    }
    assert {r["tool_id"] for r in match_or_mint(mentions, records.limit(0)).collect()} == set(range(1, 8))


def test_versions(spark):
    schema = "k string, label string, m array<int>, n int"
    old = spark.createDataFrame([("a", "x", [1, 2], 2), ("b", "x", [3], 1), ("c", "x", [4], 1), ("d", "x", [5], 1), ("e", None, [6], 1)], schema)
    new = spark.createDataFrame([("a", "x", [1, 2, 9], 3), ("b", "y", [3], 1), ("c", "x", [], 0), ("e", None, [6, 8], 1), ("new", "x", [9], 1), ("odd", "x", None, 0)], schema)
    added, minted = spark.createDataFrame([(9,)], "m int"), spark.createDataFrame([("new",)], "k string")
    fail = lambda n: {(r["guard"], r["item"]) for r in gates.version_failures(old, n, "k", ["label"], "m", added, minted).collect()}
    assert fail(new) == {("missing", "d"), ("changed", "b"), ("lost members", "c"), ("miscounted", "e"), ("foreign members", "e"), ("not minted", "odd")}
    assert fail(old) == set() and ("shrink", "records") in fail(new.limit(0))


def test_reviews_and_cards(spark):
    good, none = "x" * 40, F.array().cast("array<string>")
    check = lambda who, why, what, there, failed=none, blocks=none: one(spark, e=gates.review_errors(F.lit(who).cast("string"), F.lit(why).cast("string"), F.lit(what).cast("string"), F.lit(there), failed, blocks))["e"]
    some = F.array(F.lit("stage"))
    assert check("cwid_ab1", good, "approve", True) == [] and check("cwid_ab1", good, "reject", True, some, some) == []
    assert check("cwid_ab1", good, "approve", True, some, some) == ["failed stages", "gate blocks"]
    assert check(None, "  " + "y" * 39 + "\n", "Approve", False) == ["reviewer", "rationale", "decision", "artifact"] and check("cwid_1", None, None, None) == ["reviewer", "rationale", "decision", "artifact"]
    verdict = lambda now, before: one(spark, v=gates.card_verdict(F.lit(now), F.lit(before).cast("int")))["v"]
    assert [verdict(7, 7), verdict(8, 12), verdict(8, 13), verdict(8, None), verdict(8, 0), verdict(66, 100), verdict(65, 100)] == ["floor", "publish", "shrunk", "publish", "publish", "publish", "shrunk"]


def test_numbers_and_ranks_within_ranges(spark):
    rng = np.random.default_rng(3)
    values = [round(float(v), 2) for v in rng.normal(size=600)] + [0.5] * 300
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(5)
    got = {r["id"]: r["place"] for r in ranking.numbered(df, [F.col("v").desc(), F.col("id")]).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(range(len(values)), key=lambda i: (-values[i], i)) and sorted(got.values()) == list(range(1, 901))
    ordered = sorted(values)
    want = {v: (ordered.index(v) + 1 + len(ordered) - ordered[::-1].index(v)) / 2 for v in set(values)}
    assert {r["id"]: r["avg_rank"] for r in ranking.average_ranks(df, "v").collect()} == {i: want[v] for i, v in enumerate(values)}
    assert ranking.numbered(df.limit(0), [F.col("v")]).count() == 0 and ranking.average_ranks(df.limit(0), "v").count() == 0


def test_hot_members_make_the_same_pairs(spark):
    rows = [(f"s{i:03d}", 0) for i in range(120)] + [(f"s{i:03d}", 1 + i % 7) for i in range(120)]
    m = spark.createDataFrame(rows, "id string, m int")
    pick = lambda hot: sorted(tuple(r) for r in overlap.pair_counts(m, "id", "m", hot=hot).select("a", "b", "shared", "size_a", "size_b").collect())
    assert pick(10) == pick(1_000_000) and len(pick(10)) == 120 * 119 // 2


def test_phrases_in_texts(spark):
    texts = ["the cat sat on the mat", "a cathedral cat", "one two three four five six seven", "he cat sat on th", "", "two three two three two three", None]
    phrases = ["he cat sat on th", "cat", "t c", "wo three two thr", "two three four five six", "seven", "x y z w", "ne two three four five six seve"]
    t, p = spark.createDataFrame(list(enumerate(texts)), "tid int, x string"), spark.createDataFrame(list(enumerate(phrases)), "pid int, t string")
    got = sorted((r["tid"], r["pid"]) for r in containment.containing(t, "tid", "x", p, "pid", "t").collect())
    assert got == sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(phrases) if x and y in x)


def newton(x, y, w, offset, penalty):
    beta = np.zeros(x.shape[1])
    for _ in range(200):
        q = 1 / (1 + np.exp(-(x @ beta + offset)))
        g, h = x.T @ (w * (y - q)) - penalty * beta, (x * (w * q * (1 - q))[:, None]).T @ x + np.diag(penalty)
        beta = beta + np.clip(np.linalg.solve(h, g), -1, 1)
    return beta


@pytest.fixture(scope="module")
def panel(spark):
    df = stats._scored(spark, SF)
    return df, df.toPandas()


def test_logistic_fits_equal_plain_newton(spark, panel):
    df, pdf = panel
    y, z, ones = pdf["y"].to_numpy(), pdf["z"].to_numpy(), np.ones(len(pdf))
    assert np.allclose(fitting.logistic_fit(df, ["z"], "y", ridge=0.01), newton(np.stack([ones, z], 1), y, ones, 0, np.full(2, 0.01)), atol=1e-6)
    assert np.allclose(fitting.logistic_fit(df, [], "y", offset="z"), newton(ones[:, None], y, ones, z, np.zeros(1)), atol=1e-6)
    assert fitting.logistic_fit(df.limit(0), ["z"], "y") == [0.0, 0.0]
    c, weights = fitting.joint_logistic(df, ["z", "size", "en"], "y", "doc_id", grid=(0.1, 1.0))
    x = pdf[["z", "size", "en"]].to_numpy()
    x = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    assert c in (0.1, 1.0) and np.allclose(weights, newton(np.hstack([ones[:, None], x]), y, ones, 0, np.array([0, *[1 / c] * 3])), atol=1e-5)


def test_held_out_losses_equal_plain_folds(spark, panel):
    df, pdf = panel
    fold = {r["doc_id"]: r["f"] for r in df.select("doc_id", fitting._fold("doc_id", 10).alias("f")).collect()}
    f, y, z = pdf["doc_id"].map(fold).to_numpy(), pdf["y"].to_numpy(), pdf["z"].to_numpy()
    line = np.zeros(len(y))
    for k in range(10):
        own = f != k
        a, b = newton(np.stack([np.ones(own.sum()), z[own]], 1), y[own], np.ones(own.sum()), 0, np.full(2, 1e-6))
        line[~own] = a + b * z[~own]
    loss = lambda v: float(-(y * np.log(1 / (1 + np.exp(-v))) + (1 - y) * np.log(1 - 1 / (1 + np.exp(-v)))).mean())
    got = {r["model"]: r["log_loss"] for r in fitting.cross_fitted(df, "z", "y", "doc_id").collect()}
    assert abs(got["line"] - loss(line)) < 1e-4 and abs(got["score"] - loss(z)) < 1e-4


def test_replicates_equal_plain_sums(spark, panel):
    df, pdf = panel
    reps = fitting.replicates(df, "doc_id", {"rate": F.col("y"), "z": F.col("z")}, 20).toPandas().set_index("rep")
    w = df.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("rep")).withColumn("w", fitting.poisson("doc_id", "rep")).toPandas()
    m = w.merge(pdf, on="doc_id")
    for rep, g in m.groupby("rep"):
        assert abs(reps["rate"][rep] - (g["w"] * g["y"]).sum() / g["w"].sum()) < 1e-9 and abs(reps["z"][rep] - (g["w"] * g["z"]).sum() / g["w"].sum()) < 1e-9
    assert abs(w["w"].mean() - 1) < 0.1


def test_clique_cover_equals_a_plain_loop(spark):
    from quillspark.plans.clustering import _merge_edges

    near = {}
    for a, b in _merge_edges(spark, SF).collect():
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    used, want = set(), set()
    for seed in sorted(near):
        if seed not in used:
            group = [seed]
            for other in sorted(near[seed]):
                if other not in used and all(other in near[m] for m in group):
                    group.append(other)
            if len(group) > 1:
                used |= set(group)
                want |= {(seed, m) for m in group}
    assert {(r["clique"], r["member"]) for r in QUERIES["clique_cover"](spark, SF).collect()} == want


def test_entities_follow_their_sources(spark, tmp_path):
    from quillspark.sources.shared import entity

    source, built = f"{tmp_path}/t.parquet", []

    def build():
        built.append(1)
        return spark.read.parquet(source)

    spark.range(3).write.parquet(source)
    assert entity("t", [source], build, spark).count() == 3 and entity("t", [source], build, spark).count() == 3 and len(built) == 1
    spark.range(5).write.mode("overwrite").parquet(source)
    assert entity("t", [source], build, spark).count() == 5 and len(built) == 2


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from quillspark.sources.shared import shared_dir

    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    make = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k: None)))
    with pytest.raises(RuntimeError):
        shared_dir(make("spark://host:7077"))
    assert shared_dir(make("local[4]")).startswith("file:/")


def test_long_texts_are_split_once(spark):
    words = " ".join(f"w{k * 7919 % 10007}" for k in range(60_000))
    t = spark.createDataFrame([(0, words), (1, "a " + " ".join(words.split(" ")[500:520])), (2, None)], "tid int, x string")
    p = spark.createDataFrame([(0, " ".join(words.split(" ")[505:511])), (1, "x y z v w u")], "pid int, t string")
    began = time.monotonic()
    assert sorted((r["tid"], r["pid"]) for r in containment.containing(t, "tid", "x", p, "pid", "t").collect()) == [(0, 0), (1, 0)]
    assert time.monotonic() - began < 30


def test_forest_joins_what_all_pairs_join(spark):
    x = np.random.default_rng(3).normal(size=(300, 8)).round(2)
    x[0] = 0
    x[1] = 0
    x[40:60] = x[39]
    rows = [(i, i % 2 if i != 45 else None, x[i].tolist()) for i in range(300)] + [(900, 0, None)]
    v = spark.createDataFrame(rows, "id long, g int, v array<float>")
    for least in (0.6, 0.97):
        root = list(range(300))
        for i in range(300):
            for j in range(i):
                a, b = x[i].astype(np.float32).astype(float), x[j].astype(np.float32).astype(float)
                if i % 2 == j % 2 and 45 not in (i, j) and a.any() and b.any() and a @ b / np.sqrt((a @ a) * (b @ b)) >= least and root[i] != root[j]:
                    lo, hi = sorted((root[i], root[j]))
                    root = [lo if r == hi else r for r in root]
        want = {i: r for i, r in enumerate(root) if root.count(r) > 1}
        for block, pivots in ((1_000, 100), (20, 5)):
            edges = vectors.alike_forest(v, "id", "v", "g", least, block, pivots)
            assert {r["node"]: r["component"] for r in overlap.components(edges).collect()} == want
