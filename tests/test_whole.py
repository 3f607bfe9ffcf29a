"""Queries that once read or returned a part of their rows: brute force over all of them."""

import math
import re
from collections import Counter, defaultdict

import duckdb

from quillspark.plans.catalogue import ORACLES, QUERIES
from quillspark.plans.views import activities
from tests.oracle import both

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_affinity_rates_of_all_papers(spark):
    acts = activities(spark, SF).select("pmid", "line", "person", "topic", "score").collect()
    papers, total, own, users = {r["pmid"] for r in acts}, defaultdict(set), defaultdict(set), defaultdict(set)
    for r in acts:
        total[r["person"]].add(r["pmid"])
        if r["score"] >= 0.8:
            own[r["person"], r["topic"]].add(r["pmid"])
            users[r["topic"]].add(r["pmid"])
    want = {}
    for pmid, person in {(r["pmid"], r["person"]) for r in acts if r["line"] <= 2}:
        for (who, core), mine in own.items():
            if who == person:
                k = len(mine - {pmid})
                want[pmid, person, core] = min(1.0, (k + 5 * len(users[core]) / len(papers)) / (len(total[person]) + 5)) if k else 0.0
    got = {(r["pmid"], r["person"], r["core"]): r["rate"] for r in QUERIES["affinity_rate"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 2e-6 for k, v in want.items())
    assert {k[0] % 10 for k in got} == set(range(10))


def test_ranking_quality_of_all_papers(spark):
    acts = activities(spark, LARGER).select("pmid", "person", "year", "score", "live", "position").collect()
    papers = {r["pmid"] for r in acts}
    assert max(papers) > 8000
    assert {r["q"] for r in QUERIES["ndcg"](spark, LARGER).collect()} == papers
    ranked = defaultdict(dict)
    for r in acts:
        score, rel = ranked[r["pmid"]].get(r["person"], (-1.0, 0))
        ranked[r["pmid"]][r["person"]] = max(score, r["score"]), max(rel, 2 if r["live"] and r["position"] != "middle" else 1 if r["live"] else 0)
    firsts, recalls = [], []
    for people in ranked.values():
        rels = [rel for _, _, rel in sorted((-score, person, rel) for person, (score, rel) in people.items())]
        firsts.append(1 / (rels.index(2) + 1) if 2 in rels else 0.0)
        if any(rels):
            recalls.append(sum(r >= 1 for r in rels[:3]) / sum(r >= 1 for r in rels))
    got = QUERIES["mrr_recall"](spark, LARGER).first()
    assert got["queries"] == len(papers)
    assert abs(got["mrr"] - sum(firsts) / len(firsts)) < 2e-6 and abs(got["recall"] - sum(recalls) / len(recalls)) < 2e-6


def test_suggestions_from_all_papers(spark):
    people, year = defaultdict(set), {}
    for r in activities(spark, LARGER).select("pmid", "person", "year").collect():
        people[r["pmid"]].add(r["person"])
        year[r["pmid"]] = r["year"]
    shared, seeds = defaultdict(set), defaultdict(set)
    for pmid, who in people.items():
        seed = {p for p in who if p <= 3}
        for p in who - seed if seed else ():
            shared[p].add(pmid)
            seeds[p] |= seed
    want = {p: (len(s), len(seeds[p]), max(year[x] for x in s) >= 2000) for p, s in shared.items() if len(s) >= 2}
    assert {r["person"]: (r["papers"], r["breadth"], r["recent"]) for r in QUERIES["staff_suggest"](spark, LARGER).collect()} == want


def test_tfidf_of_all_documents(spark, tmp_path):
    texts = [(1, "en", "Alpha beta gamma alpha"), (2, "de", "gamma delta alpha"), (3, "fr", "delta " * 400 + "gamma"), (4, "en", "one"), (5, "es", None)]
    spark.createDataFrame([(k, t, lang, len(t or "")) for k, lang, t in texts], "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    words = {k: Counter(re.findall("[a-z]{4,}", (t or "").lower())) for k, _, t in texts}
    df = Counter(w for c in words.values() for w in c)
    want = {}
    for k, c in words.items():
        x = [(1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in c.items() if df[w] >= 2]
        if x:
            z = math.sqrt(sum(v * v for v in x))
            want[k] = len(x), max(x) / z, sum(x) / z
    got = {r["doc_id"]: (r["terms"], r["top_weight"], r["l1"]) for r in QUERIES["tfidf_vectors"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() == {1, 2, 3}
    assert all(g[0] == w[0] and abs(g[1] - w[1]) < 2e-6 and abs(g[2] - w[2]) < 2e-6 for g, w in ((got[k], want[k]) for k in want))


def test_near_clones_across_labels(spark):
    import numpy as np

    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    e = np.array([r["embedding"] for r in rows], dtype=np.float64)
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    sim = np.triu(e @ e.T, 1)
    want = {(rows[i]["vec_id"], rows[j]["vec_id"]) for i, j in np.argwhere(sim >= 0.2)}
    got = QUERIES["near_clones"](spark, SF).collect()
    assert {(r["a"], r["b"]) for r in got} == want and any(r["label_a"] != r["label_b"] for r in got)


def test_all_records_fold(spark, tmp_path):
    names = [(1, "Red Ring"), (399, "red  ring!"), (401, "RED-RING"), (9000, "blue cup"), (9001, "Blue Cup"), (5, "alone")]
    spark.createDataFrame(names, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r["key"], r["id"], r["kept"], r["n"]) for r in QUERIES["alias_collapse"](spark, str(tmp_path)).collect()}
    assert got == {("red ring", 1, 1, 3), ("red ring", 399, 1, 3), ("red ring", 401, 1, 3), ("blue cup", 9000, 9000, 2), ("blue cup", 9001, 9000, 2)}


def test_places_of_all_ids(spark, tmp_path):
    ids = [7, 10, 99, 100, 1000, 12345, 99999, 100000, 123456, 123457, 1234567, 9999999, 10000000]
    spark.createDataFrame([(k,) for k in reversed(ids)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    assert {int(r["id"]): r["place"] for r in QUERIES["numeric_key_order"](spark, str(tmp_path)).collect()} == {k: i + 1 for i, k in enumerate(ids)}


def test_all_due_items(spark):
    from quillspark.plans.views import event_rows

    def due(r):
        k = r["k"] if r["k"] is not None else math.inf
        tests = (r["event_type"] == "signup", k < 5, k < 10, k < 12, r["event_type"] == "error" and r["value"] > 20)
        return next((i for i, t in enumerate(tests) if t), None)

    want = {r["event_id"]: due(r) for r in event_rows(spark, LARGER).collect()}
    got = {r["event_id"]: r["priority"] for r in QUERIES["due_items"](spark, LARGER).collect()}
    assert len(got) > 2500 and got == {k: p for k, p in want.items() if p is not None}


def test_informativeness_of_other_letters_and_ties(spark, tmp_path):
    texts = ["mañas ADN5ñ ñTPñ", "ñ incubatedñ x", "İİİ a form İ", "οδ a ΟΔΟΣ", "a b", "", None, "x" * 637 + " y zz " + "ñ" * 9, "WHO ii iii", "ñx9_ b c", "one two three a1.ñ"]
    rows = [(i, t) for i, t in enumerate([t for t in texts for _ in range(3)])] + [(200 + n, f"{'w' * n} u zz") for n in range(300, 700)]
    spark.createDataFrame(rows, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/benchmark.parquet/*.parquet'")
    mine, theirs = both(QUERIES["informativeness"], ORACLES["informativeness"], spark, con, str(tmp_path))
    assert mine == theirs
