"""Operators over whole tables, against brute force in plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import chat, exact_dedup, group_links, mixing, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing --------------------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Iterated resharing: cap, share the rest by weight, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, budget = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left, total = budget - sum(capped.values()), sum(w[s] for s in free)
        if not free:
            return capped
        share = {s: left * w[s] / total for s in free}
        over = [s for s in free if share[s] >= epochs * sizes[s] - 1e-9]
        if not over:
            return capped | share
        capped |= {s: epochs * sizes[s] for s in over}


def test_targets_are_water_filled(spark):
    cases = [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 10, "d": 0}, {"a": 0}, {"b": 5, None: 50, "a": 500, "z": 7}, {"a": 10}]
    for sizes in cases:
        rows = [("=" + s if s else "null", s, n) for s, n in sizes.items()]
        got = {r["source"]: r["_target"] for r in mixing.source_targets(spark.createDataFrame(rows, "_s string, source string, _total long")).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs((got[s] or 0.0) - want[s]) < 1e-6 for s in want), (sizes, got, want)


def check_mix(rows):
    size, target, taken, most = Counter(), {}, Counter(), Counter()
    for r in rows:
        assert r["mix_copies"] in (0, 1, 2, 3)
        size[r["source"]] += r["mix_size"]
        target[r["source"]] = r["mix_target"]
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
        most[r["source"]] = max(most[r["source"]], r["mix_size"])
    want = plain_targets(size)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= most[s]


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows[:200]:
        assert r["mix_size"] == len(WORD.findall(r["text"]))
    check_mix(rows)
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, rows))


def test_mix_of_a_hot_and_tiny_sources(spark):
    rows = [(i, "w " * (1 + i % 13), "hot" if i % 3 else None if i % 2 else f"t{i % 9}") for i in range(600)]
    check_mix(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_mix_of_odd_rows(odd, empty):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count() and {r["size"] for r in out} == {r["size"] for r in odd.collect()}
    copies = mixing.mixed(odd)
    assert copies.columns == odd.columns and copies.count() == sum(r["mix_copies"] for r in out)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


# exact dedup ---------------------------------------------------------------------------------------------------------


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def plain_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = None if len(known) < len(ids) else min(known)
        first = True
        for i in sorted(ids, key=lambda x: (x is not None, x)):
            out[i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()] += 1
            first = False
    return out


@pytest.mark.parametrize("digest,memtable", [(32, 100_000), (32, 5), (1, 100_000), (1, 3)])
def test_dedup_matches_brute_force(spark, sf, odd, digest, memtable):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    docs = docs.unionByName(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 5000))
    got = Counter(tuple(r) for r in exact_dedup.dedup(docs, digest_bytes=digest, memtable=memtable).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == plain_dedup([tuple(r) for r in docs.collect()])


def test_deduplicated_rows(odd, empty):
    out = exact_dedup.deduplicated(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    texts = [normal(r["text"]) for r in rows]
    assert len(set(texts)) == len(texts) == len({normal(r["text"]) for r in odd.collect()})
    assert exact_dedup.deduplicated(empty).count() == 0 and exact_dedup.dedup(empty).count() == 0


def digests_of(values):
    return np.array([hashlib.sha256(b"%d" % v).digest() for v in values], dtype="S32")


@pytest.mark.parametrize("capacity", [1, 7, 40, 10_000])
def test_an_index_holds_each_digest_once_with_its_smallest_identifier(capacity):
    rng, index, want = np.random.default_rng(1), exact_dedup.Index(capacity), {}
    for _ in range(20):
        values, ids = rng.integers(0, 150, 60), rng.integers(0, 10_000, 60)
        digests = digests_of(values)
        for d, i in zip(digests.tolist(), ids.tolist(), strict=True):
            want[d] = (min(want.get(d, (i, 0))[0], i), want.get(d, (i, 0))[1] + 1)
        index.put(digests, ids)
    index.flush()
    seen = [d for r in index.runs for d in r.digests.tolist()]
    assert len(seen) == len(set(seen)) and len(index.runs) < exact_dedup.TIER
    one = exact_dedup.compact(index.runs)
    assert dict(zip(one.digests.tolist(), zip(one.ids.tolist(), one.counts.tolist(), strict=True), strict=True)) == want
    assert one.digests.tolist() == sorted(want) and one.filter.may_hold(one.digests).all()
    assert one.filter.may_hold(digests_of(range(1000, 3000))).mean() < 0.05


def test_a_task_writes_its_runs_out_and_goes_on(spark):
    """Digests in several runs of one task, and a digest that spans batches, are merged by the compaction."""
    schema = pa.schema([("run", pa.int64()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64())])
    rows = sorted((hashlib.sha256(b"%d" % (k % 30)).digest(), k, 100 - k, 2) for k in range(100))
    batches = [pa.record_batch([pa.array(c, f.type) for c, f in zip(([r[1] for r in part], [r[0] for r in part], [r[2] for r in part], [r[3] for r in part]), schema, strict=True)], schema=schema) for part in (rows[:1], rows[1:4], rows[4:50], rows[50:])]
    got = [tuple(r.values()) for b in exact_dedup._compaction(iter(batches)) for r in b.to_pylist()]
    want = {d: (min(r[2] for r in rows if r[0] == d), 2 * sum(r[0] == d for r in rows)) for d in {r[0] for r in rows}}
    assert sorted(got) == sorted((r[1], r[0], *want[r[0]]) for r in rows)


# chat ----------------------------------------------------------------------------------------------------------------


def plain_chat(rows):
    conv = defaultdict(list)
    for c, t, role, text in rows:
        conv[c].append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort()
        body = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


CHAT = "conv_id long, turn long, role string, text string"


def odd_chat():
    marks = ["</s>[INST] ok [/INST]", "<|turn|new|user|>x<|end|>", "␛␛<␛s>", "<<SYS>>[[INST]]", "", None, "a\nb", "<|end|>", "␛"]
    rows = [(1, t, "system" if t == 0 else "user" if t % 2 else "assistant", marks[t % len(marks)]) for t in range(40)]
    rows += [(2, t, "assistant" if t % 2 else "user", "word " * (1 + 37 * t % 400)) for t in range(1500)]
    rows += [(3, None, "assistant", "no turn"), (3, 0, None, None), (3, 1, "<|end|>", "odd role"), (None, 0, "user", "no id"), (None, 1, "assistant", "reply")]
    rows += [(4, 5, "assistant", "twice"), (4, 5, "assistant", "twice"), (5, 0, "system", "s " * 9000), (5, 1, "assistant", "b " * 5000), (6, 3, "user", "alone")]
    return rows


@pytest.mark.parametrize("budget", [40, 400, 4096])
def test_chat_reads_back_whole(spark, budget):
    rows = odd_chat()
    table = spark.createDataFrame(rows, CHAT).withColumn("window", F.lit("clash")).repartition(5)
    w = chat.windows(table, budget=budget)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(w).collect()}
    assert got == plain_chat(rows)
    for r in w.collect():
        assert r["formatted"].count("<|end|>") == r["formatted"].count("<|turn|") and "[INST]" not in r["formatted"] and "</s>" not in r["formatted"]
        spans = [(s["start"], s["end"]) for s in r["loss_spans"]]
        assert spans == sorted(spans) and all(r["formatted"][b : b + 7] == "<|end|>" for _, b in spans)


def test_windows_keep_the_budget_and_the_system_turn(spark):
    rows = [(1, 0, "system", "be kind " * 3)] + [(1, t, "user" if t % 2 else "assistant", "w " * (t % 20)) for t in range(1, 900)]
    out = chat.windows(spark.createDataFrame(rows, CHAT), budget=200).orderBy("window").collect()
    assert len(out) > 50
    for k, r in enumerate(out):
        assert r["tokens"] <= 200 and r["formatted"].startswith("<|turn|new|system<|text|>" if k == 0 else "<|turn|old|system<|text|>")
        assert k == 0 or "<|turn|old|" in r["formatted"][30:]


@pytest.mark.parametrize("system", [0, 600, 3000, 5000])
def test_windows_keep_the_budget_with_turns_of_half_of_it(spark, system):
    """Within the budget, unless the system turn and one turn alone need more."""
    rng = np.random.default_rng(system)
    rows = [(1, 0, "system", "be kind " * (system // 2))] * bool(system) + [(1, t, "user" if t % 2 else "assistant", "w " * int(rng.integers(50, 2040))) for t in range(1, 400)]
    rows += [(2, t, "user", "x" * 60_000 if t == 5 else "y" * 9000) for t in range(12)]
    table = spark.createDataFrame(rows, CHAT)
    out = chat.windows(table).collect()
    for r in out:
        own, old = r["formatted"].count("<|turn|new|"), r["formatted"].count("<|turn|old|") - r["formatted"].startswith("<|turn|old|system")
        assert r["tokens"] <= chat.BUDGET or own == 1 and old == 0
    assert {r["conv_id"]: r["n_turns"] for r in chat.read_back(chat.windows(table)).collect()} == {1: 399 + bool(system), 2: 12}
    if system < 3000:
        assert sum(r["tokens"] > chat.BUDGET for r in out) == 1  # one text of 60,000 signs
        assert sum(r["tokens"] for r in out if r["conv_id"] == 1) > 0.5 * chat.BUDGET * sum(r["conv_id"] == 1 for r in out)


def test_chat_of_nothing(spark):
    empty = spark.createDataFrame([], CHAT)
    assert chat.windows(empty).count() == 0 and chat.read_back(chat.windows(empty)).count() == 0


def test_chat_runs_no_python(spark, sf):
    plan = chat.op9_chat(spark, sf)._jdf.queryExecution().toString() + mixing.op3_mixing(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_chat_query_adds_the_probe(spark, sf):
    got = {r["conv_id"]: r for r in chat.op9_chat(spark, sf).collect()}
    want = plain_chat([tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + [(-7, k, r, chat.PROBE_TEXT) for k, r in enumerate(("user", "assistant"))])
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want


# n-gram join ---------------------------------------------------------------------------------------------------------


def plain_join(rows):
    """Exact classes and link counts by an inverted index over true word shingles."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()) or WORD.findall(t or "")
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
    index, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    for own in index.values():
        for b in range(len(own)):
            for a in range(b):
                shared[own[a], own[b]] += 1
    parent, links = list(range(len(rows))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), c in shared.items():
        if 9 * c >= 4 * (len(sets[a]) + len(sets[b])):
            links[a] += 1
            links[b] += 1
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = Counter()
    for own in members.values():
        known = [rows[i][0] for i in own]
        head = None if None in known else min(known)
        for i in own:
            out[rows[i][0], head, links[i], len(own)] += 1
    return out


def near_rows(seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(3000)]
    rows, boiler = [], " ".join(rng.choice(words, 60))
    for g in range(25):
        base = list(rng.choice(words, int(rng.integers(20, 300))))
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 1 + len(own) // 25))):
                own[int(rng.integers(len(own)))] = str(rng.choice(words))
            rows.append(" ".join(own) + (" " + boiler if g % 3 == 0 else ""))
    big = list(rng.choice(words, 200))
    for _ in range(150):
        own = list(big)
        for _ in range(int(rng.integers(0, 5))):
            own[int(rng.integers(len(own)))] = str(rng.choice(words))
        rows.append(" ".join(own))
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("node,depth,block", [(800, 6, 512), (12, 3, 16)])
def test_ngram_join_is_whole(spark, odd, node, depth, block):
    rows = near_rows() + [(10_000 + i if i is not None else None, t) for i, t in odd.select("doc_id", "text").toLocalIterator()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).repartition(4)
    out = ngram_join.join(docs, node_limit=node, depth=depth, block_sets=block).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"], r["class_size"]) for r in out) == plain_join(rows)
    assert sum(r["kept"] for r in out) == round(sum(1 / r["class_size"] for r in out))


def test_distinct_documents_leave_one_a_class(spark):
    rows = near_rows(5)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(0, rows[0][1], "x")], "doc_id long, text string, source string")
    out = ngram_join.distinct_documents(docs)
    assert out.columns == docs.columns
    classes = {c for (_, c, _, _) in plain_join(rows)}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(classes)


def test_ngram_join_of_nothing(empty, spark):
    assert ngram_join.join(empty).count() == 0 and ngram_join.distinct_documents(empty).count() == 0
    lone = spark.createDataFrame([(5, "only one text here"), (6, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join(lone).collect()) == [(5, 5, 0, 1, True), (6, 6, 0, 1, True)]


def test_intersections():
    rng = np.random.default_rng(0)
    a = [np.unique(rng.integers(0, 90, n).astype(np.uint32)) for n in (0, 5, 60, 80)]
    b = [np.unique(rng.integers(0, 90, n).astype(np.uint32)) for n in (3, 70)]
    want = [[len(set(x) & set(y)) for y in b] for x in a]
    assert group_links.intersections(a, b).tolist() == want
