"""Added spans: whole, in bounded memory, and how many of each planted kind are found."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa

from quillspark.llm import pii


def test_long_secrets_are_whole():
    for n in (100, 3400):
        token = "aB3" * n
        (found,) = pii.candidates(f"token {token} end", [])
        assert found[1:3] == (6, 6 + len(token)) and pii.decode_votes(np.array([found[3]]))[0][pii.LABELERS.index("isolated")] == -1


def test_long_masked_addresses_are_whole():
    name, host = "n" * 5000, "h" * 5000
    text = f"write {name} (at) {host} [dot] org now"
    (found,) = [f for f in pii.candidates(text, []) if f[0] == pii.MORE_KINDS.index("obfuscated")]
    assert text[found[1] : found[2]] == f"{name} (at) {host} [dot] org"


def test_identity_numbers_come_before_numbers():
    kinds = [(pii.MORE_KINDS[k], s, e) for k, s, e, _, _ in pii.candidates("ssn 17 123-45-6789 end", [])]
    assert kinds == [("idnum", 7, 18)]


def test_scores_equal_dense_rows():
    rng = np.random.default_rng(2)
    weights = rng.standard_normal(pii.FEATURES + 1)
    found = pii.candidates("call 555 123 4567, token aB3aB3aB3aB3aB3aB3aB3aB3; a (at) b (dot) org, 123-45-6789", [])
    codes, features = np.array([f[3] for f in found]), [f[4] for f in found]
    dense = pii._rows_of(pii.decode_votes(codes), features) @ weights[:-1] + weights[-1]
    assert len(found) >= 3 and np.allclose(pii.scores(weights, codes, pa.array(features, pa.list_(pa.int32()))), dense)


def test_a_megabyte_of_numbers_takes_bounded_memory(spark):
    text = ",".join(f"{k:011d}" for k in range(80_000))
    tracemalloc.start()
    start = time.perf_counter()
    found = pii.candidates(text, pii.base_spans(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 80_000 and peak < 120e6 and time.perf_counter() - start < 120
    docs = spark.createDataFrame([(1, text), (2, "token " + "aB3" * 3400)], "doc_id long, text string")
    assert {r["doc_id"] for r in pii.find(docs).collect()} == {1, 2}


def planted(rng: np.random.Generator, n: int) -> list[tuple[int, str, str]]:
    """(id, kind, text): kinds in turn, none among them, each in a sentence of its own words."""
    words = [f"{a}{b}" for a in ("bal", "cor", "den", "fal", "mir", "ton") for b in ("a", "er", "in", "os", "um")]
    digits = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    some = lambda k: " ".join(rng.choice(words, k))
    rows = []
    for i in range(n):
        kind = ("secret", "idnum", "obfuscated", "number", "clean")[i % 5]
        what = {
            "secret": f"api token {''.join(rng.choice(list('abcdefABCDEF0123456789'), 40))}",
            "idnum": f"ssn {rng.integers(100, 600)}-{rng.integers(10, 99)}-{rng.integers(1000, 9999)}",
            "obfuscated": f"mail {some(1)} (at) {some(1)} (dot) org",
            "number": f"phone ({rng.integers(200, 999)}) {digits(3)}-{digits(4)}",
            "clean": f"{rng.integers(1, 999)} {some(1)}",
        }[kind]
        rows.append((i, kind, f"{some(12)} {what} {some(12)}."))
    return rows


def test_recall_by_kind(spark):
    rows = planted(np.random.default_rng(8), 1500)
    out = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()}
    for kind in pii.MORE_KINDS:
        own = [i for i, k, _ in rows if k == kind]
        assert np.mean([any(s.startswith(kind + ":") for s in out[i]) for i in own]) >= 0.95, kind
    assert not any(out[i] for i, k, _ in rows if k == "clean")
