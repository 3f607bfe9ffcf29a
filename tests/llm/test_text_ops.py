"""Operators on single texts, against brute force: library tokenizers, plain patterns, plain sums."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import bpe, fingerprint, pii, quality, tokens

SP = P.path("piece_bpe_32k.model")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=SP)


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(open(RANKS, "rb").read()), special_tokens={})


@pytest.mark.parametrize("hot_bytes", [0, 20_000, tokens.HOT_BYTES])
def test_token_counts_match_the_library(spark, sf, odd, sp, hot_bytes):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(docs, SP, hot_bytes=hot_bytes).collect())
    want = Counter()
    for r in docs.collect():
        t = r["text"] or ""
        n = len(sp.encode(t))
        want[r["doc_id"], len(t.encode()), n, n > 4096] += 1
    assert got == want


def test_token_counts_of_nothing(empty):
    assert tokens.token_counts(empty, SP).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t▁é😀.")), max_size=30))
def test_token_counts_any_text(text):
    import sentencepiece

    data = open(SP, "rb").read()
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert sum(tokens.pieces(tokens.pre_tokens(text), data)) == len(model.encode(text))


def test_bpe_matches_the_library(spark, sf, odd, tik):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in bpe.encoded(docs, RANKS, P.PATTERN).collect())
    want = Counter()
    for r in docs.collect():
        t = r["text"] or ""
        ids = tik.encode_ordinary(t)
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), tuple(ids)] += 1
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabcthe 'sé漢.1")), max_size=60))
def test_bpe_any_text(text):
    import tiktoken

    data = open(RANKS, "rb").read()
    c = bpe.codec(data, P.PATTERN)
    ids = c.encode(text)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_bpe_memo_and_batches_change_nothing():
    import tiktoken

    data = open(RANKS, "rb").read()
    small = bpe.Codec(data, P.PATTERN, memo=7)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=small.ranks, special_tokens={})
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("aabenrstthe  ,.é漢"), int(rng.integers(0, 200)))) for _ in range(60)] + ["x" * 127, "ab" * 64, "q" * 129, "zq" * 500, ""]
    for part in (texts, texts[::-1], texts[:3], texts):
        got = small.encode_batch(part)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode_ordinary(t) for t in part]
        assert len(small.memo) <= max(7, len({m for t in part for m in small.find(t)}))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=20))
def test_rows_of_trees_are_single_trees(pieces):
    c = bpe.codec(open(RANKS, "rb").read(), P.PATTERN)
    rows = bpe.encode_pieces(pieces, c.pairs)
    for piece, row in zip(pieces, rows, strict=True):
        assert np.frombuffer(row, "<u4").tolist() == bpe.encode_piece(piece, c.ranks) or piece in c.ranks
        assert b"".join(c.table[t] for t in np.frombuffer(row, "<u4").tolist()) == piece


def test_bpe_of_nothing(empty):
    assert bpe.encoded(empty, RANKS, P.PATTERN).count() == 0


# personal data -------------------------------------------------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ@.-+ 0123459()")), max_size=50))
def test_base_spans_any_text(text):
    assert pii.base_spans(text) == plain_base(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a@.b ")), max_size=25))
def test_emails_any_text(text):
    assert pii.base_spans(text) == plain_base(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_over_a_table(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    text = {}
    for r in docs.collect():
        text.setdefault(r["doc_id"], []).append(r["text"] or "")
    rows = pii.find(docs).collect()
    assert len(rows) == docs.count()
    secrets = 0
    for r in rows:
        assert r["base"] in [[f"{k}:{s}:{e}" for k, s, e in plain_base(t)] for t in text[r["doc_id"]]]
        assert set(r["base"]) <= set(r["spans"])
        starts = [int(s.split(":")[1]) for s in r["spans"]]
        assert starts == sorted(starts)
        secrets += sum(s.startswith("secret:") for s in r["spans"])
        for s in r["spans"]:  # numbers of card length that fail the card's check are nobody's
            kind, start, end = s.split(":")
            assert kind != "number" or all(len(re.sub("[^0-9]", "", t[int(start) : int(end)])) < 12 for t in text[r["doc_id"]] if len(t) >= int(end))
    planted = sum(len(re.findall(r'(?i:token) = "[0-9A-Fa-f]{40}"', t)) for ts in text.values() for t in ts)
    assert secrets >= 0.9 * planted > 0


def test_pii_of_nothing(empty, spark):
    assert pii.find(empty).count() == 0
    lone = spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")
    assert [tuple(r) for r in pii.find(lone).collect()] == [(1, [], [])]


def test_reliabilities_find_the_bad_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.85, 0.55])
    votes = np.where(rng.random((4000, 4)) < right, truth[:, None], ~truth[:, None]).astype(np.int8)
    votes[rng.random(votes.shape) < 0.2] = -1
    prior, one, post = pii.reliabilities(votes, np.ones(4000))
    assert abs(prior - 0.4) < 0.05 and ((post > 0.5) == truth).mean() > 0.95
    accuracy = (one[1] + 1 - one[0]) / 2
    assert accuracy.argmin() == 3 and abs(accuracy[0] - 0.95) < 0.04


# fingerprints --------------------------------------------------------------------------------------------------------


def test_fingerprints_form_a_multiset_hash():
    f = fingerprint.Fingerprint.of
    a, b, c = b"the first line here\n", b"another line of words\n", b"a third one\n"
    assert f(a + b + c).text() == f(c + a + b).text() == (f(a) + f(b) + f(c)).text()
    assert f(a + b).remove(b).text() == f(a).text() and f(a).add(b).text() == f(b + a).text()
    assert f(a + a).text() != f(a).text()


def test_edited_fingerprint_is_the_edited_texts():
    for text, after in (("one two three\nfour five six seven", "eight nine ten\neleven twelve"), ("", "x"), ("a", "b c"), ("ab\n\n\ncd", "\n"), ("wörd " * 40, "ein Wört\n" * 9)):
        new = fingerprint.edited_text(text, after)
        whole = fingerprint.Fingerprint.of(text.encode())
        assert fingerprint.edited_fingerprint(whole, text, new).text() == fingerprint.Fingerprint.of(new.encode()).text()


def test_fingerprints_in_order(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id >= 20").unionByName(odd.select("doc_id", "text"))
    for size in (2000, 10_000_000):
        got = fingerprint.with_edits(docs, range_bytes=size).collect()
        order = sorted(((-(2**63) if r["doc_id"] is None else r["doc_id"]), r["text"] or "") for r in docs.collect())
        want = Counter()
        for k, (i, t) in enumerate(order):
            new = fingerprint.edited_text(t, order[(k + 1) % len(order)][1])
            want[None if i == -(2**63) else i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprint.Fingerprint.of(t.encode()).text(), fingerprint.Fingerprint.of(new.encode()).text()] += 1
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got) == want
        long = [r for r in got if r["n_chars"] > 400]
        assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.9
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_word_hashes_of_chunks_equal_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(4)
    data = np.frombuffer(b" ".join(bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(1, 60, 300)), dtype=np.uint8)
    starts, ends = fingerprint.words_of(data)
    want = fingerprint.word_hashes(data, starts, ends)
    monkeypatch.setattr(fingerprint, "CHUNK", 32)  # words of up to 59 bytes are longer
    assert (fingerprint.word_hashes(data, starts, ends) == want).all() and len(set(want.tolist())) > 280


def true_likeness(a: str, b: str) -> float:
    """Cosine of the bags of word pairs (a paragraph's first word alone), without any hashing."""
    def bag(text):
        out = Counter()
        for line in text.split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            out.update(zip([None, *words], words, strict=False))
        return out

    x, y = bag(a), bag(b)
    scale = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / scale if scale else float(a == b)


def test_likeness_is_near_the_true_one(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = [r["text"] or "" for r in rows]
    error, printed = [], [fingerprint.Fingerprint.of(t.encode()) for t in texts]
    for k, t in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        new = fingerprint.edited_text(t, after)
        for other, sketch in ((new, fingerprint.Fingerprint.of(new.encode())), (after, printed[(k + 1) % len(texts)])):
            error.append(printed[k].likeness(sketch) - max(0.0, true_likeness(t, other)))
    assert abs(np.mean(error)) < 0.04 and np.std(error) < 0.09


def test_fingerprints_of_a_text_of_megabytes(spark):
    text = "x" * 2_000_000 + " " + "word und mehr\n" * 150_000
    docs = spark.createDataFrame([(1, text), (2, text[::-1]), (None, None)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in fingerprint.with_edits(docs).collect()}
    assert out[1]["n_chars"] == out[2]["n_chars"] == len(text) and out[None]["n_chars"] == 0
    assert out[1]["edited_sha256"] == hashlib.sha256(fingerprint.edited_text(text, text[::-1]).encode()).hexdigest()


def test_fingerprints_of_nothing(empty):
    assert fingerprint.with_edits(empty).count() == 0


# quality -------------------------------------------------------------------------------------------------------------


def test_quality_agrees_with_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.classify(docs).join(labels, "doc_id").select("good", "quality").collect()
    good = [r["good"] for r in out if r["quality"] == 1]
    junk = [not r["good"] for r in out if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(junk) > 0.9


def test_quality_of_odd_texts(odd, empty):
    out = quality.classify(odd)
    assert out.columns == [*odd.columns, "p_good", "good"] and out.count() == odd.count()
    assert quality.classify(empty).count() == 0
    assert all(0 <= r["p_good"] <= 1 for r in out.collect())


def test_accuracies_start_from_rare_junk():
    votes = np.array([[1, 1, -1], [0, 1, 0], [1, 1, 1], [0, 1, 1]])
    prior, good, post = quality.accuracies(votes, np.array([800.0, 80, 400, 5]))
    assert post[0] > 0.9 and post[1] < 0.1 and prior > 0.8
