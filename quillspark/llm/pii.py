"""Personal data: base patterns, and further spans by weak supervision.

Base spans come from fixed patterns. Candidates for more spans (secrets after cue words, phone-like and card-like numbers
that the base rules refuse, obfuscated addresses, identity numbers) are voted on by regex, gazetteer and context labelers,
each of which may abstain. Expectation-maximisation over the counts of all vote patterns of the corpus estimates every
labeler's reliability for each kind; the posteriors label a bounded sample of candidates, on which a logistic span
classifier over votes and hashed shape and context features is trained. It decides on every candidate.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of_bytes, ship, stored, tune

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds the method adds, listed after the base kinds.
MORE_KINDS = ("secret", "number", "idnum", "obfuscated")

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS, _DIGIT = re.compile(r"[^0-9]"), re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed: linear in the text, with the matches of the plain patterns."""
    out = []
    if "@" in text:
        last = 0
        for m in _AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    if "." in text:
        # a run of digits is read from its first digit, or from where the match before it ends: the same place
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _DIGITS.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return [(BASE_KINDS[k], s, e) for s, k, e in out]


_MASKED_AT = re.compile(r"[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++)++")


class _Masked:
    """Addresses with (at) and (dot): found by the (at), then read leftwards; linear in the text."""

    @staticmethod
    def finditer(text: str) -> Iterator[tuple[int, int]]:
        last = 0
        for m in _MASKED_AT.finditer(text):
            end = m.start() - (text[m.start() - 1 : m.start()] == " ")
            start = end
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < end:
                yield start, m.end()
            last = m.end()


class _Spans:
    def __init__(self, pattern: str) -> None:
        self.pattern = re.compile(pattern)

    def finditer(self, text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in self.pattern.finditer(text))


# candidates: one pattern a kind, wide rather than sure; identity numbers first, which the wider pattern for numbers would take
_CANDIDATES = (
    ("secret", _Spans(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+")),
    ("idnum", _Spans(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("number", _Spans(r"(?<![0-9A-Za-z])\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)*+")),
    ("obfuscated", _Masked),
)
#: Cue words of the gazetteer labeler (fixed values).
CUES = {
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "auth", "bearer", "apikey", "credential"),
    "number": ("phone", "tel", "call", "mobile", "fax", "card", "visa", "account", "iban", "telefon", "téléphone", "teléfono", "tarjeta", "carte", "karte"),
    "idnum": ("ssn", "social", "security", "id", "identity", "passport"),
    "obfuscated": ("mail", "email", "contact", "write", "reach", "correo", "courriel"),
}
LABELERS = ("format", "cue", "isolated", "diverse", "checksum", "prose")
#: Features of the span classifier; candidates it is trained on at most (those with the smallest digests).
FEATURES, TRAIN = 512, 20_000
#: Bytes of text scanned at once: a megabyte of digits holds some 80,000 candidates.
SCAN_BYTES = 1 << 20


def _votes(kind: str, span: str, before: str, after: str) -> tuple[int, ...]:
    """Of each labeler: 1 personal, 0 not, -1 abstains. Regex and checksum judge the form, gazetteer and context the place."""
    digits = _DIGITS.sub("", span)
    letters = [c for c in span if c.isalpha()]
    low = before.lower()
    if kind == "secret":
        hexed = all(c in "0123456789abcdefABCDEF" for c in span)
        fmt = 1 if hexed and digits and letters else 1 if digits and any(c.isupper() for c in span) and any(c.islower() for c in span) else 0
        check = 1 if len(span) in (32, 40, 64) else -1
    elif kind == "number":
        # the base rules take numbers that pass the card check: what is left of that length is a number that fails it
        fmt = 0 if len(digits) >= 12 or len(digits) < 7 else 1 if len(digits) >= 9 and len(span) > len(digits) else -1
        check = 0 if len(digits) >= 12 and not luhn(digits) or len(digits) < 7 else -1
    elif kind == "idnum":
        fmt, check = 1, 0 if span[:3] in ("000", "666") or span[4:6] == "00" else -1
    else:
        fmt, check = 1, 1 if re.search(r"[a-zA-Z]{2,}$", span) else -1
    cue = 1 if any(c in low[-24:] for c in CUES[kind]) else -1
    left, right = before[-1:], after[:1]
    # a span inside a longer run, or one of few signs, speaks against it; the opposite says little
    isolated = 0 if left.isalnum() or right.isalnum() else -1
    body = digits if kind != "secret" else span
    diverse = 0 if len(body) >= 7 and len(set(body)) < 4 else -1
    prose = 0 if kind == "secret" and len(letters) == len(span) else -1
    return fmt, cue, isolated, diverse, check, prose


def _shape(s: str) -> str:
    return re.sub(r"x+", "x", re.sub(r"9+", "9", re.sub(r"[^\W\d_]", "x", re.sub(r"[0-9]", "9", s))))[:16]


def _features(kind: str, span: str, before: str, after: str) -> list[int]:
    words = before.lower().split()
    named = (f"k{kind}", f"s{kind}{_shape(span)}", f"n{kind}{min(len(span) // 4, 12)}", f"w{words[-1] if words else ''}", f"v{words[-2] if len(words) > 1 else ''}", f"a{_shape(after[:3])}", f"b{_shape(before[-3:])}")
    votes = 2 * 3 * len(LABELERS)
    return sorted({votes + zlib.crc32(f.encode()) % (FEATURES - votes) for f in named})


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """(kind, start, end, votes in base 3, features) of spans that no base span and no earlier candidate overlaps."""
    out, busy = [], [(s, e) for _, s, e in taken]
    for kind, pattern in _CANDIDATES:
        k, found, j = MORE_KINDS.index(kind), [], 0
        busy.sort()
        for s, e in pattern.finditer(text):
            if e - s < 7 or kind == "secret" and not _DIGIT.search(text, s, e):
                continue
            while j < len(busy) and busy[j][1] <= s:
                j += 1
            if j < len(busy) and busy[j][0] < e:
                continue
            before, after = text[max(0, s - 40) : s], text[e : e + 8]
            span, code = text[s:e], 0
            for v in _votes(kind, span, before, after):
                code = 3 * code + v + 1
            found.append((k, s, e, code, _features(kind, span, before, after)))
        out += found
        busy += [(s, e) for _, s, e, _, _ in found]
    out.sort()
    return out


def decode_votes(codes: np.ndarray) -> np.ndarray:
    """codes -> votes (-1, 0, 1), a column a labeler."""
    out = np.empty((len(codes), len(LABELERS)), dtype=np.int8)
    rest = np.asarray(codes, dtype=np.int64)
    for j in range(len(LABELERS) - 1, -1, -1):
        out[:, j] = rest % 3 - 1
        rest = rest // 3
    return out


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation of a two-class model with abstaining, independent labelers.

    votes(pattern, labeler) with counts(pattern). Returns prior, P(vote 1 | class) as (2, labelers), posteriors of class 1.
    Starts from the majority vote; add-one smoothing keeps every probability inside (0, 1).
    """
    cast = votes >= 0
    share = np.where(cast.any(1), (votes == 1).sum(1) / np.maximum(1, cast.sum(1)), 0.5)
    post = np.clip(share, 0.05, 0.95)  # no vote at all starts at one half
    prior, one = 0.5, np.empty((2, votes.shape[1]))
    for _ in range(rounds):
        prior = float((counts * post).sum() + 1) / float(counts.sum() + 2)
        for c, p in ((0, 1 - post), (1, post)):
            w = (counts * p)[:, None]
            one[c] = ((w * (votes == 1)).sum(0) + (2 if c else 1)) / ((w * cast).sum(0) + 3)
        log = np.log(np.array([1 - prior, prior]))[None, :] + np.stack([np.where(votes == 1, np.log(one[c]), np.where(cast, np.log(1 - one[c]), 0)).sum(1) for c in (0, 1)], axis=1)
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return prior, one, post


def _rows_of(votes: np.ndarray, features: list) -> np.ndarray:
    """Dense rows for the bounded training sample: one-hot votes, then hashed features."""
    x = np.zeros((len(votes), FEATURES), dtype=np.float32)
    for j in range(votes.shape[1]):
        x[np.arange(len(votes)), 3 * j + votes[:, j] + 1] = 1
    for i, f in enumerate(features):
        x[i, f] = 1
    return x


def scores(weights: np.ndarray, codes: np.ndarray, features: pa.ListArray) -> np.ndarray:
    """Logits of candidates, by adding the weights at their ids: no dense rows, a few bytes a candidate."""
    votes, out = decode_votes(codes), np.full(len(codes), weights[-1])
    for j in range(votes.shape[1]):
        out += weights[3 * j + votes[:, j] + 1]
    owner = np.repeat(np.arange(len(codes)), np.diff(features.offsets.to_numpy()))
    return out + np.bincount(owner, weights[features.flatten().to_numpy()], minlength=len(codes))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 1.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by full-batch gradient steps with per-weight scaling; the last weight is the bias."""
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w, g2 = np.zeros(x1.shape[1], dtype=np.float64), np.full(x1.shape[1], 1e-8)
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (p - y) / len(x) + decay * w
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
    return w


def scan(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, base array<string>, cand array<struct>: one read of the texts."""
    ship(docs.sparkSession)
    item = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.int32()), ("features", pa.list_(pa.int32()))])
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("cand", pa.list_(item))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of_bytes(batch, 500, SCAN_BYTES):
                base, ends, flat = [], [0], []
                for text in part.column(1):
                    text = text.as_py()
                    found = base_spans(text)
                    base.append([f"{k}:{s}:{e}" for k, s, e in found])
                    flat += candidates(text, found)
                    ends.append(len(flat))
                kind, start, end, votes, features = zip(*flat, strict=True) if flat else ((),) * 5
                cand = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip((kind, start, end, votes, features), item, strict=True)], fields=list(item))
                yield pa.record_batch([part.column(0), pa.array(base, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cand).cast(pa.list_(item))], schema=schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(work, "doc_id long, base array<string>, cand array<struct<kind:int,start:long,end:long,votes:int,features:array<int>>>")


def fit(scanned: DataFrame, sample: int = TRAIN) -> dict:
    """Reliabilities from the vote patterns of all candidates (at most kinds x 3^labelers counts), weights from a sample."""
    flat = scanned.select("doc_id", F.explode("cand").alias("c")).select("doc_id", "c.*")
    patterns = flat.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    posterior: dict[tuple[int, int], float] = {}
    learned = {}
    for k, name in enumerate(MORE_KINDS):
        own = [r for r in patterns if r["kind"] == k]
        if own:
            prior, one, post = reliabilities(decode_votes(np.array([r["votes"] for r in own])), np.array([r["count"] for r in own], dtype=float))
            posterior |= {(k, r["votes"]): float(p) for r, p in zip(own, post, strict=True)}
            learned[name] = {"prior": prior, "reliability": {n: [float(one[0, j]), float(one[1, j])] for j, n in enumerate(LABELERS)}}
    rows = flat.orderBy(F.xxhash64("doc_id", "start", "kind"), "doc_id", "start", "kind").limit(sample).collect()
    votes = decode_votes(np.array([r["votes"] for r in rows], dtype=np.int64))
    x = _rows_of(votes, [r["features"] for r in rows])
    w = train(x, np.array([posterior[r["kind"], r["votes"]] for r in rows]))
    return {"weights": w, "labelers": learned}


def find(docs: DataFrame, sample: int = TRAIN, threshold: float = 0.5) -> DataFrame:
    """docs(doc_id, text, ...): doc_id, base array<string>, spans array<string> (kind:start:end, code points, end exclusive).

    Null texts are empty and have no spans; rows that repeat are scanned each; without candidates only base spans are
    returned; an empty table gives no rows; other columns are not read.
    """
    scanned = stored(scan(docs), "piiscan")
    weights = fit(scanned, sample)["weights"]
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("spans", pa.list_(pa.string()))])
    order = {k: i for i, k in enumerate(BASE_KINDS + MORE_KINDS)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for bs, cs in zip(batch.column(1), batch.column(2), strict=True):
                rows = [(int(b.split(":")[1]), order[b.split(":")[0]], b) for b in bs.as_py()]
                if len(cs):
                    kind, start, end, votes, features = cs.values.flatten()
                    good = np.flatnonzero(scores(weights, votes.to_numpy(), features) > np.log(threshold / (1 - threshold)))
                    found = zip(kind.to_numpy()[good].tolist(), start.to_numpy()[good].tolist(), end.to_numpy()[good].tolist(), strict=True)
                    rows += [(s, order[MORE_KINDS[k]], f"{MORE_KINDS[k]}:{s}:{e}") for k, s, e in found]
                spans.append([b for _, _, b in sorted(rows)])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.string()))], schema=schema)

    return scanned.mapInArrow(work, "doc_id long, base array<string>, spans array<string>")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents."""
    tune(spark)
    out = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda b: b.startswith(f"{k}:"))).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(F.concat_ws(",", "base"), 256).alias("base_sha256"), F.concat_ws(",", "spans").alias("spans"))
