"""The corpus pipeline against its parts."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from quillspark.llm import bpe, mixing, quality
from quillspark.llm.common import stored
from tests.llm.test_table_ops import check_mix, normal, plain_join


def test_stage_by_stage(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], d), re.sub("[^a-z]", "", name)))
    assert all(o.columns == docs.columns for o in out[:-1])
    good, exact, near, mixed, ids = ([tuple(r) for r in o.collect()] for o in out[1:])
    want = {r["doc_id"] for r in quality.classify(docs).where("good").collect()}
    assert {r[0] for r in good} == want
    first = {}
    for r in sorted(good):
        first.setdefault(normal(r[1]), r)
    assert sorted(exact) == sorted(first.values())
    heads = {c for (_, c, _, _) in plain_join([(r[0], r[1]) for r in exact])}
    assert {r[0] for r in near} == heads and len(near) == len(heads)
    rows = mixing.mix(out[3]).collect()
    check_mix(rows)
    copies = Counter({r["doc_id"]: r["mix_copies"] for r in rows if r["mix_copies"]})
    assert Counter(r[0] for r in mixed) == copies
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()), special_tokens={})
    text = {r[0]: r[1] for r in mixed}
    assert Counter(r[0] for r in ids) == copies
    for doc, n, sha, back, tokens in ids:
        t = lib.encode_ordinary(text[doc])
        assert list(tokens) == t and n == len(t) and sha == hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest() and back == hashlib.sha256(text[doc].encode()).hexdigest()


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and out.count() > 0


def test_stages_bear_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", odd["size"].alias("n_chars"))
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, ""), re.sub("[^a-z]", "", name))
        assert now.count() >= 0


def test_stages_keep_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    names = ("_id", "_sha", "_s", "_size", "_h", "_doc", "_row", "row", "kept", "mix_copies", "mix_size", "p_good", "good", "digest", "source_", "n")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names}).withColumn("a map", F.create_map(F.lit("k"), F.col("doc_id")))
    docs = docs.unionByName(docs.limit(3))
    want = {r["doc_id"]: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r == want[r["doc_id"]] for r in rows)
