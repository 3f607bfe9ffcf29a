"""Small fixtures with the edge cases of each operator."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import scores, text
from quillspark.functions.dates import first_number, iso_date, largest_amount
from quillspark.functions.grants import activity_tier, opportunity_reason, stage_appeals
from quillspark.operators import gates, overlap, ranking
from quillspark.sources import files, sinks


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_overlap_of_empty_and_contained_sets(spark):
    m = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 3), ("c", 9), ("b", 2)], "id string, m int")
    p = overlap.pair_counts(m, "id", "m").withColumn("o", overlap.min_card()).collect()
    assert [(r["a"], r["b"], r["shared"], r["o"]) for r in p] == [("a", "b", 2, 1.0)]
    assert overlap.pair_counts(m.limit(0), "id", "m").count() == 0
    empty = spark.createDataFrame([(0, 0, 4)], "shared int, size_a int, size_b int")
    assert empty.select(overlap.min_card().alias("o")).first()["o"] == 0.0


def test_components(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("q", "q")] + [(f"n{k:02d}", f"n{k + 1:02d}") for k in range(30)], "a string, b string")
    got = {r["node"]: r["component"] for r in overlap.components(e).collect()}
    assert {k: got[k] for k in "abcxy"} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"} and got["n30"] == "n00" and "q" not in got
    assert overlap.components(e.limit(0)).count() == 0


def test_cosine_of_zero_vectors(spark):
    z, v = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    r = one(spark, zero=overlap.cosine(z, v), same=overlap.cosine(v, v))
    assert r["zero"] == 0.0 and abs(r["same"] - 1) < 1e-12


def test_epsilon_argmax(spark):
    rows = [(1, "a", 0.9, 1.0), (1, "b", 0.8995, 5.0), (1, "c", 0.5, 9.0), (2, "b", 0.4, 1.0), (2, "a", 0.4, 1.0), (3, "z", 0.7, 0.0)]
    df = spark.createDataFrame(rows, "k int, id string, v double, t double")
    got = {r["k"]: r["id"] for r in ranking.epsilon_argmax(df, ["k"], "v", "t", "id", 0.001).collect()}
    assert got == {1: "b", 2: "a", 3: "z"}


def test_knee_of_one_member_and_zero(spark):
    df = spark.createDataFrame([("a", "x", 8.0), ("a", "y", 4.0), ("a", "z", 0.0), ("b", "x", 1.0)], "g string, id string, w double")
    got = {r["g"]: (r["knee"], r["ratio"], r["position"]) for r in ranking.knee(df, "w", "id", ["g"]).collect()}
    assert got == {"a": (0.0, float("inf"), 2)}


def test_streak_ignores_transparent_rows(spark):
    rows = [(1, 5, "skip"), (1, 4, "empty"), (1, 3, "skip"), (1, 2, "run"), (1, 1, "skip"), (2, 1, "empty"), (3, 2, "run"), (3, 1, "skip")]
    df = spark.createDataFrame(rows, "k int, t int, s string")
    got = {r["k"]: r["streak"] for r in ranking.streak(df, ["k"], [F.col("t").desc()], F.col("s") == "skip", F.col("s") == "empty").collect()}
    assert got == {1: 2, 3: 0}


def test_average_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, 9.0)], "id int, v double")
    assert {r["id"]: float(r["avg_rank"]) for r in ranking.average_ranks(df, "v").collect()} == {3: 1.0, 1: 2.5, 2: 2.5, 4: 4.0}


def test_scores(spark):
    n = F.lit(None).cast("double")
    r = one(
        spark, zero=scores.article_score(F.lit(0.0), F.lit(1.0)), hi=scores.sigmoid(F.lit(800.0)), lo=scores.sigmoid(F.lit(-800.0)), abstain=scores.abstaining_mean([(0.4, n), (0.2, F.lit(0.5))], 0.3), none=scores.abstaining_mean([(0.4, n)], 0.3),
        bucket=scores.log_bucket(F.lit(1e9)), nothing=scores.log_bucket(F.lit(0.0)), gate=scores.soft_gate(F.lit(0), 2.0, 3.0), both=scores.noisy_or(F.lit(0.6), F.lit(0.4)), shown=scores.decayed(F.lit(2.0), n), key=scores.sort_key(F.lit(0.9239)), cap=scores.sort_key(F.lit(25.0)),
    )
    assert (r["zero"], r["hi"], r["lo"], r["abstain"], r["none"], r["bucket"], r["nothing"], r["gate"], r["shown"], r["key"], r["cap"]) == (0.0, 1.0, 0.0, 0.5, 0.3, 1.0, None, 0.0, 2.0, "0923", "9999")
    assert abs(r["both"] - 0.76) < 1e-12


def test_text(spark):
    r = one(
        spark, keys=text.surface_keys(F.lit("Magnetic resonance imaging (MRI) scanner")), plain=text.surface_keys(F.lit("PubMed bibliographic database")), title=text.title_tokens(F.lit("The Award for Research on Bees, on bees")), html=text.strip_html(F.lit("<p>a &amp;lt; b</p>\n c")),
        case=text.sentence_case(F.lit("mass Spectrometry of DNA")), cut=text.fit_words(F.lit("abc " * 30)), word=text.has_phrase(F.lit("HEK293T cells"), F.lit("hek293")), whole=text.has_phrase(F.lit("HEK293 cells"), F.lit("hek293")),
        use=text.informativeness(F.lit("hek cells were transfected with Nav1.3"), F.lit("hek")), back=text.informativeness(F.lit("they say hek is widely used"), F.lit("none")),
    )
    assert set(r["keys"]) == {"magnetic resonance imaging", "magnetic resonance imaging mri scanner", "magnetic resonance imaging scanner", "mri", "magnetic resonance imaging mri"}
    assert "pubmed" in r["plain"] and r["title"] == ["bees"] and r["html"] == "a &lt; b c" and r["case"] == "Mass spectrometry of DNA"
    assert len(r["cut"]) <= 80 and r["cut"].endswith("abc") and not r["word"] and r["whole"] and r["use"] == 1.0 and r["back"] == 0.0


def test_dates_and_amounts(spark):
    r = one(spark, a=iso_date(F.lit("by 3/7/2024.")), b=iso_date(F.lit("Sept 5, 2023")), c=iso_date(F.lit("05-Nov-2022")), d=iso_date(F.lit("Foo 5, 2023")), e=iso_date(F.lit("")), m=largest_amount(F.lit("$1,000 to $25,000")), n=largest_amount(F.lit("few")), i=first_number(F.lit("about 1,234.9 or 5")))
    assert tuple(r) == ("2024-03-07", "2023-09-05", "2022-11-05", "", "", 25000, None, 1234)


def test_grants(spark):
    lst = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    why = lambda k, g, l, t, d: opportunity_reason(lst(*k), lst(*g), lst(*l), F.lit(t), lst(*d), "2024-01-01")
    r = one(
        spark, tier=activity_tier(F.lit("r35")), none=activity_tier(F.lit("")), kind=why(["Equipment"], [], [], "", []), both=why(["equipment", "Fellowship"], [], [], "", []), geo=why(["fellowship"], ["Australia"], [], "", []), loc=why(["fellowship"], ["Any"], ["Australia"], "", []),
        us=why(["fellowship"], ["Australia", "USA"], ["Australia"], "", []), held=why(["fellowship"], [], [], "X (Temporarily Suspended)", []), past=why(["fellowship"], [], [], "", ["2023-01-01", ""]), odd=why(["what"], [], [], "", ["2025-01-01"]), post=stage_appeals(F.lit("Postdocs"))["postdoc"], early=stage_appeals(F.lit("Postdocs"))["early"], every=stage_appeals(F.lit("all faculty"))["mid"],
    )
    assert tuple(r) == (0.85, None, "project_type", "", "geo_non_us", "geo_non_us", "", "suspended", "past_deadline", "unknown_type", 0.9, 0.1, 0.8)


def test_gates(spark):
    @gates.gate("t1", "block")
    def bad(df):
        return df.where("x > 1")

    @gates.gate("t1", "warn")
    def fine(df):
        return df.where("x > 100")

    out = gates.run_gates("t1", spark.createDataFrame([(1,), (2,)], "x int"))
    assert [(r["gate"], r["violations"], r["passed"]) for r in out.orderBy("place").collect()] == [("bad", 1, False), ("fine", 0, True)] and gates.blocked(out)
    with pytest.raises(KeyError):
        gates.run_gates("none")
    with pytest.raises(gates.TooFew):
        gates.guard_floor(spark.range(3), 5)
    assert gates.guard_floor(spark.range(3), 5, "warn").count() == 3 and gates.guard_floor(spark.range(5), 5).count() == 5


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k int, v string, human string")
    new = spark.createDataFrame([(1, "A", None), (2, None, None), (4, "D", "w")], "k int, v string, run string")
    got = {r["k"]: (r["v"], r["human"], r["run"]) for r in sinks.merged(old, new, ["k"], held=F.col("o_human") == "x").collect()}
    assert got == {1: ("a", "x", None), 2: ("b", "y", None), 3: ("c", "z", None), 4: ("D", None, "w")}
    owned = {r["k"]: r["v"] for r in sinks.merged(old, new, ["k"], owned=["v"]).collect()}
    assert owned == {1: "A", 2: None, 3: "c", 4: "D"}


def test_publish_and_logs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    first = sinks.publish(df, f"{tmp_path}/art", "v1")
    again = sinks.publish(df.orderBy(F.col("k").desc()), f"{tmp_path}/art", "v2", previous=first["sha256"])
    assert first["published"] and not again["published"] and sinks.read_latest(spark, f"{tmp_path}/art").count() == 2
    log = tmp_path / "log.json"
    log.write_text('{"k": 1, "n": 1}\n{"k": 1, "n": 2}\nbroken\n{"k": 2, "n": 1}\n')
    assert {(r["k"], r["n"]) for r in files.replay_log(spark, str(log), "k int, n int", "k", "n").collect()} == {(1, 2), (2, 1)}
    with pytest.raises(Exception):
        files.replay_log(spark, str(log), "k int, n int", "k", "n", strict=True).collect()
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError):
        files.replay_log(spark, str(tmp_path / "empty.json"), "k int, n int", "k", "n", strict=True)


def test_csv_under_a_banner(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Banner, of two\nlines\nid,name\n1,x\n2,y z\n")
    got = files.read_csv_under_banner(spark, str(tmp_path / "a.csv"), "id,name", "id int, name string").collect()
    assert {tuple(r) for r in got} == {(1, "x"), (2, "y z")}
    with pytest.raises(ValueError):
        files.either(spark.range(1), "a", "b")


def test_ids_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    assert {tuple(r) for r in files.latest(df, ["k"], "t").collect()} == {(1, 2, "b"), (2, 1, "c")}
    assert files.with_ids(df, df.limit(0), "k").count() == 0


def test_streaming_state(spark, tmp_path):
    from quillspark.streaming import jobs

    rows = [(1, "2024-01-01 00:00:00", 7, "error"), (2, "2024-01-01 00:01:00", 7, "error"), (3, "2024-01-02 00:00:00", 7, "error"), (4, "2024-01-02 00:00:01", 8, "error"), (5, "2024-01-02 00:00:02", 8, "purchase")]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string").select("event_id", F.to_timestamp("t").alias("ts"), "user_id", "event_type", F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    df.where("event_id <= 2").coalesce(1).write.parquet(f"{tmp_path}/in")
    df.where("event_id > 2").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    out = jobs.drained(jobs.failure_states(jobs.source(spark, f"{tmp_path}/in", pattern="*.parquet")), f"{tmp_path}/q")
    last = {r["user_id"]: (r["failures"], r["quarantined"]) for r in files.latest(out, ["user_id"], "last_ts").collect()}
    assert last == {7: (3, True), 8: (0, False)}


def test_diverse_selection(spark):
    from quillspark.operators.selection import diverse, penalised

    pool = spark.createDataFrame([("a", "p", 9.0), ("b", "p", 8.0), ("c", "q", 7.0), ("d", "r", 6.0), ("e", "r", 6.0)], "id string, parent string, score double")
    clones = spark.createDataFrame([("a", "c"), ("b", "e")], "a string, b string")
    got = [(r["id"], r["how"]) for r in diverse(pool, clones, 3, 4).orderBy("place").collect()]
    assert got == [("a", "distinct"), ("d", "distinct"), ("b", "fill"), ("c", "fill")]
    assert [r["id"] for r in diverse(pool, clones, 1, 1).collect()] == ["a"]
    rich = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 9.9), ("c", 2, 9.5), ("d", 2, 1.0)], "id string, scholar int, score double")
    assert [r["id"] for r in penalised(rich, 3, 0.08).orderBy("place").collect()] == ["a", "c", "b"]


def test_cliques_and_claims(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("c", "d")], "a string, b string")
    got = {(r["clique"], r["member"]) for r in overlap.cliques(e, overlap.components(e)).collect()}
    assert got == {("a", "a"), ("a", "b"), ("a", "c")}
    c = spark.createDataFrame([("t", "x", "p", 0.9, 0.0), ("t", "y", "p", 0.8, 0.0), ("t", "y", "q", 0.1, 0.9), ("t", "z", "r", 0.3, 0.8), ("t", "w", "s", 0.3, 0.1)], "topic string, slug string, prior string, overlap double, text_sim double")
    got = {r["slug"]: (r["prior"], r["how"], r["split_from"]) for r in overlap.claims(c, "topic", 0.5, 0.2).collect()}
    assert got == {"x": ("p", "overlap", None), "y": (None, "mint", "p"), "z": ("r", "label", None), "w": (None, "mint", None)}


def test_queries_in_blocks(spark):
    from quillspark.operators.blocks import against

    rows, queries = spark.range(50).withColumnRenamed("id", "r"), spark.range(17).withColumnRenamed("id", "q")
    fold = lambda df: df.groupBy("q").agg(F.count("*").alias("n"))
    want = {q: sum(r % 17 == q for r in range(50)) for q in range(17)}
    for block in (3, 100):
        assert {r["q"]: r["n"] for r in against(rows, queries, "q", F.col("r") % 17 == F.col("q"), fold, block).collect()} == want


def test_dates_of_four_shapes(spark):
    cases = {
        "2024-05-01": "2024-05-01", "on 2024-05-01.": "2024-05-01", "2024-05-01T00:00": "", "x2024-05-01": "", "12-2024-05-01": "2024-05-01", "3/7/2024": "2024-03-07", "3/7/20245": "",
        "May 1 2024": "2024-05-01", "May. 1, 2024": "2024-05-01", "May1, 2024": "", "marching 12, 2023": "2023-03-12", "Room 12 2024 or 5-Nov-2022": "2022-11-05", "5 Nov 2022": "2022-11-05",
        "5-Nov-2022 and 1/2/2023 and 2024-01-02": "2024-01-02", "": "", "rolling": "", "\n7/8/2021": "2021-07-08",
    }
    rows = spark.createDataFrame(list(cases.items()), "t string, want string").select("t", "want", iso_date(F.col("t")).alias("got")).collect()
    assert {r["t"]: r["got"] for r in rows} == cases


def test_career_stages_by_all_their_words(spark):
    rows = {
        "Outstanding Service Award": {"senior"}, "Lifetime achievement": {"senior"}, "Rising stars under 45": {"early"}, "pre-tenure faculty": {"early"}, "early-to mid-career": {"early", "mid"},
        "Middle to senior investigators": {"mid", "senior"}, "postdoctoral fellow": {"postdoc"}, "graduate students": {"grad"}, "NAM member": {"senior"}, "within 7 years of a PhD": {"early"},
    }
    for text, stages in rows.items():
        got = one(spark, a=stage_appeals(F.lit(text)))["a"].asDict()
        assert got == {s: 0.9 if s in stages else 0.1 for s in got}, text
    assert one(spark, a=stage_appeals(F.lit("All ranks")))["a"].asDict() == {"grad": 0.6, "postdoc": 0.7, "early": 0.8, "mid": 0.8, "senior": 0.8}
    for text in (None, "", "a prize"):
        assert one(spark, a=stage_appeals(F.lit(text).cast("string")))["a"].asDict() == {"grad": 0.2, "postdoc": 0.3, "early": 0.5, "mid": 0.5, "senior": 0.5}
