"""Statistics and ranking quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions.scores import wilson
from quillspark.operators.fitting import cross_fitted, evidence_line, joint_logistic, logistic_fit, replicates
from quillspark.operators.ranking import average_ranks, top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, activities, with_sql
from quillspark.sources.tables import table

PANEL = "pn AS (SELECT l.doc_id, quality AS y, toxic, n_chars, least(0.99, greatest(0.01, n_chars / 4000.0)) AS p, d.lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _panel(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    p = F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("n_chars") / 4000.0))
    return table(spark, d, "labels").join(docs, "doc_id").select("doc_id", F.col("quality").alias("y"), "toxic", "n_chars", p.alias("p"), "lang")


@query("WITH " + PANEL + """
, r AS (SELECT y, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM pn), s AS (SELECT sum(CASE WHEN y = 1 THEN r END) AS sr, count(CASE WHEN y = 1 THEN 1 END) AS p, count(CASE WHEN y = 0 THEN 1 END) AS n FROM r)
SELECT p AS positives, n AS negatives, round((sr - p * (p + 1) / 2.0) / (p * n), 6) AS auc FROM s""")
def auc(spark, d):
    """Area under the curve by rank sums, ties averaged."""
    r = average_ranks(_panel(spark, d), "n_chars")
    s = r.agg(F.sum(F.when(F.col("y") == 1, F.col("avg_rank"))).alias("sr"), F.count(F.when(F.col("y") == 1, 1)).alias("positives"), F.count(F.when(F.col("y") == 0, 1)).alias("negatives"))
    p = F.col("positives")
    return s.select("positives", "negatives", F.round((F.col("sr") - p * (p + 1) / 2) / (p * F.col("negatives")), 6).alias("auc"))


@query("WITH " + PANEL + """
, f AS (SELECT lang, count(CASE WHEN y = 1 THEN 1 END) AS ph, count(CASE WHEN y = 0 THEN 1 END) AS nh FROM pn GROUP BY 1), t AS (SELECT sum(ph) AS pn, sum(nh) AS nn FROM f)
SELECT lang AS key, ph AS pos_hits, nh AS neg_hits, round(ln(((ph + 0.5) / (pn + 1.0)) / ((nh + 0.5) / (nn + 1.0))), 6) AS weight, CASE WHEN ph + nh < 30 THEN 'refused' WHEN ph = 0 OR nh = 0 THEN 'bound' ELSE '' END AS note FROM f, t""")
def woe_table(spark, d):
    """Weights of evidence with Laplace smoothing; small panels are refused, empty cells noted as bounds."""
    f = _panel(spark, d).groupBy(F.col("lang").alias("key")).agg(F.count(F.when(F.col("y") == 1, 1)).alias("pos_hits"), F.count(F.when(F.col("y") == 0, 1)).alias("neg_hits"))
    every = Window.partitionBy()
    w = F.ln(((F.col("pos_hits") + 0.5) / (F.sum("pos_hits").over(every) + 1)) / ((F.col("neg_hits") + 0.5) / (F.sum("neg_hits").over(every) + 1)))
    note = F.when(F.col("pos_hits") + F.col("neg_hits") < 30, "refused").when((F.col("pos_hits") == 0) | (F.col("neg_hits") == 0), "bound").otherwise("")
    return f.select("key", "pos_hits", "neg_hits", F.round(w, 6).alias("weight"), note.alias("note"))


BIN = "CASE WHEN p < 0.1 THEN 0 WHEN p < 0.3 THEN 1 WHEN p < 0.4 THEN 2 WHEN p < 0.65 THEN 3 WHEN p < 0.9 THEN 4 ELSE 5 END"


@query("WITH " + PANEL + f" SELECT {BIN} AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM pn GROUP BY 1")
def calibration_bins(spark, d):
    """Reliability by bins of the predicted probability."""
    p = F.col("p")
    b = F.when(p < 0.1, 0).when(p < 0.3, 1).when(p < 0.4, 2).when(p < 0.65, 3).when(p < 0.9, 4).otherwise(5)
    return _panel(spark, d).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("p"), 6).alias("mean_p"), F.round(F.avg(F.col("y").cast("double")), 6).alias("rate"))


@query("WITH " + PANEL + f"""
, b AS (SELECT {BIN} AS bin, count(*) AS n, avg(p) AS mp, avg(CAST(y AS DOUBLE)) AS r FROM pn GROUP BY 1)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier, (SELECT round(sum(n * abs(mp - r)) / sum(n), 6) FROM b) AS ece FROM pn""")
def calibration_metrics(spark, d):
    """Log-loss, Brier score and expected calibration error."""
    t, p, y = _panel(spark, d), F.col("p"), F.col("y")
    m = t.agg(F.round(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))), 6).alias("log_loss"), F.round(F.avg((p - y) * (p - y)), 6).alias("brier"))
    b = F.when(p < 0.1, 0).when(p < 0.3, 1).when(p < 0.4, 2).when(p < 0.65, 3).when(p < 0.9, 4).otherwise(5)
    e = t.groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.avg("p").alias("mp"), F.avg(y.cast("double")).alias("r")).agg(F.round(F.sum(F.col("n") * F.abs(F.col("mp") - F.col("r"))) / F.sum("n"), 6).alias("ece"))
    return m.join(F.broadcast(e))


@query("WITH " + PANEL + """
, g AS (SELECT lang, count(*) AS n, CAST(sum(y) AS BIGINT) AS k FROM pn GROUP BY 1), q AS (SELECT *, k / n AS p FROM g)
SELECT lang, k, n, round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n), 6) AS lo, round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n), 6) AS hi FROM q""")
def wilson_intervals(spark, d):
    """Wilson score intervals."""
    g = _panel(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("k"))
    lo, hi = wilson(F.col("k"), F.col("n"))
    return g.select("lang", "k", "n", F.round(lo, 6).alias("lo"), F.round(hi, 6).alias("hi"))


@query(with_sql(ACT) + """
, n AS (SELECT topic, other_subtopic AS sub, count(*) AS n FROM act GROUP BY 1, 2), t AS (SELECT topic, sum(n) AS nt FROM n GROUP BY 1), s AS (SELECT sub, sum(n) / (SELECT count(*) FROM act) AS share FROM n GROUP BY 1)
SELECT n.topic, n.sub, round(((n + 10 * share) / (nt + 10)) / share, 6) AS lift, round((((n - 1) + 10 * share) / (nt - 1 + 10)) / share, 6) AS loo_lift FROM n JOIN t ON n.topic = t.topic JOIN s ON n.sub = s.sub""")
def shrunk_lift(spark, d):
    """Lift shrunk toward one, and with one row left out."""
    n = activities(spark, d).groupBy("topic", F.col("other_subtopic").alias("sub")).agg(F.count("*").alias("n"))
    by_topic, by_sub = n.groupBy("topic").agg(F.sum("n").alias("nt")), n.groupBy("sub").agg(F.sum("n").alias("ns"))
    n = n.join(by_topic, "topic").join(by_sub, "sub").join(F.broadcast(n.agg(F.sum("n").alias("all")))).withColumn("share", F.col("ns") / F.col("all"))  # one row
    s = F.col("share")
    return n.select("topic", "sub", F.round(((F.col("n") + 10 * s) / (F.col("nt") + 10)) / s, 6).alias("lift"), F.round(((F.col("n") - 1 + 10 * s) / (F.col("nt") - 1 + 10)) / s, 6).alias("loo_lift"))


@query(with_sql(ACT) + """
, v AS (SELECT person, sum(score) AS a, sum(impact) AS b FROM act GROUP BY 1), w AS (SELECT round(a, 6) AS a, round(b, 6) AS b FROM v),
r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM w)
SELECT count(*) AS n, round(corr(CAST(ra AS DOUBLE), CAST(rb AS DOUBLE)), 6) AS rho FROM r""")
def spearman(spark, d):
    """Rank correlation, ties averaged."""
    v = activities(spark, d).groupBy("person").agg(F.round(F.sum("score"), 6).alias("a"), F.round(F.sum("impact"), 6).alias("b"))
    r = average_ranks(average_ranks(v, "a", name="ra"), "b", name="rb")
    return r.agg(F.count("*").alias("n"), F.round(F.corr("ra", "rb"), 6).alias("rho"))


RANKED = """, g AS (SELECT pmid AS q, person, max(score) AS score, max(CASE WHEN live AND position <> 'middle' THEN 2 WHEN live THEN 1 ELSE 0 END) AS rel FROM act GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, person) AS i, row_number() OVER (PARTITION BY q ORDER BY rel DESC, person) AS j FROM g)"""


def _ranked(spark, d):
    a = activities(spark, d)
    rel = F.max(F.when(F.col("live") & (F.col("position") != "middle"), 2).when(F.col("live"), 1).otherwise(0))
    g = a.groupBy(F.col("pmid").alias("q"), "person").agg(F.max("score").alias("score"), rel.alias("rel"))
    w = Window.partitionBy("q")
    return g.withColumns({"i": F.row_number().over(w.orderBy(F.col("score").desc(), "person")), "j": F.row_number().over(w.orderBy(F.col("rel").desc(), "person"))})


@query(with_sql(ACT) + RANKED + """, s AS (SELECT q, sum(CASE WHEN i <= 3 THEN (power(2, rel) - 1) / log2(i + 1) ELSE 0 END) AS dcg, sum(CASE WHEN j <= 3 THEN (power(2, rel) - 1) / log2(j + 1) ELSE 0 END) AS ideal, sum(CASE WHEN i <= 3 AND rel >= 1 THEN 1 ELSE 0 END) / 3.0 AS p3 FROM r GROUP BY 1)
SELECT q, round(CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0 END, 6) AS ndcg, round(p3, 6) AS p_at_3 FROM s""")
def ndcg(spark, d):
    """Normalised discounted gain and precision of the first three."""
    gain = lambda r: F.sum(F.when(F.col(r) <= 3, (F.pow(F.lit(2.0), F.col("rel")) - 1) / F.log2(F.col(r) + 1)).otherwise(0.0))
    s = _ranked(spark, d).groupBy("q").agg(gain("i").alias("dcg"), gain("j").alias("ideal"), (F.sum(F.when((F.col("i") <= 3) & (F.col("rel") >= 1), 1).otherwise(0)) / 3).alias("p3"))
    return s.select("q", F.round(F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0), 6).alias("ndcg"), F.round("p3", 6).alias("p_at_3"))


@query(with_sql(ACT) + RANKED + """, f AS (SELECT q, min(CASE WHEN rel = 2 THEN i END) AS first, count(CASE WHEN rel >= 1 AND i <= 3 THEN 1 END) AS hit, count(CASE WHEN rel >= 1 THEN 1 END) AS all_ FROM r GROUP BY 1)
SELECT count(*) AS queries, round(avg(CASE WHEN first IS NULL THEN 0 ELSE 1.0 / first END), 6) AS mrr, round(avg(CASE WHEN all_ > 0 THEN CAST(hit AS DOUBLE) / all_ END), 6) AS recall FROM f""")
def mrr_recall(spark, d):
    """Mean reciprocal rank and recall of the first three."""
    f = _ranked(spark, d).groupBy("q").agg(F.min(F.when(F.col("rel") == 2, F.col("i"))).alias("first"), F.count(F.when((F.col("rel") >= 1) & (F.col("i") <= 3), 1)).alias("hit"), F.count(F.when(F.col("rel") >= 1, 1)).alias("n"))
    return f.agg(F.count("*").alias("queries"), F.round(F.avg(F.when(F.col("first").isNull(), 0.0).otherwise(1.0 / F.col("first"))), 6).alias("mrr"), F.round(F.avg(F.when(F.col("n") > 0, F.col("hit") / F.col("n"))), 6).alias("recall"))


@query("WITH " + PANEL + f"""
, t AS (SELECT count(CASE WHEN y = 1 THEN 1 END) AS pn, count(CASE WHEN y = 0 THEN 1 END) AS nn FROM pn), h AS (SELECT {BIN} AS x, count(CASE WHEN y = 1 THEN 1 END) AS ph, count(CASE WHEN y = 0 THEN 1 END) AS nh FROM pn GROUP BY 1),
b AS (SELECT x, ln(((ph + 0.5) / (t.pn + 1.0)) / ((nh + 0.5) / (t.nn + 1.0))) AS y, 1 / (1 / (ph + 0.5) + 1 / (nh + 0.5)) AS w FROM h, t), m AS (SELECT sum(w) AS sw, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM b),
l AS (SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope FROM b, m)
SELECT round(slope, 6) AS slope, round(my - slope * mx, 6) AS base, round(1 - (SELECT sum(w * power(y - (my - slope * mx + slope * x), 2)) FROM b) / (SELECT sum(w * power(y - my, 2)) FROM b), 6) AS r2 FROM l, m""")
def weighted_line(spark, d):
    """A line through binned weights of evidence, weighted by the inverse of their variances, and its weighted R squared."""
    p = F.col("p")
    x = F.when(p < 0.1, 0).when(p < 0.3, 1).when(p < 0.4, 2).when(p < 0.65, 3).when(p < 0.9, 4).otherwise(5)
    h = _panel(spark, d).groupBy(x.alias("x")).agg(F.count(F.when(F.col("y") == 1, 1)).alias("ph"), F.count(F.when(F.col("y") == 0, 1)).alias("nh"))
    return evidence_line(h)


def _scored(spark, d):
    return _panel(spark, d).select("doc_id", F.ln(F.col("p") / (1 - F.col("p"))).alias("z"), F.col("y").cast("double").alias("y"), F.col("p"), F.ln(1 + F.col("n_chars")).alias("size"), (F.col("lang") == "en").cast("double").alias("en"))


@query()
def platt_fit(spark, d):
    """Two-parameter logistic calibration; only the sums of each Newton step reach the driver."""
    a, b = logistic_fit(_scored(spark, d), ["z"], "y", ridge=0.01)
    return spark.createDataFrame([(round(a, 6), round(b, 6))], "intercept double, slope double")


@query()
def offset_fit(spark, d):
    """The shift of the logit that calibrates best, the slope held at one."""
    (a,) = logistic_fit(_scored(spark, d), [], "y", offset="z")
    return spark.createDataFrame([(round(a, 6),)], "shift double")


@query()
def joint_fit(spark, d):
    """Logistic regression on standardised features; the penalty is chosen by log-loss over folds, all fits in one aggregation a step."""
    chosen, weights = joint_logistic(_scored(spark, d), ["z", "size", "en"], "y", "doc_id")
    return spark.createDataFrame([(chosen, *[round(w, 6) for w in weights])], "c double, intercept double, z double, size double, en double")


@query()
def held_out_losses(spark, d):
    """Log-loss of each calibration on folds that it was not fitted on: raw score, shift, line."""
    return cross_fitted(_scored(spark, d), "z", "y", "doc_id")


@query()
def bootstrap_ci(spark, d):
    """Percentile intervals of a rate, and, over the same replicates, of the difference of two scores' log-losses.

    Poisson bootstrap: a row's weight in a replicate comes from a hash, so that replicates are one aggregation and the
    difference is paired.
    """
    t = _panel(spark, d)
    base = t.agg(F.avg(F.col("y").cast("double")).alias("base"))  # one row
    loss = lambda p: -(F.col("y") * F.ln(p) + (1 - F.col("y")) * F.ln(1 - p))
    t = t.join(F.broadcast(base)).withColumns({"a": loss(F.col("p")), "b": loss(F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("base"))))})
    m = replicates(t, "doc_id", {"rate": F.col("y"), "gain": F.col("a") - F.col("b")}, 200)
    q = lambda c, at: F.round(F.percentile(c, at), 6)
    return m.agg(q("rate", 0.025).alias("lo"), q("rate", 0.5).alias("mid"), q("rate", 0.975).alias("hi"), q("gain", 0.025).alias("gain_lo"), q("gain", 0.975).alias("gain_hi"))


@query("WITH " + PANEL + """
, v AS (SELECT doc_id, lang, n_chars, n_chars / max(n_chars) OVER (PARTITION BY lang) AS v FROM pn)
SELECT doc_id, round(greatest(v, 0), 4) AS norm FROM v WHERE round(greatest(v, 0), 4) >= 0.1""")
def pool_max_norm(spark, d):
    """Scores over their pool's maximum, from a floor on."""
    v = F.round(F.greatest(F.col("n_chars") / F.max("n_chars").over(Window.partitionBy("lang")), F.lit(0.0)), 4)
    return _panel(spark, d).select("doc_id", v.alias("norm")).where("norm >= 0.1")


@query("WITH " + PANEL + " SELECT lang, count(*) AS n, round(avg(CASE WHEN (n_chars > 400) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS agree, count(CASE WHEN n_chars > 400 AND y = 0 THEN 1 END) AS only_a, count(CASE WHEN n_chars <= 400 AND y = 1 THEN 1 END) AS only_b FROM pn GROUP BY 1")
def ab_agreement(spark, d):
    """Two classifiers compared by group."""
    a, y = F.col("n_chars") > 400, F.col("y") == 1
    return _panel(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg((a == y).cast("double")), 6).alias("agree"), F.count(F.when(a & ~y, 1)).alias("only_a"), F.count(F.when(~a & y, 1)).alias("only_b"))


@query("""WITH g(c, t) AS (VALUES (0.05, 0.3), (0.05, 0.5), (0.2, 0.3), (0.2, 0.5)), """ + PANEL + """
SELECT c, t, count(CASE WHEN p >= t THEN 1 END) AS hi, count(CASE WHEN p >= c AND p < t THEN 1 END) AS mid FROM g, pn GROUP BY 1, 2""")
def threshold_sweep(spark, d):
    """Band counts over a fixed grid of thresholds."""
    grid = [(0.05, 0.3), (0.05, 0.5), (0.2, 0.3), (0.2, 0.5)]
    g = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(t).alias("t")) for c, t in grid]))
    rows = _panel(spark, d).select("p", g.alias("g")).select("p", "g.c", "g.t")
    return rows.groupBy("c", "t").agg(F.count(F.when(F.col("p") >= F.col("t"), 1)).alias("hi"), F.count(F.when((F.col("p") >= F.col("c")) & (F.col("p") < F.col("t")), 1)).alias("mid"))


#: Queries by category: topics by their number; each expects some people, two rankings answer.
CATEGORIES = ("topic_match", "topic_decompose", "gap_query", "team_assembly")


@query(with_sql(ACT) + """
, q AS (SELECT topic, person, count(*) AS n, round(sum(score), 6) AS s, bool_or(position = 'first' AND score >= 0.9) AS expected FROM act GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY n DESC, person) AS i, row_number() OVER (PARTITION BY topic ORDER BY s DESC, person) AS j FROM q),
m AS (SELECT topic, ['topic_match', 'topic_decompose', 'gap_query', 'team_assembly'][1 + CAST(split_part(topic, '#', 2) AS INTEGER) % 4] AS category, coalesce(1.0 / min(CASE WHEN expected THEN i END), 0) AS bm, coalesce(1.0 / min(CASE WHEN expected THEN j END), 0) AS hm,
 CASE WHEN bool_or(expected) THEN count(CASE WHEN expected AND i <= 10 THEN 1 END) / count(CASE WHEN expected THEN 1 END) ELSE 0 END AS br, CASE WHEN bool_or(expected) THEN count(CASE WHEN expected AND j <= 10 THEN 1 END) / count(CASE WHEN expected THEN 1 END) ELSE 0 END AS hr FROM r GROUP BY 1),
z AS (SELECT category, CASE WHEN category = 'topic_decompose' THEN 0 ELSE bm END AS bm, CASE WHEN category = 'topic_decompose' THEN 0 ELSE hm END AS hm, CASE WHEN category = 'topic_decompose' THEN 0 ELSE br END AS br, CASE WHEN category = 'topic_decompose' THEN 0 ELSE hr END AS hr FROM m),
c AS (SELECT category, count(*) AS queries, avg(bm) AS bm, avg(hm) AS hm, avg(br) AS br, avg(hr) AS hr FROM z GROUP BY 1)
SELECT category, queries, round(bm, 4) AS baseline_mrr, round(hm, 4) AS mrr, round(br, 4) AS baseline_recall, round(hr, 4) AS recall, CASE WHEN category = 'topic_decompose' OR (hm >= bm - 1e-12 AND hr >= br - 1e-12) THEN 'PASS' ELSE 'FAIL' END AS status FROM c""")
def metric_diff(spark, d):
    """Reciprocal rank and recall of the first ten by category of query, of two rankings; a category whose answers have no
    order passes always."""
    q = activities(spark, d).groupBy("topic", "person").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("s"), F.bool_or((F.col("position") == "first") & (F.col("score") >= 0.9)).alias("expected"))
    w = Window.partitionBy("topic")
    r = q.withColumns({"i": F.row_number().over(w.orderBy(F.col("n").desc(), "person")), "j": F.row_number().over(w.orderBy(F.col("s").desc(), "person"))})
    number = F.regexp_extract("topic", "#([0-9]+)", 1).cast("int")
    category = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), number % 4)
    hit = lambda at: F.try_divide(F.count(F.when(F.col("expected") & (F.col(at) <= 10), 1)), F.count(F.when(F.col("expected"), 1)))
    first = lambda at: 1.0 / F.min(F.when(F.col("expected"), F.col(at)))
    m = r.groupBy("topic").agg(*[F.coalesce(f(at), F.lit(0.0)).alias(n) for n, f, at in (("bm", first, "i"), ("hm", first, "j"), ("br", hit, "i"), ("hr", hit, "j"))]).withColumn("category", category)
    ordered = F.col("category") != "topic_decompose"
    c = m.groupBy("category").agg(F.count("*").alias("queries"), *[F.avg(F.when(ordered, F.col(x)).otherwise(0.0)).alias(x) for x in ("bm", "hm", "br", "hr")])
    better = (F.col("hm") >= F.col("bm") - 1e-12) & (F.col("hr") >= F.col("br") - 1e-12)
    return c.select("category", "queries", F.round("bm", 4).alias("baseline_mrr"), F.round("hm", 4).alias("mrr"), F.round("br", 4).alias("baseline_recall"), F.round("hr", 4).alias("recall"), F.when(~ordered | better, "PASS").otherwise("FAIL").alias("status"))
