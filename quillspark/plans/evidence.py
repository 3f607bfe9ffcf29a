"""Evidence scoring, repeat-user affinity, salience, prestige and opportunity gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.scores import PRIOR_LOGIT, abstaining_mean, band, log_bucket, noisy_or, sigmoid
from quillspark.operators.ranking import top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, PUB, activities, publications, with_sql
from quillspark.sources.tables import table

#: Prior strength, evidence weights and thresholds (fixed values).
STRENGTH = 5.0
WEIGHTS = {
    "ack": 6.37, "ack.spec:distinctive": 4.35, "ack.spec:moderate": 1.90, "ack.spec:generic": -5.07, "inst:home": 3.47, "inst:other": -3.62,
    "inst:none@moderate": -0.57, "inst:none@generic": -4.01, "staff": 4.89, "aff:trace": 1.18, "aff:regular": 3.49, "aff:core": 3.49,
}
LLM_BASE, LLM_POINT, LLM_MAX = -1.86, 0.68, 9
TRIAGE, CONFIRM = 0.30, 0.65

AFF = """, c AS (SELECT DISTINCT person, topic AS core, pmid FROM act WHERE score >= 0.8), tot AS (SELECT person, count(DISTINCT pmid) AS total FROM act GROUP BY 1),
n AS (SELECT person, core, count(*) AS n FROM c GROUP BY 1, 2), p0 AS (SELECT core, count(DISTINCT pmid) / (SELECT count(DISTINCT pmid) FROM act) AS p0 FROM c GROUP BY 1),
pair AS (SELECT DISTINCT a.pmid, a.person, b.core FROM act a JOIN n b ON a.person = b.person WHERE a.line <= 2),
r AS (SELECT pair.pmid, pair.person, pair.core, n.n - CASE WHEN c.pmid IS NULL THEN 0 ELSE 1 END AS k, total, p0 FROM pair JOIN n ON pair.person = n.person AND pair.core = n.core JOIN tot ON pair.person = tot.person JOIN p0 ON pair.core = p0.core
  LEFT JOIN c ON c.person = pair.person AND c.core = pair.core AND c.pmid = pair.pmid),
rate AS (SELECT pmid, person, core, CASE WHEN k <= 0 THEN 0.0 ELSE least((k + 5.0 * p0) / (total + 5.0), 1.0) END AS rate FROM r)"""


def _rates(spark, d):
    """(pmid, person, core, rate): each author's rate for a core, the scored paper left out of the numerator only."""
    a = activities(spark, d)
    c = a.where("score >= 0.8").select("person", F.col("topic").alias("core"), "pmid").distinct()
    total = a.groupBy("person").agg(F.countDistinct("pmid").alias("total"))
    corpus = a.agg(F.countDistinct("pmid").alias("all"))
    n = c.groupBy("person", "core").agg(F.count("*").alias("n"))
    p0 = c.groupBy("core").agg(F.countDistinct("pmid").alias("m")).join(F.broadcast(corpus)).select("core", (F.col("m") / F.col("all")).alias("p0"))
    pair = a.where("line <= 2").select("pmid", "person").distinct().join(n, "person").join(total, "person").join(p0, "core")
    own = c.withColumn("own", F.lit(1))
    k = F.col("n") - F.coalesce("own", F.lit(0))
    return pair.join(own, ["person", "core", "pmid"], "left").select("pmid", "person", "core", F.when(k <= 0, F.lit(0.0)).otherwise(F.least((k + STRENGTH * F.col("p0")) / (F.col("total") + STRENGTH), F.lit(1.0))).alias("rate"))


@query(with_sql(ACT) + AFF + "SELECT pmid, person, core, round(rate, 6) AS rate FROM rate")
def affinity_rate(spark, d):
    """Repeat-user rates of each paper's authors, zero rates too."""
    return _rates(spark, d).withColumn("rate", F.round("rate", 6))


@query(with_sql(ACT) + AFF + "SELECT pmid, core, round(max(rate), 6) AS affinity FROM rate GROUP BY 1, 2 HAVING round(max(rate), 6) >= 0.03")
def paper_affinity(spark, d):
    """A paper's affinity for a core: the largest rate over its byline."""
    return _rates(spark, d).groupBy("pmid", "core").agg(F.round(F.max("rate"), 6).alias("affinity")).where("affinity >= 0.03")


SIG = """, sig AS (SELECT pmid, topic AS core, line, line <= 3 AS ack, CAST(round(impact * 12) AS INTEGER) AS hits, CASE WHEN line = 1 THEN 'home' WHEN line = 2 THEN 'other' ELSE 'none' END AS inst,
  person % 9 = 0 AS staff, CASE WHEN score > 0.3 THEN score ELSE 0 END AS aff, CASE WHEN person % 4 = 0 THEN NULL ELSE CAST(1 + person % 10 AS INTEGER) END AS llm FROM act),
ft AS (SELECT *, CASE WHEN hits <= 100 THEN 'distinctive' WHEN hits < 800 THEN 'moderate' ELSE 'generic' END AS spec, CASE WHEN aff >= 0.7 THEN 'core' WHEN aff >= 0.05 THEN 'regular' ELSE 'trace' END AS ab FROM sig),
w AS (SELECT *, CASE WHEN ack THEN 6.37 + CASE spec WHEN 'distinctive' THEN 4.35 WHEN 'moderate' THEN 1.90 ELSE -5.07 END + CASE WHEN inst = 'home' THEN 3.47 WHEN inst = 'other' THEN -3.62 WHEN spec = 'moderate' THEN -0.57 WHEN spec = 'generic' THEN -4.01 ELSE 0 END ELSE 0 END AS wa,
  CASE WHEN staff THEN 4.89 ELSE 0 END AS ws, CASE WHEN aff > 0 THEN CASE ab WHEN 'trace' THEN 1.18 ELSE 3.49 END ELSE 0 END AS wf, CASE WHEN llm IS NULL THEN 0 ELSE -1.86 + 0.68 * least(llm, 9) END AS wl FROM ft),
p AS (SELECT *, 1 / (1 + exp(-(ln(0.02 / 0.98) + wa + ws + wf + wl))) AS like_all, 1 / (1 + exp(-(ln(0.02 / 0.98) + CASE WHEN inst = 'other' THEN 0 ELSE wa END + CASE WHEN ack AND inst <> 'other' THEN ws ELSE 0 END + wf))) AS like_held FROM w),
st AS (SELECT *, CASE WHEN wf <> 0 AND wa = 0 AND ws = 0 AND wl = 0 THEN 'below' WHEN like_all >= 0.65 THEN CASE WHEN like_held < 0.65 THEN 'candidate' ELSE 'confirmed' END WHEN like_all >= 0.30 THEN 'candidate' ELSE 'below' END AS status FROM p)"""


def _signals(spark, d):
    """Evidence of each (publication, core): keys, the sums of their weights by family, likelihoods and status."""
    a = activities(spark, d)
    aff = F.when(F.col("score") > 0.3, F.col("score")).otherwise(0.0)
    hits = F.round(F.col("impact") * 12).cast("int")
    s = a.select(
        "pmid", F.col("topic").alias("core"), "line", (F.col("line") <= 3).alias("ack"), F.when(hits <= 100, "distinctive").when(hits < 800, "moderate").otherwise("generic").alias("spec"),
        F.when(F.col("line") == 1, "home").when(F.col("line") == 2, "other").otherwise("none").alias("inst"), (F.col("person") % 9 == 0).alias("staff"), aff.alias("aff"),
        F.when(F.col("person") % 4 != 0, (1 + F.col("person") % 10).cast("int")).alias("llm"),
    )
    bucket = band(F.col("aff"), (0.70, "core"), (0.05, "regular"), low="trace")
    ack_keys = F.when(F.col("ack"), F.array(F.lit("ack"), F.concat(F.lit("ack.spec:"), "spec"), F.when(F.col("inst") == "none", F.concat(F.lit("inst:none@"), "spec")).otherwise(F.concat(F.lit("inst:"), "inst")))).otherwise(F.array().cast("array<string>"))
    keys = F.concat(ack_keys, F.array_compact(F.array(F.when(F.col("staff"), "staff"), F.when(F.col("aff") > 0, F.concat(F.lit("aff:"), bucket)))))
    table_ = F.create_map(*[x for k, v in WEIGHTS.items() for x in (F.lit(k), F.lit(v))])
    weigh = lambda prefix: F.aggregate(F.filter("keys", prefix), F.lit(0.0), lambda t, k: t + F.coalesce(F.element_at(table_, k), F.lit(0.0)))
    s = s.withColumn("keys", keys)
    s = s.withColumns({"wa": weigh(lambda k: k.startswith("ack") | k.startswith("inst")), "ws": weigh(lambda k: k == "staff"), "wf": weigh(lambda k: k.startswith("aff")), "wl": F.when(F.col("llm").isNull(), 0.0).otherwise(LLM_BASE + LLM_POINT * F.least("llm", F.lit(LLM_MAX)))})
    other = F.col("inst") == "other"
    held = PRIOR_LOGIT + F.when(other, 0.0).otherwise(F.col("wa")) + F.when(F.col("ack") & ~other, F.col("ws")).otherwise(0.0) + F.col("wf")
    s = s.withColumns({"like_all": sigmoid(PRIOR_LOGIT + F.col("wa") + F.col("ws") + F.col("wf") + F.col("wl")), "like_held": sigmoid(held)})
    alone = (F.col("wf") != 0) & (F.col("wa") == 0) & (F.col("ws") == 0) & (F.col("wl") == 0)
    status = F.when(alone, "below").when(F.col("like_all") >= CONFIRM, F.when(F.col("like_held") < CONFIRM, "candidate").otherwise("confirmed")).when(F.col("like_all") >= TRIAGE, "candidate").otherwise("below")
    return s.withColumn("status", status)


@query(with_sql(ACT) + SIG + " SELECT pmid, core, line, round(wa + ws + wf + wl, 6) AS evidence, round(like_all, 4) AS likelihood FROM st")
def evidence_score(spark, d):
    """Sum of evidence weights and the likelihood."""
    return _signals(spark, d).select("pmid", "core", "line", F.round(F.col("wa") + F.col("ws") + F.col("wf") + F.col("wl"), 6).alias("evidence"), F.round("like_all", 4).alias("likelihood"))


@query(with_sql(ACT) + SIG + " SELECT core, status, count(*) AS n FROM st GROUP BY 1, 2")
def status_bands(spark, d):
    """Statuses, with the hold for decisive votes and affinity alone."""
    return _signals(spark, d).groupBy("core", "status").agg(F.count("*").alias("n"))


@query(with_sql(ACT) + SIG + """
SELECT core, count(CASE WHEN like_all >= 0.65 THEN 1 END) AS high, count(CASE WHEN like_all >= 0.65 AND 1 / (1 + exp(-(ln(0.02 / 0.98) + ws + wf + wl))) < 0.65 THEN 1 END) AS by_ack,
 count(CASE WHEN like_all >= 0.65 AND 1 / (1 + exp(-(ln(0.02 / 0.98) + wa + wf + wl))) < 0.65 THEN 1 END) AS by_staff, count(CASE WHEN like_all >= 0.65 AND 1 / (1 + exp(-(ln(0.02 / 0.98) + wa + ws + wl))) < 0.65 THEN 1 END) AS by_affinity FROM st GROUP BY 1""")
def signal_report(spark, d):
    """Which family of evidence a high score rests on: scores with each family knocked out."""
    s = _signals(spark, d).withColumn("high", F.col("like_all") >= CONFIRM)
    falls = lambda w: F.count(F.when(F.col("high") & (sigmoid(PRIOR_LOGIT + F.col("wa") + F.col("ws") + F.col("wf") + F.col("wl") - F.col(w)) < CONFIRM), 1))
    return s.groupBy("core").agg(F.count(F.when(F.col("high"), 1)).alias("high"), falls("wa").alias("by_ack"), falls("ws").alias("by_staff"), falls("wf").alias("by_affinity"))


@query(with_sql(ACT) + """
, was AS (SELECT DISTINCT topic, pmid FROM act WHERE score >= 0.5), now AS (SELECT DISTINCT topic, pmid FROM act WHERE score >= 0.6),
s AS (SELECT w.topic, count(*) AS before, count(CASE WHEN n.pmid IS NULL THEN 1 END) AS stale FROM was w LEFT JOIN now n ON w.topic = n.topic AND w.pmid = n.pmid GROUP BY 1)
SELECT topic, before, stale, stale / before <= 0.5 AS demote FROM s""")
def stale_demotion(spark, d):
    """Rows surfaced before and not now; refused if too large a share would go."""
    a = activities(spark, d)
    was, now = a.where("score >= 0.5").select("topic", "pmid").distinct(), a.where("score >= 0.6").select("topic", "pmid").distinct().withColumn("n", F.lit(1))
    s = was.join(now, ["topic", "pmid"], "left").groupBy("topic").agg(F.count("*").alias("before"), F.count(F.when(F.col("n").isNull(), 1)).alias("stale"))
    return s.withColumn("demote", F.col("stale") / F.col("before") <= 0.5)


@query(with_sql(ACT) + """
, t AS (SELECT pmid, bool_or(line = 1 AND score > 0.5) AS a, bool_or(topic LIKE 'Brand#1%') AS m FROM act GROUP BY 1)
SELECT pmid, round(1 - (1 - CASE WHEN a THEN 0.6 ELSE 0 END) * (1 - CASE WHEN m THEN 0.4 ELSE 0 END), 6) AS prior FROM t WHERE a OR m""")
def soft_priors(spark, d):
    """Priors of two prefilters, joined by noisy or."""
    t = activities(spark, d).groupBy("pmid").agg(F.bool_or((F.col("line") == 1) & (F.col("score") > 0.5)).alias("a"), F.bool_or(F.col("topic").startswith("Brand#1")).alias("m"))
    return t.where("a or m").select("pmid", F.round(noisy_or(F.when(F.col("a"), 0.6), F.when(F.col("m"), 0.4)), 6).alias("prior"))


@query("""
WITH t AS (SELECT p_partkey AS tool, p_name AS name, p_size > 45 AS rrid, count(DISTINCT l_orderkey) AS pubs, count(DISTINCT l_suppkey % 20) AS spread FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2, 3),
q AS (SELECT spread, row_number() OVER (ORDER BY spread, tool) AS rn, count(*) OVER () AS n FROM t WHERE spread >= 2),
c AS (SELECT greatest(max(CASE WHEN rn = least(CAST(floor(n * 0.88) AS BIGINT), n - 1) + 1 THEN spread END), 2) AS cut FROM q)
SELECT tool, pubs, spread, CASE WHEN ' ' || name || ' ' LIKE '% red %' THEN 'C' WHEN cut IS NOT NULL AND spread >= cut THEN 'S' WHEN rrid OR pubs >= 3 OR spread >= 2 THEN 'A' ELSE 'B' END AS tier FROM t, c""")
def salience_tiers(spark, d):
    """Tiers by spread, with the cut at an exact position of the sorted spreads, taken from counts by spread."""
    from pyspark.sql import Window

    p = table(spark, d, "part").select(F.col("p_partkey").alias("tool"), "p_name", (F.col("p_size") > 45).alias("rrid"))
    use = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("tool")).agg(F.countDistinct("l_orderkey").alias("pubs"), F.countDistinct(F.col("l_suppkey") % 20).alias("spread"))
    t = p.join(use, "tool", "left").na.fill(0, ["pubs", "spread"])
    q = t.where("spread >= 2").groupBy("spread").agg(F.count("*").alias("c"))
    upto, all_ = Window.orderBy("spread"), Window.partitionBy()
    q = q.withColumns({"to": F.sum("c").over(upto), "n": F.sum("c").over(all_)})
    at = F.least(F.floor(F.col("n") * 0.88), F.col("n") - 1) + 1
    cut = q.where(F.col("to") >= at).agg(F.greatest(F.min("spread"), F.lit(2)).alias("cut"))
    tier = F.when(F.concat(F.lit(" "), "p_name", F.lit(" ")).contains(" red "), "C").when(F.col("cut").isNotNull() & (F.col("spread") >= F.col("cut")), "S").when(F.col("rrid") | (F.col("pubs") >= 3) | (F.col("spread") >= 2), "A").otherwise("B")
    return t.join(F.broadcast(cut)).select("tool", "pubs", "spread", tier.alias("tier"))


@query("""
WITH o AS (SELECT p_partkey AS id, CASE CAST(p_partkey % 7 AS INTEGER) WHEN 0 THEN 'R01' WHEN 1 THEN 'R21' WHEN 2 THEN 'K23' WHEN 3 THEN 'DP2' WHEN 4 THEN '' WHEN 5 THEN 'F31' ELSE 'Z99' END AS m, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice * 1000 END AS amt, CASE WHEN p_brand IN ('Brand#11', 'Brand#22') THEN 0.7 WHEN p_brand = 'Brand#33' THEN 0.55 END AS sp FROM part),
v AS (SELECT id, CASE m WHEN 'R01' THEN 0.85 WHEN 'R21' THEN 0.4 WHEN 'K23' THEN 0.7 WHEN 'DP2' THEN 1.0 WHEN 'F31' THEN 0.5 WHEN 'Z99' THEN 0.3 END AS mech, CASE WHEN amt > 0 THEN greatest(0.0, least(1.0, (log10(amt) - 4) / 3)) END AS size, sp FROM o),
s AS (SELECT id, mech, size, sp, CASE WHEN mech IS NULL AND size IS NULL AND sp IS NULL THEN 0.3 ELSE (coalesce(0.4 * mech, 0) + coalesce(0.2 * size, 0) + coalesce(0.4 * sp, 0)) / (CASE WHEN mech IS NULL THEN 0 ELSE 0.4 END + CASE WHEN size IS NULL THEN 0 ELSE 0.2 END + CASE WHEN sp IS NULL THEN 0 ELSE 0.4 END) END AS score0 FROM v), z AS (SELECT id, round(score0, 10) AS score FROM s)
SELECT id, round(score, 4) AS score, CASE WHEN score >= 0.8 THEN 'Flagship' WHEN score >= 0.55 THEN 'Major' ELSE 'Standard' END AS label FROM z""")
def prestige(spark, d):
    """Mechanism, size and sponsor, averaged over what is known; nothing known scores a floor."""
    from quillspark.functions.grants import activity_tier

    k = F.col("p_partkey")
    code = F.element_at(F.array(*[F.lit(x) for x in ("R01", "R21", "K23", "DP2", "", "F31", "Z99")]), (k % 7 + 1).cast("int"))
    amount = F.when(k % 5 != 0, F.col("p_retailprice") * 1000)
    sponsor = F.when(F.col("p_brand").isin("Brand#11", "Brand#22"), 0.7).when(F.col("p_brand") == "Brand#33", 0.55)
    o = table(spark, d, "part").select(k.alias("id"), activity_tier(code).alias("mech"), log_bucket(amount).alias("size"), sponsor.alias("sp"))
    s = o.withColumn("s", F.round(abstaining_mean([(0.4, F.col("mech")), (0.2, F.col("size")), (0.4, F.col("sp"))], 0.3), 10))
    return s.select("id", F.round("s", 4).alias("score"), band(F.col("s"), (0.8, "Flagship"), (0.55, "Major"), low="Standard").alias("label"))


@query("""
WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'Travel award' WHEN o_orderkey % 10 = 0 THEN 'Best Medal' ELSE 'Research on ' || o_orderpriority END AS title, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS due, o_orderstatus AS status FROM orders)
SELECT id, NOT (regexp_matches(lower(title), '\\b(travel|conference|symposium|workshop|registration|poster|prize|medal|lectureship|equipment|instrumentation|membership|subscription)\\b') OR (due <> '' AND status <> 'P' AND due < '1998-01-01')) AS kept,
 CASE WHEN regexp_matches(lower(title), '\\b(travel|conference|symposium|workshop|registration|poster|prize|medal|lectureship|equipment|instrumentation|membership|subscription)\\b') THEN 'excluded type' WHEN due <> '' AND status <> 'P' AND due < '1998-01-01' THEN 'expired deadline' ELSE '' END AS reason FROM o""")
def title_gate(spark, d):
    """Excluded kinds of award, then expired deadlines, with the reason."""
    from quillspark.functions.grants import EXCLUDED_TITLES

    k = F.col("o_orderkey")
    title = F.when(k % 9 == 0, "Travel award").when(k % 10 == 0, "Best Medal").otherwise(F.concat(F.lit("Research on "), "o_orderpriority"))
    due = F.when(k % 4 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    reason = F.when(F.lower(title).rlike(EXCLUDED_TITLES), "excluded type").when((due != "") & (F.col("o_orderstatus") != "P") & (due < "1998-01-01"), "expired deadline").otherwise("")
    return table(spark, d, "orders").select(k.alias("id"), reason.alias("reason")).withColumn("kept", F.col("reason") == "")


@query("""
WITH o AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN ['research grant'] WHEN 1 THEN ['equipment'] WHEN 2 THEN ['equipment', 'fellowship'] WHEN 3 THEN ['other kind'] ELSE CAST([] AS VARCHAR[]) END AS types,
 CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 0 THEN ['United States'] WHEN 1 THEN ['Australia'] WHEN 2 THEN ['no restrictions'] ELSE CAST([] AS VARCHAR[]) END AS geo, CASE WHEN o_orderkey % 3 = 0 THEN ['Australia'] ELSE CAST([] AS VARCHAR[]) END AS loc, o_orderkey % 17 = 0 AS suspended, strftime(o_orderdate, '%Y-%m-%d') AS due FROM orders),
g AS (SELECT *, list_has_any(types, ['research grant', 'fellowship']) AS allowed, list_has_any(types, ['equipment']) AS dropped, list_contains(geo, 'United States') OR (list_contains(geo, 'no restrictions') OR len(geo) = 0) AND len(loc) = 0 AS us FROM o)
SELECT id, CASE WHEN NOT allowed AND dropped THEN 'project_type' WHEN NOT us THEN 'geo_non_us' WHEN suspended THEN 'suspended' WHEN due < '1997-01-01' THEN 'past_deadline' WHEN NOT allowed THEN 'unknown_type' ELSE '' END AS reason FROM g""")
def opportunity_gate(spark, d):
    """Three gates in order: kind, geography, status and deadline; an unknown kind stays, with its reason."""
    from quillspark.functions.grants import opportunity_reason

    k = F.col("o_orderkey")
    lst = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    types = F.when(k % 5 == 0, lst("research grant")).when(k % 5 == 1, lst("equipment")).when(k % 5 == 2, lst("equipment", "fellowship")).when(k % 5 == 3, lst("other kind")).otherwise(lst())
    geo = F.when(k % 4 == 0, lst("United States")).when(k % 4 == 1, lst("Australia")).when(k % 4 == 2, lst("no restrictions")).otherwise(lst())
    loc = F.when(k % 3 == 0, lst("Australia")).otherwise(lst())
    title = F.when(k % 17 == 0, "Award (temporarily suspended)").otherwise("Award")
    due = F.array(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select(k.alias("id"), opportunity_reason(types, geo, loc, title, due, "1997-01-01").alias("reason"))
