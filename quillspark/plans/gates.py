"""Reconciliation, shrink and drift gates, onboarding and fan-out decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions.scores import article_score
from quillspark.operators import gates as G
from quillspark.plans.registry import query
from quillspark.plans.rollups import AS, BOTH
from quillspark.plans.views import ACT, EV, PUB, activities, event_rows, publications, with_sql
from quillspark.sources.tables import table


def _totals(spark, d):
    a, s = activities(spark, d), article_score(F.col("impact"), F.col("score"))
    ex = a.where("primary_subtopic is not null").groupBy(F.col("primary_subtopic").alias("subtopic")).agg(F.round(F.sum(s), 6).alias("exclusive"))
    ids = F.array_distinct(F.array_compact(F.array("primary_subtopic", "other_subtopic")))
    inc = a.withColumn("subtopic", F.explode(ids)).groupBy("subtopic").agg(F.round(F.sum(s), 6).alias("inclusive"))
    return ex, inc


TOT = with_sql(ACT) + f""", ex AS (SELECT primary_subtopic AS subtopic, round(sum({AS}), 6) AS exclusive FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1), inc AS (SELECT subtopic, round(sum({AS}), 6) AS inclusive FROM {BOTH} GROUP BY 1)"""


@query(TOT + " SELECT ex.subtopic, exclusive, inclusive, exclusive <= inclusive + 1e-6 AS ok FROM ex LEFT JOIN inc ON ex.subtopic = inc.subtopic")
def reconcile_excl_incl(spark, d):
    """Exclusive totals never exceed inclusive ones."""
    ex, inc = _totals(spark, d)
    return ex.join(inc, "subtopic", "left").withColumn("ok", F.col("exclusive") <= F.col("inclusive") + 1e-6)


@query(with_sql(ACT) + f""", p AS (SELECT primary_subtopic AS s, round(sum({AS}), 6) AS t FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1), f AS (SELECT s, round(sum(t), 6) AS t FROM (SELECT primary_subtopic AS s, person, sum({AS}) AS t FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT count(*) AS compared, count(CASE WHEN abs(coalesce(p.t, 0) - coalesce(f.t, 0)) > 1e-4 THEN 1 END) AS mismatches FROM p FULL JOIN f ON p.s = f.s""")
def reconcile_map_partition(spark, d):
    """People's map and subtopic partitions hold the same totals."""
    a, s = activities(spark, d).where("primary_subtopic is not null"), article_score(F.col("impact"), F.col("score"))
    p = a.groupBy("primary_subtopic").agg(F.round(F.sum(s), 6).alias("p"))
    f = a.groupBy("primary_subtopic", "person").agg(F.sum(s).alias("t")).groupBy("primary_subtopic").agg(F.round(F.sum("t"), 6).alias("f"))
    return p.join(f, "primary_subtopic", "full").agg(F.count("*").alias("compared"), F.count(F.when(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("f", F.lit(0.0))) > 1e-4, 1)).alias("mismatches"))


@query(with_sql(ACT) + """
, o AS (SELECT topic, count(DISTINCT other_subtopic || primary_subtopic) AS was FROM act WHERE year <= 2000 GROUP BY 1), n AS (SELECT topic, count(DISTINCT other_subtopic || primary_subtopic) AS now FROM act WHERE year <= 1997 GROUP BY 1)
SELECT o.topic, was, coalesce(now, 0) AS now, round(1 - coalesce(now, 0) / was, 6) AS shrink, 1 - coalesce(now, 0) / was <= 0.20 AS ok FROM o LEFT JOIN n ON o.topic = n.topic""")
def shrink_guard(spark, d):
    """A version may not lose more than a fifth of its parts."""
    a = activities(spark, d)
    n = lambda y, name: a.where(F.col("year") <= y).groupBy("topic").agg(F.countDistinct(F.concat("other_subtopic", "primary_subtopic")).alias(name))
    r = n(2000, "was").join(n(1997, "now"), "topic", "left").na.fill(0, ["now"])
    return r.withColumns({"shrink": F.round(1 - F.col("now") / F.col("was"), 6), "ok": 1 - F.col("now") / F.col("was") <= 0.20})


@query(with_sql(EV) + """
, w AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-16' AND ts <= TIMESTAMP '2024-01-30'), u AS (SELECT count(CASE WHEN event_type = 'signup' THEN 1 END) / count(*) AS rate, count(CASE WHEN event_type = 'error' THEN 1 END) AS failures FROM w),
t AS (SELECT k % 20 AS topic, count(*) AS n FROM w WHERE event_type = 'view' GROUP BY 1), m AS (SELECT max(n) AS worst FROM t)
SELECT round(rate, 6) AS uncovered_rate, worst AS low_confidence_max, failures, CASE WHEN rate > 0.25 OR worst > 100 THEN 'ERROR' WHEN rate > 0.03 OR worst > 30 THEN 'WARN' ELSE 'OK' END AS verdict FROM u, m""")
def drift_eval(spark, d):
    """Rates over a trailing fortnight against floors (scaled to this event log)."""
    w = event_rows(spark, d).where("ts >= timestamp '2024-01-16' and ts <= timestamp '2024-01-30'")
    kind = lambda k: F.count(F.when(F.col("event_type") == k, 1))
    u = w.agg((kind("signup") / F.count("*")).alias("rate"), kind("error").alias("failures"))
    m = w.where("event_type = 'view'").groupBy((F.col("k") % 20).alias("topic")).count().agg(F.max("count").alias("worst"))
    verdict = F.when((F.col("rate") > 0.25) | (F.col("worst") > 100), "ERROR").when((F.col("rate") > 0.03) | (F.col("worst") > 30), "WARN").otherwise("OK")
    return u.join(F.broadcast(m)).select(F.round("rate", 6).alias("uncovered_rate"), F.col("worst").alias("low_confidence_max"), "failures", verdict.alias("verdict"))


@query(with_sql(ACT, PUB) + """
, g AS (SELECT a.person, a.pmid, d.doc_id IS NOT NULL AS has_text, l.doc_id IS NOT NULL AS scored, min(a.year) AS year FROM act a LEFT JOIN documents d ON a.pmid = d.doc_id LEFT JOIN labels l ON a.pmid = l.doc_id GROUP BY 1, 2, 3, 4),
s AS (SELECT person, count(CASE WHEN NOT has_text THEN 1 END) AS gap, count(CASE WHEN has_text AND NOT scored THEN 1 END) AS unscored, count(CASE WHEN year >= 2000 THEN 1 END) AS fresh FROM g GROUP BY 1)
SELECT person, gap, unscored, fresh, 10 * unscored + 3 * fresh + gap AS weight, CASE WHEN unscored > 0 THEN 'score' WHEN fresh > 0 THEN 'refresh' WHEN gap > 0 THEN 'enrich' ELSE 'idle' END AS route FROM s""")
def onboarding_detector(spark, d):
    """Per person missing texts, missing scores and fresh papers, their weight and the route they take."""
    docs, labels = table(spark, d, "documents").select(F.col("doc_id").alias("pmid"), F.lit(1).alias("t")), table(spark, d, "labels").select(F.col("doc_id").alias("pmid"), F.lit(1).alias("s"))
    g = activities(spark, d).groupBy("person", "pmid").agg(F.min("year").alias("year")).join(docs, "pmid", "left").join(labels, "pmid", "left")
    s = g.groupBy("person").agg(F.count(F.when(F.col("t").isNull(), 1)).alias("gap"), F.count(F.when(F.col("t").isNotNull() & F.col("s").isNull(), 1)).alias("unscored"), F.count(F.when(F.col("year") >= 2000, 1)).alias("fresh"))
    route = F.when(F.col("unscored") > 0, "score").when(F.col("fresh") > 0, "refresh").when(F.col("gap") > 0, "enrich").otherwise("idle")
    return s.withColumns({"weight": 10 * F.col("unscored") + 3 * F.col("fresh") + F.col("gap"), "route": route})


@query(with_sql(ACT) + """
, dirty AS (SELECT DISTINCT person, topic FROM act WHERE created_at >= TIMESTAMP '2000-06-01'), cov AS (SELECT topic FROM act GROUP BY 1 HAVING avg(score) >= 0.4997)
SELECT person, coalesce(string_agg(CASE WHEN c.topic IS NOT NULL THEN d.topic END, ',' ORDER BY d.topic), '') AS topics, count(CASE WHEN c.topic IS NULL THEN 1 END) AS dropped FROM dirty d LEFT JOIN cov c ON d.topic = c.topic GROUP BY 1""")
def dirty_fanout(spark, d):
    """Topics to assign again for each person, and how many have no draft."""
    a = activities(spark, d)
    cov = a.groupBy("topic").agg(F.avg("score").alias("m")).where("m >= 0.4997").select("topic", F.lit(True).alias("c"))
    rows = a.where("created_at >= timestamp '2000-06-01'").select("person", "topic").distinct().join(cov, "topic", "left")
    return rows.groupBy("person").agg(F.array_join(F.sort_array(F.collect_list(F.when(F.col("c"), F.col("topic")))), ",").alias("topics"), F.count(F.when(F.col("c").isNull(), 1)).alias("dropped"))


@query(with_sql(ACT) + """
, th(topic, cut) AS (VALUES ('Brand#11', 0.7), ('Brand#22', 0.2)), ex(topic) AS (VALUES ('Brand#33'))
SELECT a.topic, coalesce(cut, 0.5) AS threshold, count(CASE WHEN score >= coalesce(cut, 0.5) THEN 1 END) AS shown FROM act a LEFT JOIN th ON a.topic = th.topic WHERE a.topic NOT IN (SELECT topic FROM ex) GROUP BY 1, 2""")
def display_overlay(spark, d):
    """Per-topic display thresholds over a default, excluded topics left out."""
    cut = F.when(F.col("topic") == "Brand#11", 0.7).when(F.col("topic") == "Brand#22", 0.2).otherwise(0.5)
    a = activities(spark, d).where(~F.col("topic").isin("Brand#33")).withColumn("threshold", cut)
    return a.groupBy("topic", "threshold").agg(F.count(F.when(F.col("score") >= F.col("threshold"), 1)).alias("shown"))


@query(with_sql(EV) + """
, q AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN 'pending' WHEN k < 5 THEN 'taxonomy changed' WHEN k < 10 THEN 'prompt changed' WHEN k < 12 THEN 'subarea changed' WHEN event_type = 'error' AND value > 20 THEN 'failed again' END AS reason FROM ev),
o AS (SELECT *, CASE reason WHEN 'pending' THEN 0 WHEN 'taxonomy changed' THEN 1 WHEN 'prompt changed' THEN 2 WHEN 'subarea changed' THEN 3 ELSE 4 END AS p FROM q WHERE reason IS NOT NULL)
SELECT event_id, reason, p AS priority FROM o""")
def due_items(spark, d):
    """Why each due item is due, and its priority; new ones first."""
    k, kind = F.col("k"), F.col("event_type")
    reason = F.when(kind == "signup", "pending").when(k < 5, "taxonomy changed").when(k < 10, "prompt changed").when(k < 12, "subarea changed").when((kind == "error") & (F.col("value") > 20), "failed again")
    place = F.array_position(F.array(*[F.lit(x) for x in ("pending", "taxonomy changed", "prompt changed", "subarea changed", "failed again")]), F.col("reason"))
    due = event_rows(spark, d).select("event_id", reason.alias("reason")).where("reason is not null")
    return due.withColumn("priority", (place - 1).cast("int")).orderBy("priority", "event_id")


@G.gate("publish", "block", "no_blank_subtopic")
def _no_blank(acts, pubs):
    return acts.where("other_subtopic = ''").select(F.col("pmid").alias("item"))


@G.gate("publish", "block", "score_range")
def _range(acts, pubs):
    return acts.where("score < 0 or score > 1 or impact < 0 or impact > 100").select(F.col("pmid").alias("item"))


@G.gate("publish", "warn", "null_primary")
def _null_primary(acts, pubs):
    return acts.where("primary_subtopic is null").select(F.col("pmid").alias("item"))


@G.gate("publish", "block", "orphans")
def _orphans(acts, pubs):
    return acts.join(pubs, "pmid", "left_anti").select(F.col("pmid").alias("item"))


@query(with_sql(ACT, PUB) + """
SELECT 0 AS place, 'no_blank_subtopic' AS gate, 'block' AS severity, count(*) AS violations, count(*) = 0 AS passed FROM act WHERE other_subtopic = ''
UNION ALL SELECT 1, 'score_range', 'block', count(*), count(*) = 0 FROM act WHERE score < 0 OR score > 1 OR impact < 0 OR impact > 100
UNION ALL SELECT 2, 'null_primary', 'warn', count(*), count(*) = 0 FROM act WHERE primary_subtopic IS NULL
UNION ALL SELECT 3, 'orphans', 'block', count(*), count(*) = 0 FROM act WHERE pmid NOT IN (SELECT pmid FROM pub)""")
def gate_results(spark, d):
    """The gates of a stage in order, with violations."""
    return G.run_gates("publish", activities(spark, d), publications(spark, d).select("pmid"))


@query(with_sql(ACT) + """
, o AS (SELECT topic, count(DISTINCT other_subtopic || coalesce(primary_subtopic, '')) AS was FROM act WHERE year <= 1998 GROUP BY 1), n AS (SELECT topic, count(DISTINCT other_subtopic || coalesce(primary_subtopic, '')) AS now FROM act WHERE year <= 1992 AND live GROUP BY 1)
SELECT o.topic, was, coalesce(now, 0) AS now, CASE WHEN coalesce(now, 0) < 8 THEN 'floor' WHEN was > 0 AND coalesce(now, 0) < was * (1 - 0.34) THEN 'shrunk' ELSE 'publish' END AS verdict FROM o LEFT JOIN n ON o.topic = n.topic""")
def card_guard(spark, d):
    """Whether each topic's new cards may replace the old ones: a floor, and a share that may be lost."""
    cards = F.countDistinct(F.concat("other_subtopic", F.coalesce("primary_subtopic", F.lit(""))))
    a = activities(spark, d)
    old, new = a.where("year <= 1998").groupBy("topic").agg(cards.alias("was")), a.where("year <= 1992 and live").groupBy("topic").agg(cards.alias("now"))
    return old.join(new, "topic", "left").na.fill(0, ["now"]).withColumn("verdict", G.card_verdict(F.col("now"), F.col("was")))


@query(with_sql(ACT) + """
, r AS (SELECT person || '/' || topic AS k, person, topic, pmid, year FROM act),
o AS (SELECT k, min(topic) AS topic, list_sort(list_distinct(list(pmid))) AS m FROM r WHERE year <= 1997 GROUP BY 1),
n AS (SELECT k, CASE WHEN min(person) % 13 = 0 THEN 'moved' ELSE min(topic) END AS topic, list_sort(list_distinct(list(pmid))) AS m, min(person) AS p FROM r WHERE year <= 1998 AND pmid % 40 <> 0 AND (year <= 1997 OR person % 3 <> 0) GROUP BY 1),
add_ AS (SELECT DISTINCT pmid FROM r WHERE year = 1998 AND pmid % 7 <> 0), mint AS (SELECT DISTINCT k FROM r WHERE year = 1998 AND person % 5 <> 0),
f AS (SELECT 'missing' AS guard, o.k FROM o WHERE k NOT IN (SELECT k FROM n)
UNION ALL SELECT 'changed', n.k FROM o JOIN n ON o.k = n.k WHERE o.topic <> n.topic
UNION ALL SELECT 'lost members', n.k FROM o JOIN n ON o.k = n.k WHERE NOT list_has_all(n.m, o.m)
UNION ALL SELECT 'miscounted', k FROM n WHERE len(m) + CASE WHEN p % 17 = 0 THEN 1 ELSE 0 END <> len(m)
UNION ALL SELECT 'not minted', k FROM n WHERE k NOT IN (SELECT k FROM o) AND k NOT IN (SELECT k FROM mint)
UNION ALL SELECT DISTINCT 'foreign members', n.k FROM o JOIN n ON o.k = n.k, unnest(n.m) AS u(x) WHERE NOT list_contains(o.m, x) AND x NOT IN (SELECT pmid FROM add_)
UNION ALL SELECT 'shrink', 'records' WHERE (SELECT count(*) FROM n) < (SELECT count(*) FROM o))
SELECT guard, k AS item FROM f""")
def publish_guards(spark, d):
    """Why a new version of people's topics may not be published over the old one: each guard with its items."""
    r = activities(spark, d).select(F.concat_ws("/", "person", "topic").alias("k"), "person", "topic", "pmid", "year")
    papers = F.sort_array(F.collect_set("pmid")).alias("pmid")
    old = r.where("year <= 1997").groupBy("k").agg(F.min("topic").alias("topic"), papers).withColumn("n", F.size("pmid"))
    new = r.where("year <= 1998 and pmid % 40 <> 0 and (year <= 1997 or person % 3 <> 0)").groupBy("k").agg(F.min("topic").alias("topic"), F.min("person").alias("p"), papers)
    new = new.select("k", F.when(F.col("p") % 13 == 0, "moved").otherwise(F.col("topic")).alias("topic"), "pmid", (F.size("pmid") + F.when(F.col("p") % 17 == 0, 1).otherwise(0)).alias("n"))
    late = r.where("year = 1998")
    return G.version_failures(old, new, "k", ["topic"], "pmid", late.where("pmid % 7 <> 0").select("pmid").distinct(), late.where("person % 5 <> 0").select("k").distinct())


@query("""
WITH r AS (SELECT conv_id, CASE CAST(conv_id % 4 AS INTEGER) WHEN 0 THEN 'cwid_abc' || CAST(conv_id AS VARCHAR) WHEN 1 THEN 'cwid_x1' WHEN 2 THEN 'cwid_' ELSE NULL END AS reviewer, max(CASE WHEN role = 'assistant' THEN text END) AS rationale,
 CASE CAST(conv_id % 3 AS INTEGER) WHEN 0 THEN 'approve' WHEN 1 THEN 'reject' ELSE 'maybe' END AS decision, conv_id % 7 <> 0 AS resolves, conv_id % 5 = 0 AS failed, conv_id % 11 = 0 AS blocks FROM conversations GROUP BY conv_id),
e AS (SELECT conv_id, list_filter([CASE WHEN NOT regexp_matches(coalesce(reviewer, ''), '^cwid_[a-z]+[0-9]+$') THEN 'reviewer' END, CASE WHEN length(regexp_replace(coalesce(rationale, ''), '^\\s+|\\s+$', '', 'g')) < 40 THEN 'rationale' END, CASE WHEN decision = 'maybe' THEN 'decision' END, CASE WHEN NOT resolves THEN 'artifact' END, CASE WHEN decision = 'approve' AND failed THEN 'failed stages' END, CASE WHEN decision = 'approve' AND blocks THEN 'gate blocks' END], lambda x: x IS NOT NULL) AS errors FROM r)
SELECT conv_id, len(errors) = 0 AS ok, array_to_string(errors, ';') AS errors FROM e""")
def review_validation(spark, d):
    """Reviews held to every rule of an approval, with what is wrong."""
    k = F.col("conv_id")
    r = table(spark, d, "conversations").groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("text"))).alias("rationale"))
    reviewer = F.when(k % 4 == 0, F.concat(F.lit("cwid_abc"), k.cast("string"))).when(k % 4 == 1, "cwid_x1").when(k % 4 == 2, "cwid_")
    decision = F.when(k % 3 == 0, "approve").when(k % 3 == 1, "reject").otherwise("maybe")
    some = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    errors = G.review_errors(reviewer, F.col("rationale"), decision, k % 7 != 0, some(k % 5 == 0), some(k % 11 == 0))
    return r.select("conv_id", errors.alias("e")).select("conv_id", (F.size("e") == 0).alias("ok"), F.array_join("e", ";").alias("errors"))


#: Years before a paper that its lab's window reaches back.
WINDOW = 3


@query(with_sql(ACT) + """
, au AS (SELECT pmid, person, max(line) AS line, max(year) AS year, max(score) AS s FROM act GROUP BY 1, 2), top AS (SELECT pmid, max(line) AS mx, max(year) AS year, max(s) AS s, max(s) >= 0.9 AS gated, max(s) >= 0.7 AS any_ FROM au GROUP BY 1),
h AS (SELECT pmid, max_by(person, line) AS head, max(line) AS line FROM au WHERE person % 10 <> 0 GROUP BY 1), p AS (SELECT top.pmid, year, gated, any_, head, line = mx AS senior FROM top LEFT JOIN h ON top.pmid = h.pmid)
SELECT pmid, head, coalesce(senior, FALSE) AS senior, CASE WHEN head IS NULL THEN 0 ELSE count(*) OVER l - 1 END AS lab_all, CASE WHEN head IS NULL THEN 0 ELSE sum(CASE WHEN gated THEN 1 ELSE 0 END) OVER l - CASE WHEN gated THEN 1 ELSE 0 END END::BIGINT AS lab_core,
 round(CASE WHEN head IS NULL THEN 0 ELSE (sum(CASE WHEN gated THEN 1 ELSE 0 END) OVER l - CASE WHEN gated THEN 1 ELSE 0 END) / (count(*) OVER l) END, 6) AS lab_rate,
 CASE WHEN head IS NULL THEN 0 ELSE coalesce((SELECT count(*) FROM p q WHERE q.head = p.head AND q.any_ AND q.year BETWEEN p.year - 3 AND p.year - 1), 0) END AS lab_window FROM p WINDOW l AS (PARTITION BY head)""")
def lab_features(spark, d):
    """Of each paper its lab (the last author who isn't staff), whether that is the last author of all, and what else the lab
    published: papers, those with core evidence and their rate, and such papers in the years before."""
    au = activities(spark, d).groupBy("pmid", "person").agg(F.max("line").alias("line"), F.max("year").alias("year"), F.max("score").alias("s"))
    staff = F.col("person") % 10 == 0
    p = au.groupBy("pmid").agg(F.max("line").alias("mx"), F.max("year").alias("year"), F.max("s").alias("s"), F.max(F.when(~staff, F.struct("line", "person"))).alias("h"))
    p = p.select("pmid", "year", F.col("h.person").alias("head"), F.coalesce(F.col("h.line") == F.col("mx"), F.lit(False)).alias("senior"), (F.col("s") >= 0.9).cast("int").alias("gated"), (F.col("s") >= 0.7).cast("int").alias("some"))
    # a lab's sums by year: a few rows a lab, so that no window holds its papers
    years = p.where("head is not null").groupBy("head", "year").agg(F.count("*").alias("n"), F.sum("gated").alias("g"), F.sum("some").alias("a"))
    lab = Window.partitionBy("head")
    years = years.select("head", "year", F.sum("n").over(lab).alias("lab_n"), F.sum("g").over(lab).alias("lab_g"), F.coalesce(F.sum("a").over(lab.orderBy("year").rangeBetween(-WINDOW, -1)), F.lit(0)).alias("lab_window"))
    out = p.join(years, ["head", "year"], "left")
    core = F.col("lab_g") - F.col("gated")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("pmid", "head", "senior", zero(F.col("lab_n") - 1).alias("lab_all"), zero(core).alias("lab_core"), F.round(F.coalesce(core / F.col("lab_n"), F.lit(0.0)), 6).alias("lab_rate"), zero(F.col("lab_window")).alias("lab_window"))
