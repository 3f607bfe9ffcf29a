"""Rollups, counts and rankings of publications, people and subtopics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions.scores import article_score, sort_key
from quillspark.operators.ranking import epsilon_argmax, top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, EV, PUB, activities, event_rows, publications, with_sql
from quillspark.sources.tables import table

#: Sizes, floors and windows (fixed values).
TOP_PAPERS, POOL, SINCE, FLOOR, EPSILON = 7, 150, 1998, 0.3, 0.001

AS = "power(impact / 100, 1.2) * power(score, 1.4)"


@query(with_sql(ACT) + f"""
, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY primary_subtopic, pmid
    ORDER BY CASE position WHEN 'first' THEN 0 WHEN 'last' THEN 0 ELSE 1 END, line) AS rn FROM act
    WHERE year >= {SINCE} AND primary_subtopic IS NOT NULL AND impact > 0) WHERE rn = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY primary_subtopic ORDER BY {AS} DESC, pmid, year DESC) AS r FROM one)
SELECT primary_subtopic AS subtopic, regexp_replace(primary_subtopic, '_[0-9][0-9][0-9]$', '') AS parent, round(sum({AS}), 6) AS pool_score, count(*) AS papers
FROM best WHERE r <= {TOP_PAPERS} GROUP BY 1, 2 ORDER BY round(sum({AS}), 6) DESC, 1 LIMIT {POOL}""")
def pool_rank(spark, d):
    """Subtopics by the sum of their best seven recent papers; a paper counts once, in its lead author's row."""
    recent = activities(spark, d).where((F.col("year") >= SINCE) & F.col("primary_subtopic").isNotNull() & (F.col("impact") > 0))
    lead = F.when(F.col("position") == "middle", 1).otherwise(0)
    one = top_k(recent, ["primary_subtopic", "pmid"], [lead, F.col("line")], 1, "_one")
    scored = one.withColumn("s", article_score(F.col("impact"), F.col("score")))
    best = top_k(scored, ["primary_subtopic"], [F.col("s").desc(), F.col("pmid"), F.col("year").desc()], TOP_PAPERS)
    parent = F.regexp_replace("subtopic", r"_\d{3}$", "")
    out = best.groupBy(F.col("primary_subtopic").alias("subtopic")).agg(F.round(F.sum("s"), 6).alias("pool_score"), F.count("*").alias("papers"))
    return out.withColumn("parent", parent).orderBy(F.col("pool_score").desc(), "subtopic").limit(POOL)


@query(with_sql(ACT) + f"SELECT person, primary_subtopic AS subtopic, round(sum({AS}), 6) AS total, count(*) AS n FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2")
def subtopic_exclusive(spark, d):
    """Each activity gives its whole score to its primary subtopic."""
    s = article_score(F.coalesce("impact", F.lit(0.0)), F.coalesce("score", F.lit(0.0)))
    return activities(spark, d).where("primary_subtopic is not null").groupBy("person", F.col("primary_subtopic").alias("subtopic")).agg(F.round(F.sum(s), 6).alias("total"), F.count("*").alias("n"))


BOTH = "(SELECT *, primary_subtopic AS subtopic FROM act WHERE primary_subtopic IS NOT NULL UNION ALL SELECT *, other_subtopic FROM act WHERE primary_subtopic IS NULL OR other_subtopic <> primary_subtopic)"


@query(with_sql(ACT) + f"SELECT person, subtopic, round(sum({AS}), 6) AS total, count(*) AS n FROM {BOTH} GROUP BY 1, 2")
def subtopic_inclusive(spark, d):
    """Each activity gives its whole score to every one of its subtopics, undivided."""
    ids = F.array_distinct(F.array_compact(F.array("primary_subtopic", "other_subtopic")))
    rows = activities(spark, d).withColumn("subtopic", F.explode(ids))
    return rows.groupBy("person", "subtopic").agg(F.round(F.sum(article_score(F.col("impact"), F.col("score"))), 6).alias("total"), F.count("*").alias("n"))


@query(with_sql(ACT) + f"""
SELECT 'topic' AS grain, person, topic AS id, count(*) AS n FROM act GROUP BY person, topic
UNION ALL SELECT 'primary', person, primary_subtopic, count(*) FROM act WHERE primary_subtopic IS NOT NULL GROUP BY person, primary_subtopic
UNION ALL SELECT 'subtopic', person, subtopic, count(*) FROM {BOTH} GROUP BY person, subtopic""")
def activity_counts(spark, d):
    """Activity counts of three grains in one pass: each row is exploded to its (grain, id) pairs before one shuffle."""
    pair = lambda g, c: F.struct(F.lit(g).alias("grain"), c.alias("id"))
    p, o = F.col("primary_subtopic"), F.col("other_subtopic")
    pairs = F.filter(F.array(pair("topic", F.col("topic")), pair("primary", p), pair("subtopic", p), pair("subtopic", F.when(p.isNull() | (o != p), o))), lambda x: x["id"].isNotNull())
    return activities(spark, d).select("person", F.explode(pairs).alias("x")).groupBy("x.grain", "person", "x.id").agg(F.count("*").alias("n"))


@query(with_sql(ACT) + """
, t AS (SELECT person, topic, count(*) AS n FROM act GROUP BY 1, 2), s AS (SELECT person, primary_subtopic, count(*) AS n FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2),
a AS (SELECT person, CAST(sum(n) AS BIGINT) AS n_activities, count(*) AS n_topics FROM t GROUP BY 1), b AS (SELECT person, CAST(sum(n) AS BIGINT) AS n_assigned, count(*) AS n_subtopics FROM s GROUP BY 1)
SELECT coalesce(a.person, b.person) AS person, coalesce(n_activities, 0) AS n_activities, coalesce(n_topics, 0) AS n_topics, coalesce(n_assigned, 0) AS n_assigned, coalesce(n_subtopics, 0) AS n_subtopics
FROM a FULL JOIN b ON a.person = b.person""")
def person_rollup(spark, d):
    """Two breakdowns rolled up to people and joined outright; what is missing is 0."""
    a = activities(spark, d)
    t = a.groupBy("person", "topic").count().groupBy("person").agg(F.sum("count").alias("n_activities"), F.count("*").alias("n_topics"))
    s = a.where("primary_subtopic is not null").groupBy("person", "primary_subtopic").count().groupBy("person").agg(F.sum("count").alias("n_assigned"), F.count("*").alias("n_subtopics"))
    return t.join(s, "person", "full").na.fill(0, ["n_activities", "n_topics", "n_assigned", "n_subtopics"]).orderBy(F.col("n_activities").desc(), "person")


@query(with_sql(ACT, PUB) + """
SELECT person, count(*) AS n_activities, count(DISTINCT topic) AS n_topics, count(primary_subtopic) AS n_assigned, count(DISTINCT primary_subtopic) AS n_subtopics
FROM act WHERE pmid IN (SELECT pmid FROM pub WHERE academic AND year >= 1997) GROUP BY 1""")
def scoped_rollup(spark, d):
    """The rollup over a given set of publications (semi-join)."""
    live = publications(spark, d).where("academic and year >= 1997").select("pmid")
    rows = activities(spark, d).join(live, "pmid", "left_semi")
    return rows.groupBy("person").agg(F.count("*").alias("n_activities"), F.countDistinct("topic").alias("n_topics"), F.count("primary_subtopic").alias("n_assigned"), F.countDistinct("primary_subtopic").alias("n_subtopics"))


@query(with_sql(ACT) + """
, t AS (SELECT person, topic, count(*) AS n FROM act GROUP BY 1, 2)
SELECT person, string_agg(topic || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, topic) AS topics, CAST(sum(n) AS BIGINT) AS total FROM t GROUP BY 1""")
def nested_counts(spark, d):
    """Per person an ordered map of topics to counts, as text, with its total."""
    t = activities(spark, d).groupBy("person", "topic").agg(F.count("*").alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "topic")))
    out = t.groupBy("person").agg(pairs.alias("p"), F.sum("n").alias("total"))
    return out.select("person", F.array_join(F.transform("p", lambda x: F.concat(x["topic"], F.lit(":"), (-x["m"]).cast("string"))), ",").alias("topics"), "total")


@query(with_sql(ACT) + f"""
, t AS (SELECT pmid, topic, max(score) AS s, round(sum(score), 6) AS conf FROM act WHERE score >= {FLOOR} GROUP BY 1, 2),
m AS (SELECT *, max(s) OVER (PARTITION BY pmid) AS best FROM t)
SELECT pmid, topic, s AS score FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY conf DESC, topic) AS rn FROM m WHERE best - s <= {EPSILON}) WHERE rn = 1""")
def top_topic(spark, d):
    """Each publication's topic: best score, ties within epsilon by summed confidence, then id."""
    t = activities(spark, d).where(F.col("score") >= FLOOR).groupBy("pmid", "topic").agg(F.max("score").alias("score"), F.round(F.sum("score"), 6).alias("conf"))
    return epsilon_argmax(t, ["pmid"], "score", "conf", "topic", EPSILON).select("pmid", "topic", "score")


@query(with_sql(ACT) + f"""
, c AS (SELECT pmid, subtopic, max(score) AS conf FROM {BOTH} WHERE score >= {FLOOR} GROUP BY 1, 2),
seeds AS (SELECT subtopic, count(DISTINCT pmid) AS n FROM {BOTH} GROUP BY 1),
m AS (SELECT pmid, c.subtopic, conf, n, max(conf) OVER (PARTITION BY pmid) AS best FROM c JOIN seeds ON c.subtopic = seeds.subtopic),
p AS (SELECT pmid, subtopic FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY n DESC, subtopic) AS rn FROM m WHERE best - conf <= {EPSILON}) WHERE rn = 1)
SELECT p.pmid, p.subtopic AS primary_id, string_agg(c.subtopic, ';' ORDER BY conf DESC, c.subtopic) AS ranked FROM p JOIN c ON p.pmid = c.pmid GROUP BY 1, 2""")
def primary_subtopic(spark, d):
    """Confidence floor, ranked ids, and the primary id with ties within epsilon settled by seed counts."""
    ids = F.array_distinct(F.array_compact(F.array("primary_subtopic", "other_subtopic")))
    rows = activities(spark, d).select("pmid", "score", F.explode(ids).alias("subtopic"))
    seeds = rows.groupBy("subtopic").agg(F.countDistinct("pmid").alias("n"))
    c = rows.where(F.col("score") >= FLOOR).groupBy("pmid", "subtopic").agg(F.max("score").alias("conf"))
    p = epsilon_argmax(c.join(seeds, "subtopic"), ["pmid"], "conf", "n", "subtopic", EPSILON).select("pmid", F.col("subtopic").alias("primary_id"))
    ranked = c.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct((-F.col("conf")).alias("m"), "subtopic"))).alias("r"))
    return p.join(ranked, "pmid").select("pmid", "primary_id", F.array_join("r.subtopic", ";").alias("ranked"))


@query(with_sql(ACT) + """
, m AS (SELECT person, topic, max(score) AS s, count(DISTINCT pmid) AS pubs FROM act WHERE score >= 0.3 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY s DESC, topic) AS rn FROM m)
SELECT person, string_agg(topic, ',' ORDER BY rn) AS topics, max(s) AS best, (SELECT count(DISTINCT pmid) FROM act a WHERE a.person = r.person) AS pubs FROM r WHERE rn <= 10 GROUP BY person""")
def faculty_top10(spark, d):
    """Per person the ten best topics by highest score, and distinct publications."""
    a = activities(spark, d)
    best = a.where("score >= 0.3").groupBy("person", "topic").agg(F.max("score").alias("s"))
    ranked = top_k(best, ["person"], [F.col("s").desc(), F.col("topic")], 10)
    vec = ranked.groupBy("person").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rn", "topic")))["topic"], ",").alias("topics"), F.max("s").alias("best"))
    return vec.join(a.groupBy("person").agg(F.countDistinct("pmid").alias("pubs")), "person")


@query(with_sql(ACT) + """
, o AS (SELECT person, topic, max(score) AS s FROM act WHERE year < 1999 GROUP BY 1, 2), n AS (SELECT person, topic, max(score) AS s FROM act WHERE year >= 1999 AND score >= 0.3 GROUP BY 1, 2),
u AS (SELECT person, topic, max(s) AS s FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY s DESC, topic) AS rn FROM u)
SELECT person, topic, s AS score, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 10 AND person IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def faculty_incremental_max(spark, d):
    """Old maxima merged with new ones; people without metadata are left out; top ten again."""
    a = activities(spark, d)
    old = a.where("year < 1999").groupBy("person", "topic").agg(F.max("score").alias("score"))
    new = a.where("year >= 1999 and score >= 0.3").groupBy("person", "topic").agg(F.max("score").alias("score"))
    known = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("person"))
    merged = old.unionByName(new).join(known, "person", "left_semi").groupBy("person", "topic").agg(F.max("score").alias("score"))
    return top_k(merged, ["person"], [F.col("score").desc(), F.col("topic")], 10, "rank")


@query(with_sql(ACT) + f"""
, t AS (SELECT primary_subtopic AS subtopic, person, round(sum({AS}), 4) AS total FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1, 2)
SELECT subtopic, person, total, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY subtopic ORDER BY total DESC, person) AS rn FROM t) WHERE rn <= 5""")
def top_people_per_subtopic(spark, d):
    """The five people with the largest totals in each subtopic."""
    s = article_score(F.col("impact"), F.col("score"))
    t = activities(spark, d).where("primary_subtopic is not null").groupBy(F.col("primary_subtopic").alias("subtopic"), "person").agg(F.round(F.sum(s), 4).alias("total"))
    return top_k(t, ["subtopic"], [F.col("total").desc(), F.col("person")], 5)


@query(with_sql(ACT) + """
, live AS (SELECT DISTINCT person, pmid FROM act WHERE live),
k AS (SELECT CASE WHEN line = 7 THEN NULL ELSE person END AS person, pmid, topic FROM act)
SELECT k.person, k.topic, count(*) AS n FROM k LEFT JOIN live ON k.person = live.person AND k.pmid = live.pmid
WHERE live.pmid IS NOT NULL OR k.person IS NULL GROUP BY 1, 2""")
def live_attribution(spark, d):
    """Drops a row only if its pair is provably absent from the live pairs: rows with a blank key stay."""
    a = activities(spark, d)
    live = a.where("live").select("person", "pmid").distinct().withColumn("hit", F.lit(True))
    rows = a.select(F.when(F.col("line") != 7, F.col("person")).alias("person"), "pmid", "topic")
    return rows.join(live, ["person", "pmid"], "left").where("hit or person is null").groupBy("person", "topic").agg(F.count("*").alias("n"))


@query(with_sql(ACT) + "SELECT person, topic, pmid, score, lpad(CAST(CAST(least(floor(score * 1000), 9999) AS INTEGER) AS VARCHAR), 4, '0') || '#' || CAST(pmid AS VARCHAR) AS sk, CAST(lpad(CAST(CAST(least(floor(score * 1000), 9999) AS INTEGER) AS VARCHAR), 4, '0') AS INTEGER) AS back FROM act")
def sort_key_codec(spark, d):
    """Score to sort key and back."""
    a = activities(spark, d)
    sk = F.concat(sort_key(F.col("score")), F.lit("#"), F.col("pmid").cast("string"))
    return a.select("person", "topic", "pmid", "score", sk.alias("sk")).withColumn("back", F.split("sk", "#")[0].cast("int"))


@query("""
SELECT n_name AS nation, p_brand AS brand, count(*) AS n, round(sum(l_extendedprice), 2) AS total, CAST(grouping(n_name) AS INTEGER) AS g_nation, CAST(grouping(p_brand) AS INTEGER) AS g_brand
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (n_name, p_brand)""")
def rollup_grouping(spark, d):
    """Two grains and the grand total of one aggregate (extension)."""
    li, s, n, p = (table(spark, d, t) for t in ("lineitem", "supplier", "nation", "part"))
    rows = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    out = rows.select(F.col("n_name").alias("nation"), F.col("p_brand").alias("brand"), "l_extendedprice").rollup("nation", "brand")
    return out.agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.grouping("nation").cast("int").alias("g_nation"), F.grouping("brand").cast("int").alias("g_brand"))


@query(with_sql(ACT) + f"""
, s AS (SELECT primary_subtopic AS subtopic, round(sum({AS}), 6) AS pool FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1),
h AS (SELECT subtopic, pool, CASE WHEN pool > 30 THEN CAST(length(subtopic) + CAST(floor(pool) AS INTEGER) % 20 AS DOUBLE) END AS weeks FROM s)
SELECT subtopic, weeks, round(CASE WHEN weeks IS NULL THEN pool ELSE pool * (1 - exp(-weeks / 12)) END, 6) AS selection FROM h""")
def rotation_score(spark, d):
    """Pool scores dampened by the weeks since a subtopic was last shown; never shown keeps all."""
    from quillspark.functions.scores import decayed

    s = activities(spark, d).where("primary_subtopic is not null").groupBy(F.col("primary_subtopic").alias("subtopic")).agg(F.round(F.sum(article_score(F.col("impact"), F.col("score"))), 6).alias("pool"))
    weeks = F.when(F.col("pool") > 30, (F.length("subtopic") + F.floor("pool").cast("int") % 20).cast("double"))
    return s.withColumn("weeks", weeks).select("subtopic", "weeks", F.round(decayed(F.col("pool"), F.col("weeks")), 6).alias("selection"))


@query(with_sql(EV) + """
, l AS (SELECT user_id AS scope, event_type AS status, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev WHERE event_type = 'purchase')
SELECT scope, ts, event_id FROM l WHERE rn = 1""")
def latest_complete(spark, d):
    """The newest complete run of each scope."""
    done = event_rows(spark, d).where("event_type = 'purchase'")
    newest = done.groupBy(F.col("user_id").alias("scope")).agg(F.max(F.struct("ts", "event_id")).alias("r"))
    return newest.select("scope", "r.ts", "r.event_id")


@query(with_sql(EV) + """
, f AS (SELECT user_id, event_id, value, ts FROM ev WHERE event_type = 'error'), c AS (SELECT count(*) AS n FROM f)
SELECT event_id, user_id, value, CAST(n AS BIGINT) AS found, n > 200 AS truncated, greatest(n - 200, 0) AS remaining FROM f, c ORDER BY coalesce(value, 0), event_id LIMIT 200""")
def capped_sweep(spark, d):
    """Worst first, at most 200, with how many remain."""
    f = event_rows(spark, d).where("event_type = 'error'").select("event_id", "user_id", "value")
    n = f.agg(F.count("*").alias("found"))
    top = f.orderBy(F.coalesce("value", F.lit(0.0)), "event_id").limit(200)
    return top.join(F.broadcast(n)).select("event_id", "user_id", "value", "found", (F.col("found") > 200).alias("truncated"), F.greatest(F.col("found") - 200, F.lit(0)).alias("remaining"))


@query("SELECT doc_id, lang FROM documents ORDER BY sha256(CAST(doc_id AS VARCHAR) || '#42'), doc_id LIMIT 50")
def seeded_sample(spark, d):
    """A sample of 50 that depends only on ids and a seed."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.orderBy(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("#42")), 256), "doc_id").limit(50)


@query(with_sql(ACT) + "SELECT topic, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, topic) AS INTEGER) AS place FROM act GROUP BY topic")
def topic_ordering(spark, d):
    """Topics by activity."""
    t = activities(spark, d).groupBy("topic").agg(F.count("*").alias("n"))
    return t.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "topic")))


@query(with_sql(PUB) + """
SELECT owner, coalesce(min(CASE WHEN published >= TIMESTAMP '1999-06-01' THEN published END), max(published)) AS deadline FROM pub GROUP BY owner""")
def next_deadline(spark, d):
    """The next date from a given day on, else the last one before."""
    day = F.lit("1999-06-01").cast("timestamp")
    return publications(spark, d).groupBy("owner").agg(F.coalesce(F.min(F.when(F.col("published") >= day, F.col("published"))), F.max("published")).alias("deadline"))
