"""Set algebra between stores: sweeps, churn, drift, diffs and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.plans.registry import query
from quillspark.plans.views import ACT, EV, MEMBERS, PUB, activities, event_rows, publications, subtopic_members, with_sql
from quillspark.sources.tables import table


@query(with_sql(PUB) + """
SELECT pmid FROM (SELECT doc_id AS pmid FROM documents EXCEPT SELECT doc_id FROM labels EXCEPT SELECT event_id FROM events WHERE event_type = 'error'
  EXCEPT SELECT event_id FROM events WHERE event_type = 'signup' INTERSECT SELECT pmid FROM pub WHERE academic) ORDER BY pmid LIMIT 200""")
def eligibility_sweep(spark, d):
    """Enriched minus scored, failed and quarantined, within the scoreable ones; the lowest 200."""
    e = event_rows(spark, d)
    # INTERSECT binds tighter than EXCEPT: the quarantined are first cut to the scoreable ones
    pool = table(spark, d, "documents").select(F.col("doc_id").alias("pmid")).distinct()
    scored = table(spark, d, "labels").select(F.col("doc_id").alias("pmid"))
    failed = e.where("event_type = 'error'").select(F.col("event_id").alias("pmid"))
    held = e.where("event_type = 'signup'").select(F.col("event_id").alias("pmid")).join(publications(spark, d).where("academic").select("pmid"), "pmid", "left_semi")
    for gone in (scored, failed, held):
        pool = pool.join(gone, "pmid", "left_anti")
    return pool.orderBy("pmid").limit(200)


@query(with_sql(ACT) + """
, base AS (SELECT DISTINCT person, pmid FROM act WHERE year < 1999), acc AS (SELECT DISTINCT person, pmid FROM act WHERE live)
SELECT coalesce(b.person, a.person) AS person, count(CASE WHEN b.pmid IS NULL THEN 1 END) AS added, count(CASE WHEN a.pmid IS NULL THEN 1 END) AS removed FROM base b FULL JOIN acc a ON b.person = a.person AND b.pmid = a.pmid GROUP BY 1""")
def churn_diff(spark, d):
    """Accepted against baseline pairs, added and removed, per person."""
    a = activities(spark, d)
    base = a.where("year < 1999").select("person", "pmid").distinct().withColumn("b", F.lit(1))
    acc = a.where("live").select("person", "pmid").distinct().withColumn("a", F.lit(1))
    return base.join(acc, ["person", "pmid"], "full").groupBy("person").agg(F.count(F.when(F.col("b").isNull(), 1)).alias("added"), F.count(F.when(F.col("a").isNull(), 1)).alias("removed"))


@query(with_sql(ACT) + """
, parts AS (SELECT DISTINCT topic AS id FROM act), tax AS (SELECT DISTINCT p_brand AS id FROM part WHERE p_brand <> 'Brand#11' UNION SELECT 'Brand#99'), cat AS (SELECT DISTINCT p_brand AS id FROM part WHERE p_size > 45)
SELECT 'orphan' AS kind, id FROM (SELECT id FROM parts EXCEPT SELECT id FROM tax) UNION ALL SELECT 'unscored', id FROM (SELECT id FROM tax EXCEPT SELECT id FROM parts)
UNION ALL SELECT 'stale', id FROM (SELECT id FROM cat EXCEPT SELECT id FROM tax) UNION ALL SELECT 'missing', id FROM (SELECT id FROM tax EXCEPT SELECT id FROM cat)""")
def taxonomy_drift(spark, d):
    """Differences both ways between partitions, taxonomy and catalogue."""
    p = table(spark, d, "part")
    parts = activities(spark, d).select(F.col("topic").alias("id")).distinct()
    tax = p.where("p_brand <> 'Brand#11'").select(F.col("p_brand").alias("id")).union(spark.sql("select 'Brand#99' as id")).distinct()
    cat = p.where("p_size > 45").select(F.col("p_brand").alias("id")).distinct()
    tag = lambda k, df: df.select(F.lit(k).alias("kind"), "id")
    return tag("orphan", parts.subtract(tax)).union(tag("unscored", tax.subtract(parts))).union(tag("stale", cat.subtract(tax))).union(tag("missing", tax.subtract(cat)))


@query(with_sql(ACT) + """
, o AS (SELECT primary_subtopic AS id, min(topic || '-' || CAST(year AS VARCHAR)) AS label FROM act WHERE year <= 1997 AND primary_subtopic IS NOT NULL GROUP BY 1), n AS (SELECT primary_subtopic AS id, min(topic || '-' || CAST(year AS VARCHAR)) AS label FROM act WHERE year >= 1996 AND primary_subtopic IS NOT NULL GROUP BY 1)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.label <> n.label THEN 'renamed' ELSE 'same' END AS change FROM o FULL JOIN n ON o.id = n.id""")
def structural_diff(spark, d):
    """Added, removed and renamed nodes between two versions."""
    a = activities(spark, d).where("primary_subtopic is not null")
    label = F.min(F.concat("topic", F.lit("-"), F.col("year").cast("string")))
    o = a.where("year <= 1997").groupBy(F.col("primary_subtopic").alias("id")).agg(label.alias("was"))
    n = a.where("year >= 1996").groupBy(F.col("primary_subtopic").alias("id")).agg(label.alias("now"))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "renamed").otherwise("same")
    return o.join(n, "id", "full").select("id", kind.alias("change"))


@query("""
WITH e AS (SELECT DISTINCT l_suppkey AS a, 1 + (l_partkey % 100) AS b FROM lineitem WHERE l_suppkey <> 1 + (l_partkey % 100) AND l_quantity < 20)
SELECT e.a, e.b FROM e JOIN e r ON e.a = r.b AND e.b = r.a""")
def bidirectional_edges(spark, d):
    """Edges whose reverse is there too, without loops and repeats."""
    e = table(spark, d, "lineitem").where("l_quantity < 20").select(F.col("l_suppkey").alias("a"), (1 + F.col("l_partkey") % 100).alias("b")).where("a <> b").distinct()
    return e.join(e.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi")


@query(with_sql(ACT, MEMBERS) + """
, x AS (SELECT subtopic AS a, topic AS b FROM mem), y AS (SELECT primary_subtopic AS a, position AS b FROM act WHERE primary_subtopic IS NOT NULL)
SELECT a, b FROM x UNION SELECT a, b FROM y""")
def adjacency_union(spark, d):
    """Union of adjacency maps."""
    x = subtopic_members(spark, d).select(F.col("subtopic").alias("a"), F.col("topic").alias("b"))
    y = activities(spark, d).where("primary_subtopic is not null").select(F.col("primary_subtopic").alias("a"), F.col("position").alias("b"))
    return x.union(y).distinct()


@query("SELECT d.doc_id, l.doc_id IS NOT NULL AND quality IS NOT NULL AS complete FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def coverage_partition(spark, d):
    """Complete and incomplete items."""
    l = table(spark, d, "labels").where("quality is not null").select("doc_id", F.lit(True).alias("c"))  # noqa: E741
    return table(spark, d, "documents").select("doc_id").join(l, "doc_id", "left").select("doc_id", F.coalesce("c", F.lit(False)).alias("complete"))


@query(with_sql(ACT) + """
, m AS (SELECT pmid, CASE WHEN other_subtopic LIKE '%_010' THEN replace(other_subtopic, '_010', '_001') ELSE other_subtopic END AS id FROM act)
SELECT pmid, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM m GROUP BY 1""")
def repoint_ids(spark, d):
    """Dropped ids repointed to those kept, repeats removed."""
    to = F.when(F.col("other_subtopic").endswith("_010"), F.replace("other_subtopic", F.lit("_010"), F.lit("_001"))).otherwise(F.col("other_subtopic"))
    return activities(spark, d).groupBy("pmid").agg(F.array_join(F.sort_array(F.collect_set(to)), ",").alias("ids"))


@query(with_sql(ACT) + "SELECT DISTINCT other_subtopic AS id FROM act WHERE year = 1995 AND other_subtopic NOT IN (SELECT other_subtopic FROM act WHERE year >= 1996 AND score >= 1.0)")
def gc_candidates(spark, d):
    """Candidates no longer seen."""
    a = activities(spark, d)
    seen = a.where("year >= 1996 and score >= 1.0").select(F.col("other_subtopic").alias("id"))
    return a.where("year = 1995").select(F.col("other_subtopic").alias("id")).distinct().join(seen, "id", "left_anti")


@query(with_sql(PUB) + """
, o AS (SELECT pmid, impact FROM pub WHERE year <= 1999), n AS (SELECT pmid, CASE WHEN pmid % 10 = 0 THEN impact + 1 ELSE impact END AS impact, pmid % 7 = 0 AS human FROM pub WHERE year >= 1998)
SELECT coalesce(o.pmid, n.pmid) AS pmid, round(coalesce(CASE WHEN n.human THEN o.impact END, n.impact, o.impact), 6) AS impact,
 CASE WHEN o.pmid IS NULL THEN 'inserted' WHEN n.pmid IS NULL THEN 'kept' WHEN n.human THEN 'held' WHEN o.impact <> n.impact THEN 'updated' ELSE 'same' END AS how FROM o FULL JOIN n ON o.pmid = n.pmid""")
def upsert_merge(spark, d):
    """New rows over old ones by key; decided values stay, attributes not produced this run stay."""
    p = publications(spark, d)
    old = p.where("year <= 1999").select("pmid", F.col("impact").alias("was"))
    new = p.where("year >= 1998").select("pmid", F.when(F.col("pmid") % 10 == 0, F.col("impact") + 1).otherwise(F.col("impact")).alias("now"), (F.col("pmid") % 7 == 0).alias("human"))
    rows = old.join(new, "pmid", "full")
    how = F.when(F.col("was").isNull(), "inserted").when(F.col("now").isNull(), "kept").when(F.col("human"), "held").when(F.col("was") != F.col("now"), "updated").otherwise("same")
    return rows.select("pmid", F.round(F.coalesce(F.when(F.col("human"), F.col("was")), "now", "was"), 6).alias("impact"), how.alias("how"))


@query(with_sql(ACT) + """
, r(s, k) AS (VALUES ('below', 0), ('candidate', 1), ('confirmed', 2)),
o AS (SELECT pmid, max(CASE WHEN score >= 0.8 THEN 2 WHEN score >= 0.4 THEN 1 ELSE 0 END) AS k FROM act WHERE line <= 3 GROUP BY 1), n AS (SELECT pmid, max(CASE WHEN score >= 0.9 THEN 2 WHEN score >= 0.5 THEN 1 ELSE 0 END) AS k FROM act WHERE line > 2 GROUP BY 1)
SELECT coalesce(o.pmid, n.pmid) AS pmid, s AS status FROM o FULL JOIN n ON o.pmid = n.pmid JOIN r ON r.k = greatest(coalesce(o.k, 0), coalesce(n.k, 0))""")
def never_downgrade(spark, d):
    """A status is only ever raised."""
    a = activities(spark, d)
    rank = lambda hi, lo: F.max(F.when(F.col("score") >= hi, 2).when(F.col("score") >= lo, 1).otherwise(0))
    o, n = a.where("line <= 3").groupBy("pmid").agg(rank(0.8, 0.4).alias("o")), a.where("line > 2").groupBy("pmid").agg(rank(0.9, 0.5).alias("n"))
    top = F.greatest(F.coalesce("o", F.lit(0)), F.coalesce("n", F.lit(0)))
    return o.join(n, "pmid", "full").select("pmid", F.when(top == 2, "confirmed").when(top == 1, "candidate").otherwise("below").alias("status"))


@query(with_sql(ACT, PUB) + """
, child AS (SELECT a.pmid, line, CASE WHEN line % 3 = 0 THEN NULL WHEN line % 3 = 1 THEN a.impact ELSE a.impact + 1 END AS had, p.impact AS parent FROM act a JOIN pub p ON a.pmid = p.pmid)
SELECT pmid, count(*) AS n, count(CASE WHEN had IS DISTINCT FROM parent THEN 1 END) AS changed FROM child GROUP BY 1""")
def propagate_parent(spark, d):
    """A parent's attribute written to the child rows in which it differs."""
    p = publications(spark, d).select("pmid", F.col("impact").alias("parent"))
    had = F.when(F.col("line") % 3 == 1, F.col("impact")).when(F.col("line") % 3 == 2, F.col("impact") + 1)
    c = activities(spark, d).withColumn("had", had).join(p, "pmid")
    return c.groupBy("pmid").agg(F.count("*").alias("n"), F.count(F.when(~F.col("had").eqNullSafe(F.col("parent")), 1)).alias("changed"))


@query(with_sql(EV) + """
, f AS (SELECT user_id, count(*) AS fails, min(CASE WHEN event_id % 13 <> 0 THEN ts END) AS failed_at FROM ev WHERE event_type = 'error' GROUP BY 1)
SELECT user_id, fails, failed_at, CASE WHEN fails >= 16 THEN 'quarantine' WHEN failed_at IS NOT NULL AND failed_at > TIMESTAMP '2024-01-03' THEN 'too young' ELSE 'retry' END AS verdict FROM f ORDER BY failed_at ASC NULLS FIRST, user_id LIMIT 100""")
def retry_sweep(spark, d):
    """Quarantine after too many failures, wait for young ones, else retry; never-stamped failures first."""
    f = event_rows(spark, d).where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("fails"), F.min(F.when(F.col("event_id") % 13 != 0, F.col("ts"))).alias("failed_at"))
    verdict = F.when(F.col("fails") >= 16, "quarantine").when(F.col("failed_at") > F.lit("2024-01-03").cast("timestamp"), "too young").otherwise("retry")
    return f.withColumn("verdict", verdict).orderBy(F.col("failed_at").asc_nulls_first(), "user_id").limit(100)


@query(with_sql(EV) + """
, s AS (SELECT user_id, max(CASE WHEN event_type = 'view' THEN ts END) AS scored, max(CASE WHEN event_type = 'click' THEN ts END) AS enriched, CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'm' || CAST(user_id % 3 AS VARCHAR) END AS model FROM ev GROUP BY 1)
SELECT user_id, enriched > scored AS re_enriched, coalesce(model <> 'm1', FALSE) AS model_changed FROM s WHERE scored IS NOT NULL AND (enriched > scored OR coalesce(model <> 'm1', FALSE))""")
def drift_sweep(spark, d):
    """Scores older than their input or of another model; unstamped scores count as the baseline."""
    last = lambda t: F.max(F.when(F.col("event_type") == t, F.col("ts")))
    s = event_rows(spark, d).groupBy("user_id").agg(last("view").alias("scored"), last("click").alias("enriched"))
    model = F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")))
    rows = s.select("user_id", (F.col("enriched") > F.col("scored")).alias("re_enriched"), F.coalesce(model != "m1", F.lit(False)).alias("model_changed"), "scored")
    return rows.where("scored is not null and (re_enriched or model_changed)").drop("scored")


@query(with_sql(EV) + """
, c AS (SELECT user_id, day, sha256('stage' || chr(0) || CAST(user_id AS VARCHAR) || '|' || string_agg(DISTINCT CAST(k AS VARCHAR), ',' ORDER BY CAST(k AS VARCHAR))) AS h FROM ev GROUP BY 1, 2),
n AS (SELECT user_id, h FROM c WHERE day = DATE '2024-01-20'), p AS (SELECT DISTINCT user_id, h FROM c WHERE day < DATE '2024-01-20')
SELECT n.user_id, n.h AS input_hash, p.h IS NOT NULL AS skip FROM n LEFT JOIN p ON n.user_id = p.user_id AND n.h = p.h""")
def skip_cache(spark, d):
    """Inputs hashed regardless of order; a run whose input was done before is skipped."""
    e = event_rows(spark, d)
    c = e.groupBy("user_id", "day").agg(F.array_join(F.sort_array(F.collect_set(F.col("k").cast("string"))), ",").alias("s"))
    c = c.withColumn("h", F.sha2(F.concat(F.lit("stage\0"), F.col("user_id").cast("string"), F.lit("|"), "s"), 256))
    day = F.lit("2024-01-20").cast("date")
    past = c.where(F.col("day") < day).select("user_id", "h", F.lit(True).alias("done")).distinct()
    return c.where(F.col("day") == day).join(past, ["user_id", "h"], "left").select("user_id", F.col("h").alias("input_hash"), F.coalesce("done", F.lit(False)).alias("skip"))
