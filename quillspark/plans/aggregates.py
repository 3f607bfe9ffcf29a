"""Aggregates: modes, diagnostics, lift, agreement, coverage and spending."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions.text import norm_name
from quillspark.operators.ranking import top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, EV, PUB, activities, event_rows, publications, with_sql
from quillspark.sources.tables import table


@query(with_sql(PUB) + "SELECT owner, min(year) AS start_year, CASE WHEN bool_or(status = 'O') THEN NULL ELSE max(year) END AS end_year FROM pub GROUP BY 1")
def tenure_span(spark, d):
    """First and last year of each owner; open if any row is."""
    return publications(spark, d).groupBy("owner").agg(F.min("year").alias("start_year"), F.when(~F.bool_or(F.col("status") == "O"), F.max("year")).alias("end_year"))


@query(with_sql(ACT) + "SELECT pmid, bool_and(coalesce(s_acctbal, 0) <= 2000) AS all_voluntary FROM act LEFT JOIN supplier ON person = s_suppkey GROUP BY 1")
def all_voluntary(spark, d):
    """Whether every author of a publication is voluntary; an unknown author counts as such."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("person"), "s_acctbal")
    return activities(spark, d).join(s, "person", "left").groupBy("pmid").agg(F.bool_and(F.coalesce("s_acctbal", F.lit(0.0)) <= 2000).alias("all_voluntary"))


@query(with_sql(ACT) + """
, t AS (SELECT DISTINCT l_suppkey AS person, p_partkey AS tool, least(1.0, l_quantity / 10 / 5) AS conf FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 35)
SELECT person, tool, round(max(conf), 6) AS confidence FROM t GROUP BY 1, 2""")
def tool_records(spark, d):
    """Person and tool pairs over the confidence floor, once each, confidence scaled to one."""
    li = table(spark, d, "lineitem").where("l_quantity >= 35").select(F.col("l_suppkey").alias("person"), F.col("l_partkey").alias("tool"), F.least(F.lit(1.0), F.col("l_quantity") / 10 / 5).alias("c"))
    known = table(spark, d, "part").select(F.col("p_partkey").alias("tool"))
    return li.join(known, "tool", "left_semi").groupBy("person", "tool").agg(F.round(F.max("c"), 6).alias("confidence"))


@query("""
WITH n AS (SELECT p_type AS category, p_partkey AS tool, count(DISTINCT l_orderkey) AS pubs FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) >= 3)
SELECT category, count(*) AS tool_count, string_agg(CAST(tool AS VARCHAR), ',' ORDER BY pubs DESC, tool) AS tools FROM n GROUP BY 1""")
def tool_index(spark, d):
    """Tools of each category by publications, with the floor applied upstream."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("tool"), F.col("p_type").alias("category"))
    n = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("tool")).agg(F.countDistinct("l_orderkey").alias("pubs")).where("pubs >= 3").join(p, "tool")
    rows = n.groupBy("category").agg(F.count("*").alias("tool_count"), F.sort_array(F.collect_list(F.struct((-F.col("pubs")).alias("m"), "tool"))).alias("t"))
    return rows.select("category", "tool_count", F.array_join(F.transform("t", lambda x: x["tool"].cast("string")), ",").alias("tools"))


@query("""
WITH m AS (SELECT p_name AS raw, p_type AS category, p_partkey AS id, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k FROM part),
r AS (SELECT k, raw, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, length(raw) DESC, raw) AS rn FROM m GROUP BY k, raw),
c AS (SELECT k, category, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, category) AS rn FROM m GROUP BY k, category),
n AS (SELECT k, count(*) AS mentions, count(DISTINCT id) AS pubs FROM m GROUP BY k)
SELECT n.k AS form, r.raw AS display, c.category, mentions, pubs FROM n JOIN r ON n.k = r.k AND r.rn = 1 JOIN c ON n.k = c.k AND c.rn = 1""")
def mention_groups(spark, d):
    """Mentions by normalised name: modal raw form (longest on ties), modal category, distinct publications."""
    m = table(spark, d, "part").select(norm_name(F.col("p_name")).alias("form"), F.col("p_name").alias("raw"), F.col("p_type").alias("category"), "p_partkey")
    raw = top_k(m.groupBy("form", "raw").count(), ["form"], [F.col("count").desc(), F.length("raw").desc(), F.col("raw")], 1).select("form", F.col("raw").alias("display"))
    cat = top_k(m.groupBy("form", "category").count(), ["form"], [F.col("count").desc(), F.col("category")], 1).select("form", "category")
    return m.groupBy("form").agg(F.count("*").alias("mentions"), F.countDistinct("p_partkey").alias("pubs")).join(raw, "form").join(cat, "form")


@query("""
WITH s AS (SELECT lang, source, doc_id, regexp_extract(text, '^[^\\n]*') AS t FROM documents)
SELECT lang, source, length(t) AS chars, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY length(t) DESC, doc_id) AS rn FROM s) WHERE rn = 1""")
def longest_context(spark, d):
    """The longest snippet of each group, the first on ties."""
    s = table(spark, d, "documents").select("lang", "source", "doc_id", F.length(F.substring_index("text", "\n", 1)).alias("n"))
    best = s.groupBy("lang", "source").agg(F.max(F.struct("n", (-F.col("doc_id")).alias("m"))).alias("b"))
    return best.select("lang", "source", F.col("b.n").alias("chars"), (-F.col("b.m")).alias("doc_id"))


@query(with_sql(ACT) + "SELECT pmid % 1000 AS grant_id, count(DISTINCT person) AS n, string_agg(DISTINCT CAST(person AS VARCHAR), ';' ORDER BY CAST(person AS VARCHAR)) AS people FROM act GROUP BY 1")
def grant_investigators(spark, d):
    """Distinct investigators of each grant, sorted as text."""
    rows = activities(spark, d).groupBy((F.col("pmid") % 1000).alias("grant_id")).agg(F.sort_array(F.collect_set(F.col("person").cast("string"))).alias("p"))
    return rows.select("grant_id", F.size("p").cast("long").alias("n"), F.array_join("p", ";").alias("people"))


@query(with_sql(ACT) + "SELECT pmid, round(1 - CASE WHEN max(score) >= 1 THEN 0 ELSE exp(sum(CASE WHEN score < 1 THEN ln(1 - score) END)) END, 6) AS p FROM act GROUP BY 1")
def noisy_or_by_publication(spark, d):
    """1 - prod(1 - p) by logarithms, with a guard for certain evidence."""
    logs = F.sum(F.when(F.col("score") < 1, F.ln(1 - F.col("score"))))
    return activities(spark, d).groupBy("pmid").agg(F.round(1 - F.when(F.max("score") >= 1, F.lit(0.0)).otherwise(F.exp(logs)), 6).alias("p"))


LIFT = """, n AS (SELECT topic, n_name AS unit, count(*) AS n FROM act JOIN supplier ON person = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
l AS (SELECT topic, unit, n, n / sum(n) OVER (PARTITION BY topic) AS share, sum(n) OVER (PARTITION BY unit) / sum(n) OVER () AS base FROM n)"""


def _lift(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("person"), F.col("n_name").alias("unit"))
    n = activities(spark, d).join(s, "person").groupBy("topic", "unit").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("topic"))
    base = F.sum("n").over(Window.partitionBy("unit")) / F.sum("n").over(Window.partitionBy())
    return n.withColumns({"share": share, "base": base})


@query(with_sql(ACT) + LIFT + "SELECT topic, unit, n, round(share, 4) AS share, round(base, 4) AS base, round(share / base, 3) AS lift FROM l")
def lift_table(spark, d):
    """Share of a unit in a topic against its share of everything."""
    return _lift(spark, d).select("topic", "unit", "n", F.round("share", 4).alias("share"), F.round("base", 4).alias("base"), F.round(F.col("share") / F.col("base"), 3).alias("lift"))


@query(with_sql(ACT) + LIFT + "SELECT topic, count(*) AS homes, string_agg(unit, '; ' ORDER BY unit) AS units FROM l WHERE share / base >= 1.1 AND n >= 25 GROUP BY 1")
def unit_homes(spark, d):
    """Topics' home units: enough lift and enough rows, joined in order."""
    homes = _lift(spark, d).where((F.col("share") / F.col("base") >= 1.1) & (F.col("n") >= 25))
    return homes.groupBy("topic").agg(F.count("*").alias("homes"), F.array_join(F.sort_array(F.collect_list("unit")), "; ").alias("units"))


@query("""
WITH x AS (SELECT l.doc_id, quality AS a, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS b FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s AS (SELECT count(*) AS n, avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) AS po, avg(CAST(a AS DOUBLE)) AS pa, avg(CAST(b AS DOUBLE)) AS pb FROM x)
SELECT n, round(po, 6) AS agreement, round((po - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))), 6) AS kappa FROM s""")
def kappa(spark, d):
    """Agreement of two raters beyond chance."""
    x = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality").cast("double").alias("a"), (F.col("n_chars") > 400).cast("double").alias("b"))
    s = x.agg(F.count("*").alias("n"), F.avg((F.col("a") == F.col("b")).cast("double")).alias("po"), F.avg("a").alias("pa"), F.avg("b").alias("pb"))
    chance = F.col("pa") * F.col("pb") + (1 - F.col("pa")) * (1 - F.col("pb"))
    return s.select("n", F.round("po", 6).alias("agreement"), F.round((F.col("po") - chance) / (1 - chance), 6).alias("kappa"))


@query(with_sql(ACT) + """
, c AS (SELECT topic, count(*) AS n, avg(CASE WHEN primary_subtopic IS NOT NULL THEN 1.0 ELSE 0.0 END) AS cover FROM act GROUP BY 1)
SELECT topic, n, round(cover, 6) AS coverage, topic IN ('Brand#11', 'Brand#12') AS exempt, NOT (topic IN ('Brand#11', 'Brand#12')) AND cover < 0.67 AS alert FROM c""")
def field_coverage(spark, d):
    """Coverage of a field by topic against a floor, with exempt topics."""
    c = activities(spark, d).groupBy("topic").agg(F.count("*").alias("n"), F.avg(F.col("primary_subtopic").isNotNull().cast("double")).alias("c"))
    exempt = F.col("topic").isin("Brand#11", "Brand#12")
    return c.select("topic", "n", F.round("c", 6).alias("coverage"), exempt.alias("exempt"), (~exempt & (F.col("c") < 0.67)).alias("alert"))


@query(with_sql(ACT) + "SELECT count(*) AS n, count(primary_subtopic) AS covered, round(avg(CASE WHEN primary_subtopic IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM act")
def coverage_fraction(spark, d):
    """Coverage over everything."""
    return activities(spark, d).agg(F.count("*").alias("n"), F.count("primary_subtopic").alias("covered"), F.round(F.avg(F.col("primary_subtopic").isNotNull().cast("double")), 6).alias("fraction"))


@query(with_sql(EV) + """
, e AS (SELECT * FROM ev WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'),
r AS (SELECT k, 'r' || CAST(user_id % 5 AS VARCHAR) AS reason, count(DISTINCT (user_id, day)) AS n FROM e GROUP BY 1, 2)
SELECT e.k, count(DISTINCT (user_id, day)) AS pairs, count(*) AS events, (SELECT string_agg(reason || '=' || CAST(n AS VARCHAR), ',' ORDER BY reason) FROM r WHERE r.k = e.k) AS reasons FROM e GROUP BY e.k HAVING count(DISTINCT (user_id, day)) >= 2""")
def critic_diagnostics(spark, d):
    """Distinct (run, set) pairs and their reasons in a closed window; at least two pairs."""
    e = event_rows(spark, d).where("event_type = 'error' and ts between timestamp '2024-01-05' and timestamp '2024-01-25'").withColumn("reason", F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")))
    pairs = e.groupBy("k").agg(F.countDistinct("user_id", "day").alias("pairs"), F.count("*").alias("events")).where("pairs >= 2")
    r = e.groupBy("k", "reason").agg(F.countDistinct("user_id", "day").alias("n")).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("reason", "n"))).alias("r"))
    return pairs.join(r, "k").select("k", "pairs", "events", F.array_join(F.transform("r", lambda x: F.concat(x["reason"], F.lit("="), x["n"].cast("string"))), ",").alias("reasons"))


@query(with_sql(ACT) + """
, top AS (SELECT primary_subtopic AS s FROM act WHERE primary_subtopic IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 100),
c AS (SELECT primary_subtopic AS s, count(DISTINCT pmid) AS n FROM act WHERE created_at >= TIMESTAMP '1999-01-01' AND primary_subtopic IN (SELECT s FROM top) GROUP BY 1 HAVING count(DISTINCT pmid) >= 5)
SELECT s AS subtopic, n, (SELECT count(*) FROM c) >= 3 AS gate_open FROM c""")
def dirty_gate(spark, d):
    """New publications of the top subtopics, with a floor each and a floor on how many subtopics reach it."""
    a = activities(spark, d).where("primary_subtopic is not null")
    top = a.groupBy("primary_subtopic").count().orderBy(F.col("count").desc(), "primary_subtopic").limit(100).select("primary_subtopic")
    c = a.where("created_at >= timestamp '1999-01-01'").join(top, "primary_subtopic", "left_semi").groupBy(F.col("primary_subtopic").alias("subtopic")).agg(F.countDistinct("pmid").alias("n")).where("n >= 5")
    return c.withColumn("gate_open", F.count("*").over(Window.partitionBy()) >= 3)


@query("""
WITH p(model, pin, pout) AS (VALUES ('click', 0.000003, 0.000015), ('view', 0.0000008, 0.000004), ('purchase', 0.000015, 0.000075))
SELECT event_type AS model, count(*) AS calls, sum(CAST(round(event_id % 1000 * CAST(pin AS DECIMAL(18,9)) + event_id % 300 * CAST(pout AS DECIMAL(18,9)), 6) AS DECIMAL(18,6))) AS cost FROM events JOIN p ON event_type = model GROUP BY 1""")
def cost_totals(spark, d):
    """Cost by model in decimals, rounded half up to six places a call."""
    dec = lambda x: F.lit(x).cast("decimal(18,9)")
    e = table(spark, d, "events")
    pin = F.when(F.col("event_type") == "click", dec("0.000003")).when(F.col("event_type") == "view", dec("0.0000008")).when(F.col("event_type") == "purchase", dec("0.000015"))
    pout = F.when(F.col("event_type") == "click", dec("0.000015")).when(F.col("event_type") == "view", dec("0.000004")).when(F.col("event_type") == "purchase", dec("0.000075"))
    cost = F.round((F.col("event_id") % 1000).cast("decimal(18,0)") * pin + (F.col("event_id") % 300).cast("decimal(18,0)") * pout, 6).cast("decimal(18,6)")
    return e.where(F.col("event_type").isin("click", "view", "purchase")).groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("calls"), F.sum(cost).alias("cost"))


@query(with_sql(EV) + """
, s AS (SELECT day, sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS spent FROM ev GROUP BY 1), r AS (SELECT day, spent, sum(spent) OVER (ORDER BY day) AS upto FROM s)
SELECT day, CAST(upto AS DOUBLE) AS upto, floor(CAST(upto AS DOUBLE) / 5000) > floor(CAST(upto - spent AS DOUBLE) / 5000) AS crossed FROM r""")
def spend_boundary(spark, d):
    """Running spend by day and the days on which it crosses a multiple of 5,000. Days are few, whatever the events."""
    s = event_rows(spark, d).groupBy("day").agg(F.sum(F.round("value", 2).cast("decimal(18,2)")).alias("spent"))
    upto = F.sum("spent").over(Window.orderBy("day"))
    r = s.withColumn("upto", upto)
    cross = F.floor(F.col("upto").cast("double") / 5000) > F.floor((F.col("upto") - F.col("spent")).cast("double") / 5000)
    return r.select("day", F.col("upto").cast("double").alias("upto"), cross.alias("crossed"))


@query(with_sql(ACT) + ", l AS (SELECT person, count(*) AS load FROM act GROUP BY 1) SELECT count(*) AS people, quantile_cont(load, 0.5) AS median_load FROM l")
def median_load(spark, d):
    """Exact median of people's loads."""
    l = activities(spark, d).groupBy("person").agg(F.count("*").alias("load"))  # noqa: E741
    return l.agg(F.count("*").alias("people"), F.percentile("load", 0.5).alias("median_load"))


@query(with_sql(EV) + "SELECT user_id, greatest(count(DISTINCT k), max(CASE WHEN event_type = 'purchase' THEN k ELSE 0 END)) AS n FROM ev GROUP BY 1")
def distinct_with_fallback(spark, d):
    """The larger of a distinct count and a reported total."""
    return event_rows(spark, d).groupBy("user_id").agg(F.greatest(F.countDistinct("k"), F.max(F.when(F.col("event_type") == "purchase", F.col("k")).otherwise(0)).cast("long")).alias("n"))


@query(with_sql(EV) + "SELECT day, count(*) AS n, count(CASE WHEN event_type = 'error' THEN 1 END) AS error, count(CASE WHEN event_type = 'view' THEN 1 END) AS view, count(CASE WHEN event_type = 'click' THEN 1 END) AS click FROM ev GROUP BY 1")
def status_histogram(spark, d):
    """Counts by day and status, pivoted."""
    p = event_rows(spark, d).groupBy("day").pivot("event_type", ["error", "view", "click"]).agg(F.count("event_id"))
    n = event_rows(spark, d).groupBy("day").agg(F.count("*").alias("n"))
    return p.na.fill(0).join(n, "day")


@query("SELECT lang, count(*) AS n, round(avg(CASE WHEN regexp_matches(substr(text, 1, 1), '[a-z]') OR NOT regexp_matches(text, '[.!?]$') THEN 1.0 ELSE 0.0 END), 6) AS fragments FROM documents GROUP BY 1")
def fragment_share(spark, d):
    """Share of texts that open in lower case or don't end a sentence."""
    frag = F.substring("text", 1, 1).rlike("[a-z]") | ~F.substring("text", -1, 1).rlike("[.!?]")
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(frag.cast("double")), 6).alias("fragments"))
