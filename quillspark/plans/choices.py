"""Selections with diversity, best relations, fallback joins and classifications of opportunities."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.grants import EVERYONE, FOR_EVERYONE, STAGE_WORDS, UNNAMED, stage_appeals
from quillspark.functions.scores import logit, noisy_or, sigmoid, soft_gate
from quillspark.operators.blocks import small
from quillspark.operators.ranking import top_k
from quillspark.operators.selection import diverse, penalised
from quillspark.plans.registry import query
from quillspark.plans.rollups import pool_rank
from quillspark.plans.views import ACT, PUB, activities, publications, subtopic_members, with_sql
from quillspark.operators.overlap import min_card, pair_counts
from quillspark.sources.tables import table


@query()
def diverse_selection(spark, d):
    """Twenty-five subtopics of distinct parents without near clones, eight at least."""
    pool = pool_rank(spark, d).select(F.col("subtopic").alias("id"), "parent", F.col("pool_score").alias("score"))
    members = subtopic_members(spark, d).select("subtopic", "pmid").join(pool.select(F.col("id").alias("subtopic")), "subtopic", "left_semi")
    clones = pair_counts(members, "subtopic", "pmid").where(min_card() >= 0.05).select("a", "b")
    return diverse(pool, clones, 25, 8)


@query()
def penalised_selection(spark, d):
    """Subtopics picked with an escalating penalty for their leading person."""
    pool = pool_rank(spark, d).select(F.col("subtopic").alias("id"), F.col("pool_score").alias("score"))
    n = activities(spark, d).where("primary_subtopic is not null").groupBy(F.col("primary_subtopic").alias("id"), "person").agg(F.count("*").alias("n"))
    lead = top_k(n.join(pool.select("id"), "id", "left_semi"), ["id"], [F.col("n").desc(), F.col("person")], 1).select("id", F.col("person").alias("scholar"))
    return penalised(pool.join(lead, "id"), 25)


@query(with_sql(ACT) + """
, t AS (SELECT pmid, topic, max(score) AS s, bool_or(line <= 2) AS dense FROM act GROUP BY 1, 2), m AS (SELECT pmid FROM t GROUP BY 1 HAVING max(s) < 0.4),
c AS (SELECT t.*, bool_or(dense) OVER (PARTITION BY t.pmid) AS any_dense FROM t JOIN m ON t.pmid = m.pmid),
r AS (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY s DESC, topic) AS rn FROM c WHERE dense OR NOT any_dense)
SELECT pmid, string_agg(topic || '=' || CAST(CAST(round(s * 10) AS INTEGER) AS VARCHAR), ',' ORDER BY rn) AS top3 FROM r WHERE rn <= 3 GROUP BY 1""")
def uncovered_top3(spark, d):
    """Publications under the floor everywhere, with their best three topics: dense scores if there are any, else screening ones."""
    t = activities(spark, d).groupBy("pmid", "topic").agg(F.max("score").alias("s"), F.bool_or(F.col("line") <= 2).alias("dense"))
    w = Window.partitionBy("pmid")
    c = t.withColumns({"best": F.max("s").over(w), "any": F.bool_or("dense").over(w)}).where("best < 0.4 and (dense or not any)")
    top = c.groupBy("pmid").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("m"), "topic"))), 1, 3).alias("t"))
    return top.select("pmid", F.array_join(F.transform("t", lambda x: F.concat(x["topic"], F.lit("="), F.round(-x["m"] * 10).cast("int").cast("string"))), ",").alias("top3"))


@query("""
WITH u AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+ [a-z]+ [a-z]+')) AS p FROM documents WHERE lang = 'en'),
s AS (SELECT DISTINCT doc_id, p FROM u UNION SELECT DISTINCT doc_id, regexp_extract(p, '^[^ ]+ [^ ]+') FROM u UNION SELECT DISTINCT doc_id, regexp_extract(p, '^[^ ]+ [^ ]+ [^ ]+') FROM u),
f AS (SELECT p, count(*) AS df, length(p) - length(replace(p, ' ', '')) + 1 AS n FROM s GROUP BY 1 HAVING count(*) >= 3)
SELECT a.p AS phrase, a.df FROM f a WHERE NOT EXISTS (SELECT 1 FROM f b WHERE b.df = a.df AND b.n > a.n AND starts_with(b.p, a.p || ' '))""")
def phrase_collapse(spark, d):
    """Phrases and their leading parts by document frequency; a part as frequent as a longer phrase folds into it."""
    p = F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ [a-z]+ [a-z]+ [a-z]+"), 0))
    u = table(spark, d, "documents").where("lang = 'en'").select("doc_id", p.alias("p"))
    lead = lambda k: F.substring_index("p", " ", k)
    s = u.select("doc_id", F.explode(F.array("p", lead(2), lead(3))).alias("p")).distinct()
    f = s.groupBy("p").agg(F.count("*").alias("df")).where("df >= 3").withColumn("n", F.size(F.split("p", " ")))
    longer = f.where("n > 2").select(F.explode(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda k: F.array_join(F.slice(F.split("p", " "), 1, k), " "))).alias("p"), "df")
    return f.join(longer, ["p", "df"], "left_anti").select(F.col("p").alias("phrase"), "df")


@query(with_sql(ACT) + """
, r AS (SELECT person, topic, CASE position WHEN 'first' THEN 'exact' WHEN 'last' THEN 'broad' ELSE 'related' END AS relation, CASE position WHEN 'first' THEN 0 WHEN 'last' THEN 1 ELSE 2 END AS k FROM act)
SELECT person, topic, min_by(relation, k) AS relation FROM r GROUP BY 1, 2""")
def best_relation(spark, d):
    """The closest of the relations found."""
    p = F.col("position")
    k = F.when(p == "first", 0).when(p == "last", 1).otherwise(2)
    name = F.when(p == "first", "exact").when(p == "last", "broad").otherwise("related")
    return activities(spark, d).groupBy("person", "topic").agg(F.min_by(name, k).alias("relation"))


@query("""
WITH q AS (SELECT DISTINCT p_name AS t, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k FROM part), w AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN (SELECT min(k) FROM q WHERE length(k) > n_nationkey % 5 + 8) ELSE substr((SELECT max(k) FROM q), 1, 4) END AS k FROM nation),
e AS (SELECT w.id, w.k, min(q.t) AS t FROM w LEFT JOIN q ON w.k = q.k GROUP BY 1, 2), c AS (SELECT e.id, min(q.t) AS t FROM e JOIN q ON e.t IS NULL AND (contains(q.k, e.k) OR contains(e.k, q.k)) GROUP BY 1)
SELECT e.id, coalesce(e.t, c.t) AS title, CASE WHEN e.t IS NOT NULL THEN 'exact' WHEN c.t IS NOT NULL THEN 'contains' ELSE 'none' END AS how FROM e LEFT JOIN c ON e.id = c.id""")
def title_fallback(spark, d):
    """Exact normalised titles, else the first title that contains the other or is contained (a small title list)."""
    q = table(spark, d, "part").select(F.col("p_name").alias("t")).distinct().withColumn("k", T.norm_name(F.col("t")))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"))
    lens = q.select("k", F.explode(F.sequence(F.lit(8), F.lit(12))).alias("n")).where("length(k) > n").groupBy("n").agg(F.min("k").alias("mk"))
    top = q.agg(F.substring(F.max("k"), 1, 4).alias("part"))
    w = nation.withColumn("n", (F.col("id") % 5 + 8).cast("int")).join(small(lens), "n", "left").join(F.broadcast(top)).select("id", F.when(F.col("id") % 2 == 0, F.col("mk")).otherwise(F.col("part")).alias("wk"))
    e = w.join(q.groupBy("k").agg(F.min("t").alias("t")), F.col("wk") == F.col("k"), "left").select("id", "wk", "t")
    c = q.join(small(e.where("t is null").drop("t")), F.col("k").contains(F.col("wk")) | F.col("wk").contains(F.col("k"))).groupBy("id").agg(F.min("t").alias("ct"))
    return e.join(c, "id", "left").select("id", F.coalesce("t", "ct").alias("title"), F.when(F.col("t").isNotNull(), "exact").when(F.col("ct").isNotNull(), "contains").otherwise("none").alias("how"))


@query(with_sql(ACT) + """
, fam(label, tier, k) AS (VALUES ('Brand#11', 'distinctive', 0), ('Brand#12', 'moderate', 1), ('Brand#13', 'moderate', 1), ('Brand#21', 'common', 2)),
h AS (SELECT DISTINCT a.pmid, f.label, f.tier, f.k FROM act a JOIN fam f ON lower(a.topic) = lower(f.label))
SELECT pmid, tier, label FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY k, label) AS rn FROM h) WHERE rn = 1""")
def method_tier(spark, d):
    """The strongest tier of method evidence of each publication (a fixed short dictionary)."""
    fam = spark.createDataFrame([("brand#11", "distinctive", 0), ("brand#12", "moderate", 1), ("brand#13", "moderate", 1), ("brand#21", "common", 2)], "low string, tier string, k int")
    h = activities(spark, d).select("pmid", F.col("topic").alias("label"), F.lower("topic").alias("low")).join(F.broadcast(fam), "low")
    best = h.groupBy("pmid").agg(F.min(F.struct("k", "label", "tier")).alias("b"))
    return best.select("pmid", "b.tier", "b.label")


@query("""
SELECT 'customer' AS source, c_custkey AS id, n_name AS ref FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000
UNION ALL SELECT 'supplier', s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 5000 UNION ALL SELECT 'region', r_regionkey, r_name FROM region""")
def crosswalk(spark, d):
    """One row for each reference entry of several sources."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    c = table(spark, d, "customer").where("c_acctbal > 9000").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("n_name").alias("ref"))
    s = table(spark, d, "supplier").where("s_acctbal > 5000").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"), F.col("n_name").alias("ref"))
    r = table(spark, d, "region").select(F.lit("region").alias("source"), F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("ref"))
    return c.unionByName(s).unionByName(r)


@query(with_sql(ACT) + """
, valid AS (SELECT DISTINCT primary_subtopic AS id FROM act WHERE primary_subtopic LIKE '%_00%')
SELECT pmid, other_subtopic AS id, max(score) AS confidence FROM act WHERE score >= 0.3 AND other_subtopic IN (SELECT id FROM valid) GROUP BY 1, 2""")
def valid_assignments(spark, d):
    """Assignments in a closed vocabulary at or above the floor; of repeats the most confident."""
    a = activities(spark, d)
    valid = a.where("primary_subtopic like '%_00%'").select(F.col("primary_subtopic").alias("id")).distinct()
    return a.where("score >= 0.3").select("pmid", F.col("other_subtopic").alias("id"), "score").join(valid, "id", "left_semi").groupBy("pmid", "id").agg(F.max("score").alias("confidence"))


OPP = """o AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 8 AS INTEGER) WHEN 0 THEN 'Best Young Scientist Prize' WHEN 1 THEN 'Pilot award for early career investigators' WHEN 2 THEN 'Outstanding Service Award' WHEN 3 THEN 'Elected to the hall of fame' WHEN 4 THEN 'R01 program for senior faculty' WHEN 5 THEN 'Postdoctoral fellowship' WHEN 6 THEN 'Open to all faculty' ELSE 'Study of ' || o_orderpriority END AS title,
 CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN 'Jane Roe' || chr(10) || 'Grants Management Specialist' WHEN 1 THEN '' ELSE 'National Agency' END AS agency, CASE WHEN o_orderkey % 2 = 0 THEN 'American Heart Association' ELSE 'Society of Things' END AS parent, CASE WHEN o_orderkey % 5 = 0 THEN 'PAR-24-R21-' || CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 5 = 1 THEN 'DP2 new' ELSE 'none' END AS number FROM orders)"""


def _opps(spark, d):
    k = F.col("o_orderkey")
    pick = lambda c, n, *xs: F.element_at(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs]), (c % n + 1).cast("int"))
    title = pick(k, 8, "Best Young Scientist Prize", "Pilot award for early career investigators", "Outstanding Service Award", "Elected to the hall of fame", "R01 program for senior faculty", "Postdoctoral fellowship", "Open to all faculty", F.concat(F.lit("Study of "), F.col("o_orderpriority")))
    number = F.when(k % 5 == 0, F.concat(F.lit("PAR-24-R21-"), k.cast("string"))).when(k % 5 == 1, "DP2 new").otherwise("none")
    return table(spark, d, "orders").select(k.alias("id"), title.alias("title"), pick(k, 3, "Jane Roe\nGrants Management Specialist", "", "National Agency").alias("agency"), F.when(k % 2 == 0, "American Heart Association").otherwise("Society of Things").alias("parent"), number.alias("number"))


@query("WITH " + OPP + """
SELECT id, CASE WHEN agency <> '' AND NOT contains(agency, chr(10)) THEN agency ELSE parent END AS sponsor, regexp_extract(number, '\\b([A-Z][0-9]{2}|[A-Z]{2}[0-9])\\b', 1) AS code FROM o""")
def sponsor_and_code(spark, d):
    """The first sponsor that isn't a contact, and the activity code."""
    contact = F.col("agency").contains("\n") | F.lower("agency").rlike(r"\b(grantor|grants?\s+(management\s+)?(specialist|manager|officer|analyst)|procurement\s+analyst)\b")
    return _opps(spark, d).select("id", F.when((F.col("agency") != "") & ~contact, F.col("agency")).otherwise(F.col("parent")).alias("sponsor"), F.regexp_extract("number", r"\b([A-Z]\d{2}|[A-Z]{2}\d)\b", 1).alias("code"))


#: Words of honours, of recognitions, and of awards that one applies for (fixed values).
HON = r"\b(prizes?|prix|medals?|lectureships?|laureate)\b"
REC = r"\b(designation|named (chair|professorship)|endowed (chair|professorship)|election to|elected to|hall of fame)\b"
APP = r"\b(fellowships?|scholarships?|travel|pilot|seed|career[ -]development|seminar|residency|internship|traineeship|sabbatical)\b"


@query("WITH " + OPP + f""", h AS (SELECT id, lower(title) AS t, lower(parent) AS s, regexp_extract(number, '\\b([A-Z][0-9]{{2}}|[A-Z]{{2}}[0-9])\\b', 1) AS code FROM o)
SELECT id, regexp_matches(t, '{HON}') OR regexp_matches(t, '{REC}') OR (regexp_matches(t, '\\bawards?\\b') AND code = '' AND NOT regexp_matches(t, '{APP}') AND NOT contains(s, 'american heart association')) AS honorific FROM h""")
def honorific(spark, d):
    """Honours that nobody applies for: by their words, or awards without code, applicable kind or granting sponsor."""
    t, code = F.lower("title"), F.regexp_extract("number", r"\b([A-Z]\d{2}|[A-Z]{2}\d)\b", 1)
    award = t.rlike(r"\bawards?\b") & (code == "") & ~t.rlike(APP) & ~F.lower("parent").contains("american heart association")
    return _opps(spark, d).select("id", (t.rlike(HON) | t.rlike(REC) | award).alias("honorific"))


def _sql_has(words) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in words) + ")"


_STAGED = ", ".join(f"{_sql_has(words)} AS {s}" for s, words in STAGE_WORDS.items())
_APPEALS = ", ".join(f"CASE WHEN everyone THEN {FOR_EVERYONE[s]} WHEN NOT ({' OR '.join(STAGE_WORDS)}) THEN {UNNAMED[s]} WHEN {s} THEN 0.9 ELSE 0.1 END::DOUBLE AS {s}" for s in STAGE_WORDS)


@query("WITH " + OPP + f""", t AS (SELECT id, lower(title) AS t FROM o), n AS (SELECT id, {_sql_has(EVERYONE)} AS everyone, {_STAGED} FROM t)
SELECT id, {_APPEALS} FROM n""")
def career_appeal(spark, d):
    """Appeal by career stage."""
    return _opps(spark, d).select("id", stage_appeals(F.col("title")).alias("a")).select("id", "a.*")


@query("""
WITH b AS (SELECT item_id, text AS s, lower(split_part(text, ' ', 4)) AS f FROM benchmark)
SELECT item_id, CASE WHEN instr(lower(s), f) > 0 THEN instr(lower(s), f) - 1 END AS start, CASE WHEN instr(lower(s), f) > 0 THEN instr(lower(s), f) - 1 + length(f) END AS stop, round(1 - CASE WHEN instr(lower(s), f) > 0 THEN (instr(lower(s), f) - 1) / length(s) ELSE 1.0 END, 4) AS centrality FROM b""")
def matched_span(spark, d):
    """Where a name stands in its sentence, and how early."""
    b = table(spark, d, "benchmark").select("item_id", F.col("text").alias("s"), T.plain_lower(F.split_part("text", F.lit(" "), F.lit(4))).alias("f"))
    at = F.call_function("instr", T.plain_lower(F.col("s")), F.col("f"))
    return b.select("item_id", F.when(at > 0, at - 1).alias("start"), F.when(at > 0, at - 1 + F.length("f")).alias("stop"), F.round(1 - T.first_fraction(F.col("s"), F.col("f")), 4).alias("centrality"))


@query("""
WITH p AS (SELECT p_partkey AS id, lower(p_name) AS n, p_type AS kind, p_size AS size FROM part)
SELECT id, array_to_string(list_filter([CASE WHEN contains(n, 'green') AND kind LIKE 'ECONOMY%' THEN 'named_green_as_economy' END, CASE WHEN size > 40 AND kind LIKE 'SMALL%' THEN 'large_small' END, CASE WHEN length(n) < 5 THEN 'short_name' END], lambda x: x IS NOT NULL), ',') AS flags FROM p""")
def routing_flags(spark, d):
    """Names that don't fit their class."""
    n, kind = F.lower("p_name"), F.col("p_type")
    flags = F.array(F.when(n.contains("green") & kind.startswith("ECONOMY"), "named_green_as_economy"), F.when((F.col("p_size") > 40) & kind.startswith("SMALL"), "large_small"), F.when(F.length(n) < 5, "short_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(F.array_compact(flags), ",").alias("flags"))


@query("WITH " + OPP + """, e AS (SELECT id, lower(title || ' ' || parent) AS t FROM o)
SELECT id, array_to_string(list_filter([CASE WHEN regexp_matches(t, 'postdoc|fellow') THEN 'postdoc' END, CASE WHEN regexp_matches(t, 'faculty|investigator') THEN 'faculty' END, CASE WHEN regexp_matches(t, 'young|early') THEN 'early' END], lambda x: x IS NOT NULL), ';') AS flags FROM e""")
def eligibility_flags(spark, d):
    """Who may apply, by word lists."""
    t = F.lower(F.concat("title", F.lit(" "), "parent"))
    flags = F.array(F.when(t.rlike("postdoc|fellow"), "postdoc"), F.when(t.rlike("faculty|investigator"), "faculty"), F.when(t.rlike("young|early"), "early"))
    return _opps(spark, d).select("id", F.array_join(F.array_compact(flags), ";").alias("flags"))


@query(with_sql(ACT) + """
, c AS (SELECT pmid, topic, max(score) AS s, count(*) AS n FROM act GROUP BY 1, 2)
SELECT pmid, topic, round(1 / (1 + exp(-(-0.5 + 0.8 * ln(least(greatest(s, 0.01), 0.99) / (1 - least(greatest(s, 0.01), 0.99)))))), 6) AS calibrated, round(1 - (1 - s / 2) * (1 - 0.4), 6) AS screened, round(1 / (1 + power(2.0 / n, 3.0)), 6) AS gate FROM c""")
def calibrated_scores(spark, d):
    """Calibrated probabilities, screening likelihoods and soft gates."""
    c = activities(spark, d).groupBy("pmid", "topic").agg(F.max("score").alias("s"), F.count("*").alias("n"))
    p = F.least(F.greatest(F.col("s"), F.lit(0.01)), F.lit(0.99))
    return c.select("pmid", "topic", F.round(sigmoid(-0.5 + 0.8 * logit(p)), 6).alias("calibrated"), F.round(noisy_or(F.col("s") / 2, F.lit(0.4)), 6).alias("screened"), F.round(soft_gate(F.col("n"), 2.0, 3.0), 6).alias("gate"))


@query(with_sql(ACT) + """
, l AS (SELECT pmid, person, year, row_number() OVER (PARTITION BY pmid ORDER BY line DESC) AS rn FROM act)
SELECT person AS head, count(DISTINCT pmid) AS papers, min(year) AS since, max(year) AS until FROM l WHERE rn = 1 GROUP BY 1""")
def lab_heads(spark, d):
    """Last authors as heads of labs, with their papers and years."""
    last = activities(spark, d).groupBy("pmid").agg(F.max(F.struct("line", "person", "year")).alias("l"))
    return last.groupBy(F.col("l.person").alias("head")).agg(F.countDistinct("pmid").alias("papers"), F.min("l.year").alias("since"), F.max("l.year").alias("until"))


@query("""
WITH h AS (SELECT user_id, event_type AS version, ts, value FROM events WHERE event_type IN ('click', 'view')), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, version) AS rn FROM h)
SELECT h.user_id, count(*) AS shown, count(DISTINCT h.version) AS versions, max(h.ts) AS last_shown, max(CASE WHEN rn = 1 THEN r.version END) AS last_version FROM h JOIN r ON h.user_id = r.user_id AND h.ts = r.ts AND h.version = r.version AND h.value = r.value GROUP BY 1""")
def history_fold(spark, d):
    """Histories of several versions folded to a row each."""
    h = table(spark, d, "events").where("event_type in ('click', 'view')")
    g = h.groupBy("user_id").agg(F.count("*").alias("shown"), F.countDistinct("event_type").alias("versions"), F.max("ts").alias("last_shown"), F.min(F.struct((-F.unix_micros(F.col("ts").cast("timestamp"))).alias("m"), "event_type"))["event_type"].alias("last_version"))
    return g


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL AS valid FROM events""")
def schema_check(spark, d):
    """Whether a record reads under its schema."""
    parsed = F.from_json("props", "k int, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return table(spark, d, "events").select("event_id", (parsed["_corrupt"].isNull() & parsed["k"].isNotNull()).alias("valid"))


@query(with_sql(PUB) + """
SELECT owner, status, count(*) AS n, CASE WHEN count(*) >= 3 AND bool_and(academic) THEN 'done' WHEN bool_or(academic) THEN 'partial' ELSE 'pending' END AS terminal FROM pub GROUP BY 1, 2""")
def terminal_status(spark, d):
    """The terminal state of each run."""
    g = publications(spark, d).groupBy("owner", "status").agg(F.count("*").alias("n"), F.bool_and("academic").alias("all"), F.bool_or("academic").alias("any"))
    return g.select("owner", "status", "n", F.when((F.col("n") >= 3) & F.col("all"), "done").when(F.col("any"), "partial").otherwise("pending").alias("terminal"))
