"""Extracts, semi-joins, theta joins and nested joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators.blocks import against
from quillspark.operators.ranking import top_k
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, PUB, activities, publications, with_sql
from quillspark.sources.tables import table


@query(with_sql(PUB) + """
SELECT p.pmid, p.year, d.lang, coalesce(length(d.text), 0) AS abstract_chars FROM pub p LEFT JOIN documents d ON p.pmid = d.doc_id WHERE academic AND year >= 1997""")
def corpus_extract(spark, d):
    """Academic publications from a year on, with their abstract where there is one."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.length("text").alias("n"))
    p = publications(spark, d).where("academic and year >= 1997")
    return p.join(docs, p["pmid"] == docs["doc_id"], "left").select("pmid", "year", "lang", F.coalesce("n", F.lit(0)).alias("abstract_chars"))


@query(with_sql(PUB) + """
SELECT pmid, year FROM pub p WHERE pmid > 8000 AND EXISTS (
  SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_orderkey = p.pmid AND s_acctbal > 2000) ORDER BY pmid LIMIT 500""")
def new_since_watermark(spark, d):
    """Publications above a watermark with any faculty author (correlated EXISTS as a semi-join), lowest ids first."""
    faculty = table(spark, d, "supplier").where("s_acctbal > 2000").select("s_suppkey")
    authored = table(spark, d, "lineitem").where("l_orderkey > 8000").join(faculty, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select(F.col("l_orderkey").alias("pmid"))
    return publications(spark, d).where("pmid > 8000").join(authored, "pmid", "left_semi").select("pmid", "year").orderBy("pmid").limit(500)


@query(with_sql(ACT) + "SELECT a.pmid, a.person, a.position, s_name || ' of ' || n_name AS label FROM act a JOIN supplier ON person = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 2000")
def author_mapping(spark, d):
    """Authors that are faculty, with identity."""
    s = table(spark, d, "supplier").where("s_acctbal > 2000").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    ident = s.select(F.col("s_suppkey").alias("person"), F.concat("s_name", F.lit(" of "), "n_name").alias("label"))
    return activities(spark, d).select("pmid", "person", "position").join(ident, "person")


@query(with_sql(ACT, PUB) + """
SELECT DISTINCT a.person, a.pmid, d.doc_id IS NOT NULL AND length(d.text) > 0 AS has_text FROM act a JOIN supplier ON person = s_suppkey AND s_acctbal > 2000
JOIN pub p ON a.pmid = p.pmid AND academic LEFT JOIN documents d ON d.doc_id = a.pmid""")
def faculty_gap(spark, d):
    """Distinct faculty publications of a kind, with a flag for those that have a text."""
    faculty = table(spark, d, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("person"))
    live = publications(spark, d).where("academic").select("pmid")
    docs = table(spark, d, "documents").where(F.length("text") > 0).select(F.col("doc_id").alias("pmid"), F.lit(True).alias("t"))
    rows = activities(spark, d).select("person", "pmid").join(faculty, "person", "left_semi").join(live, "pmid", "left_semi").distinct()
    return rows.join(docs, "pmid", "left").select("person", "pmid", F.coalesce("t", F.lit(False)).alias("has_text"))


@query(with_sql(ACT) + """
, changed AS (SELECT DISTINCT pmid FROM act WHERE pmid % 97 = 0)
SELECT DISTINCT person FROM act WHERE pmid IN (SELECT pmid FROM changed)""")
def dirty_persons(spark, d):
    """People touched by a set of changed publications."""
    a = activities(spark, d)
    return a.join(a.where("pmid % 97 = 0").select("pmid").distinct(), "pmid", "left_semi").select("person").distinct()


@query("""
WITH prefixes(core, prefix) AS (VALUES ('c1', 'ECONOMY A'), ('c1', 'SMALL'), ('c2', 'LARGE BR'), ('c3', 'STANDARD'))
SELECT DISTINCT core, l_orderkey AS pmid FROM lineitem JOIN part ON l_partkey = p_partkey JOIN prefixes ON starts_with(p_type, prefix) WHERE l_shipdate >= TIMESTAMP '1997-01-01'""")
def prefix_tree_match(spark, d):
    """Publications with a descriptor under any of a core's prefixes. The prefixes are a fixed short list."""
    prefixes = spark.createDataFrame([("c1", "ECONOMY A"), ("c1", "SMALL"), ("c2", "LARGE BR"), ("c3", "STANDARD")], "core string, prefix string")
    p = table(spark, d, "part").select("p_partkey", "p_type").join(F.broadcast(prefixes), F.expr("startswith(p_type, prefix)"))
    li = table(spark, d, "lineitem").where("l_shipdate >= timestamp '1997-01-01'").select("l_orderkey", "l_partkey")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("core", F.col("l_orderkey").alias("pmid")).distinct()


@query(with_sql(PUB) + "SELECT owner, year, count(DISTINCT pmid) AS n FROM pub WHERE academic GROUP BY 1, 2")
def author_year_totals(spark, d):
    """Distinct publications of each owner and year within the corpus."""
    return publications(spark, d).where("academic").groupBy("owner", "year").agg(F.countDistinct("pmid").alias("n"))


@query(with_sql(ACT, PUB) + """
, lead AS (SELECT a.pmid, a.person, s_name, row_number() OVER (PARTITION BY a.pmid ORDER BY s_name IS NULL, CASE position WHEN 'first' THEN 0 WHEN 'last' THEN 1 ELSE 2 END, line) AS rn
  FROM act a LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 2000) ON person = s_suppkey)
SELECT pmid, person, s_name AS lead FROM lead WHERE rn = 1""")
def lead_resolution(spark, d):
    """Each publication's lead: known people first, then by position and order."""
    s = table(spark, d, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("person"), "s_name")
    place = F.when(F.col("position") == "first", 0).when(F.col("position") == "last", 1).otherwise(2)
    rows = activities(spark, d).join(s, "person", "left")
    return top_k(rows, ["pmid"], [F.col("s_name").isNull(), place, F.col("line")], 1).select("pmid", "person", F.col("s_name").alias("lead"))


@query(with_sql(ACT) + "SELECT pmid, count(*) AS n, string_agg(CAST(person AS VARCHAR) || '/' || position, '; ' ORDER BY line) AS authors FROM act GROUP BY pmid")
def authors_nested(spark, d):
    """Publications with their authors in order, nested."""
    rows = activities(spark, d).groupBy("pmid").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("line", "person", "position"))).alias("a"))
    return rows.select("pmid", "n", F.array_join(F.transform("a", lambda x: F.concat(x["person"].cast("string"), F.lit("/"), x["position"])), "; ").alias("authors"))


@query(with_sql(ACT) + """
, s AS (SELECT DISTINCT pmid, topic, score FROM act WHERE score >= 0.3), au AS (SELECT pmid, person, min(CASE position WHEN 'first' THEN 0 WHEN 'last' THEN 1 ELSE 2 END) AS k FROM act GROUP BY 1, 2),
b AS (SELECT pmid, topic, max(score) AS score FROM s GROUP BY 1, 2)
SELECT b.pmid, b.topic, au.person, b.score, CASE k WHEN 0 THEN 'first' WHEN 1 THEN 'last' ELSE 'middle' END AS position FROM b JOIN au ON b.pmid = au.pmid""")
def activity_builder(spark, d):
    """Within each publication every topic at or above the floor meets every author, once, in the author's best position."""
    a = activities(spark, d)
    scores = a.where("score >= 0.3").groupBy("pmid", "topic").agg(F.max("score").alias("score"))
    rank = F.when(F.col("position") == "first", 0).when(F.col("position") == "last", 1).otherwise(2)
    authors = a.groupBy("pmid", "person").agg(F.min_by("position", rank).alias("position"))
    return scores.join(authors, "pmid")


@query("""
WITH raw AS (SELECT o_orderkey AS pmid, CASE CAST(o_orderkey % 6 AS INTEGER) WHEN 0 THEN 'First' WHEN 1 THEN ' last ' WHEN 2 THEN 'None' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'senior' END AS p FROM orders)
SELECT pmid, CASE WHEN lower(trim(p)) IN ('first', 'last') THEN lower(trim(p)) ELSE 'middle' END AS position FROM raw""")
def position_normal(spark, d):
    """First and last stay; null, blank and anything else is middle."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("pmid"))
    p = F.element_at(F.array(F.lit("First"), F.lit(" last "), F.lit("None"), F.lit(None).cast("string"), F.lit(""), F.lit("senior")), (F.col("pmid") % 6 + 1).cast("int"))
    clean = F.lower(F.trim(p))
    return o.select("pmid", F.when(clean.isin("first", "last"), clean).otherwise("middle").alias("position"))


@query(with_sql(ACT) + """
, names AS (SELECT topic, n.n_name FROM (SELECT DISTINCT topic FROM act) CROSS JOIN nation n WHERE n.n_nationkey < 10),
pairs AS (SELECT lower(topic) AS k, n_name FROM names)
, ap AS (SELECT DISTINCT pmid, person, year FROM act), seed AS (SELECT DISTINCT pmid FROM ap WHERE person <= 3),
co AS (SELECT ap.person, count(DISTINCT ap.pmid) AS papers FROM ap JOIN seed ON ap.pmid = seed.pmid WHERE ap.person > 3 GROUP BY 1),
br AS (SELECT a.person, count(DISTINCT s.person) AS breadth, max(a.year) AS newest FROM ap a JOIN ap s ON a.pmid = s.pmid AND s.person <= 3 WHERE a.person > 3 GROUP BY 1)
SELECT co.person, s_acctbal > 2000 AS is_staff, newest >= 2000 AS recent, breadth, papers, CAST(row_number() OVER (ORDER BY s_acctbal > 2000 DESC, newest >= 2000 DESC, breadth DESC, papers DESC, co.person) AS INTEGER) AS place
FROM co JOIN br ON co.person = br.person JOIN supplier ON co.person = s_suppkey WHERE papers >= 2""")
def staff_suggest(spark, d):
    """Co-authors of seed people, ranked by staff, recency, breadth of seeds and shared papers."""
    ap = activities(spark, d).select("pmid", "person", "year").distinct()
    seed = ap.where("person <= 3").select("pmid", F.col("person").alias("seed"))
    co = ap.where("person > 3").join(seed, "pmid").groupBy("person").agg(F.countDistinct("pmid").alias("papers"), F.countDistinct("seed").alias("breadth"), F.max("year").alias("newest")).where("papers >= 2")
    staff = table(spark, d, "supplier").select(F.col("s_suppkey").alias("person"), (F.col("s_acctbal") > 2000).alias("is_staff"))
    rows = co.join(staff, "person").withColumn("recent", F.col("newest") >= 2000)
    w = Window.orderBy(F.col("is_staff").desc(), F.col("recent").desc(), F.col("breadth").desc(), F.col("papers").desc(), "person")
    return rows.select("person", "is_staff", "recent", "breadth", "papers", F.row_number().over(w).alias("place"))


@query(with_sql(ACT, PUB) + """
, confirmed AS (SELECT DISTINCT person, pmid, year FROM act WHERE score >= 0.9), span AS (
  SELECT s_suppkey AS person, 1995 + CAST(s_suppkey % 4 AS INTEGER) AS start_year, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 1998 + CAST(s_suppkey % 3 AS INTEGER) END AS end_year FROM supplier)
SELECT c.person, count(*) AS n FROM confirmed c LEFT JOIN span s ON c.person = s.person
WHERE start_year IS NULL OR (year >= start_year - 3 AND (end_year IS NULL OR year <= end_year + 2)) GROUP BY 1""")
def tenure_gated(spark, d):
    """Confirmed papers within a person's appointment, three years early and two late; no span means not gated."""
    confirmed = activities(spark, d).where("score >= 0.9").select("person", "pmid", "year").distinct()
    key = F.col("s_suppkey")
    span = table(spark, d, "supplier").select(key.alias("person"), (1995 + (key % 4).cast("int")).alias("start_year"), F.when(key % 3 != 0, 1998 + (key % 3).cast("int")).alias("end_year"))
    ok = F.col("start_year").isNull() | ((F.col("year") >= F.col("start_year") - 3) & (F.col("end_year").isNull() | (F.col("year") <= F.col("end_year") + 2)))
    return confirmed.join(span, "person", "left").where(ok).groupBy("person").agg(F.count("*").alias("n"))


@query("""
WITH m1 AS (SELECT doc_id, quality AS a FROM labels), m2 AS (SELECT doc_id, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS b FROM documents WHERE doc_id % 5 <> 0), adj AS (SELECT doc_id, 1 AS c FROM documents WHERE doc_id % 11 = 0)
SELECT coalesce(m1.doc_id, m2.doc_id) AS doc_id, coalesce(c, CASE WHEN a = b THEN a END, least(a, b), a, b) AS verdict,
       CASE WHEN c IS NOT NULL THEN 'adjudicated' WHEN a = b THEN 'agreed' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'split' ELSE 'single' END AS basis
FROM m1 FULL JOIN m2 ON m1.doc_id = m2.doc_id LEFT JOIN adj ON adj.doc_id = coalesce(m1.doc_id, m2.doc_id)""")
def agreement_merge(spark, d):
    """Two mappers joined outright, adjudications above agreement above a split vote above a single one."""
    m1 = table(spark, d, "labels").select("doc_id", F.col("quality").alias("a"))
    docs = table(spark, d, "documents")
    m2 = docs.where("doc_id % 5 <> 0").select("doc_id", (F.col("n_chars") > 400).cast("int").alias("b"))
    adj = docs.where("doc_id % 11 = 0").select("doc_id", F.lit(1).alias("c"))
    rows = m1.join(m2, "doc_id", "full").join(adj, "doc_id", "left")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    basis = F.when(c.isNotNull(), "adjudicated").when(a == b, "agreed").when(a.isNotNull() & b.isNotNull(), "split").otherwise("single")
    return rows.select("doc_id", F.coalesce(c, F.when(a == b, a), F.least(a, b), a, b).alias("verdict"), basis.alias("basis"))


@query("""
WITH q AS (SELECT item_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS t FROM benchmark), p AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS x FROM documents)
SELECT item_id, min(doc_id) AS first_doc, count(*) AS n FROM q JOIN p ON contains(x, t) GROUP BY 1""")
def verbatim_containment(spark, d):
    """Documents that hold a query text verbatim, letters and digits only."""
    from quillspark.functions.text import norm_name
    from quillspark.operators.containment import containing

    q = table(spark, d, "benchmark").select("item_id", norm_name(F.col("text")).alias("t"))
    p = table(spark, d, "documents").select("doc_id", norm_name(F.col("text")).alias("x"))
    return containing(p, "doc_id", "x", q, "item_id", "t").groupBy("item_id").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
