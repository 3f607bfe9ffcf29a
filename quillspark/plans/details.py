"""Smaller operators: alias matching, decays, coercions, keys, two-phase scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.scores import PRIOR_LOGIT, half_life, sigmoid
from quillspark.operators.blocks import small
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, EV, PUB, activities, event_rows, publications, with_sql
from quillspark.sources.tables import table


@query("""
WITH t AS (SELECT doc_id, text FROM documents)
SELECT doc_id, regexp_matches(text, '\\bCC\\b') AS acronym, regexp_matches(text, '(?i)\\b(apache|mit)\\s+license\\b') AS phrase, regexp_matches(text, '(?i)\\bcopyright\\s+(and|&)\\s+license\\b') AS either FROM t""")
def alias_regex(spark, d):
    """Acronyms match in their case, phrases in any, and "and" stands for the sign too."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", t.rlike(r"\bCC\b").alias("acronym"), t.rlike(r"(?i)\b(apache|mit)\s+license\b").alias("phrase"), t.rlike(r"(?i)\bcopyright\s+(and|&)\s+license\b").alias("either"))


@query("""
WITH x AS (SELECT page_id, lower(regexp_extract(html, '<h1>([^< ]+)', 1)) AS alias, lower(html) AS h FROM pages)
SELECT page_id, CASE WHEN alias = '' THEN 'none' WHEN contains(regexp_extract(h, '(?s)<footer>(.*?)</footer>', 1), alias) THEN 'footer' WHEN contains(regexp_extract(h, '(?s)<nav>(.*?)</nav>', 1), alias) THEN 'nav' WHEN contains(regexp_extract(h, '(?s)<article>(.*?)</article>', 1), alias) THEN 'body' ELSE 'none' END AS section FROM x""")
def match_section(spark, d):
    """The first of the sections, in their order, that names an alias."""
    h, alias = F.lower("html"), F.lower(F.regexp_extract("html", "<h1>([^< ]+)", 1))
    part = lambda tag: F.regexp_extract(h, f"(?s)<{tag}>(.*?)</{tag}>", 1)
    out = F.when(alias == "", "none").when(part("footer").contains(alias), "footer").when(part("nav").contains(alias), "nav").when(part("article").contains(alias), "body").otherwise("none")
    return table(spark, d, "pages").select("page_id", out.alias("section"))


@query("""
WITH b AS (SELECT item_id, lower(text) AS s, lower(split_part(text, ' ', 2)) AS a, lower(split_part(text, ' ', 5)) || 'zing' AS b FROM benchmark)
SELECT item_id, contains(s, a) OR (length(a) >= 6 AND contains(s, substr(a, 1, 6))) AS exact, contains(s, b) OR (length(b) >= 6 AND contains(s, substr(b, 1, 6))) AS stem FROM b""")
def names_tool(spark, d):
    """Whether a sentence names a tool: the whole word, or its first six letters."""
    word = lambda k: F.lower(F.split_part("text", F.lit(" "), F.lit(k)))
    s = F.lower("text")
    named = lambda w: s.contains(w) | ((F.length(w) >= 6) & s.contains(F.substring(w, 1, 6)))
    return table(spark, d, "benchmark").select("item_id", named(word(2)).alias("exact"), named(F.concat(word(5), F.lit("zing"))).alias("stem"))


@query(with_sql(ACT) + "SELECT person, topic, round(sum(score * power(0.5, abs(2001 - year) / 3.0)), 6) AS weight FROM act GROUP BY 1, 2")
def half_life_totals(spark, d):
    """Totals that fade by half every three years."""
    return activities(spark, d).groupBy("person", "topic").agg(F.round(F.sum(F.col("score") * half_life(2001 - F.col("year"), 3.0)), 6).alias("weight"))


@query(with_sql(EV) + """
, n AS (SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM ev)
SELECT user_id, CAST(max(date_diff('millisecond', ts, nx)) AS BIGINT) AS longest_ms FROM n WHERE nx IS NOT NULL GROUP BY 1""")
def duration_ms(spark, d):
    """The longest pause of each scope in milliseconds."""
    from pyspark.sql import Window

    e = event_rows(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    nx = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.withColumn("ms", F.unix_millis(nx) - F.unix_millis("ts")).where("ms is not null").groupBy("user_id").agg(F.max("ms").alias("longest_ms"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, row_number() OVER (ORDER BY length(CAST(o_orderkey AS VARCHAR)), CAST(o_orderkey AS VARCHAR)) AS place FROM orders")
def numeric_key_order(spark, d):
    """Each id's place in the order of numbers of a string column: by length, then by signs. Ids are numbered within ranges of all but their last five signs."""
    from pyspark.sql import Window

    ids = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    ids = ids.withColumns({"size": F.length("id"), "head": F.expr("substring(id, 1, greatest(length(id) - 5, 0))")})
    before = F.sum("n").over(Window.orderBy("size", "head")) - F.col("n")
    starts = ids.groupBy("size", "head").agg(F.count("*").alias("n")).select("size", "head", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("size", "head").orderBy("id"))
    return ids.withColumn("at", place).join(small(starts), ["size", "head"]).select("id", (F.col("before") + F.col("at")).alias("place"))


@query(with_sql(ACT) + """
, c AS (SELECT pmid, other_subtopic AS s, max(score) AS v FROM act GROUP BY 1, 2) SELECT pmid, round(sum(v), 6) AS confidence, count(*) AS n FROM c GROUP BY 1""")
def confidence_sums(spark, d):
    """Sums over the values of a map of confidences."""
    m = activities(spark, d).groupBy("pmid", F.col("other_subtopic").alias("s")).agg(F.max("score").alias("v")).groupBy("pmid").agg(F.map_from_entries(F.collect_list(F.struct("s", "v"))).alias("m"))
    return m.select("pmid", F.round(F.aggregate(F.map_values("m"), F.lit(0.0), lambda t, v: t + v), 6).alias("confidence"), F.size("m").cast("long").alias("n"))


@query("""
WITH v AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 0 THEN '7' WHEN 1 THEN '-3' WHEN 2 THEN 'x' ELSE NULL END AS raw, CASE WHEN o_orderkey % 2 = 0 THEN ['phd', 'bogus'] ELSE ['md', 'phd', 'md'] END AS tags FROM orders)
SELECT id, CASE WHEN TRY_CAST(raw AS INTEGER) >= 0 THEN TRY_CAST(raw AS INTEGER) END AS n, CASE WHEN id % 2 = 0 THEN 'phd' ELSE 'md,phd' END AS tags FROM v""")
def coerced_values(spark, d):
    """Whole numbers that aren't negative, and lists cut to a closed vocabulary."""
    k = F.col("o_orderkey")
    raw = F.when(k % 4 == 0, "7").when(k % 4 == 1, "-3").when(k % 4 == 2, "x")
    tags = F.when(k % 2 == 0, F.array(F.lit("phd"), F.lit("bogus"))).otherwise(F.array(F.lit("md"), F.lit("phd"), F.lit("md")))
    n = raw.try_cast("int")
    return table(spark, d, "orders").select(k.alias("id"), F.when(n >= 0, n).alias("n"), F.array_join(F.array_intersect(tags, F.array(F.lit("md"), F.lit("phd"))), ",").alias("tags"))


@query(with_sql(ACT) + """
, p1 AS (SELECT DISTINCT pmid, topic AS core FROM act WHERE score >= 0.9 AND line = 1), au AS (SELECT DISTINCT a.person, p1.core, a.pmid FROM p1 JOIN act a ON a.pmid = p1.pmid),
k AS (SELECT person, core, count(*) AS k FROM au GROUP BY 1, 2), tot AS (SELECT person, count(DISTINCT pmid) AS t FROM act GROUP BY 1), pr AS (SELECT DISTINCT a.pmid, a.topic AS core, a.person FROM act a),
r AS (SELECT pr.pmid, pr.core, max(CASE WHEN k - CASE WHEN au.pmid IS NULL THEN 0 ELSE 1 END <= 0 THEN 0 ELSE CAST(k - CASE WHEN au.pmid IS NULL THEN 0 ELSE 1 END AS DOUBLE) / t END) AS rate FROM pr JOIN k ON pr.person = k.person AND pr.core = k.core JOIN tot ON pr.person = tot.person LEFT JOIN au ON au.person = pr.person AND au.core = pr.core AND au.pmid = pr.pmid GROUP BY 1, 2)
SELECT r.pmid, r.core, CASE WHEN p1.pmid IS NOT NULL THEN 'confirmed' WHEN 1 / (1 + exp(-(ln(0.02 / 0.98) + 150 * rate))) >= 0.3 THEN 'candidate' ELSE 'below' END AS status FROM r LEFT JOIN p1 ON r.pmid = p1.pmid AND r.core = p1.core WHERE rate > 0""")
def two_phase_run(spark, d):
    """Sure papers first; their authors' rates, the scored paper left out, then rank the rest. A sure paper is never demoted."""
    a = activities(spark, d)
    sure = a.where("score >= 0.9 and line = 1").select("pmid", F.col("topic").alias("core")).distinct()
    by = a.select("pmid", "person").distinct().join(sure, "pmid").distinct()
    k = by.groupBy("person", "core").agg(F.count("*").alias("k"))
    total = a.groupBy("person").agg(F.countDistinct("pmid").alias("t"))
    pair = a.select("pmid", F.col("topic").alias("core"), "person").distinct().join(k, ["person", "core"]).join(total, "person")
    own = by.withColumn("own", F.lit(1))
    n = F.col("k") - F.coalesce("own", F.lit(0))
    rate = pair.join(own, ["pmid", "person", "core"], "left").groupBy("pmid", "core").agg(F.max(F.when(n <= 0, 0.0).otherwise(n / F.col("t"))).alias("rate")).where("rate > 0")
    status = F.when(F.col("sure"), "confirmed").when(sigmoid(PRIOR_LOGIT + 150 * F.col("rate")) >= 0.3, "candidate").otherwise("below")
    return rate.join(sure.withColumn("sure", F.lit(True)), ["pmid", "core"], "left").select("pmid", "core", status.alias("status"))


@query("""
WITH f AS (SELECT p_brand AS family, p_type AS kind, count(*) AS members, bool_or(contains(p_name, 'green')) AS line FROM part GROUP BY 1, 2)
SELECT family, kind, members, members >= 10 AND NOT (kind LIKE 'PROMO%') AS projectable, line AND kind LIKE 'ECONOMY%' AS cell_line FROM f""")
def family_scopes(spark, d):
    """Which families a view projects."""
    f = table(spark, d, "part").groupBy(F.col("p_brand").alias("family"), F.col("p_type").alias("kind")).agg(F.count("*").alias("members"), F.bool_or(F.col("p_name").contains("green")).alias("line"))
    return f.select("family", "kind", "members", ((F.col("members") >= 10) & ~F.col("kind").startswith("PROMO")).alias("projectable"), (F.col("line") & F.col("kind").startswith("ECONOMY")).alias("cell_line"))


@query(with_sql(ACT) + """
, s AS (SELECT DISTINCT topic, primary_subtopic AS slug FROM act WHERE primary_subtopic IS NOT NULL)
SELECT topic, string_agg(slug || '>' || substr(sha256(topic || '/' || slug), 1, 12), ',' ORDER BY slug) AS aliases FROM s GROUP BY 1""")
def alias_map(spark, d):
    """Slugs to durable ids, a map a topic."""
    s = activities(spark, d).where("primary_subtopic is not null").select("topic", F.col("primary_subtopic").alias("slug")).distinct()
    pair = F.concat("slug", F.lit(">"), F.substring(F.sha2(F.concat("topic", F.lit("/"), "slug"), 256), 1, 12))
    return s.groupBy("topic").agg(F.array_join(F.sort_array(F.collect_list(pair)), ",").alias("aliases"))


@query(with_sql(EV) + """
, l AS (SELECT coalesce(max(ts), TIMESTAMP '2024-01-01') AS since FROM ev WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-15')
SELECT user_id, count(*) AS n FROM ev, l WHERE ts > since GROUP BY 1""")
def delta_since_success(spark, d):
    """What is newer than the last successful run, with a start for the first."""
    e = event_rows(spark, d)
    since = e.where("event_type = 'purchase' and ts < timestamp '2024-01-15'").agg(F.coalesce(F.max("ts"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("since"))
    return e.join(F.broadcast(since)).where("ts > since").groupBy("user_id").agg(F.count("*").alias("n"))


@query(with_sql(ACT) + """
, f AS (SELECT pmid, min_by(person, line) FILTER (position = 'first') AS fa, min_by(person, -line) FILTER (position = 'last') AS la, min_by(person, line) AS any_ FROM act GROUP BY 1)
SELECT pmid, coalesce(fa, any_) AS first_author, coalesce(la, fa, any_) AS last_author FROM f""")
def author_fallback(spark, d):
    """First and last author, from the attributes of the fan-out or else from the row itself."""
    p, line = F.col("position"), F.col("line")
    f = activities(spark, d).groupBy("pmid").agg(F.min_by(F.when(p == "first", F.col("person")), F.when(p == "first", line)).alias("fa"), F.min_by(F.when(p == "last", F.col("person")), F.when(p == "last", -line)).alias("la"), F.min_by("person", line).alias("x"))
    return f.select("pmid", F.coalesce("fa", "x").alias("first_author"), F.coalesce("la", "fa", "x").alias("last_author"))


@query(with_sql(PUB) + "SELECT pmid, published FROM pub WHERE academic ORDER BY published DESC, pmid DESC LIMIT 100")
def newest_limit(spark, d):
    """The newest hundred."""
    return publications(spark, d).where("academic").select("pmid", "published").orderBy(F.col("published").desc(), F.col("pmid").desc()).limit(100)


@query("SELECT sha256(string_agg(k, chr(10) ORDER BY k)) AS taxonomy_hash, count(*) AS entries FROM (SELECT DISTINCT p_brand || '|' || p_type AS k FROM part)")
def taxonomy_hash(spark, d):
    """The content hash of a taxonomy: sorted entries, one hash (a taxonomy is small)."""
    k = table(spark, d, "part").select(F.concat("p_brand", F.lit("|"), "p_type").alias("k")).distinct()
    return k.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("k")), "\n"), 256).alias("taxonomy_hash"), F.count("*").alias("entries"))


@query(with_sql(ACT, PUB) + """
, m AS (SELECT a.topic, p.status, count(*) AS n, count(DISTINCT a.pmid) AS pubs, CAST(sum(CAST(round(a.score * 10) AS INTEGER)) AS DOUBLE) / (10 * count(*)) AS mean FROM act a JOIN pub p ON a.pmid = p.pmid GROUP BY 1, 2)
SELECT topic, status, n, pubs, mean, n / CAST(sum(n) OVER (PARTITION BY topic) AS DOUBLE) AS share FROM m""")
def record_summary(spark, d):
    """Records by topic and status, with shares: quotients of whole numbers, which any engine divides alike."""
    from pyspark.sql import Window

    p = publications(spark, d).select("pmid", "status")
    m = activities(spark, d).join(p, "pmid").groupBy("topic", "status").agg(F.count("*").alias("n"), F.countDistinct("pmid").alias("pubs"), (F.sum(F.round(F.col("score") * 10).cast("int")).cast("double") / (10 * F.count("*"))).alias("mean"))
    return m.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("topic")).cast("double"))
