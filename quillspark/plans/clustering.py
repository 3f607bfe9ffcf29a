"""Overlap, near clones, clustering, identity and registries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions.text import norm_name, surface_keys, title_tokens
from quillspark.operators.blocks import against, small
from quillspark.operators.overlap import CONTAINED, FLAG_OVERLAP, MERGE_COSINE, MERGE_OVERLAP, best_by, claims, cliques, components, cosine, jaccard, merge_plan, min_card, pair_counts
from quillspark.operators.ranking import numbered, top_k
from quillspark.operators.registry import match_or_mint
from quillspark.operators.vectors import alike_forest, alike_pairs
from quillspark.plans.registry import query
from quillspark.plans.views import ACT, MEMBERS, activities, subtopic_members, with_sql
from quillspark.sources.tables import table

#: Overlap from which the components, covers and canonical members of these tables merge; their subtopics overlap little.
SCALED_OVERLAP = 0.05

PAIRS = """, sz AS (SELECT subtopic, count(*) AS n FROM mem GROUP BY 1),
pr AS (SELECT x.subtopic AS a, y.subtopic AS b, count(*) AS shared FROM mem x JOIN mem y ON x.pmid = y.pmid AND x.subtopic < y.subtopic GROUP BY 1, 2),
ov AS (SELECT a, b, shared, sa.n AS size_a, sb.n AS size_b, shared / least(sa.n, sb.n) AS overlap FROM pr JOIN sz sa ON a = sa.subtopic JOIN sz sb ON b = sb.subtopic)"""


def _members(spark, d):
    return subtopic_members(spark, d).select("subtopic", "pmid").distinct()


MEM2 = """, mem AS (SELECT DISTINCT subtopic, pmid FROM mem0)"""
M = MEMBERS.replace("mem AS", "mem0 AS")


@query(with_sql(ACT, M) + MEM2 + PAIRS + " SELECT a, b, shared, round(overlap, 6) AS overlap FROM ov WHERE shared >= 2")
def pairwise_overlap(spark, d):
    """Overlap by smaller set of pairs that share at least two members."""
    p = pair_counts(_members(spark, d), "subtopic", "pmid").where("shared >= 2")
    return p.select("a", "b", "shared", F.round(min_card(), 6).alias("overlap"))


@query(with_sql(ACT, M) + MEM2 + PAIRS + """, d AS (SELECT a, b, overlap FROM ov UNION ALL SELECT b, a, overlap FROM ov)
SELECT a, b AS best, round(overlap, 6) AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY overlap DESC, b) AS rn FROM d WHERE overlap > 0) WHERE rn = 1""")
def best_overlap(spark, d):
    """Each subtopic's best other subtopic, the lowest id on ties."""
    p = pair_counts(_members(spark, d), "subtopic", "pmid").withColumn("overlap", min_card())
    shared = p.select("a", "b", "overlap").union(p.select("b", "a", "overlap"))
    return best_by(shared, ["a"], "overlap", "b").select("a", F.col("b").alias("best"), F.round("overlap", 6).alias("overlap"))


@query(with_sql(ACT, M) + MEM2 + PAIRS + " SELECT a, b FROM ov WHERE overlap >= 0.04 AND greatest(size_a, size_b) / least(size_a, size_b) < 3")
def overlap_adjacency(spark, d):
    """Pairs that overlap enough, containment left out."""
    p = pair_counts(_members(spark, d), "subtopic", "pmid")
    return p.where((min_card() >= 0.04) & (F.greatest("size_a", "size_b") / F.least("size_a", "size_b") < CONTAINED)).select("a", "b")


VEC = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _vectors(spark, d, limit=None):
    return table(spark, d, "embeddings").select("vec_id", "label", "embedding")


@query("WITH " + VEC + """, p AS (SELECT x.vec_id AS a, y.vec_id AS b, x.label AS label_a, y.label AS label_b, list_cosine_similarity(x.e, y.e) AS sim FROM v x JOIN v y ON x.vec_id < y.vec_id)
SELECT a, b, label_a, label_b, round(sim, 5) AS sim, sim >= 0.3 AS clone FROM p WHERE sim >= 0.2""")
def near_clones(spark, d):
    """Pairs of alike vectors, whatever their labels, down to a tenth below the threshold. All pairs are compared, block by block: work grows with the table's square."""
    v = _vectors(spark, d)
    label = lambda k: v.select(F.col("vec_id").alias(k), F.col("label").alias(f"label_{k}"))
    p = alike_pairs(v, "vec_id", "embedding", 0.2 - 1e-12).join(small(label("a")), "a").join(small(label("b")), "b")
    return p.select("a", "b", "label_a", "label_b", F.round("sim", 5).alias("sim"), (F.col("sim") >= 0.3).alias("clone"))


@query("WITH " + VEC + """, q AS (SELECT * FROM v WHERE vec_id % 100 = 0), p AS (SELECT q.vec_id AS query, v.vec_id AS match, list_cosine_similarity(q.e, v.e) AS sim FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query, match, round(sim, 5) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(sim, 8) DESC, match) AS rn FROM p WHERE sim >= 0.1) WHERE rn = 1""")
def nearest_match(spark, d):
    """The nearest vector to each vector of a stated query set, above a threshold, ties by id."""
    v = _vectors(spark, d)
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("qe"))

    def nearest(pairs):
        p = pairs.select("query", F.col("vec_id").alias("match"), cosine(F.col("qe"), F.col("embedding")).alias("sim")).where("sim >= 0.1")
        return p.groupBy("query").agg(F.max(F.struct(F.round("sim", 8).alias("s"), (-F.col("match")).alias("m"))).alias("b"))

    best = against(v, q, "query", F.col("vec_id") != F.col("query"), nearest)
    return best.select("query", (-F.col("b.m")).alias("match"), F.round("b.s", 5).alias("sim"))


PLAN = """, lab AS (SELECT subtopic, min(topic) AS topic FROM mem0 GROUP BY 1),
pl AS (SELECT a, b, overlap, greatest(size_a, size_b) / least(size_a, size_b) AS ratio, la.topic <> lb.topic AS crosses FROM ov JOIN lab la ON a = la.subtopic JOIN lab lb ON b = lb.subtopic)"""


def _plan(spark, d):
    m = subtopic_members(spark, d)
    lab = m.groupBy("subtopic").agg(F.min("topic").alias("topic"))
    p = pair_counts(m.select("subtopic", "pmid").distinct(), "subtopic", "pmid").withColumns({"overlap": min_card(), "ratio": F.greatest("size_a", "size_b") / F.least("size_a", "size_b")})
    p = p.join(lab.withColumnsRenamed({"subtopic": "a", "topic": "ta"}), "a").join(lab.withColumnsRenamed({"subtopic": "b", "topic": "tb"}), "b")
    return p.where("ta <> tb")


#: Each subtopic's description has the vector whose number its brand and size give (vectors are shared by some).
DESCRIBED = """, sub AS (SELECT DISTINCT subtopic AS s, (CAST(split_part(split_part(subtopic, '#', 2), '_', 1) AS INTEGER) * 50 + CAST(right(subtopic, 3) AS INTEGER)) % 500 AS vec_id FROM mem),
vp AS (SELECT x.vec_id AS va, y.vec_id AS vb, list_cosine_similarity(x.e, y.e) AS cosine FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id < 500) x, (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id < 500) y),
near AS (SELECT a.s AS a, b.s AS b, round(cosine, 4) AS cosine FROM vp JOIN sub a ON a.vec_id = va JOIN sub b ON b.vec_id = vb WHERE a.s < b.s AND cosine >= 0.75),
both_ AS (SELECT coalesce(ov.a, near.a) AS a, coalesce(ov.b, near.b) AS b, coalesce(shared, 0) AS shared, cosine FROM ov FULL JOIN near ON ov.a = near.a AND ov.b = near.b),
al AS (SELECT both_.*, sa.n AS na, sb.n AS nb, shared / least(sa.n, sb.n) AS share, greatest(sa.n, sb.n) / least(sa.n, sb.n) >= 3 AS inside FROM both_ JOIN sz sa ON a = sa.subtopic JOIN sz sb ON b = sb.subtopic WHERE split_part(a, '_', 1) <> split_part(b, '_', 1))"""


@query(with_sql(ACT, M) + MEM2 + PAIRS + DESCRIBED + f"""
SELECT a, b, round(share, 4) AS overlap, cosine, CASE WHEN inside THEN 'parent_child' ELSE 'merge' END AS action, CASE WHEN inside THEN CASE WHEN na >= nb THEN a ELSE b END END AS parent,
 array_to_string(list_filter([CASE WHEN share >= CASE WHEN inside THEN {FLAG_OVERLAP} ELSE {MERGE_OVERLAP} END THEN 'overlap' END, CASE WHEN cosine IS NOT NULL THEN 'cosine' END], lambda x: x IS NOT NULL), '+') AS signal
FROM al WHERE share >= CASE WHEN inside THEN {FLAG_OVERLAP} ELSE {MERGE_OVERLAP} END OR cosine IS NOT NULL""")
def dedup_plan(spark, d):
    """Cross-topic pairs of subtopics that merge, by overlap or by the cosine of their descriptions, or that are flagged as
    parent and child."""
    m = _members(spark, d)
    size = m.groupBy("subtopic").agg(F.count("*").alias("n"))
    number = (F.regexp_extract("subtopic", "#([0-9]+)_", 1).cast("int") * 50 + F.substring("subtopic", -3, 3).cast("int")) % 500
    v = table(spark, d, "embeddings").where("vec_id < 500").select("vec_id", "embedding")  # the descriptions' vectors
    half = alike_pairs(v, "vec_id", "embedding", MERGE_COSINE).select(F.col("a").alias("va"), F.col("b").alias("vb"), F.col("sim").alias("cosine"))
    alike = half.unionByName(half.select(F.col("vb").alias("va"), F.col("va").alias("vb"), "cosine")).unionByName(v.select(F.col("vec_id").alias("va"), F.col("vec_id").alias("vb"), F.lit(1.0).alias("cosine")))
    sub = size.select("subtopic", number.alias("vec_id"))
    near = alike.join(sub.select(F.col("subtopic").alias("a"), F.col("vec_id").alias("va")), "va").join(sub.select(F.col("subtopic").alias("b"), F.col("vec_id").alias("vb")), "vb").where("a < b").select("a", "b", F.round("cosine", 4).alias("cosine"))
    shared = pair_counts(m, "subtopic", "pmid").select("a", "b", "shared").join(near, ["a", "b"], "full").na.fill(0, ["shared"])
    pairs = shared.join(size.select(F.col("subtopic").alias("a"), F.col("n").alias("size_a")), "a").join(size.select(F.col("subtopic").alias("b"), F.col("n").alias("size_b")), "b")
    cross = pairs.where(F.substring_index("a", "_", 1) != F.substring_index("b", "_", 1))
    return merge_plan(cross).select("a", "b", F.round("overlap", 4).alias("overlap"), "cosine", "action", "parent", "signal")


def _merge_edges(spark, d):
    return _plan(spark, d).where((F.col("ratio") < CONTAINED) & (F.col("overlap") >= SCALED_OVERLAP)).select("a", "b")


CC = """
, e AS (SELECT a, b FROM pl WHERE crosses AND ratio < 3 AND overlap >= 0.05), s AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
cc AS (WITH RECURSIVE r(u, v) AS (SELECT DISTINCT u, u FROM s UNION SELECT r.u, s.v FROM r JOIN s ON r.v = s.u) SELECT u AS node, min(v) AS component FROM r GROUP BY u)"""


@query(with_sql(ACT, M) + MEM2 + PAIRS + PLAN + CC + " SELECT node, component FROM cc")
def overlap_components(spark, d):
    """Connected components of the merge edges."""
    return components(_merge_edges(spark, d))


@query(with_sql(ACT, M) + MEM2 + PAIRS + PLAN + CC + """, w AS (SELECT subtopic, count(DISTINCT pmid) AS n FROM mem GROUP BY 1)
SELECT component, node AS canonical, members FROM (SELECT component, node, count(*) OVER (PARTITION BY component) AS members, row_number() OVER (PARTITION BY component ORDER BY n DESC, node) AS rn FROM cc JOIN w ON node = subtopic) WHERE rn = 1""")
def canonical_members(spark, d):
    """Each component's canonical member: the heaviest, then the lowest id."""
    n = _members(spark, d).groupBy("subtopic").agg(F.count("*").alias("n"))
    cc = components(_merge_edges(spark, d)).join(n, F.col("node") == F.col("subtopic"))
    best = cc.groupBy("component").agg(F.count("*").alias("members"), F.min(F.struct((-F.col("n")).alias("m"), "node")).alias("b"))
    return best.select("component", F.col("b.node").alias("canonical"), "members")


@query()
def clique_cover(spark, d):
    """Greedy clique cover of the merge edges (sequential by meaning)."""
    edges = _merge_edges(spark, d)
    return cliques(edges, components(edges))


@query("WITH RECURSIVE " + VEC + """, p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.35),
s AS (SELECT a AS u, b AS v FROM p UNION SELECT b, a FROM p), r(u, v) AS (SELECT DISTINCT u, u FROM s UNION SELECT r.u, s.v FROM r JOIN s ON r.v = s.u)
SELECT u AS vec_id, min(v) AS class FROM r GROUP BY u""")
def class_consolidation(spark, d):
    """Union of near vectors within a class; the smallest id stands for its group."""
    edges = alike_forest(_vectors(spark, d), "vec_id", "embedding", "label", 0.35)
    return components(edges).select(F.col("node").alias("vec_id"), F.col("component").alias("class"))


@query("""
WITH f AS (SELECT DISTINCT l_suppkey AS person, p_brand || '/' || split_part(p_type, ' ', 1) AS fam FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 40),
n AS (SELECT fam, count(*) AS n FROM f GROUP BY 1), p AS (SELECT x.fam AS a, y.fam AS b, count(*) AS shared FROM f x JOIN f y ON x.person = y.person AND x.fam < y.fam GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT a, b, shared, round(shared / (na.n + nb.n - shared), 6) AS jaccard FROM p JOIN n na ON a = na.fam JOIN n nb ON b = nb.fam WHERE shared / (na.n + nb.n - shared) >= 0.34""")
def family_dupe_scan(spark, d):
    """Families that share scholars, with enough co-scholars and Jaccard overlap."""
    p = table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit("/"), F.substring_index("p_type", " ", 1)).alias("fam"))
    f = table(spark, d, "lineitem").where("l_quantity > 40").join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("person"), "fam").distinct()
    return pair_counts(f, "fam", "person").where((F.col("shared") >= 3) & (jaccard() >= 0.34)).select("a", "b", "shared", F.round(jaccard(), 6).alias("jaccard"))


@query("""
WITH t AS (SELECT DISTINCT p_name AS id, lower(p_name) AS x FROM part), pat(p) AS (VALUES ('green'), ('red')), h AS (SELECT id, p FROM t JOIN pat ON contains(x, p)), m AS (SELECT p, min(id) AS root, count(*) AS n FROM h GROUP BY 1)
SELECT h.p AS pattern, h.id, m.root, m.n FROM h JOIN m ON h.p = m.p WHERE n > 1""")
def theme_cap(spark, d):
    """Ids that share a capped theme word are all adjacent: a clique as its members and its first id, not as its pairs."""
    pats = spark.createDataFrame([("green",), ("red",)], "pattern string")
    h = table(spark, d, "part").select(F.col("p_name").alias("id")).distinct().join(F.broadcast(pats), F.lower("id").contains(F.col("pattern")))
    m = h.groupBy("pattern").agg(F.min("id").alias("root"), F.count("*").alias("n")).where("n > 1")
    return h.join(F.broadcast(m), "pattern").select("pattern", "id", "root", "n")


@query("""
WITH n AS (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k, p_type, p_partkey FROM part)
SELECT k AS label, count(DISTINCT p_type) AS buckets, count(*) AS n FROM n GROUP BY 1 HAVING count(DISTINCT p_type) > 1""")
def label_forks(spark, d):
    """Labels that occur in several buckets."""
    n = table(spark, d, "part").select(norm_name(F.col("p_name")).alias("label"), "p_type")
    return n.groupBy("label").agg(F.countDistinct("p_type").alias("buckets"), F.count("*").alias("n")).where("buckets > 1")


@query("""
WITH f AS (SELECT DISTINCT p_name, p_type FROM part), c AS (SELECT *, count(*) OVER (PARTITION BY lower(p_name)) AS n FROM f)
SELECT p_type, CASE WHEN n > 1 THEN p_name || ' (' || lower(p_type) || ')' ELSE p_name END AS label FROM c""")
def unique_labels(spark, d):
    """Colliding labels qualified by their bucket."""
    f = table(spark, d, "part").select("p_name", "p_type").distinct()
    n = F.count("*").over(Window.partitionBy(F.lower("p_name")))
    return f.withColumn("n", n).select("p_type", F.when(F.col("n") > 1, F.concat("p_name", F.lit(" ("), F.lower("p_type"), F.lit(")"))).otherwise(F.col("p_name")).alias("label"))


GRANTS = """g AS (SELECT p_partkey AS id, p_name AS title, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand || CASE WHEN p_partkey % 3 = 0 THEN ' Foundation' ELSE '' END END AS sponsor, CAST(p_partkey % 5 AS INTEGER) - 1 AS src, p_retailprice AS stamp FROM part),
k AS (SELECT *, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(title), '[a-z0-9]+'), lambda x: NOT list_contains(['a','an','and','for','in','of','on','the','to','with','research','award','awards','grant','grants','program','fellowship','foundation','fund'], x)))), ' ') AS tk,
 array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(sponsor), '[a-z0-9]+'), lambda x: NOT list_contains(['a','an','and','for','in','of','on','the','to','with','research','award','awards','grant','grants','program','fellowship','foundation','fund'], x)))), ' ') AS sk FROM g)"""


def _grants(spark, d):
    key = F.col("p_partkey")
    sponsor = F.when(key % 4 == 0, "").otherwise(F.concat("p_brand", F.when(key % 3 == 0, " Foundation").otherwise("")))
    g = table(spark, d, "part").select(key.alias("id"), F.col("p_name").alias("title"), sponsor.alias("sponsor"), ((key % 5).cast("int") - 1).alias("src"), F.col("p_retailprice").alias("stamp"))
    return g.withColumns({"tk": F.array_join(title_tokens(F.col("title")), " "), "sk": F.array_join(title_tokens(F.col("sponsor")), " ")})


@query("WITH " + GRANTS + """
, s AS (SELECT tk, count(DISTINCT sk) AS n, min(sk) AS only FROM k WHERE tk <> '' AND sk <> '' GROUP BY 1),
c AS (SELECT k.*, CASE WHEN k.sk = '' AND s.n = 1 THEN s.only ELSE k.sk END AS ck FROM k LEFT JOIN s ON k.tk = s.tk WHERE k.tk <> ''),
r AS (SELECT *, count(*) OVER (PARTITION BY tk, ck) AS n, row_number() OVER (PARTITION BY tk, ck ORDER BY src DESC, stamp DESC, id DESC) AS rn, first_value(id) OVER (PARTITION BY tk, ck ORDER BY src DESC, stamp DESC, id DESC) AS winner FROM c)
SELECT id AS loser, winner FROM r WHERE n >= 2 AND rn > 1""")
def grant_dedupe(spark, d):
    """Same title words and sponsor words; a blank sponsor folds into the one sponsored cluster, if there is just one."""
    k = _grants(spark, d).where("tk <> ''")
    s = k.where("sk <> ''").groupBy("tk").agg(F.countDistinct("sk").alias("n"), F.min("sk").alias("only"))
    c = k.join(s, "tk", "left").withColumn("ck", F.when((F.col("sk") == "") & (F.col("n") == 1), F.col("only")).otherwise(F.col("sk")))
    win = c.groupBy("tk", "ck").agg(F.max(F.struct("src", "stamp", "id")).alias("w"))
    return c.join(win, ["tk", "ck"]).where("id <> w.id").select(F.col("id").alias("loser"), F.col("w.id").alias("winner"))


@query("WITH " + GRANTS + """
, i AS (SELECT * FROM k WHERE id % 7 = 0 AND tk <> ''), h AS (SELECT * FROM k WHERE id % 7 <> 0 AND tk <> '')
SELECT i.id AS incoming, min(h.id) AS blocked_by FROM i JOIN h ON i.tk = h.tk AND (i.sk = h.sk OR i.sk = '' OR h.sk = '') AND h.src >= i.src GROUP BY 1""")
def ingest_guard(spark, d):
    """Incoming grants whose title is held already under the same or a blank sponsor by a source of the same rank or higher."""
    k = _grants(spark, d).where("tk <> ''")
    i = k.where("id % 7 = 0").select(F.col("id").alias("incoming"), "tk", F.col("sk").alias("isk"), F.col("src").alias("isrc"))
    h = k.where("id % 7 <> 0").select("id", "tk", "sk", "src")
    hit = i.join(h, "tk").where("(isk = sk or isk = '' or sk = '') and src >= isrc")
    return hit.groupBy("incoming").agg(F.min("id").alias("blocked_by"))


#: The registry's rules for these tables: names left out, variants of one tool, and terms that are never folded together.
DENIED = ("hot plate", "old rod")
VARIANTS = (("hot gear", "gear class"), ("large gear", "gear class"))
APART = (("red", "blue"),)


@query(f"""
WITH p AS (SELECT p_partkey AS id, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS form FROM part),
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id < 16),
variant(form, class) AS (VALUES {', '.join(str(x) for x in VARIANTS)}),
reg AS (SELECT id, form FROM p WHERE id <= 12), keys AS (SELECT form AS key, id FROM reg UNION SELECT class, id FROM reg JOIN variant USING (form)), first AS (SELECT key, min(id) AS id FROM keys GROUP BY 1),
f AS (SELECT form, count(*) AS n, min(id) AS first_id FROM p WHERE id > 12 GROUP BY 1), fk AS (SELECT form, form AS key FROM f UNION SELECT form, class FROM f JOIN variant USING (form)),
hit AS (SELECT fk.form, fk.key, first.id, (contains(' ' || fk.form || ' ', ' blue ') AND contains(' ' || reg.form || ' ', ' red ')) OR (contains(' ' || fk.form || ' ', ' red ') AND contains(' ' || reg.form || ' ', ' blue ')) AS apart FROM fk JOIN first ON fk.key = first.key JOIN reg ON reg.id = first.id),
surface AS (SELECT form, min_by(id, key) AS id FROM hit WHERE NOT apart GROUP BY 1),
open AS (SELECT form, first_id FROM f WHERE form NOT IN {DENIED} AND form NOT IN (SELECT form FROM surface)),
c AS (SELECT open.form, reg.id, reg.form AS rform, round(list_cosine_similarity(a.e, b.e), 8) AS sim FROM open JOIN v a ON a.vec_id = first_id % 16, reg JOIN v b ON b.vec_id = reg.id % 16),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY sim DESC, id) AS rn FROM c WHERE sim >= 0.86) WHERE rn = 1),
near AS (SELECT form, id, (contains(' ' || form || ' ', ' blue ') AND contains(' ' || rform || ' ', ' red ')) OR (contains(' ' || form || ' ', ' red ') AND contains(' ' || rform || ' ', ' blue ')) AS apart FROM nn),
r AS (SELECT f.form, n, CASE WHEN f.form IN {DENIED} THEN 'denied' WHEN s.id IS NOT NULL THEN 'attached' WHEN near.id IS NOT NULL AND NOT near.apart THEN 'attached' ELSE 'minted' END AS action,
 CASE WHEN f.form IN {DENIED} THEN NULL WHEN s.id IS NOT NULL THEN 'surface' WHEN near.apart THEN 'kept apart' WHEN near.id IS NOT NULL THEN 'embedding' END AS via, CASE WHEN f.form NOT IN {DENIED} THEN coalesce(s.id, CASE WHEN NOT near.apart THEN near.id END) END AS hit FROM f LEFT JOIN surface s ON f.form = s.form LEFT JOIN near ON f.form = near.form)
SELECT form AS key, n, action, via, CASE WHEN action = 'minted' THEN (SELECT max(id) FROM reg) + row_number() OVER (PARTITION BY action ORDER BY form) ELSE hit END AS tool_id FROM r""")
def registry_match(spark, d):
    """Forms matched to a registry or minted: names left out, surface keys and variants, the nearest vector, terms kept apart."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name")
    v = table(spark, d, "embeddings").where("vec_id < 16").select("vec_id", F.col("embedding").alias("vector"))
    records = p.where("id <= 12").withColumn("vec_id", F.col("id") % 16).join(v, "vec_id", "left").select("id", F.col("p_name").alias("name"), "vector")
    forms = p.where("id > 12").groupBy(norm_name(F.col("p_name")).alias("form")).agg(F.count("*").alias("n"), F.min(F.struct("id", "p_name")).alias("f"))
    mentions = forms.withColumn("vec_id", F.col("f.id") % 16).join(v, "vec_id", "left").select("form", "n", F.col("f.p_name").alias("name"), "vector")
    return match_or_mint(mentions, records, DENIED, VARIANTS, APART).select(F.col("form").alias("key"), "n", "action", "via", "tool_id")


@query("WITH " + VEC + """, fam AS (SELECT vec_id, label, e FROM v WHERE vec_id < 50), t AS (SELECT vec_id, label, e FROM v WHERE vec_id >= 50),
p AS (SELECT t.vec_id, t.label, fam.vec_id AS family, fam.label AS fl, list_cosine_similarity(t.e, fam.e) AS sim FROM t JOIN fam ON true),
own AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 8) DESC, family) AS rn FROM p WHERE fl = label), x AS (SELECT vec_id, max(sim) AS s FROM p WHERE fl <> label GROUP BY 1)
SELECT t.vec_id, CASE WHEN own.sim >= 0.2 THEN own.family END AS family, coalesce(own.sim < 0.2, TRUE) AS minted, coalesce(own.sim < 0.2, TRUE) AND coalesce(x.s >= 0.25, FALSE) AS cross_flag FROM t LEFT JOIN own ON t.vec_id = own.vec_id AND rn = 1 LEFT JOIN x ON t.vec_id = x.vec_id""")
def family_resolve(spark, d):
    """Attach to the nearest family of the same class, else mint, flagged if another class is near. Families are a bounded side."""
    v = _vectors(spark, d)
    fam = v.where("vec_id < 50").select(F.col("vec_id").alias("family"), F.col("label").alias("fl"), F.col("embedding").alias("fe"))
    p = v.where("vec_id >= 50").join(F.broadcast(fam)).withColumn("sim", cosine(F.col("embedding"), F.col("fe")))
    own = F.max(F.when(F.col("fl") == F.col("label"), F.struct(F.round("sim", 8).alias("s"), (-F.col("family")).alias("m"), "sim")))
    out = p.groupBy("vec_id").agg(own.alias("o"), F.max(F.when(F.col("fl") != F.col("label"), F.col("sim"))).alias("x"))
    minted = F.coalesce(F.col("o.sim") < 0.2, F.lit(True))
    return out.select("vec_id", F.when(~minted, -F.col("o.m")).alias("family"), minted.alias("minted"), (minted & F.coalesce(F.col("x") >= 0.25, F.lit(False))).alias("cross_flag"))


@query(with_sql(ACT) + """
, n AS (SELECT primary_subtopic AS slug, topic, pmid FROM act WHERE primary_subtopic IS NOT NULL AND year >= 1998)
SELECT slug, substr(sha256(topic || '/' || slug), 1, 12) AS durable_id, count(DISTINCT pmid) AS papers FROM n GROUP BY slug, topic""")
def durable_ids(spark, d):
    """Opaque ids by content hash."""
    n = activities(spark, d).where("primary_subtopic is not null and year >= 1998")
    return n.groupBy("topic", F.col("primary_subtopic").alias("slug")).agg(F.countDistinct("pmid").alias("papers")).select("slug", F.substring(F.sha2(F.concat("topic", F.lit("/"), "slug"), 256), 1, 12).alias("durable_id"), "papers")


REC = with_sql(ACT) + """
, nw AS (SELECT DISTINCT topic, primary_subtopic AS s, pmid FROM act WHERE primary_subtopic IS NOT NULL AND year >= 1996), pv AS (SELECT DISTINCT topic, other_subtopic AS s, pmid FROM act WHERE year <= 1999),
a AS (SELECT topic, s, count(*) AS n FROM nw GROUP BY 1, 2), b AS (SELECT topic, s, count(*) AS n FROM pv GROUP BY 1, 2),
c AS (SELECT nw.topic, nw.s AS slug, pv.s AS prior, count(*) AS shared FROM nw JOIN pv ON nw.topic = pv.topic AND nw.pmid = pv.pmid GROUP BY 1, 2, 3),
cand AS (SELECT c.topic, slug, prior, shared, shared / least(a.n, b.n) AS overlap, shared / b.n AS directed FROM c JOIN a ON c.topic = a.topic AND slug = a.s JOIN b ON c.topic = b.topic AND prior = b.s)"""


def _candidates(spark, d):
    a = activities(spark, d)
    new = a.where("primary_subtopic is not null and year >= 1996").select("topic", F.col("primary_subtopic").alias("slug"), "pmid").distinct()
    old = a.where("year <= 1999").select("topic", F.col("other_subtopic").alias("prior"), "pmid").distinct()
    na, nb = new.groupBy("topic", "slug").agg(F.count("*").alias("na")), old.groupBy("topic", "prior").agg(F.count("*").alias("nb"))
    shared = new.join(old, ["topic", "pmid"]).groupBy("topic", "slug", "prior").agg(F.count("*").alias("shared"))
    return shared.join(na, ["topic", "slug"]).join(nb, ["topic", "prior"]).withColumns({"overlap": F.col("shared") / F.least("na", "nb"), "directed": F.col("shared") / F.col("nb")})


@query(REC + " SELECT topic, slug, prior, round(overlap, 6) AS overlap, CASE WHEN overlap >= 0.5 THEN 'auto' WHEN overlap >= 0.2 THEN 'ambiguous' ELSE 'mint' END AS band FROM cand")
def reconcile_candidates(spark, d):
    """Overlap of new clusters with prior identities of their topic, banded."""
    band = F.when(F.col("overlap") >= 0.5, "auto").when(F.col("overlap") >= 0.2, "ambiguous").otherwise("mint")
    return _candidates(spark, d).select("topic", "slug", "prior", F.round("overlap", 6).alias("overlap"), band.alias("band"))


@query()
def reconcile_claims(spark, d):
    """The claim loop over the candidates (sequential by meaning)."""
    c = _candidates(spark, d).select("topic", "slug", "prior", "overlap", F.when(F.substring("slug", -3, 3) == F.substring("prior", -3, 3), F.lit(1.0)).otherwise(F.lit(0.0)).alias("text_sim"))
    return claims(c, "topic", 0.5, 0.2)


@query(REC + " SELECT prior, slug AS successor, round(directed, 6) AS share FROM (SELECT *, row_number() OVER (PARTITION BY topic, prior ORDER BY directed DESC, slug) AS rn FROM cand) WHERE rn = 1 AND directed >= 0.5")
def merge_lineage(spark, d):
    """The successor that took most of a prior identity's members, if at least half."""
    best = _candidates(spark, d).groupBy("topic", "prior").agg(F.max("directed").alias("share"), F.min_by("slug", F.struct((-F.col("directed")).alias("m"), "slug")).alias("successor"))
    return best.where("share >= 0.5").select("prior", "successor", F.round("share", 6).alias("share"))


@query(REC + """, best AS (SELECT topic, slug, prior, overlap, row_number() OVER (PARTITION BY topic, slug ORDER BY overlap DESC, prior) AS rn FROM cand), rival AS (SELECT topic, prior, count(*) AS n FROM cand WHERE overlap >= 0.2 GROUP BY 1, 2)
SELECT slug, best.prior, round(overlap, 6) AS overlap FROM best LEFT JOIN rival r ON best.topic = r.topic AND best.prior = r.prior WHERE rn = 1 AND overlap >= 0.25 AND coalesce(n, 0) <= 1""")
def reuse_map(spark, d):
    """Texts reused only for a good best match that no other cluster rivals (threshold scaled to these tables)."""
    c = _candidates(spark, d)
    rival = c.where("overlap >= 0.2").groupBy("topic", "prior").agg(F.count("*").alias("rivals"))
    best = top_k(c, ["topic", "slug"], [F.col("overlap").desc(), F.col("prior")], 1)
    return best.where("overlap >= 0.25").join(rival, ["topic", "prior"], "left").where("coalesce(rivals, 0) <= 1").select("slug", "prior", F.round("overlap", 6).alias("overlap"))


@query("""
WITH f AS (SELECT DISTINCT p_name AS display, regexp_extract(p_type, '[A-Z]+$') AS core, p_partkey FROM part), u AS (SELECT DISTINCT l_partkey FROM lineitem)
SELECT core, count(DISTINCT display) AS forms, count(*) AS members FROM f WHERE p_partkey IN (SELECT l_partkey FROM u) GROUP BY core HAVING count(DISTINCT display) >= 2""")
def entity_layer(spark, d):
    """Entities in use, grouped under a parent core with at least two forms."""
    f = table(spark, d, "part").select(F.col("p_name").alias("display"), F.regexp_extract("p_type", "[A-Z]+$", 0).alias("core"), "p_partkey")
    used = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return f.join(used, "p_partkey", "left_semi").groupBy("core").agg(F.countDistinct("display").alias("forms"), F.count("*").alias("members")).where("forms >= 2")


@query("""
WITH k AS (SELECT p_partkey AS id, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS key FROM part)
SELECT k.key, id, kept, n FROM k JOIN (SELECT key, min(id) AS kept, count(*) AS n FROM k GROUP BY 1 HAVING count(*) >= 2) g ON k.key = g.key""")
def alias_collapse(spark, d):
    """Live records of one normalised name fold into the lowest id: a row for each record."""
    k = table(spark, d, "part").select(F.col("p_partkey").alias("id"), norm_name(F.col("p_name")).alias("key"))
    groups = k.groupBy("key").agg(F.min("id").alias("kept"), F.count("*").alias("n")).where("n >= 2")
    return k.join(small(groups), "key").select("key", "id", "kept", "n")


@query(with_sql(ACT) + """
, f AS (SELECT topic, primary_subtopic AS sub, person, pmid FROM act WHERE primary_subtopic IS NOT NULL AND position <> 'middle'),
m AS (SELECT topic, sub, count(DISTINCT pmid) AS n FROM f GROUP BY 1, 2), x AS (SELECT topic, sub, row_number() OVER (PARTITION BY topic ORDER BY n DESC, sub) AS rn FROM m)
SELECT f.person, f.topic AS family, count(DISTINCT f.pmid) AS pubs, (SELECT string_agg(sub, ';' ORDER BY rn) FROM x WHERE x.topic = f.topic AND rn <= 3) AS exemplars FROM f GROUP BY f.person, f.topic""")
def tool_family_rollup(spark, d):
    """Distinct publications of each person in a family, with the family's three main members."""
    f = activities(spark, d).where("primary_subtopic is not null and position <> 'middle'").select("topic", F.col("primary_subtopic").alias("sub"), "person", "pmid")
    m = top_k(f.groupBy("topic", "sub").agg(F.countDistinct("pmid").alias("n")), ["topic"], [F.col("n").desc(), F.col("sub")], 3)
    ex = m.groupBy("topic").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rn", "sub")))["sub"], ";").alias("exemplars"))
    return f.groupBy("person", "topic").agg(F.countDistinct("pmid").alias("pubs")).join(ex, "topic").select("person", F.col("topic").alias("family"), "pubs", "exemplars")
