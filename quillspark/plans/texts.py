"""Text functions over documents, pages, parts and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators.blocks import small
from quillspark.plans.registry import query
from quillspark.sources.tables import table

NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query(f"SELECT doc_id, md5({NORM.format('text')}) AS name_md5, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS space_md5, length({NORM.format('text')}) AS chars FROM documents")
def text_normalise(spark, d):
    """Two normal forms of whole texts, as digests."""
    n = T.norm_name(F.col("text"))
    return _docs(spark, d).select("doc_id", F.md5(n).alias("name_md5"), F.md5(T.norm_space(F.col("text"))).alias("space_md5"), F.length(n).cast("long").alias("chars"))


ENT = "bare"
for _name, _sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    ENT = f"replace({ENT}, '{_name}', '{_sign}')"


@query(f"SELECT page_id, md5(trim(regexp_replace({ENT}, '\\s+', ' ', 'g'))) AS text_md5 FROM (SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS bare FROM pages)")
def strip_html(spark, d):
    """Visible text of pages, tags and entities resolved, as a digest."""
    return table(spark, d, "pages").select("page_id", F.md5(T.strip_html(F.col("html"))).alias("text_md5"))


STOP = "['a','an','and','for','in','of','on','the','to','with','research','award','awards','grant','grants','program','fellowship','foundation','fund']"


@query(f"SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: NOT list_contains({STOP}, x)))), ' ') AS tokens FROM part")
def token_set(spark, d):
    """Sorted distinct words of a title without its generic words."""
    return table(spark, d, "part").select("p_partkey", F.array_join(T.title_tokens(F.col("p_name")), " ").alias("tokens"))


@query("""
WITH n AS (SELECT p_partkey, p_name || ' (' || substr(p_brand, 1, 5) || ') system' AS raw FROM part),
k AS (SELECT p_partkey, trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')) AS whole, trim(regexp_replace(lower(regexp_replace(raw, '\\([^)]*\\)', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')) AS bare, lower(regexp_extract(raw, '\\(([^)]*)\\)', 1)) AS acr FROM n)
SELECT p_partkey, array_to_string(list_sort(list_distinct([acr, whole, bare, regexp_replace(whole, ' system$', ''), regexp_replace(bare, ' system$', '')])), '|') AS keys FROM k""")
def surface_key_sets(spark, d):
    """Keys of a name: with and without its short form, and without wrapping words."""
    raw = F.concat("p_name", F.lit(" ("), F.substring("p_brand", 1, 5), F.lit(") system"))
    return table(spark, d, "part").select("p_partkey", F.array_join(T.surface_keys(raw), "|").alias("keys"))


@query("""
SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, substr(sha1(lower(url)), 1, 6) AS tail, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages""")
def slug_ids(spark, d):
    """Readable slugs, a short content hash, and the host of a page."""
    return table(spark, d, "pages").select("page_id", T.slug(F.col("url")).alias("slug"), F.substring(F.sha1(F.lower("url")), 1, 6).alias("tail"), F.parse_url("url", F.lit("HOST")).alias("host"))


@query("""
WITH w AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages)
SELECT host, count(*) AS n, bool_or(starts_with(url, 'https')) AS any_tls FROM w WHERE NOT regexp_matches(host, '^(localhost|127\\.|10\\.|192\\.168\\.|169\\.254\\.)') GROUP BY 1""")
def fetch_guard(spark, d):
    """Pages by host, private addresses left out."""
    host = F.parse_url("url", F.lit("HOST"))
    p = table(spark, d, "pages").select("url", host.alias("host")).where(~F.col("host").rlike(r"^(localhost|127\.|10\.|192\.168\.|169\.254\.)"))
    return p.groupBy("host").agg(F.count("*").alias("n"), F.bool_or(F.col("url").startswith("https")).alias("any_tls"))


@query("""
WITH w AS (SELECT p_partkey, string_split(trim(regexp_replace(p_type, '\\s+', ' ', 'g')), ' ') AS w FROM part),
c AS (SELECT p_partkey, list_transform(w, lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))) AS w FROM w)
SELECT p_partkey, array_to_string(list_concat([w[1]], list_transform(w[2:], lambda x: lower(x))), ' ') AS label FROM c""")
def sentence_case(spark, d):
    """Labels in sentence case."""
    title = F.initcap(F.lower("p_type"))
    return table(spark, d, "part").select("p_partkey", T.sentence_case(title).alias("label"))


@query("SELECT doc_id, CASE WHEN length(line) <= 80 THEN line ELSE substr(regexp_replace(substr(line, 1, 81), '\\s+\\S*$', ''), 1, 80) END AS cut FROM (SELECT doc_id, string_split(text, chr(10))[1] AS line FROM documents)")
def fit_line(spark, d):
    """A text's first line cut at a word's end."""
    line = F.substring_index("text", "\n", 1)
    return _docs(spark, d).select("doc_id", T.fit_words(line).alias("cut"))


@query("""
SELECT doc_id, length(text) - length(replace(text, '@', '')) AS signs, len(regexp_extract_all(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b')) AS emails, len(regexp_extract_all(text, '\\bcwid_[a-z]+\\d+\\b')) AS ids FROM documents""")
def pii_scan(spark, d):
    """Addresses and person ids in texts."""
    n = lambda p: F.regexp_count("text", F.lit(p))
    signs = F.length("text") - F.length(F.replace("text", F.lit("@"), F.lit("")))
    return _docs(spark, d).select("doc_id", signs.alias("signs"), n(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b").alias("emails"), n(r"\bcwid_[a-z]+\d+\b").alias("ids"))


@query("""
WITH s AS (SELECT doc_id, text AS s FROM documents)
SELECT doc_id, NOT regexp_matches(s, '[.!?]["\\x27)\\]]?\\s+[A-Z]') AND length(trim(s)) > 0 AS single,
  length(trim(s)) > 0 AND NOT regexp_matches(substr(trim(s), 1, 1), '[a-z]') AND regexp_matches(s, '[.!?]["\\x27)\\]]*\\s*$') AS complete, len(regexp_extract_all(s, '\\S+')) AS words FROM s""")
def sentence_flags(spark, d):
    """Whether a text is one sentence, and whole."""
    s = F.col("text")
    single = ~s.rlike(r"[.!?][\"')\]]?\s+[A-Z]") & (F.length(F.trim(s)) > 0)
    complete = (F.length(F.trim(s)) > 0) & ~F.substring(F.trim(s), 1, 1).rlike("[a-z]") & s.rlike(r"[.!?][\"')\]]*\s*\z")
    return _docs(spark, d).select("doc_id", single.alias("single"), complete.alias("complete"), F.regexp_count("text", F.lit(r"\S+")).alias("words"))


@query("""
WITH t AS (SELECT conv_id, turn, text, len(regexp_extract_all(text, '\\S+')) AS n FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN contains(text, '—') THEN 'em_dash' END, CASE WHEN regexp_matches(lower(text), '\\b(today|recently|currently|now)\\b') THEN 'time_bound' END,
 CASE WHEN NOT regexp_matches(text, '[.!?]\\s*$') THEN 'open_end' END, CASE WHEN n < 22 OR n > 38 THEN 'length:' || CAST(n AS VARCHAR) END], lambda x: x IS NOT NULL), ',') AS failed FROM t""")
def lede_rules(spark, d):
    """Names of the rules that a short text breaks."""
    n = F.regexp_count("text", F.lit(r"\S+"))
    rules = F.array(F.when(F.col("text").contains("—"), "em_dash"), F.when(F.lower("text").rlike(r"\b(today|recently|currently|now)\b"), "time_bound"), F.when(~F.col("text").rlike(r"[.!?]\s*\z"), "open_end"), F.when((n < 22) | (n > 38), F.concat(F.lit("length:"), n.cast("string"))))
    return table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.array_join(F.array_compact(rules), ",").alias("failed"))


_USE = "|".join(T.USE_VERBS)
_BACK = "|".join(T.BACKGROUND)


@query(f"""
WITH s AS (SELECT item_id, text AS t, lower(split_part(text, ' ', 3)) AS f, text || CASE WHEN item_id % 3 = 0 THEN ' cells were transfected' WHEN item_id % 3 = 1 THEN ' is widely used' ELSE ' in Nav1.3' END AS s FROM benchmark),
c AS (SELECT item_id, s, f, CASE WHEN instr(lower(s), f) > 0 THEN (instr(lower(s), f) - 1) / length(s) ELSE 1.0 END AS frac FROM s)
SELECT item_id, round(greatest(0.0, least(1.0, 0.4 + CASE WHEN regexp_matches(lower(s), '\\b(?:{_USE})\\b') THEN 0.35 ELSE 0.0 END + CASE WHEN regexp_matches(s, '\\b(?:[A-Za-z]+\\d[A-Za-z0-9.\\-]*|[A-Z]{{2,}}\\d*)\\b') THEN 0.15 ELSE 0.0 END
  + 0.10 * round(1 - frac, 4) - CASE WHEN regexp_matches(lower(s), '{_BACK}') THEN 0.40 ELSE 0.0 END)), 4) AS score FROM c""")
def informativeness(spark, d):
    """How specifically a sentence uses what it names."""
    tail = F.when(F.col("item_id") % 3 == 0, " cells were transfected").when(F.col("item_id") % 3 == 1, " is widely used").otherwise(" in Nav1.3")
    b = table(spark, d, "benchmark").select("item_id", T.plain_lower(F.split_part("text", F.lit(" "), F.lit(3))).alias("f"), F.concat("text", tail).alias("s"))
    return b.select("item_id", T.informativeness(F.col("s"), F.col("f")).alias("score"))


@query("""
WITH x AS (SELECT page_id, html || '<ack>Thanks to the core of page ' || CAST(page_id AS VARCHAR) || '.</ack><ref-list>a<b>c</b></ref-list>' AS xml FROM pages)
SELECT page_id, regexp_extract(xml, '<ack>(.*?)</ack>', 1) AS ack, md5(trim(regexp_replace(regexp_replace(regexp_replace(xml, '(?is)<ref-list.*?</ref-list>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS plain_md5 FROM x""")
def ack_text(spark, d):
    """Acknowledgements, and plain text without the references."""
    xml = F.concat("html", F.lit("<ack>Thanks to the core of page "), F.col("page_id").cast("string"), F.lit(".</ack><ref-list>a<b>c</b></ref-list>"))
    x = table(spark, d, "pages").select("page_id", xml.alias("xml"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("xml", "(?is)<ref-list.*?</ref-list>", " "), "<[^>]+>", " "), r"\s+", " "))
    return x.select("page_id", F.regexp_extract("xml", "<ack>(.*?)</ack>", 1).alias("ack"), F.md5(plain).alias("plain_md5"))


@query("""
WITH s AS (SELECT doc_id, text, instr(text, 'License') AS pos FROM documents WHERE instr(text, 'License') > 0)
SELECT doc_id, substr(text, greatest(1, pos - 70), 70 + 7 + 70 - greatest(0, 71 - pos)) AS snippet, CASE WHEN contains(substr(text, greatest(1, pos - 140), 290), 'Apache') THEN 'home' WHEN contains(substr(text, greatest(1, pos - 140), 290), 'Public') THEN 'other' ELSE 'none' END AS place FROM s""")
def alias_context(spark, d):
    """First match of an alias, its snippet, and what the window around it names."""
    s = _docs(spark, d).withColumn("at", F.instr("text", "License")).where("at > 0")
    window = F.substring(F.col("text"), F.greatest(F.lit(1), F.col("at") - 140), F.lit(290))
    snippet = F.substring(F.col("text"), F.greatest(F.lit(1), F.col("at") - 70), F.lit(147) - F.greatest(F.lit(0), 71 - F.col("at")))
    return s.select("doc_id", snippet.alias("snippet"), F.when(window.contains("Apache"), "home").when(window.contains("Public"), "other").otherwise("none").alias("place"))


@query("""
WITH t AS (SELECT DISTINCT s_suppkey, s_name FROM supplier), w AS (SELECT s_suppkey, string_split(trim(replace(s_name, '#', ' ')), ' ') AS w FROM t)
SELECT s_suppkey, w[1] AS first, w[len(w)] AS last FROM w""")
def byline_parts(spark, d):
    """First and last word of a byline without markers."""
    w = F.split(F.trim(F.replace("s_name", F.lit("#"), F.lit(" "))), " ")
    return table(spark, d, "supplier").select("s_suppkey", F.element_at(w, 1).alias("first"), F.element_at(w, -1).alias("last"))


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{4,}') AS t FROM documents), u AS (SELECT doc_id, unnest(t) AS w FROM d),
tf AS (SELECT doc_id, w, 1 + ln(count(*)) AS tf FROM u GROUP BY 1, 2), n AS (SELECT count(DISTINCT doc_id) AS n FROM documents), df AS (SELECT w, ln((1 + n.n) / (1 + count(*))) + 1 AS idf FROM tf, n GROUP BY w, n.n HAVING count(*) >= 2),
x AS (SELECT doc_id, tf.w, tf * idf AS x FROM tf JOIN df ON tf.w = df.w), z AS (SELECT doc_id, sqrt(sum(x * x)) AS z FROM x GROUP BY 1)
SELECT x.doc_id, count(*) AS terms, round(max(x.x / z), 6) AS top_weight, round(sum(x.x / z), 6) AS l1 FROM x JOIN z ON x.doc_id = z.doc_id GROUP BY 1""")
def tfidf_vectors(spark, d):
    """Sublinear tf, smoothed idf over words of at least two of all documents, unit length: summaries of the vectors."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0))
    docs = table(spark, d, "documents")
    # texts are dealt once by document: words of a document meet without a further exchange, and so do its weights if the vocabulary is small
    u = docs.select("doc_id", "text").repartition("doc_id").select("doc_id", words.alias("w"))
    tf = u.groupBy("doc_id", "w").agg((1 + F.ln(F.count("*"))).alias("tf"))
    n = docs.agg(F.countDistinct("doc_id").alias("n"))
    df = tf.groupBy("w").agg(F.count("*").alias("c")).where("c >= 2").join(F.broadcast(n)).select("w", (F.ln((1 + F.col("n")) / (1 + F.col("c"))) + 1).alias("idf"))
    x = tf.join(small(df), "w").select("doc_id", (F.col("tf") * F.col("idf")).alias("x"))
    z = x.groupBy("doc_id").agg(F.count("*").alias("terms"), F.max("x").alias("m"), F.sum("x").alias("s"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("z"))
    return z.select("doc_id", "terms", F.round(F.col("m") / F.col("z"), 6).alias("top_weight"), F.round(F.col("s") / F.col("z"), 6).alias("l1"))


@query("""
WITH u AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+ [a-z]+')) AS p FROM documents WHERE lang = 'en'),
a AS (SELECT p, count(DISTINCT doc_id) AS df FROM u GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3)
SELECT p AS phrase, df, CAST(row_number() OVER (ORDER BY df DESC, p) AS INTEGER) AS place FROM a""")
def phrase_rank(spark, d):
    """Capitalised phrases by document frequency."""
    from quillspark.operators.ranking import numbered

    p = F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ [a-z]+ [a-z]+"), 0))
    u = table(spark, d, "documents").where("lang = 'en'").select("doc_id", p.alias("phrase"))
    a = u.groupBy("phrase").agg(F.countDistinct("doc_id").alias("df")).where("df >= 3")
    return numbered(a, [F.col("df").desc(), F.col("phrase")]).withColumn("place", F.col("place").cast("int"))


@query("""
WITH v AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00' WHEN 1 THEN 'due ' || strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 3 THEN strftime(o_orderdate, '%d-%b-%Y') ELSE 'rolling' END AS t, o_orderdate FROM orders)
SELECT id, CASE WHEN id % 5 = 4 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM v""")
def date_parse(spark, d):
    """Dates of four shapes to ISO; empty if there is none."""
    from quillspark.functions.dates import iso_date

    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    shape = F.when(k % 5 == 0, F.concat(F.date_format(t, "yyyy-MM-dd"), F.lit(" 00:00"))).when(k % 5 == 1, F.concat(F.lit("due "), F.date_format(t, "M/d/yyyy")))
    shape = shape.when(k % 5 == 2, F.date_format(t, "MMMM d, yyyy")).when(k % 5 == 3, F.date_format(t, "dd-MMM-yyyy")).otherwise("rolling")
    return table(spark, d, "orders").select(k.alias("id"), iso_date(shape).alias("iso"))


@query("""
WITH v AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN 'none' ELSE 'from $' || CAST(p_size * 100 AS VARCHAR) || ' up to $' || CAST(p_size AS VARCHAR) || ',' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') END AS t, p_size, p_partkey FROM part)
SELECT id, CASE WHEN id % 6 <> 0 THEN greatest(p_size * 100, p_size * 1000 + p_partkey % 1000) END AS largest, CASE WHEN id % 6 <> 0 THEN CAST(p_size * 100 AS BIGINT) END AS first FROM v""")
def amount_parse(spark, d):
    """The largest and the first figure of a text."""
    from quillspark.functions.dates import first_number, largest_amount

    k = F.col("p_partkey")
    t = F.when(k % 6 == 0, "none").otherwise(F.concat(F.lit("from $"), (F.col("p_size") * 100).cast("string"), F.lit(" up to $"), F.col("p_size").cast("string"), F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0")))
    return table(spark, d, "part").select(k.alias("id"), largest_amount(t).alias("largest"), first_number(t).alias("first"))


@query("SELECT user_id, sha256(array_to_string(list_sort(list_distinct(list(CAST(json_extract_string(props, '$.k') AS VARCHAR)))), ',')) AS set_hash FROM events GROUP BY 1")
def set_hash(spark, d):
    """A hash of a set that doesn't depend on its order."""
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").groupBy("user_id").agg(F.sha2(F.array_join(F.sort_array(F.collect_set(k)), ","), 256).alias("set_hash"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS fenced, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_lenient(spark, d):
    """JSON inside fences or prose: the first object is read."""
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(F.concat(F.lit("Here: "), "props", F.lit(" done")))
    obj = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    k = F.from_json(obj, "k int")["k"]
    return table(spark, d, "events").select("event_id", F.when(raw.startswith("```"), k).alias("fenced"), k.alias("k"))


@query("""
WITH p AS (SELECT p_partkey, p_brand, p_name, lower(split_part(p_name, ' ', 1)) AS w FROM part)
SELECT p_partkey, CASE WHEN list_contains(string_split(lower(p_name || ' ' || p_brand), ' '), w) AND p_partkey % 2 = 0 THEN w ELSE '' END AS violation, regexp_matches(lower(p_name), '(red|blue|green)') AS sensitive FROM p""")
def label_gates(spark, d):
    """A label whose first word repeats a parent word, and labels that hold a listed tag."""
    w = F.lower(F.split_part("p_name", F.lit(" "), F.lit(1)))
    parent = F.when(F.col("p_partkey") % 2 == 0, F.split(F.lower(F.concat("p_name", F.lit(" "), "p_brand")), " ")).otherwise(F.array())
    tags = F.array(*[F.lit(t) for t in ("red", "blue", "green")])
    return table(spark, d, "part").select("p_partkey", F.when(F.array_contains(parent, w), w).otherwise("").alias("violation"), F.exists(tags, lambda t: F.lower("p_name").contains(t)).alias("sensitive"))
