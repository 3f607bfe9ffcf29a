"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

Every row gets a uniform 24-bit key from a digest of its id and text. Words are summed by (source, first 12 bits); prefix
sums over at most 4,096 buckets a source find the bucket in which a source's budget ends; only that boundary bucket is
summed again by its next 12 bits. A row is then kept by comparing its key with its source's threshold: no sort of rows,
and the thresholds are nested, so that a larger budget keeps every row that a smaller one kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, drop_stored, key_of, packed, small_side, stored

#: Weights are dealt to the sources in code point order, null last.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MAX_EPOCHS = 3


def _keyed(docs: DataFrame) -> DataFrame:
    """(_doc, _s, source, _size, _h): each row whole, with its source's key, its words and its uniform key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)), 256)
    return packed(docs, _s=key_of("source"), source=F.col("source").cast("string"), _size=F.regexp_count(text, F.lit(WORD)).cast("long"), _h=F.substring(digest, 1, 6))


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """totals(_s, source, _total): adds _target, the water-filled share of all words, at most epochs times the source.

    One row a source meets in one task here: sources are the mixture's configuration, not its data.
    """
    table = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("_w", F.element_at(table, (F.pmod(F.col("_i") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_cap", F.col("_total") * epochs)
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_i").asc())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    filled = ranked.withColumns({"_all": F.sum("_total").over(every), "_ws": F.sum("_w").over(every), "_c0": F.coalesce(F.sum("_cap").over(before), zero), "_w0": F.coalesce(F.sum("_w").over(before), zero)})
    filled = filled.withColumn("_capped", F.col("_w") * (F.col("_all") - F.col("_c0")) >= F.col("_cap") * (F.col("_ws") - F.col("_w0")))
    gone = lambda c: F.coalesce(F.sum(F.when(F.col("_capped"), F.col(c))).over(every), zero)
    filled = filled.withColumns({"_cg": gone("_cap"), "_wg": gone("_w")})
    share = (F.col("_w") * (F.col("_all") - F.col("_cg"))).cast("double") / F.nullif((F.col("_ws") - F.col("_wg")).cast("double"), F.lit(0.0))
    return filled.select("_s", "source", "_total", F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share).alias("_target"))


def _cut(hist: DataFrame, base) -> DataFrame:
    """hist(_s, _left, _b, _n): running sums by bucket within a source, from `base`."""
    run = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("_to", F.sum("_n").over(run) + base).withColumn("_from", F.col("_to") - F.col("_n"))


def thresholds(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes(_s, source, _size, _h): one row a source with _total, _target, _times (whole passes) and _until (6 hex digits).

    A row is taken _times times, and once more if _h < _until. The 24-bit bucket in which the budget ends is taken if that
    brings the source nearer to its target. Reads `sizes` twice: pass a stored table where it is dear.
    """
    hist = stored(sizes.groupBy("_s", F.substring("_h", 1, 3).alias("_b")).agg(F.first("source").alias("source"), F.sum("_size").alias("_n")), "mixhist")
    totals = hist.groupBy("_s").agg(F.first("source").alias("source"), F.sum("_n").alias("_total"))
    plan = source_targets(totals, weights, epochs)
    plan = plan.withColumn("_times", F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(F.lit(0)).cast("long"))
    plan = stored(plan.withColumn("_left", F.col("_target") - F.col("_times") * F.col("_total")), "mixplan")
    coarse = _cut(hist.drop("source").join(small_side(plan.select("_s", "_left")), "_s"), F.lit(0))
    edge = stored(coarse.where((F.col("_from") <= F.col("_left")) & (F.col("_left") < F.col("_to"))).select("_s", "_left", F.col("_b").alias("_edge"), F.col("_from").alias("_base")), "mixedge")
    inside = sizes.join(small_side(edge), "_s").where(F.substring("_h", 1, 3) == F.col("_edge"))
    fine = _cut(inside.groupBy("_s", "_left", "_base", "_edge", F.col("_h").alias("_b")).agg(F.sum("_size").alias("_n")), F.col("_base"))
    until = fine.where(F.col("_from") + F.col("_to") > 2 * F.col("_left")).groupBy("_s").agg(F.min("_b").alias("_fine"))
    out = plan.join(edge.select("_s", "_edge"), "_s", "left").join(until, "_s", "left")
    # without an edge bucket nothing is left to take; without a first refused key the whole edge bucket is taken
    cut = F.when(F.col("_edge").isNull(), F.lit("")).otherwise(F.coalesce(F.col("_fine"), F.concat(F.col("_edge"), F.lit("g"))))
    return out.select("_s", "_total", "_target", "_times", cut.alias("_until"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """docs(doc_id, text, source, ...): every row once, with size, source_size, target, copies (how often the mix takes it).

    Null texts have size 0; null sources are one source, last in order; rows equal in doc_id and text share a key and are
    taken alike; an empty table gives an empty result; other columns pass through, but for those of the result's own names.
    """
    out = _planned(docs, weights, epochs)
    own = {"mix_size": F.col("_size"), "mix_source_size": F.col("_total"), "mix_target": F.col("_target"), "mix_copies": F.col("_copies")}
    return out.select(*[F.col("_doc")[c].alias(c) for c in docs.columns if c not in own], *[v.alias(k) for k, v in own.items()])


def _planned(docs: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """_keyed() with each source's plan and each row's _copies."""
    keyed = _keyed(docs)
    sizes = stored(keyed.select("_s", "source", "_size", "_h"), "mixsizes")
    cuts = stored(thresholds(sizes, weights, epochs), "mixcuts")
    drop_stored(sizes)
    return keyed.join(small_side(cuts), "_s", "left").withColumn("_copies", _copies())


def _copies():
    return (F.col("_times") + F.when(F.col("_h") < F.col("_until"), 1).otherwise(0)).cast("long")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each row as many times as it is taken, with the columns of docs."""
    out = _planned(docs, weights, epochs).where("_copies > 0")
    return out.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of mix() over all documents: computed once from a narrow table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sizes = stored(_keyed(docs).select("_doc.doc_id", "_s", "source", "_size", "_h"), "mixsizes")
    cuts = stored(thresholds(sizes), "mixcuts")
    out = sizes.join(small_side(cuts), "_s", "left").withColumn("_copies", _copies())
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(sha256(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 6) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, 1 + i % 3 AS w, 3 * total AS cap FROM r),
f AS (
  SELECT *, (SELECT sum(total) FROM w) AS alls, (SELECT sum(w) FROM w) AS ws,
         coalesce(sum(cap) OVER o, 0) AS c0, coalesce(sum(w) OVER o, 0) AS w0
  FROM w WINDOW o AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, w * (alls - c0) >= cap * (ws - w0) AS capped FROM f),
t AS (
  SELECT source, total, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
    CAST(w * (alls - (SELECT coalesce(sum(cap), 0) FROM g WHERE capped)) AS DOUBLE)
    / CAST(ws - (SELECT coalesce(sum(w), 0) FROM g WHERE capped) AS DOUBLE) END AS target
  FROM g),
u AS (SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS times FROM t),
b AS (
  SELECT d.source, h, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY d.source ORDER BY h) AS upto
  FROM d GROUP BY d.source, h)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(u.total AS BIGINT) AS source_size, u.target,
       CAST(d.size * (u.times + CASE WHEN 2 * b.upto - b.n <= 2 * (u.target - u.times * u.total)
                                  AND u.target - u.times * u.total > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source JOIN b ON b.source IS NOT DISTINCT FROM d.source AND b.h = d.h
"""
