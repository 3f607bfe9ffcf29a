"""Identity of mentions: matched to a registry's records, or minted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import has_phrase, norm_name, surface_keys
from quillspark.operators.blocks import against, small
from quillspark.operators.overlap import cosine
from quillspark.operators.ranking import numbered

#: Cosine from which the nearest record's vector is a match (fixed value).
MATCH_COSINE = 0.86


def _apart(a: Column, b: Column, terms: Sequence[tuple[str, str]]) -> Column:
    """Whether folding a into b would join two terms that are kept apart, either way round."""
    out = F.lit(False)
    for x, y in terms:
        out = out | (has_phrase(a, F.lit(x)) & has_phrase(b, F.lit(y))) | (has_phrase(a, F.lit(y)) & has_phrase(b, F.lit(x)))
    return out


def match_or_mint(mentions: DataFrame, records: DataFrame, denied: Sequence[str] = (), variants: Sequence[tuple[str, str]] = (), apart: Sequence[tuple[str, str]] = (), least: float = MATCH_COSINE) -> DataFrame:
    """mentions(form, n, name, vector), one a normalised form; records(id, name, vector): form, n, action, via, tool_id.

    In order: a denied form is left out. A form attaches to the record that holds its first surface key, in order of keys, or
    the class of its curated variant; of records with one key the lowest id holds it. Otherwise it attaches to the nearest
    record by cosine, if near enough, the lowest id on ties. A match that would fold terms kept apart is passed over (a
    surface key) or ends in a mint (the nearest record). The rest mint ids above the registry's highest, in order of forms.
    """
    spark = mentions.sparkSession
    classes = spark.createDataFrame([(norm, cls) for norm, cls in variants], "_form string, _class string")

    def keyed(df: DataFrame, form: Column, *keep: str) -> DataFrame:
        own = df.select(*keep, F.explode(surface_keys(F.col("name"))).alias("_key"))
        variant = df.select(*keep, form.alias("_form")).join(F.broadcast(classes), "_form").select(*keep, F.col("_class").alias("_key"))
        return own.unionByName(variant).distinct()

    named = records.select("id", "name")
    holder = keyed(named, norm_name(F.col("name")), "id").groupBy("_key").agg(F.min("id").alias("id")).join(named.withColumnRenamed("name", "_record"), "id")
    known = mentions.select("form", "name").where(~F.col("form").isin(list(denied)))
    hits = keyed(known, F.col("form"), "form", "name").join(small(holder), "_key").where(~_apart(F.col("name"), F.col("_record"), apart))
    surface = hits.groupBy("form").agg(F.min_by("id", "_key").alias("_surface"))
    rest = mentions.where(~F.col("form").isin(list(denied))).join(surface, "form", "left_anti")

    # records meet the open forms in blocks of a bounded number of records; of blocks the best is taken again
    vectors = records.where("vector is not null").select(F.col("id").alias("_id"), F.col("name").alias("_record"), F.col("vector").alias("_vector"))
    found = against(rest.where("vector is not null"), vectors, "_id", F.lit(True), lambda pairs: pairs.select("form", "name", "_id", "_record", F.round(cosine(F.col("vector"), F.col("_vector")), 8).alias("_sim")).where(F.col("_sim") >= least))
    best = found.groupBy("form").agg(F.max_by(F.struct("_id", "_record", "name"), F.struct("_sim", (-F.col("_id")).alias("_at"))).alias("_best"))
    near = best.select("form", F.col("_best._id").alias("_near"), _apart(F.col("_best.name"), F.col("_best._record"), apart).alias("_blocked"))
    out = mentions.select("form", "n").join(surface, "form", "left").join(near, "form", "left")
    is_denied, attached = F.col("form").isin(list(denied)), F.coalesce("_surface", F.when(~F.col("_blocked"), F.col("_near")))
    action = F.when(is_denied, "denied").when(attached.isNotNull(), "attached").otherwise("minted")
    via = F.when(F.col("_surface").isNotNull(), "surface").when(F.col("_blocked"), "kept apart").when(F.col("_near").isNotNull(), "embedding")
    out = out.select("form", "n", action.alias("action"), F.when(~is_denied, via).alias("via"), F.when(~is_denied, attached).alias("tool_id"))
    minted = numbered(out.where("action = 'minted'"), [F.col("form")], "_place")
    high = F.broadcast(records.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_high")))  # one row
    minted = minted.join(high).withColumn("tool_id", F.col("_high") + F.col("_place")).drop("_high", "_place")
    return out.where("action <> 'minted'").unionByName(minted)
