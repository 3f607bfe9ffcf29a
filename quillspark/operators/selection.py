"""Greedy selections over a ranked pool. A pool is a top-k report (150 rows), so that one group holds it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diverse(pool: DataFrame, clones: DataFrame, target: int, floor: int) -> DataFrame:
    """pool(id, parent, score), clones(a, b): (id, place, how), by score descending, then id.

    First pass: one of each parent, nothing that is a near clone of what is chosen, up to `target`. Only if that leaves
    fewer than `floor`, the second pass fills up to it, those with the fewest chosen clones first.
    """

    def select(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "id"], ascending=[False, True])
        near = {i: set(n) for i, n in zip(pdf["id"], pdf["near"], strict=True)}
        chosen: list[tuple[str, str]] = []
        ids, parents = set(), set()
        for i, parent in zip(pdf["id"], pdf["parent"], strict=True):
            if len(chosen) == target:
                break
            if parent not in parents and not near[i] & ids:
                chosen.append((i, "distinct"))
                ids.add(i)
                parents.add(parent)
        rest = [i for i in pdf["id"] if i not in ids]
        while len(chosen) < floor and rest:
            pick = min(rest, key=lambda i: (len(near[i] & ids), rest.index(i)))
            rest.remove(pick)
            ids.add(pick)
            chosen.append((pick, "fill"))
        return pd.DataFrame([(i, k + 1, how) for k, (i, how) in enumerate(chosen)], columns=["id", "place", "how"])

    both = clones.select(F.col("a").alias("id"), F.col("b").alias("n")).union(clones.select(F.col("b"), F.col("a")))
    near = pool.select("id").join(both, "id").groupBy("id").agg(F.collect_set("n").alias("near"))
    rows = pool.join(near, "id", "left").withColumn("near", F.coalesce("near", F.array().cast("array<string>")))
    return rows.groupBy(F.lit(1).alias("g")).applyInPandas(lambda pdf: select(pdf), "id string, place int, how string")


def penalised(pool: DataFrame, target: int, penalty: float = 0.08) -> DataFrame:
    """pool(id, scholar, score): picks the best of score - penalty * median * picks its scholar has already, ties by id."""

    def select(pdf: pd.DataFrame) -> pd.DataFrame:
        step = penalty * float(pdf["score"].median())
        load: dict[int, int] = {}
        left = sorted(zip(pdf["id"], pdf["scholar"], pdf["score"], strict=True))
        out = []
        while left and len(out) < target:
            k = min(range(len(left)), key=lambda j: (-(left[j][2] - step * load.get(left[j][1], 0)), left[j][0]))
            i, who, score = left.pop(k)
            out.append((i, len(out) + 1, round(score - step * load.get(who, 0), 6)))
            load[who] = load.get(who, 0) + 1
        return pd.DataFrame(out, columns=["id", "place", "value"])

    return pool.groupBy(F.lit(1).alias("g")).applyInPandas(lambda pdf: select(pdf), "id string, place int, value double")
