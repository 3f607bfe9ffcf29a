"""Lines, logistic fits and replicates by sums: what reaches the driver has a size of its own, whatever the rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Smoothing of hits on either side; penalties that a joint fit chooses from, folds, and Newton steps at most (fixed values).
ALPHA = 0.5
GRID = (0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0)
FOLDS, STEPS = 5, 50


def evidence_line(bins: DataFrame) -> DataFrame:
    """bins(x, ph, nh), a row a bin: slope, base, r2 of the line through the bins' smoothed weights of evidence.

    A bin's weight is the inverse of its log-odds' variance, so that a bin of few rows doesn't outvote one of many.
    """
    totals = F.broadcast(bins.agg(F.sum("ph").alias("pn"), F.sum("nh").alias("nn")))  # one row
    y = F.ln(((F.col("ph") + ALPHA) / (F.col("pn") + 2 * ALPHA)) / ((F.col("nh") + ALPHA) / (F.col("nn") + 2 * ALPHA)))
    w = 1 / (1 / (F.col("ph") + ALPHA) + 1 / (F.col("nh") + ALPHA))
    b = bins.join(totals).select(F.col("x").cast("double").alias("x"), y.alias("y"), w.alias("w"))
    means = F.broadcast(b.agg((F.sum(F.expr("w * x")) / F.sum("w")).alias("mx"), (F.sum(F.expr("w * y")) / F.sum("w")).alias("my")))
    m = b.join(means).groupBy("mx", "my").agg(*[F.sum(F.expr(e)).alias(n) for n, e in (("xx", "w * (x - mx) * (x - mx)"), ("xy", "w * (x - mx) * (y - my)"), ("yy", "w * (y - my) * (y - my)"))])
    slope = F.col("xy") / F.col("xx")
    return m.select(F.round(slope, 6).alias("slope"), F.round(F.col("my") - slope * F.col("mx"), 6).alias("base"), F.round(slope * F.col("xy") / F.col("yy"), 6).alias("r2"))


def _terms(names: list[str], y: str, w: Column, z: Column) -> list[Column]:
    """Gradient and Hessian sums of a weighted logistic fit at the linear predictor z; the first feature is the constant."""
    q = 1 / (1 + F.exp(-z))
    x = [F.lit(1.0), *[F.col(n) for n in names]]
    grad = [F.sum(w * (F.col(y) - q) * a).alias(f"g{i}") for i, a in enumerate(x)]
    hess = [F.sum(w * q * (1 - q) * a * b).alias(f"h{i}_{j}") for i, a in enumerate(x) for j, b in enumerate(x) if j >= i]
    return grad + hess


def _step(r, beta: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """A Newton step from sums; steps are cut to one, as far from the optimum Newton overshoots."""
    k = len(beta)
    g = np.array([r[f"g{i}"] for i in range(k)]) - penalty * beta
    h = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) + np.diag(penalty)
    return np.clip(np.linalg.lstsq(h, g, rcond=None)[0], -1.0, 1.0)


def logistic_fit(df: DataFrame, features: list[str], y: str, weight: str | None = None, offset: str | None = None, ridge: float = 0.0) -> list[float]:
    """Intercept and slopes of logistic(offset + intercept + slopes * features), by Newton steps over sums.

    A little ridge keeps separable panels finite. No rows give zeros.
    """
    beta, penalty = np.zeros(1 + len(features)), np.full(1 + len(features), ridge)
    w = F.col(weight) if weight else F.lit(1.0)
    for _ in range(STEPS):
        z = F.lit(float(beta[0])) + (F.col(offset) if offset else F.lit(0.0))
        for n, b in zip(features, beta[1:], strict=True):
            z = z + float(b) * F.col(n)
        r = df.agg(*_terms(features, y, w, z)).first()
        if r["h0_0"] is None:
            break
        step = _step(r, beta, penalty)
        beta = beta + step
        if np.abs(step).sum() < 1e-10:
            break
    return beta.tolist()


def _fold(key: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def joint_logistic(df: DataFrame, features: list[str], y: str, key: str, grid: tuple[float, ...] = GRID, folds: int = FOLDS) -> tuple[float, list[float]]:
    """(penalty, weights): logistic regression on standardised features, the constant not penalised.

    The inverse penalty comes from the grid, by log-loss on folds (by a hash of the key) that a fit hasn't seen; all fits of
    folds and penalties take their steps together, in one aggregation each, so that the driver gets grid x folds sums.
    """
    spread = df.agg(*[F.avg(n).alias(f"m_{n}") for n in features], *[F.stddev_pop(n).alias(f"s_{n}") for n in features]).first()
    x = df.select(y, _fold(key, folds).alias("fold"), *[((F.col(n) - float(spread[f"m_{n}"] or 0)) / float(spread[f"s_{n}"] or 1)).alias(n) for n in features])
    k = 1 + len(features)
    # fold -1 sees every row: the fit that is returned
    fits = {(c, f): np.zeros(k) for c in grid for f in (-1, *range(folds))}
    still = set(fits)
    for _ in range(STEPS):
        if not still:
            break
        order = sorted(still)
        cases = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(f).alias("out"), *[F.lit(float(v)).alias(f"b{j}") for j, v in enumerate(fits[c, f])]) for i, (c, f) in enumerate(order)])
        e = x.select("*", F.explode(cases).alias("t")).where("fold <> t.out")
        z = F.col("t.b0")
        for j, n in enumerate(features):
            z = z + F.col(f"t.b{j + 1}") * F.col(n)
        for r in e.groupBy("t.fit").agg(*_terms(features, y, F.lit(1.0), z)).collect():  # a row a fit
            c, f = order[r["fit"]]
            step = _step(r, fits[c, f], np.array([0.0, *[1 / c] * (k - 1)]))
            fits[c, f] = fits[c, f] + step
            if np.abs(step).sum() < 1e-9:
                still.discard((c, f))
    cases = F.array(*[F.struct(F.lit(float(c)).alias("c"), F.lit(f).alias("out"), *[F.lit(float(v)).alias(f"b{j}") for j, v in enumerate(b)]) for (c, f), b in fits.items() if f >= 0])
    e = x.select("*", F.explode(cases).alias("t")).where("fold = t.out")
    z = F.col("t.b0")
    for j, n in enumerate(features):
        z = z + F.col(f"t.b{j + 1}") * F.col(n)
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), 1 / (1 + F.exp(-z))))
    losses = {r["c"]: r["loss"] for r in e.groupBy("t.c").agg(F.sum(-(F.col(y) * F.ln(p) + (1 - F.col(y)) * F.ln(1 - p))).alias("loss")).collect()}
    best = min(grid, key=lambda c: (round(losses.get(float(c), math.inf), 9), c))
    return best, fits[best, -1].tolist()


def cross_fitted(df: DataFrame, z: str, y: str, key: str, folds: int = 10) -> DataFrame:
    """(model, rows, log_loss): the raw score z, its best shift and its best line, each judged on folds that it hasn't seen."""
    t = df.withColumn("_fold", _fold(key, folds))
    rows = []
    for f in range(folds):
        (shift,) = logistic_fit(t.where(F.col("_fold") != f), [], y, offset=z, ridge=1e-6)
        a, b = logistic_fit(t.where(F.col("_fold") != f), [z], y, ridge=1e-6)
        rows.append(F.when(F.col("_fold") == f, F.struct(F.lit(shift).alias("s"), F.lit(a).alias("a"), F.lit(b).alias("b"))))
    m = F.coalesce(*rows)
    models = F.array(F.struct(F.lit("score").alias("model"), F.col(z).alias("v")), F.struct(F.lit("shift").alias("model"), (F.col(z) + m["s"]).alias("v")), F.struct(F.lit("line").alias("model"), (m["a"] + m["b"] * F.col(z)).alias("v")))
    e = t.select(y, F.explode(models).alias("e")).select(y, "e.*")
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), 1 / (1 + F.exp(-F.col("v")))))
    return e.groupBy("model").agg(F.count("*").alias("rows"), F.round(F.avg(-(F.col(y) * F.ln(p) + (1 - F.col(y)) * F.ln(1 - p))), 6).alias("log_loss"))


def poisson(key: str, replicate: str) -> Column:
    """A row's Poisson(1) weight in a replicate, from a hash of both; 5 stands for all above 4."""
    u = F.pmod(F.xxhash64(key, replicate), F.lit(1_000_003)) / 1_000_003
    return F.when(u < 0.367879, 0).when(u < 0.735759, 1).when(u < 0.919699, 2).when(u < 0.981012, 3).when(u < 0.996340, 4).otherwise(5)


def replicates(df: DataFrame, key: str, values: dict[str, Column], n: int) -> DataFrame:
    """(rep, a weighted mean for each value): bootstrap replicates that share their rows' weights, so that means are paired."""
    e = df.select(key, *[c.alias(name) for name, c in values.items()], F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep")).withColumn("_w", poisson(key, "rep"))
    return e.groupBy("rep").agg(*[(F.sum(F.col("_w") * F.col(v)) / F.sum("_w")).alias(v) for v in values])
