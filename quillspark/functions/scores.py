"""Scalar scores: locked exponents, logistic forms, gates, decays and bands."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exponents of the article score and parameters of the evidence model (fixed values).
IMPACT_POWER, RELEVANCE_POWER = 1.2, 1.4
PRIOR_LOGIT = math.log(0.02 / 0.98)


def article_score(impact: Column, relevance: Column) -> Column:
    """(impact / 100)^1.2 * relevance^1.4"""
    return F.pow(impact / 100, F.lit(IMPACT_POWER)) * F.pow(relevance, F.lit(RELEVANCE_POWER))


def sigmoid(x: Column) -> Column:
    """Stable at both tails: the exponent is never positive."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def soft_gate(n: Column, c: float, h: float) -> Column:
    """1 / (1 + (c / n)^h), 0 for n <= 0."""
    return F.when(n > 0, 1 / (1 + F.pow(F.lit(c) / n, F.lit(h)))).otherwise(F.lit(0.0))


def half_life(distance: Column, life: float) -> Column:
    return F.pow(F.lit(0.5), F.abs(distance) / life)


def decayed(pool: Column, weeks: Column, tau: float = 12.0) -> Column:
    """pool * (1 - exp(-weeks / tau)); never shown (null) keeps the whole score."""
    return F.when(weeks.isNull(), pool).otherwise(pool * (1 - F.exp(-weeks / tau)))


def noisy_or(*ps: Column) -> Column:
    out = F.lit(1.0)
    for p in ps:
        out = out * (1 - F.coalesce(p, F.lit(0.0)))
    return 1 - out


def log_bucket(x: Column, lo: float = 4.0, hi: float = 7.0) -> Column:
    """(log10(x) - lo) / (hi - lo) clamped to [0, 1]; null for nothing or less."""
    return F.when(x > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.log10(x) - lo) / (hi - lo))))


def abstaining_mean(parts: list[tuple[float, Column]], none: float) -> Column:
    """Weighted mean over the parts that are not null; `none` if all abstain."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for w, v in parts:
        total = total + F.when(v.isNotNull(), w * v).otherwise(0.0)
        weight = weight + F.when(v.isNotNull(), w).otherwise(0.0)
    return F.when(weight > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), total / weight))).otherwise(none)


def band(x: Column, *steps: tuple[float, str], low: str) -> Column:
    """The label of the first threshold that x reaches."""
    out = None
    for t, label in steps:
        out = F.when(x >= t, label) if out is None else out.when(x >= t, label)
    return out.otherwise(low)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval of k successes in n; (0, 1) for n = 0."""
    p = k / n
    mid, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n > 0, (mid - spread) / (1 + z * z / n)).otherwise(0.0), F.when(n > 0, (mid + spread) / (1 + z * z / n)).otherwise(1.0)


def sort_key(score: Column) -> Column:
    """Score as four digits, floor(1000 * score) capped at 9999."""
    return F.lpad(F.least(F.floor(score * 1000), F.lit(9999)).cast("string"), 4, "0")
