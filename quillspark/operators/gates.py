"""A registry of quality gates: named checks that return violation rows, run in order, each blocking or warning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Check = Callable[..., DataFrame]
_GATES: dict[str, list[tuple[str, str, Check]]] = {}


def gate(stage: str, severity: str = "block", name: str | None = None):
    """Registers a function that returns (item, detail) rows for what is wrong."""
    if severity not in ("block", "warn"):
        raise ValueError("severity is block or warn")

    def keep(f: Check) -> Check:
        _GATES.setdefault(stage, []).append((name or f.__name__, severity, f))
        return f

    return keep


def run_gates(stage: str, *args) -> DataFrame:
    """(gate, severity, violations, passed) in the order of registration."""
    rows = None
    for place, (name, severity, f) in enumerate(_GATES.get(stage, [])):
        one = f(*args).agg(F.count("*").alias("violations")).select(F.lit(place).alias("place"), F.lit(name).alias("gate"), F.lit(severity).alias("severity"), "violations", (F.col("violations") == 0).alias("passed"))
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise KeyError(stage)
    return rows


def blocked(results: DataFrame) -> bool:
    return results.where("severity = 'block' and not passed").limit(1).count() > 0


class TooFew(RuntimeError):
    """A read came back with fewer rows than its floor."""


def guard_floor(df: DataFrame, floor: int, mode: str = "abort") -> DataFrame:
    """Raises (or, in mode warn, only returns) if df has fewer rows than the floor; counts no more than it must."""
    if df.limit(floor).count() < floor and mode == "abort":
        raise TooFew(f"fewer than {floor} rows")
    return df


#: Reviews (fixed values): the form of a reviewer's id, and the signs that a rationale has at least.
REVIEWER, RATIONALE = r"^cwid_[a-z]+[0-9]+$", 40


def review_errors(reviewer: Column, rationale: Column, decision: Column, resolves: Column, failed: Column, blocks: Column) -> Column:
    """What is wrong with a review, in order, as an array: its reviewer, rationale, decision, artifact; and, where it approves,
    failed stages and blocking gates. Nulls are empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    approves = text(decision) == "approve"
    rules = (
        (~text(reviewer).rlike(REVIEWER), "reviewer"),
        (F.length(F.regexp_replace(text(rationale), r"^\s+|\s+$", "")) < RATIONALE, "rationale"),
        (~text(decision).isin("approve", "reject"), "decision"),
        (~F.coalesce(resolves, F.lit(False)), "artifact"),
        (approves & some(failed), "failed stages"),
        (approves & some(blocks), "gate blocks"),
    )
    return F.array_compact(F.array(*[F.when(wrong, name) for wrong, name in rules]))


#: A collection of cards (fixed values): the least it may hold, and the share of the version before that it may lose.
LEAST_CARDS, CARD_SHRINK = 8, 0.34


def card_verdict(now: Column, before: Column, least: int = LEAST_CARDS, shrink: float = CARD_SHRINK) -> Column:
    """'floor' for too few cards, 'shrunk' for too many lost (of a version before that had some), else 'publish'."""
    return F.when(now < least, "floor").when((F.coalesce(before, F.lit(0)) > 0) & (now < before * (1 - shrink)), "shrunk").otherwise("publish")


def version_failures(old: DataFrame, new: DataFrame, key: str, frozen: list[str], members: str, added: DataFrame, minted: DataFrame) -> DataFrame:
    """(guard, item): why a new version of keyed records may not be published over the old one.

    Both versions hold key, frozen columns, n (the stated number of members) and an array of members; added(member) are the
    members that this run brought, minted(key) the records that it made. Records stay, and only minted ones come; frozen
    columns don't change; members are only appended, and only members of this run; n is the number of members.
    """
    o = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in frozen], F.col(members).alias("_o"), F.lit(True).alias("_was"))
    both = new.withColumn("_is", F.lit(True)).join(o, key, "full")
    held, was = F.coalesce(members, F.array()), F.coalesce("_o", F.array())
    changed = F.lit(False)
    for c in frozen:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    kept = F.col("_was") & F.col("_is")
    flags = {
        "missing": F.col("_is").isNull(),
        "changed": kept & changed,
        "lost members": kept & (F.size(F.array_except(was, held)) > 0),
        "miscounted": F.col("_is") & (F.col("n") != F.size(held)),
    }
    cases = F.array_compact(F.array(*[F.when(F.coalesce(f, F.lit(False)), g) for g, f in flags.items()]))
    plain = both.select(F.explode(cases).alias("guard"), F.col(key).cast("string").alias("item"))
    unknown = new.join(old.select(key), key, "left_anti").join(minted.select(key), key, "left_anti").select(F.lit("not minted").alias("guard"), F.col(key).cast("string").alias("item"))
    gained = both.where(kept).select(key, F.explode(F.array_except(held, was)).alias("_m"))
    foreign = gained.join(added.select(F.col(members).alias("_m")), "_m", "left_anti").select(F.lit("foreign members").alias("guard"), F.col(key).cast("string").alias("item")).distinct()
    fewer = new.agg(F.count("*").alias("a")).join(old.agg(F.count("*").alias("b"))).where("a < b").select(F.lit("shrink").alias("guard"), F.lit("records").alias("item"))
    return plain.unionByName(unknown).unionByName(foreign).unionByName(fewer)
