"""Every query with SQL gives DuckDB's rows; the others give rows and keep their invariants."""

from collections import defaultdict

import pytest

from quillspark.plans.catalogue import ORACLES, QUERIES
from tests.oracle import both, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, con):
    mine, theirs = both(QUERIES[name], ORACLES[name], spark, con, SF)
    assert mine == theirs


def test_every_other_query_is_known():
    assert set(QUERIES) - set(ORACLES) == {"clique_cover", "reconcile_claims", "diverse_selection", "penalised_selection", "platt_fit", "offset_fit", "joint_fit", "held_out_losses", "bootstrap_ci", "manifest"}


def test_cliques_are_cliques(spark):
    from quillspark.plans.clustering import _merge_edges

    edges = {tuple(r) for r in _merge_edges(spark, SF).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    groups = defaultdict(set)
    for r in QUERIES["clique_cover"](spark, SF).collect():
        groups[r["clique"]].add(r["member"])
    seen = [m for g in groups.values() for m in g]
    assert len(seen) == len(set(seen))
    for g in groups.values():
        assert len(g) > 1 and all(b in near[a] for a in g for b in g if a != b)


def test_claims_are_unique(spark):
    rows = QUERIES["reconcile_claims"](spark, SF).collect()
    taken = [(r["topic"], r["prior"]) for r in rows if r["prior"] is not None]
    assert len(taken) == len(set(taken)) and {r["how"] for r in rows} <= {"overlap", "label", "mint"}
    assert all((r["how"] == "mint") == (r["prior"] is None) for r in rows)


def test_fits(spark):
    r = QUERIES["platt_fit"](spark, SF).first()
    assert r["slope"] == r["slope"] and abs(r["intercept"]) < 50
    b = QUERIES["bootstrap_ci"](spark, SF).first()
    assert 0 <= b["lo"] <= b["mid"] <= b["hi"] <= 1
    assert QUERIES["manifest"](spark, SF).first()["stable"]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
