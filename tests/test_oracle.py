"""Every registered query against its oracle SQL."""
from __future__ import annotations

import pytest

from compare import compare, oracle
from conftest import SF
from ordermill import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
SLOW = {"incremental_replay", "replay_fact_revenue", "run_log", "reset_layers"}


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLES and k not in SLOW])
def test_matches_oracle(spark, con, key):
    assert compare(spark, SF, con, QUERIES[key], ORACLES[key]) is None


def test_plan_audit_strategies(spark):
    got = {r["plan"]: r for r in QUERIES["plan_audit"](spark, SF).collect()}
    hashed, sorted_ = got["size-checked broadcast"], got["forced sort-merge"]
    assert (hashed["broadcast_join"], hashed["sort_merge"], hashed["shuffles"]) == (1, 0, 0)
    assert (sorted_["broadcast_join"], sorted_["sort_merge"], sorted_["shuffles"]) == (0, 1, 2)
    assert hashed["result_rows"] == sorted_["result_rows"] > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
