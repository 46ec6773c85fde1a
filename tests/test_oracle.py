"""Every registered query against its SQL twin, and the shape of its plan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from checks import compare, registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    note = compare.difference(df.toArrow(), compare.fetch_oracle(duck, ORACLES[name]))
    assert note is None, note
    plan = plan_of(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{bad} in the plan of {name}"


def test_entry(spark):
    assert len(entry.entry(spark).take(1)) == 1
