"""Physical-plan properties: pushdown, broadcast of checked dimensions, no
Python on report paths, no nested-loop joins."""

import pytest

from schemelens.registry import load_all

JOBS = load_all()
REPORTS = sorted(n for n in JOBS if n[0] in "qvrfdbc")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_no_nested_loop(name, cat01):
    p = plan(JOBS[name].fn(cat01))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_filter_pushdown_on_stored_tables(spark, cat01, tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("wh"))
    stored = cat01.materialize(wh, ["citizen", "application", "scheme", "department", "pool"])
    p = plan(JOBS["q02_state_citizens"].fn(stored))
    assert "PushedFilters: [IsNotNull(state), EqualTo(state,NATION_1)]" in p
    p = plan(JOBS["q08_status_counts"].fn(stored))
    assert "ReadSchema: struct<scheme_id:bigint,status:string>" in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
