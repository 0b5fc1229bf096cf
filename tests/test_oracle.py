"""Every registered job vs its DuckDB oracle at sf0.01 (the driver's check)."""

import pytest

from harness import compare
from schemelens.registry import load_all, oracle_text, to_output

JOBS = load_all()
WITH_ORACLE = sorted(n for n, j in JOBS.items() if j.oracle is not None)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_job_matches_oracle(name, cat01, duck01):
    job = JOBS[name]
    ok, msg = compare(to_output(job.fn(cat01)), duck01, oracle_text(job))
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
