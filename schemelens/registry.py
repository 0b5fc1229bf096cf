"""Registry of named jobs: Spark builder + DuckDB oracle text.

Each job is a function ``fn(catalog) -> DataFrame``.  ``oracle`` is the same
computation as DuckDB SQL over the driver's tables (fixture CTEs are prefixed
automatically); ``None`` means the job is not expressible there and is
checked against a sequential model in the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


@dataclass
class Job:
    name: str
    fn: Callable
    oracle: str | None
    doc: str


JOBS: dict[str, Job] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        JOBS[name] = Job(name, fn, oracle, (fn.__doc__ or "").strip().split("\n")[0])
        return fn
    return deco


def to_output(df: DataFrame) -> DataFrame:
    """Result convention shared with the oracle: decimals leave as double."""
    cols = [F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def load_all() -> dict[str, Job]:
    # importing the modules fills JOBS
    import schemelens.plans.views  # noqa: F401
    import schemelens.plans.reports  # noqa: F401
    for mod in ("schemelens.sources.jobs", "schemelens.plans.rule_jobs", "schemelens.plans.population",
                "schemelens.operators.quality", "schemelens.operators.loading", "schemelens.operators.cohorts",
                "schemelens.operators.payments", "schemelens.operators.intake",
                "schemelens.operators.allocation", "schemelens.operators.decisions",
                "schemelens.operators.triggers", "schemelens.operators.requests", "schemelens.streaming.jobs"):
        __import__(mod)
    return JOBS


def oracle_text(job: Job) -> str | None:
    if job.oracle is None:
        return None
    from schemelens.sources.catalog import oracle_ctes
    return oracle_ctes(job.oracle)
