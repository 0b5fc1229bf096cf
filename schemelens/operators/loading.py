"""Constraints counted in the pass that writes a table (d09).

NOT NULL and CHECK conditions ride on the written rows as observed metrics
(``DataFrame.observe``), so a load knows how many rows break each rule without
reading anything twice.  The metrics sit above the last shuffle of the write, in
the tasks whose results count once, so a lost executor does not count rows
twice.  Which rows break a rule is said by d01 and d04 to d06, needed only where
a count is not zero.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from schemelens.operators import quality as Q
from schemelens.registry import register
from schemelens.session import checkpoint_dir
from schemelens.sources import sinks

METRICS = "table_name string, rule string, failed_rows long"


def table_rules(table: str, df: DataFrame) -> list[tuple[str, Column]]:
    """(rule, condition of a failing row) of a table's NOT NULL and CHECK constraints; a CHECK passes on NULL."""
    nulls = [(f"NOT NULL {c}", F.col(c).isNull()) for c in Q._declared(table, df, Q.NOT_NULL.get(table, []))]
    return nulls + [(rule, bad) for rule, bad, _ in Q._check_list(table, df)]


class Watched:
    """A table's rows with a counter for each rule; ``failures`` waits for the action that reads ``rows``."""

    def __init__(self, table: str, df: DataFrame):
        self.table = table
        rules = table_rules(table, df) if table in Q.PRIMARY_KEYS else []
        self.rules = [rule for rule, _ in rules]
        self.rows, self._seen = df, None
        if rules:
            self._seen = Observation(f"rules of {table} {uuid.uuid4().hex}")
            self.rows = df.observe(self._seen, *[F.count_if(bad).alias(f"r{i}") for i, (_, bad) in enumerate(rules)])

    def failures(self) -> list[tuple[str, str, int]]:
        if self._seen is None:
            return []
        got = self._seen.get
        return [(self.table, rule, got[f"r{i}"]) for i, rule in enumerate(self.rules)]


def load_checked(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> list[tuple[str, str, int]]:
    """Write tables as stored tables under ``path``; (table, rule, failing rows) of every rule."""
    out = []
    for name, df in tables.items():
        watched = Watched(name, df)
        sinks.load_rows(watched.rows, f"{path.rstrip('/')}/{name}")
        out += watched.failures()
    return out


def _metrics_sql() -> str:
    rules = [(t, f"NOT NULL {c}") for t, cols in Q.NOT_NULL.items() for c in cols]
    rules += [(t, f"CHECK {c} IN ({','.join(v)})") for t, cols in Q.DOMAINS.items() for c, v in cols.items()]
    rules += [(t, f"CHECK {rule}") for rule, (t, _, _) in Q.RANGES.items()]
    rules += [(t, f"CHECK {c} FORMAT") for t, cols in Q.FORMATS.items() for c in cols]
    values = ", ".join(f"('{t}', '{rule}')" for t, rule in rules)
    found = "\nunion all\n".join([Q._d01_sql(), *(Q._checks_sql(kind) for kind in ("domain", "range", "format"))])
    return (f"select r.table_name, r.rule, count(v.rule) as failed_rows from (values {values}) r(table_name, rule) "
            f"left join ({found}) v on v.table_name = r.table_name and v.rule = r.rule group by all")


@register("d09_load_metrics", oracle=_metrics_sql())
def d09_load_metrics(cat) -> DataFrame:
    """Rows that break each NOT NULL and CHECK rule, counted while the tables are written."""
    folder = f"{checkpoint_dir(cat.spark)}/load-{uuid.uuid4().hex}"
    return cat.spark.createDataFrame(load_checked(cat.spark, Q._tables(cat), folder), METRICS)
