"""The table-load job: every benefit-scheme table derived from the driver data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.registry import register
from schemelens.sources import fixtures

LOADED = [n for n in fixtures.ORDER if n not in ("application0", "application_base")]


@register("load_tables", oracle="\nunion all\n".join(
    f"select '{n}' as table_name, count(*) as row_count from {n}" for n in LOADED))
def load_tables(cat) -> DataFrame:
    """Row count of every derived table (reads and derives all of them)."""
    return reduce(lambda a, b: a.unionByName(b),
                  [cat[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                   for n in LOADED])
