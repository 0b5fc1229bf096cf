"""Oracle-compatible scalar semantics on Spark columns.

Every helper comes as a pair: a Spark ``Column`` builder used by the jobs, and
a ``*_sql`` text builder producing the same value in DuckDB's dialect, used by
the oracle queries that check the jobs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed clock used instead of SYSDATE / SYSTIMESTAMP so every job is
# deterministic.
AS_OF = _dt.datetime(2001, 8, 15, 12, 0, 0)
AS_OF_TEXT = "2001-08-15 12:00:00"


def as_of_col(as_of: _dt.datetime | str = AS_OF) -> Column:
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.expr(f"timestamp_ntz'{text}'")


def as_of_sql(as_of: _dt.datetime | str = AS_OF) -> str:
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return f"timestamp '{text}'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- number text
def oracle_num(x) -> Column:
    """TO_CHAR(number) as Oracle prints it: no trailing zeros, no leading 0.

    250000.00 -> '250000', 85000.50 -> '85000.5', 0.10 -> '.1', 0 -> '0'.
    Three chained replacements that read the input once, so the expression
    stays small inside the long CASE chains of the rule texts (measured faster
    than trim / CASE variants, which repeat the input).
    """
    s = _c(x).cast("string")
    s = F.regexp_replace(s, "([.][0-9]*?)0+$", "$1")   # trailing zeros after the point
    s = F.regexp_replace(s, "[.]$", "")                  # a bare trailing point
    return F.regexp_replace(s, "^(-?)0[.]", "$1.")       # leading zero before the point


def oracle_num_sql(expr: str) -> str:
    s = f"cast({expr} as varchar)"
    t = (f"(case when strpos({s}, '.') > 0 then regexp_replace(regexp_replace({s}, '0+$', ''), '[.]$', '') "
         f"else {s} end)")
    return (f"(case when {t} like '0.%' then substr({t}, 2) "
            f"when {t} like '-0.%' then '-' || substr({t}, 3) else {t} end)")


def cat(*parts) -> Column:
    """Oracle ``a || b || ...``: NULL operands contribute ''."""
    return F.concat_ws("", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


# --------------------------------------------------------- exact HALF_UP ratio
def half_up(num, den, k: int) -> Column:
    """ROUND(num / den, k), HALF_UP (away from zero), computed exactly.

    ``num`` / ``den`` are integral columns (money in paise, time in seconds,
    counts), ``den`` positive.  Widened to decimal(38,0) so 2*|num|*10^k cannot
    overflow at large scale.  Returns a double; NULL when den is 0 or NULL.
    """
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    scale = 10 ** k
    top = (F.lit(2) * F.abs(n) * F.lit(scale) + d).cast("decimal(38,0)")
    bottom = (F.lit(2) * d).cast("decimal(38,0)")
    mag = int_div(top, bottom).cast("double") / F.lit(float(scale))
    return F.when(d > 0, F.when(n < 0, -mag).otherwise(mag))


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative integral decimals."""
    rem = (a % b).cast("decimal(38,0)")
    return ((a - rem) / b).cast("decimal(38,0)")


def half_up_sql(num: str, den: str, k: int) -> str:
    scale = 10 ** k
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    mag = f"cast((2 * abs({n}) * {scale} + {d}) // (2 * {d}) as double) / {float(scale)}"
    return f"(case when {d} > 0 then (case when {n} < 0 then -({mag}) else {mag} end) end)"


# ------------------------------------------------------------------ time math
def trunc_days(start, end) -> Column:
    """TRUNC(end - start) for DATE values: whole elapsed days."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def trunc_days_sql(start: str, end: str) -> str:
    return f"datesub('day', {start}, {end})"


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def seconds_between_sql(start: str, end: str) -> str:
    return f"(epoch({end}) - epoch({start}))"


def paise(x) -> Column:
    """Money decimal(.,2) -> integral paise (decimal(38,0))."""
    return (_c(x) * F.lit(100)).cast("decimal(38,0)")


def paise_sql(x: str) -> str:
    return f"cast(({x}) * 100 as hugeint)"


def ntz_micros(x) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (time-zone independent,
    monotone: usable as a numeric order key)."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), _c(x))


def checkpoint_table(df):
    """Cut lineage: write ``df`` once as Parquet under the session's shared
    checkpoint folder (``spark.checkpoint.dir``) and read it back, so that later
    branches prune columns and a lost executor recomputes nothing of it."""
    import uuid

    from schemelens.session import checkpoint_dir
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def time_id_key(time_col, id_col) -> Column:
    """One exact decimal(38,0) ordered like (time, id): micros * 10^20 + (id + 2^63).

    ``min`` / ``max`` of a decimal run as hash aggregates with map-side partial
    aggregation, where ``min(struct(time, id))`` would fall back to a sort-based
    aggregate.  The id is shifted to be non-negative and below 10^20, so the
    order of the pair is kept for any bigint id and any timestamp within
    +-3000 years of 1970.
    """
    from decimal import Decimal
    micros = ntz_micros(time_col).cast("decimal(38,0)")
    shifted = (_c(id_col).cast("decimal(20,0)") + F.lit(Decimal(2 ** 63))).cast("decimal(38,0)")
    return (micros * F.lit(Decimal(10 ** 20)) + shifted).cast("decimal(38,0)")


def padded_id(name: str) -> Column:
    """Id as text, zero-padded to eight digits; longer ids stay whole, so they stay distinct."""
    text = F.col(name).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(8)), F.lit("0"))
