"""Declarative constraints as data-quality jobs (d01..d08).

The modelled schema enforces NOT NULL, PRIMARY KEY / UNIQUE, FOREIGN KEY,
CHECK (IN-lists, ranges, a format) and DEFAULT at write time, one row at a
time.  Here they become set-based jobs that report violations as rows
``(table_name, rule, row_key, value)``.  A CHECK passes on NULL, so only a
condition that is false is a violation.

Where the catalog has ``<table>_dirty`` (the same rows with planted breaches),
the constraint jobs read it in place of ``<table>``; the parents that foreign
keys point to are the registered rows.

Keys are checked by reduction.  d02 shuffles eight bytes a key (the number
itself, or a 64-bit fingerprint of a text), summed in the tasks first; only
texts whose fingerprint occurs twice are then counted as texts.  d03 shuffles
distinct references, so a parent named by a third of all rows is one row a
task; only references without a parent go back to the child rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import checkpoint_table
from schemelens.registry import register

# The declared constraints of the modelled schema, restricted to
# the columns of this data model.
PRIMARY_KEYS = {
    "department": "department_id", "scheme": "scheme_id", "pool": "scheme_id", "officer": "officer_id",
    "citizen": "citizen_id", "citizen_document": "doc_id", "application": "application_id",
    "disbursement": "disbursement_id", "rules": "scheme_id",
}
NOT_NULL = {
    "department": ["department_id", "department_name"],
    "scheme": ["scheme_id", "scheme_name", "scheme_code", "department_id"],
    "rules": ["scheme_id"],
    "pool": ["scheme_id", "financial_year", "total_budget"],
    "officer": ["officer_id", "officer_name", "department_id"],
    "citizen": ["citizen_id", "aadhaar_number", "full_name", "gender", "category", "annual_income",
                "location_type", "state", "bank_account"],
    "citizen_document": ["doc_id", "citizen_id", "doc_type"],
    "application": ["application_id", "citizen_id", "scheme_id", "apply_date"],
    "disbursement": ["disbursement_id", "application_id", "amount"],
}
UNIQUE = {  # primary keys first, then UNIQUE columns (NULLs exempt)
    "department": ["department_id", "department_name"],
    "scheme": ["scheme_id", "scheme_name", "scheme_code"],
    "pool": ["scheme_id"],
    "officer": ["officer_id"],
    "citizen": ["citizen_id", "aadhaar_number", "bank_account"],
    "citizen_document": ["doc_id"],
    "application": ["application_id"],
    "disbursement": ["disbursement_id", "application_id", "transaction_ref"],
}
FOREIGN_KEYS = [  # (child table, column, parent table, parent column)
    ("scheme", "department_id", "department", "department_id"),
    ("rules", "scheme_id", "scheme", "scheme_id"),
    ("pool", "scheme_id", "scheme", "scheme_id"),
    ("officer", "department_id", "department", "department_id"),
    ("citizen_document", "citizen_id", "citizen", "citizen_id"),
    ("application", "citizen_id", "citizen", "citizen_id"),
    ("application", "scheme_id", "scheme", "scheme_id"),
    ("application", "officer_id", "officer", "officer_id"),
    ("disbursement", "application_id", "application", "application_id"),
]
DOMAINS = {
    "scheme": {"scheme_type": ["MAJOR", "MINOR"], "is_active": ["Y", "N"]},
    "rules": {"location_type": ["RURAL", "URBAN", "ALL"], "gender_restriction": ["M", "F", "ALL"]},
    "citizen": {"gender": ["M", "F"], "category": ["SC", "ST", "OBC", "GEN"], "location_type": ["RURAL", "URBAN"],
                "is_verified": ["Y", "N"]},
    "citizen_document": {"doc_type": ["AADHAAR", "INCOME_CERT", "CASTE_CERT", "LAND_RECORD", "BANK_PASSBOOK",
                                      "RATION_CARD"],
                         "status": ["PENDING", "VERIFIED", "REJECTED"]},
    "application": {"status": ["SUBMITTED", "UNDER_REVIEW", "APPROVED", "REJECTED", "DISBURSED"]},
    "disbursement": {"payment_mode": ["DBT", "NEFT", "RTGS"], "status": ["PROCESSED", "FAILED"]},
}
RANGES = {  # rule name -> (table, SQL condition that must not be false, value column)
    "base_benefit_amount > 0": ("scheme", "base_benefit_amount > 0", "base_benefit_amount"),
    "max_benefit_amount > 0": ("scheme", "max_benefit_amount > 0", "max_benefit_amount"),
    "max_benefit_amount >= base_benefit_amount": ("scheme", "max_benefit_amount >= base_benefit_amount",
                                                  "max_benefit_amount"),
    "total_budget > 0": ("pool", "total_budget > 0", "total_budget"),
    "disbursed_amount >= 0": ("pool", "disbursed_amount >= 0", "disbursed_amount"),
    "age between 0 and 120": ("citizen", "age between 0 and 120", "age"),
    "annual_income >= 0": ("citizen", "annual_income >= 0", "annual_income"),
    "amount > 0": ("disbursement", "amount > 0", "amount"),
}
FORMATS = {"citizen": {"aadhaar_number": ("^[0-9]{12}$", 12)}}
DEFAULTS = {
    "rules": {"min_age": "18", "max_age": "120", "min_income": "0", "allowed_categories": "'ALL'",
              "location_type": "'ALL'", "gender_restriction": "'ALL'", "min_land_acres": "0"},
    "citizen": {"land_holding_acres": "0", "is_verified": "'N'"},
    "application": {"status": "'SUBMITTED'", "priority_score": "0"},
    "disbursement": {"payment_mode": "'DBT'", "status": "'PROCESSED'"},
    "pool": {"disbursed_amount": "0"},
    "scheme": {"is_active": "'Y'"},
}

VIOLATION_COLS = ["table_name", "rule", "row_key", "value"]


def _dirty(table: str) -> str:
    from schemelens.sources.schemas import SCHEMAS
    return f"{table}_dirty" if f"{table}_dirty" in SCHEMAS else table


def _tables(cat) -> dict[str, DataFrame]:
    return {n: cat[f"{n}_dirty"] if f"{n}_dirty" in cat else cat[n] for n in PRIMARY_KEYS}


def _explode(table: str, df: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """One pass over ``df``: an array of (rule, value) for the failed checks, exploded."""
    key = PRIMARY_KEYS[table]
    arr = F.array(*[F.when(bad, F.struct(F.lit(rule).alias("rule"), val.cast("string").alias("value")))
                    for rule, bad, val in checks])
    hits = F.filter(arr, lambda x: x.isNotNull())
    return (df.select(F.col(key).cast("string").alias("row_key"), F.explode(hits).alias("h"))
            .select(F.lit(table).alias("table_name"), "h.rule", "row_key", "h.value"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _declared(table: str, df: DataFrame, cols) -> list[str]:
    """``cols``; a constraint on a column that the table lacks is an error, never a check left out."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{table} lacks columns that its constraints name: {', '.join(missing)}")
    return list(cols)


@register("d01_not_null", oracle=None)
def d01_not_null(cat) -> DataFrame:
    """NOT NULL violations of every table."""
    frames = []
    for t, df in _tables(cat).items():
        cols = _declared(t, df, NOT_NULL.get(t, []))
        frames.append(_explode(t, df, [(f"NOT NULL {c}", F.col(c).isNull(), F.lit(None)) for c in cols]))
    return _union(frames)


def _d01_sql() -> str:
    from schemelens.sources.schemas import SCHEMAS
    parts = []
    for t, cols in NOT_NULL.items():
        tab = _dirty(t)
        have = [f.split(" ")[0] for f in SCHEMAS[tab].split(", ")]
        for c in cols:
            if c in have:
                parts.append(f"select '{t}' as table_name, 'NOT NULL {c}' as rule, cast({PRIMARY_KEYS[t]} as varchar) "
                             f"as row_key, cast(null as varchar) as value from {tab} where {c} is null")
    return "\nunion all\n".join(parts)


def _key_rule(table: str, col: str) -> str:
    return ("PRIMARY KEY " if col == PRIMARY_KEYS[table] else "UNIQUE ") + col


def _few(cat, df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is counted as small; otherwise joined by shuffle."""
    return F.broadcast(df) if df.count() <= cat.broadcast_max_rows else df


def repeated_keys(cat, tables: dict[str, DataFrame]) -> DataFrame:
    """Values of primary keys and UNIQUE columns that occur on several rows, and how many (NULLs exempt).

    Fingerprints decide only which texts are counted, so texts that share one
    by chance are told apart by the exact count.
    """
    keys = [(t, c) for t in tables for c in _declared(t, tables[t], UNIQUE.get(t, []))]
    text = {(t, c) for t, c in keys if tables[t].schema[c].dataType.simpleString() == "string"}
    rules = F.create_map(*[x for i, (t, c) in enumerate(keys)
                           for x in (F.lit(i), F.struct(F.lit(t).alias("t"), F.lit(_key_rule(t, c)).alias("r")))])

    def rows(t: str, cols: list[str]) -> DataFrame:
        arr = F.array(*[F.struct(F.lit(keys.index((t, c))).alias("k"),
                                 F.when(F.col(c).isNotNull(), F.xxhash64(c) if (t, c) in text else F.col(c).cast("bigint")).alias("h"),
                                 (F.col(c) if (t, c) in text else F.lit(None)).cast("string").alias("v")) for c in cols])
        return tables[t].select(F.explode(arr).alias("x")).select("x.k", "x.h", "x.v").filter(F.col("h").isNotNull())

    every = _union([rows(t, UNIQUE[t]) for t in tables if UNIQUE.get(t)]).select("k", "h")
    again = checkpoint_table(every.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    numbers = (again.filter(~F.col("k").isin([i for i, kc in enumerate(keys) if kc in text]))
               .select("k", F.col("h").cast("string").alias("v"), "n"))
    texts = _union([rows(t, cols) for t in tables if (cols := [c for c in UNIQUE.get(t, []) if (t, c) in text])])
    texts = (texts.join(_few(cat, again.select("k", "h")), ["k", "h"], "left_semi")
             .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return (numbers.unionByName(texts).withColumn("rule", rules[F.col("k")])
            .select(F.col("rule.t").alias("table_name"), F.col("rule.r").alias("rule"), F.col("v").alias("row_key"),
                    F.col("n").cast("string").alias("value")))


@register("d02_unique_keys", oracle=None)
def d02_unique_keys(cat) -> DataFrame:
    """Duplicate values of primary keys and UNIQUE columns (NULLs exempt)."""
    return repeated_keys(cat, _tables(cat))


def _d02_sql() -> str:
    from schemelens.sources.schemas import SCHEMAS
    parts = []
    for t, cols in UNIQUE.items():
        tab = _dirty(t)
        have = [f.split(" ")[0] for f in SCHEMAS[tab].split(", ")]
        for c in cols:
            if c not in have:
                continue
            rule = ("PRIMARY KEY " if c == PRIMARY_KEYS[t] else "UNIQUE ") + c
            parts.append(f"select '{t}' as table_name, '{rule}' as rule, cast({c} as varchar) as row_key, "
                         f"cast(count(*) as varchar) as value from {tab} where {c} is not null group by {c} having count(*) > 1")
    return "\nunion all\n".join(parts)


def dangling_references(cat, tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose non-NULL reference names no row of the parent table.

    Distinct references of all children of one parent are anti-joined once with
    the parent's keys; child rows are read again only to meet the references
    found to dangle (broadcast if counted as few, else by a join that AQE splits).
    """
    lost = []
    for parent in dict.fromkeys(p for _, _, p, _ in FOREIGN_KEYS):
        refs = [(i, c, col) for i, (c, col, p, _) in enumerate(FOREIGN_KEYS) if p == parent]
        pcol = next(pc for _, _, p, pc in FOREIGN_KEYS if p == parent)
        named = _union([tables[c].select(F.lit(i).alias("fk"), F.col(col).cast("bigint").alias("ref")) for i, c, col in refs])
        parents = cat[parent].select(F.col(pcol).cast("bigint").alias("ref"))
        if parent in ("department", "scheme", "officer"):
            parents = cat.small(parents, f"fk_{parent}")
        lost.append(named.filter("ref is not null").distinct().join(parents, "ref", "left_anti").select("fk", "ref"))
    lost = _few(cat, checkpoint_table(_union(lost)))
    frames = []
    for child in dict.fromkeys(c for c, _, _, _ in FOREIGN_KEYS):
        own = [(i, col, p) for i, (c, col, p, _) in enumerate(FOREIGN_KEYS) if c == child]
        arr = F.array(*[F.struct(F.lit(i).alias("fk"), F.col(col).cast("bigint").alias("ref"),
                                 F.lit(f"FOREIGN KEY {col} -> {p}").alias("rule")) for i, col, p in own])
        rows = (tables[child].select(F.col(PRIMARY_KEYS[child]).alias("id"), F.explode(arr).alias("x"))
                .select("id", "x.fk", "x.ref", "x.rule").filter("ref is not null"))
        frames.append(rows.join(lost, ["fk", "ref"], "left_semi").select(
            F.lit(child).alias("table_name"), "rule", F.col("id").cast("string").alias("row_key"),
            F.col("ref").cast("string").alias("value")))
    return _union(frames)


@register("d03_foreign_keys", oracle=None)
def d03_foreign_keys(cat) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    return dangling_references(cat, _tables(cat))


def _d03_sql() -> str:
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        parts.append(f"select '{child}' as table_name, 'FOREIGN KEY {col} -> {parent}' as rule, "
                     f"cast(x.{PRIMARY_KEYS[child]} as varchar) as row_key, cast(x.{col} as varchar) as value from {_dirty(child)} x "
                     f"where x.{col} is not null and not exists (select 1 from {parent} p where p.{pcol} = x.{col})")
    return "\nunion all\n".join(parts)


def _check_list(t: str, df: DataFrame) -> list[tuple[str, Column, Column]]:
    checks = []
    own = {rule: (cond, vcol) for rule, (tt, cond, vcol) in RANGES.items() if tt == t}
    _declared(t, df, [*DOMAINS.get(t, {}), *(v for _, v in own.values()), *FORMATS.get(t, {})])
    for c, values in DOMAINS.get(t, {}).items():
        checks.append((f"CHECK {c} IN ({','.join(values)})", ~F.col(c).isin(*values), F.col(c)))
    for rule, (cond, vcol) in own.items():
        checks.append((f"CHECK {rule}", ~F.expr(cond), F.col(vcol)))
    for c, (pattern, length) in FORMATS.get(t, {}).items():
        checks.append((f"CHECK {c} FORMAT", ~(F.col(c).rlike(pattern) & (F.length(c) == length)), F.col(c)))
    return checks


@register("d04_domain_checks", oracle=None)
def d04_domain_checks(cat) -> DataFrame:
    """IN-list CHECK violations (NULL passes)."""
    frames = []
    for t, df in _tables(cat).items():
        checks = [c for c in _check_list(t, df) if " IN (" in c[0]]
        if checks:
            frames.append(_explode(t, df, checks))
    return _union(frames)


@register("d05_range_checks", oracle=None)
def d05_range_checks(cat) -> DataFrame:
    """Range and cross-column CHECK violations (NULL passes)."""
    frames = []
    for t, df in _tables(cat).items():
        checks = [c for c in _check_list(t, df) if " IN (" not in c[0] and not c[0].endswith("FORMAT")]
        if checks:
            frames.append(_explode(t, df, checks))
    return _union(frames)


@register("d06_format_check", oracle=None)
def d06_format_check(cat) -> DataFrame:
    """Identity numbers that are not exactly 12 digits."""
    frames = []
    for t, df in _tables(cat).items():
        checks = [c for c in _check_list(t, df) if c[0].endswith("FORMAT")]
        if checks:
            frames.append(_explode(t, df, checks))
    return _union(frames)


def _checks_sql(kind: str) -> str:
    from schemelens.sources.schemas import SCHEMAS
    parts = []
    for t in PRIMARY_KEYS:
        tab = _dirty(t)
        have = [f.split(" ")[0] for f in SCHEMAS[tab].split(", ")]
        key = f"cast({PRIMARY_KEYS[t]} as varchar)"
        if kind == "domain":
            for c, values in DOMAINS.get(t, {}).items():
                if c in have:
                    lst = ", ".join(f"'{v}'" for v in values)
                    parts.append(f"select '{t}' as table_name, 'CHECK {c} IN ({','.join(values)})' as rule, {key} as row_key, "
                                 f"cast({c} as varchar) as value from {tab} where {c} not in ({lst})")
        elif kind == "range":
            for rule, (tt, cond, vcol) in RANGES.items():
                if tt == t and vcol in have:
                    parts.append(f"select '{t}' as table_name, 'CHECK {rule}' as rule, {key} as row_key, "
                                 f"cast({vcol} as varchar) as value from {tab} where not ({cond})")
        else:
            for c, (pattern, length) in FORMATS.get(t, {}).items():
                if c in have:
                    parts.append(f"select '{t}' as table_name, 'CHECK {c} FORMAT' as rule, {key} as row_key, "
                                 f"cast({c} as varchar) as value from {tab} "
                                 f"where not (regexp_full_match({c}, '[0-9]{{{length}}}') and length({c}) = {length})")
    return "\nunion all\n".join(parts)


@register("d07_defaults", oracle=None)
def d07_defaults(cat) -> DataFrame:
    """Intake normalisation of the rules table: '' -> NULL, then column defaults."""
    return apply_defaults(cat["rules"], "rules")


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Oracle intake semantics: empty strings are NULL; declared defaults fill NULLs."""
    defaults = DEFAULTS.get(table, {})
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            c = F.nullif(c, F.lit(""))
        if f.name in defaults:
            c = F.coalesce(c, F.expr(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _d07_sql() -> str:
    from schemelens.sources.schemas import SCHEMAS
    cols = []
    for field in SCHEMAS["rules"].split(", "):
        n, t = field.split(" ", 1)
        c = f"nullif({n}, '')" if t == "string" else n
        if n in DEFAULTS["rules"]:
            c = f"coalesce({c}, cast({DEFAULTS['rules'][n]} as {t.replace('string', 'varchar')}))"
        if t.startswith("decimal"):
            c = f"cast({c} as double)"
        cols.append(f"{c} as {n}")
    return "select " + ", ".join(cols) + " from rules"


@register("d08_pool_ledger_reconciliation", oracle="""
select coalesce(p.scheme_id, l.scheme_id) as scheme_id, cast(p.disbursed_amount as double) as stored_disbursed,
 cast(coalesce(l.paid, 0) as double) as ledger_disbursed,
 cast(coalesce(p.disbursed_amount, 0) - coalesce(l.paid, 0) as double) as difference
from pool p full outer join (select a.scheme_id, sum(fd.amount) as paid from disbursement fd
 join application a on fd.application_id = a.application_id group by a.scheme_id) l on p.scheme_id = l.scheme_id
where coalesce(p.disbursed_amount, 0) <> coalesce(l.paid, 0)""")
def d08_pool_ledger_reconciliation(cat) -> DataFrame:
    """Schemes whose stored pool total differs from the sum of their payments."""
    a = cat["application"].select("application_id", "scheme_id")
    ledger = (cat["disbursement"].select("application_id", "amount").join(a, "application_id")
              .groupBy("scheme_id").agg(F.sum("amount").alias("paid")))
    p = cat["pool"].select("scheme_id", "disbursed_amount")
    j = p.join(ledger, "scheme_id", "full_outer")
    stored, paid = F.coalesce("disbursed_amount", F.lit(0)), F.coalesce("paid", F.lit(0))
    return j.filter(stored != paid).select(
        "scheme_id", F.col("disbursed_amount").alias("stored_disbursed"), paid.alias("ledger_disbursed"),
        (stored - paid).alias("difference"))


# the oracle texts depend on the spec above
from schemelens.registry import JOBS  # noqa: E402

JOBS["d01_not_null"].oracle = _d01_sql()
JOBS["d02_unique_keys"].oracle = _d02_sql()
JOBS["d03_foreign_keys"].oracle = _d03_sql()
JOBS["d04_domain_checks"].oracle = _checks_sql("domain")
JOBS["d05_range_checks"].oracle = _checks_sql("range")
JOBS["d06_format_check"].oracle = _checks_sql("format")
JOBS["d07_defaults"].oracle = _d07_sql()
