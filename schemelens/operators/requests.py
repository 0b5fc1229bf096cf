"""Insert requests as JSON: omitted columns take their defaults, explicit nulls stay NULL (d07b).

A typed row cannot say whether a column was left out or given as NULL; a
``VARIANT`` can.  An omitted key takes the column's declared default, a key with
``null`` or with the empty string (which the modelled database stores as NULL)
stays NULL, and any other value is kept.  A body that is no JSON object, or
names a key twice, gives no values (origin ``malformed``).  Everything is
built-in functions on one scan; an unknown table name or a NULL one gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import AS_OF
from schemelens.operators.quality import DEFAULTS
from schemelens.operators.triggers import CHANGED_BY
from schemelens.registry import register
from schemelens.sources.schemas import SCHEMAS

NOW = AS_OF.strftime("%Y-%m-%d %H:%M:%S")

# The declared defaults whose columns this data model has not, and the clock's.
FURTHER_DEFAULTS = {
    "scheme": {"applicable_states": "'ALL'"},
    "pool": {"last_updated": f"'{NOW}'"},
    "officer": {"is_active": "'Y'"},
    "citizen": {"registration_date": f"'{NOW}'"},
    "citizen_document": {"upload_date": f"'{NOW}'", "status": "'PENDING'"},
    "application": {"apply_date": f"'{NOW}'"},
    "disbursement": {"disbursement_date": f"'{NOW}'"},
    "audit_log": {"changed_by": f"'{CHANGED_BY}'", "change_date": f"'{NOW}'"},
}
ALL_DEFAULTS = {t: DEFAULTS.get(t, {}) | FURTHER_DEFAULTS.get(t, {}) for t in [*DEFAULTS, *FURTHER_DEFAULTS]}


def _parsed(body: str) -> Column:
    """The body as a variant, NULL unless it is a JSON object."""
    v = F.try_parse_json(body)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def _given(v: Column, col: str) -> tuple[Column, Column, Column]:
    """(omitted, explicitly null or empty, text) of one key."""
    one = F.variant_get(v, f"$.{col}", "variant")
    text = F.nullif(F.try_variant_get(v, f"$.{col}", "string"), F.lit(""))
    return one.isNull(), F.is_variant_null(one) | text.isNull(), text


def default_columns(requests: DataFrame) -> DataFrame:
    """(request_id, table_name, column_name, value, origin) for every column with a default of the requested table.

    ``requests``: request_id, table_name, body (JSON text).  ``origin`` says why
    the value is as it is: default, null, given or malformed.
    """
    v, arms = F.col("_v"), F.lit(None)
    for i, (t, cols) in enumerate(ALL_DEFAULTS.items()):
        items = []
        for c, expr in cols.items():
            omitted, null, text = _given(v, c)
            origin = (F.when(v.isNull(), "malformed").when(omitted, "default").when(null, "null").otherwise("given"))
            value = F.when(v.isNotNull(), F.when(omitted, F.expr(expr).cast("string")).otherwise(text))
            items.append(F.struct(F.lit(c).alias("column_name"), value.alias("value"), origin.alias("origin")))
        arr = F.array(*items)
        arms = F.when(F.col("table_name") == t, arr) if i == 0 else arms.when(F.col("table_name") == t, arr)
    return (requests.select("request_id", "table_name", _parsed("body").alias("_v"))
            .select("request_id", "table_name", F.explode(arms).alias("x")).select("request_id", "table_name", "x.*"))


def intake_rows(requests: DataFrame, table: str) -> DataFrame:
    """Typed rows of ``table`` from its requests, ready for ``Catalog.append``.

    A value that does not fit its column's type, and a column without default that is omitted, are NULL; rows of
    malformed bodies are left out (``default_columns`` names them).
    """
    defaults, cols = ALL_DEFAULTS.get(table, {}), []
    for field in SCHEMAS[table].split(", "):
        name, ctype = field.split(" ", 1)
        omitted, _, text = _given(F.col("_v"), name)
        kept = text.try_cast(ctype)
        cols.append((F.when(omitted, F.expr(defaults[name]).cast(ctype)).otherwise(kept) if name in defaults else kept)
                    .alias(name))
    return (requests.filter(F.col("table_name") == table).select(_parsed("body").alias("_v"))
            .filter(F.col("_v").isNotNull()).select(*cols))


def request_columns() -> list[str]:
    """Columns of requests derived from the events, the same text for both engines: each table in turn; its columns are in turn
    omitted, null, given and empty; every 97th body is cut short."""
    tables = "case event_id % {} {} end".format(
        len(ALL_DEFAULTS), " ".join(f"when {i} then '{t}'" for i, t in enumerate(ALL_DEFAULTS)))
    arms = []
    for i, (t, cols) in enumerate(ALL_DEFAULTS.items()):
        parts = []
        for j, c in enumerate(cols):
            shown = "cast(event_id % 90 as string)" if not ALL_DEFAULTS[t][c].startswith("'") else \
                "concat('\"V', cast(event_id % 90 as string), '\"')"
            parts.append(f"case floor(event_id / {len(ALL_DEFAULTS)} + {j}) % 4 when 0 then '' when 1 then ', \"{c}\": null' "
                         f"when 2 then concat(', \"{c}\": ', {shown}) else ', \"{c}\": \"\"' end")
        arms.append(f"when {i} then concat({', '.join(parts)}, '')")
    return ["event_id as request_id", f"{tables} as table_name", f"concat('{{\"row\": ', cast(event_id as string), "
            f"case event_id % {len(ALL_DEFAULTS)} {' '.join(arms)} end, case when event_id % 97 = 96 then '' else '}}' end) as body"]


def _oracle() -> str:
    parts = []
    for t, cols in ALL_DEFAULTS.items():
        for c, expr in cols.items():
            parts.append(f"select request_id, table_name, '{c}' as column_name, case when not json_valid(body) then null "
                         f"when not json_exists(body, '$.{c}') then cast({expr} as varchar) else nullif(json_extract_string(body, '$.{c}'), '') end as value, "
                         f"case when not json_valid(body) then 'malformed' when not json_exists(body, '$.{c}') then 'default' "
                         f"when nullif(json_extract_string(body, '$.{c}'), '') is null then 'null' else 'given' end as origin "
                         f"from insert_request where table_name = '{t}'")
    return f"with insert_request as materialized (select {', '.join(request_columns())} from events)\n" + "\nunion all\n".join(parts)


@register("d07b_insert_defaults", oracle=_oracle())
def d07b_insert_defaults(cat) -> DataFrame:
    """Values of the columns with defaults in JSON insert requests: omitted, null, empty or given."""
    return default_columns(cat["status_event"].selectExpr(*request_columns()))
