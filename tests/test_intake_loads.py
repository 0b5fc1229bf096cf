"""JSON insert requests and constraints counted while loading."""

from collections import Counter

from schemelens.operators import quality as Q
from schemelens.operators.loading import load_checked
from schemelens.operators.requests import ALL_DEFAULTS, NOW, d07b_insert_defaults, default_columns, intake_rows
from schemelens.sources.catalog import Catalog

REQ = "request_id long, table_name string, body string"


def test_omitted_null_empty_and_given(spark):
    rows = [(1, "rules", '{"scheme_id": 4}'), (2, "rules", '{"scheme_id": 4, "min_age": null, "location_type": ""}'),
            (3, "rules", '{"min_age": 30, "location_type": "URBAN"}'), (4, "rules", '{"min_age": 1, "min_age": 2}'),
            (5, "rules", "[1]"), (6, "rules", None), (7, "no_table", "{}"), (8, None, "{}"), (9, "rules", ""), (9, "rules", "{}")]
    got = default_columns(spark.createDataFrame(rows, REQ))
    assert got.columns == ["request_id", "table_name", "column_name", "value", "origin"]
    by = {(r.request_id, r.column_name): (r.value, r.origin) for r in got.filter("request_id < 9").collect()}
    assert by[1, "min_age"] == ("18", "default") and by[1, "location_type"] == ("ALL", "default")
    assert by[2, "min_age"] == (None, "null") and by[2, "location_type"] == (None, "null")
    assert by[3, "min_age"] == ("30", "given") and by[3, "location_type"] == ("URBAN", "given")
    for bad in (4, 5, 6):
        assert {by[bad, c] for c in ALL_DEFAULTS["rules"]} == {(None, "malformed")}
    assert {k[0] for k in by} == {1, 2, 3, 4, 5, 6}
    assert got.filter("request_id = 9").count() == 2 * len(ALL_DEFAULTS["rules"])  # repeated ids are rows of their own
    assert default_columns(spark.createDataFrame([], REQ)).count() == 0


def test_typed_rows_of_requests(spark):
    body = ['{"application_id": 5, "citizen_id": 7, "scheme_id": 2, "remarks": ""}',
            '{"application_id": 6, "status": null, "priority_score": "many", "apply_date": "2001-02-03 04:05:06"}', "{"]
    got = intake_rows(spark.createDataFrame([(i, "application", b) for i, b in enumerate(body)], REQ), "application")
    a, b = sorted(got.collect(), key=lambda r: r.application_id)
    assert (a.citizen_id, a.scheme_id, a.status, a.priority_score, str(a.apply_date), a.remarks) == (7, 2, "SUBMITTED", 0, NOW, None)
    assert (b.citizen_id, b.status, b.priority_score, str(b.apply_date)) == (None, None, None, "2001-02-03 04:05:06")


def test_every_default_is_met_in_each_way(cat01):
    seen = Counter((r.table_name, r.column_name, r.origin) for r in d07b_insert_defaults(cat01).collect())
    assert sum(len(c) for c in ALL_DEFAULTS.values()) == 25
    for t, cols in ALL_DEFAULTS.items():
        for c in cols:
            assert all(seen[t, c, o] for o in ("default", "null", "given", "malformed")), (t, c)


def test_metrics_equal_the_violations(spark, cat001, tmp_path):
    tables = Q._tables(cat001)
    got = {(t, rule): n for t, rule, n in load_checked(spark, tables, str(tmp_path / "wh"))}
    rows = Counter()
    for job in (Q.d01_not_null, Q.d04_domain_checks, Q.d05_range_checks, Q.d06_format_check):
        rows.update((r.table_name, r.rule) for r in job(cat001).collect())
    assert {k: n for k, n in got.items() if n} == rows and len({t for t, _ in rows}) >= 6
    again = Catalog.from_warehouse(spark, str(tmp_path / "wh"))
    assert again["application"].count() == tables["application"].count()


def test_checked_load_and_empty_strings(spark, cat001, tmp_path):
    wh = cat001.materialize(str(tmp_path / "wh"), tables=["scheme", "application", "department"], check=True)
    assert wh.failed_rules and not any(wh.failed_rules.values())
    assert ("application", "NOT NULL citizen_id") in wh.failed_rules
    new = intake_rows(spark.createDataFrame([(1, "scheme", '{"scheme_id": 100000, "scheme_name": "N", "scheme_type": ""}')], REQ), "scheme")
    wh.append("scheme", new, "b1")
    wh.append("department", spark.createDataFrame([(99, "")], "department_id int, department_name string"), "b1")
    assert [(r.scheme_type, r.is_active) for r in wh["scheme"].filter("scheme_id = 100000").collect()] == [(None, "Y")]
    assert wh["department"].filter("department_id = 99").first().department_name is None
