
from decimal import Decimal as D

from schemelens.plans.reports import q29_department_budget, r02_report_totals, scheme_report
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS
from test_rules import citizen, evaluate, rule, scheme

# Demo department budgets (rupees), one scheme and pool each.
BUDGETS = [D("78500000000"), D("54000000000"), D("76000000000"), D("105000000000"), D("2000000000"),
           D("5300000000"), D("7500000000")]


def test_demo_citizen_benefit_and_priority(spark):
    # female, 45, OBC, income 85000, 1.5 acres, rural; scheme base 300000 capped at 500000
    out = evaluate(spark, [citizen(1, age=45, income="85000", category="OBC", loc="RURAL", land="1.5", gender="F")],
                   [scheme(3, base="300000", mx="500000")], [rule(3, max_age=120, max_inc="500000")], [(1, 3)])
    e, b, p = out[(1, 3)]
    assert e == "ELIGIBLE" and b == D("313632.00") and p == 73


def _budget_catalog(spark, disbursed_first=D("313632")):
    dept = spark.createDataFrame([(i, f"D{i}") for i in range(7)], SCHEMAS["department"])
    sch = spark.createDataFrame([(i, f"S{i}", f"C{i}", i, "MAJOR", D("1"), D("2"), "Y") for i in range(7)],
                                SCHEMAS["scheme"])
    pool = spark.createDataFrame([(i, "2024-25", BUDGETS[i], disbursed_first if i == 2 else D(0)) for i in range(7)],
                                 SCHEMAS["pool"])
    app = spark.createDataFrame([], SCHEMAS["application"])
    return Catalog(spark, {"department": dept, "scheme": sch, "pool": pool, "application": app})


def test_report_totals_in_crore(spark):
    cat = _budget_catalog(spark)
    t = r02_report_totals(cat).first()
    assert t.total_budget_cr == 32830.0 and t.disbursed_cr == 0.0 and t.total_apps == 0
    per = {r.scheme_name: r.disbursed_cr for r in scheme_report(cat).collect()}
    assert per["S2"] == 0.03  # 313632 rupees = .03 crore


def test_department_budget_totals(spark):
    got = {r.department_name: r.total_budget for r in q29_department_budget(_budget_catalog(spark)).collect()}
    assert [got[f"D{i}"] for i in range(7)] == BUDGETS
    assert sum(got.values()) == D("328300000000")
