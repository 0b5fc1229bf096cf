"""Boundary tests of the rule expressions on small literal rows."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import half_up, oracle_num
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS


def _cat(spark, citizens, schemes, rules):
    frames = {
        "citizen": spark.createDataFrame(citizens, SCHEMAS["citizen"]),
        "scheme": spark.createDataFrame(schemes, SCHEMAS["scheme"]),
        "rules": spark.createDataFrame(rules, SCHEMAS["rules"]),
    }
    return Catalog(spark, frames)


def citizen(cid, age=30, income="40000", category="GEN", loc="RURAL", land="0", gender="M"):
    return (cid, "700000000000", f"C{cid}", gender, age, category, D(income), loc, D(land), "Other", "S", "A", "Y")


def scheme(sid, base="1000", mx="100000", active="Y"):
    return (sid, f"SCHEME_{sid}", f"S-{sid}", 0, "MAJOR", None if base is None else D(base), None if mx is None else D(mx), active)


def rule(sid, min_age=18, max_age=60, max_inc="200000", min_inc="0", cats="ALL", loc="ALL", gen="ALL", land="0"):
    return (sid, min_age, max_age, None if max_inc is None else D(max_inc), D(min_inc), cats, loc, gen, D(land))


def evaluate(spark, citizens, schemes, rules, pairs):
    cat = _cat(spark, citizens, schemes, rules)
    p = spark.createDataFrame(pairs, "citizen_id bigint, scheme_id bigint")
    x = R.rule_inputs(p, cat)
    rows = x.select("citizen_id", "scheme_id", R.eligibility_reason().alias("e"), R.benefit_amount().alias("b"),
                    R.priority_score().alias("p")).collect()
    return {(r.citizen_id, r.scheme_id): (r.e, r.b, r.p) for r in rows}


def test_eligibility_order_and_texts(spark):
    cs = [citizen(1, age=17), citizen(2, income="250000.50"), citizen(3, category="OBC"), citizen(4, loc="URBAN"),
          citizen(5, gender="F"), citizen(6, land="0.09"), citizen(7, land="0.10"), citizen(8, age=None)]
    out = evaluate(spark, cs, [scheme(1), scheme(2, active="N"), scheme(3), scheme(4), scheme(5, active=None)],
                   [rule(1, max_inc="200000", land="0.1"), rule(3, cats="SC,ST", loc="RURAL", gen="M"), rule(3),
                    rule(5, land="0.1")],
                   [(1, 1), (2, 1), (6, 1), (7, 1), (8, 1), (1, 2), (1, 3), (99, 1), (1, 4), (1, 77),
                    (3, 5), (7, 5)])
    assert out[(1, 1)][0] == "INELIGIBLE: Age 17 out of range [18-60]"
    assert out[(2, 1)][0] == "INELIGIBLE: Income Rs.250000.5 exceeds limit of Rs.200000"
    assert out[(6, 1)][0] == "INELIGIBLE: Land holding .09 acres is below minimum .1 acres"
    assert out[(7, 1)][0] == "ELIGIBLE"
    assert out[(8, 1)][0] == "INELIGIBLE: Land holding 0 acres is below minimum .1 acres"  # NULL age skips the age rule
    assert out[(1, 2)][0] == R.INACTIVE
    assert out[(1, 3)][0] == R.TOO_MANY_ROWS  # two rules rows for one scheme
    assert out[(99, 1)][0] == R.NOT_FOUND
    assert out[(1, 4)][0] == R.NOT_FOUND  # scheme without rules
    assert out[(1, 77)][0] == R.NOT_FOUND
    assert out[(3, 5)][0] == "INELIGIBLE: Land holding 0 acres is below minimum .1 acres"  # NULL is_active passes
    assert out[(99, 1)][1] == D("0.00") and out[(99, 1)][2] == 0


def test_category_location_gender(spark):
    cs = [citizen(1, category="OBC"), citizen(2, category="SC", loc="URBAN"), citizen(3, category="ST", gender="F")]
    out = evaluate(spark, cs, [scheme(1)], [rule(1, cats="SC,ST", loc="RURAL", gen="M")], [(1, 1), (2, 1), (3, 1)])
    assert out[(1, 1)][0] == "INELIGIBLE: Category OBC not eligible. Allowed: SC,ST"
    assert out[(2, 1)][0] == "INELIGIBLE: Scheme is for RURAL residents only"
    assert out[(3, 1)][0] == "INELIGIBLE: Scheme is restricted to male applicants only"


@pytest.mark.parametrize("income,age,category,loc,expected", [
    ("50000", 30, "GEN", "URBAN", "1000.00"),
    ("50000.01", 30, "GEN", "URBAN", "880.00"),
    ("150000", 30, "OBC", "URBAN", "968.00"),
    ("300000", 60, "SC", "RURAL", "1088.64"),   # 1000*.75*1.2*1.08*1.12 = 1088.64
    ("500000.01", 59, "ST", "RURAL", "518.40"),
    ("85000", 45, "OBC", "RURAL", "1045.44"),   # 1000*.88*1.1*1.08
])
def test_benefit_bands(spark, income, age, category, loc, expected):
    out = evaluate(spark, [citizen(1, age=age, income=income, category=category, loc=loc)], [scheme(1)], [rule(1)],
                   [(1, 1)])
    assert out[(1, 1)][1] == D(expected)


def test_benefit_cap_and_null_cap(spark):
    out = evaluate(spark, [citizen(1)], [scheme(1, base="300000", mx="250000"), scheme(2, mx=None), scheme(3, base=None)],
                   [rule(1), rule(2), rule(3)], [(1, 1), (1, 2), (1, 3)])
    assert out[(1, 1)][1] == D("250000.00")
    assert out[(1, 2)][1] is None  # LEAST with a NULL cap is NULL
    assert out[(1, 3)][1] is None  # and so it is with a NULL base


def test_priority_demo_citizen(spark):
    # female, 45, OBC, 85000, rural: 44 + 14 + 15
    out = evaluate(spark, [citizen(1, age=45, income="85000", category="OBC", gender="F")], [scheme(1)], [rule(1)],
                   [(1, 1)])
    assert out[(1, 1)][2] == 73
    out = evaluate(spark, [citizen(1, age=60, income="500001", category="GEN", loc="URBAN")], [scheme(1)],
                   [rule(1)], [(1, 1)])
    assert out[(1, 1)][2] == 5 + 5 + 5 + 10


def test_oracle_num_and_half_up(spark):
    df = spark.createDataFrame([(D("250000.00"), 1, 2), (D("85000.50"), 5, 2), (D("0.10"), 15, 10), (D("0.00"), 25, 10),
                                (D("-0.50"), 35, 10)], "x decimal(12,2), n bigint, d bigint")
    got = [(r.s, r.h) for r in df.select(oracle_num("x").alias("s"), half_up(F.col("n"), F.col("d"), 0).alias("h"))
           .collect()]
    assert [g[0] for g in got] == ["250000", "85000.5", ".1", "0", "-.5"]
    assert [g[1] for g in got] == [1.0, 3.0, 2.0, 3.0, 4.0]  # 0.5 -> 1, 2.5 -> 3, 1.5 -> 2, 2.5 -> 3, 3.5 -> 4


def test_time_id_key_orders_like_the_pair(spark):
    import datetime as dt
    from schemelens.functions.semantics import time_id_key
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 5), -(2 ** 63)), (dt.datetime(2024, 1, 1, 0, 0, 0, 5), 2 ** 63 - 1),
            (dt.datetime(2024, 1, 1, 0, 0, 0, 4), 7), (dt.datetime(1960, 5, 1), 3), (dt.datetime(2024, 1, 1), 0)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, id long")
    got = [(r.t, r.id) for r in df.orderBy(time_id_key("t", "id")).collect()]
    assert got == sorted(rows)
