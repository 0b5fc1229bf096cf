"""Population eligibility against a plain loop over all citizens and schemes, on odd rows."""

import random
from collections import Counter
from decimal import Decimal

from schemelens.plans.population import f01d_population_eligibility, f01e_eligible_schemes
from schemelens.registry import JOBS
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS


def frames(spark, citizens, schemes, rules):
    def table(name, rows, cols):
        keep = ", ".join(f for f in SCHEMAS[name].split(", ") if f.split(" ")[0] in cols)
        order = [f.split(" ")[0] for f in keep.split(", ")]
        return spark.createDataFrame([tuple(r[c] for c in order) for r in rows], keep)
    return Catalog(spark, {
        "citizen": table("citizen", citizens, {"citizen_id", "age", "annual_income", "category", "location_type", "gender",
                                               "land_holding_acres"}),
        "scheme": table("scheme", schemes, {"scheme_id", "is_active"}),
        "rules": table("rules", rules, {"scheme_id", "min_age", "max_age", "max_income", "min_income", "allowed_categories",
                                        "location_type", "gender_restriction", "min_land_acres"})})


def first_failing(c, s, own):
    if s["is_active"] == "N":
        return "INACTIVE"
    if not own:
        return "NOT_FOUND"
    if len(own) > 1:
        return "ERROR"
    r = own[0]
    less = lambda a, b: a is not None and b is not None and a < b
    other = lambda have, need: need not in (None, "ALL") and have is not None and have != need
    if less(c["age"], r["min_age"]) or less(r["max_age"], c["age"]):
        return "AGE"
    if less(r["max_income"], c["annual_income"]):
        return "MAX_INCOME"
    if less(c["annual_income"], r["min_income"]):
        return "MIN_INCOME"
    cats = r["allowed_categories"]
    if cats not in (None, "ALL") and c["category"] is not None and c["category"] not in cats.split(","):
        return "CATEGORY"
    if other(c["location_type"], r["location_type"]):
        return "LOCATION"
    if other(c["gender"], r["gender_restriction"]):
        return "GENDER"
    if r["min_land_acres"] is not None and r["min_land_acres"] > 0 and less(c["land_holding_acres"], r["min_land_acres"]):
        return "LAND"
    return "ELIGIBLE"


def odd_rows(rng, n):
    pick, money = rng.choice, lambda x: None if x is None else Decimal(x)
    citizens = [dict(citizen_id=i, age=pick([None, 0, 17, 18, 19, 59, 60, 61, 120]),
                     annual_income=money(pick([None, "0.00", "99999.99", "100000.00", "100000.01", "250000.00"])),
                     category=pick([None, "SC", "ST", "GEN", "", "ALL", "SC,ST"]),
                     location_type=pick([None, "RURAL", "URBAN", "HILLS"]), gender=pick([None, "M", "F", "X"]),
                     land_holding_acres=money(pick([None, "-1.00", "0.00", "0.49", "0.50", "0.51"]))) for i in range(n)]
    schemes = [dict(scheme_id=i * 40_000, is_active=pick(["Y", "Y", "Y", None, "N"])) for i in range(40)]
    rules = []
    for s in schemes:
        for _ in range(pick([0, 1, 1, 1, 1, 1, 2])):
            rules.append(dict(
                scheme_id=s["scheme_id"], min_age=pick([None, 0, 18, 60]), max_age=pick([None, 17, 60, 120]),
                max_income=money(pick([None, "100000.00", "99999.99"])), min_income=money(pick([None, "0.00", "100000.00"])),
                allowed_categories=pick([None, "ALL", "SC", "SC,ST", "GEN,GEN"]), location_type=pick([None, "ALL", "RURAL"]),
                gender_restriction=pick([None, "ALL", "F", "M"]), min_land_acres=money(pick([None, "-2.00", "0.00", "0.50"]))))
    return citizens, schemes, rules


def brute(citizens, schemes, rules):
    reasons, passed = Counter(), Counter({c["citizen_id"]: 0 for c in citizens})
    for s in schemes:
        own = [r for r in rules if r["scheme_id"] == s["scheme_id"]]
        for c in citizens:
            code = first_failing(c, s, own)
            reasons[s["scheme_id"], code] += 1
            passed[c["citizen_id"]] += code == "ELIGIBLE"
    return reasons, passed


def check(spark, citizens, schemes, rules):
    cat = frames(spark, citizens, schemes, rules)
    reasons, passed = brute(citizens, schemes, rules)
    assert {(r.scheme_id, r.reason_code): r.citizens for r in f01d_population_eligibility(cat).collect()} == reasons
    assert {r.citizen_id: r.schemes for r in f01e_eligible_schemes(cat).collect()} == passed


def test_population_matches_all_pairs(spark):
    for seed in (1, 2):
        check(spark, *odd_rows(random.Random(seed), 400))


def test_population_of_odd_tables(spark):
    citizens, schemes, rules = odd_rows(random.Random(3), 20)
    check(spark, [], schemes, rules)
    check(spark, citizens, schemes, [])
    check(spark, citizens, [], [])


def test_no_pair_of_citizen_and_scheme(cat01):
    """No nested loop; citizens meet nothing before they are counted per cell."""
    for name in ("f01d_population_eligibility", "f01e_eligible_schemes"):
        plan = JOBS[name].fn(cat01)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
