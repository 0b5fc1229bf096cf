"""Eligibility (f01), benefit (f02), priority (f03), duplicate (f04) and
utilisation (f05) rules as set-based Catalyst expressions.

The modelled system evaluates these as point lookups by id followed by an IF
chain.  Here the lookups become joins done once per batch of pairs
(``rule_inputs``) and the IF chains become ``when`` chains evaluated inside
whole-stage codegen: no Python on the row path.

Input contract of the column builders (produced by ``rule_inputs``):
  citizen : _c_found, age, annual_income, category, location_type, gender,
            land_holding_acres
  scheme  : _s_found, is_active, base_benefit_amount, max_benefit_amount
  rules   : r_count, r_min_age, r_max_age, r_max_income, r_min_income,
            r_allowed_categories, r_location_type, r_gender_restriction,
            r_min_land_acres
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import cat, oracle_num, oracle_num_sql

# Outcome texts of the eligibility check.
ELIGIBLE = "ELIGIBLE"
NOT_FOUND = "INELIGIBLE: Citizen or scheme not found"
INACTIVE = "INELIGIBLE: Scheme is currently inactive"
TOO_MANY_ROWS = "ERROR: ORA-01422: exact fetch returns more than requested number of rows"

# Benefit factor bands (upper income bound, factor), category and
# location / age multipliers.
BENEFIT_INCOME_BANDS = [(50000, "1.00"), (150000, "0.88"), (300000, "0.75"), (500000, "0.60")]
BENEFIT_INCOME_ELSE = "0.40"
BENEFIT_SC_ST = "1.20"
BENEFIT_OBC = "1.10"
BENEFIT_RURAL = "1.08"
BENEFIT_SENIOR = "1.12"
SENIOR_AGE = 60

# Priority score bands.
PRIORITY_INCOME_BANDS = [(50000, 50), (100000, 44), (200000, 36), (350000, 26), (500000, 16)]
PRIORITY_INCOME_ELSE = 5
PRIORITY_CATEGORY = [("ST", 25), ("SC", 22), ("OBC", 14)]
PRIORITY_CATEGORY_ELSE = 5
PRIORITY_RURAL, PRIORITY_URBAN = 15, 5
PRIORITY_SENIOR = 10

RULE_COLUMNS = ["min_age", "max_age", "max_income", "min_income", "allowed_categories", "location_type",
                "gender_restriction", "min_land_acres"]
CITIZEN_RULE_COLUMNS = ["age", "annual_income", "category", "location_type", "gender", "land_holding_acres"]


# ------------------------------------------------------------------ inputs
def rules_by_scheme(rules: DataFrame) -> DataFrame:
    """One row per scheme: rule count plus the attributes (valid when count=1)."""
    return rules.groupBy("scheme_id").agg(
        F.count(F.lit(1)).alias("r_count"),
        *[F.min(c).alias(f"r_{c}") for c in RULE_COLUMNS])


def rule_inputs(pairs: DataFrame, catalog, need_rules: bool = True, citizen_extra: tuple = (),
                scheme_extra: tuple = ()) -> DataFrame:
    """Attach citizen, scheme and rules attributes to (citizen_id, scheme_id) pairs
    (one join per table; ``*_extra`` carries further columns along)."""
    cz = catalog["citizen"].select("citizen_id", *CITIZEN_RULE_COLUMNS, *citizen_extra, F.lit(True).alias("_c_found"))
    sc = catalog.dim("scheme").select("scheme_id", "is_active", "base_benefit_amount", "max_benefit_amount",
                                      *scheme_extra, F.lit(True).alias("_s_found"))
    out = pairs.join(cz, "citizen_id", "left").join(sc, "scheme_id", "left")
    if need_rules:
        out = out.join(catalog.small(rules_by_scheme(catalog["rules"]), "rules_by_scheme"), "scheme_id", "left")
    return out


# ------------------------------------------------------------- f01 (text)
def eligibility_reason() -> Column:
    """First failing rule wins; NULL comparisons do not fire (PL/SQL IF)."""
    age, inc, category = F.col("age"), F.col("annual_income"), F.col("category")
    loc, gender, land = F.col("location_type"), F.col("gender"), F.col("land_holding_acres")
    mn_age, mx_age = F.col("r_min_age"), F.col("r_max_age")
    mx_inc, mn_inc = F.col("r_max_income"), F.col("r_min_income")
    cats, loc_req = F.col("r_allowed_categories"), F.col("r_location_type")
    gen_req, mn_land = F.col("r_gender_restriction"), F.col("r_min_land_acres")
    return (
        F.when(F.col("_s_found").isNull(), F.lit(NOT_FOUND))
        .when(F.col("is_active") == "N", F.lit(INACTIVE))
        .when(F.col("_c_found").isNull() | F.col("r_count").isNull(), F.lit(NOT_FOUND))
        .when(F.col("r_count") > 1, F.lit(TOO_MANY_ROWS))
        .when((age < mn_age) | (age > mx_age),
              cat("INELIGIBLE: Age ", age.cast("string"), " out of range [", mn_age.cast("string"), "-",
                  mx_age.cast("string"), "]"))
        .when(mx_inc.isNotNull() & (inc > mx_inc),
              cat("INELIGIBLE: Income Rs.", oracle_num(inc), " exceeds limit of Rs.", oracle_num(mx_inc)))
        .when(inc < mn_inc,
              cat("INELIGIBLE: Income Rs.", oracle_num(inc), " below minimum Rs.", oracle_num(mn_inc)))
        .when((cats != "ALL") & ~F.array_contains(F.split(cats, ","), category),
              cat("INELIGIBLE: Category ", category, " not eligible. Allowed: ", cats))
        .when((loc_req != "ALL") & (loc != loc_req),
              cat("INELIGIBLE: Scheme is for ", loc_req, " residents only"))
        .when((gen_req != "ALL") & (gender != gen_req),
              cat("INELIGIBLE: Scheme is restricted to ",
                  F.when(gen_req == "F", F.lit("female")).otherwise(F.lit("male")), " applicants only"))
        .when((mn_land > 0) & (land < mn_land),
              cat("INELIGIBLE: Land holding ", oracle_num(land), " acres is below minimum ", oracle_num(mn_land),
                  " acres"))
        .otherwise(F.lit(ELIGIBLE)))


def reason_code() -> Column:
    """Short code of the first failing rule (for counting)."""
    r = F.col("eligibility")
    return (F.when(r == ELIGIBLE, "ELIGIBLE")
            .when(r == NOT_FOUND, "NOT_FOUND")
            .when(r == INACTIVE, "INACTIVE")
            .when(r.startswith("ERROR"), "ERROR")
            .when(r.startswith("INELIGIBLE: Age"), "AGE")
            .when(r.contains("exceeds limit"), "MAX_INCOME")
            .when(r.contains("below minimum Rs."), "MIN_INCOME")
            .when(r.startswith("INELIGIBLE: Category"), "CATEGORY")
            .when(r.startswith("INELIGIBLE: Scheme is for"), "LOCATION")
            .when(r.startswith("INELIGIBLE: Scheme is restricted"), "GENDER")
            .when(r.startswith("INELIGIBLE: Land"), "LAND")
            .otherwise("OTHER"))


def eligibility_reason_sql(c: str = "c", s: str = "s", r: str = "r") -> str:
    """DuckDB twin of ``eligibility_reason``; ``r`` is a per-scheme aggregate
    with r_count and r_<attr> columns, ``c`` / ``s`` are left-joined rows."""
    def num(x):
        return oracle_num_sql(x)
    return f"""(case
 when {s}.scheme_id is null then '{NOT_FOUND}'
 when {s}.is_active = 'N' then '{INACTIVE}'
 when {c}.citizen_id is null or {r}.r_count is null then '{NOT_FOUND}'
 when {r}.r_count > 1 then '{TOO_MANY_ROWS}'
 when {c}.age < {r}.r_min_age or {c}.age > {r}.r_max_age then concat('INELIGIBLE: Age ', cast({c}.age as varchar), ' out of range [', cast({r}.r_min_age as varchar), '-', cast({r}.r_max_age as varchar), ']')
 when {r}.r_max_income is not null and {c}.annual_income > {r}.r_max_income then concat('INELIGIBLE: Income Rs.', {num(c + '.annual_income')}, ' exceeds limit of Rs.', {num(r + '.r_max_income')})
 when {c}.annual_income < {r}.r_min_income then concat('INELIGIBLE: Income Rs.', {num(c + '.annual_income')}, ' below minimum Rs.', {num(r + '.r_min_income')})
 when {r}.r_allowed_categories <> 'ALL' and (',' || {r}.r_allowed_categories || ',') not like ('%,' || {c}.category || ',%') then concat('INELIGIBLE: Category ', {c}.category, ' not eligible. Allowed: ', {r}.r_allowed_categories)
 when {r}.r_location_type <> 'ALL' and {c}.location_type <> {r}.r_location_type then concat('INELIGIBLE: Scheme is for ', {r}.r_location_type, ' residents only')
 when {r}.r_gender_restriction <> 'ALL' and {c}.gender <> {r}.r_gender_restriction then concat('INELIGIBLE: Scheme is restricted to ', case when {r}.r_gender_restriction = 'F' then 'female' else 'male' end, ' applicants only')
 when {r}.r_min_land_acres > 0 and {c}.land_holding_acres < {r}.r_min_land_acres then concat('INELIGIBLE: Land holding ', {num(c + '.land_holding_acres')}, ' acres is below minimum ', {num(r + '.r_min_land_acres')}, ' acres')
 else 'ELIGIBLE' end)"""


RULES_BY_SCHEME_SQL = ("(select scheme_id, count(*) as r_count, "
                       + ", ".join(f"min({c}) as r_{c}" for c in RULE_COLUMNS)
                       + " from rules group by scheme_id)")


# ----------------------------------------------------------- f02 (amount)
def _d(x: str) -> Column:
    return F.lit(Decimal(x))


def benefit_amount() -> Column:
    """LEAST(ROUND(base * factors, 2), max); 0 when citizen or scheme missing.

    Exact decimal arithmetic: decimal(12,2) times four 2-dp factors is
    decimal(24,10), rounded HALF_UP to 2 dp.  Oracle's LEAST is NULL when the
    base or the cap is NULL (Spark's ``least`` would skip it).
    """
    inc = F.col("annual_income")
    factor = F.when(inc <= BENEFIT_INCOME_BANDS[0][0], _d(BENEFIT_INCOME_BANDS[0][1]))
    for bound, f in BENEFIT_INCOME_BANDS[1:]:
        factor = factor.when(inc <= bound, _d(f))
    factor = factor.otherwise(_d(BENEFIT_INCOME_ELSE))
    category = (F.when(F.col("category").isin("SC", "ST"), _d(BENEFIT_SC_ST))
                .when(F.col("category") == "OBC", _d(BENEFIT_OBC)).otherwise(_d("1.00")))
    rural = F.when(F.col("location_type") == "RURAL", _d(BENEFIT_RURAL)).otherwise(_d("1.00"))
    senior = F.when(F.col("age") >= SENIOR_AGE, _d(BENEFIT_SENIOR)).otherwise(_d("1.00"))
    raw = F.col("base_benefit_amount") * factor * category * rural * senior
    rounded = F.round(raw.cast("decimal(28,10)"), 2).cast("decimal(12,2)")
    mx = F.col("max_benefit_amount")
    capped = F.when(mx.isNull() | F.col("base_benefit_amount").isNull(), F.lit(None).cast("decimal(12,2)")).otherwise(F.least(rounded, mx))
    return (F.when(F.col("_c_found").isNull() | F.col("_s_found").isNull(), F.lit(Decimal("0.00")))
            .otherwise(capped)).cast("decimal(12,2)")


def benefit_amount_sql(c: str = "c", s: str = "s") -> str:
    bands = " ".join(f"when {c}.annual_income<={b} then {f}" for b, f in BENEFIT_INCOME_BANDS)
    return (f"case when {s}.base_benefit_amount is null or {s}.max_benefit_amount is null then null else "
            f"least(cast(round(cast({s}.base_benefit_amount * (case {bands} else {BENEFIT_INCOME_ELSE} end)"
            f" * (case when {c}.category in ('SC','ST') then {BENEFIT_SC_ST} when {c}.category='OBC' then {BENEFIT_OBC} else 1.00 end)"
            f" * (case when {c}.location_type='RURAL' then {BENEFIT_RURAL} else 1.00 end)"
            f" * (case when {c}.age>={SENIOR_AGE} then {BENEFIT_SENIOR} else 1.00 end) as decimal(28,10)),2) as decimal(12,2)),"
            f" {s}.max_benefit_amount) end")


# ---------------------------------------------------------- f03 (score)
def priority_score() -> Column:
    inc = F.col("annual_income")
    income = F.when(inc <= PRIORITY_INCOME_BANDS[0][0], PRIORITY_INCOME_BANDS[0][1])
    for bound, pts in PRIORITY_INCOME_BANDS[1:]:
        income = income.when(inc <= bound, pts)
    income = income.otherwise(PRIORITY_INCOME_ELSE)
    c = F.col("category")
    category = F.when(c == PRIORITY_CATEGORY[0][0], PRIORITY_CATEGORY[0][1])
    for code, pts in PRIORITY_CATEGORY[1:]:
        category = category.when(c == code, pts)
    category = category.otherwise(PRIORITY_CATEGORY_ELSE)
    loc = F.when(F.col("location_type") == "RURAL", PRIORITY_RURAL).otherwise(PRIORITY_URBAN)
    senior = F.when(F.col("age") >= SENIOR_AGE, PRIORITY_SENIOR).otherwise(0)
    return F.when(F.col("_c_found").isNull(), F.lit(0)).otherwise(income + category + loc + senior).cast("int")


def priority_score_sql(c: str = "c") -> str:
    inc = " ".join(f"when {c}.annual_income <= {b} then {p}" for b, p in PRIORITY_INCOME_BANDS)
    catg = " ".join(f"when {c}.category = '{k}' then {p}" for k, p in PRIORITY_CATEGORY)
    return (f"cast((case {inc} else {PRIORITY_INCOME_ELSE} end) + (case {catg} else {PRIORITY_CATEGORY_ELSE} end)"
            f" + (case when {c}.location_type = 'RURAL' then {PRIORITY_RURAL} else {PRIORITY_URBAN} end)"
            f" + (case when {c}.age >= {SENIOR_AGE} then {PRIORITY_SENIOR} else 0 end) as integer)")


# ------------------------------------------------------- f04, f05 helpers
def is_active_status() -> Column:
    """status NOT IN ('REJECTED'): a NULL status is not counted (UNKNOWN)."""
    return ~F.col("status").isin("REJECTED")


def active_keys(application: DataFrame) -> DataFrame:
    """Distinct (citizen_id, scheme_id) with an active (not REJECTED) application."""
    return application.filter(is_active_status()).select("citizen_id", "scheme_id").distinct()


def utilization_pct() -> Column:
    """ROUND(disbursed / total * 100, 2); 0 when there is no pool or total is 0."""
    from schemelens.functions.semantics import half_up, paise
    return (F.when(F.col("total_budget").isNull() | (F.col("total_budget") == 0), F.lit(0.0))
            .otherwise(half_up(paise("disbursed_amount") * 100, paise("total_budget"), 2)))
