"""SQL surface: the tables and views as temp views, the rules as SQL functions.

The rule functions are SQL-language functions (``CREATE TEMPORARY FUNCTION ...
RETURN expr``): Spark inlines them into the calling plan, so SQL users get the
same JVM-side evaluation as the DataFrame jobs.  They take attribute values
(not ids): looking attributes up is a join the query expresses.  For those
joins there are the views ``v_rules_by_scheme`` (one row per scheme, the
arguments of ``check_eligibility``) and ``v_active_pairs`` (one row per
citizen and scheme with an active application: the duplicate test).
"""

from __future__ import annotations

import re

from schemelens.functions import rules as R


def _bare(sql: str, alias: str) -> str:
    return re.sub(rf"\b{alias}\.", "", sql)


def register_sql(cat, prefix: str = "") -> list[str]:
    """Create temp views for every catalog table, the three report views and the
    two lookup views, and the SQL functions ``priority_score``,
    ``benefit_amount``, ``check_eligibility`` and ``scheme_utilization``.
    Returns view names."""
    from schemelens.plans.views import v01_application_flow, v02_scheme_fund_status, v03_officer_performance
    spark = cat.spark
    names = []
    for n in cat.names():
        cat[n].createOrReplaceTempView(prefix + n)
        names.append(prefix + n)
    for n, fn in (("v_application_flow", v01_application_flow), ("v_scheme_fund_status", v02_scheme_fund_status),
                  ("v_officer_performance", v03_officer_performance)):
        fn(cat).createOrReplaceTempView(prefix + n)
        names.append(prefix + n)
    for n, df in (("v_rules_by_scheme", R.rules_by_scheme(cat["rules"])),
                  ("v_active_pairs", R.active_keys(cat["application"]))):
        df.createOrReplaceTempView(prefix + n)
        names.append(prefix + n)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION priority_score(annual_income DECIMAL(12,2), category STRING, "
              "location_type STRING, age INT) RETURNS INT RETURN " + _bare(R.priority_score_sql("p"), "p"))
    body = _bare(_bare(R.benefit_amount_sql("p", "q"), "p"), "q")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION benefit_amount(base_benefit_amount DECIMAL(12,2), "
              "max_benefit_amount DECIMAL(12,2), annual_income DECIMAL(12,2), category STRING, location_type STRING, "
              "age INT) RETURNS DECIMAL(12,2) RETURN CASE WHEN max_benefit_amount IS NULL THEN NULL ELSE "
              + body + " END")
    # an unknown citizen or scheme comes from a left join: its id is NULL
    text = R.eligibility_reason_sql("c", "s", "r").replace("c.citizen_id", "citizen_id").replace("s.scheme_id", "scheme_id")
    for alias in "csr":
        text = _bare(text, alias)
    for theirs, ours in (("concat(", "concat_ws('', "), ("varchar", "string"), ("strpos(", "instr(")):
        text = text.replace(theirs, ours)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION check_eligibility(citizen_id BIGINT, age INT, "
              "annual_income DECIMAL(12,2), category STRING, location_type STRING, gender STRING, "
              "land_holding_acres DECIMAL(6,2), scheme_id BIGINT, is_active STRING, r_count BIGINT, r_min_age INT, "
              "r_max_age INT, r_max_income DECIMAL(12,2), r_min_income DECIMAL(12,2), r_allowed_categories STRING, "
              "r_location_type STRING, r_gender_restriction STRING, r_min_land_acres DECIMAL(6,2)) "
              "RETURNS STRING RETURN " + text)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION scheme_utilization(total_budget DECIMAL(15,2), "
              "disbursed_amount DECIMAL(15,2)) RETURNS DOUBLE RETURN CASE WHEN total_budget IS NULL OR total_budget = 0 "
              "THEN 0.0D ELSE CAST(round(CAST(disbursed_amount * 100 AS DECIMAL(38,12)) / total_budget, 2) AS DOUBLE) END")
    return names
