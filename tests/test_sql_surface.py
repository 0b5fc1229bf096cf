"""The SQL surface (temp views + SQL rule functions) agrees with the DataFrame jobs."""

from schemelens.plans.sql import register_sql
from schemelens.plans.rule_jobs import (f01_check_eligibility, f02_calculate_benefit, f03_priority_score,
                                       f04_is_duplicate_app, f05_scheme_utilization)


def test_sql_functions_match_columns(spark, cat001):
    register_sql(cat001, prefix="t_")
    got = spark.sql("""select q.request_id, priority_score(c.annual_income, c.category, c.location_type, c.age) as p,
                              benefit_amount(s.base_benefit_amount, s.max_benefit_amount, c.annual_income, c.category,
                                             c.location_type, c.age) as b
                       from t_application_request q join t_citizen c on q.citizen_id = c.citizen_id
                       join t_scheme s on q.scheme_id = s.scheme_id""").collect()
    pr = {r.request_id: r.priority_score for r in f03_priority_score(cat001).collect()}
    bf = {r.request_id: r.benefit for r in f02_calculate_benefit(cat001).collect()}
    assert got and all(pr[r.request_id] == r.p and bf[r.request_id] == r.b for r in got)
    n = spark.sql("select count(*) as n from t_v_scheme_fund_status").first().n
    assert n == cat001["pool"].count()


def test_eligibility_utilisation_and_duplicates(spark, cat001):
    register_sql(cat001, prefix="t_")
    got = spark.sql("""select q.request_id, check_eligibility(c.citizen_id, c.age, c.annual_income, c.category, c.location_type,
                              c.gender, c.land_holding_acres, s.scheme_id, s.is_active, r.r_count, r.r_min_age, r.r_max_age,
                              r.r_max_income, r.r_min_income, r.r_allowed_categories, r.r_location_type,
                              r.r_gender_restriction, r.r_min_land_acres) as e,
                              if(a.citizen_id is null, 'N', 'Y') as dup
                       from t_application_request q left join t_citizen c on q.citizen_id = c.citizen_id
                       left join t_scheme s on q.scheme_id = s.scheme_id
                       left join t_v_rules_by_scheme r on q.scheme_id = r.scheme_id
                       left join t_v_active_pairs a on q.citizen_id = a.citizen_id and q.scheme_id = a.scheme_id""").collect()
    texts = {r.request_id: r.eligibility for r in f01_check_eligibility(cat001).collect()}
    dups = {r.request_id: r.is_duplicate for r in f04_is_duplicate_app(cat001).collect()}
    assert got and {r.request_id: r.e for r in got} == texts and {r.request_id: r.dup for r in got} == dups
    assert len(set(texts.values())) > 3
    used = spark.sql("""select s.scheme_id, scheme_utilization(p.total_budget, p.disbursed_amount) as u
                        from t_scheme s left join t_pool p on s.scheme_id = p.scheme_id""").collect()
    assert {r.scheme_id: r.u for r in used} == {r.scheme_id: r.utilization_pct for r in f05_scheme_utilization(cat001).collect()}
