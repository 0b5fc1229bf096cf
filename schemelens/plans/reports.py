"""Operational and analytical reports (q01..q31) and the scheme report (r01, r02).

Conventions: ORDER BY is applied as the final step with the modelled null order
(ascending -> nulls last, descending -> nulls first).  Aggregates over the
large fact tables are computed on ids first and names are attached afterwards
(Catalyst does not push aggregation below joins); ratios are rounded exactly
with ``half_up``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import (as_of_col, as_of_sql, half_up, half_up_sql, paise, paise_sql,
                                            trunc_days, trunc_days_sql)
from schemelens.plans.views import (APPROVED, BUDGET_STATUS_SQL, OFFICER_STATS_SQL, PENDING, avg_days,
                                    avg_days_sql, fund_status, officer_app_stats)
from schemelens.registry import register

# Report parameters (stand-ins for the literals of the modelled reports).
Q02_STATE = "NATION_1"
Q09_SCHEME_ID, Q09_INCOME_CAP = 3, 500000
Q11_MIN_APPLICATIONS = 50
Q13_DAYS = 30
Q23_SCHEME_CODES = ("S-0", "S-1", "S-4")
Q23_INCOME = 500000
Q25_TOP = 5
Q28_APPLICATION_ID = 1


def A(c):
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def D(c):
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def _citizens(cat, *cols):
    return cat["citizen"].select("citizen_id", *cols)


def _schemes(cat, *cols):
    return cat.dim("scheme").select("scheme_id", *cols)


# ---------------------------------------------------------------- Q1 - Q7
@register("q01_scheme_catalog", oracle="""
select s.scheme_name, s.scheme_type, d.department_name, cast(s.base_benefit_amount as double) as base_benefit_amount,
 cast(s.max_benefit_amount as double) as max_benefit_amount, s.is_active
from scheme s join department d on s.department_id = d.department_id
order by s.scheme_type, s.scheme_name""")
def q01_scheme_catalog(cat) -> DataFrame:
    """Schemes with department and benefit range."""
    return (cat.dim("scheme").join(cat.dim("department"), "department_id")
            .select("scheme_name", "scheme_type", "department_name", "base_benefit_amount", "max_benefit_amount",
                    "is_active")
            .orderBy(A("scheme_type"), A("scheme_name")))


@register("q02_state_citizens", oracle=f"""
select full_name, state, category, cast(annual_income as double) as annual_income, location_type, occupation
from citizen where state = '{Q02_STATE}' order by annual_income""")
def q02_state_citizens(cat, state: str = Q02_STATE) -> DataFrame:
    """Citizens of one state by income (filter pushed to the scan)."""
    return (cat["citizen"].filter(F.col("state") == state)
            .select("full_name", "state", "category", "annual_income", "location_type", "occupation")
            .orderBy(A("annual_income"), A("citizen_id")))


@register("q03_application_detail", oracle="""
select a.application_id, c.full_name, c.aadhaar_number, s.scheme_name, a.status, a.apply_date, a.priority_score
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id""")
def q03_application_detail(cat) -> DataFrame:
    """Applications with citizen and scheme details, newest first."""
    return (cat["application"].join(_citizens(cat, "full_name", "aadhaar_number"), "citizen_id")
            .join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("application_id", "full_name", "aadhaar_number", "scheme_name", "status", "apply_date",
                    "priority_score")
            .orderBy(D("apply_date"), A("application_id")))


@register("q04_officer_directory", oracle="""
select o.officer_name, d.department_name, o.assigned_state
from officer o join department d on o.department_id = d.department_id""")
def q04_officer_directory(cat) -> DataFrame:
    """Officers with department and assignment (NULL state sorts last)."""
    return (cat.dim("officer").join(cat.dim("department"), "department_id")
            .select("officer_name", "department_name", "assigned_state").orderBy(A("assigned_state"), A("officer_id")))


@register("q05_active_budget_balance", oracle="""
select s.scheme_name, s.scheme_type, cast(p.total_budget as double) as total_budget,
 cast(p.disbursed_amount as double) as disbursed_amount, cast(p.total_budget - p.disbursed_amount as double) as remaining_budget
from scheme s join pool p on s.scheme_id = p.scheme_id where s.is_active = 'Y'""")
def q05_active_budget_balance(cat) -> DataFrame:
    """Active schemes with current budget balance."""
    return (cat.dim("scheme").filter(F.col("is_active") == "Y").join(cat.dim("pool"), "scheme_id")
            .select("scheme_name", "scheme_type", "total_budget", "disbursed_amount",
                    (F.col("total_budget") - F.col("disbursed_amount")).alias("remaining_budget"))
            .orderBy(D("total_budget")))


@register("q06_pending_documents", oracle="""
select cd.doc_id, c.full_name, c.aadhaar_number, cd.doc_type, cd.upload_date, cd.status
from citizen_document cd join citizen c on cd.citizen_id = c.citizen_id where cd.status = 'PENDING'""")
def q06_pending_documents(cat) -> DataFrame:
    """Documents awaiting verification (filter before the join)."""
    return (cat["citizen_document"].filter(F.col("status") == "PENDING")
            .join(_citizens(cat, "full_name", "aadhaar_number"), "citizen_id")
            .select("doc_id", "full_name", "aadhaar_number", "doc_type", "upload_date", "status")
            .orderBy(A("upload_date"), A("doc_id")))


@register("q07_rule_listing", oracle="""
select s.scheme_name, r.min_age, r.max_age, cast(r.max_income as double) as max_income, cast(r.min_income as double) as min_income,
 r.allowed_categories, r.location_type, r.gender_restriction, cast(r.min_land_acres as double) as min_land_acres
from rules r join scheme s on r.scheme_id = s.scheme_id""")
def q07_rule_listing(cat) -> DataFrame:
    """Eligibility rules of every scheme (all rule rows kept)."""
    return (cat.dim("rules").join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("scheme_name", "min_age", "max_age", "max_income", "min_income", "allowed_categories",
                    "location_type", "gender_restriction", "min_land_acres")
            .orderBy(A("scheme_name")))


# --------------------------------------------------------------- Q8 - Q14
@register("q08_status_counts", oracle="""
select s.scheme_name, a.status, count(*) as count
from application a join scheme s on a.scheme_id = s.scheme_id group by s.scheme_name, a.status""")
def q08_status_counts(cat) -> DataFrame:
    """Application count per scheme and status."""
    counts = cat["application"].groupBy("scheme_id", "status").agg(F.count(F.lit(1)).alias("count"))
    return (counts.join(_schemes(cat, "scheme_name"), "scheme_id")
            .groupBy("scheme_name", "status").agg(F.sum("count").alias("count"))
            .orderBy(A("scheme_name"), A("status")))


@register("q09_unapplied_eligible", oracle=f"""
select c.citizen_id, c.full_name, c.state, c.category, cast(c.annual_income as double) as annual_income
from citizen c where c.annual_income < {Q09_INCOME_CAP} and c.is_verified = 'Y'
 and not exists (select 1 from application a where a.citizen_id = c.citizen_id and a.scheme_id = {Q09_SCHEME_ID})""")
def q09_unapplied_eligible(cat, scheme_id: int = Q09_SCHEME_ID, cap: int = Q09_INCOME_CAP) -> DataFrame:
    """Verified low-income citizens with no application (any status) to a scheme."""
    # distinct keys: a citizen with many applications becomes one row (no skewed anti-join key)
    applied = cat["application"].filter(F.col("scheme_id") == scheme_id).select("citizen_id").distinct()
    return (cat["citizen"].filter((F.col("annual_income") < cap) & (F.col("is_verified") == "Y"))
            .join(applied, "citizen_id", "left_anti")
            .select("citizen_id", "full_name", "state", "category", "annual_income")
            .orderBy(A("annual_income"), A("citizen_id")))


@register("q10_officer_queue", oracle=f"""
select a.application_id, c.full_name, c.category, cast(c.annual_income as double) as annual_income, s.scheme_name,
 a.priority_score, a.apply_date, {trunc_days_sql('a.apply_date', as_of_sql())} as days_waiting
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
where a.status in ('SUBMITTED','UNDER_REVIEW')""")
def q10_officer_queue(cat, as_of=None) -> DataFrame:
    """Pending applications by priority, with whole days waiting."""
    now = as_of_col() if as_of is None else as_of_col(as_of)
    return (cat["application"].filter(F.col("status").isin(*PENDING))
            .join(_citizens(cat, "full_name", "category", "annual_income"), "citizen_id")
            .join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("application_id", "full_name", "category", "annual_income", "scheme_name", "priority_score",
                    "apply_date", trunc_days("apply_date", now).alias("days_waiting"))
            .orderBy(D("priority_score"), A("apply_date"), A("application_id")))


@register("q11_popular_schemes", oracle=f"""
select s.scheme_name, count(a.application_id) as total_applications
from scheme s left join application a on s.scheme_id = a.scheme_id
group by s.scheme_name having count(a.application_id) > {Q11_MIN_APPLICATIONS}""")
def q11_popular_schemes(cat, min_apps: int = Q11_MIN_APPLICATIONS) -> DataFrame:
    """Schemes with more than ``min_apps`` applications."""
    counts = cat["application"].groupBy("scheme_id").agg(F.count("application_id").alias("n"))
    return (_schemes(cat, "scheme_name").join(counts, "scheme_id", "left")
            .groupBy("scheme_name").agg(F.sum(F.coalesce("n", F.lit(0))).alias("total_applications"))
            .filter(F.col("total_applications") > min_apps)
            .orderBy(D("total_applications")))


@register("q12_multi_applicants", oracle="""
select c.citizen_id, c.full_name, c.category, cast(c.annual_income as double) as annual_income,
 count(a.application_id) as total_applications
from citizen c join application a on c.citizen_id = a.citizen_id
group by c.citizen_id, c.full_name, c.category, c.annual_income having count(a.application_id) > 1""")
def q12_multi_applicants(cat) -> DataFrame:
    """Citizens with more than one application."""
    counts = (cat["application"].groupBy("citizen_id").agg(F.count("application_id").alias("total_applications"))
              .filter(F.col("total_applications") > 1))
    return (counts.join(_citizens(cat, "full_name", "category", "annual_income"), "citizen_id")
            .select("citizen_id", "full_name", "category", "annual_income", "total_applications")
            .orderBy(D("total_applications"), A("citizen_id")))


@register("q13_recent_disbursements", oracle=f"""
select fd.disbursement_id, c.full_name, s.scheme_name, cast(fd.amount as double) as amount, fd.disbursement_date,
 fd.payment_mode, fd.transaction_ref
from disbursement fd join application a on fd.application_id = a.application_id
 join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
where fd.disbursement_date >= {as_of_sql()} - interval {Q13_DAYS} day and fd.status = 'PROCESSED'""")
def q13_recent_disbursements(cat, as_of=None, days: int = Q13_DAYS) -> DataFrame:
    """Processed payments dated on or after as_of - days (no upper bound)."""
    now = as_of_col() if as_of is None else as_of_col(as_of)
    since = now - F.expr(f"INTERVAL {int(days)} DAYS")
    fd = cat["disbursement"].filter((F.col("disbursement_date") >= since) & (F.col("status") == "PROCESSED"))
    a = cat["application"].select("application_id", "citizen_id", "scheme_id")
    return (fd.join(a, "application_id").join(_citizens(cat, "full_name"), "citizen_id")
            .join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("disbursement_id", "full_name", "scheme_name", "amount", "disbursement_date", "payment_mode",
                    "transaction_ref")
            .orderBy(D("disbursement_date"), A("disbursement_id")))


@register("q14_rejections", oracle="""
select a.application_id, c.full_name, c.aadhaar_number, s.scheme_name, a.rejection_reason, a.approval_date
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
where a.status = 'REJECTED'""")
def q14_rejections(cat) -> DataFrame:
    """Rejected applications with reasons (undated rejections first)."""
    return (cat["application"].filter(F.col("status") == "REJECTED")
            .join(_citizens(cat, "full_name", "aadhaar_number"), "citizen_id")
            .join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("application_id", "full_name", "aadhaar_number", "scheme_name", "rejection_reason",
                    "approval_date")
            .orderBy(D("approval_date"), A("application_id")))


# -------------------------------------------------------------- Q15 - Q21
def payments_by_scheme(cat) -> DataFrame:
    """Sum / count of payments per scheme (payments of any status)."""
    a = cat["application"].select("application_id", "scheme_id")
    return (cat["disbursement"].select("application_id", "disbursement_id", "amount").join(a, "application_id")
            .groupBy("scheme_id").agg(F.sum("amount").alias("paid"), F.count("disbursement_id").alias("n_paid")))


PAYMENTS_BY_SCHEME_SQL = """(select a.scheme_id, sum(fd.amount) as paid, count(fd.disbursement_id) as n_paid
 from disbursement fd join application a on fd.application_id = a.application_id group by a.scheme_id)"""


@register("q15_funds_per_scheme", oracle="""
select s.scheme_name, cast(coalesce(sum(x.paid), 0) as double) as total_disbursed,
 cast(coalesce(sum(x.n_paid), 0) as bigint) as beneficiary_count,
 coalesce(""" + half_up_sql(paise_sql("sum(x.paid)"), "100 * sum(x.n_paid)", 2) + """, 0.0) as avg_per_beneficiary
from scheme s left join """ + PAYMENTS_BY_SCHEME_SQL + """ x on s.scheme_id = x.scheme_id group by s.scheme_name""")
def q15_funds_per_scheme(cat) -> DataFrame:
    """Total, count and average payment per scheme (FAILED payments included)."""
    per = _schemes(cat, "scheme_name").join(payments_by_scheme(cat), "scheme_id", "left")
    g = per.groupBy("scheme_name").agg(F.sum("paid").alias("paid"), F.sum("n_paid").alias("n_paid"))
    return (g.select("scheme_name",
                     F.coalesce("paid", F.lit(0)).cast("decimal(25,2)").alias("total_disbursed"),
                     F.coalesce("n_paid", F.lit(0)).cast("bigint").alias("beneficiary_count"),
                     F.coalesce(half_up(paise("paid"), F.col("n_paid") * 100, 2), F.lit(0.0))
                     .alias("avg_per_beneficiary"))
            .orderBy(D("total_disbursed")))


@register("q16_budget_health", oracle="""
select s.scheme_name, cast(p.total_budget as double) as total_budget, cast(p.disbursed_amount as double) as disbursed_amount,
 cast(p.total_budget - p.disbursed_amount as double) as remaining,
 """ + half_up_sql(paise_sql("p.disbursed_amount") + " * 100", paise_sql("p.total_budget"), 2) + """ as used_pct,
 """ + BUDGET_STATUS_SQL + """ as budget_status
from scheme s join pool p on s.scheme_id = p.scheme_id""")
def q16_budget_health(cat) -> DataFrame:
    """Budget utilisation with health band, most used first."""
    return (fund_status(cat)
            .select("scheme_name", "total_budget", "disbursed_amount", F.col("remaining_budget").alias("remaining"),
                    F.col("utilization_pct").alias("used_pct"), "budget_status")
            .orderBy(D("used_pct")))


def _payments_per_application(cat) -> DataFrame:
    """Payments pre-aggregated per application (normally one row each)."""
    return (cat["disbursement"].groupBy("application_id")
            .agg(F.sum("amount").alias("paid"), F.count(F.lit(1)).alias("n_pay")))


@register("q17_rural_urban", oracle="""
select s.scheme_name, c.location_type, count(distinct a.citizen_id) as beneficiaries,
 cast(coalesce(sum(fd.amount), 0) as double) as total_amount
from scheme s join application a on s.scheme_id = a.scheme_id join citizen c on a.citizen_id = c.citizen_id
left join disbursement fd on a.application_id = fd.application_id
where a.status in ('APPROVED','DISBURSED') group by s.scheme_name, c.location_type""")
def q17_rural_urban(cat) -> DataFrame:
    """Approved beneficiaries and amounts per scheme and location type."""
    a = cat["application"].filter(F.col("status").isin(*APPROVED)).select("application_id", "citizen_id", "scheme_id")
    per_cs = (a.join(_payments_per_application(cat), "application_id", "left")
              .groupBy("scheme_id", "citizen_id").agg(F.sum("paid").alias("paid")))
    g = (per_cs.join(_citizens(cat, "location_type"), "citizen_id")
         .groupBy("scheme_id", "location_type")
         .agg(F.count(F.lit(1)).alias("beneficiaries"), F.sum("paid").alias("paid")))
    return (g.join(_schemes(cat, "scheme_name"), "scheme_id")
            .groupBy("scheme_name", "location_type")
            .agg(F.sum("beneficiaries").alias("beneficiaries"), F.sum("paid").alias("paid"))
            .select("scheme_name", "location_type", F.col("beneficiaries").cast("bigint").alias("beneficiaries"),
                    F.coalesce("paid", F.lit(0)).cast("decimal(25,2)").alias("total_amount"))
            .orderBy(A("scheme_name"), A("location_type")))


@register("q18_state_funds", oracle="""
select c.state, count(distinct a.application_id) as disbursed_apps, cast(coalesce(sum(fd.amount), 0) as double) as total_funds,
 """ + half_up_sql(paise_sql("sum(fd.amount)"), "100 * count(fd.amount)", 0) + """ as avg_benefit
from citizen c join application a on c.citizen_id = a.citizen_id left join disbursement fd on a.application_id = fd.application_id
where a.status in ('APPROVED','DISBURSED') group by c.state""")
def q18_state_funds(cat) -> DataFrame:
    """Approved applications and funds per state; average NULL without payments."""
    a = cat["application"].filter(F.col("status").isin(*APPROVED)).select("application_id", "citizen_id")
    per_c = (a.join(_payments_per_application(cat), "application_id", "left")
             .groupBy("citizen_id").agg(F.count(F.lit(1)).alias("apps"), F.sum("paid").alias("paid"),
                                        F.sum("n_pay").alias("n_pay")))
    g = (per_c.join(_citizens(cat, "state"), "citizen_id").groupBy("state")
         .agg(F.sum("apps").alias("apps"), F.sum("paid").alias("paid"), F.sum("n_pay").alias("n_pay")))
    return (g.select("state", F.col("apps").cast("bigint").alias("disbursed_apps"),
                     F.coalesce("paid", F.lit(0)).cast("decimal(25,2)").alias("total_funds"),
                     half_up(paise("paid"), F.col("n_pay") * 100, 0).alias("avg_benefit"))
            .orderBy(D("total_funds")))


@register("q19_category_benefits", oracle="""
select c.category, count(distinct c.citizen_id) as total_citizens, count(a.application_id) as applications,
 cast(sum(case when a.status in ('APPROVED','DISBURSED') then 1 else 0 end) as bigint) as approved,
 cast(coalesce(sum(fd.amount), 0) as double) as total_benefit
from citizen c left join application a on c.citizen_id = a.citizen_id left join disbursement fd on a.application_id = fd.application_id
group by c.category""")
def q19_category_benefits(cat) -> DataFrame:
    """Citizens, applications, approvals and benefit per category."""
    pay = _payments_per_application(cat)
    a = cat["application"].select("application_id", "citizen_id", "status").join(pay, "application_id", "left")
    mult = F.coalesce(F.col("n_pay"), F.lit(1))  # a payment-less application is one joined row
    per_c = a.groupBy("citizen_id").agg(
        F.sum(mult).alias("apps"),
        F.sum(F.when(F.col("status").isin(*APPROVED), mult).otherwise(0)).alias("appr"),
        F.sum("paid").alias("paid"))
    g = (_citizens(cat, "category").join(per_c, "citizen_id", "left").groupBy("category")
         .agg(F.count(F.lit(1)).alias("total_citizens"), F.sum(F.coalesce("apps", F.lit(0))).alias("apps"),
              F.sum(F.coalesce("appr", F.lit(0))).alias("appr"), F.sum("paid").alias("paid")))
    return (g.select("category", F.col("total_citizens").cast("bigint").alias("total_citizens"),
                     F.col("apps").cast("bigint").alias("applications"), F.col("appr").cast("bigint").alias("approved"),
                     F.coalesce("paid", F.lit(0)).cast("decimal(25,2)").alias("total_benefit"))
            .orderBy(D("total_benefit")))


@register("q20_priority_stats", oracle="""
select s.scheme_name, """ + half_up_sql("sum(a.priority_score)", "count(a.priority_score)", 2) + """ as avg_priority_score,
 min(a.priority_score) as min_score, max(a.priority_score) as max_score
from application a join scheme s on a.scheme_id = s.scheme_id where a.status in ('APPROVED','DISBURSED') group by s.scheme_name""")
def q20_priority_stats(cat) -> DataFrame:
    """Average / min / max priority of approved applications per scheme."""
    a = cat["application"].filter(F.col("status").isin(*APPROVED))
    g = a.groupBy("scheme_id").agg(F.sum("priority_score").alias("s"), F.count("priority_score").alias("n"),
                                   F.min("priority_score").alias("mn"), F.max("priority_score").alias("mx"))
    g = (g.join(_schemes(cat, "scheme_name"), "scheme_id").groupBy("scheme_name")
         .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("mn").alias("min_score"),
              F.max("mx").alias("max_score")))
    return (g.select("scheme_name", half_up(F.col("s"), F.col("n"), 2).alias("avg_priority_score"),
                     "min_score", "max_score")
            .orderBy(D("avg_priority_score")))


@register("q21_monthly_trend", oracle="""
select strftime(apply_date, '%Y-%m') as month, count(*) as total_applications,
 cast(sum(case when status = 'DISBURSED' then 1 else 0 end) as bigint) as disbursed
from application group by strftime(apply_date, '%Y-%m')""")
def q21_monthly_trend(cat) -> DataFrame:
    """Applications and disbursed applications per month of application."""
    return (cat["application"].groupBy(F.date_format("apply_date", "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("total_applications"),
                 F.sum(F.when(F.col("status") == "DISBURSED", 1).otherwise(0)).cast("bigint").alias("disbursed"))
            .orderBy(A("month")))


# -------------------------------------------------------------- Q22 - Q31
@register("q22_below_state_avg_unapplied", oracle="""
select c.citizen_id, c.full_name, c.state, cast(c.annual_income as double) as annual_income, c.category
from citizen c join (select state, sum(annual_income) as s, count(annual_income) as n from citizen group by state) st
 on c.state = st.state
where c.annual_income * st.n < st.s and c.is_verified = 'Y'
 and not exists (select 1 from application a where a.citizen_id = c.citizen_id)""")
def q22_below_state_avg_unapplied(cat) -> DataFrame:
    """Verified citizens below their state's average income who never applied.

    ``income < avg`` is evaluated exactly as ``income * n < sum``.
    """
    c = cat["citizen"]
    st = c.groupBy("state").agg(F.sum("annual_income").alias("_s"), F.count("annual_income").alias("_n"))
    applied = cat["application"].select("citizen_id").distinct()
    return (c.filter(F.col("is_verified") == "Y").join(cat.small(st, "state_income"), "state")
            .filter(F.col("annual_income") * F.col("_n") < F.col("_s"))
            .join(applied, "citizen_id", "left_anti")
            .select("citizen_id", "full_name", "state", "annual_income", "category")
            .orderBy(A("annual_income"), A("citizen_id")))


@register("q23_income_anomaly", oracle=f"""
select c.full_name, c.aadhaar_number, cast(c.annual_income as double) as annual_income, c.category, s.scheme_name,
 a.status, a.apply_date
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
where c.annual_income > {Q23_INCOME} and s.scheme_code in {Q23_SCHEME_CODES!r}""")
def q23_income_anomaly(cat, codes=Q23_SCHEME_CODES, income: int = Q23_INCOME) -> DataFrame:
    """High-income citizens on low-income schemes."""
    s = cat.dim("scheme").filter(F.col("scheme_code").isin(*codes)).select("scheme_id", "scheme_name")
    c = cat["citizen"].filter(F.col("annual_income") > income).select(
        "citizen_id", "full_name", "aadhaar_number", "annual_income", "category")
    return (cat["application"].join(s, "scheme_id")
            .join(c, "citizen_id")
            .select("full_name", "aadhaar_number", "annual_income", "category", "scheme_name", "status",
                    "apply_date")
            .orderBy(D("annual_income"), A("application_id")))


@register("q24_officer_dashboard", oracle="""
select o.officer_name, o.assigned_state, cast(sum(coalesce(x.handled, 0)) as bigint) as handled,
 cast(sum(coalesce(x.approved, 0)) as bigint) as approved, cast(sum(coalesce(x.rejected, 0)) as bigint) as rejected,
 """ + half_up_sql("sum(coalesce(x.approved, 0)) * 100", "sum(coalesce(x.handled, 0))", 1) + """ as approval_rate_pct,
 """ + avg_days_sql("sum(x.dated_seconds)", "sum(x.dated_n)") + """ as avg_days_taken
from officer o left join """ + OFFICER_STATS_SQL + """ x on o.officer_id = x.officer_id
group by o.officer_name, o.assigned_state having sum(coalesce(x.handled, 0)) > 0""")
def q24_officer_dashboard(cat) -> DataFrame:
    """Approval rate and average days per (officer name, state)."""
    x = officer_app_stats(cat)
    g = (cat.dim("officer").join(x, "officer_id", "left").groupBy("officer_name", "assigned_state")
         .agg(F.sum(F.coalesce("handled", F.lit(0))).alias("handled"),
              F.sum(F.coalesce("approved", F.lit(0))).alias("approved"),
              F.sum(F.coalesce("rejected", F.lit(0))).alias("rejected"),
              F.sum("dated_seconds").alias("dated_seconds"), F.sum("dated_n").alias("dated_n"))
         .filter(F.col("handled") > 0))
    return (g.select("officer_name", "assigned_state", F.col("handled").cast("bigint").alias("handled"),
                     F.col("approved").cast("bigint").alias("approved"),
                     F.col("rejected").cast("bigint").alias("rejected"),
                     half_up(F.col("approved") * 100, F.col("handled"), 1).alias("approval_rate_pct"),
                     avg_days().alias("avg_days_taken"))
            .orderBy(D("approval_rate_pct")))


@register("q25_top5_schemes", oracle=f"""
select s.scheme_name, cast(coalesce(sum(x.paid), 0) as double) as total_disbursed
from scheme s left join """ + PAYMENTS_BY_SCHEME_SQL + f""" x on s.scheme_id = x.scheme_id
group by s.scheme_name order by coalesce(sum(x.paid), 0) desc, s.scheme_name limit {Q25_TOP}""")
def q25_top5_schemes(cat, k: int = Q25_TOP) -> DataFrame:
    """Top-k schemes by total paid (scheme name breaks ties)."""
    per = _schemes(cat, "scheme_name").join(payments_by_scheme(cat), "scheme_id", "left")
    return (per.groupBy("scheme_name").agg(F.coalesce(F.sum("paid"), F.lit(0)).cast("decimal(25,2)")
                                           .alias("total_disbursed"))
            .orderBy(D("total_disbursed"), A("scheme_name")).limit(k))


@register("q26_unverified_pending", oracle="""
select c.citizen_id, c.full_name, c.aadhaar_number, c.is_verified, a.application_id, s.scheme_name, a.status
from citizen c join application a on c.citizen_id = a.citizen_id join scheme s on a.scheme_id = s.scheme_id
where c.is_verified = 'N' and a.status in ('SUBMITTED','UNDER_REVIEW')""")
def q26_unverified_pending(cat) -> DataFrame:
    """Unverified citizens with pending applications (oldest application first)."""
    c = cat["citizen"].filter(F.col("is_verified") == "N").select("citizen_id", "full_name", "aadhaar_number",
                                                                   "is_verified")
    return (cat["application"].filter(F.col("status").isin(*PENDING)).join(c, "citizen_id")
            .join(_schemes(cat, "scheme_name"), "scheme_id")
            .orderBy(A("apply_date"), A("application_id"))
            .select("citizen_id", "full_name", "aadhaar_number", "is_verified", "application_id", "scheme_name",
                    "status"))


@register("q27_unassigned", oracle=f"""
select a.application_id, c.full_name, s.scheme_name, a.status, a.apply_date,
 {trunc_days_sql('a.apply_date', as_of_sql())} as days_unassigned
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
where a.officer_id is null and a.status in ('SUBMITTED','UNDER_REVIEW')""")
def q27_unassigned(cat, as_of=None) -> DataFrame:
    """Pending applications with no officer, longest waiting first."""
    now = as_of_col() if as_of is None else as_of_col(as_of)
    return (cat["application"].filter(F.col("officer_id").isNull() & F.col("status").isin(*PENDING))
            .join(_citizens(cat, "full_name"), "citizen_id").join(_schemes(cat, "scheme_name"), "scheme_id")
            .select("application_id", "full_name", "scheme_name", "status", "apply_date",
                    trunc_days("apply_date", now).alias("days_unassigned"))
            .orderBy(D("days_unassigned"), A("application_id")))


def _audit(cat) -> DataFrame:
    from schemelens.operators.triggers import audit_trail
    return audit_trail(cat["status_event"], cat["application"])


def _audit_sql(where: str = "") -> str:
    from schemelens.operators.triggers import AUDIT_TRAIL_SQL
    return f"select * from ({AUDIT_TRAIL_SQL}) t {where}"


@register("q28_audit_history", oracle=_audit_sql(f"where application_id = {Q28_APPLICATION_ID}"))
def q28_audit_history(cat, application_id: int = Q28_APPLICATION_ID) -> DataFrame:
    """Audit trail of one application (filter reaches the scan before the window)."""
    from schemelens.operators.triggers import audit_trail
    ev = cat["status_event"].filter(F.col("application_id") == application_id)
    app = cat["application"].filter(F.col("application_id") == application_id)
    return audit_trail(ev, app).orderBy(A("change_date"), A("audit_id"))


@register("q29_department_budget", oracle="""
select d.department_name, count(s.scheme_id) as total_schemes, cast(sum(p.total_budget) as double) as total_budget,
 cast(sum(p.disbursed_amount) as double) as total_disbursed,
 """ + half_up_sql(paise_sql("sum(p.disbursed_amount)") + " * 100", paise_sql("sum(p.total_budget)"), 2) + """ as utilization_pct
from department d join scheme s on d.department_id = s.department_id join pool p on s.scheme_id = p.scheme_id
group by d.department_name""")
def q29_department_budget(cat) -> DataFrame:
    """Budget, disbursed and utilisation per department."""
    g = (cat.dim("department").join(cat.dim("scheme"), "department_id").join(cat.dim("pool"), "scheme_id")
         .groupBy("department_name")
         .agg(F.count("scheme_id").alias("total_schemes"), F.sum("total_budget").alias("total_budget"),
              F.sum("disbursed_amount").alias("total_disbursed")))
    return (g.select("department_name", "total_schemes", "total_budget", "total_disbursed",
                     half_up(paise("total_disbursed") * 100, paise("total_budget"), 2).alias("utilization_pct"))
            .orderBy(D("total_disbursed")))


@register("q30_end_to_end_report", oracle="""
select c.full_name, c.state, c.category, s.scheme_name, a.status, a.priority_score, a.apply_date, a.approval_date,
 cast(fd.amount as double) as disbursed_amount, fd.transaction_ref
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
left join disbursement fd on a.application_id = fd.application_id""")
def q30_end_to_end_report(cat) -> DataFrame:
    """Citizen, scheme, status and payment of every application."""
    from schemelens.plans.views import application_overview
    return (application_overview(cat, with_officer=False)
            .select("full_name", "state", "category", "scheme_name", "status", "priority_score", "apply_date",
                    "approval_date", "disbursed_amount", "transaction_ref")
            .orderBy(D("priority_score"), A("apply_date"), A("application_id")))


@register("q31_audit_log_all", oracle=_audit_sql())
def q31_audit_log_all(cat) -> DataFrame:
    """The full audit log by change time."""
    return _audit(cat).orderBy(A("change_date"), A("audit_id"))


# ------------------------------------------------------------- r01, r02
def scheme_report(cat) -> DataFrame:
    a = cat["application"].groupBy("scheme_id").agg(
        F.count("application_id").alias("total_apps"),
        F.sum(F.when(F.col("status") == "DISBURSED", 1).otherwise(0)).alias("done"),
        F.sum(F.when(F.col("status").isin(*PENDING), 1).otherwise(0)).alias("pending"),
        F.sum(F.when(F.col("status") == "REJECTED", 1).otherwise(0)).alias("rejected"))
    return (cat.dim("scheme").join(cat.dim("pool"), "scheme_id").join(a, "scheme_id", "left")
            .select("scheme_name", F.substring("scheme_name", 1, 33).alias("short_name"), "scheme_type",
                    "total_budget", "disbursed_amount",
                    (F.col("total_budget") - F.col("disbursed_amount")).alias("remaining"),
                    F.coalesce("total_apps", F.lit(0)).cast("bigint").alias("total_apps"),
                    F.coalesce("done", F.lit(0)).cast("bigint").alias("done"),
                    F.coalesce("pending", F.lit(0)).cast("bigint").alias("pending"),
                    F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected"),
                    half_up(paise("disbursed_amount"), F.lit(10 ** 9), 2).alias("disbursed_cr")))


SCHEME_REPORT_SQL = """select s.scheme_name, substr(s.scheme_name, 1, 33) as short_name, s.scheme_type,
 cast(p.total_budget as double) as total_budget, cast(p.disbursed_amount as double) as disbursed_amount,
 cast(p.total_budget - p.disbursed_amount as double) as remaining,
 cast(count(a.application_id) as bigint) as total_apps,
 cast(sum(case when a.status = 'DISBURSED' then 1 else 0 end) as bigint) as done,
 cast(sum(case when a.status in ('SUBMITTED','UNDER_REVIEW') then 1 else 0 end) as bigint) as pending,
 cast(sum(case when a.status = 'REJECTED' then 1 else 0 end) as bigint) as rejected,
 """ + half_up_sql(paise_sql("p.disbursed_amount"), "1000000000", 2) + """ as disbursed_cr,
 p.total_budget as tb_raw, p.disbursed_amount as db_raw
from scheme s join pool p on s.scheme_id = p.scheme_id left join application a on s.scheme_id = a.scheme_id
group by s.scheme_name, s.scheme_type, p.total_budget, p.disbursed_amount"""


@register("r01_scheme_report", oracle="select * exclude (tb_raw, db_raw) from (" + SCHEME_REPORT_SQL + ") t")
def r01_scheme_report(cat) -> DataFrame:
    """Per-scheme budget, disbursed (also in crore) and application pipeline counts."""
    return scheme_report(cat).orderBy(D("disbursed_amount"))


@register("r02_report_totals", oracle="""
select """ + half_up_sql(paise_sql("sum(tb_raw)"), "1000000000", 1) + """ as total_budget_cr,
 """ + half_up_sql(paise_sql("sum(db_raw)"), "1000000000", 1) + """ as disbursed_cr,
 cast(sum(total_apps) as bigint) as total_apps from (""" + SCHEME_REPORT_SQL + ") t")
def r02_report_totals(cat) -> DataFrame:
    """Grand totals of the scheme report, in crore to one decimal."""
    r = scheme_report(cat)
    return r.agg(half_up(paise(F.sum("total_budget")), F.lit(10 ** 9), 1).alias("total_budget_cr"),
                 half_up(paise(F.sum("disbursed_amount")), F.lit(10 ** 9), 1).alias("disbursed_cr"),
                 F.sum("total_apps").cast("bigint").alias("total_apps"))
