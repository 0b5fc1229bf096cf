"""The three views: application overview, scheme fund status, officer performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import half_up, half_up_sql, paise, paise_sql, seconds_between
from schemelens.registry import register

APPROVED = ("APPROVED", "DISBURSED")
PENDING = ("SUBMITTED", "UNDER_REVIEW")


def budget_status() -> F.Column:
    """Thresholds on the unrounded ratio, compared exactly: d/t >= 0.9 <=> 10d >= 9t."""
    d, t = F.col("disbursed_amount"), F.col("total_budget")
    return (F.when(d * 10 >= t * 9, "CRITICAL").when(d * 2 >= t, "MODERATE").otherwise("HEALTHY"))


BUDGET_STATUS_SQL = ("case when p.disbursed_amount * 10 >= p.total_budget * 9 then 'CRITICAL' "
                     "when p.disbursed_amount * 2 >= p.total_budget then 'MODERATE' else 'HEALTHY' end")


def fund_status(cat) -> DataFrame:
    s = cat.dim("scheme")
    p = cat.dim("pool")
    return (s.join(p, "scheme_id")
            .select("scheme_id", "scheme_name", "scheme_type", "total_budget", "disbursed_amount",
                    (F.col("total_budget") - F.col("disbursed_amount")).alias("remaining_budget"),
                    half_up(paise("disbursed_amount") * 100, paise("total_budget"), 2).alias("utilization_pct"),
                    budget_status().alias("budget_status"), "is_active"))


@register("v02_scheme_fund_status", oracle="""
select s.scheme_id, s.scheme_name, s.scheme_type, cast(p.total_budget as double) as total_budget,
 cast(p.disbursed_amount as double) as disbursed_amount, cast(p.total_budget - p.disbursed_amount as double) as remaining_budget,
 """ + half_up_sql(paise_sql("p.disbursed_amount") + " * 100", paise_sql("p.total_budget"), 2) + """ as utilization_pct,
 """ + BUDGET_STATUS_SQL + """ as budget_status, s.is_active
from scheme s join pool p on s.scheme_id = p.scheme_id
""")
def v02_scheme_fund_status(cat) -> DataFrame:
    """Scheme x pool with remaining budget, utilisation % and health band."""
    return fund_status(cat)


def application_overview(cat, with_officer: bool = True) -> DataFrame:
    a = cat["application"]
    c = cat["citizen"].select("citizen_id", "full_name", "aadhaar_number", "state", "category", "annual_income",
                              "gender", "location_type")
    s = cat.dim("scheme").select("scheme_id", "scheme_name", "scheme_type")
    d = cat["disbursement"].select("application_id", F.col("amount").alias("disbursed_amount"), "transaction_ref")
    out = a.join(c, "citizen_id").join(s, "scheme_id")
    if with_officer:
        o = cat.dim("officer").select("officer_id", "officer_name")
        out = out.join(o, "officer_id", "left")
    return out.join(d, "application_id", "left")


@register("v01_application_flow", oracle="""
select a.application_id, c.full_name, c.aadhaar_number, c.state, c.category, cast(c.annual_income as double) as annual_income,
 c.gender, c.location_type, s.scheme_name, s.scheme_type, a.status, a.apply_date, a.priority_score, a.approval_date,
 o.officer_name, cast(fd.amount as double) as disbursed_amount, fd.transaction_ref
from application a join citizen c on a.citizen_id = c.citizen_id join scheme s on a.scheme_id = s.scheme_id
left join officer o on a.officer_id = o.officer_id left join disbursement fd on a.application_id = fd.application_id
""")
def v01_application_flow(cat) -> DataFrame:
    """Application x citizen x scheme, officer and payment attached (left)."""
    return application_overview(cat).select(
        "application_id", "full_name", "aadhaar_number", "state", "category", "annual_income", "gender",
        "location_type", "scheme_name", "scheme_type", "status", "apply_date", "priority_score", "approval_date",
        "officer_name", "disbursed_amount", "transaction_ref")


def officer_app_stats(cat) -> DataFrame:
    """Applications pre-aggregated by officer (partial aggregation map-side)."""
    a = cat["application"]
    dated = F.col("approval_date").isNotNull()
    return (a.filter(F.col("officer_id").isNotNull())
            .groupBy("officer_id").agg(
                F.count("application_id").alias("handled"),
                F.sum(F.when(F.col("status").isin(*APPROVED), 1).otherwise(0)).alias("approved"),
                F.sum(F.when(F.col("status") == "REJECTED", 1).otherwise(0)).alias("rejected"),
                F.sum(F.when(dated, seconds_between("apply_date", "approval_date"))).alias("dated_seconds"),
                F.count(F.when(dated, F.lit(1))).alias("dated_n")))


def avg_days(sec_col: str = "dated_seconds", n_col: str = "dated_n") -> F.Column:
    """NVL(ROUND(AVG(approval - apply), 1), 0) in days, exact."""
    return F.coalesce(half_up(F.col(sec_col), F.col(n_col) * 86400, 1), F.lit(0.0))


def avg_days_sql(sec: str, n: str) -> str:
    from schemelens.functions.semantics import half_up_sql
    return f"coalesce({half_up_sql(sec, n + ' * 86400', 1)}, 0.0)"


OFFICER_STATS_SQL = """(select officer_id, count(application_id) as handled,
   sum(case when status in ('APPROVED','DISBURSED') then 1 else 0 end) as approved,
   sum(case when status = 'REJECTED' then 1 else 0 end) as rejected,
   sum(case when approval_date is not null then epoch(approval_date) - epoch(apply_date) end) as dated_seconds,
   count(case when approval_date is not null then 1 end) as dated_n
 from application where officer_id is not null group by officer_id)"""


@register("v03_officer_performance", oracle="""
select o.officer_id, o.officer_name, o.assigned_state, d.department_name,
 cast(coalesce(x.handled, 0) as bigint) as total_handled, cast(coalesce(x.approved, 0) as bigint) as approved,
 cast(coalesce(x.rejected, 0) as bigint) as rejected, """ + avg_days_sql("x.dated_seconds", "x.dated_n") + """ as avg_days
from officer o join department d on o.department_id = d.department_id left join """ + OFFICER_STATS_SQL + """ x
 on o.officer_id = x.officer_id
""")
def v03_officer_performance(cat) -> DataFrame:
    """Per officer: handled / approved / rejected counts and average days to decision."""
    o = cat.dim("officer")
    d = cat.dim("department")
    x = officer_app_stats(cat)
    return (o.join(d, "department_id").join(x, "officer_id", "left")
            .select("officer_id", "officer_name", "assigned_state", "department_name",
                    F.coalesce("handled", F.lit(0)).cast("bigint").alias("total_handled"),
                    F.coalesce("approved", F.lit(0)).cast("bigint").alias("approved"),
                    F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected"),
                    avg_days().alias("avg_days")))
