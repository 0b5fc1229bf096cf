"""Rules f01..f05 evaluated set-based over request / application pairs.

The modelled functions take one (citizen, scheme) id pair per call; here a
whole table of pairs is evaluated with one join per lookup table and a
Catalyst ``when`` chain.  Pairs come from data (intake requests), so the
work grows with the tables.  An all-citizens x all-schemes matrix is not
materialised: it is a cross product, and every caller of the rules works
on concrete request pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import half_up_sql, paise_sql
from schemelens.registry import register

_REQ_JOIN_SQL = """from application_request q left join citizen c on q.citizen_id = c.citizen_id
 left join scheme s on q.scheme_id = s.scheme_id left join """ + R.RULES_BY_SCHEME_SQL + """ r on q.scheme_id = r.scheme_id"""


def eligibility_of(pairs: DataFrame, cat) -> DataFrame:
    """Attach the eligibility text to (citizen_id, scheme_id) pairs."""
    cols = pairs.columns
    return R.rule_inputs(pairs, cat).select(*cols, R.eligibility_reason().alias("eligibility"))


@register("f01_check_eligibility", oracle="select q.request_id, q.citizen_id, q.scheme_id, "
          + R.eligibility_reason_sql("c", "s", "r") + " as eligibility " + _REQ_JOIN_SQL)
def f01_check_eligibility(cat) -> DataFrame:
    """Eligibility text (first failing rule) for every intake request pair."""
    return eligibility_of(cat["application_request"].select("request_id", "citizen_id", "scheme_id"), cat)


REASON_CODE_SQL = """case when e = 'ELIGIBLE' then 'ELIGIBLE' when e = '{nf}' then 'NOT_FOUND' when e = '{ina}' then 'INACTIVE'
 when e like 'ERROR%' then 'ERROR' when e like 'INELIGIBLE: Age%' then 'AGE' when e like '%exceeds limit%' then 'MAX_INCOME'
 when e like '%below minimum Rs.%' then 'MIN_INCOME' when e like 'INELIGIBLE: Category%' then 'CATEGORY'
 when e like 'INELIGIBLE: Scheme is for%' then 'LOCATION' when e like 'INELIGIBLE: Scheme is restricted%' then 'GENDER'
 when e like 'INELIGIBLE: Land%' then 'LAND' else 'OTHER' end""".format(nf=R.NOT_FOUND, ina=R.INACTIVE)


@register("f01c_ineligibility_reason_counts", oracle="select scheme_id, " + REASON_CODE_SQL
          + " as reason_code, count(*) as pairs from (select q.scheme_id, " + R.eligibility_reason_sql("c", "s", "r")
          + " as e " + _REQ_JOIN_SQL + ") t group by all")
def f01c_ineligibility_reason_counts(cat) -> DataFrame:
    """Requests per scheme and first-failing-rule code."""
    e = f01_check_eligibility(cat)
    return e.groupBy("scheme_id", R.reason_code().alias("reason_code")).agg(F.count(F.lit(1)).alias("pairs"))


@register("f02_calculate_benefit", oracle="select q.request_id, q.citizen_id, q.scheme_id, cast(case when c.citizen_id is null "
          "or s.scheme_id is null then 0 when s.max_benefit_amount is null then null else " + R.benefit_amount_sql("c", "s")
          + " end as double) as benefit " + _REQ_JOIN_SQL)
def f02_calculate_benefit(cat) -> DataFrame:
    """Benefit amount for every request pair (0 when citizen or scheme is unknown)."""
    pairs = cat["application_request"].select("request_id", "citizen_id", "scheme_id")
    return R.rule_inputs(pairs, cat, need_rules=False).select(
        "request_id", "citizen_id", "scheme_id", R.benefit_amount().alias("benefit"))


@register("f03_priority_score", oracle="select q.request_id, q.citizen_id, case when c.citizen_id is null then 0 else "
          + R.priority_score_sql("c") + " end as priority_score from application_request q left join citizen c "
          "on q.citizen_id = c.citizen_id")
def f03_priority_score(cat) -> DataFrame:
    """Priority score of each requesting citizen (0 when unknown)."""
    cz = cat["citizen"].select("citizen_id", *R.CITIZEN_RULE_COLUMNS, F.lit(True).alias("_c_found"))
    return (cat["application_request"].select("request_id", "citizen_id").join(cz, "citizen_id", "left")
            .select("request_id", "citizen_id", R.priority_score().alias("priority_score")))


@register("f04_is_duplicate_app", oracle="""select q.request_id, q.citizen_id, q.scheme_id,
 case when exists (select 1 from application a where a.citizen_id = q.citizen_id and a.scheme_id = q.scheme_id
   and a.status not in ('REJECTED')) then 'Y' else 'N' end as is_duplicate from application_request q""")
def f04_is_duplicate_app(cat) -> DataFrame:
    """'Y' when the requesting citizen already has an active application to the scheme."""
    from schemelens.operators.intake import join_pairs
    act = R.active_keys(cat["application"]).dropna().withColumn("_dup", F.lit(True))
    return (join_pairs(cat["application_request"].select("request_id", "citizen_id", "scheme_id"), act)
            .select("request_id", "citizen_id", "scheme_id",
                    F.when(F.col("_dup"), "Y").otherwise("N").alias("is_duplicate")))


@register("f04b_duplicate_active_groups", oracle="""select citizen_id, scheme_id, count(*) as active_count from application
 where status not in ('REJECTED') group by citizen_id, scheme_id having count(*) > 1""")
def f04b_duplicate_active_groups(cat) -> DataFrame:
    """(citizen, scheme) pairs holding more than one active application."""
    return (cat["application"].filter(R.is_active_status()).groupBy("citizen_id", "scheme_id")
            .agg(F.count(F.lit(1)).alias("active_count")).filter(F.col("active_count") > 1))


@register("f05_scheme_utilization", oracle="""select s.scheme_id, case when p.total_budget is null or p.total_budget = 0 then 0.0
 else """ + half_up_sql(paise_sql("p.disbursed_amount") + " * 100", paise_sql("p.total_budget"), 2) + """ end as utilization_pct
 from scheme s left join pool p on s.scheme_id = p.scheme_id""")
def f05_scheme_utilization(cat) -> DataFrame:
    """Utilisation % of every scheme's pool (0 without pool or budget)."""
    return (cat.dim("scheme").select("scheme_id").join(cat.dim("pool"), "scheme_id", "left")
            .select("scheme_id", R.utilization_pct().alias("utilization_pct")))
