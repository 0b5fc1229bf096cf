"""Batch intake of applications (p03).

The modelled procedure handles one (citizen, scheme, remarks) request per
call and raises on the first failing check.  Processing a whole table of
requests in (requested_at, request_id) order gives exactly these outcomes:

  -20001  citizen missing
  -20002  scheme missing or not active (a NULL flag also fails)
  -20003  an active application exists (stored, or accepted earlier in the batch)
  -20004  eligibility text is not ELIGIBLE
       0  accepted: new SUBMITTED application, priority f03, remarks or 'Self-applied'

Checks 1, 2 and 4 depend only on the (citizen, scheme) pair, so within a pair
with no stored active application the first request is accepted when the pair
is eligible and every later one gets -20003; an ineligible pair gets -20004
throughout.  So one aggregate makes the distinct pairs (first request, active
application or not; partial aggregation keeps a hot pair cheap), everything is
looked up once per pair, and the requests join their pair's row: no sequential
step, and AQE can split a pair that holds a large share of the requests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import cat as ocat
from schemelens.functions.semantics import time_id_key
from schemelens.registry import register

DEFAULT_REMARKS = "Self-applied"
# New applications take id = max(stored id) + request id: above every stored id, unique
# per request, and deterministic (a retried batch produces the same keys).


PAIR = ("citizen_id", "scheme_id")


def requested_pairs(requests: DataFrame, application: DataFrame, time_col="requested_at",
                    id_col="request_id") -> DataFrame:
    """One row per requested pair: ``_first`` (time and id key of its first request) and
    ``_active`` (true when an active application is stored, else NULL), in one shuffle."""
    asked = requests.select(*PAIR, time_id_key(time_col, id_col).alias("_first"), F.lit(None).cast("boolean").alias("_active"))
    # a NULL id equals nothing, so such applications are nobody's duplicate
    held = (application.filter(R.is_active_status()).dropna(subset=list(PAIR))
            .select(*PAIR, F.lit(None).cast("decimal(38,0)").alias("_first"), F.lit(True).alias("_active")))
    return (asked.unionByName(held).groupBy(*PAIR).agg(F.min("_first").alias("_first"), F.max("_active").alias("_active"))
            .filter(F.col("_first").isNotNull()))


def join_pairs(rows: DataFrame, per_pair: DataFrame, keys: tuple = PAIR) -> DataFrame:
    """Attach the columns of ``per_pair`` (unique per pair, or per other ``keys``) to all ``rows`` of the pair.

    A NULL-safe join shuffles on its own expressions, so the aggregated side is
    shuffled anew instead of lying in its aggregate's partitions: both sides are
    then plain shuffles, which AQE needs to split a skewed pair."""
    side = per_pair.withColumnsRenamed({c: f"_pair_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_pair_{c}")) for c in keys])
    return rows.join(side, same, "left").drop(*[f"_pair_{c}" for c in keys])


def apply_batch(requests: DataFrame, cat) -> DataFrame:
    pairs = R.rule_inputs(requested_pairs(requests, cat["application"]), cat, citizen_extra=("full_name",),
                          scheme_extra=("scheme_name",))
    pairs = pairs.select(*PAIR, "_first", "_active", "_c_found", "_s_found", "is_active", "full_name", "scheme_name",
                         R.eligibility_reason().alias("_elig"), R.priority_score().alias("_priority"))
    q = join_pairs(requests.select("request_id", *PAIR, "remarks", "requested_at"), pairs)
    q = q.withColumn("_is_first", time_id_key("requested_at", "request_id") == F.col("_first"))
    elig = F.col("_elig")
    code = (F.when(F.col("_c_found").isNull(), F.lit(-20001))
            .when(F.col("_s_found").isNull() | ~F.coalesce(F.col("is_active") == "Y", F.lit(False)), F.lit(-20002))
            .when(F.col("_active").isNotNull(), F.lit(-20003))
            .when(elig != R.ELIGIBLE, F.lit(-20004))
            .when(F.col("_is_first"), F.lit(0))
            .otherwise(F.lit(-20003)))
    q = q.withColumn("outcome_code", code)
    msg = (F.when(F.col("outcome_code") == -20001,
                  ocat("Citizen ID ", F.col("citizen_id").cast("string"), " does not exist"))
           .when(F.col("outcome_code") == -20002, F.lit("Scheme not found or inactive"))
           .when(F.col("outcome_code") == -20003,
                 ocat(F.col("full_name"), " already has an active application for ", F.col("scheme_name")))
           .when(F.col("outcome_code") == -20004, ocat("Eligibility check failed: ", F.col("_elig")))
           .otherwise(F.lit("SUBMITTED")))
    ok = F.col("outcome_code") == 0
    # scalar subquery (one aggregate row, evaluated once), not a join
    max_id = F.coalesce(cat["application"].select(F.max("application_id")).scalar(), F.lit(0))
    return q.select(
        "request_id", "citizen_id", "scheme_id", "outcome_code", msg.alias("message"),
        F.when(ok, max_id + F.col("request_id")).alias("application_id"),
        F.when(ok, F.col("_priority")).alias("priority_score"),
        F.when(ok, F.coalesce(F.nullif(F.col("remarks"), F.lit("")), F.lit(DEFAULT_REMARKS))).alias("remarks"))


APPLY_BATCH_SQL = """select request_id, citizen_id, scheme_id, code as outcome_code,
 case code when -20001 then concat('Citizen ID ', cast(citizen_id as varchar), ' does not exist')
  when -20002 then 'Scheme not found or inactive'
  when -20003 then concat(full_name, ' already has an active application for ', scheme_name)
  when -20004 then concat('Eligibility check failed: ', elig) else 'SUBMITTED' end as message,
 case when code = 0 then coalesce((select max(application_id) from application), 0) + request_id end as application_id,
 case when code = 0 then prio end as priority_score,
 case when code = 0 then coalesce(nullif(remarks, ''), 'Self-applied') end as remarks
from (select *, case when cid is null then -20001 when sid is null or coalesce(is_active, '') <> 'Y' then -20002
   when act then -20003 when elig <> 'ELIGIBLE' then -20004 when rn = 1 then 0 else -20003 end as code
 from (select q.request_id, q.citizen_id, q.scheme_id, q.remarks, q.rn, c.citizen_id as cid, s.scheme_id as sid,
   s.is_active, c.full_name, s.scheme_name, """ + R.priority_score_sql("c") + """ as prio,
   """ + R.eligibility_reason_sql("c", "s", "r") + """ as elig,
   exists (select 1 from application a where a.citizen_id = q.citizen_id and a.scheme_id = q.scheme_id
           and a.status not in ('REJECTED')) as act
  from (select *, row_number() over (partition by citizen_id, scheme_id order by requested_at, request_id) as rn
        from application_request) q
  left join citizen c on q.citizen_id = c.citizen_id left join scheme s on q.scheme_id = s.scheme_id
  left join """ + R.RULES_BY_SCHEME_SQL + """ r on q.scheme_id = r.scheme_id) x) y"""


@register("p03_apply_batch", oracle=APPLY_BATCH_SQL)
def p03_apply_batch(cat) -> DataFrame:
    """Outcome of every intake request, as if applied one by one in time order."""
    return apply_batch(cat["application_request"], cat)
