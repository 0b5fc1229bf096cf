"""Batch processing of officer decisions (p04).

The modelled procedure takes one (application, officer, action) per call,
locks the application, and either approves (pays the benefit out of the
scheme pool) or rejects; any error rolls the call back.  For a table of
decision requests processed in (requested_at, request_id) order this job
returns each request's outcome without a sequential loop:

1. Static checks per request: application exists, initial status pending,
   officer NULL or known, action APPROVE / REJECT (case-insensitive), and for
   APPROVE a pool row, a positive benefit and no stored payment.
2. An application is a state machine that starts open: a valid REJECT takes it
   to rejected, a valid APPROVE to claimed, and it stays there.  The state
   before each request is a running state over pieces of the requests
   (``ordered.running_state``), so an application with most of the requests is
   many pieces.  A valid APPROVE that finds its application open is a claim on
   the scheme pool; repeated approvals cannot succeed later (the budget only
   shrinks and the benefit is the same), so it is the application's only claim.
3. Claims are allocated per scheme in request order with the exact greedy
   allocation of ``allocation.allocate``.  A granted claim is terminal;
   a refused one leaves tR (if any) as terminal.
4. Requests after their application's terminal request fail with -20010
   (the status check precedes every other check).  An APPROVE that is
   neither granted nor late fails with -20011 when the budget left at its
   position (opening balance minus grants before it, a skew-safe per-scheme
   running sum over grants and such requests) is below the benefit, else
   with the payment constraint error.

Outcome codes: 0 done; -1403 no data found; -20010 already processed;
-2291 unknown officer; -20012 invalid action; -20011 insufficient funds;
-1400 NULL amount; -2290 amount not positive; -1 payment already exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import cat as ocat
from schemelens.functions.semantics import checkpoint_table, oracle_num, padded_id
from schemelens.operators import ordered
from schemelens.operators.allocation import allocate
from schemelens.operators.intake import join_pairs
from schemelens.plans.views import PENDING
from schemelens.registry import register

REJECT_REASON = "Rejected during officer review"
REJECTED, DISBURSED = "REJECTED", "DISBURSED"  # the states a decision leads to


def _ord() -> list:
    return [F.col("requested_at"), F.col("request_id")]


def stored_pool(cat) -> DataFrame:
    """The pools as a stored table: deriving them reads all disbursements, and the batch looks them up several times."""
    if cat.warehouse is not None:
        return cat.dim("pool")
    if "pool" not in cat.memo:
        cat.memo["pool"] = checkpoint_table(cat["pool"])
    return cat.small(cat.memo["pool"], "pool")


def requested_applications(decisions: DataFrame, cat) -> DataFrame:
    """One row per requested application that is stored: what the checks need of it, its pool and its benefit."""
    app = cat["application"].select("application_id", "citizen_id", "scheme_id",
                                    F.col("status").alias("init_status"), F.lit(True).alias("_app"))
    pool = stored_pool(cat).select("scheme_id", (F.col("total_budget") - F.col("disbursed_amount")).alias("_rem0"),
                                  F.lit(True).alias("_pool"))
    paid = cat["disbursement"].select("application_id").distinct().withColumn("_paid", F.lit(True))
    asked = decisions.select("application_id").distinct()
    apps = app.join(asked, "application_id").join(paid, "application_id", "left").join(pool, "scheme_id", "left")
    return R.rule_inputs(apps, cat, need_rules=False).select(
        "application_id", "scheme_id", "init_status", "_app", "_paid", "_rem0", "_pool", R.benefit_amount().alias("benefit"))


def decide_batch(decisions: DataFrame, cat) -> DataFrame:
    officers = cat.dim("officer").select("officer_id", F.lit(True).alias("_off"))
    act = F.upper(F.col("action"))
    r = decisions.select("request_id", "application_id", "officer_id", "action", "requested_at",
                         F.nullif(F.col("remarks"), F.lit("")).alias("_remarks"))
    r = join_pairs(r, requested_applications(decisions, cat), ("application_id",)).join(officers, "officer_id", "left")
    r = (r.withColumn("_act", act)
         .withColumn("_pend", F.coalesce(F.col("init_status").isin(*PENDING), F.lit(True)))
         .withColumn("_officer_ok", F.col("officer_id").isNull() | F.col("_off").isNotNull())
         .withColumn("_base_ok", F.col("_app").isNotNull() & F.col("_pend") & F.col("_officer_ok")
                     & F.coalesce(act.isin("APPROVE", "REJECT"), F.lit(False)))
         .withColumn("_asks", F.when(~F.col("_base_ok"), None).when(act == "REJECT", F.lit(REJECTED))
                     .when(F.col("_pool").isNotNull() & (F.col("benefit") > 0) & F.col("_paid").isNull(),
                           F.lit(DISBURSED))))
    # the enriched requests feed the branches below: they are written once, in pieces, to the
    # shared checkpoint folder (only the columns used later)
    r = ordered.in_pieces(r.select(
        "request_id", "application_id", "officer_id", "action", "requested_at", "scheme_id", "init_status", "_app",
        "_rem0", "_pool", "benefit", "_act", "_pend", "_officer_ok", "_asks", "_remarks"), "application_id", _ord())

    # claims, grants and the states after them each feed two branches too
    claims = checkpoint_table(
        ordered.running_state(r, "application_id", _ord(), "_asks", "_before")
        .filter((F.col("_asks") == DISBURSED) & F.col("_before").isNull())
        .select("request_id", "scheme_id", "requested_at", F.col("benefit").alias("amount")))
    budgets = stored_pool(cat).select("scheme_id", (F.col("total_budget") - F.col("disbursed_amount")).alias("_rem"))
    alloc = allocate(claims, budgets, "scheme_id", "request_id", "amount", _ord(), catalog=cat)
    grants = checkpoint_table(alloc.filter("granted").select("request_id", F.lit(True).alias("_granted")))

    r = r.join(grants, "request_id", "left")
    move = F.when((F.col("_asks") == REJECTED) | F.col("_granted"), F.col("_asks"))
    r = checkpoint_table(ordered.running_state(r.withColumn("_move", move), "application_id", _ord(), "_move", "_before")
                         .drop(ordered.PIECE))

    late = F.col("_before").isNotNull()
    is_term = F.col("_before").isNull() & F.col("_move").isNotNull()
    reach6 = (F.col("_app").isNotNull() & F.col("_pend") & ~late & ~is_term & F.col("_officer_ok")
              & (F.col("_act") == "APPROVE") & F.col("_pool").isNotNull())

    # budget left at the position of every APPROVE that reaches the funds check
    granted_rows = (claims.join(grants, "request_id")
                    .select("scheme_id", "requested_at", "request_id", F.col("amount").alias("_v"),
                            F.lit(False).alias("_q")))
    queries = r.filter(reach6).select("scheme_id", "requested_at", "request_id",
                                      F.lit(0).cast(granted_rows.schema["_v"].dataType).alias("_v"),
                                      F.lit(True).alias("_q"))
    spent = ordered.running_sum(granted_rows.unionByName(queries), "scheme_id", _ord(), "_v", "_spent")
    spent = spent.filter("_q").select("request_id", "_spent")
    r = r.join(spent, "request_id", "left").withColumn("_rem_at", F.col("_rem0") - F.col("_spent"))

    code = (F.when(F.col("_app").isNull(), F.lit(-1403))
            .when(~F.col("_pend"), F.lit(-20010))
            .when(late, F.lit(-20010))
            .when(is_term, F.lit(0))
            .when(~F.col("_officer_ok"), F.lit(-2291))
            .when(~F.coalesce(F.col("_act").isin("APPROVE", "REJECT"), F.lit(False)), F.lit(-20012))
            .when(F.col("_pool").isNull(), F.lit(-1403))
            .when(F.col("_rem_at") < F.col("benefit"), F.lit(-20011))
            .when(F.col("benefit").isNull(), F.lit(-1400))
            .when(F.col("benefit") <= 0, F.lit(-2290))
            .otherwise(F.lit(-1)))
    r = r.withColumn("outcome_code", code)
    status_now = F.when(~F.col("_pend"), F.col("init_status")).otherwise(F.col("_before"))
    c = F.col("outcome_code")
    msg = (F.when(c == 0, F.when(F.col("_act") == "APPROVE", ocat("Approved. Disbursed Rs.", oracle_num("benefit")))
                  .otherwise(ocat("Application ", F.col("application_id").cast("string"), " rejected.")))
           .when(c == -1403, F.lit("no data found"))
           .when(c == -20010, ocat("Application already processed. Status: ", status_now))
           .when(c == -2291, F.lit("integrity constraint violated - parent key not found"))
           .when(c == -20012, F.lit("Invalid action. Use APPROVE or REJECT"))
           .when(c == -20011, ocat("Insufficient funds in scheme pool. Available: Rs.", oracle_num("_rem_at")))
           .when(c == -1400, F.lit("cannot insert NULL into amount"))
           .when(c == -2290, F.lit("check constraint violated: amount > 0"))
           .otherwise(F.lit("unique constraint violated: application_id")))
    ok = c == 0
    return r.select(
        "request_id", "application_id", "officer_id", "action", "requested_at", "outcome_code", msg.alias("message"),
        F.when(ok, F.col("_move")).alias("new_status"),
        F.when(ok & (F.col("_act") == "APPROVE"), F.col("benefit")).alias("paid_amount"),
        F.when(ok & (F.col("_act") == "REJECT"), F.coalesce("_remarks", F.lit(REJECT_REASON)))
        .alias("rejection_reason"), F.col("_remarks").alias("remarks"))


def _p04_sql() -> str:
    """Oracle: the procedure run request by request, per scheme, in time order.
    The recursion carries the pool remainder and the applications already
    decided (DuckDB lists); requests for unknown applications are separate."""
    from schemelens.functions.semantics import oracle_num_sql
    ben = ("case when c.citizen_id is null or s.scheme_id is null then 0 when s.max_benefit_amount is null then null "
           "else " + R.benefit_amount_sql("c", "s") + " end")
    return """with recursive q as (
 select d.request_id, d.application_id, d.officer_id, d.action, d.requested_at, nullif(d.remarks, '') as remarks, a.scheme_id, a.status as init_status,
  upper(d.action) as act, (d.officer_id is null or o.officer_id is not null) as officer_ok, p.scheme_id is not null as has_pool,
  """ + ben + """ as benefit,
  exists (select 1 from disbursement fd where fd.application_id = d.application_id) as paid,
  row_number() over (partition by a.scheme_id order by d.requested_at, d.request_id) as rn
 from decision_request d join application a on d.application_id = a.application_id
 left join officer o on d.officer_id = o.officer_id left join pool p on a.scheme_id = p.scheme_id
 left join citizen c on a.citizen_id = c.citizen_id left join scheme s on a.scheme_id = s.scheme_id),
walk(scheme_id, rn, rem, done_ids, done_sts, request_id, st, code, benefit, act, application_id, rem_before) as (
 select x.scheme_id, cast(0 as bigint), p.total_budget - p.disbursed_amount, cast([] as bigint[]), cast([] as varchar[]),
  cast(null as bigint), cast(null as varchar), cast(null as integer), cast(null as decimal(12,2)), cast(null as varchar),
  cast(null as bigint), cast(null as decimal(16,2))
 from (select distinct scheme_id from q) x left join pool p on x.scheme_id = p.scheme_id
 union all
 select scheme_id, rn,
  case when code = 0 and act = 'APPROVE' then rem - benefit else rem end,
  case when code = 0 then list_append(done_ids, application_id) else done_ids end,
  case when code = 0 then list_append(done_sts, case when act = 'APPROVE' then 'DISBURSED' else 'REJECTED' end) else done_sts end,
  request_id, st, code, benefit, act, application_id, rem
 from (select w.scheme_id, q.rn, w.rem, w.done_ids, w.done_sts, q.request_id, q.benefit, q.act, q.application_id, t.st,
   case when t.st not in ('SUBMITTED','UNDER_REVIEW') then -20010
    when not q.officer_ok then -2291
    when q.act is null or q.act not in ('APPROVE','REJECT') then -20012
    when q.act = 'REJECT' then 0
    when not q.has_pool then -1403
    when w.rem < q.benefit then -20011
    when q.benefit is null then -1400
    when q.benefit <= 0 then -2290
    when q.paid then -1
    else 0 end as code
  from walk w join q on q.scheme_id is not distinct from w.scheme_id and q.rn = w.rn + 1,
   lateral (select case when list_contains(w.done_ids, q.application_id)
                   then list_extract(w.done_sts, list_position(w.done_ids, q.application_id)) else q.init_status end as st) t) z),
res as (
 select q.request_id, q.application_id, q.officer_id, q.action, q.requested_at, w.code as outcome_code, w.st, w.benefit,
  w.act, w.rem_before, q.remarks from walk w join q on w.request_id = q.request_id
 union all
 select d.request_id, d.application_id, d.officer_id, d.action, d.requested_at, -1403, null, null, upper(d.action), null, nullif(d.remarks, '')
 from decision_request d where not exists (select 1 from application a where a.application_id = d.application_id))
select request_id, application_id, officer_id, action, requested_at, outcome_code,
 case outcome_code when 0 then case when act = 'APPROVE' then concat('Approved. Disbursed Rs.', """ + oracle_num_sql("benefit") + """)
                               else concat('Application ', cast(application_id as varchar), ' rejected.') end
  when -1403 then 'no data found' when -20010 then concat('Application already processed. Status: ', st)
  when -2291 then 'integrity constraint violated - parent key not found'
  when -20012 then 'Invalid action. Use APPROVE or REJECT'
  when -20011 then concat('Insufficient funds in scheme pool. Available: Rs.', """ + oracle_num_sql("rem_before") + """)
  when -1400 then 'cannot insert NULL into amount' when -2290 then 'check constraint violated: amount > 0'
  else 'unique constraint violated: application_id' end as message,
 case when outcome_code = 0 then case when act = 'APPROVE' then 'DISBURSED' else 'REJECTED' end end as new_status,
 case when outcome_code = 0 and act = 'APPROVE' then cast(benefit as double) end as paid_amount,
 case when outcome_code = 0 and act = 'REJECT' then coalesce(remarks, '""" + REJECT_REASON + """') end as rejection_reason, remarks
from res"""


@register("p04_decide_batch", oracle=_p04_sql())
def p04_decide_batch(cat) -> DataFrame:
    """Outcome of every officer decision request, as if processed one by one in time order."""
    return decide_batch(cat["decision_request"], cat)


# ------------------------------------------------------------ side effects
def stored_outcomes(cat) -> DataFrame:
    """Outcomes of the decision batch, written once to the shared folder and read by each of its effects."""
    if "outcomes" not in cat.memo:
        cat.memo["outcomes"] = checkpoint_table(p04_decide_batch(cat))
    return cat.memo["outcomes"]


def decision_effects(outcomes: DataFrame, cat) -> dict[str, DataFrame]:
    """What the successful decisions write: payment rows (approvals), the
    application updates, the audit rows of the status trigger and the pool
    balances after the ledger trigger."""
    from schemelens.operators.triggers import CHANGED_BY, pool_ledger
    done = outcomes.filter(F.col("outcome_code") == 0)
    app = cat["application"].select("application_id", "citizen_id", "scheme_id", F.col("status").alias("old_status"))
    bank = cat["citizen"].select("citizen_id", "bank_account")
    payments = (done.filter(F.col("new_status") == "DISBURSED").join(app, "application_id").join(bank, "citizen_id")
                .select(F.col("application_id").alias("disbursement_id"), "application_id", "scheme_id",
                        F.col("paid_amount").alias("amount"), F.col("requested_at").alias("disbursement_date"),
                        F.lit("DBT").alias("payment_mode"),
                        F.concat(F.lit("TXN"), F.date_format("requested_at", "yyyyMMdd"),
                                 padded_id("application_id")).alias("transaction_ref"),
                        "bank_account", F.lit("PROCESSED").alias("status")))
    # an approval keeps the stored rejection reason, a rejection the stored remarks
    stored = cat["application"].select("application_id", F.col("remarks").alias("_remarks"),
                                       F.col("rejection_reason").alias("_reason"))
    approved = F.col("new_status") == "DISBURSED"
    updates = done.join(stored, "application_id").select(
        "application_id", F.col("new_status").alias("status"), "officer_id",
        F.col("requested_at").alias("approval_date"),
        F.when(approved, F.col("_reason")).otherwise(F.col("rejection_reason")).alias("rejection_reason"),
        F.when(approved, F.coalesce("remarks", "_remarks")).otherwise(F.col("_remarks")).alias("remarks"))
    audit = (done.join(app, "application_id")
             .select(F.col("request_id").alias("audit_id"), "application_id", "old_status",
                     F.col("new_status"), F.lit(CHANGED_BY).alias("changed_by"),
                     F.col("requested_at").alias("change_date")))
    pools = pool_ledger(cat["pool"], payments, cat["application"])
    return {"payments": payments, "updates": updates, "audit": audit, "pools": pools}


def _payments_sql() -> str:
    """Oracle: payments of the replayed decisions, amounts as decimals."""
    return f"""(select r.application_id as disbursement_id, r.application_id, a.scheme_id,
 cast(r.paid_amount as decimal(12,2)) as amount, r.requested_at as disbursement_date, 'DBT' as payment_mode,
 'TXN' || strftime(r.requested_at, '%Y%m%d') || lpad(cast(r.application_id as varchar), cast(greatest(length(cast(r.application_id as varchar)), 8) as int), '0') as transaction_ref,
 c.bank_account, 'PROCESSED' as status
 from ({_p04_sql()}) r join application a on r.application_id = a.application_id join citizen c on a.citizen_id = c.citizen_id
 where r.outcome_code = 0 and r.new_status = 'DISBURSED')"""


@register("p04b_decision_payments", oracle=f"""select disbursement_id, application_id, scheme_id, cast(amount as double) as amount,
 disbursement_date, payment_mode, transaction_ref, bank_account, status from {_payments_sql()} t""")
def p04b_decision_payments(cat) -> DataFrame:
    """Payment rows written by the granted approvals of the decision batch."""
    return decision_effects(stored_outcomes(cat), cat)["payments"]


@register("p04c_pools_after_decisions", oracle=f"""select p.scheme_id, cast(p.total_budget as double) as total_budget,
 cast(p.disbursed_amount as double) as opening_disbursed, cast(coalesce(x.n, 0) as bigint) as payments,
 cast(coalesce(x.amt, 0) as double) as added_amount, cast(p.disbursed_amount + coalesce(x.amt, 0) as double) as closing_disbursed, x.last_updated
from pool p left join (select scheme_id, sum(amount) as amt, count(*) as n, max(disbursement_date) as last_updated
 from {_payments_sql()} t group by scheme_id) x
 on p.scheme_id = x.scheme_id""")
def p04c_pools_after_decisions(cat) -> DataFrame:
    """Pool balances after the decision batch's payments fire the ledger trigger."""
    return decision_effects(stored_outcomes(cat), cat)["pools"]


@register("p04d_application_updates", oracle=f"""select r.application_id, r.new_status as status, r.officer_id, r.requested_at as approval_date,
 case when r.new_status = 'REJECTED' then r.rejection_reason else a.rejection_reason end as rejection_reason,
 case when r.new_status = 'DISBURSED' then coalesce(r.remarks, a.remarks) else a.remarks end as remarks
from ({_p04_sql()}) r join application a on r.application_id = a.application_id where r.outcome_code = 0""")
def p04d_application_updates(cat) -> DataFrame:
    """Application rows as the successful decisions leave them."""
    return decision_effects(stored_outcomes(cat), cat)["updates"]


@register("p04e_decision_audit", oracle=f"""select r.request_id as audit_id, r.application_id, a.status as old_status, r.new_status,
 'APP_USER' as changed_by, r.requested_at as change_date
from ({_p04_sql()}) r join application a on r.application_id = a.application_id where r.outcome_code = 0""")
def p04e_decision_audit(cat) -> DataFrame:
    """Audit rows that the status trigger writes for the successful decisions."""
    return decision_effects(stored_outcomes(cat), cat)["audit"]
