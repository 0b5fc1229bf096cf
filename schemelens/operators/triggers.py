"""Change-driven jobs, batch form: audit trail (t01), pool ledger (t02, t02b)
and the duplicate-application guard (t03).

The modelled system runs these as synchronous row triggers.  Here each one is
a set-based job over a table of change events processed in arrival order
(event time, then event id); the streaming forms live in
``schemelens.streaming``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions.semantics import time_id_key
from schemelens.operators import ordered
from schemelens.registry import register

CHANGED_BY = "APP_USER"  # the session user recorded by the audit trigger


def audit_trail(status_event: DataFrame, application: DataFrame, changed_by: str = CHANGED_BY) -> DataFrame:
    """One audit row per status change of an existing application.

    old_status is the previous change's new status for that application
    (its stored status before the first change).  Changes for unknown applications
    update no row and therefore leave no audit row.  The per-application lag is
    skew-safe (one application may carry any share of the events).
    """
    ev = status_event.join(application.select("application_id", F.col("status").alias("_stored")), "application_id")
    ev = ordered.lag(ev, "application_id", ["change_date", "event_id"], "new_status", "old_status",
                     default=F.col("_stored"))
    return ev.select(F.col("event_id").alias("audit_id"), "application_id", "old_status", "new_status",
                     F.lit(changed_by).alias("changed_by"), "change_date")


AUDIT_TRAIL_SQL = f"""select e.event_id as audit_id, e.application_id,
 case when row_number() over w = 1 then a.status else lag(e.new_status) over w end as old_status,
 e.new_status, '{CHANGED_BY}' as changed_by, e.change_date
from status_event e join application0 a on e.application_id = a.application_id
window w as (partition by e.application_id order by e.change_date, e.event_id)"""


@register("t01_audit_trail", oracle=AUDIT_TRAIL_SQL)
def t01_audit_trail(cat) -> DataFrame:
    """Audit rows (old -> new status) for every status change event."""
    return audit_trail(cat["status_event"], cat["application"])


# ------------------------------------------------------------------ t02
def pool_ledger(pool: DataFrame, payments: DataFrame, application: DataFrame) -> DataFrame:
    """Pools after applying payment inserts: disbursed += amount per scheme, last_updated = date of the latest of them.

    A payment's date is its insert time by default, so it stands for the clock of the modelled trigger; pools
    without new payments have no ``last_updated`` here.
    Every inserted payment counts (FAILED too); a payment whose application
    is unknown updates nothing.  Payments are aggregated per scheme before the
    join (map-side partial sums), so a scheme holding most payments costs one
    row of shuffle per partition.
    """
    return closing_pools(pool, payment_totals(payments, application))


def payment_totals(payments: DataFrame, application: DataFrame) -> DataFrame:
    """Sum, number and latest date of payments per scheme; also over a stream of payments."""
    return (payments.select("application_id", "amount", "disbursement_date")
            .join(application.select("application_id", "scheme_id"), "application_id")
            .groupBy("scheme_id").agg(F.sum("amount").alias("added_amount"), F.count(F.lit(1)).alias("payments"),
                                      F.max("disbursement_date").alias("last_updated")))


def closing_pools(pool: DataFrame, totals: DataFrame) -> DataFrame:
    return (pool.join(totals, "scheme_id", "left")
            .select("scheme_id", "total_budget", F.col("disbursed_amount").alias("opening_disbursed"),
                    F.coalesce("payments", F.lit(0)).cast("bigint").alias("payments"),
                    F.coalesce("added_amount", F.lit(0)).cast("decimal(25,2)").alias("added_amount"),
                    (F.col("disbursed_amount") + F.coalesce("added_amount", F.lit(0))).cast("decimal(25,2)")
                    .alias("closing_disbursed"), "last_updated"))


def _new_payments(cat) -> DataFrame:
    from schemelens.operators.payments import payment_run
    return payment_run(cat)[0]


def _new_payments_sql() -> str:
    from schemelens.operators.payments import PAYMENT_RUN_SQL
    return f"(select * from ({PAYMENT_RUN_SQL}) pr where amount > 0)"


@register("t02_pool_ledger", oracle="""select p.scheme_id, cast(p.total_budget as double) as total_budget,
 cast(p.disbursed_amount as double) as opening_disbursed, cast(coalesce(x.n, 0) as bigint) as payments,
 cast(coalesce(x.amt, 0) as double) as added_amount, cast(p.disbursed_amount + coalesce(x.amt, 0) as double) as closing_disbursed, x.last_updated
from pool p left join (select a.scheme_id, sum(np.amount) as amt, count(*) as n, max(np.disbursement_date) as last_updated from """ + "{NEW_PAYMENTS}" + """ np
 join application0 a on np.application_id = a.application_id group by a.scheme_id) x on p.scheme_id = x.scheme_id""")
def t02_pool_ledger(cat) -> DataFrame:
    """Pool balances after the payment run's inserts fire the ledger trigger."""
    return pool_ledger(cat["pool"], _new_payments(cat), cat["application"])


def running_balance(pool: DataFrame, payments: DataFrame) -> DataFrame:
    """Pool disbursed balance after each payment, in insert order per scheme.

    Few schemes carry all payments, so ``partitionBy(scheme)`` would run each
    scheme in one task; ``ordered.running_sum`` splits hot schemes.
    """
    p = payments.select("disbursement_id", "application_id", "scheme_id", "amount", "disbursement_date")
    p = p.join(pool.select("scheme_id", "total_budget", "disbursed_amount"), "scheme_id")
    p = ordered.running_sum(p, "scheme_id", [F.col("disbursement_date").asc_nulls_last(), "disbursement_id"], "amount", "_cum")
    bal = (F.col("disbursed_amount") + F.col("_cum")).cast("decimal(25,2)")
    return p.select("disbursement_id", "application_id", "scheme_id", "amount", "disbursement_date",
                    bal.alias("running_disbursed"),
                    (F.col("total_budget") - bal).cast("decimal(25,2)").alias("remaining_after"))


@register("t02b_running_balance", oracle="""select np.disbursement_id, np.application_id, np.scheme_id, cast(np.amount as double) as amount,
 np.disbursement_date, cast(p.disbursed_amount + sum(np.amount) over w as double) as running_disbursed,
 cast(p.total_budget - (p.disbursed_amount + sum(np.amount) over w) as double) as remaining_after
from {NEW_PAYMENTS} np join pool p on np.scheme_id = p.scheme_id
window w as (partition by np.scheme_id order by np.disbursement_date, np.disbursement_id rows between unbounded preceding and current row)""")
def t02b_running_balance(cat) -> DataFrame:
    """Running pool balance after each new payment (skew-safe per-scheme window)."""
    return running_balance(cat["pool"], _new_payments(cat))


# ------------------------------------------------------------------ t03
DUPLICATE_MESSAGE = "Active application already exists for scheme: "


def duplicate_guard(inserts: DataFrame, cat) -> DataFrame:
    """Direct inserts checked by the duplicate-application trigger.

    In arrival order per (citizen, scheme): with a stored active application
    every insert fails -20030; otherwise the first insert with valid
    references is stored (SUBMITTED, hence active) and the later ones fail
    -20030.  Unknown citizen or scheme pass the trigger and fail the foreign
    key (-2291), storing nothing.
    """
    from schemelens.operators.intake import join_pairs, requested_pairs
    cz = cat["citizen"].select("citizen_id", F.lit(True).alias("_c_found"))
    sc = cat.dim("scheme").select("scheme_id", "scheme_name")
    pairs = (requested_pairs(inserts, cat["application"]).join(cz, "citizen_id", "left").join(sc, "scheme_id", "left")
             .select("citizen_id", "scheme_id", "_first", "_active", "_c_found", "scheme_name"))
    q = join_pairs(inserts.select("request_id", "citizen_id", "scheme_id", "requested_at"), pairs)
    q = q.withColumn("_is_first", time_id_key("requested_at", "request_id") == F.col("_first"))
    code = (F.when(F.col("_active").isNotNull(), F.lit(-20030))
            .when(F.col("_c_found").isNull() | F.col("scheme_name").isNull(), F.lit(-2291))
            .when(F.col("_is_first"), F.lit(0)).otherwise(F.lit(-20030)))
    msg = (F.when(code == -20030, F.concat(F.lit(DUPLICATE_MESSAGE), F.col("scheme_name")))
           .when(code == -2291, F.lit("integrity constraint violated - parent key not found"))
           .otherwise(F.lit("INSERTED")))
    return q.select("request_id", "citizen_id", "scheme_id", code.alias("outcome_code"), msg.alias("message"))


@register("t03_duplicate_guard", oracle="""select request_id, citizen_id, scheme_id, code as outcome_code,
 case code when -20030 then concat('""" + DUPLICATE_MESSAGE + """', scheme_name)
  when -2291 then 'integrity constraint violated - parent key not found' else 'INSERTED' end as message
from (select q.*, s.scheme_name, case when exists (select 1 from application a where a.citizen_id = q.citizen_id
   and a.scheme_id = q.scheme_id and a.status not in ('REJECTED')) then -20030
  when c.citizen_id is null or s.scheme_id is null then -2291 when q.rn = 1 then 0 else -20030 end as code
 from (select *, row_number() over (partition by citizen_id, scheme_id order by requested_at, request_id) as rn
       from application_request) q left join citizen c on q.citizen_id = c.citizen_id
 left join scheme s on q.scheme_id = s.scheme_id) t""")
def t03_duplicate_guard(cat) -> DataFrame:
    """Outcome of every intake request inserted directly under the duplicate trigger."""
    return duplicate_guard(cat["application_request"], cat)


from schemelens.registry import JOBS as _JOBS  # noqa: E402

for _n in ("t02_pool_ledger", "t02b_running_balance"):
    _JOBS[_n].oracle = _JOBS[_n].oracle.replace("{NEW_PAYMENTS}", _new_payments_sql())


# ----------------------------------------------------------------- t03b
def _merged_guard_events(status_event: DataFrame, requests: DataFrame, cat) -> DataFrame:
    """One time line per pair: its stored active applications (kind -1, one row before all others), status
    changes of stored applications (0; both as changes of the pair's active count) and insert requests (1)."""
    app = cat["application"].select("application_id", "citizen_id", "scheme_id", F.col("status").alias("_stored"))
    st = status_event.join(app, "application_id")
    st = ordered.lag(st, "application_id", ["change_date", "event_id"], "new_status", "_old")
    old = F.coalesce(F.col("_old"), F.col("_stored"))

    def act(c):
        return F.when(c != "REJECTED", 1).otherwise(0)

    def line(df, t, kind, event_id, delta, refs_ok, scheme_name):
        return df.select("citizen_id", "scheme_id", t.cast("timestamp_ntz").alias("t"), F.lit(kind).alias("kind"),
                         event_id.cast("bigint").alias("event_id"), delta.cast("bigint").alias("delta"),
                         refs_ok.cast("boolean").alias("_refs_ok"), scheme_name.cast("string").alias("scheme_name"))

    none = F.lit(None)
    cz = cat["citizen"].select("citizen_id", F.lit(True).alias("_c"))
    sc = cat.dim("scheme").select("scheme_id", "scheme_name")
    # a NULL id equals nothing: such applications hold nobody's pair
    held = (cat["application"].filter(F.col("status") != "REJECTED").dropna(subset=["citizen_id", "scheme_id"])
            .groupBy("citizen_id", "scheme_id").agg(F.count(F.lit(1)).alias("_n")))
    rq = requests.join(cz, "citizen_id", "left").join(sc, "scheme_id", "left")
    return (line(held, none, -1, none, F.col("_n"), none, none)
            .unionByName(line(st, F.col("change_date"), 0, F.col("event_id"), act(F.col("new_status")) - act(old), none, none))
            .unionByName(line(rq, F.col("requested_at"), 1, F.col("request_id"), F.lit(0),
                              F.col("_c").isNotNull() & F.col("scheme_name").isNotNull(), F.col("scheme_name"))))


def duplicate_guard_reopen(status_event: DataFrame, requests: DataFrame, cat) -> DataFrame:
    """Inserts under the duplicate trigger while status changes arrive too.

    A pair's active count is its stored active applications plus the running
    sum of status deltas before the insert (a rejection reopens the pair).
    The first insert with valid references at a moment the count is 0 is
    stored (the new SUBMITTED row keeps the pair active from then on: status
    changes refer to stored applications); other inserts fail -20030 while
    the pair is active, or -2291 for unknown references.

    Count and "stored before" are a running sum and a running state over the same
    pieces of the pairs' time lines; nothing is joined by pair, so a pair with
    most of the rows is just many pieces.
    """
    order = ["t", "kind", "event_id"]
    u = _merged_guard_events(status_event, requests, cat)
    u = u.withColumn("_pair", F.concat(*(F.concat(F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit(":")) for c in ("citizen_id", "scheme_id"))))
    u = ordered.in_pieces(u, "_pair", order)
    r = ordered.running_sum(u, "_pair", order, "delta", "_active", inclusive=False).filter(F.col("kind") == 1)
    r = r.withColumn("_move", F.when((F.col("_active") == 0) & F.col("_refs_ok"), F.lit(True)))
    r = ordered.running_state(r, "_pair", order, "_move", "_stored")
    code = (F.when(F.col("_stored"), F.lit(-20030))
            .when(F.col("_move"), F.lit(0))
            .when(F.col("_active") > 0, F.lit(-20030))
            .otherwise(F.lit(-2291)))
    msg = (F.when(code == -20030, F.concat(F.lit(DUPLICATE_MESSAGE), F.col("scheme_name")))
           .when(code == -2291, F.lit("integrity constraint violated - parent key not found"))
           .otherwise(F.lit("INSERTED")))
    return r.select(F.col("event_id").alias("request_id"), "citizen_id", "scheme_id", code.alias("outcome_code"),
                    msg.alias("message"))


GUARD_REOPEN_SQL = """select request_id, citizen_id, scheme_id, code as outcome_code,
 case code when -20030 then concat('""" + DUPLICATE_MESSAGE + """', scheme_name)
  when -2291 then 'integrity constraint violated - parent key not found' else 'INSERTED' end as message
from (select *, case when elig_before > 0 then -20030 when eligible and elig_before = 0 then 0
   when active > 0 then -20030 else -2291 end as code
 from (select *, coalesce(sum(case when eligible then 1 else 0 end) over (partition by citizen_id, scheme_id
        order by t, event_id rows between unbounded preceding and 1 preceding), 0) as elig_before
  from (select r.*, r.event_id as request_id, r.t as requested_at, s.scheme_name,
         (cz.citizen_id is not null and s.scheme_id is not null) and r.active = 0 as eligible
   from (select u.*, coalesce(b.n, 0) + coalesce(sum(delta) over (partition by u.citizen_id, u.scheme_id
          order by t, kind, event_id rows between unbounded preceding and 1 preceding), 0) as active
         from (select a.citizen_id, a.scheme_id, e.change_date as t, 0 as kind, e.event_id,
                 (case when e.new_status <> 'REJECTED' then 1 else 0 end)
                 - (case when coalesce(lag(e.new_status) over (partition by e.application_id order by e.change_date, e.event_id),
                                       a.status) <> 'REJECTED' then 1 else 0 end) as delta
               from status_event e join application a on e.application_id = a.application_id
               union all
               select citizen_id, scheme_id, requested_at as t, 1 as kind, request_id as event_id, 0 as delta
               from application_request) u
         left join (select citizen_id, scheme_id, count(*) as n from application where status <> 'REJECTED'
                    group by citizen_id, scheme_id) b on u.citizen_id = b.citizen_id and u.scheme_id = b.scheme_id) r
   left join citizen cz on r.citizen_id = cz.citizen_id left join scheme s on r.scheme_id = s.scheme_id
   where r.kind = 1) x) y) z"""


@register("t03b_duplicate_guard_reopen", oracle=GUARD_REOPEN_SQL)
def t03b_duplicate_guard_reopen(cat) -> DataFrame:
    """Duplicate guard over inserts and status changes together: rejections reopen a pair."""
    return duplicate_guard_reopen(cat["status_event"], cat["application_request"], cat)
