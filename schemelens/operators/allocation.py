"""Budget allocation of claims against per-scheme pools (a01, a02).

``a02`` is the strict variant: grant claims in queue order while the running
total fits the remaining budget, stop at the first overflow.  Amounts are
positive, so the running total is monotone and ``granted = cum <= remaining``
is one cumulative window per scheme.

``a01`` is the modelled behaviour: each claim is checked against the budget
left at its turn, granted if it fits, otherwise skipped; a smaller later claim
may still fit.  So a queue goes through phases: while all claims not above the
budget at the phase's start fit, all of those are granted; the first that does
not fit (an overflow) ends the phase.

Overflows are found from totals instead of rows.  The queue of all schemes is
cut into ordered pieces (``ordered.in_pieces``); their totals per (scheme, piece,
amount), summed along the pieces, are a prefix-sum table in which the piece of
the next overflow is a binary search.  The pieces before it need no more than the
budget at their start.  Only the piece with the overflow is read, and walked
claim by claim to the budget at its end; then the search goes on behind it.  A
scheme has at most one overflow for each distinct amount, so the rounds end.  In
the end every claim is decided by the budget at its piece's start, in one pass.

The totals of one scheme are one group: at most pieces x distinct amounts rows,
whatever the number of claims.  A walked piece is one group too, a range
partition's size.  Nothing else depends on how claims are spread over schemes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import checkpoint_table
from schemelens.operators import ordered
from schemelens.operators.ordered import PIECE
from schemelens.plans.views import PENDING
from schemelens.registry import register
from schemelens.sources.catalog import BROADCAST_MAX_ROWS


#: Stands for the budget of a key that has none (NULL refuses no claim).
UNBOUNDED = 1 << 62


def allocate(claims: DataFrame, budgets: DataFrame, key: str, id_col: str, amount: str,
             order: Sequence[Column], catalog=None) -> DataFrame:
    """Greedy skip-if-it-does-not-fit allocation per ``key``.

    claims  : id_col, key, amount (not negative), and the columns used by ``order``
    budgets : key, _rem (budget available before the first claim)
    order   : ascending column expressions defining the queue (must be unique)
    Returns (id_col, key, amount, granted boolean, alloc_round int); the round is
    the phase of the queue in which the claim was decided, 0 without an amount.
    """
    small = budgets.count() <= getattr(catalog, "broadcast_max_rows", BROADCAST_MAX_ROWS)
    own = [id_col, key, amount]
    base = claims.join(F.broadcast(budgets) if small else budgets, key)
    unfundable = base.filter(F.col(amount).isNull()).select(
        *own, F.lit(False).alias("granted"), F.lit(0).alias("alloc_round"))
    exact = claims.schema[amount].dataType
    unit = 10 ** getattr(exact, "scale", 0)
    units = lambda c: (F.col(c) * F.lit(unit)).cast("long")
    rows = ordered.in_pieces(base.filter(F.col(amount).isNotNull()).withColumn("_a", units(amount)), key, order,
                             position="_pos").select(*own, "_a", "_pos", PIECE)
    totals = checkpoint_table(rows.groupBy(key, PIECE, "_a").agg(F.sum("_a").alias("_total")))
    state = budgets.select(key, F.lit(-1).alias("_done"), F.lit(1).alias("_phase"), F.coalesce(
        F.floor(F.col("_rem") * unit).cast("long"), F.lit(UNBOUNDED)).alias("_left"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    entry = f"`{key}` {kinds[key]}, {PIECE} int, _left long, _phase int, _over boolean"
    walked_as = ", ".join(f"`{c}` {kinds[c]}" for c in own) + f", granted boolean, alloc_round int, {PIECE} int, _left long, _phase int"
    decided = [unfundable]
    entries = []
    while True:
        ahead = totals.join(state, key).where(F.col(PIECE) > F.col("_done"))
        found = checkpoint_table(ahead.groupBy(key).applyInArrow(_entries(key), entry))
        entries.append(found.where(~F.col("_over")))
        over = found.where("_over")
        # numbers of pieces that hold an overflow: at most one a partition
        pieces = [r[0] for r in over.select(PIECE).distinct().collect()]
        if not pieces:
            break
        at = rows.where(F.col(PIECE).isin(pieces)).join(F.broadcast(over) if small else over, [key, PIECE])
        walked = checkpoint_table(at.groupBy(key, PIECE).applyInArrow(_walk(own), walked_as))
        decided.append(walked.select(*own, "granted", "alloc_round"))
        state = walked.groupBy(key).agg(F.max(PIECE).alias("_done"), F.max("_left").alias("_left"),
                                        F.max("_phase").alias("_phase"))
    plain = reduce(lambda a, b: a.unionByName(b), entries)
    # fewer rows than budgets and pieces together
    plain = rows.join(F.broadcast(plain) if small else plain, [key, PIECE])
    decided.append(plain.select(*own, (F.col("_a") <= F.col("_left")).alias("granted"), F.col("_phase").alias("alloc_round")))
    return reduce(lambda a, b: a.unionByName(b), decided)


def _entries(key: str):
    """From the totals of one key, the budget at the start of each piece up to the next one with an overflow."""
    def run(table: pa.Table) -> pa.Table:
        piece, amount, total = (table[c].to_numpy() for c in (PIECE, "_a", "_total"))
        left, phase = table["_left"][0].as_py(), table["_phase"][0].as_py()
        if (amount < 0).any():
            raise ValueError("negative amounts cannot be allocated")
        pieces, at = np.unique(piece, return_inverse=True)
        fits = amount <= left
        spent = np.cumsum(_sums(at[fits], total[fits], len(pieces)))
        stop = int(np.searchsorted(spent, left, side="right"))  # the first piece whose running total exceeds the budget
        if left < 0:
            stop = len(pieces)  # nothing fits, nothing overflows
        n = min(stop + 1, len(pieces))
        start = left - np.concatenate(([0], spent[:n - 1]))
        return pa.table({key: table[key].slice(0, 1).take(pa.array([0] * n)), PIECE: pa.array(pieces[:n], pa.int32()),
                         "_left": pa.array(start, pa.int64()), "_phase": pa.array([phase] * n, pa.int32()),
                         "_over": pa.array(np.arange(n) == stop)})
    return run


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of 64-bit ``values`` by position."""
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def _walk(own: list[str]):
    """Decide the claims of one piece in order, phase by phase."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        amount = table["_a"].to_numpy()
        left, phase = table["_left"][0].as_py(), table["_phase"][0].as_py()
        granted, phases = np.zeros(len(amount), bool), np.zeros(len(amount), np.int32)
        at = 0
        while at < len(amount):
            fits = amount[at:] <= left
            spent = np.cumsum(np.where(fits, amount[at:], 0))
            n = int(np.searchsorted(spent, left, side="right")) if fits.any() else len(spent)
            granted[at:at + n] = fits[:n]
            phases[at:] = phase
            left -= int(spent[n - 1]) if n else 0
            at += n
            phase += at < len(amount)
        size = len(amount)
        return pa.table({c: table[c] for c in own} | {
            "granted": pa.array(granted), "alloc_round": pa.array(phases), PIECE: table[PIECE],
            "_left": pa.array([left] * size, pa.int64()), "_phase": pa.array([phase] * size, pa.int32())})
    return run


def queue_claims(cat) -> tuple[DataFrame, DataFrame]:
    """Pending applications with their benefit, and per-scheme remaining budget."""
    a = cat["application"].filter(F.col("status").isin(*PENDING)).select(
        "application_id", "citizen_id", "scheme_id", "priority_score", "apply_date")
    x = R.rule_inputs(a, cat, need_rules=False).filter(F.col("_c_found") & F.col("_s_found"))
    claims = x.select("application_id", "scheme_id", "priority_score", "apply_date",
                      R.benefit_amount().alias("amount"))
    budgets = cat.dim("pool").select(
        "scheme_id", (F.col("total_budget") - F.col("disbursed_amount")).alias("_rem"))
    return claims, budgets


def queue_order() -> list[Column]:
    """Officer queue order: priority desc, apply date asc, id asc (as ascending keys)."""
    return [-F.col("priority_score"), F.col("apply_date"), F.col("application_id")]


@register("a02_budget_prefix", oracle="""select application_id, scheme_id, cast(amount as double) as amount,
 cast(coalesce(cum, 0) as double) as cum_amount, amount is not null and cum <= remaining as granted from (
 select a.application_id, a.scheme_id, b.amount, p.total_budget - p.disbursed_amount as remaining,
  sum(b.amount) over (partition by a.scheme_id order by a.priority_score desc, a.apply_date, a.application_id
                      rows between unbounded preceding and current row) as cum
 from application a join pool p on a.scheme_id = p.scheme_id
 join (select a2.application_id, """ + R.benefit_amount_sql("c", "s") + """ as amount from application a2
       join citizen c on a2.citizen_id = c.citizen_id join scheme s on a2.scheme_id = s.scheme_id) b
  on a.application_id = b.application_id
 where a.status in ('SUBMITTED','UNDER_REVIEW')) t""")
def a02_budget_prefix(cat) -> DataFrame:
    """Queue-order grants that stop at the first claim over the remaining budget.

    A claim without an amount is never granted and adds nothing, as in ``a01``."""
    claims, budgets = queue_claims(cat)
    x = claims.join(budgets, "scheme_id")
    x = ordered.running_sum(x, "scheme_id", queue_order(), "amount", "_cum")
    return x.select("application_id", "scheme_id", "amount", F.col("_cum").alias("cum_amount"),
                    (F.col("amount").isNotNull() & (F.col("_cum") <= F.col("_rem"))).alias("granted"))


# Oracle: the plain sequential greedy, one claim per recursion step per scheme.
A01_SQL = """with recursive q as (
 select a.application_id, a.scheme_id, b.amount,
  row_number() over (partition by a.scheme_id order by a.priority_score desc, a.apply_date, a.application_id) as rn
 from application a join pool p on a.scheme_id = p.scheme_id
 join (select a2.application_id, """ + R.benefit_amount_sql("c", "s") + """ as amount from application a2
       join citizen c on a2.citizen_id = c.citizen_id join scheme s on a2.scheme_id = s.scheme_id) b
  on a.application_id = b.application_id
 where a.status in ('SUBMITTED','UNDER_REVIEW')),
walk(scheme_id, rn, rem, application_id, amount, granted) as (
 select scheme_id, cast(0 as bigint), total_budget - disbursed_amount, cast(null as bigint), cast(null as decimal(12,2)),
  cast(null as boolean) from pool
 union all
 select q.scheme_id, q.rn, case when q.amount <= w.rem then w.rem - q.amount else w.rem end, q.application_id, q.amount,
  coalesce(q.amount <= w.rem, false)
 from walk w join q on q.scheme_id = w.scheme_id and q.rn = w.rn + 1)
select application_id, scheme_id, cast(amount as double) as amount, granted from walk where rn > 0"""


@register("a01_budget_allocation", oracle=A01_SQL)
def a01_budget_allocation(cat) -> DataFrame:
    """Queue-order grants where a claim that does not fit is skipped (exact greedy)."""
    claims, budgets = queue_claims(cat)
    return allocate(claims, budgets, "scheme_id", "application_id", "amount", queue_order(),
                    catalog=cat).drop("alloc_round")
