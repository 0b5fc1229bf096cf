"""Payment run (b01): pay every approved application that has no payment yet.

Amount is the f02 benefit, dated 1..7 days after approval (a deterministic
``1 + id % 7`` instead of a random draw), mode DBT, reference
``TXN<run date yyyymmdd><id padded to 8>``, status PROCESSED.  No fund check
is made and the application status is not changed.  A row whose amount is not
positive would abort the whole modelled statement; here it goes to the
``rejected`` output instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import as_of_col, as_of_sql, padded_id
from schemelens.plans.views import APPROVED
from schemelens.registry import register


def payment_run(cat, as_of=None) -> tuple[DataFrame, DataFrame]:
    now = as_of_col() if as_of is None else as_of_col(as_of)
    a = (cat["application"].filter(F.col("status").isin(*APPROVED))
         .select("application_id", "citizen_id", "scheme_id", "approval_date")
         .join(cat["disbursement"].select("application_id"), "application_id", "left_anti"))
    x = (R.rule_inputs(a, cat, need_rules=False, citizen_extra=("bank_account",))
         .filter(F.col("_c_found").isNotNull())  # inner join semantics on the citizen
         .withColumn("amount", R.benefit_amount()))
    rows = x.select(
        F.col("application_id").alias("disbursement_id"), "application_id", "scheme_id", "amount",
        F.timestamp_add("DAY", (F.col("application_id") % 7 + 1).cast("int"), F.col("approval_date"))
        .alias("disbursement_date"),
        F.lit("DBT").alias("payment_mode"),
        F.concat(F.lit("TXN"), F.date_format(now, "yyyyMMdd"),
                 padded_id("application_id")).alias("transaction_ref"),
        "bank_account", F.lit("PROCESSED").alias("status"))
    ok = F.col("amount") > 0
    return rows.filter(ok), rows.filter(~ok | F.col("amount").isNull())


PAYMENT_RUN_SQL = f"""select a.application_id as disbursement_id, a.application_id, a.scheme_id,
 case when s.scheme_id is null then 0 when s.max_benefit_amount is null then null else {R.benefit_amount_sql('c', 's')} end as amount,
 a.approval_date + interval '1' day * cast(a.application_id % 7 + 1 as int) as disbursement_date, 'DBT' as payment_mode,
 'TXN' || strftime({as_of_sql()}, '%Y%m%d') || lpad(cast(a.application_id as varchar), cast(greatest(length(cast(a.application_id as varchar)), 8) as int), '0') as transaction_ref,
 c.bank_account, 'PROCESSED' as status
from application a join citizen c on a.citizen_id = c.citizen_id left join scheme s on a.scheme_id = s.scheme_id
where a.status in ('APPROVED','DISBURSED')
 and not exists (select 1 from disbursement fd where fd.application_id = a.application_id)"""


@register("b01_payment_run", oracle=f"""select disbursement_id, application_id, scheme_id, cast(amount as double) as amount,
 disbursement_date, payment_mode, transaction_ref, bank_account, status from ({PAYMENT_RUN_SQL}) t where amount > 0""")
def b01_payment_run(cat) -> DataFrame:
    """New payment rows for approved applications without a payment."""
    return payment_run(cat)[0]


@register("b01b_payment_rejects", oracle=f"""select disbursement_id, application_id, scheme_id, cast(amount as double) as amount,
 disbursement_date, payment_mode, transaction_ref, bank_account, status from ({PAYMENT_RUN_SQL}) t
where amount is null or amount <= 0""")
def b01b_payment_rejects(cat) -> DataFrame:
    """Rows of the payment run whose amount is missing or not positive."""
    return payment_run(cat)[1]
