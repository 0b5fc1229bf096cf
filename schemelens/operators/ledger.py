"""Pool totals kept from new payment batches only.

The payment trigger adds each inserted payment to its scheme's pool.  Here the
stored ``pool`` table remembers, in its manifest, which batches of
``disbursement`` its totals include.  ``apply_new_payments`` reads only the
batches that are new, adds their sums, and commits totals and list together, so
a failure between two writes neither loses nor doubles a payment: until the
commit the old totals and the old list hold.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from schemelens.sources import manifest
from schemelens.sources.schemas import SCHEMAS


def _paths(warehouse: str) -> tuple[str, str]:
    root = warehouse.rstrip("/")
    return f"{root}/disbursement", f"{root}/pool"


def mark_applied(spark: SparkSession, warehouse: str) -> None:
    """Say that the stored pool totals include all payments stored now."""
    payments, pools = _paths(warehouse)
    batches = dict(manifest.current(spark, payments).batches)
    manifest.commit(spark, pools, lambda now: replace(now, applied=now.applied | {"disbursement": batches}))


def apply_new_payments(cat) -> list[str]:
    """Add the payment batches that the stored pool totals lack; the ids of those batches."""
    from schemelens.operators.triggers import pool_ledger
    spark = cat.spark
    payments, pools = _paths(cat.warehouse)
    stored, pool = manifest.current(spark, payments), manifest.current(spark, pools)
    applied = pool.applied.get("disbursement", {})
    changed = sorted(b for b, folder in applied.items() if stored.batches.get(b) != folder)
    if changed:
        raise ValueError(f"payment batches {changed} were replaced after their sums were taken: load the pools anew")
    new = [b for b in stored.batches if b not in applied]
    if not new:
        return []
    rows = manifest.read(spark, payments, stored, SCHEMAS["disbursement"], new)
    before = manifest.read(spark, pools, pool, SCHEMAS["pool"])
    closing = pool_ledger(before, rows, cat["application"]).select(
        "scheme_id", F.col("closing_disbursed").cast("decimal(15,2)").alias("closing"))
    totals = (before.join(closing, "scheme_id", "left")
              .withColumn("disbursed_amount", F.coalesce("closing", "disbursed_amount")).drop("closing"))
    folder = manifest.write_batch(totals, pools, "load")

    def change(now):
        if now.number != pool.number:
            raise RuntimeError("the pools were changed meanwhile; apply the payments again")
        done = {"disbursement": applied | {b: stored.batches[b] for b in new}}
        return replace(now, batches={"load": folder}, applied=now.applied | done)

    manifest.commit(spark, pools, change)
    cat.refresh("pool")
    return new


def run_payments(cat, batch_id: str) -> list[str]:
    """Store the payment run as batch ``batch_id`` and bring the pools up to date; the batches added to the pools.

    A run that is stored already is not made again: its applications are paid,
    so a second run would replace the batch by an empty one.
    """
    from schemelens.operators.payments import payment_run
    if batch_id not in manifest.current(cat.spark, _paths(cat.warehouse)[0]).batches:
        cat.append("disbursement", payment_run(cat)[0], batch_id)
    return apply_new_payments(cat)
