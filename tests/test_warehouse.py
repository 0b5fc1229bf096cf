"""Stored tables: batches, manifests, appended payments that reach the reports, pools kept from new batches."""

import pytest
from pyspark.sql import functions as F

from schemelens.operators import ledger
from schemelens.operators.payments import payment_run
from schemelens.operators.triggers import pool_ledger
from schemelens.registry import JOBS, load_all, to_output
from schemelens.sources import manifest, sinks
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS

load_all()


@pytest.fixture(scope="module")
def stored(spark, cat001, tmp_path_factory):
    wh = f"file://{tmp_path_factory.mktemp('warehouse')}"
    cat001.materialize(wh)
    return wh


def sums(df):
    return {r.scheme_id: (r.total_budget, r.disbursed_amount) for r in df.collect()}


def test_every_table_reads_as_it_was_derived(spark, cat001, stored):
    cat = Catalog.from_warehouse(spark, stored)
    assert set(cat.names()) == set(cat001.names())
    for name, ddl in SCHEMAS.items():
        assert [f.name for f in cat[name].schema] == [c.split(" ")[0] for c in ddl.split(", ")], name
        assert cat[name].exceptAll(cat001[name]).isEmpty() and cat[name].count() == cat001[name].count(), name


def test_appended_payments_reach_reports_and_pools(spark, stored):
    """Three batches, one of them retried; pools from the new batches equal pools from all payments."""
    cat = Catalog.from_warehouse(spark, stored)
    opening, n = cat["pool"].collect(), cat["disbursement"].count()
    run = payment_run(cat)[0].orderBy("application_id").limit(9).collect()
    rows = spark.createDataFrame(run, payment_run(cat)[0].schema)
    part = lambda k: rows.where(F.col("application_id").isin([r.application_id for r in run[k::3]]))
    cat.append("disbursement", part(0), "run1")
    cat.append("disbursement", part(0), "run1")  # a retry
    assert ledger.apply_new_payments(cat) == ["run1"]
    assert ledger.apply_new_payments(cat) == []
    cat.append("disbursement", part(1), "run2")
    cat.append("disbursement", part(2), "run3")
    assert sorted(ledger.apply_new_payments(cat)) == ["run2", "run3"]
    again = Catalog.from_warehouse(spark, stored)
    assert again["disbursement"].count() == n + 9
    assert again["disbursement"].where(F.col("application_id") == run[0].application_id).count() == 1
    full = pool_ledger(spark.createDataFrame(opening, SCHEMAS["pool"]), rows, again["application"])
    assert {r.scheme_id: r.disbursed_amount for r in again["pool"].collect()} == {
        r.scheme_id: r.closing_disbursed for r in full.collect()}
    # the views see them
    paid = {r.scheme_id: r.disbursed_amount for r in again["pool"].collect()}
    v02 = to_output(JOBS["v02_scheme_fund_status"].fn(again)).agg(F.sum("disbursed_amount")).first()[0]
    assert v02 == pytest.approx(float(sum(paid.values())))
    flow = JOBS["v01_application_flow"].fn(again).where(F.col("application_id") == run[0].application_id)
    assert flow.first().transaction_ref == run[0].transaction_ref


def test_a_failed_write_changes_nothing(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    sinks.load_rows(spark.createDataFrame([(1, "a")], "id long, x string"), at)
    broken = spark.range(5).select("id", F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):
        sinks.append_rows(broken, at, "b1")
    manifest.write_batch(spark.createDataFrame([(2, "b")], "id long, x string"), at, "b2")  # never committed
    assert [tuple(r) for r in sinks.read_rows(spark, at).collect()] == [(1, "a")]
    assert len(manifest.remove_unlisted(spark, at)) >= 1
    assert [tuple(r) for r in sinks.read_rows(spark, at).collect()] == [(1, "a")]


def test_commits_of_two_writers_both_hold(spark, tmp_path):
    """The one that finds its number taken reads the table again."""
    at = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(1,)], "id long")
    sinks.load_rows(rows, at)
    folder = manifest.write_batch(rows, at, "mine")
    calls = []

    def change(now):
        if not calls:
            sinks.append_rows(rows, at, "other")
        calls.append(now.number)
        return manifest.Manifest(0, now.schema, now.batches | {"mine": folder}, now.applied)

    done = manifest.commit(spark, at, change)
    assert list(done.batches) == ["load", "other", "mine"] and len(calls) == 2
    assert sinks.read_rows(spark, at).count() == 3


def test_pools_fail_between_write_and_commit(spark, cat001, tmp_path, monkeypatch):
    """Nothing is lost or doubled if the commit of the totals fails and the run is tried again."""
    wh = f"file://{tmp_path}/wh"
    cat = cat001.materialize(wh, ["pool", "disbursement", "application"])
    before = sums(cat["pool"])
    paid = cat["application"].join(cat["disbursement"], "application_id", "left_anti").where("scheme_id = 0").limit(1)
    cat.append("disbursement", paid.select(
        F.lit(10**9).alias("disbursement_id"), "application_id", F.lit("5.00").cast("decimal(12,2)").alias("amount")), "late")
    real = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.apply_new_payments(cat)
    monkeypatch.setattr(manifest, "commit", real)
    assert sums(Catalog.from_warehouse(spark, wh)["pool"]) == before
    assert ledger.apply_new_payments(cat) == ["late"]
    after = sums(Catalog.from_warehouse(spark, wh)["pool"])
    assert sum(x[1] for x in after.values()) - sum(x[1] for x in before.values()) == 5


def test_odd_calls(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError):
        sinks.append_rows(rows, f"{tmp_path}/none", "b")
    with pytest.raises(ValueError):
        sinks.read_rows(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError):
        manifest.write_batch(rows, f"{tmp_path}/none", "a/b")
    sinks.load_rows(rows.limit(0), f"{tmp_path}/empty")
    assert sinks.read_rows(spark, f"{tmp_path}/empty").count() == 0
    sinks.load_rows(rows, f"{tmp_path}/empty")  # replaces
    assert sinks.read_rows(spark, f"{tmp_path}/empty").count() == 1


def test_bucketed_tables_append_too(spark, cat001, tmp_path):
    cat = cat001.materialize(f"{tmp_path}/wh", ["disbursement", "citizen"], buckets=4)
    n = cat["disbursement"].count()
    again = Catalog.from_warehouse(spark, f"{tmp_path}/wh")
    assert again["disbursement"].count() == n
    again.append("disbursement", cat["disbursement"].limit(3), "more")
    assert again["disbursement"].count() == n + 3


def test_payment_run_is_stored_once(spark, cat001, tmp_path):
    wh = f"{tmp_path}/wh"
    cat = cat001.materialize(wh)
    due, n = payment_run(cat)[0].count(), cat["disbursement"].count()
    assert due > 0 and ledger.run_payments(cat, "august") == ["august"]
    assert ledger.run_payments(Catalog.from_warehouse(spark, wh), "august") == []
    again = Catalog.from_warehouse(spark, wh)
    assert again["disbursement"].count() == n + due and payment_run(again)[0].isEmpty()
