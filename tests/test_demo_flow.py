"""The modelled demo scenario end to end: register a citizen, check
eligibility, apply, approve, then payment, audit row and pool ledger."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from schemelens.operators.decisions import decide_batch, decision_effects
from schemelens.operators.intake import apply_batch
from schemelens.plans.rule_jobs import eligibility_of
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS

DEMO_ID = 10 ** 9


def test_demo_flow(spark, cat001):
    frames = dict(cat001.frames)
    # step 1: register the demo citizen (female, 45, OBC, 85000, 1.5 acres, rural, verified)
    demo = spark.createDataFrame([(DEMO_ID, "987654321098", "Demo Citizen", "F", 45, "OBC", D("85000.00"), "RURAL",
                                   D("1.50"), "Farmer", "NATION_1", "ACCT000000009999", "Y")], SCHEMAS["citizen"])
    frames["citizen"] = frames["citizen"].unionByName(demo)
    cat = Catalog(spark, frames, source_dir=cat001.source_dir)

    # step 2: eligibility across a few schemes
    pairs = spark.createDataFrame([(DEMO_ID, s) for s in (0, 3, 6, 13, 17)], "citizen_id long, scheme_id long")
    e = {r.scheme_id: r.eligibility for r in eligibility_of(pairs, cat).collect()}
    assert e[0] == "ELIGIBLE"
    assert e[3] == "INELIGIBLE: Age 45 out of range [18-30]"
    assert e[6] == "INELIGIBLE: Income Rs.85000 below minimum Rs.100000"
    assert e[13] == "INELIGIBLE: Scheme is currently inactive"
    assert e[17] == "INELIGIBLE: Citizen or scheme not found"

    # step 3: apply to scheme 0
    t0 = dt.datetime(2001, 8, 15, 12, 0, 0)
    req = spark.createDataFrame([(1, DEMO_ID, 0, "Applying for support", t0)], SCHEMAS["application_request"])
    out = apply_batch(req, cat).first()
    assert out.outcome_code == 0 and out.priority_score == 44 + 14 + 15 and out.remarks == "Applying for support"
    app_id = out.application_id
    new_app = spark.createDataFrame([(app_id, DEMO_ID, 0, None, t0, "SUBMITTED", None, out.priority_score, None,
                                      out.remarks)], SCHEMAS["application"])
    frames["application"] = frames["application"].unionByName(new_app)
    cat = Catalog(spark, frames, source_dir=cat001.source_dir)

    # step 4: an officer approves it
    t1 = t0 + dt.timedelta(hours=2)
    dec = spark.createDataFrame([(2, app_id, 3, "APPROVE", t1, None)], SCHEMAS["decision_request"])
    res = decide_batch(dec, cat)
    r = res.first()
    # benefit: 900 * 0.88 (income <= 150000) * 1.10 (OBC) * 1.08 (rural) = 940.896 -> 940.90 (cap 945)
    assert r.outcome_code == 0 and r.new_status == "DISBURSED" and r.paid_amount == D("940.90")

    # steps 5-6: payment row, audit trail and pool ledger written by the approval
    eff = decision_effects(res, cat)
    pay = eff["payments"].first()
    # LPAD(id, 8, '0'): zero-padded to 8 characters (a longer id keeps its first 8)
    assert pay.transaction_ref == "TXN20010815" + str(app_id).rjust(8, "0") and pay.disbursement_id == app_id
    assert pay.bank_account == "ACCT000000009999" and pay.payment_mode == "DBT"
    audit = eff["audit"].first()
    assert (audit.old_status, audit.new_status) == ("SUBMITTED", "DISBURSED")
    pool = eff["pools"].filter(F.col("scheme_id") == 0).first()
    assert pool.closing_disbursed - pool.opening_disbursed == D("940.90") and pool.payments == 1
