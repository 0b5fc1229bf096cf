"""Constraint jobs on injected breaches (the fixture itself has no dangling references)."""

import datetime as dt
from decimal import Decimal as D

from schemelens.operators.quality import d02_unique_keys, d03_foreign_keys
from schemelens.sources.catalog import Catalog
from schemelens.sources.schemas import SCHEMAS


def _clean(cat):
    """The catalog's tables without the ones that have planted breaches."""
    return {n: f for n, f in cat.frames.items() if not n.endswith("_dirty")}


def test_foreign_keys_report_dangling_references(spark, cat001):
    frames = _clean(cat001)
    t = dt.datetime(2001, 1, 1)
    bad_apps = spark.createDataFrame([
        (900000001, 10 ** 9, 0, None, t, "SUBMITTED", None, 0, None, None),       # unknown citizen
        (900000002, 1, 10 ** 7, 10 ** 6, t, "SUBMITTED", None, 0, None, None),         # unknown scheme and officer
    ], SCHEMAS["application"])
    frames["application"] = frames["application"].unionByName(bad_apps)
    bad_pay = spark.createDataFrame([(900000003, 123456789012, D("10.00"), t, "DBT", "PROCESSED", "TXNX")],
                                    SCHEMAS["disbursement"])
    frames["disbursement"] = frames["disbursement"].unionByName(bad_pay)
    cat = Catalog(spark, frames, source_dir=cat001.source_dir)
    got = {(r.table_name, r.rule, r.row_key, r.value) for r in d03_foreign_keys(cat).collect()}
    assert got == {
        ("application", "FOREIGN KEY citizen_id -> citizen", "900000001", str(10 ** 9)),
        ("application", "FOREIGN KEY scheme_id -> scheme", "900000002", str(10 ** 7)),
        ("application", "FOREIGN KEY officer_id -> officer", "900000002", str(10 ** 6)),
        ("disbursement", "FOREIGN KEY application_id -> application", "900000003", "123456789012"),
    }


def test_unique_keys_report_duplicates(spark, cat001):
    frames = _clean(cat001)
    dup = frames["scheme"].filter("scheme_id = 1")
    frames["scheme"] = frames["scheme"].unionByName(dup)
    got = {(r.table_name, r.rule, r.row_key, r.value) for r in d02_unique_keys(Catalog(spark, frames)).collect()}
    assert {("scheme", "PRIMARY KEY scheme_id", "1", "2"), ("scheme", "UNIQUE scheme_name", "SCHEME_01", "2"),
            ("scheme", "UNIQUE scheme_code", "S-1", "2")} <= got


def test_planted_breaches_in_every_child_table(cat001):
    """The registered jobs see breaches of every foreign key's table and of five tables' keys."""
    dangling = d03_foreign_keys(cat001).groupBy("table_name").count().collect()
    assert {r.table_name for r in dangling} == {"scheme", "rules", "pool", "officer", "citizen_document", "application",
                                                "disbursement"}
    assert len({r.table_name for r in d02_unique_keys(cat001).select("table_name").distinct().collect()}) >= 5


def test_hot_references_and_values(spark, cat001):
    """Nine tenths of the rows name one parent, or one parent that is not there; one text on nine tenths of the rows."""
    from pyspark.sql import functions as F
    for hot in (3, 10 ** 15):
        frames = _clean(cat001)
        frames["application"] = frames["application"].withColumn(
            "citizen_id", F.when(F.col("application_id") % 10 > 0, F.lit(hot).cast("bigint")).otherwise(F.col("citizen_id")))
        # one text on nine tenths of the payments, which then repeat 9/10 of the rows
        frames["disbursement"] = frames["disbursement"].withColumn(
            "transaction_ref", F.when(F.col("disbursement_id") % 10 > 0, F.lit("TXN1")).otherwise(F.col("transaction_ref")))
        cat = Catalog(spark, frames, source_dir=cat001.source_dir)
        for few in (200_000, 0):  # the references found are broadcast, or joined by shuffle
            cat.broadcast_max_rows = few
            apps = [r.application_id for r in frames["application"].filter("application_id % 10 > 0").collect()]
            found = {int(r.row_key) for r in d03_foreign_keys(cat).filter("rule = 'FOREIGN KEY citizen_id -> citizen'").collect()}
            assert found == (set(apps) if hot > 10 ** 9 else set())
            pays = frames["disbursement"].filter("disbursement_id % 10 > 0").count()
            assert [(r.table_name, r.row_key, r.value) for r in d02_unique_keys(cat).filter("table_name = 'disbursement'").collect()
                    ] == [("disbursement", "TXN1", str(pays))]


def test_references_are_shuffled_as_numbers_counted_in_tasks_first(spark, cat001, monkeypatch):
    """What crosses the network: distinct (key, number) rows, never texts or ids of child rows."""
    import re

    from schemelens.operators import quality
    plans = []

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.sparkSession.createDataFrame(df.collect(), df.schema)

    monkeypatch.setattr(quality, "checkpoint_table", keep)
    cat = Catalog(spark, _clean(cat001), source_dir=cat001.source_dir)
    d03_foreign_keys(cat).collect()
    d02_unique_keys(cat).collect()
    assert len(plans) == 2
    for text in plans:
        shuffled = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
        assert any(re.search(r"\b(fk|k)#", x) for x in shuffled)
        assert "HashAggregate" in text and "SortAggregate" not in text
