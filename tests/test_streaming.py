"""Stateful streams over several micro-batches equal the batch jobs."""

import os

import pytest
from pyspark.sql import functions as F

from schemelens.operators.triggers import t01_audit_trail, t03_duplicate_guard
from schemelens.streaming.jobs import audit_trail_stream, drain, duplicate_guard_stream


def _landing(spark, cat, tmp_path, parts=4):
    """The events table split by time into several files: one micro-batch each."""
    ev = spark.read.parquet(os.path.join(cat.source_dir, "events.parquet"))
    bounds = ev.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0.0)
    folder = str(tmp_path / "landing")
    edges = [None] + bounds + [None]
    for i in range(parts):
        part = ev
        if edges[i] is not None:
            part = part.filter(F.col("event_id") > edges[i])
        if edges[i + 1] is not None:
            part = part.filter(F.col("event_id") <= edges[i + 1])
        part.coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
        # one file per micro-batch, in event order
        f = [x for x in os.listdir(os.path.join(folder, f"part{i}")) if x.endswith(".parquet")][0]
        os.rename(os.path.join(folder, f"part{i}", f), os.path.join(folder, f"batch-{i:03d}.parquet"))
    return folder


def test_audit_stream_incremental(spark, cat001, tmp_path):
    folder = _landing(spark, cat001, tmp_path)
    got = drain(audit_trail_stream(cat001, folder), "audit-test")
    exp = t01_audit_trail(cat001)
    cols = ["audit_id", "application_id", "old_status", "new_status"]
    # event ids increase with time in the fixture, so file order is arrival order
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_audit_value_state_starts_from_stored_statuses(spark, cat001, tmp_path):
    """Initial state instead of a join: several micro-batches, a stop and a resumption on one checkpoint."""
    from schemelens.sources.catalog import Catalog
    from schemelens.streaming.jobs import audit_trail_stream_tws
    folder = _landing(spark, cat001, tmp_path)
    late = os.path.join(folder, "batch-003.parquet")
    held_back = str(tmp_path / "held-back.parquet")
    os.rename(late, held_back)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(cat):
        q = (audit_trail_stream_tws(cat, folder).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    q = run(cat001)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    first = spark.read.parquet(out).count()
    os.rename(held_back, late)
    empty = Catalog(spark, {t: cat001[t] for t in cat001.names()} | {"application": cat001["application"].limit(0)}, label="empty")
    empty.source_dir = cat001.source_dir
    run(empty)  # a resumed query takes nothing from the applications any more: all is in its state
    cols = ["audit_id", "application_id", "old_status", "new_status"]
    got, exp = spark.read.parquet(out).select(*cols).collect(), t01_audit_trail(cat001).select(*cols).collect()
    assert sorted(got) == sorted(exp) and 0 < first < len(got)


def test_reopen_state_is_read_and_written_per_event():
    """A pair with 100,000 applications in its state costs an event no more state calls than one with 10."""
    import pandas as pd

    from schemelens.streaming.jobs import ReopenGuard

    class Value:
        def __init__(self):
            self.v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    class Map:
        def __init__(self, n):
            self.d, self.calls = {(i,): ("SUBMITTED",) for i in range(n)}, 0

        def containsKey(self, k):
            self.calls += 1
            return k in self.d

        def getValue(self, k):
            self.calls += 1
            return self.d[k]

        def updateValue(self, k, v):
            self.calls += 1
            self.d[k] = v

    calls, codes = [], []
    for n in (10, 100_000):
        g = ReopenGuard()
        g.pair, g.statuses = Value(), Map(n)
        g.handleInitialState((1, 2), pd.DataFrame({"active": [1]}), None)
        rows = pd.DataFrame({"t": [3, 1, 2, 4], "kind": [1, 1, 0, 1], "event_id": [3, 1, 2, 4], "citizen_id": 1, "scheme_id": 2,
                             "application_id": [None, None, 5, None], "new_status": [None, None, "REJECTED", None],
                             "stored_status": [None, None, "SUBMITTED", None], "scheme_name": "S", "refs_ok": True})
        out = pd.concat(g.handleInputRows((1, 2), iter([rows]), None))
        calls.append(g.statuses.calls)
        codes.append(dict(zip(out["request_id"], out["outcome_code"])))
        assert g.pair.v == (0, True) and g.statuses.d[(5,)] == ("REJECTED",)
    assert calls == [3, 3] and codes == [{1: -20030, 3: 0, 4: -20030}] * 2


def test_guard_stream_incremental(spark, cat001, tmp_path):
    folder = _landing(spark, cat001, tmp_path)
    got = drain(duplicate_guard_stream(cat001, folder), "guard-test")
    exp = t03_duplicate_guard(cat001)
    cols = ["request_id", "outcome_code", "message"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_guard_reopen_stream_incremental(spark, cat001, tmp_path):
    from schemelens.operators.triggers import t03b_duplicate_guard_reopen
    from schemelens.streaming.jobs import duplicate_guard_reopen_stream
    folder = _landing(spark, cat001, tmp_path)
    got = drain(duplicate_guard_reopen_stream(cat001, folder), "reopen-test")
    exp = t03b_duplicate_guard_reopen(cat001)
    cols = ["request_id", "outcome_code", "message"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_reopen_changes_outcomes(cat01):
    from schemelens.operators.triggers import t03b_duplicate_guard_reopen
    plain = {r.request_id: r.outcome_code for r in t03_duplicate_guard(cat01).collect()}
    reopen = {r.request_id: r.outcome_code for r in t03b_duplicate_guard_reopen(cat01).collect()}
    changed = [k for k in plain if plain[k] != reopen[k]]
    assert changed, "status changes in the stream should reopen some pairs"


def test_ledger_epochs_survive_failures_between_two_writes(spark, cat001, tmp_path, monkeypatch):
    """A micro-batch that fails before or after the totals are published is replayed: nothing lost, nothing doubled."""
    import pytest

    from schemelens.operators.payments import payment_run
    from schemelens.operators.triggers import pool_ledger
    from schemelens.sources import manifest
    from schemelens.streaming import jobs
    rows = payment_run(cat001)[0]
    pay, totals, checkpoint = (str(tmp_path / n) for n in ("payments", "totals", "checkpoint"))
    rows.repartition(3, "disbursement_id").write.parquet(pay)
    real, calls = manifest.commit, []

    def commit(spark, path, change):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("before the pointer moves")
        out = real(spark, path, change)
        if len(calls) == 4:
            raise OSError("after the pointer moved")
        return out

    monkeypatch.setattr(manifest, "commit", commit)
    seen = []
    for _ in range(2):
        with pytest.raises(Exception):
            jobs.run_ledger(cat001, pay, totals, checkpoint)
        seen.append(manifest.current(spark, totals).applied["stream"]["epoch"])
    got = jobs.run_ledger(cat001, pay, totals, checkpoint)
    exp = pool_ledger(cat001["pool"], rows, cat001["application"])
    assert sorted(got.collect()) == sorted(exp.select(got.columns).collect())
    assert exp.filter("payments > 0 and last_updated is not null").count() == exp.filter("payments > 0").count() > 1
    assert seen == ["0", "2"] and len(calls) == 4  # the epoch published before its failure was not published again
    before = manifest.current(spark, totals)
    jobs.publish_totals(manifest.read(spark, totals, before, jobs.LEDGER), 1, totals, checkpoint)  # an old epoch again
    assert manifest.current(spark, totals) == before
    with pytest.raises(ValueError):
        jobs.publish_totals(manifest.read(spark, totals, before, jobs.LEDGER), 9, totals, "another")


# ------------------------------------------------------- keys in groups
def _unordered_events(spark, cat, folder):
    """A catalog whose events table is three files in no order; requests and changes of a pair are in all of them."""
    import datetime as dt

    from schemelens.sources.catalog import Catalog
    folder.mkdir()
    for f in os.listdir(cat.source_dir):
        if f != "events.parquet":
            os.symlink(os.path.join(cat.source_dir, f), folder / f)
    customers = spark.read.parquet(os.path.join(cat.source_dir, "customer.parquet")).count() + 5
    apps = cat["application"].select("application_id", "citizen_id", "scheme_id").orderBy("application_id").limit(40).collect()
    kinds = ["error", "purchase", "error", "error", "view"]
    rows = []
    for i, a in enumerate(apps):  # a change of the application is a request of its pair too
        first = next(e for e in range(customers * 21) if e * 11 % customers == a.citizen_id and e % 21 == a.scheme_id)
        for j in range(6):
            at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(i * 7 + j * 31) % 97)
            rows.append((first + customers * 21 * (j * 40 + i), at, a.application_id, kinds[(i + j) % 5]))
    ev = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string")
    ev.repartition(3, "event_id").write.parquet(str(folder / "events.parquet"))
    return Catalog.from_testdata(spark, str(folder))


STREAMS = [("audit_trail_stream_tws", "t01_audit_trail"), ("duplicate_guard_stream", "t03_duplicate_guard"),
           ("duplicate_guard_reopen_stream", "t03b_duplicate_guard_reopen")]


@pytest.mark.parametrize("stream, batch", STREAMS)
def test_keys_are_handled_in_groups(spark, cat001, tmp_path, monkeypatch, stream, batch):
    """A Python call and a state a group, not a key; part files of a table, in no order, make one micro-batch."""
    from collections import Counter

    from schemelens.operators import triggers
    from schemelens.streaming import jobs
    monkeypatch.setattr(jobs, "KEY_GROUPS", 3, raising=False)
    frame = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")  # a group comes in several frames
    try:
        cat = _unordered_events(spark, cat001, tmp_path / "source")
        landing = _landing(spark, cat, tmp_path, parts=3)
        exp = getattr(triggers, batch)(cat)
        for folder, batches in ((None, 1), (landing, 3)):
            out = str(tmp_path / f"out-{batches}")
            q = (getattr(jobs, stream)(cat, folder).writeStream.format("parquet").option("path", out).outputMode("append")
                 .option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start())
            q.awaitTermination()
            done = [p for p in q.recentProgress if p["numInputRows"]]
            assert len(done) == batches
            got = spark.read.parquet(out)
            if folder is None:  # files of the landing folder are not in time order here
                assert Counter(got.select(*exp.columns).collect()) == Counter(exp.collect())
                state = done[-1]["stateOperators"][0]
                assert state["numRowsTotal"] <= 3 + state["customMetrics"].get("numMapStateVars", 0) * 40
            assert got.count() == exp.count() == 240
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", frame)


def test_ledger_micro_batches_send_no_table_to_the_driver(spark, cat001, tmp_path):
    """Micro-batches are bounded by bytes, not files, and broadcast neither payments nor what applications derive from."""
    from schemelens.operators.payments import payment_run
    from schemelens.operators.triggers import pool_ledger
    from schemelens.sources import manifest
    from schemelens.streaming import jobs
    rows = payment_run(cat001)[0]
    pay, totals, checkpoint = (str(tmp_path / n) for n in ("payments", "totals", "checkpoint"))
    rows.repartition(4, "disbursement_id").write.parquet(pay)
    plans = []
    real = jobs.publish_totals

    def publish(changed, epoch, table_path, stream):
        real(changed, epoch, table_path, stream)
        plans.append(spark.streams.active[0]._jsq.explainInternal(False))

    jobs.publish_totals = publish
    try:
        got = jobs.run_ledger(cat001, pay, totals, checkpoint, jobs.LEDGER_BATCH)
    finally:
        jobs.publish_totals = real
    assert sorted(got.collect()) == sorted(pool_ledger(cat001["pool"], rows, cat001["application"]).select(got.columns).collect())
    assert manifest.current(spark, totals).applied["stream"]["epoch"] == "0"
    assert "BroadcastExchange" not in plans[0] and "c_custkey" not in plans[0] and "SortMergeJoin" in plans[0]
