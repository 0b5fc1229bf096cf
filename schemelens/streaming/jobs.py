"""Structured Streaming forms of the change-driven jobs (t01, t02, t03).

Each job reads its change events with ``readStream`` from the driver's files,
enriches them with stream-static joins against the catalog tables and keeps
per-key state with ``applyInPandasWithState`` or ``transformWithStateInPandas``
(Arrow batches, one pandas frame per key and micro-batch).  State is keyed by the entity that the
modelled trigger serialises on (the application; the (citizen, scheme)
pair; the scheme), so it is partitioned across the cluster by key and
checkpointed in the shared checkpoint folder.  A Python call costs some
milliseconds, so the guards and s01b get the keys in groups
(``KEY_GROUPS``): one call handles the rows of all keys of a group with array
operations, and one state holds an entry for each of them.

The registered ``sNN`` jobs drain the whole source with
``trigger(availableNow=True)`` into a parquet sink and return the sink as a
DataFrame: over the same input they must equal the batch forms, so they share
their oracles.
"""

from __future__ import annotations

import json
import os
import sys
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from schemelens.functions.semantics import checkpoint_table
from schemelens.operators.triggers import CHANGED_BY, DUPLICATE_MESSAGE
from schemelens.registry import JOBS, register
from schemelens.session import checkpoint_dir
from schemelens.sources import fixtures, manifest

try:  # ship the per-key step functions by value: executors need only pandas
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass


def _stream_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def _source(cat, table: str, folder: str | None = None) -> DataFrame:
    """Streaming read of change events: the driver's table, or a landing
    folder of parquet files with the same schema (one file per micro-batch).

    The files of a landing folder arrive one after another.  Those of a table lie in no
    order, and a key's events may be in any of them, so all that there are form one micro-batch."""
    spark = cat.spark
    from schemelens.sources.schemas import SOURCE_SCHEMAS
    path = os.path.join(cat.source_dir, f"{table}.parquet")
    static = spark.read.schema(SOURCE_SCHEMAS[table]).parquet(path)
    # a file stream source lists a directory or glob: the glob matches exactly this file
    reader = spark.readStream.schema(static.schema)
    if folder is not None:
        return reader.option("maxFilesPerTrigger", 1).parquet(folder)
    return reader.parquet(path[:-1] + "[t]")


def stored_applications(cat) -> DataFrame:
    """What the streams need of the applications, as a stored table: micro-batches read it again and are planned
    without AQE, so they are spared its derivation."""
    if cat.warehouse is not None:
        return cat["application"]
    if "applications" not in cat.memo:
        cat.memo["applications"] = checkpoint_table(
            cat["application"].select("application_id", "citizen_id", "scheme_id", "status"))
    return cat.memo["applications"]


# ------------------------------------------------------- groups of keys
#: Groups that the keys of a stream are dealt into; a checkpoint belongs to the number that it was made with.
KEY_GROUPS = 4096


def _key_group(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS)).cast("int")


def _packed(entries: pd.DataFrame) -> bytes:
    """The entries of a group's keys as one state value (an Arrow stream)."""
    table, sink = pa.Table.from_pandas(entries, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(value)).read_all().to_pandas()


def _numbered(rows: pd.DataFrame, known: pd.DataFrame, by: list[str]) -> tuple[np.ndarray, pd.DataFrame]:
    """The number of each row's key and the keys by number; ``known`` holds each of its keys once, they come first."""
    keys = pd.concat([known[by], rows[by]], ignore_index=True) if len(known) else rows[by]
    return keys.groupby(by, sort=False).ngroup().to_numpy()[len(known):], keys.drop_duplicates(ignore_index=True)


def status_event_stream(cat, folder: str | None = None) -> DataFrame:
    text = fixtures.TEMPLATES["status_event"]
    return _source(cat, "events", folder).select(
        "event_id", F.col("user_id").alias("application_id"),
        F.expr(text.split("user_id as application_id, ")[1].split(" as new_status")[0]).alias("new_status"),
        F.col("ts").alias("change_date"))


# ----------------------------------------------------------------- t01
AUDIT_OUT = "audit_id long, application_id long, old_status string, new_status string, changed_by string, " \
            "change_date timestamp_ntz"


def _audit_step(key, frames, state):
    out = []
    for pdf in frames:
        out.append(pdf)
    if not out:
        return
    pdf = pd.concat(out).sort_values(["change_date", "event_id"], kind="stable")
    prev = pdf["new_status"].shift(1)
    prev.iloc[0] = state.get[0] if state.exists else pdf["stored_status"].iloc[0]
    state.update((pdf["new_status"].iloc[-1],))
    yield pd.DataFrame({"audit_id": pdf["event_id"].to_numpy(), "application_id": pdf["application_id"].to_numpy(),
                        "old_status": prev.to_numpy(), "new_status": pdf["new_status"].to_numpy(),
                        "changed_by": CHANGED_BY, "change_date": pdf["change_date"].to_numpy()})


def _requested_scheme(cat):
    """Scheme of a request, as in the fixture: every 21st names one that does not exist."""
    n = F.col("event_id") % 21
    return F.when(n == 20, F.lit(cat["scheme"].count() + 5)).otherwise(n)


def _stored(cat) -> DataFrame:
    return stored_applications(cat).select("application_id", F.col("status").alias("stored_status"))


def audit_trail_stream(cat, folder: str | None = None) -> DataFrame:
    ev = status_event_stream(cat, folder).join(_stored(cat), "application_id")
    return ev.groupBy("application_id").applyInPandasWithState(
        _audit_step, AUDIT_OUT, "last_status string", "append", GroupStateTimeout.NoTimeout)


class AuditProcessor(StatefulProcessor):
    """Keeps the last status of each application of a group in a ValueState; emits
    one audit row per status change in arrival order (event time, then event id).
    The stored statuses are the initial state, read in the first micro-batch
    only; an application without an entry is not stored and leaves no row."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last_status", "applications binary")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        stored = initialState[["application_id", "stored_status"]].rename(columns={"stored_status": "status"})
        if self.last.exists():  # a group may come in several frames
            stored = pd.concat([_unpacked(self.last.get()[0]), stored])
        self.last.update((_packed(stored.drop_duplicates("application_id")),))

    def handleInputRows(self, key, rows, timerValues):
        parts = [p for p in rows if len(p)]  # a key with initial state only comes with an empty frame
        if not parts or not self.last.exists():
            return
        last = _unpacked(self.last.get()[0])
        pdf = pd.concat(parts)
        pdf = pdf[pdf["application_id"].isin(last["application_id"])]
        if not len(pdf):
            return
        pdf = pdf.sort_values(["change_date", "event_id"], kind="stable")
        entry = pd.Index(last["application_id"]).get_indexer(pdf["application_id"])
        new, status = (c.astype(object).where(c.notna(), None).to_numpy() for c in (pdf["new_status"], last["status"]))
        by_app = np.argsort(entry, kind="stable")
        first = np.concatenate(([True], np.diff(entry[by_app]) != 0))
        old = np.empty(len(pdf), dtype=object)
        old[by_app] = np.where(first, status[entry[by_app]], np.roll(new[by_app], 1))
        ends = by_app[np.roll(first, -1)]  # the last change of each application
        status[entry[ends]] = new[ends]
        self.last.update((_packed(last.assign(status=status)),))
        yield pd.DataFrame({"audit_id": pdf["event_id"].to_numpy(),
                            "application_id": pdf["application_id"].to_numpy(),
                            "old_status": pd.Series(old, dtype=object), "new_status": pd.Series(new, dtype=object),
                            "changed_by": CHANGED_BY, "change_date": pdf["change_date"].to_numpy()})

    def close(self) -> None:
        pass


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store: set only when the session names no such provider."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def audit_trail_stream_tws(cat, folder: str | None = None) -> DataFrame:
    """t01 with ``transformWithStateInPandas``; the stored statuses are its initial state, so
    no micro-batch after the first reads the applications."""
    _rocksdb(cat.spark)
    events, stored = (df.filter(F.col("application_id").isNotNull()).withColumn("key_group", _key_group("application_id"))
                      for df in (status_event_stream(cat, folder), _stored(cat)))
    return events.groupBy("key_group").transformWithStateInPandas(
        AuditProcessor(), AUDIT_OUT, "Append", "None", initialState=stored.groupBy("key_group"))


def drain(df: DataFrame, name: str) -> DataFrame:
    """Run a streaming DataFrame over everything available, return the sink."""
    spark = df.sparkSession
    base = _stream_folder(spark, name)
    q = (df.writeStream.format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "checkpoint")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out"))


@register("s01_audit_trail_stream")
def s01_audit_trail_stream(cat) -> DataFrame:
    """t01 as a stateful stream: last status per application kept in state."""
    return drain(audit_trail_stream(cat), "audit")


# ----------------------------------------------------------------- t03
PAIR = ["citizen", "scheme"]  # the ids of a pair without NULLs (``_pair_groups``)
STEP_OUT = "request_id long, citizen long, scheme long, key_group int, outcome_code int, message string"


def _pair_groups(df: DataFrame) -> DataFrame:
    """Adds the group of each row's pair and its ids; pairs with a NULL id are in groups of their own, below 0."""
    c, s = F.col("citizen_id"), F.col("scheme_id")
    group = (F.when(c.isNull() & s.isNull(), F.lit(-3)).when(s.isNull(), F.lit(-2)).when(c.isNull(), F.lit(-1))
             .otherwise(_key_group("citizen_id", "scheme_id")))
    return df.select("*", group.alias("key_group"), F.coalesce(c, F.lit(0)).alias("citizen"), F.coalesce(s, F.lit(0)).alias("scheme"))


def _guard_rows(df: DataFrame) -> DataFrame:
    group = F.col("key_group")
    return df.select("request_id", F.when(~group.isin(-1, -3), F.col("citizen")).alias("citizen_id"),
                     F.when(~group.isin(-2, -3), F.col("scheme")).alias("scheme_id"), "outcome_code", "message")


def _outcomes(pair, request, refs_ok, active_before, stored):
    """Outcome codes of rows in arrival order, and which pairs have an insert stored afterwards.

    Until a pair has one: duplicates while it is active, FK failures before the first insert with valid
    references, that insert is stored; the rest are duplicates.
    """
    at = np.arange(len(pair))
    open_ = (active_before == 0) & ~stored[pair]
    ok = open_ & request & refs_ok
    first = np.full(len(stored), len(pair))
    np.minimum.at(first, pair[ok], at[ok])
    codes = np.full(len(pair), -20030, dtype=np.int32)
    codes[open_ & (at < first[pair])] = -2291
    codes[at == first[pair]] = 0
    return codes, stored | (first < len(pair))


def _messages(codes, names):
    return np.where(codes == 0, "INSERTED",
                    np.where(codes == -2291, "integrity constraint violated - parent key not found",
                             np.array([DUPLICATE_MESSAGE + str(x) for x in names], dtype=object)))


def _guard_step(key, frames, state):
    parts = [p for p in frames]
    if not parts:
        return
    pdf = pd.concat(parts).sort_values(["requested_at", "request_id"], kind="stable")
    known = _unpacked(state.get[0]) if state.exists else pd.DataFrame(columns=[*PAIR, "active"])
    pair, pairs = _numbered(pdf, known, PAIR)
    active = np.zeros(len(pairs), dtype=bool)
    first = ~pd.Series(pair).duplicated().to_numpy()
    active[pair[first]] = pdf["_stored_active"].to_numpy(dtype=bool)[first]
    active[:len(known)] = known["active"].to_numpy(dtype=bool)
    codes, active = _outcomes(pair, np.ones(len(pdf), dtype=bool), pdf["_refs_ok"].to_numpy(dtype=bool),
                              np.zeros(len(pdf), dtype=np.int64), active)
    state.update((_packed(pairs.assign(active=active)),))
    yield pd.DataFrame({"request_id": pdf["request_id"].to_numpy(), "citizen": pdf["citizen"].to_numpy(),
                        "scheme": pdf["scheme"].to_numpy(), "key_group": key[0], "outcome_code": codes,
                        "message": _messages(codes, pdf["scheme_name"].astype(object).to_numpy())})


def duplicate_guard_stream(cat, folder: str | None = None) -> DataFrame:
    from schemelens.functions import rules as R
    customers = cat.spark.read.parquet(os.path.join(cat.source_dir, "customer.parquet")).count()
    ev = _source(cat, "events", folder).select(
        F.col("event_id").alias("request_id"),
        ((F.col("event_id") * 11) % F.lit(customers + 5)).alias("citizen_id"),
        _requested_scheme(cat).alias("scheme_id"), F.col("ts").alias("requested_at"))
    act = R.active_keys(stored_applications(cat)).withColumn("_stored_active", F.lit(True))
    cz = cat["citizen"].select("citizen_id", F.lit(True).alias("_c"))
    sc = cat.dim("scheme").select("scheme_id", "scheme_name")
    ev = (ev.join(act, ["citizen_id", "scheme_id"], "left").join(cz, "citizen_id", "left")
          .join(sc, "scheme_id", "left")
          .select("request_id", "citizen_id", "scheme_id", "requested_at", "scheme_name",
                  F.coalesce("_stored_active", F.lit(False)).alias("_stored_active"),
                  (F.col("_c").isNotNull() & F.col("scheme_name").isNotNull()).alias("_refs_ok")))
    return _guard_rows(_pair_groups(ev).drop("citizen_id", "scheme_id").groupBy("key_group").applyInPandasWithState(
        _guard_step, STEP_OUT, "pairs binary", "append", GroupStateTimeout.NoTimeout))


@register("s03_duplicate_guard_stream")
def s03_duplicate_guard_stream(cat) -> DataFrame:
    """t03 as a stateful stream: per (citizen, scheme) 'has an active application' state."""
    return drain(duplicate_guard_stream(cat), "guard")


# ----------------------------------------------------------------- t03b
class ReopenGuard(StatefulProcessor):
    """A (citizen, scheme) pair's time line of status changes and inserts.

    ``pair`` holds the count of active stored applications and whether an insert
    was stored; its initial state comes from the stored applications.  ``statuses``
    maps an application of the pair to the last status a change gave it, so a
    change reads and writes its own entry, however many applications the pair has.
    (Columns of the rows have no leading underscore: later micro-batches would rename them.)
    """

    def init(self, handle) -> None:
        self.pair = handle.getValueState("pair", "active long, stored boolean")
        self.statuses = handle.getMapState("statuses", "application_id long", "status string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.pair.update((int(initialState["active"].iloc[0]), False))

    def _deltas(self, st):
        """Changes of the active count by the status changes ``st`` of one micro-batch, in order."""
        apps, known = st["application_id"].astype("int64").tolist(), {}
        for a, stored in zip(apps, st["stored_status"]):
            if a not in known:
                known[a] = self.statuses.getValue((a,))[0] if self.statuses.containsKey((a,)) else stored
        out = np.zeros(len(st), dtype=np.int64)
        for i, (a, new) in enumerate(zip(apps, st["new_status"])):
            out[i] = int(new != "REJECTED") - int(known[a] != "REJECTED")
            known[a] = new
        for a, status in known.items():
            self.statuses.updateValue((a,), (status,))
        return out

    def handleInputRows(self, key, rows, timerValues):
        parts = [p for p in rows if len(p)]  # a key with initial state only comes with an empty frame
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(["t", "kind", "event_id"], kind="stable")
        active0, stored = self.pair.get() if self.pair.exists() else (0, False)
        n, rq = len(pdf), pdf["kind"].to_numpy() == 1
        delta = np.zeros(n, dtype=np.int64)
        if not rq.all():
            delta[~rq] = self._deltas(pdf[~rq])
        active_before = active0 + np.concatenate([[0], np.cumsum(delta)[:-1]])
        codes, after = _outcomes(np.zeros(n, dtype=np.int64), rq, pdf["refs_ok"].to_numpy(dtype=bool), active_before,
                                 np.array([bool(stored)]))
        self.pair.update((int(active0 + delta.sum()), bool(after[0])))
        if rq.any():
            c = codes[rq]
            yield pd.DataFrame({"request_id": pdf["event_id"].to_numpy()[rq], "citizen_id": pdf["citizen_id"].to_numpy()[rq],
                                "scheme_id": pdf["scheme_id"].to_numpy()[rq], "outcome_code": c,
                                "message": _messages(c, pdf["scheme_name"].to_numpy()[rq])})

    def close(self) -> None:
        pass


class ReopenGuards(ReopenGuard):
    """The time lines of all pairs of a group, each as in ``ReopenGuard``.

    ``pairs`` holds what ``pair`` holds there, for every pair of the group; ``statuses``
    has an entry for each application that was changed, read and written alone.
    """

    def init(self, handle) -> None:
        self.pairs = handle.getValueState("pairs", "pairs binary")
        self.statuses = handle.getMapState("statuses", "citizen long, scheme long, application_id long", "status string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = initialState[[*PAIR, "active"]].assign(stored=False)
        if self.pairs.exists():  # a group may come in several frames
            held = pd.concat([_unpacked(self.pairs.get()[0]), held])
        self.pairs.update((_packed(held),))

    def _deltas(self, st):
        """Changes of the active counts by the status changes ``st`` of one micro-batch, in order."""
        change, apps = _numbered(st, pd.DataFrame(), [*PAIR, "application_id"])
        new = st["new_status"].astype(object).where(st["new_status"].notna(), None).to_numpy()
        by_app = np.argsort(change, kind="stable")
        first = np.concatenate(([True], np.diff(change[by_app]) != 0))
        ends = by_app[np.roll(first, -1)]
        before = np.roll(new[by_app], 1)
        before[first] = st["stored_status"].to_numpy(dtype=object)[by_app[first]]
        firsts = np.flatnonzero(first)
        for i, end, k in zip(firsts, ends, map(tuple, apps.to_numpy().tolist())):
            if self.statuses.containsKey(k):
                before[i] = self.statuses.getValue(k)[0]
            self.statuses.updateValue(k, (new[end],))
        out = np.zeros(len(st), dtype=np.int64)
        out[by_app] = (new[by_app] != "REJECTED").astype(np.int64) - (before != "REJECTED").astype(np.int64)
        return out

    def handleInputRows(self, key, rows, timerValues):
        parts = [p for p in rows if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(["t", "kind", "event_id"], kind="stable")
        known = _unpacked(self.pairs.get()[0]) if self.pairs.exists() else pd.DataFrame(columns=[*PAIR, "active", "stored"])
        pair, pairs = _numbered(pdf, known, PAIR)
        active, stored = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
        active[:len(known)], stored[:len(known)] = known["active"].to_numpy(np.int64), known["stored"].to_numpy(bool)
        rq = pdf["kind"].to_numpy() == 1
        delta = np.zeros(len(pdf), dtype=np.int64)
        if not rq.all():
            delta[~rq] = self._deltas(pdf[~rq])
        before = active[pair] + pd.Series(delta).groupby(pair).cumsum().to_numpy() - delta
        codes, stored = _outcomes(pair, rq, pdf["refs_ok"].to_numpy(dtype=bool), before, stored)
        np.add.at(active, pair, delta)
        self.pairs.update((_packed(pairs.assign(active=active, stored=stored)),))
        if rq.any():
            c = codes[rq]
            yield pd.DataFrame({"request_id": pdf["event_id"].to_numpy()[rq], "citizen": pdf["citizen"].to_numpy()[rq],
                                "scheme": pdf["scheme"].to_numpy()[rq], "key_group": key[0], "outcome_code": c,
                                "message": _messages(c, pdf["scheme_name"].to_numpy()[rq])})


def duplicate_guard_reopen_stream(cat, folder: str | None = None) -> DataFrame:
    """One change stream (the events files) seen both as status changes of
    stored applications and as insert requests, keyed by (citizen, scheme)."""
    customers = cat.spark.read.parquet(os.path.join(cat.source_dir, "customer.parquet")).count()
    src = _source(cat, "events", folder)
    text = fixtures.TEMPLATES["status_event"]
    status_expr = F.expr(text.split("user_id as application_id, ")[1].split(" as new_status")[0])
    stored = stored_applications(cat)
    app = stored.select("application_id", "citizen_id", "scheme_id", F.col("status").alias("stored_status"))
    st = (src.select("event_id", F.col("user_id").alias("application_id"), status_expr.alias("new_status"),
                     F.col("ts").alias("t"))
          .join(app, "application_id")
          .select("citizen_id", "scheme_id", "t", F.lit(0).alias("kind"), "event_id", "application_id",
                  "new_status", "stored_status"))
    rq = src.select(((F.col("event_id") * 11) % F.lit(customers + 5)).alias("citizen_id"),
                    _requested_scheme(cat).alias("scheme_id"), F.col("ts").alias("t"), F.lit(1).alias("kind"),
                    "event_id", F.lit(0).cast("long").alias("application_id"),
                    F.lit(None).cast("string").alias("new_status"), F.lit(None).cast("string").alias("stored_status"))
    held = (stored.filter(F.col("status") != "REJECTED").dropna(subset=["citizen_id", "scheme_id"])
            .groupBy("citizen_id", "scheme_id").agg(F.count(F.lit(1)).alias("active")))
    cz = cat["citizen"].select("citizen_id", F.lit(True).alias("_c"))
    sc = cat.dim("scheme").select("scheme_id", "scheme_name")
    u = (st.unionByName(rq).join(cz, "citizen_id", "left").join(sc, "scheme_id", "left")
         .select("citizen_id", "scheme_id", "t", "kind", "event_id", "application_id", "new_status", "stored_status",
                 "scheme_name",
                 (F.col("_c").isNotNull() & F.col("scheme_name").isNotNull()).alias("refs_ok")))
    _rocksdb(cat.spark)
    u, held = (_pair_groups(df).drop("citizen_id", "scheme_id").groupBy("key_group") for df in (u, held))
    return _guard_rows(u.transformWithStateInPandas(ReopenGuards(), STEP_OUT, "Append", "None", initialState=held))


@register("s03b_duplicate_guard_reopen_stream")
def s03b_duplicate_guard_reopen_stream(cat) -> DataFrame:
    """t03b as a stateful stream: per-pair active count reopened by rejections."""
    return drain(duplicate_guard_reopen_stream(cat), "guard-reopen")


# ----------------------------------------------------------------- t02
LEDGER = "scheme_id bigint, added_amount decimal(25,2), payments bigint, last_updated timestamp_ntz"


#: Bytes of payments in a micro-batch of ``s02``: each micro-batch reads the applications, so their number must not follow
#: the number of files.
LEDGER_BATCH = 256 << 20


def pool_ledger_stream(cat, payments_path: str, batch_bytes: int | None = None) -> DataFrame:
    """Totals of each scheme's payments so far; an update holds the schemes that changed.

    A micro-batch takes one file, or files of about ``batch_bytes``.  It is planned without AQE and would broadcast
    whichever side looks small, again each time: the merge join keeps payments and applications off the driver.
    """
    from schemelens.operators.triggers import payment_totals
    spark = cat.spark
    static = spark.read.parquet(payments_path)
    limit = ("maxBytesPerTrigger", batch_bytes) if batch_bytes else ("maxFilesPerTrigger", 1)
    pay = spark.readStream.schema(static.schema).option(*limit).parquet(payments_path)
    return payment_totals(pay, stored_applications(cat).hint("merge"))


def publish_totals(changed: DataFrame, epoch: int, table_path: str, stream: str) -> None:
    """Put the totals of one micro-batch in place of the schemes' earlier ones, once however often it is replayed.

    The whole table (one row a scheme) is written to a folder named by the epoch, then the next manifest names that
    folder and the epoch together.  A failure before that leaves the former totals, and the replayed epoch writes them
    again; an epoch that the manifest has already is left out.  A table belongs to one stream (its checkpoint): another
    one would count its epochs from 0 and be left out wrongly, so it is refused.
    """
    spark = changed.sparkSession
    now = manifest.current(spark, table_path)
    done = now.applied.get("stream", {}) if now else {}
    if done and done["name"] != stream:
        raise ValueError(f"{table_path} holds the totals of stream {done['name']}, not of {stream}")
    if done and int(done["epoch"]) >= epoch:
        changed.write.format("noop").mode("overwrite").save()  # the stream's state of this epoch must be written all the same
        return
    totals = changed.select([F.col(f.split(" ")[0]).cast(f.split(" ", 1)[1]) for f in LEDGER.split(", ")])
    if now:
        totals = manifest.read(spark, table_path, now, LEDGER).join(totals, "scheme_id", "left_anti").unionByName(totals)
    folder = manifest.write_batch(totals, table_path, f"epoch-{epoch}")

    def change(latest):
        if (latest.number if latest else 0) != (now.number if now else 0):
            raise RuntimeError(f"{table_path} was changed by another writer during epoch {epoch}")
        return manifest.Manifest(0, json.loads(totals.schema.json()), {"totals": folder},
                                 {"stream": {"name": stream, "epoch": str(epoch)}})

    manifest.commit(spark, table_path, change)


def run_ledger(cat, payments_path: str, table_path: str, checkpoint: str, batch_bytes: int | None = None) -> DataFrame:
    """Drain the payments into the stored totals at ``table_path``; the pools with these totals added."""
    from schemelens.operators.triggers import closing_pools
    q = (pool_ledger_stream(cat, payments_path, batch_bytes).writeStream.outputMode("update")
         .foreachBatch(lambda batch, epoch: publish_totals(batch, epoch, table_path, checkpoint))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    now = manifest.current(cat.spark, table_path)
    totals = manifest.read(cat.spark, table_path, now, LEDGER) if now else cat.spark.createDataFrame([], LEDGER)
    return closing_pools(cat["pool"], totals)


@register("s02_pool_ledger_stream")
def s02_pool_ledger_stream(cat) -> DataFrame:
    """t02 as a streaming aggregation: changed totals of each micro-batch published as one epoch (update mode)."""
    from schemelens.operators.payments import payment_run
    base = _stream_folder(cat.spark, "ledger")
    payment_run(cat)[0].write.parquet(os.path.join(base, "payments"))
    return run_ledger(cat, os.path.join(base, "payments"), os.path.join(base, "totals"), os.path.join(base, "checkpoint"),
                      LEDGER_BATCH)


@register("s01b_audit_trail_value_state")
def s01b_audit_trail_value_state(cat) -> DataFrame:
    """t01 as a transformWithState stream: ValueState(last_status) per application."""
    return drain(audit_trail_stream_tws(cat), "audit-tws")


# streams over the same input equal the batch forms
JOBS["s01_audit_trail_stream"].oracle = JOBS["t01_audit_trail"].oracle
JOBS["s01b_audit_trail_value_state"].oracle = JOBS["t01_audit_trail"].oracle
JOBS["s02_pool_ledger_stream"].oracle = JOBS["t02_pool_ledger"].oracle
JOBS["s03_duplicate_guard_stream"].oracle = JOBS["t03_duplicate_guard"].oracle
JOBS["s03b_duplicate_guard_reopen_stream"].oracle = JOBS["t03b_duplicate_guard_reopen"].oracle
