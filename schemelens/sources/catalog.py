"""Table catalog: the benefit-scheme tables as DataFrames.

``Catalog.from_testdata`` derives every table lazily from the driver's parquet
(nothing is computed until an action).  ``Catalog.materialize`` writes the
tables once as parquet into the shared checkpoint folder and returns a catalog
over the written files: that is the shape of a production deployment, where
the tables are stored and every report starts from a columnar scan with
predicate pushdown and column pruning.

Dimension tables are broadcast only behind a size check: ``dim`` / ``small``
count the rows once (memoised) and hint a broadcast only if the count is under
``BROADCAST_MAX_ROWS``; otherwise the join is left to sort-merge / AQE.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemelens.sources import fixtures, manifest, sinks
from schemelens.sources.schemas import SCHEMAS, SOURCE_SCHEMAS, SOURCE_TABLES

BROADCAST_MAX_ROWS = 200_000

_CACHE: dict[tuple, "Catalog"] = {}


def catalog_for(spark: SparkSession, sf_dir: str) -> "Catalog":
    key = (spark.sparkContext.applicationId, id(spark), os.path.abspath(sf_dir))
    cat = _CACHE.get(key)
    if cat is None:
        cat = Catalog.from_testdata(spark, sf_dir)
        _CACHE[key] = cat
    return cat


class Catalog:
    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], label: str = "",
                 source_dir: str | None = None):
        self.spark = spark
        self.frames = frames
        self.label = label
        self.source_dir = source_dir  # driver parquet folder (change-event sources for streams)
        self.broadcast_max_rows = BROADCAST_MAX_ROWS
        self.warehouse: str | None = None  # folder of the stored tables
        self.shared: list[DataFrame] = []
        #: (table, rule) -> rows that broke it, of a load with ``check``
        self.failed_rules: dict[tuple[str, str], int] = {}
        self._counts: dict[str, int] = {}
        self.memo: dict[str, DataFrame] = {}  # written results that several jobs read; gone when a table changes

    # ------------------------------------------------------------ access
    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    def __contains__(self, name: str) -> bool:
        return name in self.frames

    def names(self) -> list[str]:
        return list(self.frames)

    def row_count(self, name: str, df: DataFrame | None = None) -> int:
        if name not in self._counts:
            self._counts[name] = (df if df is not None else self.frames[name]).count()
        return self._counts[name]

    def small(self, df: DataFrame, name: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
        """Broadcast-hint ``df`` if its (memoised) row count is under max_rows."""
        return F.broadcast(df) if self.row_count(name, df) <= max_rows else df

    def dim(self, name: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
        return self.small(self.frames[name], name, max_rows)

    # ------------------------------------------------------------ builders
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Catalog":
        src = {t: spark.read.schema(SOURCE_SCHEMAS[t]).parquet(os.path.join(sf_dir, f"{t}.parquet"))
               for t in SOURCE_TABLES}
        frames: dict[str, DataFrame] = {}
        cat = cls(spark, frames, label=sf_dir, source_dir=sf_dir)
        for name in fixtures.ORDER:
            if name == "benefit":
                df = _derive_benefit(cat)
            elif name == "application":
                df = _derive_application(cat)
            else:
                binds = {d: (frames[d] if d in frames else src[d]) for d in fixtures.dependencies(name)}
                df = spark.sql(fixtures.TEMPLATES[name], **binds)
            frames[name] = _conform(df, name)
        # intermediates feeding several tables; cached while materialising
        cat.shared = [frames["application_base"], frames["benefit"], frames["citizen"]]
        for name in ("application0", "application_base"):
            frames.pop(name)  # intermediate
        return cat

    @classmethod
    def from_warehouse(cls, spark: SparkSession, path: str, source_dir: str | None = None) -> "Catalog":
        """Open stored tables: every folder with a manifest, on any file system that Spark reads.

        Tables are read with their declared schemas (others with the one they
        were stored with).
        """
        cat = cls(spark, {}, label=path, source_dir=source_dir)
        cat.warehouse = path.rstrip("/")
        for name in manifest.Folder(spark, path).names(folders=True):
            if not name.startswith((".", "_")):
                cat.refresh(name)
        return cat

    def refresh(self, name: str) -> None:
        """Read the stored table ``name`` as it is now."""
        at = f"{self.warehouse}/{name}"
        now = manifest.current(self.spark, at)
        if now is not None:
            self.frames[name] = manifest.read(self.spark, at, now, SCHEMAS.get(name))
            self._counts.clear()
            self.memo.clear()

    def append(self, name: str, rows: DataFrame, batch_id: str) -> None:
        """Insert ``rows`` into the stored table as one batch, once whatever the number of tries; later jobs see them.

        Empty strings are stored as NULL, as the modelled database does.
        """
        if self.warehouse is None:
            raise ValueError("rows are appended to stored tables: open the catalog with from_warehouse")
        rows = _conform(rows, name)
        rows = rows.select(*[F.nullif(f.name, F.lit("")).alias(f.name) if f.dataType.simpleString() == "string"
                             else F.col(f.name) for f in rows.schema.fields])
        sinks.append_rows(rows, f"{self.warehouse}/{name}", batch_id)
        self.refresh(name)

    def materialize(self, path: str, tables: list[str] | None = None, buckets: int | None = None,
                    check: bool = False) -> "Catalog":
        """Write tables as parquet under ``path`` (a shared folder) and reopen.

        Facts are clustered by their main join key inside the files (sorted
        within partitions) so parquet min/max statistics prune row groups on
        key filters.  With ``buckets`` the facts and the citizen table are
        stored as bucketed tables (same bucket count on the same key), so the
        application x citizen joins and per-citizen aggregates of the reports
        read co-partitioned data and skip the shuffle.  With ``check`` the rows
        that break each NOT NULL and CHECK rule are counted in the same pass
        (``failed_rules`` of the result).
        """
        from concurrent.futures import ThreadPoolExecutor

        from schemelens.operators import ledger, loading

        names = tables or self.names()
        db = None
        if buckets:
            db = "wh_" + os.path.basename(path.rstrip("/")).replace("-", "_")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{path}'")

        failed: dict[tuple[str, str], int] = {}

        def write(name: str) -> None:
            df = self.frames[name]
            if not check:
                store(name, df)
                return
            watched = loading.Watched(name, df)
            store(name, watched.rows)
            failed.update({(t, rule): n for t, rule, n in watched.failures()})

        def store(name: str, df: DataFrame) -> None:
            key = CLUSTER_KEYS.get(name)
            at = f"{path.rstrip('/')}/{name}"
            if buckets and key:
                folder = f"load-{uuid.uuid4().hex}"
                (df.write.bucketBy(buckets, key).sortBy(key).option("path", f"{at}/batches/{folder}")
                 .mode("overwrite").saveAsTable(f"{db}.{name}"))
                manifest.commit(self.spark, at, lambda now: manifest.Manifest(0, json.loads(df.schema.json()), {"load": folder}))
                return
            if key:
                df = df.sortWithinPartitions(key)
            sinks.load_rows(df, at)

        # intermediates read by several tables are cached for the duration of the
        # writes (the cache matches plan subtrees, so every dependent reuses them);
        # a lost executor only means recomputing them from lineage
        for df in self.shared:
            df.persist()
        try:
            # independent tables: submit the write jobs concurrently (Spark schedules them side by side)
            with ThreadPoolExecutor(max_workers=4) as pool:
                list(pool.map(write, names))
        finally:
            for df in self.shared:
                df.unpersist()
        if {"pool", "disbursement"} <= set(names):
            ledger.mark_applied(self.spark, path)  # the stored pool totals include the stored payments
        cat = Catalog.from_warehouse(self.spark, path, source_dir=self.source_dir)
        cat.failed_rules = failed
        if buckets:
            for name in names:
                if CLUSTER_KEYS.get(name):
                    cat.frames[name] = self.spark.table(f"{db}.{name}")
        return cat


# main join key of each stored table (clustering / bucketing key)
CLUSTER_KEYS = {"application": "citizen_id", "citizen": "citizen_id", "disbursement": "application_id",
                "status_event": "application_id", "citizen_document": "citizen_id"}


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Cast to the declared schema (column order and types)."""
    ddl = SCHEMAS.get(name)
    if ddl is None:
        return df
    cols = []
    for field in ddl.split(", "):
        cname, ctype = field.split(" ", 1)
        cols.append(F.col(cname).cast(ctype).alias(cname) if cname in df.columns
                    else F.lit(None).cast(ctype).alias(cname))
    return df.select(*cols)


def _derive_benefit(cat: Catalog) -> DataFrame:
    from schemelens.functions.rules import benefit_amount, rule_inputs
    base = cat.frames["application_base"].select("application_id", "citizen_id", "scheme_id")
    # inner semantics of the fixture: only pairs whose citizen and scheme exist
    joined = rule_inputs(base, cat, need_rules=False).filter(
        F.col("_c_found").isNotNull() & F.col("_s_found").isNotNull())
    return joined.select("application_id", "citizen_id", "scheme_id", benefit_amount().alias("amount"))


def _derive_application(cat: Catalog) -> DataFrame:
    """Stored application rows: generated status plus the columns the intake
    procedure stores: priority score of the citizen and, on generated
    rejections, the eligibility text as rejection reason."""
    from schemelens.functions.rules import eligibility_reason, priority_score, rule_inputs
    base = cat.frames["application_base"]
    joined = rule_inputs(base, cat)
    return joined.select(
        "application_id", "citizen_id", "scheme_id", "officer_id", "apply_date", "status", "approval_date",
        priority_score().alias("priority_score"),
        F.when(F.col("status") == "REJECTED", eligibility_reason()).alias("rejection_reason"),
        F.lit(None).cast("string").alias("remarks"))


# ------------------------------------------------------------- oracle side
def oracle_ctes(body: str) -> str:
    """Prefix a DuckDB query with the fixture CTEs it needs (transitively)."""
    from schemelens.functions.rules import (RULES_BY_SCHEME_SQL, eligibility_reason_sql,
                                            priority_score_sql)
    import re

    known = list(fixtures.ORDER)
    needed: set[str] = set()

    def visit(n: str):
        if n in needed:
            return
        needed.add(n)
        for d in fixtures.dependencies(n):
            if d in known:
                visit(d)

    for n in known:
        if re.search(rf"\b{n}\b", body):
            visit(n)
    parts = []
    for n in known:
        if n not in needed:
            continue
        if n == "application":
            text = (
                "select a.application_id, a.citizen_id, a.scheme_id, a.officer_id, a.apply_date, a.status, "
                "a.approval_date, case when c.citizen_id is null then 0 else " + priority_score_sql("c") + " end as priority_score, "
                "case when a.status = 'REJECTED' then " + eligibility_reason_sql("c", "s", "r") + " end as rejection_reason, "
                "cast(null as varchar) as remarks from application_base a left join citizen c on a.citizen_id = c.citizen_id "
                "left join scheme s on a.scheme_id = s.scheme_id left join "
                + RULES_BY_SCHEME_SQL.replace(" from rules ", " from rules ") + " r on a.scheme_id = r.scheme_id")
        else:
            text = fixtures.TEMPLATES[n]
            text = fixtures._PLACEHOLDER.sub(lambda m: m.group(1), text)
        parts.append(f"{n} as ({text.strip()})")
    body = body.strip()
    if not parts:
        return body
    if body[:15].lower() == "with recursive ":
        return "with recursive " + ",\n".join(parts) + ",\n" + body[15:]
    if body[:5].lower() == "with ":
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body
