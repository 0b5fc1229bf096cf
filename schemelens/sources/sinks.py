"""Sinks: result sets and stored tables written as parquet.

``write_result`` stores a job's DataFrame.  A stored table is a set of batches
listed by its manifest (``sources.manifest``): ``load_rows`` starts it or
replaces all its batches, ``append_rows`` (the table-insert sink, for example the
payment run's rows) adds a batch, ``read_rows`` reads all of them with a declared
schema.  ``Catalog`` writes and reads its warehouse through these.  A batch that
is written again under its id replaces its earlier try.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from schemelens.sources import manifest


def write_result(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_rows(df: DataFrame, table_path: str, applied: dict | None = None) -> str:
    """Start the stored table at ``table_path`` with ``df``; replaces all its batches in one commit."""
    folder = manifest.write_batch(df, table_path, "load")
    manifest.commit(df.sparkSession, table_path, lambda now: manifest.Manifest(
        0, json.loads(df.schema.json()), {"load": folder}, applied or {}))
    return f"{table_path.rstrip('/')}/batches/{folder}"


def append_rows(df: DataFrame, table_path: str, batch_id: str) -> str:
    """Insert ``df`` into the stored table at ``table_path`` as batch ``batch_id``."""
    if manifest.current(df.sparkSession, table_path) is None:
        raise ValueError(f"no stored table at {table_path}: load_rows starts one")
    folder = manifest.write_batch(df, table_path, batch_id)
    manifest.commit(df.sparkSession, table_path, lambda now: replace(now, batches=now.batches | {batch_id: folder}))
    return f"{table_path.rstrip('/')}/batches/{folder}"


def read_rows(spark: SparkSession, table_path: str, schema: str | None = None) -> DataFrame:
    """All rows of the stored table, whatever batch wrote them."""
    now = manifest.current(spark, table_path)
    if now is None:
        raise ValueError(f"no stored table at {table_path}")
    return manifest.read(spark, table_path, now, schema)
