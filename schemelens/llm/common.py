"""Helpers shared by the operators: shared-folder tables, row keys, Arrow row batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from schemelens.session import checkpoint_dir

#: Characters of text that one block of rows holds inside a task.
BLOCK_CHARS = 1 << 20


class Scratch:
    """Intermediate tables in the folder that all executors share.

    ``keep`` writes a frame as Parquet and reads it back, which cuts its
    lineage: an executor that is lost later costs no recomputation of it.
    ``drop`` removes tables that no later frame reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/t{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._kept_path = path
        return out

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps: it does so when the driver's JVM collects their frames."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._kept_path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Let the system have the memory that Arrow and the C library hold free: worker processes serve many tasks."""
    pa.default_memory_pool().release_unused()
    if _trim:  # glibc
        _trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with ``fn`` called per bounded slice of rows; workers give free memory back after each batch."""
    text_at = [i for i, f in enumerate(df.schema.fields) if f.dataType.typeName() in ("string", "binary", "array")]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_at):
                yield from fn(part)
            batch = part = None
            give_back()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text_at: list[int], most: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts and lists of a slice stay near ``most`` bytes (a longer single row stands alone)."""
    size = sum(batch.column(i).nbytes for i in text_at)
    if size <= most or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    mid = batch.num_rows // 2
    yield from slices(batch.slice(0, mid), text_at, most)
    yield from slices(batch.slice(mid), text_at, most)


def record_batch(schema: StructType, columns: list) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def keyed(df: DataFrame, id_col: str, tie: list[str]) -> tuple[DataFrame, bool]:
    """Add the long column ``_key`` that orders rows by (id, tie columns), and say whether the keys are the ids.

    Ids that are all present and distinct are the keys themselves.  Otherwise
    rows are dealt out by ranges, numbered in order and written once, so that
    repeated ids stay separate rows whatever size the ids have; rows without
    an id come last.  ``component_ids`` maps components back to ids.
    """
    counts = df.groupBy(F.col(id_col).alias("i")).agg(F.count("*").alias("n"))
    n, nulls = counts.agg(F.max("n"), F.max(F.col("i").isNull().cast("int"))).first()
    if (n or 1) == 1 and not nulls:
        return df.withColumn("_key", F.col(id_col).cast("long")), True
    by_id = F.col(id_col).asc_nulls_last()
    dealt = df.repartitionByRange(by_id).sortWithinPartitions(by_id, *tie)
    return Scratch(df.sparkSession, "keys").keep(dealt.withColumn("_key", F.monotonically_increasing_id())), False


def component_ids(found: DataFrame, rows: DataFrame, id_col: str, own: bool) -> DataFrame:
    """``found`` with component_id, the id of the row of ``rows`` whose key its component is; null if that has none."""
    if own:
        return found.withColumn("component_id", F.col("component"))
    ids = rows.select(F.col("_key").alias("component"), F.col(id_col).cast("long").alias("component_id"))
    return found.join(ids, "component")
