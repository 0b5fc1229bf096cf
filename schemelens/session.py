"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting protects the citizen/application
# joins when one key carries a large share of the rows.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # stream state (per application / pair / scheme) can outgrow executor memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The rule texts are long CASE chains; fused into one whole-stage method they
    # exceed HotSpot's 8000-bytecode JIT limit and would run interpreted (measured
    # 3x slower).  Let the JIT compile large generated methods (driver and executors;
    # only effective when the JVMs are launched with this configuration).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "schemelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when the session leaves it unset (local tests) a
    scratch folder is created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="schemelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
