"""Session set-up and the shared checkpoint folder.

Cluster settings come from the session the caller hands us. The only thing
we ever set ourselves is a checkpoint folder, and only when the session has
none and runs in local mode (tests, laptops). On a cluster an unset
``spark.checkpoint.dir`` is an error: a machine-local folder would not
survive the loss of the executor that wrote it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for local runs (tests, bench). A cluster brings its own.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  driver_memory: str = "6g", app_name: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every "
            "executor can reach (HDFS, object store) before building a star")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str, compression: str | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return a reader of it.

    This cuts the lineage like a reliable checkpoint, survives executor loss
    (the files live in shared storage), and unlike a checkpointed RDD keeps
    what the planner needs at scale: file statistics for size-checked
    broadcasts, column pruning and filter pushdown into the scan. Tables as
    large as the input name a ``compression``; else the session's applies."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df, by: str, label: str, compression: str | None = None):
    """As :func:`materialize`, but bucketed by one column into as many buckets
    as the session has shuffle partitions, so that joins and aggregates on it
    need no exchange. Rows that an exchange on that column has placed already
    are written where they are. Only a catalog table can be written so; its
    name goes at once, the reader and the files under the scratch folder stay."""
    spark = df.sparkSession
    name = f"ledgerline_{label.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, by).sortBy(by).option("path", scratch_path(spark, label))
    (writer.option("compression", compression) if compression else writer).saveAsTable(name)
    reader = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return reader


def release_scratch(spark: SparkSession) -> None:
    """Delete what :func:`materialize` and :func:`scratch_path` have made for
    this session, on whatever store the checkpoint folder is. Call it when no
    DataFrame read from there is needed any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
