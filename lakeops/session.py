"""Session construction and shared storage locations.

Every job that materialises data (tables, streaming checkpoints, lineage
cuts) writes below the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "lakeops", extra: dict | None = None) -> SparkSession:
    """Session with the settings this library assumes.

    AQE re-plans joins and coalesces partitions at run time and splits
    skewed join partitions; the UI stays off (no server is started).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # target shuffle partition size; AQE coalesces small partitions to it
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LAKEOPS_DRIVER_MEMORY", "16g"),
        "spark.sql.streaming.schemaInference": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the running context or from ``spark.checkpoint.dir``; if both are
    unset, a local master gets a private folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lakeops-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for one job run."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/lakeops/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` written below the shared checkpoint root and read back: cuts lineage,
    survives lost executors, and the planner knows the table's size."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)
