"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the engine relies on.  Everything else is left to the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gradeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GRADELOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.  Only a local session may go without and gets a fresh one."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    target = named or tempfile.mkdtemp(prefix="gradeloom-ckpt-")
    context.setCheckpointDir(target)
    return target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written copy.

    Reliable checkpoints survive lost executors, so iterative operators use these and nothing that
    lives only in executor storage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def put_down(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the checkpoint folder and go on from the written copy.

    For wide tables that many steps read in part: packed by columns, and a reader takes only those it names.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
