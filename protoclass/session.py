"""Session helpers: the shared checkpoint folder, scratch paths, local sessions.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
the library only falls back to a temporary folder of its own when that
setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of this session, or None if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A session on this machine alone
    (as in tests) may name none and gets a temporary one; on a cluster that
    would be another folder on every machine, so there it is an error."""
    current = checkpoint_dir(spark)
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    local = tempfile.mkdtemp(prefix="protoclass-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Keep an intermediate result that several later stages read.

    ``persist``: memory and disk; a lost executor's blocks are recomputed
    from lineage. ``checkpoint``: written to the shared checkpoint folder,
    which also cuts the lineage. ``none``: leave it to recomputation.
    """
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "none":
        return df
    raise ValueError(f"unknown materialisation {how!r}")


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "protoclass", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests, the benchmark and the smoke entry point."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
