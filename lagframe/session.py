"""Session helpers: a tuned local session for tests/bench, and shared scratch paths.

Scratch output (landed files, appended tables, lineage cuts) always goes below the
folder the cluster names in ``spark.checkpoint.dir``; a private folder is set only
when the session has none (local tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lagframe") -> SparkSession:
    """Session for tests and the bench: AQE on, UTC, UI off, small shuffle fan-out."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LAGFRAME_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memoisation)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - e.g. a Connect session has no SparkContext
        return f"session-{id(spark)}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root. Only a local session without one gets a private
    folder, which goes when the process ends; on a cluster the folder must be named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect: the server owns checkpointing
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lagframe-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/lagframe/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint root and read back: computed once, and a lost
    executor costs a read of the table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
