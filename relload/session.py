"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library code never builds its own session; it takes the caller's.  Scratch data
(rendered dumps, checkpoints, written intermediate tables) lives under the folder
the cluster names in ``spark.checkpoint.dir``.  Only when that is unset (local
tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "relload") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RELLOAD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` when the cluster sets it.

    When it is unset (local runs), a fresh folder under the system temp dir is
    created once and registered as the checkpoint dir so ``checkpoint()`` works.
    """
    root = None
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            try:
                root = sc.getCheckpointDir()
            except Exception:  # pragma: no cover
                root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else ""
        if not master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="relload-scratch-")
        if sc is not None:
            sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared scratch folder."""
    return f"{scratch_root(spark)}/relload/{name}-{uuid.uuid4().hex[:12]}"
