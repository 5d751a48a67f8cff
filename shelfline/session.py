"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_local_root: dict[str, str] = {}


def build_session(app: str = "shelfline", cores: int | None = None, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the one submitted."""
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "16g")
            .config("spark.ui.enabled", "false")
            .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfline-"))
        )
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path below the folder every executor sees.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a session
    without the setting (a local test) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _local_root:
            # local-cluster has executors of its own, like any cluster.
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            _local_root[app] = tempfile.mkdtemp(prefix="shelfline-")
        root = _local_root[app]
    return os.path.join(root, *parts) if "://" not in root else "/".join([root.rstrip("/"), *parts])
