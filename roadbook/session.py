"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # dates are derived from timestamps, so the zone has to be the same on every host
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def spark_session(app: str = "roadbook", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where it is unset, a machine-local folder serves a session that runs in one process. On a cluster
    every executor would write to its own disk, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="roadbook-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, visible to every executor."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
