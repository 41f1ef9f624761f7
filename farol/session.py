"""Session helpers: a tuned builder and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "farol", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution; extra settings override the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local run without that setting gets a folder of its own; a cluster
    without it is refused, because a machine-local path would lose data with
    the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(app: str) -> str:
    return tempfile.mkdtemp(prefix="farol-")


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for one staged table of this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/farol/{app}/{name}-{uuid.uuid4().hex[:12]}"
