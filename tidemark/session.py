"""Session settings the jobs rely on, and where they may put scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the two runtime options that results depend on and return the session.

    Event times are UTC throughout, so hours, days and time text must be taken in
    UTC. A JSON object that repeats a key keeps the last value instead of being
    rejected as malformed.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under the folder the cluster names in `spark.checkpoint.dir`. Only a
    local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
