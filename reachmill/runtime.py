"""Session settings and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the plans in this package count on. Every entry is a runtime SQL setting,
# so `tune` can apply it to a session that somebody else has started.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # join by hashing instead of sorting where every measured partition of the
    # smaller side is below this size; it is that of compressed shuffle data, and a hash
    # table several times larger has to fit into a task's memory
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's temporary folder: on a
    cluster the other executors would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="reachmill-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
