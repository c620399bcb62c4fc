"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "bitexture", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` entries win over the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the cluster's shared folder (``spark.checkpoint.dir``).

    A machine-local folder is used only in local mode, where driver and executors share one machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="bitexture-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
