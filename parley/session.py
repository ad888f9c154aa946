"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# UTC keeps timestamps comparable between engines. Adaptive execution splits skewed join
# partitions and coalesces small shuffle partitions, so partition counts need no hand tuning.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "parley", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``, which every executor must
    reach. Where that is unset, the path is below the warehouse folder, which they share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
