"""Session settings the mart relies on. Callers with their own session need none of this."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with Arrow transfer, ANSI casts and adaptive execution on.

    Shuffle partition counts and memory belong to the cluster and are left alone
    unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Join by hash, without sorting the order lines, where a dimension's partitions are small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
