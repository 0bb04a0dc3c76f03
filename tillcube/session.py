"""Session settings used by the bench and the tests.

Every job also runs on a session made elsewhere: nothing below is needed for right results.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Largest dimension that a join may broadcast. Spark compares it with the size of the written table.
DIMENSION_LIMIT = "64m"


def build_session(
    app_name: str = "tillcube",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with adaptive execution and a fixed time zone.

    On a cluster leave ``master`` unset and pass sizes (shuffle partitions, broadcast threshold,
    ``spark.checkpoint.dir``) through ``settings`` or spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        # Sums that do not fit their type raise an error.
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", DIMENSION_LIMIT)
    )
    if master:
        builder = builder.master(master)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
