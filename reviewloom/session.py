"""Session defaults. A cluster brings its own settings; these only fill gaps."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {"spark.sql.session.timeZone": "UTC"}


def get_session(app_name: str = "reviewloom", master: str | None = None, **conf) -> SparkSession:
    """Create or reuse a session; ``conf`` is set, defaults only where a new session lacks the key."""
    existed = SparkSession.getActiveSession() is not None
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not existed:
        given = spark.sparkContext.getConf()
        for key, value in DEFAULTS.items():
            if not given.contains(key):
                spark.conf.set(key, value)
    return spark
