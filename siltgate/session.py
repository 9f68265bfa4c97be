"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "siltgate", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE on. Shuffle width is left to AQE unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
