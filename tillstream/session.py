"""Session helpers. On a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "tillstream", cpus: str | int = "*", shuffle_partitions: int = 8,
                  memory: str | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # recording the Python call site of every column expression costs more than planning the query
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
