"""Session settings for tests and local benchmarks.

On a cluster the caller brings the session; nothing in the library changes its
settings.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app_name: str = "corpusmill") -> SparkSession:
    """A local session with UTC time, adaptive execution and few shuffle partitions."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
