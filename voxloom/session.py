"""SparkSession factory used by tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[8]", app: str = "voxloom", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session in UTC with adaptive execution; a cluster brings its own session."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
