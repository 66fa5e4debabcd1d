"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Valid for any cluster size: AQE sizes partitions, splits skewed ones and turns a join into a
# broadcast only after measuring the side.  The one broadcast that the library hints has a row per sort range.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Tables in the checkpoint folder go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the Python call site of every column costs more than building most plans here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(name: str, cpus: int = 8, memory: str = "16g") -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
