"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "tablelift", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own.

    Sizes follow the machine here.  On a cluster leave
    ``spark.sql.shuffle.partitions`` high (AQE merges small partitions) and let
    ``spark.checkpoint.dir`` name a folder every executor can reach.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", "8g")
    builder = builder.config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
