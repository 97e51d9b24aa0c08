"""Session settings that suit these operators."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str = "sparkmine", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitted configuration is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
