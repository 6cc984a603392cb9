"""The Spark session used by tests, bench and the oracle check."""

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidespan")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        # test data is tiny: keep its few rows spread over the cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # queries here have many small stages: keep their generated code between runs
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # do not record the Python call site of every expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
