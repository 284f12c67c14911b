"""A local Spark session for the checks, tests and benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(name: str, cpus: str = "8", memory: str = "8g") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix=f"{name}-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else str(os.cpu_count()))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
