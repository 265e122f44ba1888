"""Session helper: settings that hold at any size are left to the cluster."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "lodestone", cpus: int | None = None, **conf: str) -> SparkSession:
    """A session; local[cpus] only where no master is set from outside."""
    b = SparkSession.builder.appName(app)
    if cpus:
        b = b.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(cpus))
        b = b.config("spark.driver.memory", os.environ.get("LODESTONE_DRIVER_MEMORY", "8g"))
    b = (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
