"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "cohortrail", master: str | None = None, **conf) -> SparkSession:
    """Build (or get) a session. Partition counts and memory belong to the cluster: pass them in `conf`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    On a cluster the setting must be there. Only a local master, as in tests, gets a folder made for it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="cohortrail-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path
