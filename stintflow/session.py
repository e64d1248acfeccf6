"""Session for local runs and tests, with the settings recommended for a cluster as well."""
from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a running session may still take.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lookups are broadcast only after their size was measured.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Events stay partitioned by game while they meet per-game tables on finer keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
SETTINGS = {
    **RUNTIME,
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Building a plan takes thousands of small calls; without call-site capture it is several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> None:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)


def local_session(name: str, cores: str = "8", partitions: int = 8, **settings: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
             "spark.sql.shuffle.partitions": str(partitions)}
    for key, value in {**SETTINGS, **local, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
