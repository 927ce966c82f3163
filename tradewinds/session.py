"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results or for plans that hold at scale; every one of them
# can be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of the smaller side of a join is at most this large, it is hashed and neither side sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Parquet files are several times smaller than their rows in memory; without this a
    # side could be broadcast that is far larger than the threshold.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # State of open windows goes to disk instead of filling the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tradewinds", master: str | None = None, **conf) -> SparkSession:
    """Create a session; `conf` keys use `__` for dots (spark__ui__enabled)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
