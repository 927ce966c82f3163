"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.operators.days import ORDER_DAY
from tradewinds.operators.frames import stack


def overwrite(df: DataFrame, path: str) -> None:
    """Create the table at `path` or replace all of it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Put the finished folder `written` in the place of `path`, on the same file system."""
    source, files = _folder(spark, written)
    folder, _ = _folder(spark, path)
    files.mkdirs(folder.getParent())
    files.delete(folder, True)
    if not files.rename(source, folder):
        raise OSError(f"cannot rename {written} to {path}")


def replace_table(df: DataFrame, table: str) -> None:
    """Create or replace a catalog table with the rows of `df`."""
    df.write.mode("overwrite").saveAsTable(table)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_days(df: DataFrame, path: str, day: str) -> None:
    """Replace only the days of `df` in a table partitioned by `day`, a file for each unless it is large."""
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; maps and structs stay nested."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def write_by_day(df: DataFrame, path: str, ts: str, day: str, cluster_by: list[str]) -> None:
    """Partition by the date of `ts` and sort each file by `cluster_by`.

    A filter on `day` then reads one folder, and one on a sort column skips row groups.
    Rows are gathered by day and rebalanced: adaptive execution joins small days and cuts a
    large one into tasks of the advised size, reading the source once.
    """
    (
        df.withColumn(day, F.to_date(ts))
        .hint("rebalance", day)
        .sortWithinPartitions(day, *cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(day)
        .parquet(path)
    )


def orders_partitioned(orders: DataFrame, path: str) -> DataFrame:
    """The copy of orders that is partitioned by purchase date."""
    cluster_by = ["customer_id", "order_status"]
    write_by_day(orders, path, "order_purchase_timestamp", ORDER_DAY, cluster_by)
    return orders.sparkSession.read.parquet(path)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values that partition a table, newest (largest) first, by one listing of its folder."""
    folder, files = _folder(spark, path)
    names = [p.getName() for p in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(folder))]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), reverse=True)


def read_newest(spark: SparkSession, path: str, column: str, n: int) -> DataFrame:
    """The rows of the newest `n` partitions; the other folders are not opened."""
    newest = partitions(spark, path, column)[:n]
    if not newest:
        return spark.read.parquet(path).limit(0)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in newest])


def partition_stats(spark: SparkSession, path: str, day: str, n: int | None = 10) -> DataFrame:
    """Rows and size of the latest `n` partitions; only these are opened."""
    per_file = (
        (spark.read.parquet(path) if n is None else read_newest(spark, path, day, n))
        .select(day, "_metadata.file_path", "_metadata.file_size")
        .groupBy(day, "file_path", "file_size")
        .agg(F.count("*").alias("n_rows"))
    )
    stats = (
        per_file.groupBy(F.col(day).alias("partition_id"))
        .agg(
            F.sum("n_rows").alias("total_rows"),
            (F.sum("file_size") / F.pow(F.lit(10.0), F.lit(9.0))).alias("size_gb"),
        )
        .orderBy(F.desc("partition_id"))
    )
    return stats if n is None else stats.limit(n)


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and gigabytes of Parquet tables (name -> path)."""
    return stack([
        spark.read.parquet(path)
        .select("_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path", "file_size")
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("n_rows"), (F.sum("file_size") / F.lit(1e9)).alias("size_gb"))
        .select(F.lit(name).alias("table_name"), "n_rows", "size_gb")
        for name, path in paths.items()
    ])
