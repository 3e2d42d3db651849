"""Parquet table loading and view registration (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str,
                   names: list[str] | None = None) -> list[str]:
    """Register parquet tables as temp views so ``spark.sql`` can query them."""
    names = names or DRIVER_TABLES
    for n in names:
        load_table(spark, sf_dir, n).createOrReplaceTempView(n)
    return names


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Warehouse table over JDBC, read in parallel ranges of a numeric key."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", num_partitions or 64))
    return r.load()


def sql_query(spark: SparkSession, query: str) -> DataFrame:
    """Text SQL over registered views (the warehouse query path)."""
    return spark.sql(query)
