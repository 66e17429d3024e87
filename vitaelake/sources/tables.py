"""Layer databases and full-recompute table writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vitaelake.sources import manifest

LAYERS = ("bronze", "silver", "gold")
#: Versions of a table that stay: the current one, and one for readers that began before.
KEEP_VERSIONS = 2


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    """Create the three databases where they are missing."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")


def bind_table(spark: SparkSession, name: str, path: str) -> None:
    """Point a catalog table at a folder of Parquet files.

    A table that is there keeps its entry, of which only the location changes, so no
    reader ever misses it. Only where the columns have changed is the entry made anew.
    """
    if spark.catalog.tableExists(name):
        columns = [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]
        if columns == spark.read.parquet(path).dtypes:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")


def replace_table(
    df: DataFrame, root: str, name: str, prefix: str = "", keep: int = KEEP_VERSIONS
) -> DataFrame:
    """Recompute ``layer.table`` and return it as read back.

    Every write takes a new folder and the catalog entry moves to it at the
    end, so a failed run leaves the last table as it was and no plan ever
    overwrites what it reads. Of the folders written before, ``keep`` - 1 stay for
    readers that have planned their scan; older ones are deleted.
    """
    spark = df.sparkSession
    layer, table = name.split(".")
    folder = f"{root.rstrip('/')}/{layer}/{table}"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    bind_table(spark, f"`{prefix}{layer}`.`{table}`", path)
    for old in manifest.newest_first(spark, folder)[max(keep, 1) :]:
        manifest.delete(spark, f"{folder}/{old}")
    return spark.read.schema(df.schema).parquet(path)
