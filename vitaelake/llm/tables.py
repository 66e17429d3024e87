"""What the queries of this subpackage share: the driver's tables, and the split by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds
