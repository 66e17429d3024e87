"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage, survives the loss of executors, gives an exact
size to decide a broadcast on, and lets two consumers share one computation.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 16 * 1024 * 1024
BROADCAST_MAX_ROWS = 1_000_000
SPREAD_TASKS = 64
SPREAD_BYTES_PER_TASK = 64 * 1024 * 1024

_local_dirs: dict[str, str] = {}
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="vitaelake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to a fresh folder of the shared directory, read them back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(
    spark: SparkSession, frames: Iterable[DataFrame], schema: str, name: str
) -> DataFrame:
    """The rows of all frames as one staged table, each written before the next is made.

    The plan of the result is one scan, however many frames there were.
    """
    path = f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    written = 0
    for frame in frames:
        frame.write.parquet(f"{path}/part-{written:08d}")
        written += 1
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also of a failed block, what this block has staged.

    Frames built on these tables are of no use afterwards; tables staged outside
    the block, or in another thread, stay.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        jvm, configuration = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(configuration).delete(folder, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a file scan it is the size of the files."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(staged: DataFrame, rows: int | None = None) -> bool:
    """Whether a staged table, or a part of it, may go to every executor.

    ``rows`` saves the count where the caller knows it.
    """
    if estimated_bytes(staged) > BROADCAST_MAX_BYTES:
        return False
    return (staged.count() if rows is None else rows) <= BROADCAST_MAX_ROWS


def sized(staged: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a staged table for broadcast if it fits.

    If it does not, the join shuffles and adaptive execution splits hot keys.
    """
    return F.broadcast(staged) if fits_broadcast(staged, rows) else staged


def by_hash(staged: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark the smaller side of a join: for broadcast if it fits, else for a hash table.

    Then the other side, many narrow rows or few wide ones, is shuffled but not sorted.
    """
    return F.broadcast(staged) if fits_broadcast(staged, rows) else staged.hint("shuffle_hash")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of an input that has too few file splits.

    A file is split by row group, so a small table in one file would be scored
    by one task. Inputs above a few gigabytes have splits enough and are not
    shuffled.
    """
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_TASKS)
    if estimated_bytes(df) >= tasks * SPREAD_BYTES_PER_TASK:
        return df
    return df.repartition(tasks, key)
