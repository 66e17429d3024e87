"""Raw files of the landing folder and the Bronze rows made of them."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vitaelake.functions.extract import Extractor, extract_text
from vitaelake.functions.paths import category_of, resume_id_of
from vitaelake.sources import manifest

BINARY_FILE_SCHEMA = (
    "path string, modificationTime timestamp, length bigint, content binary"
)
#: Bytes of files that go to a Python worker at a time.
BATCH_BYTES = 64 * 1024 * 1024
#: Threads that move ingested files to the archive.
ARCHIVE_THREADS = 8
#: What opening a file counts for beside its bytes when files are dealt out to tasks.
#: Spark's 4 MB put 32 small files into a task, each of which writes a file to Bronze.
OPEN_COST_BYTES = 64 * 1024
BRONZE_COLUMNS = (
    "resume_id",
    "category",
    "raw_text",
    "file_path",
    "_ingested_at",
    "_source",
)


def file_session(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> SparkSession:
    """A session of the same application for frames whose rows are whole files.

    Tasks hand rows to Python in batches, by default of ten thousand rows. Here a batch
    ends after the file that reaches ``batch_bytes``, so a Python worker holds no more
    than that and one file. Spark lists a batch of files with a task per file, up to ten
    thousand; here with two per core. A task gets up to two thousand small files. Settings of the caller's session are taken over, and
    none of its own is touched, so other threads see no change.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    tasks = 2 * spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)
    session.conf.set("spark.sql.files.openCostInBytes", OPEN_COST_BYTES)
    session.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", ARCHIVE_THREADS)
    return session


def file_writer(
    folder: str, job: str, group: str, content: str, changed: float | None = None
) -> Callable[[Iterator[Row]], None]:
    """Writes each row's ``content`` and a line end as a text file of a local folder.

    A file lies in a sub-folder by ``group``. A task writes beside the folder, names its
    files by its number and the row's place, and moves them at its end, so a task that is
    run again replaces them.
    ``changed`` sets the files' time of change.
    """

    os.makedirs(folder, exist_ok=True)

    def write(rows: Iterator[Row]) -> None:
        task = TaskContext.get()
        draft = f"{folder}-drafts/{job}-{task.taskAttemptId()}"
        os.makedirs(draft)
        made: dict[str, list[str]] = {}
        for number, row in enumerate(rows):
            name = f"part-{task.partitionId():05d}-{number:08d}-{job}.txt"
            with open(f"{draft}/{name}", "wb") as file:
                file.write(row[content] + b"\n")
            if changed is not None:
                os.utime(f"{draft}/{name}", (changed, changed))
            made.setdefault(f"{folder}/{group}={row[group]}", []).append(name)
        for target, names in made.items():
            os.makedirs(target, exist_ok=True)
            for name in names:
                os.replace(f"{draft}/{name}", f"{target}/{name}")
        os.rmdir(draft)

    return write


def read_landing(
    spark: SparkSession, root: str, extension: str = "pdf", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """All files of the folder and its sub-folders, as path and bytes.

    The frame belongs to a session that bounds what a Python worker holds of it.
    """
    return (
        file_session(spark, batch_bytes).read.format("binaryFile")
        .option("pathGlobFilter", f"*.{extension}")
        .option("recursiveFileLookup", "true")
        .load(root)
    )


def stream_landing(
    spark: SparkSession,
    root: str,
    extension: str = "pdf",
    max_files_per_batch: int | None = None,
    max_file_age: str = "36500d",
    archive: str | None = None,
) -> DataFrame:
    """The same files as a stream, each of them once per checkpoint.

    Spark leaves out files that are older than the newest one seen by more than
    ``max_file_age``. By default no file is too old, so the stream's list of seen
    files grows with the folder. With ``archive``, a folder outside the landing one,
    files are moved there once their batch is done: the folder that is listed holds
    only what is new, whatever has passed through it. As with ``read_landing`` the
    session of the stream bounds what a Python worker holds.
    """
    reader = (
        file_session(spark).readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", f"*.{extension}")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", max_file_age)
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(root)


def moment(as_of: dt.datetime | str | None) -> Column:
    """The given time, or the time of the query if none is given."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def bronze_rows(
    texts: DataFrame,
    source: str,
    extension: str = "pdf",
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Bronze rows of a frame with ``path`` and ``raw_text``."""
    path = F.col("path")
    return texts.select(
        resume_id_of(path, extension).alias("resume_id"),
        category_of(path, extension).alias("category"),
        F.col("raw_text"),
        path.alias("file_path"),
        moment(as_of).alias("_ingested_at"),
        F.lit(source).alias("_source"),
    )


def bronze_from_files(
    files: DataFrame,
    extractor: Extractor,
    source: str,
    extension: str = "pdf",
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Bronze rows of a batch or streaming frame of binary files."""
    texts = files.select("path", extract_text(F.col("content"), extractor).alias("raw_text"))
    return bronze_rows(texts, source, extension, as_of)


def empty_files(spark: SparkSession, root: str, extension: str = "pdf") -> DataFrame:
    """Paths of files without a byte.

    Spark's file scan skips them, so they never reach Bronze by themselves.
    Only the driver's file listing sees them; the list holds paths alone.
    """
    found = manifest.lengths(spark, root, f".{extension}")
    paths = [(name,) for name, length in found if length == 0]
    return spark.createDataFrame(paths, "path string")
