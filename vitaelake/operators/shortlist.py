"""Shortlist kept as a log of actions and folded to its current state.

An action records a suggestion for a human to review; there is no operator
that approves or rejects anyone.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.config import SHORTLIST_KEY, SHORTLIST_WIDTHS
from vitaelake.sources import manifest
from vitaelake.sources.landing import moment
from vitaelake.sources.staging import estimated_bytes

ACTION_SCHEMA = (
    "recruiter_email string, resume_id string, category string, job_title string, "
    "job_description string, note string, added_at timestamp, seq bigint"
)
#: Compacted actions lie in a folder that a plain scan of the log leaves out.
_COMPACTED = "_compacted"
#: One task shuffles what makes a file, several times its bytes before compression.
COMPACTED_FILE_BYTES = 32 * 1024 * 1024
SHORTLIST_COLUMNS = (
    *SHORTLIST_KEY,
    "category",
    "job_description",
    "note",
    "added_at",
)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def actor(email: Column, user: Column, default: str) -> Column:
    """Who acted: the e-mail, else the user id, else the service's own name."""
    return F.coalesce(blank_to_null(email), blank_to_null(user), F.lit(default))


def backfill_titles(actions: DataFrame) -> DataFrame:
    """Give actions from before job titles existed their category as title."""
    return actions.withColumn("job_title", F.coalesce("job_title", "category"))


def _fold_columns() -> Sequence[Column]:
    when = F.struct("added_at", "seq")
    # A struct is never NULL, so a NULL of the newest action wins like a value.
    newest = F.struct(blank_to_null(F.col("job_description")).alias("job_description"), "note")
    return (
        F.min_by(F.struct("category"), when).alias("first"),
        F.max_by(newest, when).alias("last"),
        F.max("added_at").alias("added_at"),
        F.min(when).alias("first_at"),
        F.max(when).alias("last_at"),
    )


def fold_state(actions: DataFrame, key: Sequence[str] = SHORTLIST_KEY) -> DataFrame:
    """The fold with the order of the actions it rests on, which streams keep."""
    return accepted(actions).groupBy(*key).agg(*_fold_columns())


def shortlist(actions: DataFrame, key: Sequence[str] = SHORTLIST_KEY) -> DataFrame:
    """Current shortlist: one row per key.

    The category is that of the first action; description, note and time are
    those of the last. Actions that break a constraint are left out; ``rejects``
    lists them. ``seq`` orders actions of the same time. Aggregates
    before the shuffle, so a key with many actions is no hot spot.
    """
    return unpack(fold_state(actions, key), key)


def unpack(state: DataFrame, key: Sequence[str] = SHORTLIST_KEY) -> DataFrame:
    return state.select(
        *key, "first.category", "last.job_description", "last.note", "added_at"
    )


def _violations() -> Sequence[tuple[Column, str]]:
    required = (*SHORTLIST_WIDTHS, "added_at")
    missing = [(F.col(c).isNull(), f"{c} is null") for c in required]
    long = [
        (F.length(c) > width, f"{c} is longer than {width}")
        for c, width in SHORTLIST_WIDTHS.items()
    ]
    return [*missing, *long]


def _reason() -> Column:
    """First broken rule, NULL if the row is sound."""
    return reduce(
        lambda rest, rule: F.when(rule[0], F.lit(rule[1])).otherwise(rest),
        reversed(_violations()),
        F.lit(None).cast("string"),
    )


def rejects(actions: DataFrame) -> DataFrame:
    """Actions that break a constraint of the shortlist, with the reason."""
    return actions.withColumn("reason", _reason()).filter("reason IS NOT NULL")


def accepted(actions: DataFrame) -> DataFrame:
    """Actions that meet all constraints."""
    return actions.filter(_reason().isNull())


def record_action(
    spark: SparkSession,
    log_path: str,
    *,
    resume_id: str,
    category: str,
    note: str,
    job_title: str,
    job_description: str,
    default_actor: str,
    email: str | None = None,
    user: str | None = None,
    seq: int | None = None,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Append one suggestion to the log and return it.

    ``job_description`` may be ``""``, which is stored as NULL. The order of
    actions within one instant is ``seq``, by default the clock's nanoseconds.
    """
    import time

    given = spark.createDataFrame(
        [(email, user, resume_id, category, job_title, job_description, note)],
        "email string, user string, resume_id string, category string, "
        "job_title string, job_description string, note string",
    )
    row = given.select(
        actor(F.col("email"), F.col("user"), default_actor).alias("recruiter_email"),
        "resume_id",
        "category",
        "job_title",
        blank_to_null(F.col("job_description")).alias("job_description"),
        "note",
        moment(as_of or dt.datetime.now(dt.timezone.utc)).alias("added_at"),
        F.lit(time.time_ns() if seq is None else seq).cast("bigint").alias("seq"),
    )
    broken = rejects(row).select("reason").first()
    if broken:
        raise ValueError(broken["reason"])
    record_actions(row, log_path)
    return row


def record_actions(actions: DataFrame, log_path: str) -> None:
    """Append actions to the log as they are; safe beside other writers and a compaction."""
    actions.write.mode("append").parquet(log_path)


def _log_files(spark: SparkSession, log_path: str) -> tuple[list[str], list[str], dict]:
    """Loose files and compacted folders that make up the log, and its version."""
    loose = manifest.names(spark, log_path)  # before the version, which may replace some
    _, content = manifest.latest(spark, log_path)
    gone = {*content.get("replaced", []), *content.get("deleted", [])}
    return [name for name in loose if name not in gone], content.get("compacted", []), content


def _read_parts(
    spark: SparkSession, log_path: str, loose: Sequence[str], compacted: Sequence[str]
) -> DataFrame:
    paths = [f"{log_path}/{name}" for name in loose]
    paths += [f"{log_path}/{_COMPACTED}/{name}" for name in compacted]
    if not paths:
        return spark.createDataFrame([], ACTION_SCHEMA)
    return spark.read.schema(ACTION_SCHEMA).parquet(*paths)


def read_actions(spark: SparkSession, log_path: str) -> DataFrame:
    """All actions of the log, each once, whatever has been compacted of it."""
    loose, compacted, _ = _log_files(spark, log_path)
    return _read_parts(spark, log_path, loose, compacted)


def compact_actions(spark: SparkSession, log_path: str) -> int:
    """Swap the many small files of the log for few; the number of files replaced.

    The new version names both the compacted folder and the files it replaces, so no
    reader counts an action twice or misses one. Files appended meanwhile are in no
    version and stay. Replaced files are deleted by the next compaction: readers that
    started before this one find them until then. Of two compactions at once the
    second leaves the log as the first has made it.
    """
    loose, compacted, content = _log_files(spark, log_path)
    if not loose:
        return 0
    number, _ = manifest.latest(spark, log_path)
    name = uuid.uuid4().hex
    rows = _read_parts(spark, log_path, loose, compacted)
    files = max(1, math.ceil(estimated_bytes(rows) / COMPACTED_FILE_BYTES))
    rows.repartition(files).write.parquet(f"{log_path}/{_COMPACTED}/{name}")
    new = {"compacted": [name], "replaced": loose, "deleted": content.get("replaced", [])}
    try:
        manifest.publish(spark, log_path, number + 1, {**new, "former": compacted})
    except manifest.VersionTaken:
        manifest.delete(spark, f"{log_path}/{_COMPACTED}/{name}")
        return 0
    for old in content.get("replaced", []):
        manifest.delete(spark, f"{log_path}/{old}")
    for old in content.get("former", []):
        manifest.delete(spark, f"{log_path}/{_COMPACTED}/{old}")
    return len(loose)
