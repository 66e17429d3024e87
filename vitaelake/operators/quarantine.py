"""Split of Bronze into readable rows and quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.config import QUARANTINE_REASON
from vitaelake.functions.text import clean_text, is_unreadable
from vitaelake.sources.landing import moment


def triage(bronze: DataFrame, min_words: int = 1) -> DataFrame:
    """Bronze without the text, but with the verdict on it.

    Quarantine, key dedupe and the counts per layer need no more than this, so
    staging it once spares them the text.
    """
    return bronze.select(
        "resume_id",
        "category",
        "file_path",
        "_ingested_at",
        is_unreadable(F.col("raw_text"), min_words).alias("is_unreadable"),
    )


def quarantine(
    triaged: DataFrame, as_of: dt.datetime | str | None = None
) -> DataFrame:
    """Rows without usable text, kept with the reason."""
    return triaged.filter("is_unreadable").select(
        "resume_id",
        "category",
        "file_path",
        "_ingested_at",
        F.lit(QUARANTINE_REASON).alias("reason"),
        moment(as_of).alias("_quarantined_at"),
    )


def readable(bronze: DataFrame, min_words: int = 1) -> DataFrame:
    """Bronze rows with usable text."""
    return bronze.filter(~is_unreadable(F.col("raw_text"), min_words))


def normalized(bronze: DataFrame) -> DataFrame:
    """Bronze rows with ``clean_text`` beside the raw text."""
    return bronze.withColumn("clean_text", clean_text(F.col("raw_text")))
