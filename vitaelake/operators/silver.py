"""Bronze to Silver: readable, deduplicated and scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.config import LEADERSHIP, SENIORITY, Lexicon
from vitaelake.functions.text import (
    has_email,
    has_phone,
    lexicon_score,
    word_count,
)
from vitaelake.operators.dedupe import dedupe
from vitaelake.operators.quarantine import normalized, readable

KEYS = ("resume_id",)
ORDER = ("_ingested_at", "file_path")


def enrich(
    clean: DataFrame,
    leadership: Lexicon = LEADERSHIP,
    seniority: Lexicon = SENIORITY,
) -> DataFrame:
    """The nine Silver columns of rows that have ``clean_text``."""
    text = F.col("clean_text")
    return clean.select(
        "resume_id",
        "category",
        "clean_text",
        word_count(text).alias("word_count"),
        lexicon_score(text, leadership).alias("leadership_score"),
        lexicon_score(text, seniority).alias("seniority_score"),
        has_email(text).alias("has_email"),
        has_phone(text).alias("has_phone"),
    ).withColumn("contact_complete", F.col("has_email") & F.col("has_phone"))


def silver(
    bronze: DataFrame,
    leadership: Lexicon = LEADERSHIP,
    seniority: Lexicon = SENIORITY,
    min_words: int = 1,
    triaged: DataFrame | None = None,
) -> DataFrame:
    """Silver rows of Bronze.

    Unreadable rows leave before the dedupe, so a blank copy of a résumé never
    displaces a readable one. ``triaged`` is the staged output of ``triage``.
    """
    probe = None if triaged is None else triaged.filter("NOT is_unreadable")
    rows = dedupe(readable(bronze, min_words), KEYS, ORDER, probe)
    return enrich(normalized(rows), leadership, seniority)
