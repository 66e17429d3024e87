"""Readers of the Gold tables, and the five tools.

A stored table has no order, so order is made where a table is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.config import (
    CATEGORY_PATTERN,
    MATCH_LIMIT_DEFAULT,
    SEARCH_LIMIT_DEFAULT,
    SEARCH_LIMIT_MAX,
    SHORTLIST_LIMIT_DEFAULT,
)
from vitaelake.operators.gold import bucket_order
from vitaelake.operators.match import TermStatistics, clamp, match_text
from vitaelake.operators.shortlist import record_action
from vitaelake.operators.text_index import TextIndex, match_index

shortlist_candidate = record_action


def highest_first(table: DataFrame, metric: str) -> DataFrame:
    """A table of categories by falling metric, the order it is read in."""
    return table.orderBy(F.desc(metric), "category")


def by_length(table: DataFrame) -> DataFrame:
    """The terciles of each category from short to long."""
    return table.orderBy("category", bucket_order(F.col("length_bucket")))


def get_category_stats(stats: DataFrame) -> DataFrame:
    """Statistics per category, most leadership first."""
    columns = ("category", "resume_count", "avg_word_count", "avg_leadership_score")
    return highest_first(stats.select(*columns), "avg_leadership_score")


def valid_category(category: str | None) -> str | None:
    """Category in stored form; None for no filter, an error for a bad one."""
    if not category:
        return None
    wanted = category.strip().upper()
    if not re.fullmatch(CATEGORY_PATTERN, wanted):
        raise ValueError(f"invalid category: {wanted!r}")
    return wanted


def search_resumes(
    top_candidates: DataFrame,
    category: str | None = None,
    limit: int = SEARCH_LIMIT_DEFAULT,
) -> DataFrame:
    """Top candidates in the order of category and rank."""
    wanted = valid_category(category)
    rows = top_candidates.select("category", "resume_id", "leadership_score", "rank")
    if wanted is not None:
        rows = rows.filter(F.col("category") == wanted)
    return rows.orderBy("category", "rank", "resume_id").limit(
        clamp(limit, SEARCH_LIMIT_MAX)
    )


_SEARCH_SQL = """
SELECT category, resume_id, leadership_score, rank FROM IDENTIFIER(:source)
WHERE :category IS NULL OR category = :category
ORDER BY category, rank, resume_id LIMIT :most
"""


def search_table(
    spark: SparkSession, source: str, category: str | None = None, limit: int = SEARCH_LIMIT_DEFAULT
) -> DataFrame:
    """``search_resumes`` as SQL over a catalog table.

    All that a caller gives is bound as an argument and never becomes part of the
    statement, so a category may hold any character and is compared as it is.
    """
    arguments = {"source": source, "category": category, "most": clamp(limit, SEARCH_LIMIT_MAX)}
    return spark.sql(_SEARCH_SQL, args=arguments)


def find_indexed_resumes(
    index: TextIndex, silver: DataFrame, job_description: str, limit: int = MATCH_LIMIT_DEFAULT
) -> DataFrame:
    """The answer of ``find_matching_resumes`` by a stored index."""
    docs = silver.select("resume_id", "category", "clean_text")
    return match_index(index, docs, job_description, limit)


def find_matching_resumes(
    silver: DataFrame,
    job_description: str,
    limit: int = MATCH_LIMIT_DEFAULT,
    statistics: TermStatistics | None = None,
) -> DataFrame:
    """Résumés whose text is closest to the description, closest first."""
    docs = silver.select("resume_id", "category", "clean_text")
    return match_text(docs, job_description, limit, statistics)


def get_shortlist(
    shortlist: DataFrame,
    limit: int | None = SHORTLIST_LIMIT_DEFAULT,
    job_title: str | None = None,
) -> DataFrame:
    """Shortlist, newest first; with limit None all of it, as a dashboard reads it."""
    rows = shortlist
    if job_title is not None:
        rows = rows.filter(F.col("job_title") == job_title)
    rows = rows.select(
        "resume_id",
        "category",
        "job_title",
        "job_description",
        "note",
        F.col("recruiter_email").alias("added_by"),
        "added_at",
    ).orderBy(F.desc("added_at"), "added_by", "resume_id", "job_title")
    return rows if limit is None else rows.limit(max(1, int(limit)))
