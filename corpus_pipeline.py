"""Documents to training shards: quality, near duplicates, benchmarks, mix, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; between
stages the rows are a table of the shared folder.

Odd rows: a NULL text is an empty one, which the quality rules reject; an empty table
passes through all stages; columns besides those of documents, whatever their names,
are carried along up to the last stage, which returns its own columns only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.llm import decontamination, mixing, near_dedup, quality_rules, sharding
from vitaelake.llm.tables import table
from vitaelake.sources.staging import sized, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: More of a document than this in benchmark passages, and all of it goes.
MAX_COVERAGE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    whole = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")
    # Written before the filter: pushed into the rules it would compute them many times over.
    judged = stage(quality_rules.judge(whole, trusted).select("__row", "kept"), "judged")
    return judged.filter("kept").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates, and equal rows once.

    Rows of one id with different content all stay, since none of them is a copy of
    the others by its id alone. Rows without an id are in no group and stay.
    """
    found = stage(near_dedup.near_duplicates(docs).select("doc_id", "kept"), "near-duplicates")
    dropped = sized(stage(found.filter("NOT kept").select("doc_id").distinct(), "dropped"))
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    ids = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    repeated = sized(stage(ids.select("doc_id"), "repeated"))
    single = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    several = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return single.union(several.distinct())


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out, and drop documents that are mostly such."""
    before = docs.withColumn("__before", F.length("text"))
    clean = decontamination.remove(
        before, table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE
    )
    cut = F.length("text") != F.col("__before")
    n_chars = F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources come near their target words."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
