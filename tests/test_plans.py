"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vitaelake.operators import gold, match, shortlist
from vitaelake.operators.dedupe import dedupe
from vitaelake.plans import queries as q

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pairs_of_whole_tables(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scans_read_only_what_is_used(spark):
    counts = plan_of(q.QUERIES["bronze_category_counts"](spark, SF_DIR))
    assert "text" not in counts.split("ReadSchema")[1]
    quality = plan_of(gold.contact_quality(q._silver(spark, SF_DIR)))
    assert "regexp_extract_all" not in quality
    stats = plan_of(gold.category_stats(q._silver(spark, SF_DIR)))
    assert "@" not in stats and "n_chars" not in stats


def test_groups_are_counted_before_they_are_shuffled(spark):
    folded = plan_of(shortlist.shortlist(q._actions(q._table(spark, SF_DIR, "events"))))
    assert folded.count("Exchange") == 1 and "partial_max_by" in folded


def test_ranking_and_dedupe_do_not_shuffle_the_rows(spark):
    top = plan_of(gold.top_candidates(q._silver_numbers(spark, SF_DIR)))
    assert "BroadcastHashJoin" in top and "hashpartitioning" not in top
    docs = q._table(spark, SF_DIR, "documents").withColumn("half", F.floor(F.col("doc_id") / 2))
    few = docs.withColumn("key", F.when(F.col("doc_id") < 20, F.col("half")).otherwise(F.col("doc_id") + 100))
    kept = plan_of(dedupe(few, ["key"], ["doc_id"]))
    assert "BroadcastHashJoin" in kept and "hashpartitioning" not in kept


def test_dedupe_scans_once_where_most_keys_repeat(spark):
    talks = q._table(spark, SF_DIR, "conversations")
    kept = dedupe(talks, ["conv_id"], ["turn"])
    plan = plan_of(kept)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    # Of each key a task hands on its first row only.
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]
    assert kept.count() == talks.select("conv_id").distinct().count()


def test_the_snippet_filter_lies_below_the_cleaning(spark):
    plan = plan_of(match.match_text(q._texts(spark, SF_DIR), q.QUERY_TEXT, 10))
    assert plan.index("regexp_replace") < plan.index(" IN (")
    plan = plan_of(q.QUERIES["tool_match_text"](spark, SF_DIR))
    assert " IN (" in plan
    assert plan.index("regexp_replace") < plan.index(" IN (")
