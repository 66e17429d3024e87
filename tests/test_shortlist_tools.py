from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitaelake.operators import shortlist as s
from vitaelake.plans import tools
from vitaelake.streaming.shortlist import read_shortlist, start_shortlist


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


ACTIONS = [
    ("a@x", "1", "HR", "Lead", "text", "first", at(1), 1),
    ("a@x", "1", "IT", "Lead", "", "second", at(2), 2),
    ("a@x", "1", "IT", "Clerk", "d", "other role", at(3), 3),
    ("b@x", "1", "IT", "Lead", None, "other recruiter", at(3), 4),
    ("b@x", "2", "IT", "Lead", "d1", "same time", at(4), 5),
    ("b@x", "2", "HR", "Lead", "d2", None, at(4), 6),
]


def actions(spark, rows=ACTIONS):
    return spark.createDataFrame(rows, s.ACTION_SCHEMA)


def table(df):
    return {tuple(r) for r in df.select(*s.SHORTLIST_COLUMNS).collect()}


EXPECTED = {
    ("a@x", "1", "Lead", "HR", None, "second", at(2)),
    ("a@x", "1", "Clerk", "IT", "d", "other role", at(3)),
    ("b@x", "1", "Lead", "IT", None, "other recruiter", at(3)),
    ("b@x", "2", "Lead", "IT", "d2", None, at(4)),
}


def test_upsert(spark):
    assert table(s.shortlist(actions(spark))) == EXPECTED
    shuffled = random.Random(4).sample(ACTIONS, len(ACTIONS))
    assert table(s.shortlist(actions(spark, shuffled))) == EXPECTED


def test_stream_equals_batch(spark, tmp_path):
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    # Two runs over a growing log, the late part holding the earliest action.
    for part in (ACTIONS[1:4], [ACTIONS[0], *ACTIONS[4:]]):
        actions(spark, part).coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(s.ACTION_SCHEMA).parquet(log)
        start_shortlist(stream, out, checkpoint).awaitTermination()
        batch = table(s.shortlist(spark.read.parquet(log)))
        assert table(read_shortlist(spark, out)) == batch
    assert batch == EXPECTED
    start_shortlist(stream, out, checkpoint).awaitTermination()
    assert table(read_shortlist(spark, out)) == EXPECTED


def test_backfill_and_actor(spark):
    old = actions(spark, [("a", "1", "HR", None, None, None, at(1), 1)])
    assert s.backfill_titles(old).first()["job_title"] == "HR"
    people = spark.createDataFrame(
        [("e", "u"), ("", "u"), (None, "u"), ("", ""), (None, None)], "e string, u string"
    )
    got = people.select(s.actor(F.col("e"), F.col("u"), "svc").alias("a")).collect()
    assert [r["a"] for r in got] == ["e", "u", "u", "svc", "svc"]


def test_rejects(spark):
    good = ("é" * 255, "r" * 50, "c" * 100, "t" * 255, None, None, at(1), 1)
    rows = [good]
    for i in range(4):
        rows.append((*good[:i], None, *good[i + 1 :]))
        rows.append((*good[:i], good[i] + "x", *good[i + 1 :]))
    rows.append((*good[:6], None, 1))
    df = actions(spark, rows)
    assert s.accepted(df).count() == 1
    assert s.shortlist(df).count() == 1
    assert sorted(r["reason"] for r in s.rejects(df).collect()) == sorted(
        [f"{c} is null" for c in ("recruiter_email", "resume_id", "category", "job_title")]
        + ["added_at is null", "recruiter_email is longer than 255"]
        + ["resume_id is longer than 50", "category is longer than 100"]
        + ["job_title is longer than 255"]
    )


def test_record_then_read(spark, tmp_path):
    log = str(tmp_path / "log")
    common = dict(resume_id="7", job_title="Lead", default_actor="svc")
    record = tools.shortlist_candidate
    record(spark, log, category="HR", note="n1", job_description="d", user="u", **common)
    record(spark, log, category="IT", note="n2", job_description="", user="u", **common)
    record(spark, log, category="IT", note="n3", job_description="", email="e@x", **common)
    rows = tools.get_shortlist(s.shortlist(spark.read.parquet(log))).collect()
    assert [(r["added_by"], r["category"], r["note"], r["job_description"]) for r in rows] == [
        ("e@x", "IT", "n3", None),
        ("u", "HR", "n2", None),
    ]
    assert rows[0].asDict().keys() == {
        "resume_id", "category", "job_title", "job_description", "note", "added_by", "added_at",
    }
    with pytest.raises(ValueError, match="longer than 50"):
        record(
            spark, log, category="HR", note="n", job_description="",
            **{**common, "resume_id": "r" * 51},
        )
    with pytest.raises(TypeError):
        record(spark, log, resume_id="7")


def test_get_shortlist_filters_and_limits(spark):
    folded = s.shortlist(actions(spark))
    newest = tools.get_shortlist(folded).collect()
    assert [r["added_at"] for r in newest] == [at(4), at(3), at(3), at(2)]
    assert tools.get_shortlist(folded, job_title="Clerk").count() == 1
    assert tools.get_shortlist(folded, job_title="lead").count() == 0
    assert tools.get_shortlist(folded, limit=0).count() == 1
    assert tools.get_shortlist(folded, limit=None).count() == 4


def test_search_resumes(spark):
    rows = [("HR", f"{i:03d}", 9, 1) for i in range(120)] + [("A-B", "x", 1, 1), ("A-B", "y", 0, 2)]
    top = spark.createDataFrame(
        rows, "category string, resume_id string, leadership_score int, rank int"
    ).repartition(4)
    ids = lambda **given: [r["resume_id"] for r in tools.search_resumes(top, **given).collect()]
    assert ids() == ["x", "y"] + [f"{i:03d}" for i in range(18)]
    assert ids(category=" a-b ") == ["x", "y"]
    assert ids(category="", limit=1) == ids(category=None, limit=0) == ["x"]
    assert len(ids(category="hr", limit=1000)) == 100
    assert len(ids(category="hr", limit=5)) == 5
    assert ids(category="nowhere") == []
    for bad in ("  ", "A1", "HR' OR 'a", "HR\n;"):
        with pytest.raises(ValueError):
            tools.search_resumes(top, category=bad)


def test_category_stats_columns(spark):
    stats = spark.createDataFrame(
        [("B", 1, 1.0, 0.5, 9.0), ("A", 1, 1.0, 0.5, 9.0), ("C", 1, 1.0, 0.7, 9.0)],
        "category string, resume_count bigint, avg_word_count double, "
        "avg_leadership_score double, avg_seniority_score double",
    )
    got = tools.get_category_stats(stats)
    assert got.columns == ["category", "resume_count", "avg_word_count", "avg_leadership_score"]
    assert [r["category"] for r in got.collect()] == ["C", "A", "B"]
