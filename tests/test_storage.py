"""Log compaction, shortlist snapshots, table replacement, vector refresh, bound SQL."""

from __future__ import annotations

import threading
import uuid

import pytest
from pyspark.sql import functions as F
from test_shortlist_tools import actions

from vitaelake.operators import match, vectors
from vitaelake.operators import shortlist as s
from vitaelake.plans import queries as q
from vitaelake.plans import tools
from vitaelake.sources import manifest
from vitaelake.sources.tables import create_layers, replace_table
from vitaelake.streaming.shortlist import compact_shortlist, read_shortlist, start_shortlist

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_compaction_keeps_every_action_once(spark, tmp_path):
    log = str(tmp_path / "log")
    every = actions(spark)
    assert s.read_actions(spark, log).count() == 0 and s.compact_actions(spark, log) == 0
    for seq in range(3):
        s.record_actions(every, log)
    before = s.read_actions(spark, log)
    expected = rows_of(before)
    n_files = s.compact_actions(spark, log)
    assert n_files == len([p for p in (tmp_path / "log").glob("*.parquet")])  # deleted by the next one
    assert rows_of(s.read_actions(spark, log)) == expected == rows_of(before)
    s.record_actions(every, log)
    expected = sorted(expected + rows_of(every), key=repr)
    assert rows_of(s.read_actions(spark, log)) == expected
    assert s.compact_actions(spark, log) >= 1
    assert rows_of(s.read_actions(spark, log)) == expected
    # The first compaction's files are gone, those of the second still lie there.
    assert len(list((tmp_path / "log").glob("*.parquet"))) < n_files + 9
    assert s.compact_actions(spark, log) == 0
    folded = rows_of(s.shortlist(s.read_actions(spark, log)))
    assert folded == rows_of(s.shortlist(every))


def test_a_second_compaction_at_once_changes_nothing(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    s.record_actions(actions(spark), log)
    expected = rows_of(s.read_actions(spark, log))
    publish = manifest.publish

    def late(spark, root, number, content):
        monkeypatch.setattr(manifest, "publish", publish)
        s.compact_actions(spark, log)  # the other one is first
        return publish(spark, root, number, content)

    monkeypatch.setattr(manifest, "publish", late)
    assert s.compact_actions(spark, log) == 0
    assert rows_of(s.read_actions(spark, log)) == expected
    assert len(list((tmp_path / "log" / "_compacted").iterdir())) == 1


def test_snapshots_bound_what_readers_scan(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "log"))
    every = actions(spark)
    stream = lambda: spark.readStream.schema(every.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for seq in range(7):
        every.filter(F.col("seq") % 7 == seq).coalesce(1).write.mode("append").parquet(source)
        start_shortlist(stream(), out, checkpoint, compact_every=3).awaitTermination()
    expected = rows_of(s.shortlist(every))
    assert rows_of(read_shortlist(spark, out)) == expected
    version, content = manifest.latest(spark, out)
    snapshot = content["snapshot"]
    names = manifest.names(spark, out)
    assert f"snapshot={snapshot}" in names and "batch_id=0" not in names
    read = {f.split("/")[-2] for f in read_shortlist(spark, out).inputFiles()}
    batches = [int(n[9:]) for n in read if n.startswith("batch_id=")]
    assert all(n > snapshot for n in batches) and len(batches) < 3
    plan = read_shortlist(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") <= 1
    # Again, as after a failure: nothing changes.
    compact_shortlist(spark, out, snapshot)
    assert manifest.latest(spark, out)[0] == version
    assert rows_of(read_shortlist(spark, out)) == expected


def test_no_batch_no_shortlist(spark, tmp_path):
    with pytest.raises(ValueError):
        read_shortlist(spark, str(tmp_path / "none"))


def test_a_reader_never_misses_a_table_that_is_replaced(spark, tmp_path):
    prefix = f"r{uuid.uuid4().hex[:8]}_"
    create_layers(spark, prefix)
    root, name = str(tmp_path / "lake"), "gold.numbers"
    replace_table(spark.range(1).withColumn("version", F.lit(0)), root, name, prefix)
    stop, failures, seen = threading.Event(), [], set()

    def read():
        while not stop.is_set():
            try:
                seen.update(r["version"] for r in spark.table(f"{prefix}gold.numbers").collect())
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for version in range(1, 6):
            rows = spark.range(1).withColumn("version", F.lit(version))
            got = replace_table(rows, root, name, prefix, keep=3)
            assert got.first()["version"] == version
            assert spark.table(f"{prefix}gold.numbers").first()["version"] == version
    finally:
        stop.set()
        reader.join()
    assert not failures and seen <= set(range(6))
    assert len(list((tmp_path / "lake" / "gold" / "numbers").iterdir())) == 3
    other = spark.range(2).withColumn("name", F.lit("x"))
    replace_table(other, root, name, prefix, keep=1)
    assert spark.table(f"{prefix}gold.numbers").columns == ["id", "name"]
    assert len(list((tmp_path / "lake" / "gold" / "numbers").iterdir())) == 1


def test_bound_arguments_are_data(spark, tmp_path):
    prefix = f"b{uuid.uuid4().hex[:8]}_"
    create_layers(spark, prefix)
    rows = [("HR", "1", 5, 1), ("HR", "2", 4, 2), ("it's", "3", 1, 1), ("x' OR '1' = '1", "4", 1, 1)]
    top = spark.createDataFrame(rows, "category string, resume_id string, leadership_score int, rank int")
    replace_table(top, str(tmp_path), "gold.top", prefix)
    table = f"{prefix}gold.top"
    ids = lambda *given: [r["resume_id"] for r in tools.search_table(spark, table, *given).collect()]
    assert ids("HR") == ["1", "2"] and ids("HR", 1) == ["1"]
    assert ids("it's") == ["3"] and ids("x' OR '1' = '1") == ["4"]
    assert ids("y' OR '1' = '1") == [] and ids("\\' --") == []
    assert sorted(ids()) == ["1", "2", "3", "4"]


def test_first_load_of_vectors_shuffles_no_text(spark):
    docs = spark.createDataFrame([(str(i), f"text {i}") for i in range(50)], "resume_id string, clean_text string")
    none = spark.createDataFrame([], "resume_id string, text_hash long, embedding array<float>")
    first = match.refresh_vectors_by(docs, none, q.hashed_embedding)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert first.count() == 50
    stored = spark.createDataFrame(first.collect(), first.schema)
    for share in (2, 10):  # more texts due than not, and fewer
        text = F.when(F.col("resume_id") % share != 1, F.upper("clean_text")).otherwise(F.col("clean_text"))
        if share == 10:
            text = F.when(F.col("resume_id") % share == 1, F.upper("clean_text")).otherwise(F.col("clean_text"))
        now = docs.withColumn("clean_text", text).filter("resume_id <> '9'")
        again = match.refresh_vectors_by(now, stored, q.hashed_embedding)
        expected = match.refresh_vectors_by(now, none, q.hashed_embedding)
        assert rows_of(again) == rows_of(expected)


def test_a_plan_as_large_for_many_blocks_as_for_one(spark):
    embeddings = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    plans = []
    for block in (500, 50):
        found = vectors.match_vectors(embeddings, embeddings, 3, True, block=block)
        plans.append(found._jdf.queryExecution().executedPlan().toString().count("\n"))
        assert found.count() == 3 * embeddings.count()
    assert plans[0] == plans[1]


def test_hash_index_finds_all_with_all_cells(spark, tmp_path):
    embeddings = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    odd = spark.createDataFrame([(9001, None, 0)], embeddings.schema)
    every = embeddings.unionByName(odd)
    queries = embeddings.filter("vec_id % 10 = 0")
    index = vectors.build_hash_index(every, str(tmp_path / "index"), 64, bits=5)
    exact = rows_of(vectors.match_vectors(every, queries, 10, True))
    assert rows_of(vectors.match_vectors_approx(index, queries, 10, True, probes=32)) == exact
    near = vectors.match_vectors_approx(index, queries, 10, True, probes=20, with_pairs=True)
    pairs = near.select("query_id", "pairs").distinct()
    assert pairs.count() == queries.count()
    total = pairs.agg(F.sum("pairs")).first()[0]
    assert total == vectors.pairs_examined(index, queries, probes=20)
    assert total < embeddings.count() * queries.count()
    # A vector's cell does not depend on the others.
    some = vectors.build_hash_index(every.filter("vec_id < 50"), str(tmp_path / "some"), 64, bits=5)
    own = dict(map(tuple, index.rows.select("vec_id", "cell").collect()))
    assert all(own[r["vec_id"]] == r["cell"] for r in some.rows.collect())


def test_recall_is_reported(spark):
    for row in q.QUERIES["match_vectors_recall"](spark, SF_DIR).collect():
        assert row["pairs"] < row["vectors"]
    total = q.QUERIES["match_vectors_recall"](spark, SF_DIR).agg(F.avg("found")).first()[0]
    assert total >= 9
