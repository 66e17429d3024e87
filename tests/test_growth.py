"""Work and memory of a task that must not grow faster than the input."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from vitaelake.operators import shortlist, text_index, vectors
from vitaelake.plans import queries
from vitaelake.sources import manifest, staging
from vitaelake.sources.landing import empty_files, file_session, read_landing


def test_files_are_listed_without_a_task_or_a_process_per_file(spark, tmp_path):
    contents = {"HR/1.txt": b"one", "HR/deeper/2.txt": b"", "IT/3.txt": b"three", "IT/4.md": b""}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    parallelism = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    session, usual = file_session(spark), spark.conf.get(parallelism)
    assert int(session.conf.get(parallelism)) == 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(parallelism) == usual
    found = {s.getPath().getName(): s.getLen() for s in manifest.files(spark, str(tmp_path))}
    assert found == {"1.txt": 3, "2.txt": 0, "3.txt": 5, "4.md": 0}
    empty = empty_files(spark, str(tmp_path), "txt").collect()
    assert [r["path"].split("/")[-1] for r in empty] == ["2.txt"]
    manifest.age_files(spark, str(tmp_path), 40)
    old = time.time() - 39 * 86_400
    assert all(p.stat().st_mtime < old for p in tmp_path.rglob("*.*") if p.is_file() and p.suffix != ".crc")


def test_ingested_files_are_archived_by_several_threads(spark):
    threads = "spark.sql.streaming.fileSource.cleaner.numThreads"
    assert int(file_session(spark).conf.get(threads)) > 1


def test_one_scan_answers_many_blocks_of_queries(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(7)
    matrix = np.round(draw.normal(size=(700, 6)), 1)  # copies and ties among them
    matrix[600:] = matrix[:100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    scans, made = [], vectors._scan
    monkeypatch.setattr(vectors, "_scan", lambda ids, *rest: scans.append(len(ids)) or made(ids, *rest))
    got = vectors.match_vectors(df, df, 5, True, block=100).collect()
    assert scans == [700]
    units = matrix.astype(np.float32).astype(float)
    with np.errstate(invalid="ignore"):
        units = units / np.linalg.norm(units, axis=1, keepdims=True)
    cosines = np.round(units @ units.T, 9)
    expected = set()
    for query in range(700):
        order = [i for i in np.lexsort((np.arange(700), -cosines[query])) if i != query]
        order = [i for i in order if not np.isnan(cosines[query, i])]
        expected |= {(query, int(i), rank) for rank, i in enumerate(order[:5], 1)}
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in got} == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, n):
    rows = [(str(i), "c", f"w{i % 7} Wort{i % 3} w1") for i in range(n)]
    return spark.createDataFrame(rows, "resume_id string, category string, clean_text string")


def test_postings_of_several_segments_are_not_sorted_by_document(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    text_index.refresh_text_index(texts(spark, 30), root)
    index = text_index.refresh_text_index(texts(spark, 40).filter("resume_id <> '3'"), root)
    found = {r["resume_id"]: r["n"] for r in index.per_document(F.sum("tf").alias("n")).collect()}
    assert found == {str(i): 3 for i in range(40) if i != 3}
    monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", 0)
    assert "SortMergeJoin" not in plan_of(index.live_postings())
    counted = {r["resume_id"]: r["count"] for r in index.live_postings().groupBy("resume_id").count().collect()}
    assert set(counted) == set(found)


def test_postings_of_one_segment_are_joined_with_nothing(spark, tmp_path):
    docs = texts(spark, 30).unionByName(spark.createDataFrame([(None, "c", "w1")], texts(spark, 1).schema))
    index = text_index.refresh_text_index(docs, str(tmp_path / "index"))
    assert "Join" not in plan_of(index.live_postings())
    assert index.live_postings().agg(F.sum("tf")).first()[0] == 90


def test_postings_are_sorted_by_a_number_in_the_order_of_tokens(spark):
    tokens = ["", "a", "a0", "ab", "abcdefg", "abcdefgh", "b", "zz", "é", "été", "中文", "𝔘"]
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    rows = df.select("token", text_index._first_bytes(F.col("token")).alias("n")).collect()
    numbers = {r["token"]: r["n"] for r in rows}
    assert [numbers[t] for t in sorted(tokens, key=lambda t: t.encode()[:7])] == sorted(numbers.values())
    assert all(numbers[t] == int.from_bytes(t.encode()[:7].ljust(7, bytes(1)), "big") for t in tokens)


def test_an_embedding_cuts_a_text_into_words_once(spark):
    made = texts(spark, 3).select(queries.hashed_embedding(F.col("clean_text")).alias("e"))
    assert plan_of(made).count("split(") == 1
    assert all(sum(r["e"]) == 3.0 for r in made.collect())


def test_a_compacted_file_is_bounded(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    shortlist.record_actions(queries._actions(events).coalesce(1), log)
    size = staging.estimated_bytes(shortlist.read_actions(spark, log))
    monkeypatch.setattr(shortlist, "COMPACTED_FILE_BYTES", int(size / 1.9))
    shortlist.compact_actions(spark, log)
    assert len(list((tmp_path / "log" / "_compacted").rglob("*.parquet"))) == 2


def test_pages_land_in_local_folders_without_a_process_a_file(spark, tmp_path):
    rows = [(i, f"<p>é {i}</p>" if i % 4 else None) for i in range(40)] + [(7, "<p>é 7</p>"), (8, "a\nb")]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(3)
    folder = tmp_path / "files"
    queries._landed(pages, f"file://{folder}", days_ago=40)
    queries._landed(pages.limit(0), f"file://{folder}")
    found = [p for p in folder.rglob("*") if p.is_file()]
    # Spark's writer leaves a checksum beside each file and sets the rights of both.
    assert len(found) == len(rows) and all(p.suffix == ".txt" for p in found)
    expected = sorted((f"topic=topic{i % 3}", f"{html or ''}\n") for i, html in rows)
    assert sorted((p.parent.name, p.read_text()) for p in found) == expected
    assert all(abs(time.time() - 40 * 86_400 - p.stat().st_mtime) < 600 for p in found)
    assert not list((tmp_path / "files-drafts").iterdir())
    queries._landed(pages.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").iterdir())


def test_a_task_reads_more_than_a_few_small_files(spark, tmp_path):
    for i in range(2000):
        (tmp_path / f"{i}.txt").write_bytes(b"x")
    files = read_landing(spark, str(tmp_path), "txt")
    assert files.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert files.count() == 2000


def test_empty_files_of_a_local_folder_cost_no_call_each(spark, tmp_path, monkeypatch):
    names = ("a b/1.txt", "a b/2%20.txt", "ä/x/3.txt", "a b/.4.txt.crc", "a b/.5.txt", "6.md", "a b/7.txt")
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"7" if "7" in name else b"")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    listed = {(s.getPath().toString(), s.getLen()) for s in manifest.files(spark, str(tmp_path))}
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        assert set(manifest.lengths(spark, root, "")) == listed
    empty = {path for path, length in listed if length == 0 and path.endswith(".txt")}
    assert len(empty) == 4
    monkeypatch.setattr(manifest, "files", None)
    assert {r["path"] for r in empty_files(spark, str(tmp_path), "txt").collect()} == empty
