from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitaelake.operators import match, text_index
from vitaelake.sources import manifest, staging

SCHEMA = "resume_id string, category string, clean_text string"


def some_docs(spark, seed, n=60):
    draw = random.Random(seed)
    names = [f"w{i}" for i in range(40)] + ["Été", "the", "THE"]
    rows = [
        (str(i), f"c{i % 3}", " ".join(draw.choices(names, [1 / (j + 1) for j in range(43)], k=draw.randint(1, 50))))
        for i in range(n)
    ]
    rows += [("empty", "c0", ""), ("null", "c1", None), ("signs", "c2", "...")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def parts(index):
    """Everything a match reads, without the names of segments."""
    documents = index.documents.select("resume_id", "text_hash", F.round("norm", 9)).collect()
    live = index.live_postings().select("token", "resume_id", "tf").collect()
    return (
        sorted(map(tuple, live)), sorted(map(tuple, documents), key=repr),
        sorted(map(tuple, index.vocabulary.collect())), index.n_docs,
    )


def test_the_index_gives_the_answers_of_the_scan(spark, tmp_path):
    docs = some_docs(spark, 1)
    index = text_index.refresh_text_index(docs, str(tmp_path / "index"))
    for question in ("the w3", "w39 été", "W1 w1 w2 nowhere", "nowhere"):
        expected = list(map(tuple, match.match_text(docs, question, 7).collect()))
        assert list(map(tuple, text_index.match_index(index, docs, question, 7).collect())) == expected
    with pytest.raises(ValueError):
        text_index.match_index(index, docs, " ")


@pytest.mark.parametrize("most", [8, 1])
def test_refresh_equals_rebuild(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(text_index, "MAX_SEGMENTS", most)
    docs, root = some_docs(spark, 1), str(tmp_path / "index")
    text_index.refresh_text_index(docs, root)
    text = F.col("clean_text")
    changed = docs.withColumn("clean_text", F.when(F.length("resume_id") == 1, F.concat(text, F.lit(" new w1"))).otherwise(text))
    changed = changed.filter("resume_id NOT IN ('3', '7', 'null')").unionByName(
        spark.createDataFrame([("n1", "c0", "w1 fresh"), ("n2", "c0", None)], SCHEMA)
    )
    # Forth and back again: postings of a text that was there before are not counted twice.
    for now in (changed, docs, changed):
        refreshed = text_index.refresh_text_index(now, root)
        rebuilt = text_index.refresh_text_index(now, str(tmp_path / f"new-{random.random()}"))
        assert parts(refreshed) == parts(rebuilt)
    assert manifest.latest(spark, root)[0] == 4
    assert len(manifest.latest(spark, root)[1]["segments"]) == (4 if most == 8 else 1)
    assert len(list((tmp_path / "index" / "state").iterdir())) == 2  # this version's and the last one's
    assert len(list((tmp_path / "index" / "postings").iterdir())) == (4 if most == 8 else 2)
    text_index.refresh_text_index(changed, root)
    assert manifest.latest(spark, root)[0] == 4  # nothing to do, no version


def test_refresh_without_broadcasts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", 0)
    docs, root = some_docs(spark, 2), str(tmp_path / "index")
    text_index.refresh_text_index(docs.filter("resume_id <> '5'"), root)
    assert parts(text_index.refresh_text_index(docs, root)) == parts(
        text_index.refresh_text_index(docs, str(tmp_path / "other"))
    )


def test_a_match_reads_the_words_of_the_question_only(spark, tmp_path):
    docs = some_docs(spark, 1)
    index = text_index.refresh_text_index(docs, str(tmp_path / "index"))
    scan = index.postings.filter(F.col("token").isin(["w1", "w2"]))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(token, [w1,w2])]" in plan
    tokens = [r["token"] for r in index.postings.select("token").collect()]
    assert len(set(tokens)) > 2


def test_an_empty_index(spark, tmp_path):
    docs, root = some_docs(spark, 1), str(tmp_path / "index")
    assert text_index.open_index(spark, root) is None
    index = text_index.refresh_text_index(docs.limit(0), root)
    assert text_index.match_index(index, docs, "w1").count() == 0
    index = text_index.refresh_text_index(docs, root)
    assert parts(text_index.refresh_text_index(docs.limit(0), root)) == ([], [], [], 0)


def test_of_two_writers_one_publishes(spark, tmp_path):
    root = str(tmp_path / "versions")
    assert manifest.latest(spark, root) == (0, {})
    manifest.publish(spark, root, 1, {"a": 1})
    with pytest.raises(manifest.VersionTaken):
        manifest.publish(spark, root, 1, {"a": 2})
    assert manifest.latest(spark, root) == (1, {"a": 1})

    def change(content):
        if content["a"] == 1:  # another writer comes between
            manifest.publish(spark, root, 2, {"a": 5})
        return {"a": content["a"] + 1}

    assert manifest.update(spark, root, change) == {"a": 6}
    assert manifest.update(spark, root, lambda content: None) == {"a": 6}
    assert manifest.latest(spark, root) == (3, {"a": 6})
    drafts = [p.name for p in (tmp_path / "versions" / "_versions").iterdir() if "json" not in p.name]
    assert not drafts


ODD_TEXTS = (
    "É–tude «a» 1²3 x_y a\u00a0b e\u0301 İstanbul ǅ 𝔘𝔫 中文,日本 \x85c a\u2028b \x7f\x00z", "-", " ", "", None,
    "a" * 5_000, "a b\ta\nB;b é É", "١٢ ½ ⅷ ☃snow☃man " * 50, "de de de",
)


def test_words_are_those_of_the_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "TEXT_BYTES", 100)
    monkeypatch.setattr(text_index, "TURNED_WORDS", 5)
    rows = [(str(i % 8), "c", text) for i, text in enumerate(ODD_TEXTS)] + [(None, "c", "lost words"), ("8", "c", "w")]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    index = text_index.refresh_text_index(docs, str(tmp_path / "index"))
    found = index.postings.select("resume_id", "token", "tf").collect()
    expected = match.term_frequencies(docs, "resume_id", F.col("clean_text")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, expected), key=repr)
    held = {r["resume_id"]: (r["n"], r["tf"]) for r in index.per_document(F.count("*").alias("n"), F.sum("tf").alias("tf")).collect()}
    assert held["8"] == (1, 1) and held["6"] == (3, 7) and "1" not in held
    assert index.documents.count() == len(rows)


def test_a_stored_row_holds_several_documents_of_a_token(spark, tmp_path):
    rows = [(str(i), "c", f"the same of w{i % 7}") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    text_index.refresh_text_index(docs, str(tmp_path / "index"))
    stored = spark.read.parquet(f"{tmp_path}/index/postings/*")
    assert stored.count() * 10 < 4 * 400
    assert stored.agg(F.max(F.size("ids")), F.sum(F.size("ids"))).first() == (text_index.HOLDERS, 4 * 400)


@pytest.mark.parametrize("most", [1_000_000, 4, 0])
def test_norms_with_all_some_or_no_words_sent_to_tasks(spark, tmp_path, monkeypatch, most):
    rows = [(str(i), "c", f"the same w{i % 3} x{i} x{i}") for i in range(6000)] + [("none", "c", "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = {r["resume_id"]: round(r["norm"], 9) for r in text_index.refresh_text_index(
        docs, str(tmp_path / "all")).documents.filter("norm IS NOT NULL").collect()}
    monkeypatch.setattr(text_index, "fits_broadcast", lambda df: df.count() <= most)
    monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", most)
    documents = text_index.refresh_text_index(docs, str(tmp_path / "index")).documents
    found = {r["resume_id"]: r["norm"] and round(r["norm"], 9) for r in documents.collect()}
    assert found == {**expected, "none": None} and len(expected) == 6000
    x1 = 1 + math.log(6002 / 2)
    shared = 2 * (1 + math.log(6002 / 6001)) ** 2 + (1 + math.log(6002 / 2001)) ** 2
    assert found["1"] == pytest.approx(math.sqrt(shared + 4 * x1 * x1))


def test_an_index_of_another_layout_is_built_anew(spark, tmp_path):
    docs, root = some_docs(spark, 3), str(tmp_path / "index")
    manifest.publish(spark, root, 1, {"segments": ["a"], "state": "b", "n_docs": 1, "former": {}})
    assert text_index.open_index(spark, root) is None
    index = text_index.refresh_text_index(docs, root)
    assert parts(index) == parts(text_index.refresh_text_index(docs, str(tmp_path / "new")))
    assert manifest.latest(spark, root)[0] == 2


def test_ranges_of_postings_are_in_the_order_of_tokens_and_even(spark, tmp_path, monkeypatch):
    rows = [(str(i), "c", f"the w{i % 997:03d} été of {'中文' if i % 2 else 'zz'}") for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    words = text_index._write_words(docs, str(tmp_path / "index"), "a")
    tokens = spark.createDataFrame([(t,) for t in ["", "abcdefgh", "é", "w001", "𝔘x"]], "token string")
    expected = [r["n"] for r in tokens.select(text_index._first_bytes(F.col("token")).alias("n")).collect()]
    assert text_index._numbers(pa.array([r["token"] for r in tokens.collect()])).tolist() == expected
    assert text_index._numbers(pa.array(["x", "é", "b"])[1:]).tolist()[0] == expected[2]
    monkeypatch.setattr(text_index, "RANGE_BYTES", text_index.estimated_bytes(words) // 9)
    monkeypatch.setattr(text_index, "SAMPLED", 500)
    stored = text_index._write_postings(words, str(tmp_path / "index"), "a")
    numbered = stored.select(
        F.input_file_name().alias("file"), F.size("ids").alias("n"), text_index._first_bytes(F.col("token")).alias("at")
    )
    ranges = sorted((r["a"], r["b"], r["n"]) for r in numbered.groupBy("file").agg(
        F.min("at").alias("a"), F.max("at").alias("b"), F.sum("n").alias("n")).collect())
    assert sum(n for _, _, n in ranges) == 10_000 and len(ranges) >= 8
    assert all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:]))
    # "the", "of" and "été" are in all documents; each fills ranges of its own.
    assert max(n for _, _, n in ranges) < 2000
