from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitaelake.operators import match, vectors
from vitaelake.sources import staging

EMBEDDINGS = "/root/testdata/sf0.01/embeddings.parquet"


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(EMBEDDINGS)


def brute_force(rows, queries, k, skip_self):
    ids = np.array([r["vec_id"] for r in rows])
    matrix = np.array([r["embedding"] for r in rows], dtype=float)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    found = set()
    for q in queries:
        v = np.array(q["embedding"], dtype=float)
        cosine = np.round(matrix @ (v / np.linalg.norm(v)), 9)
        order = [i for i in np.lexsort((ids, -cosine)) if not (skip_self and ids[i] == q["vec_id"])]
        for rank, i in enumerate(order[:k], 1):
            found.add((q["vec_id"], int(ids[i]), rank))
    return found


def triples(df):
    return {(r["query_id"], r["vec_id"], r["rank"]) for r in df.collect()}


def test_all_neighbours_in_blocks(embeddings):
    rows = embeddings.collect()
    got = vectors.match_vectors(embeddings.repartition(7), embeddings, 10, True, block=150)
    assert triples(got) == brute_force(rows, rows, 10, True)


def test_copies_tie_on_id_and_odd_vectors_are_no_match(spark):
    rows = [(i, [1.0, 2.0]) for i in range(200)]
    rows += [(900, None), (901, [0.0, 0.0]), (902, [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(9)
    query = spark.createDataFrame([(5, [2.0, 4.0])], "vec_id bigint, embedding array<float>")
    got = vectors.match_vectors(df, query, 3).orderBy("rank").collect()
    assert [(r["vec_id"], r["match_score"]) for r in got] == [(0, 1.0), (1, 1.0), (2, 1.0)]
    everything = vectors.match_vectors(df, query, 500).collect()
    assert len(everything) == 201 and min(r["match_score"] for r in everything) == 0.0
    assert vectors.match_vectors(df, query.limit(0), 3).count() == 0


def test_vectors_of_different_length_fail(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        vectors.match_vectors(df, df.limit(1), 1).collect()


def test_approximate_search_reports_recall_and_work(embeddings, tmp_path):
    queries = embeddings.filter("vec_id % 10 = 0")
    index = vectors.build_vector_index(embeddings, str(tmp_path / "index"), cells=16)
    exact = triples(vectors.match_vectors(embeddings, queries, 10, True))
    pairs = lambda found: {t[:2] for t in found}

    got = triples(vectors.match_vectors_approx(index, queries, 10, True, probes=12))
    recall = len(pairs(got) & pairs(exact)) / len(exact)
    examined = vectors.pairs_examined(index, queries, probes=12)
    everything = embeddings.count() * queries.count()
    assert recall >= 0.9 and examined < everything

    assert triples(vectors.match_vectors_approx(index, queries, 10, True, probes=16)) == exact
    assert vectors.pairs_examined(index, queries, probes=16) == everything


DOCS = [
    ("1", "HR", "Senior manager, led a team of ten"),
    ("2", "HR", "Junior clerk helped a team"),
    ("3", "IT", "Led data platform and data team"),
    ("4", "IT", "data data data"),
    ("5", "IT", "..."),
    ("6", "IT", "Led data platform and data team"),
    ("7", "HR", "éled ÉLED"),
]


def plain_scores(docs, query):
    tokens = lambda t: Counter(re.findall(r"[^\W_]+", t.lower()))
    tf = {i: tokens(t) for i, _, t in docs}
    df = Counter(w for counts in tf.values() for w in counts)
    weigh = lambda c: {
        w: n * (1 + math.log((1 + len(docs)) / (1 + df[w]))) for w, n in c.items()
    }
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    asked = weigh(tokens(query))
    scores = []
    for i, counts in tf.items():
        own = weigh(counts)
        dot = sum(own[w] * asked.get(w, 0) for w in own)
        if dot > 0:
            scores.append((i, round((1 + round(dot / norm(own) / norm(asked), 9)) / 2, 3)))
    return sorted(scores, key=lambda s: (-s[1], s[0]))


@pytest.mark.parametrize("way", ["broadcast", "common and rare terms apart"])
def test_match_text(spark, monkeypatch, way):
    if way != "broadcast":
        real = staging.fits_broadcast
        monkeypatch.setattr(match, "fits_broadcast", lambda _: False)
        monkeypatch.setattr(match, "COMMON_TERM_SHARE", 3)
        assert staging.fits_broadcast is real
    docs = spark.createDataFrame(DOCS, "resume_id string, category string, clean_text string")
    statistics = match.term_statistics(docs)
    for query in ("data team led", "unknown data", "ÉLED!"):
        got = match.match_text(docs.repartition(3), query, 5, statistics).collect()
        assert [(r["resume_id"], r["match_score"]) for r in got] == plain_scores(DOCS, query)[:5]
    assert got[0]["snippet"] == "éled ÉLED" and got[0]["category"] == "HR"
    assert match.match_text(docs, "nowhere", 5).count() == 0
    assert match.match_text(docs.limit(0), "data", 5).count() == 0
    assert match.term_statistics(docs).n_docs == len(DOCS)
    assert match.match_text(docs, "data team led", 0).count() == 1


@pytest.mark.parametrize("query", ["", "  ", None])
def test_blank_query(spark, query):
    docs = spark.createDataFrame(DOCS, "resume_id string, category string, clean_text string")
    with pytest.raises(ValueError):
        match.match_text(docs, query)


def test_term_frequencies(spark):
    docs = spark.createDataFrame([("a", "b a b, B c-a"), ("e", ""), ("n", None)], "id string, t string")
    got = {tuple(r) for r in match.term_frequencies(docs, "id", F.col("t")).collect()}
    assert got == {("a", "a", 2), ("a", "b", 3), ("a", "c", 1)}


def test_refresh_embeds_only_what_changed(spark):
    def embed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 1.0])

    def docs(rows):
        return spark.createDataFrame(rows, "resume_id string, clean_text string")

    nothing = spark.createDataFrame(
        [], "resume_id string, text_hash bigint, embedding array<float>"
    )
    first = match.refresh_vectors(docs([("1", "a"), ("2", "bb"), ("3", "ccc")]), nothing, embed)
    kept = spark.createDataFrame(
        [(r[0], r[1], [-1.0, -1.0]) for r in first.collect()], nothing.schema
    )
    now = docs([("1", "a"), ("2", "changed"), ("4", "dddd")])
    actions = {tuple(r) for r in match.vector_changes(now, kept).collect()}
    assert actions == {("2", "changed"), ("3", "removed"), ("4", "new")}
    second = {r[0]: r[2] for r in match.refresh_vectors(now, kept, embed).collect()}
    assert second == {"1": [-1.0, -1.0], "2": [7.0, 1.0], "4": [4.0, 1.0]}


def test_words_of_all_documents_still_match(spark):
    docs = spark.createDataFrame(
        [("1", "a", "data one"), ("2", "a", "data two")],
        "resume_id string, category string, clean_text string",
    )
    assert {r["resume_id"] for r in match.match_text(docs, "data team", 5).collect()} == {"1", "2"}
