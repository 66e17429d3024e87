"""Documents closest to a free text, and the upkeep of a vector table.

The text match is lexical (TF-IDF cosine). It stands where a hosted embedding
model would; with an embedding function of your own, keep a vector table by
``refresh_vectors`` and search it with ``match_vectors``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.config import MATCH_LIMIT_DEFAULT, MATCH_LIMIT_MAX
from vitaelake.functions.text import snippet, words
from vitaelake.operators.vectors import score_of
from vitaelake.sources.staging import by_hash, fits_broadcast, sized, stage

# With more terms than a broadcast can hold, those found in more than one
# document out of this many still go by broadcast. A document has finitely many
# terms, so there are at most this many times the mean terms per document.
COMMON_TERM_SHARE = 1000

_DIGITS = 9


def clamp(limit: int, most: int) -> int:
    """Limit held between 1 and ``most``."""
    return max(1, min(int(limit), most))


def term_frequencies(
    docs: DataFrame, key: str, text: Column, sharing: Sequence[str] | None = None
) -> DataFrame:
    """One row per document and distinct word: key, ``token``, ``tf``.

    The words of a row are sorted and cut into runs within the row, so nothing
    is shuffled to count them. With ``sharing``, only documents that hold one
    of these words are listed, all their words included.
    """
    listed = docs.select(key, F.sort_array(words(text)).alias("w"))
    is_start = lambda word, i: (i == 0) | (word != F.get("w", i - 1))
    marks = F.transform("w", lambda word, i: F.when(is_start(word, i), i))
    starts = F.filter(marks, lambda i: i.isNotNull())
    if sharing is not None:
        # An emptied list rather than a filter, which would be pushed below
        # the tokenising and repeat it.
        shared = F.arrays_overlap("w", F.array(*map(F.lit, sharing)))
        starts = F.when(shared, starts).otherwise(F.array().cast("array<int>"))
    listed = listed.select(key, "w", starts.alias("s"))
    runs = F.transform(
        "s",
        lambda at, i: F.struct(
            F.get("w", at).alias("token"),
            (F.coalesce(F.get("s", i + 1), F.size("w")) - at).alias("tf"),
        ),
    )
    return listed.select(key, F.inline(runs))


@dataclass(frozen=True)
class TermStatistics:
    """What the weights need to know of all documents, as a stored table."""

    vocabulary: DataFrame
    n_docs: int


def term_statistics(docs: DataFrame) -> TermStatistics:
    """Documents per token, and documents, for any number of ``match_text`` calls.

    Every document also counts for the empty token, which is no word, so one
    pass over the texts yields both.
    """
    found = F.coalesce(words(F.col("clean_text")), F.array().cast("array<string>"))
    tokens = F.explode(F.array_append(F.array_distinct(found), "")).alias("token")
    counted = docs.select(tokens).groupBy("token").agg(F.count("*").alias("df"))
    counted = stage(counted, "vocabulary")
    every = counted.filter("token = ''").first()
    return TermStatistics(counted.filter("token <> ''"), every["df"] if every else 0)


def idf(n_docs: int, df: Column) -> Column:
    """One at least, so that a word of all documents still counts as shared."""
    return F.log(F.lit(float(1 + n_docs)) / (df + 1)) + 1


def with_df(terms: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """Add each token's ``df``. Common tokens, the hot keys, are not shuffled."""
    if fits_broadcast(vocab):
        return terms.join(F.broadcast(vocab), "token")
    common = sized(
        stage(vocab.filter(F.col("df") * COMMON_TERM_SHARE > n_docs), "common-terms")
    )
    rare = vocab.filter(F.col("df") * COMMON_TERM_SHARE <= n_docs)
    columns = [*terms.columns, "df"]
    hot = terms.join(common, "token").select(*columns)
    cold = terms.join(common, "token", "left_anti").join(by_hash(rare), "token").select(*columns)
    return hot.unionByName(cold)


def match_text(
    docs: DataFrame,
    query_text: str,
    limit: int = MATCH_LIMIT_DEFAULT,
    statistics: TermStatistics | None = None,
) -> DataFrame:
    """Best documents for a text: id, category, score 0 to 1, and snippet.

    ``docs`` has ``resume_id``, ``category`` and ``clean_text``. Weights are
    tf * (1 + ln((1 + N) / (1 + df))), the score is the cosine moved to 0..1.
    Documents that share no word with the query are no matches.
    """
    if not query_text or not query_text.strip():
        raise ValueError("query text is required")
    limit = clamp(limit, MATCH_LIMIT_MAX)
    spark = docs.sparkSession

    text = F.col("clean_text")
    statistics = statistics or term_statistics(docs)
    vocab, n_docs = statistics.vocabulary, statistics.n_docs

    # The query is one short text, so its words are few.
    asked = term_frequencies(
        spark.createDataFrame([("query", query_text)], "id string, text string"),
        "id",
        F.col("text"),
    ).collect()
    counts = {r["token"]: r["tf"] for r in asked}
    known = vocab.filter(F.col("token").isin(list(counts))).collect()
    holders = {r["token"]: r["df"] for r in known}
    asked_weights = [
        (token, tf * (1 + math.log((1 + n_docs) / (1 + holders.get(token, 0)))))
        for token, tf in counts.items()
    ]
    query_norm = math.sqrt(sum(w * w for _, w in asked_weights))
    weights = spark.createDataFrame(
        asked_weights if query_norm else [], "token string, query_weight double"
    )
    terms = term_frequencies(docs, "resume_id", text, sharing=list(holders))

    weight = F.col("tf") * idf(n_docs, F.col("df"))
    best = (
        with_df(terms, vocab, n_docs)
        .withColumn("weight", weight)
        .join(F.broadcast(weights), "token", "left")
        .groupBy("resume_id")
        .agg(
            F.sum(F.col("weight") * F.col("query_weight")).alias("dot"),
            F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        )
        .filter("dot > 0")
        .withColumn(
            "cosine",
            F.round(F.col("dot") / (F.col("norm") * F.lit(query_norm or 1.0)), _DIGITS),
        )
        .orderBy(F.desc("cosine"), "resume_id")
        .limit(limit)
        .select("resume_id", "cosine")
        .collect()
    )
    # At most fifty ids by the clamp. As a filter they reach the scan, so no
    # other document is cleaned again for its snippet.
    found = spark.createDataFrame(best, "resume_id string, cosine double")
    return (
        docs.filter(F.col("resume_id").isin([r["resume_id"] for r in best]))
        .join(F.broadcast(found), "resume_id")
        .orderBy(F.desc("cosine"), "resume_id")
        .select(
            "resume_id",
            "category",
            score_of(F.col("cosine")).alias("match_score"),
            snippet(text).alias("snippet"),
        )
    )


def text_hash(text: Column) -> Column:
    """Fingerprint that tells whether a text has changed."""
    return F.xxhash64(text)


def vector_changes(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Ids to embed or drop: ``action`` is new, changed or removed.

    ``docs`` has ``resume_id`` and ``clean_text``; ``vectors`` has
    ``resume_id`` and ``text_hash``. Only ids and hashes are shuffled.
    """
    now = docs.select("resume_id", text_hash(F.col("clean_text")).alias("now"))
    then = vectors.select("resume_id", F.col("text_hash").alias("then"))
    action = (
        F.when(F.col("in_then").isNull(), "new")
        .when(F.col("in_now").isNull(), "removed")
        .when(~F.col("now").eqNullSafe(F.col("then")), "changed")
    )
    return (
        now.withColumn("in_now", F.lit(True))
        .join(then.withColumn("in_then", F.lit(True)), "resume_id", "full")
        .select("resume_id", action.alias("action"))
        .filter("action IS NOT NULL")
    )


def refresh_vectors(
    docs: DataFrame,
    vectors: DataFrame,
    embed: Callable[[pd.Series], pd.Series],
) -> DataFrame:
    """``refresh_vectors_by`` with a function from texts to vectors."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield embed(texts)

    return refresh_vectors_by(docs, vectors, run)


def refresh_vectors_by(
    docs: DataFrame, vectors: DataFrame, embedding: Callable[[Column], Column]
) -> DataFrame:
    """The vector table brought up to the documents.

    Embeds only new and changed texts, keeps the vectors of unchanged ones and
    drops those whose document is gone. Which texts are due is told by the smaller
    side, the ids that are due or those that are not, so a first load and a load with
    few changes join no text by shuffle.
    """
    changes = stage(vector_changes(docs, vectors), "vector-changes")
    due = changes.filter("action <> 'removed'").select("resume_id")
    current = vectors.select("resume_id", "text_hash", "embedding")
    kept = current.join(by_hash(changes.select("resume_id")), "resume_id", "left_anti")
    unchanged = stage(kept.select("resume_id"), "unchanged-vectors")
    n_due, n_unchanged = due.count(), unchanged.count()
    if not n_unchanged:
        texts = docs
    elif n_due <= n_unchanged:
        texts = docs.join(by_hash(due, n_due), "resume_id", "left_semi")
    else:
        texts = docs.join(by_hash(unchanged, n_unchanged), "resume_id", "left_anti")
    fresh = texts.select(
        "resume_id",
        text_hash(F.col("clean_text")).alias("text_hash"),
        embedding(F.col("clean_text")).alias("embedding"),
    )
    return kept.unionByName(fresh) if n_unchanged else fresh
