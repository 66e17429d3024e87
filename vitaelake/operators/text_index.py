"""A stored inverted index for the text match, kept up by the changes of the documents.

``postings`` hold token, document and frequency, range-partitioned by token and sorted
by its first bytes, so a match reads only the pages of the question's words; a word of very many
documents is spread over several files. They are stored as rows of a token and up to
``HOLDERS`` documents, which are shuffled, sorted and joined in place of single postings.
``words`` hold the same by document, with spaces between its tokens, so what is asked per
document meets all its words in one task. A refresh writes the words of new and changed
documents as one more segment of both. ``documents`` tells for each document which segment
holds its words now, so older rows count no more, its text's hash, and the length
(norm) of its vector; ``vocabulary`` holds the documents per token. These two are
written anew by a refresh, from the last ones and the words, not from texts.

A version names the folders of all four, so readers see a refresh whole or not at all.
The version before stays readable; what only older ones have read is deleted.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.config import MATCH_LIMIT_DEFAULT, MATCH_LIMIT_MAX
from vitaelake.functions.text import ascii_separated, snippet
from vitaelake.operators.match import (
    _DIGITS,
    COMMON_TERM_SHARE,
    clamp,
    idf,
    term_frequencies,
    text_hash,
    vector_changes,
)
from vitaelake.operators.vectors import score_of
from vitaelake.sources import manifest
from vitaelake.sources.staging import by_hash, estimated_bytes, fits_broadcast, scope, stage

POSTINGS = "token string, ids array<string>, tfs array<int>"
WORDS = "resume_id string, text_hash bigint, tokens string, tfs array<int>"
DOCUMENTS = "resume_id string, text_hash bigint, segment string, norm double"
VOCABULARY = "token string, df bigint"
#: With more segments than this, a refresh writes all live postings as one.
MAX_SEGMENTS = 8
#: Documents of a stored row of postings; a word of very many has rows enough to be spread.
HOLDERS = 16
#: Bytes of words whose postings make one range, and documents that the ranges are told by.
RANGE_BYTES, SAMPLED = 10 * 1024 * 1024, 20_000
#: Of words and postings, which are long and much alike.
CODEC = "zstd"
#: Bytes of text that are cut into words at a time, and words that are turned round.
TEXT_BYTES, TURNED_WORDS = 4 * 1024 * 1024, 4_000_000
#: Of the folders of a version; an index of another layout is built anew.
LAYOUT = 2


@dataclass(frozen=True)
class TextIndex:
    """One version of the index: what a match reads."""

    postings: DataFrame
    words: DataFrame
    documents: DataFrame
    vocabulary: DataFrame
    n_docs: int
    #: Whether all postings are of current words, as those of a single segment are.
    all_live: bool = False

    def live_postings(self) -> DataFrame:
        """Postings of the documents' current words."""
        if self.all_live:
            return self.postings.filter("resume_id IS NOT NULL")
        current = self.documents.select("resume_id", "segment")
        return self.postings.join(by_hash(current), ["resume_id", "segment"], "left_semi")

    def per_document(self, *numbers: Column) -> DataFrame:
        """Aggregates over each document's current words.

        Older words are counted too and left out after: only a row per document and
        segment is shuffled and joined.
        """
        counted = _listed(self.words, "segment").groupBy("resume_id", "segment").agg(*numbers)
        current = self.documents.select("resume_id", "segment")
        return counted.join(current, ["resume_id", "segment"], "left_semi").drop("segment")


def open_index(spark: SparkSession, root: str) -> TextIndex | None:
    """The current version, None where there is none."""
    number, content = manifest.latest(spark, root)
    return _opened(spark, root, content) if number and content.get("layout") == LAYOUT else None


def _opened(spark: SparkSession, root: str, content: dict) -> TextIndex:
    names, state = content["segments"], f"{root}/state/{content['state']}"
    named = lambda frame, name: frame.withColumn("segment", F.lit(name))
    return TextIndex(
        reduce(DataFrame.unionByName, [named(_postings(spark, root, name), name) for name in names]),
        reduce(DataFrame.unionByName, [named(_words(spark, root, name), name) for name in names]),
        spark.read.schema(DOCUMENTS).parquet(f"{state}/documents"),
        spark.read.schema(VOCABULARY).parquet(f"{state}/vocabulary"),
        content["n_docs"],
        len(names) == 1,
    )


def _words(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(WORDS).parquet(f"{root}/words/{name}")


def _postings(spark: SparkSession, root: str, name: str) -> DataFrame:
    stored = spark.read.schema(POSTINGS).parquet(f"{root}/postings/{name}")
    # No row is without documents, so the outer form, which tests nothing, does.
    held = stored.select("token", "tfs", F.posexplode_outer("ids").alias("at", "resume_id"))
    return held.select("token", "resume_id", F.get("tfs", "at").alias("tf"))


def _listed(words: DataFrame, *columns: str) -> DataFrame:
    """A row per document and word, with ``token`` and ``tf``."""
    tokens = F.posexplode_outer(F.split("tokens", " ")).alias("at", "token")
    terms = words.select("resume_id", *columns, "tfs", tokens).filter("token IS NOT NULL")
    return terms.select("resume_id", *columns, "token", F.get("tfs", "at").alias("tf"))


def _slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that sum up to about ``most``, or exceed it by one row."""
    total = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = np.append(np.flatnonzero(np.diff(total // most)) + 1, batch.num_rows)
    start = 0
    for end in ends.tolist():
        if end > start:
            yield batch.slice(start, end - start)
        start = end


#: A byte of UTF-8, or a space for the ASCII characters that are no part of a word.
_SPACED = np.array([b if b > 127 or chr(b).isalnum() else 32 for b in range(256)], dtype=np.uint8)


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts whose words have spaces between them."""
    valid, offsets, data = texts.buffers()
    if data is None:
        return texts
    spaced = pa.py_buffer(_SPACED[np.frombuffer(data, dtype=np.uint8)])
    return pa.StringArray.from_buffers(len(texts), offsets, spaced, valid, -1, texts.offset)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every text and how often it has them."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        batch = batch.set_column(at, "text", _spaced(batch.column("text").cast("string")))
        for part in _slices(batch, pc.binary_length(batch.column("text")), TEXT_BYTES):
            lists = pc.split_pattern(part.column("text"), " ")
            n_words = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            row, words = np.repeat(np.arange(part.num_rows), n_words), lists.flatten()
            some = pc.not_equal(words, "")
            row, coded = row[some.to_numpy(zero_copy_only=False)], words.filter(some).dictionary_encode()
            n_codes = max(len(coded.dictionary), 1)
            found, tf = np.unique(row * n_codes + coded.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(found, n_codes)
            starts = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), "int32")
            tokens = pa.ListArray.from_arrays(starts, coded.dictionary.take(pa.array(code)))
            joined = pc.binary_join(tokens, " ")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("resume_id"),
                    part.column("text_hash"),
                    pc.if_else(pc.equal(joined, ""), None, joined),
                    pa.ListArray.from_arrays(starts, pa.array(tf, "int32")),
                ],
                ["resume_id", "text_hash", "tokens", "tfs"],
            )


def _terms(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """Documents with, for each of their words: row, number, the numbers' words, and tf."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("tokens")))
        for part in _slices(batch, pc.list_value_length(batch.column("tfs")), TURNED_WORDS):
            lists = pc.split_pattern(part.column("tokens"), " ")
            coded = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
            yield part, row, coded.indices.to_numpy(), coded.dictionary, part.column("tfs").flatten().to_numpy()


def _numbers(words: pa.Array) -> np.ndarray:
    """``_first_bytes`` of the words."""
    spans, data = words.buffers()[1:]
    spans = np.frombuffer(spans, dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.append(np.frombuffer(data or b"", dtype=np.uint8), np.uint8(0))
    numbers = np.zeros(len(words), dtype=np.int64)
    for i in range(7):
        at = spans[:-1] + i
        inside = at < spans[1:]
        numbers = numbers * 256 + np.where(inside, data[np.where(inside, at, 0)], 0)
    return numbers


def _turned_by(
    bounds: np.ndarray,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words of documents as rows of a word and some of the documents that have it.

    ``part`` is the range of the word; the rows of one that fills several ranges take turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, codes, words, tf in _terms(batches):
            numbers = _numbers(words)
            lowest = np.searchsorted(bounds, numbers)
            ranges = np.searchsorted(bounds, numbers, "right") - lowest + 1
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            place = np.arange(len(codes)) - np.repeat(first, np.diff(first, append=len(codes)))
            heads = np.flatnonzero(place % HOLDERS == 0)
            starts = pa.array(np.append(heads, len(codes)), "int32")
            holders = part.column("resume_id").take(pa.array(row[order]))
            at = codes[heads]
            yield pa.RecordBatch.from_arrays(
                [
                    words.take(pa.array(at)),
                    pa.ListArray.from_arrays(starts, holders),
                    pa.ListArray.from_arrays(starts, pa.array(tf[order])),
                    pa.array(lowest[at] + np.arange(len(at)) % ranges[at], "int32"),
                ],
                ["token", "ids", "tfs", "part"],
            )

    return run


def _weighed_by(known: pa.Table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document the sum of squares over its known words, and the words left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = known["token"].combine_chunks()
        squares = np.append(known["square"].to_numpy(), 0.0)
        for part, row, codes, words, tf in _terms(batches):
            at = pc.index_in(words, tokens).fill_null(-1).to_numpy()[codes]
            sums = np.bincount(row, squares[at] * tf.astype(np.float64) ** 2, part.num_rows)
            rest = np.flatnonzero(at < 0)
            starts = pa.array(np.searchsorted(row[rest], np.arange(part.num_rows + 1)), "int32")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("resume_id"),
                    part.column("place"),
                    pa.array(sums),
                    pa.ListArray.from_arrays(starts, words.take(pa.array(codes[rest]))),
                    pa.ListArray.from_arrays(starts, pa.array(tf[rest])),
                ],
                ["resume_id", "place", "square", "tokens", "tfs"],
            )

    return run


def _write_words(texts: DataFrame, root: str, name: str) -> DataFrame:
    """The words of a segment by document, also of those without any, as read back."""
    clean = F.col("clean_text")
    hashed = texts.select(
        "resume_id", text_hash(clean).alias("text_hash"), ascii_separated(clean).alias("text")
    )
    hashed.mapInArrow(_counted, WORDS).write.parquet(f"{root}/words/{name}", compression=CODEC)
    return _words(texts.sparkSession, root, name)


def _bounds(words: DataFrame, n_ranges: int) -> np.ndarray:
    """Numbers of tokens that cut the postings into ranges of about one size."""
    n_rows = words.count()
    some = words.sample(min(1.0, SAMPLED / n_rows), 7) if n_rows > SAMPLED else words
    tokens = some.select(F.explode_outer(F.split("tokens", " ")).alias("token"))
    shares = [i / n_ranges for i in range(1, n_ranges)]
    if not shares:
        return np.empty(0, dtype=np.int64)
    # Accuracy beyond the ranges, so that a word's share is met.
    found = tokens.select(_first_bytes(F.col("token")).alias("n")).agg(
        F.percentile_approx("n", shares, max(10_000, 20 * n_ranges)).alias("n")
    )
    return np.array(found.first()["n"] or [], dtype=np.int64)


def _write_postings(words: DataFrame, root: str, name: str) -> DataFrame:
    """Ranges of token, of which a frequent token fills several; its rows by token."""
    spark = words.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n_ranges = max(-(-estimated_bytes(words) // RANGE_BYTES), min(cores, words.count() // HOLDERS), 1)
    turn = _turned_by(_bounds(words, n_ranges))
    rows = words.select("resume_id", "tokens", "tfs").mapInArrow(turn, f"{POSTINGS}, part int")
    ranged = rows.repartitionById(n_ranges, F.col("part")).drop("part")
    # A whole number is sorted by its digits, without comparisons of the rows' strings.
    ordered = ranged.sortWithinPartitions(_first_bytes(F.col("token")))
    ordered.write.parquet(f"{root}/postings/{name}", compression=CODEC)
    return spark.read.schema(POSTINGS).parquet(f"{root}/postings/{name}")


def _first_bytes(token: Column) -> Column:
    """The first seven bytes as a whole number, in the order of the tokens.

    Tokens that share these bytes stay mixed, but side by side.
    """
    padded = F.rpad(F.substring(F.encode(token, "UTF-8"), 1, 7), 7, F.lit(bytes(1)))
    return F.conv(F.hex(padded), 16, 10).cast("bigint")


def _norms(
    spark: SparkSession, root: str, names: list[str], vocabulary: DataFrame, n_docs: int
) -> DataFrame:
    """Length of the vector per document and segment, be its words current or older ones.

    Tasks get the words of many documents, or all if they are few, and sum these up where
    the document lies; only the rest is joined by shuffle. A segment goes by its place in
    ``names``.
    """
    many = F.col("df") * COMMON_TERM_SHARE > n_docs
    known = vocabulary if fits_broadcast(vocabulary) else stage(vocabulary.filter(many), "common-terms")
    if not fits_broadcast(known):
        known = known.limit(0)
    factor = idf(n_docs, F.col("df"))
    sent = known.select("token", (factor * factor).alias("square")).toArrow()
    placed = [_words(spark, root, name).withColumn("place", F.lit(i)) for i, name in enumerate(names)]
    words = reduce(DataFrame.unionByName, placed).select("resume_id", "place", "tokens", "tfs")
    schema = "resume_id string, place int, square double, tokens array<string>, tfs array<int>"
    weighed = stage(words.mapInArrow(_weighed_by(sent), schema), "weighed-documents")
    squares = weighed.select("resume_id", "place", "square")
    if sent.num_rows < vocabulary.count():
        rest = vocabulary.filter(~many) if sent.num_rows else vocabulary
        left = weighed.select("resume_id", "place", "tfs", F.posexplode("tokens").alias("at", "token"))
        joined = left.select("resume_id", "place", "token", F.get("tfs", "at").alias("tf")).join(
            by_hash(rest), "token"
        )
        weight = F.col("tf") * factor
        squares = squares.unionByName(
            joined.select("resume_id", "place", (weight * weight).alias("square"))
        )
    segment = F.element_at(F.array(*map(F.lit, names)), F.col("place") + 1).alias("segment")
    lengths = squares.groupBy("resume_id", "place").agg(F.sqrt(F.sum("square")).alias("norm"))
    return lengths.select("resume_id", segment, "norm")


def refresh_text_index(docs: DataFrame, root: str) -> TextIndex:
    """Bring the index up to ``docs`` (``resume_id``, ``clean_text``); build it if missing.

    Only texts that are new or have changed are cut into words. Without changes no new
    version is made. If another writer publishes first, ``VersionTaken`` is raised and
    the index is as that writer left it.
    """
    spark, root = docs.sparkSession, root.rstrip("/")
    with scope(spark):
        return _refreshed(spark, docs, root)


def _refreshed(spark: SparkSession, docs: DataFrame, root: str) -> TextIndex:
    number, content = manifest.latest(spark, root)
    old = open_index(spark, root)
    name, state = f"{number + 1:012d}-{uuid.uuid4().hex}", uuid.uuid4().hex
    texts = docs.select("resume_id", "clean_text")
    per_token = lambda rows, df: rows.groupBy("token").agg(df.alias("df"))

    if old is None:
        words = _write_words(texts, root, name)
        documents = words.select("resume_id", "text_hash", F.lit(name).alias("segment"))
        segments = [name]
    else:
        changes = stage(vector_changes(docs, old.documents), "index-changes")
        if not changes.take(1):
            return old
        due = by_hash(changes.filter("action <> 'removed'").select("resume_id"))
        gone = by_hash(changes.filter("action <> 'new'").select("resume_id"))
        words = _write_words(texts.join(due, "resume_id", "left_semi"), root, name)
        fresh = words.select("resume_id", "text_hash", F.lit(name).alias("segment"))
        kept = old.documents.drop("norm").join(
            by_hash(changes.select("resume_id")), "resume_id", "left_anti"
        )
        documents = stage(kept.unionByName(fresh), "indexed-documents")
        # Of a document that goes its words are joined as one row.
        going = old.documents.join(gone, "resume_id", "left_semi").select("resume_id", "segment")
        going = by_hash(stage(going, "going-documents"))
        lost = old.words.select("resume_id", "segment", "tokens", "tfs").join(
            going, ["resume_id", "segment"], "left_semi"
        )
        segments = [*content["segments"], name]

    if len(segments) <= MAX_SEGMENTS:
        vocabulary = per_token(_write_postings(words, root, name), F.sum(F.size("tfs")))
    else:
        vocabulary = per_token(_listed(words), F.count("*"))
    if old is not None:
        vocabulary = (
            old.vocabulary.unionByName(vocabulary)
            .unionByName(per_token(_listed(lost), -F.count("*")))
            .groupBy("token")
            .agg(F.sum("df").alias("df"))
            .filter("df > 0")
        )
    vocabulary.select("token", "df").sort("token").write.parquet(f"{root}/state/{state}/vocabulary")
    vocabulary = spark.read.schema(VOCABULARY).parquet(f"{root}/state/{state}/vocabulary")
    n_docs = documents.count()
    if len(segments) > MAX_SEGMENTS:
        every = [_words(spark, root, s).withColumn("segment", F.lit(s)) for s in segments]
        current = by_hash(documents.select("resume_id", "segment"))
        live = reduce(DataFrame.unionByName, every).join(current, ["resume_id", "segment"], "left_semi")
        one = f"{number + 1:012d}-{uuid.uuid4().hex}"
        live.drop("segment").write.parquet(f"{root}/words/{one}", compression=CODEC)
        manifest.delete(spark, f"{root}/words/{name}")  # no version has named it
        segments = [one]
        documents = documents.withColumn("segment", F.lit(one))
        _write_postings(_words(spark, root, one), root, one)
    norms = _norms(spark, root, segments, vocabulary, n_docs)
    normed = documents.join(norms, ["resume_id", "segment"], "left")
    normed.select("resume_id", "text_hash", "segment", "norm").write.parquet(
        f"{root}/state/{state}/documents"
    )
    former = {name: content.get(name) for name in ("segments", "state")}
    new = {"layout": LAYOUT, "segments": segments, "state": state, "n_docs": n_docs, "former": former}
    manifest.publish(spark, root, number + 1, new)
    _clean(spark, root, content, segments)
    return _opened(spark, root, new)


def _clean(spark: SparkSession, root: str, content: dict, segments: list[str]) -> None:
    """Delete what only the version before ``content`` has read; readers of ``content`` may be at work."""
    older = content.get("former") or {}
    if older.get("state"):
        manifest.delete(spark, f"{root}/state/{older['state']}")
    for name in older.get("segments") or []:
        if name not in content["segments"] and name not in segments:
            for kind in ("postings", "words"):
                manifest.delete(spark, f"{root}/{kind}/{name}")


def match_index(
    index: TextIndex, docs: DataFrame, query_text: str, limit: int = MATCH_LIMIT_DEFAULT
) -> DataFrame:
    """Best documents for a text by the index; the answer of ``match.match_text``.

    Of ``docs`` only the rows found are read, for ``category`` and snippet.
    """
    if not query_text or not query_text.strip():
        raise ValueError("query text is required")
    limit = clamp(limit, MATCH_LIMIT_MAX)
    spark = docs.sparkSession
    # The question is one short text, so its words are few.
    asked = term_frequencies(
        spark.createDataFrame([("query", query_text)], "id string, text string"), "id", F.col("text")
    ).collect()
    counts = {row["token"]: row["tf"] for row in asked}
    known = index.vocabulary.filter(F.col("token").isin(list(counts))).collect()
    holders = {row["token"]: row["df"] for row in known}
    factor = lambda df: 1 + math.log((1 + index.n_docs) / (1 + df))
    asked_weights = {t: tf * factor(holders.get(t, 0)) for t, tf in counts.items()}
    query_norm = math.sqrt(sum(w * w for w in asked_weights.values())) or 1.0
    rows = [(t, asked_weights[t] * factor(df)) for t, df in holders.items()]
    weights = spark.createDataFrame(rows, "token string, weight double")

    found = (
        index.postings.filter(F.col("token").isin(list(holders)))
        .join(F.broadcast(weights), "token")
        .groupBy("resume_id", "segment")
        .agg(F.sum(F.col("tf") * F.col("weight")).alias("dot"))
        .join(index.documents, ["resume_id", "segment"])
        .withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * query_norm), _DIGITS))
        .orderBy(F.desc("cosine"), "resume_id")
        .limit(limit)
        .select("resume_id", "cosine")
        .collect()
    )
    best = spark.createDataFrame(found, "resume_id string, cosine double")
    return (
        docs.filter(F.col("resume_id").isin([row["resume_id"] for row in found]))
        .join(F.broadcast(best), "resume_id")
        .orderBy(F.desc("cosine"), "resume_id")
        .select(
            "resume_id",
            "category",
            score_of(F.col("cosine")).alias("match_score"),
            snippet(F.col("clean_text")).alias("snippet"),
        )
    )
