"""Every operator as a query over the driver's tables.

``documents`` plays Bronze, ``pages`` the raw files, ``conversations`` rows with
a repeated key, ``embeddings`` the vector table and ``events`` the action log.
The documents hold none of the default lexicon terms, so the scores here use
words that do occur; the defaults are tested on hand-made rows.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.config import Lexicon
from vitaelake.functions.extract import utf8_column, utf8_text
from vitaelake.functions.text import clean_text, html_text, words
from vitaelake.operators import gold, match, shortlist, text_index, vectors
from vitaelake.operators.dedupe import dedupe
from vitaelake.operators.quarantine import normalized, quarantine, readable, triage
from vitaelake.operators.silver import KEYS, ORDER, silver
from vitaelake.plans import lake, tools
from vitaelake.sources import landing, manifest
from vitaelake.sources.staging import shared_dir, spread, stage
from vitaelake.sources.tables import create_layers, replace_table
from vitaelake.streaming.ingest import ingest, read_bronze
from vitaelake.streaming.shortlist import read_shortlist, start_shortlist

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-01 00:00:00"
SOURCE = "documents"
MIN_WORDS = 5
LEADERSHIP = Lexicon(plus=("the", "of"), minus=("and", "to"))
SENIORITY = Lexicon(plus=("in the", "of the", "that"), minus=("for", "with"))
QUERY_TEXT = "the thing that is in the house and for the people with an order of events"
DEFAULT_ACTOR = "service@example.org"

QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bronze


def _paths(docs: DataFrame, folder: Column) -> DataFrame:
    path = F.concat(F.lit("/landing/"), folder, F.lit("/"), F.col("doc_id"), F.lit(".pdf"))
    return docs.select(path.alias("path"), F.col("text").alias("raw_text"))


def bronze(spark: SparkSession, sf_dir: str, folder: str = "source") -> DataFrame:
    docs = spread(_table(spark, sf_dir, "documents"), "doc_id")
    return landing.bronze_rows(_paths(docs, F.expr(folder)), SOURCE, as_of=AS_OF)


@_query
def bronze_path_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).select("file_path", "resume_id", "category")


@_query
def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir)


@_query
def bronze_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.highest_first(gold.category_counts(bronze(spark, sf_dir)), "resume_count")


@_query
def extract_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(_table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", html_text(F.col("html")).alias("raw_text"))


@_query
def extract_bytes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(_table(spark, sf_dir, "pages"), "page_id")
    content = F.encode("html", "UTF-8")
    return pages.select("page_id", utf8_column(content).alias("raw_text"))


# Silver


def _silver(spark: SparkSession, sf_dir: str, folder: str = "source") -> DataFrame:
    return silver(bronze(spark, sf_dir, folder), LEADERSHIP, SENIORITY, MIN_WORDS)


def _silver_numbers(spark: SparkSession, sf_dir: str, folder: str = "source") -> DataFrame:
    """Silver without the text, as a table, for queries that read it twice."""
    columns = ("category", "resume_id", "word_count", "leadership_score")
    return stage(_silver(spark, sf_dir, folder).select(*columns), "silver-numbers")


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze, Silver and quarantine as far as their rows are counted."""
    triaged = stage(triage(bronze(spark, sf_dir), MIN_WORDS), "triage")
    kept = dedupe(triaged.filter("NOT is_unreadable"), KEYS, ORDER)
    return triaged, kept, quarantine(triaged, AS_OF)


@_query
def silver_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(bronze(spark, sf_dir)).select("resume_id", "clean_text")


@_query
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = quarantine(triage(bronze(spark, sf_dir), MIN_WORDS), AS_OF)
    return lost.select("resume_id", "category", "file_path", "reason")


@_query
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(_table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])


@_query
def silver_dedup_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_table(spark, sf_dir, "documents"), "doc_id")
    hashed = docs.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("resume_id"),
        F.col("source").alias("category"),
        F.md5(clean_text(F.col("text"))).alias("content"),
    )
    # Without the text a row is narrow, and staged it is hashed only once.
    kept = dedupe(stage(hashed, "content-keys"), ["content"], ["doc_id"])
    return kept.select("resume_id", "category")


@_query
def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@_query
def silver_category_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.highest_first(gold.category_check(_silver(spark, sf_dir)), "resume_count")


@_query
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.layer_counts(*_layers(spark, sf_dir))


# Gold


@_query
def gold_category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_stats(_silver(spark, sf_dir))


@_query
def gold_top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_candidates(_silver_numbers(spark, sf_dir))


@_query
def gold_contact_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.contact_quality(_silver(spark, sf_dir))


@_query
def gold_length_vs_leadership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.length_vs_leadership(_silver_numbers(spark, sf_dir))


@_query
def length_leadership_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.length_leadership_correlation(_silver(spark, sf_dir), digits=6)


@_query
def gold_category_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_health(*_layers(spark, sf_dir))


# Match


def label_centroids(embeddings: DataFrame) -> DataFrame:
    """Mean vector per label: few query vectors, drawn from the whole table."""
    means = (
        embeddings.select("label", F.posexplode("embedding").alias("at", "x"))
        .groupBy("label", "at")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    # One entry per dimension and label, whatever the number of vectors.
    sorted_pairs = F.array_sort(F.collect_list(F.struct("at", "x")))
    return means.groupBy(F.col("label").cast("bigint").alias("vec_id")).agg(
        F.transform(sorted_pairs, lambda p: p["x"]).alias("embedding")
    )


@_query
def match_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return vectors.match_vectors(embeddings, label_centroids(embeddings), k=10)


@_query
def match_vectors_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    path = f"{shared_dir(spark)}/vector-index-{uuid.uuid4().hex}"
    index = vectors.build_vector_index(embeddings, path, cells=16)
    return vectors.match_vectors_approx(index, label_centroids(embeddings), k=10, probes=12)


@_query
def match_vectors_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is a query, in blocks of which one at a time passes the driver."""
    embeddings = _table(spark, sf_dir, "embeddings")
    return vectors.match_vectors(embeddings, embeddings, k=10, skip_self=True, block=512)


#: The test vectors have no clusters, so it takes most cells to find nine of ten neighbours.
HASH_DIMENSIONS, HASH_BITS, HASH_PROBES = 64, 6, 57


def _hashed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    path = f"{shared_dir(spark)}/hash-index-{uuid.uuid4().hex}"
    index = vectors.build_hash_index(embeddings, path, HASH_DIMENSIONS, HASH_BITS)
    return vectors.match_vectors_approx(
        index, label_centroids(embeddings), k=10, probes=HASH_PROBES, with_pairs=True
    )


@_query
def match_vectors_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed_matches(spark, sf_dir).filter("rank IS NOT NULL").drop("pairs")


@_query
def match_vectors_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query the pairs that the scans compared, of how many, and the neighbours found."""
    embeddings = _table(spark, sf_dir, "embeddings")
    exact = vectors.match_vectors(embeddings, label_centroids(embeddings), k=10)
    near = _hashed_matches(spark, sf_dir).select("query_id", "vec_id", "pairs")
    right = exact.select("query_id", "vec_id", F.lit(1).alias("right"))
    usable = embeddings.filter("embedding IS NOT NULL").agg(F.count("*")).scalar()
    return (
        near.join(right, ["query_id", "vec_id"], "left")
        .groupBy("query_id")
        .agg(F.max("pairs").alias("pairs"), F.count("right").alias("found"))
        .withColumn("vectors", usable)
    )


@_query
def vector_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a vector table that knew other ones."""
    docs = spread(_table(spark, sf_dir, "documents"), "doc_id")
    resume_id = F.col("doc_id").cast("string").alias("resume_id")
    now = docs.filter("source <> 'src0'").select(resume_id, F.col("text").alias("clean_text"))
    then_text = F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text"))
    then = docs.filter("lang <> 'es'").select(
        resume_id, match.text_hash(then_text).alias("text_hash")
    )
    return match.vector_changes(now, then)


def hashed_embedding(text: Column) -> Column:
    """Eight counts of words by first letter and length: a vector without a model."""
    bins = F.transform(words(text), lambda w: (F.ascii(w) * 31 + F.length(w)) % 8)

    def count(of: Column, i: int) -> Column:
        return F.size(F.filter(of, lambda x: x == i)).cast("float")

    # As the element of an array the bins are made once, not once per count.
    counts = F.transform(F.array(bins), lambda of: F.array(*(count(of, i) for i in range(8))))
    return F.get(counts, 0)


@_query
def vectors_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the vectors of other texts and documents, brought up to the documents."""
    docs = spread(_table(spark, sf_dir, "documents"), "doc_id")
    resume_id = F.col("doc_id").cast("string").alias("resume_id")
    old_text = F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text"))
    then = docs.filter("lang <> 'es'").select(resume_id, old_text.alias("clean_text"))
    none = spark.createDataFrame([], "resume_id string, text_hash long, embedding array<float>")
    first = stage(match.refresh_vectors_by(then, none, hashed_embedding), "first-vectors")
    now = docs.filter("source <> 'src0' OR lang = 'es'")
    now = now.select(resume_id, F.col("text").alias("clean_text"))
    current = match.refresh_vectors_by(now, first, hashed_embedding)
    numbers = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    return current.select("resume_id", F.array_join(numbers, ",").alias("embedding"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(readable(bronze(spark, sf_dir)))


def _text_index(spark: SparkSession, sf_dir: str) -> text_index.TextIndex:
    """The stored index of these files; built by whoever asks first."""
    files = sorted(_table(spark, sf_dir, "documents").inputFiles())
    state = [manifest.fingerprint(spark, name) for name in files]
    key = hashlib.sha256(repr((files, state)).encode()).hexdigest()[:16]
    root = f"{shared_dir(spark)}/text-index-{key}"
    index = text_index.open_index(spark, root)
    return index or text_index.refresh_text_index(_texts(spark, sf_dir), root)


@_query
def text_index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and occurrences of every token, as the index has them."""
    index = _text_index(spark, sf_dir)
    occurrences = index.live_postings().groupBy("token").agg(F.sum("tf").alias("tf"))
    return index.vocabulary.join(occurrences, "token", "left").select("token", "df", "tf")


@_query
def text_index_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and vector length of every document, of an index that knew other texts."""
    docs = _texts(spark, sf_dir)
    text = F.col("clean_text")
    other = F.when(F.col("resume_id") % 3 == 0, F.concat(text, F.lit(" once more"))).otherwise(text)
    then = docs.withColumn("clean_text", other).filter("resume_id % 7 <> 0")
    lost = docs.withColumn("resume_id", F.concat("resume_id", F.lit("-gone")))
    root = f"{shared_dir(spark)}/text-index-{uuid.uuid4().hex}"
    text_index.refresh_text_index(then.unionByName(lost), root)
    index = text_index.refresh_text_index(docs, root)
    held = index.per_document(F.count("*").alias("terms"), F.sum("tf").alias("words"))
    return index.documents.join(held, "resume_id", "left").select(
        "resume_id", "terms", "words", F.round("norm", 6).alias("norm")
    )


@_query
def tool_match_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _text_index(spark, sf_dir)
    return tools.find_indexed_resumes(index, _texts(spark, sf_dir), QUERY_TEXT, 10)


# Tools


@_query
def tool_category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.get_category_stats(gold.category_stats(_silver(spark, sf_dir)))


@_query
def tool_search_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.search_resumes(gold.top_candidates(_silver_numbers(spark, sf_dir)))


@_query
def tool_search_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Category names may hold letters and hyphens only, so languages serve here.
    top = gold.top_candidates(_silver_numbers(spark, sf_dir, "upper(lang)"))
    return tools.search_resumes(top, category=" en ", limit=20)


SQL_CATEGORY = "src1"


@_query
def tool_search_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_layers(spark, "sql_")
    top = gold.top_candidates(_silver_numbers(spark, sf_dir))
    replace_table(top, f"{shared_dir(spark)}/sql-tables", "gold.gold_top_candidates", "sql_")
    return tools.search_table(spark, "sql_gold.gold_top_candidates", SQL_CATEGORY, 20)


@_query
def gold_length_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.by_length(gold.length_vs_leadership(_silver_numbers(spark, sf_dir)))


# Shortlist


def _actions(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("user"), "user_id").alias("recruiter_email"),
        F.concat(F.lit("cv"), "user_id").alias("resume_id"),
        F.get_json_object("props", "$.k").alias("category"),
        F.col("event_type").alias("job_title"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("props")).alias(
            "job_description"
        ),
        F.col("value").cast("string").alias("note"),
        F.col("ts").alias("added_at"),
        F.col("event_id").alias("seq"),
    )


def _upsert_columns(folded: DataFrame) -> DataFrame:
    return folded.select(
        F.col("recruiter_email").alias("recruiter"),
        "job_title",
        "category",
        "job_description",
        "note",
        "added_at",
    )


@_query
def shortlist_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = _actions(_table(spark, sf_dir, "events"))
    return _upsert_columns(shortlist.shortlist(actions))


@_query
def shortlist_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    folder = f"{shared_dir(spark)}/shortlist-{uuid.uuid4().hex}"
    start_shortlist(_actions(events), f"{folder}/rows", f"{folder}/log").awaitTermination()
    return _upsert_columns(read_shortlist(spark, f"{folder}/rows"))


@_query
def shortlist_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream in several batches, whose snapshot is renewed after every second one."""
    folder = f"{shared_dir(spark)}/shortlist-{uuid.uuid4().hex}"
    actions = _actions(_table(spark, sf_dir, "events"))
    actions.repartition(5, "seq").write.parquet(f"{folder}/actions")
    stream = spark.readStream.schema(actions.schema).option("maxFilesPerTrigger", 1)
    start_shortlist(
        stream.parquet(f"{folder}/actions"), f"{folder}/rows", f"{folder}/log", compact_every=2
    ).awaitTermination()
    return _upsert_columns(read_shortlist(spark, f"{folder}/rows"))


@_query
def shortlist_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions through the recorder, compacted while more of them come."""
    log = f"{shared_dir(spark)}/actions-{uuid.uuid4().hex}"
    actions = _actions(_table(spark, sf_dir, "events"))
    last = actions.orderBy(F.desc("seq")).first()
    shortlist.record_actions(actions.filter("seq % 2 = 0 AND seq < {}".format(last["seq"])), log)
    shortlist.compact_actions(spark, log)
    shortlist.record_actions(actions.filter("seq % 2 = 1 AND seq < {}".format(last["seq"])), log)
    shortlist.record_action(
        spark, log, email=last["recruiter_email"], default_actor=DEFAULT_ACTOR,
        **{c: last[c] for c in ("resume_id", "category", "job_title", "job_description", "note", "seq")},
        as_of=last["added_at"],
    )
    shortlist.compact_actions(spark, log)
    return _upsert_columns(shortlist.shortlist(shortlist.read_actions(spark, log)))


@_query
def shortlist_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _actions(_table(spark, sf_dir, "events"))
    untitled = F.when(F.col("job_title") != "error", F.col("job_title"))
    old = events.withColumn("job_title", untitled)
    return shortlist.backfill_titles(old).select("seq", "category", "job_title")


@_query
def shortlist_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    kind = F.col("event_type")
    email = F.when(kind == "click", F.concat("user_id", F.lit("@example.org"))).when(
        kind == "view", ""
    )
    user = F.when(kind.isin("click", "view", "signup"), F.concat(F.lit("id-"), "user_id"))
    user = F.when(kind == "error", "").otherwise(user)
    return events.select("event_id", shortlist.actor(email, user, DEFAULT_ACTOR).alias("added_by"))


@_query
def shortlist_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    actions = customer.select(
        "c_custkey",
        F.when(nation != 0, F.col("c_name")).alias("recruiter_email"),
        F.when(nation == 1, F.repeat("c_name", F.lit(3)))
        .otherwise(F.col("c_name"))
        .alias("resume_id"),
        F.when(nation.isin(2, 3), F.repeat("c_mktsegment", F.lit(12)))
        .otherwise(F.col("c_mktsegment"))
        .alias("category"),
        F.when(nation == 4, F.repeat("c_name", F.lit(15)))
        .when(nation != 5, F.col("c_name"))
        .alias("job_title"),
        F.when(F.col("c_acctbal") >= 0, F.to_timestamp(F.lit(AS_OF))).alias("added_at"),
    )
    return shortlist.rejects(actions).select("c_custkey", "reason")


@_query
def tool_get_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = shortlist.shortlist(_actions(_table(spark, sf_dir, "events")))
    return tools.get_shortlist(folded, job_title="purchase")


# The lake as a whole


def _landed(pages: DataFrame, folder: str, days_ago: int = 0) -> None:
    """Each page as a file of its own, in a folder per topic."""
    spark = pages.sparkSession
    topic = F.concat(F.lit("topic"), F.col("page_id") % 3)
    rows = pages.select(F.coalesce("html", F.lit("")).alias("html"), topic.alias("topic"))
    local = manifest.local_path(spark, folder)
    if local is not None:
        # Spark's writer starts processes for each local file, to set its rights.
        then = time.time() - days_ago * 86_400
        rows.withColumn("html", F.col("html").cast("binary")).foreachPartition(
            landing.file_writer(local, uuid.uuid4().hex, "topic", "html", then if days_ago else None)
        )
        return
    # Tasks move their files to the folder themselves; else the driver does, one by one.
    rows.write.mode("append").partitionBy("topic").option("maxRecordsPerFile", 1).option(
        "mapreduce.fileoutputcommitter.algorithm.version", 2
    ).text(folder)
    if days_ago:
        manifest.age_files(spark, folder, days_ago)


def _ingested(spark: SparkSession, sf_dir: str, archive: bool) -> DataFrame:
    """Pages as Bronze: landed and ingested twice, late and empty files among them."""
    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    files, bronze_path = f"{folder}/files", f"{folder}/bronze"
    moved = f"{folder}/archive" if archive else None
    pages = spread(_table(spark, sf_dir, "pages"), "page_id")

    def run() -> None:
        ingest(
            spark, files, bronze_path, f"{folder}/checkpoint", utf8_text, "pages", "txt", AS_OF,
            archive=moved,
        )

    _landed(pages.filter("page_id % 5 = 0"), files, days_ago=40)
    run()
    _landed(pages.filter("page_id % 5 <> 0"), files)
    manifest.touch(spark, f"{files}/topic=topic9/empty.txt")
    run()
    run()
    rows = read_bronze(spark, bronze_path)
    settings = lake.Settings(source="pages", extension="txt", as_of=AS_OF)
    return lake.with_empty_files(rows, files, settings)


def _page_text() -> Column:
    """The text without the line end that the text sink adds to a page."""
    return F.regexp_replace("raw_text", r"\n\z", "")


@_query
def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ingested(spark, sf_dir, archive=False)
    return rows.select("category", _page_text().alias("raw_text"), "_ingested_at", "_source")


@_query
def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and characters per folder, after runs that move what they have ingested."""
    rows = _ingested(spark, sf_dir, archive=True)
    characters = F.sum(F.length(_page_text())).alias("characters")
    return rows.groupBy("category").agg(F.count("*").alias("files"), characters)


def _rebuilt(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers of the documents, made twice over, as the catalog has them."""
    settings = lake.Settings(
        leadership=LEADERSHIP, seniority=SENIORITY, min_words=MIN_WORDS, as_of=AS_OF,
        database_prefix="rebuilt_", correlation_digits=6,
    )
    create_layers(spark, settings.database_prefix)
    rows = stage(bronze(spark, sf_dir), "bronze")
    for _ in range(2):
        tables = lake.rebuild(rows, f"{shared_dir(spark)}/rebuilt", settings)
    return {name: spark.table(f"rebuilt_{name}") for name in tables}


@_query
def lake_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every layer table."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, rows in _rebuilt(spark, sf_dir).items()
        if not name.startswith("gold.run_")
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out


@_query
def lake_run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a run, one row per number."""
    tables = _rebuilt(spark, sf_dir)
    counts = tables["gold.run_layer_counts"].select(
        F.lit("layer").alias("name"), F.col("layer").alias("of"), F.col("row_count").cast("double").alias("value")
    )
    found = tables["gold.run_length_leadership_corr"].select(
        F.lit("correlation").alias("name"), F.lit("all").alias("of"), F.col("correlation").alias("value")
    )
    check = tables["gold.run_category_check"]
    numbers = [c for c in check.columns if c != "category"]
    pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in numbers))
    per_category = check.select("category", F.inline(pairs)).select(
        "name", F.col("category").alias("of"), "value"
    )
    return counts.unionByName(found).unionByName(per_category)
