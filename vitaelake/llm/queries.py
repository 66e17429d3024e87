"""The operators over the driver's tables, each with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.llm import (
    decontamination,
    lexical_search,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    phrases,
    pii,
    quality_gam,
    quality_rules,
    repeats,
    sharding,
    url_filters,
)
from vitaelake.llm.tables import fold, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (fold(F.col("doc_id")) == 1).alias("held_out")
    )
    model = lm_scoring.fit(docs.filter("NOT held_out"))
    scored = lm_scoring.score(docs, model, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


URL_RULES = (
    url_filters.Rule("org", "/", "allow"),
    url_filters.Rule("example.org", "/es/", "block"),
    url_filters.Rule("example.org", "/en/1", "block"),
    url_filters.Rule("com", "/fr/", "allow"),
    url_filters.Rule("com", "/de/", "block"),
)


@_query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


_HOST_PATH = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (
  SELECT *, host = 'org' OR ends_with(host, '.org') AS org,
    host = 'example.org' OR ends_with(host, '.example.org') AS example,
    host = 'com' OR ends_with(host, '.com') AS com FROM parts),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN example AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN example AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule FROM judged)
"""
ORACLE_SQL["op3_url_filters"] = _HOST_PATH + r"""
SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host || path, '^(?s:[^/]*/.*/wp-login\.php|[^/]*/wp-login\.php|[^/]*/wp-admin/.*'
    || '|[^/]*/cgi-bin/.*|[^/]*/login|[^/]*/logout|[^/]*/.*/cart/checkout.*|[^/]*/.*\.exe|[^/]*/.*\.zip'
    || '|ads\.[^/]*/.*|[^/]*\.doubleclick\.[^/]*/.*)$') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


def _sha256(names: Column) -> Column:
    return F.sha2(F.array_join(names, ","), 256)


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.search(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontamination.n_hit(F.col("hit_spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        _sha256(F.col("items")).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


ORACLE_SQL["op5_decontamination"] = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    for i in range(1, len(w) - least(len(w), 10) + 2)]) AS g FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM lowered, sizes WHERE len(w) >= k),
hits AS (
  SELECT d.r, d.i, d.k, t.item_id FROM doc_windows d
  JOIN item_windows t ON t.k = d.k AND t.g = array_to_string(d.w[d.i:d.i + d.k - 1], ' ')),
hit_words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items t USING (r)
"""


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    judged = quality_rules.judge(docs, trusted)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "llr",
    )


@_query
def op8_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, settings=near_dedup.Settings(shingle_words=2))


ORACLE_SQL["op8_setsketch_dedup"] = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS s FROM lowered),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION
  SELECT r.a, edges.b FROM reached r JOIN edges ON r.b = edges.a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) c ON c.a = s.doc_id
"""


@_query
def op9_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = sharding.assign(table(spark, sf_dir, "documents"))
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan(table(spark, sf_dir, "documents"))
    return mixing.taken(mix).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


PREDICTED_FROM = 0.3


@_query
def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = quality_gam.feature_table(table(spark, sf_dir, "documents"))
    held_out = fold(F.col("id")) == 0
    labels = table(spark, sf_dir, "labels")
    model = quality_gam.train(featured.filter(~held_out), labels, "doc_id", "quality")
    return quality_gam.score(featured, model).select(
        F.col("id").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))

    def joined(spans: str) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
        return F.array_join(texts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


@_query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, k=10)


ORACLE_SQL["op11_lexical_search"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM doc_words WHERE len(w) > 0),
sized AS (
  SELECT doc_id, w, 10 + (90 * len(w)::BIGINT * docs) // terms AS m FROM doc_words, total WHERE len(w) > 0),
held AS (
  SELECT doc_id, m, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, m, unnest(w) AS term FROM sized)
  WHERE term IN (SELECT term FROM item_words) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM held, total GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item_words JOIN held USING (term) JOIN weights USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
    doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


@_query
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]
    )
    return found.select(
        "row.doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
word_lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word_lists GROUP BY lang),
runs AS (
  SELECT lang, unnest([w[i:i + m - 1] for i in range(1, len(w) - m + 2)]) AS p
  FROM word_lists, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
counts AS (SELECT lang, p, count(*)::HUGEINT AS f FROM runs GROUP BY lang, p HAVING count(*) >= 30),
candidates AS (SELECT lang, p, f AS a FROM counts WHERE len(p) > 1),
inside AS (
  SELECT lang, unnest(list_concat([p[i:i + 1] for i in range(1, len(p))],
    CASE WHEN len(p) = 4 THEN [p[1:3], p[2:4]] ELSE [] END)) AS p, a FROM candidates WHERE len(p) > 2),
longest AS (SELECT lang, p, max(a) AS longer FROM inside GROUP BY lang, p),
kept AS (
  SELECT lang, p, a FROM candidates LEFT JOIN longest USING (lang, p)
  WHERE longer IS NULL OR 100 * longer < 80 * a),
cuts AS (SELECT *, unnest(range(1, len(p))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, (2000000 * c.a) // (x.f + y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:k]
  JOIN counts y ON y.lang = c.lang AND y.p = c.p[k + 1:]),
lowest AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
