"""The same answers in SQL that DuckDB runs over the same tables."""

from __future__ import annotations

from vitaelake.config import (
    EMAIL_PATTERN,
    PHONE_PATTERN,
    QUARANTINE_REASON,
    Lexicon,
)
from vitaelake.plans.queries import (
    AS_OF,
    DEFAULT_ACTOR,
    HASH_BITS,
    HASH_DIMENSIONS,
    HASH_PROBES,
    LEADERSHIP,
    MIN_WORDS,
    QUERY_TEXT,
    SENIORITY,
    SOURCE,
    SQL_CATEGORY,
)

_SPACE = r"[\t\n\x0B\f\r ]+"
_NON_WORD = r"[^\p{L}\p{M}\p{N}_]"


def _rounded(x: str, digits: int) -> str:
    """Half up on the decimal digits, as Spark rounds."""
    return f"round(CAST({x} AS DECIMAL(28, 12)), {digits})::DOUBLE"


def _clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'), ' ')"


def _hits(term: str) -> str:
    # Every non-word character is doubled, so that two neighbouring hits do
    # not compete for the one between them.
    doubled = term.replace(" ", "  ")
    return f"len(regexp_extract_all(doubled, '(^|{_NON_WORD}){doubled}({_NON_WORD}|$)'))"


def _score(lexicon: Lexicon) -> str:
    plus = " + ".join(map(_hits, lexicon.plus))
    minus = " - ".join(map(_hits, lexicon.minus))
    return f"({plus} - {minus})::INTEGER"


def _bronze(folder: str = "source") -> str:
    return f"""
bronze AS (
  SELECT CAST(doc_id AS VARCHAR) AS resume_id, {folder} AS category, text AS raw_text,
         '/landing/' || {folder} || '/' || doc_id || '.pdf' AS file_path,
         TIMESTAMP '{AS_OF}' AS _ingested_at, '{SOURCE}' AS _source
  FROM documents),
normalized AS (
  SELECT *, {_clean("raw_text")} AS clean_text FROM bronze),
counted AS (
  SELECT *, len(string_split(clean_text, ' '))::INTEGER AS word_count FROM normalized),
triaged AS (
  SELECT *, clean_text IS NULL OR clean_text = '' OR word_count < {MIN_WORDS} AS is_unreadable
  FROM counted),
quarantine AS (
  SELECT resume_id, category, file_path, '{QUARANTINE_REASON}' AS reason
  FROM triaged WHERE is_unreadable),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY resume_id ORDER BY _ingested_at, file_path) AS nth
    FROM triaged WHERE NOT is_unreadable) WHERE nth = 1)"""


def _silver(folder: str = "source") -> str:
    return f"""{_bronze(folder)},
bordered AS (
  SELECT *, regexp_replace(lower(clean_text), '({_NON_WORD})', '\\1\\1', 'g') AS doubled
  FROM kept),
scored AS (
  SELECT resume_id, category, clean_text, word_count,
         {_score(LEADERSHIP)} AS leadership_score,
         {_score(SENIORITY)} AS seniority_score,
         regexp_matches(clean_text, '{EMAIL_PATTERN}') AS has_email,
         regexp_matches(clean_text, '{PHONE_PATTERN}') AS has_phone
  FROM bordered),
silver AS (
  SELECT *, has_email AND has_phone AS contact_complete FROM scored)"""


def _top(folder: str = "source") -> str:
    return f"""{_silver(folder)},
top AS (
  SELECT category, resume_id, leadership_score, rank::INTEGER AS rank FROM (
    SELECT *, rank() OVER (PARTITION BY category ORDER BY leadership_score DESC) AS rank
    FROM silver) WHERE rank <= 10)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _share(flag: str) -> str:
    return _rounded(f"avg(CAST({flag} AS INTEGER)) * 100", 1)


_STATS = f"""
  SELECT category, count(*) AS resume_count,
         {_rounded("avg(word_count)", 1)} AS avg_word_count,
         {_rounded("avg(leadership_score)", 2)} AS avg_leadership_score,
         {_rounded("avg(seniority_score)", 2)} AS avg_seniority_score
  FROM silver GROUP BY category"""

_HTML = "html"
for _pattern in (
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
):
    _HTML = f"regexp_replace({_HTML}, '{_pattern}', ' ', 'g')"
for _entity, _character in (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "''"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
):
    _HTML = f"replace({_HTML}, '{_entity}', '{_character}')"

_ACTIONS = """
actions AS (
  SELECT 'user' || user_id AS recruiter_email, 'cv' || user_id AS resume_id,
         json_extract_string(props, '$.k') AS category, event_type AS job_title,
         nullif(CASE WHEN event_type = 'view' THEN '' ELSE props END, '') AS job_description,
         CAST(value AS VARCHAR) AS note, ts AS added_at, event_id AS seq
  FROM events)"""

_FOLDED = f"""{_ACTIONS},
numbered AS (
  SELECT *,
    row_number() OVER (PARTITION BY recruiter_email, resume_id, job_title
                       ORDER BY added_at, seq) AS from_first,
    row_number() OVER (PARTITION BY recruiter_email, resume_id, job_title
                       ORDER BY added_at DESC, seq DESC) AS from_last
  FROM actions),
folded AS (
  SELECT l.recruiter_email, l.resume_id, l.job_title, f.category,
         l.job_description, l.note, l.added_at
  FROM numbered l JOIN numbered f
    ON l.recruiter_email = f.recruiter_email AND l.resume_id = f.resume_id
   AND l.job_title = f.job_title
  WHERE l.from_last = 1 AND f.from_first = 1)"""

_UPSERT = f"""WITH {_FOLDED}
SELECT recruiter_email AS recruiter, job_title, category, job_description, note, added_at
FROM folded"""

_TOKENS = r"""
  SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{M}}\p{{N}}]+')) AS token
  FROM {table}"""

_SCORE = _rounded("(cosine + 1) / 2", 3)

_CENTROIDS = """
entries AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
  FROM embeddings),
means AS (SELECT label, pos, avg(x) AS x FROM entries GROUP BY label, pos),
centroids AS (
  SELECT label::BIGINT AS query_id, list(x ORDER BY pos) AS centroid FROM means GROUP BY label)"""

# The planes by the rule of vectors.hash_planes, the cell of every vector, and the
# cells that each query probes.
_HASHED = f"""{_CENTROIDS},
steps AS (
  SELECT p, d, p * {HASH_DIMENSIONS} + d + 1 AS n
  FROM (SELECT unnest(range({HASH_BITS})) AS p), (SELECT unnest(range({HASH_DIMENSIONS})) AS d)),
planes AS (
  SELECT p, d, (n * 48271 % 2147483647 * 48271 % 2147483647 * 48271 % 2147483647 % 2001 - 1000)::DOUBLE AS w
  FROM steps),
sides AS (
  SELECT vec_id, p, sum(x * w) >= 0 AS upper
  FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d
        FROM embeddings) JOIN planes USING (d) GROUP BY vec_id, p),
placed AS (
  SELECT vec_id, sum(CASE WHEN upper THEN 1 << p ELSE 0 END)::BIGINT AS cell FROM sides GROUP BY vec_id),
distances AS (
  SELECT label::BIGINT AS query_id, p, sum(x * w) AS distance
  FROM means JOIN planes ON d = pos - 1 GROUP BY label, p),
costs AS (
  SELECT query_id, cell, sum(CASE WHEN ((cell >> p) & 1 = 1) = (distance >= 0) THEN 0
                             ELSE abs(distance) END) AS cost
  FROM distances, (SELECT unnest(range(1 << {HASH_BITS})) AS cell) GROUP BY query_id, cell),
probed AS (
  SELECT query_id, cell FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cost, cell) AS nth FROM costs)
  WHERE nth <= {HASH_PROBES}),
pairs AS (
  SELECT query_id, vec_id,
         round(list_cosine_similarity(centroid, CAST(embedding AS DOUBLE[])), 9) AS cosine
  FROM probed JOIN placed USING (cell) JOIN embeddings USING (vec_id) JOIN centroids USING (query_id)),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY cosine DESC, vec_id)::INTEGER AS rank FROM pairs)"""

_DOCS = f"""
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS resume_id, source AS category, {_clean("text")} AS clean_text
  FROM documents WHERE regexp_matches(text, '[^\\t\\n\\x0B\\f\\r ]')),
tokens AS ({_TOKENS.format(key="resume_id", text="clean_text", table="docs")}),
terms AS (SELECT resume_id, token, count(*) AS tf FROM tokens GROUP BY resume_id, token),
vocabulary AS (SELECT token, count(*) AS df FROM terms GROUP BY token),
total AS (SELECT count(*) AS n FROM docs)"""


def _refreshed_vectors() -> str:
    bins = "(31 * unicode(w) + length(w)) % 8"
    counts = " || ',' || ".join(f"len(list_filter(ws, lambda w: {bins} = {i}))" for i in range(8))
    return f"""
SELECT CAST(doc_id AS VARCHAR) AS resume_id, {counts} AS embedding
FROM (SELECT *, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS ws FROM documents)
WHERE source <> 'src0' OR lang = 'es'"""


def _run_checks(silver: str) -> str:
    numbers = ("resume_count", "avg_word_count", "avg_leadership_score", "avg_seniority_score")
    rows = "".join(
        f"""
UNION ALL SELECT '{c}', category, {c}::DOUBLE FROM ({_STATS})""" for c in numbers
    )
    return _with(
        silver,
        f"""SELECT 'layer' AS name, 'bronze' AS of, count(*)::DOUBLE AS value FROM bronze
UNION ALL SELECT 'layer', 'quarantine', count(*) FROM quarantine
UNION ALL SELECT 'layer', 'silver', count(*) FROM kept
UNION ALL SELECT 'layer', 'duplicates', (SELECT count(*) FROM triaged WHERE NOT is_unreadable)
                                      - (SELECT count(*) FROM kept)
UNION ALL SELECT 'correlation', 'all', CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END
  FROM (SELECT corr(word_count, leadership_score) AS r FROM silver)
UNION ALL SELECT 'pct_contact_complete', category, {_share("contact_complete")}
  FROM silver GROUP BY category{rows}""",
    )


def oracle_sql() -> dict[str, str]:
    bronze, silver, top = _bronze(), _silver(), _top()
    by_length = _with(
        silver,
        f"""SELECT category,
   CASE tercile WHEN 1 THEN 'short' WHEN 2 THEN 'medium' ELSE 'long' END AS length_bucket,
   count(*) AS resume_count,
   {_rounded("avg(word_count)", 1)} AS avg_word_count,
   {_rounded("avg(leadership_score)", 2)} AS avg_leadership_score
FROM (SELECT *, ntile(3) OVER (
    PARTITION BY category ORDER BY word_count, resume_id) AS tercile FROM silver)
GROUP BY category, tercile""",
    )
    return {
        "bronze_path_fields": _with(bronze, "SELECT file_path, resume_id, category FROM bronze"),
        "bronze_rows": _with(bronze, "SELECT * FROM bronze"),
        "bronze_category_counts": _with(
            bronze, "SELECT category, count(*) AS resume_count FROM bronze GROUP BY category"
        ),
        "extract_html_text": f"SELECT page_id, {_clean(_HTML)} AS raw_text FROM pages",
        "extract_bytes_text": "SELECT page_id, html AS raw_text FROM pages",
        "silver_normalized": _with(bronze, "SELECT resume_id, clean_text FROM normalized"),
        "silver_quarantine": _with(bronze, "SELECT * FROM quarantine"),
        "silver_dedup": """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth
  FROM conversations) WHERE nth = 1""",
        "silver_dedup_content": f"""
SELECT CAST(doc_id AS VARCHAR) AS resume_id, source AS category FROM (
  SELECT *, row_number() OVER (
    PARTITION BY md5({_clean("text")}) ORDER BY doc_id) AS nth
  FROM documents) WHERE nth = 1""",
        "silver_enriched": _with(silver, "SELECT * FROM silver"),
        "silver_category_check": _with(
            silver,
            f"""SELECT s.*, p.pct_contact_complete FROM ({_STATS}) s JOIN (
  SELECT category, {_share("contact_complete")} AS pct_contact_complete
  FROM silver GROUP BY category) p USING (category)""",
        ),
        "layer_counts": _with(
            bronze,
            """SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze
UNION ALL SELECT 'quarantine', count(*) FROM quarantine
UNION ALL SELECT 'silver', count(*) FROM kept
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM triaged WHERE NOT is_unreadable)
                             - (SELECT count(*) FROM kept)""",
        ),
        "gold_category_stats": _with(silver, _STATS),
        "gold_top_candidates": _with(top, "SELECT * FROM top"),
        "gold_contact_quality": _with(
            silver,
            f"""SELECT category, count(*) AS resume_count,
       {_share("has_email")} AS pct_with_email,
       {_share("has_phone")} AS pct_with_phone,
       {_share("contact_complete")} AS pct_contact_complete
FROM silver GROUP BY category""",
        ),
        "gold_length_vs_leadership": by_length,
        "gold_length_sorted": by_length,
        "length_leadership_corr": _with(
            silver,
            """SELECT CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS correlation
FROM (SELECT corr(word_count, leadership_score) AS r FROM silver)""",
        ),
        "gold_category_health": _with(
            bronze,
            f"""SELECT category, ingested_count, silver_count, quarantine_count,
       {_rounded("quarantine_count / ingested_count * 100", 1)} AS quarantine_rate_pct
FROM (SELECT b.category, b.n AS ingested_count, coalesce(k.n, 0) AS silver_count,
             coalesce(q.n, 0) AS quarantine_count
      FROM (SELECT category, count(*) AS n FROM bronze GROUP BY category) b
      LEFT JOIN (SELECT category, count(*) AS n FROM kept GROUP BY category) k USING (category)
      LEFT JOIN (SELECT category, count(*) AS n FROM quarantine GROUP BY category) q
        USING (category))""",
        ),
        "match_vectors": f"""
WITH entries AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
  FROM embeddings),
means AS (SELECT label, pos, avg(x) AS x FROM entries GROUP BY label, pos),
centroids AS (
  SELECT label::BIGINT AS query_id, list(x ORDER BY pos) AS centroid FROM means GROUP BY label),
pairs AS (
  SELECT query_id, vec_id,
         round(list_cosine_similarity(centroid, CAST(embedding AS DOUBLE[])), 9) AS cosine
  FROM centroids CROSS JOIN embeddings),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY cosine DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, vec_id, {_SCORE} AS match_score, rank FROM ranked WHERE rank <= 10""",
        "match_vectors_all": f"""
WITH pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(
    CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 9) AS cosine
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY cosine DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, vec_id, {_SCORE} AS match_score, rank FROM ranked WHERE rank <= 10""",
        "match_vectors_hashed": _with(
            _HASHED,
            f"SELECT query_id, vec_id, {_SCORE} AS match_score, rank FROM ranked WHERE rank <= 10",
        ),
        "match_vectors_recall": _with(
            f"""{_HASHED},
every AS (
  SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY round(
    list_cosine_similarity(centroid, CAST(embedding AS DOUBLE[])), 9) DESC, vec_id) AS nth
  FROM centroids CROSS JOIN embeddings),
right_ones AS (
  SELECT query_id, count(*) AS found FROM every JOIN ranked USING (query_id, vec_id)
  WHERE nth <= 10 AND rank <= 10 GROUP BY query_id),
compared AS (SELECT query_id, count(*) AS pairs FROM pairs GROUP BY query_id)""",
            """SELECT query_id, pairs, coalesce(found, 0) AS found,
       (SELECT count(*) FROM embeddings) AS vectors
FROM compared LEFT JOIN right_ones USING (query_id)""",
        ),
        "vectors_refreshed": _refreshed_vectors(),
        "text_index_terms": _with(
            _DOCS,
            """SELECT token, df, tf FROM vocabulary
JOIN (SELECT token, sum(tf)::BIGINT AS tf FROM terms GROUP BY token) USING (token)""",
        ),
        "text_index_refreshed": _with(
            _DOCS,
            """SELECT resume_id, terms, words, norm FROM docs LEFT JOIN (
  SELECT resume_id, count(*) AS terms, sum(tf)::BIGINT AS words,
         round(sqrt(sum((tf * (1 + ln((1 + n) / (1 + df)))) ** 2)), 6) AS norm
  FROM terms JOIN vocabulary USING (token) CROSS JOIN total GROUP BY resume_id) USING (resume_id)""",
        ),
        "tool_search_sql": _with(
            top,
            f"SELECT * FROM top WHERE category = '{SQL_CATEGORY}' ORDER BY rank, resume_id LIMIT 20",
        ),
        "shortlist_compacted": _UPSERT,
        "shortlist_recorded": _UPSERT,
        "ingest_files": f"""
SELECT 'topic=topic' || (page_id % 3) AS category, html AS raw_text,
       TIMESTAMP '{AS_OF}' AS _ingested_at, 'pages' AS _source FROM pages
UNION ALL SELECT 'topic=topic9', NULL, TIMESTAMP '{AS_OF}', 'pages'""",
        "ingest_rerun": """
SELECT 'topic=topic' || (page_id % 3) AS category, count(*) AS files,
       sum(length(html))::BIGINT AS characters FROM pages GROUP BY ALL
UNION ALL SELECT 'topic=topic9', 1, NULL""",
        "lake_rebuild": _with(
            top,
            """SELECT 'silver.silver_resumes' AS name, count(*) AS row_count FROM silver
UNION ALL SELECT 'silver.silver_resumes_quarantine', count(*) FROM quarantine
UNION ALL SELECT 'gold.gold_category_stats', count(DISTINCT category) FROM silver
UNION ALL SELECT 'gold.gold_contact_quality', count(DISTINCT category) FROM silver
UNION ALL SELECT 'gold.gold_top_candidates', count(*) FROM top
UNION ALL SELECT 'gold.gold_category_health', count(DISTINCT category) FROM bronze
UNION ALL SELECT 'gold.gold_length_vs_leadership', count(*) FROM (
  SELECT DISTINCT category, ntile(3) OVER (PARTITION BY category ORDER BY word_count, resume_id)
  FROM silver)""",
        ),
        "lake_run_checks": _run_checks(silver),
        "vector_changes": """
WITH now AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE source <> 'src0'),
past AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'de' THEN upper(text) ELSE text END AS text
  FROM documents WHERE lang <> 'es'),
compared AS (
  SELECT coalesce(now.id, past.id) AS resume_id,
         CASE WHEN past.id IS NULL THEN 'new' WHEN now.id IS NULL THEN 'removed'
              WHEN now.text <> past.text THEN 'changed' END AS action
  FROM now FULL JOIN past ON now.id = past.id)
SELECT * FROM compared WHERE action IS NOT NULL""",
        "tool_match_text": f"""
WITH docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS resume_id, source AS category, {_clean("text")} AS clean_text
  FROM documents WHERE regexp_matches(text, '[^\\t\\n\\x0B\\f\\r ]')),
tokens AS ({_TOKENS.format(key="resume_id", text="clean_text", table="docs")}),
terms AS (SELECT resume_id, token, count(*) AS tf FROM tokens GROUP BY resume_id, token),
vocabulary AS (SELECT token, count(*) AS df FROM terms GROUP BY token),
total AS (SELECT count(*) AS n FROM docs),
asked_tokens AS ({_TOKENS.format(key="1 AS one", text="q", table=f"(SELECT '{QUERY_TEXT}' AS q)")}),
asked AS (SELECT token, count(*) AS tf FROM asked_tokens GROUP BY token),
asked_weights AS (
  SELECT a.token, a.tf * (1 + ln((1 + n) / (1 + coalesce(df, 0)))) AS w
  FROM asked a LEFT JOIN vocabulary v ON a.token = v.token CROSS JOIN total),
weights AS (
  SELECT resume_id, t.token, tf * (1 + ln((1 + n) / (1 + df))) AS w
  FROM terms t JOIN vocabulary v ON t.token = v.token CROSS JOIN total),
scored AS (
  SELECT resume_id, sum(d.w * a.w) AS dot, sqrt(sum(d.w * d.w)) AS norm
  FROM weights d LEFT JOIN asked_weights a ON d.token = a.token GROUP BY resume_id),
best AS (
  SELECT resume_id, round(dot / (norm * (SELECT sqrt(sum(w * w)) FROM asked_weights)), 9) AS cosine
  FROM scored WHERE dot > 0 ORDER BY cosine DESC, resume_id LIMIT 10)
SELECT resume_id, category, {_SCORE} AS match_score,
       substring(clean_text, 1, 200) AS snippet
FROM best JOIN docs USING (resume_id)""",
        "tool_category_stats": _with(
            silver,
            f"""SELECT category, resume_count, avg_word_count, avg_leadership_score
FROM ({_STATS}) ORDER BY avg_leadership_score DESC, category""",
        ),
        "tool_search_resumes": _with(
            top, "SELECT * FROM top ORDER BY category, rank, resume_id LIMIT 20"
        ),
        "tool_search_category": _with(
            _top("upper(lang)"),
            "SELECT * FROM top WHERE category = 'EN' ORDER BY category, rank, resume_id LIMIT 20",
        ),
        "shortlist_upsert": _UPSERT,
        "shortlist_stream": _UPSERT,
        "shortlist_backfill": f"""WITH {_ACTIONS}
SELECT seq, category, coalesce(nullif(job_title, 'error'), category) AS job_title FROM actions""",
        "shortlist_actor": f"""
SELECT event_id, CASE event_type WHEN 'click' THEN user_id || '@example.org'
         WHEN 'view' THEN 'id-' || user_id WHEN 'signup' THEN 'id-' || user_id
         ELSE '{DEFAULT_ACTOR}' END AS added_by
FROM events""",
        "shortlist_rejects": """
SELECT c_custkey, reason FROM (
  SELECT c_custkey, CASE
    WHEN c_nationkey = 0 THEN 'recruiter_email is null'
    WHEN c_nationkey = 5 THEN 'job_title is null'
    WHEN c_acctbal < 0 OR c_acctbal IS NULL THEN 'added_at is null'
    WHEN c_nationkey = 1 AND 3 * length(c_name) > 50 THEN 'resume_id is longer than 50'
    WHEN c_nationkey IN (2, 3) AND 12 * length(c_mktsegment) > 100
      THEN 'category is longer than 100'
    WHEN c_nationkey = 4 AND 15 * length(c_name) > 255 THEN 'job_title is longer than 255'
    END AS reason FROM customer) WHERE reason IS NOT NULL""",
        "tool_get_shortlist": f"""WITH {_FOLDED}
SELECT resume_id, category, job_title, job_description, note,
       recruiter_email AS added_by, added_at
FROM folded WHERE job_title = 'purchase'
ORDER BY added_at DESC, added_by, resume_id, job_title LIMIT 100""",
    }
