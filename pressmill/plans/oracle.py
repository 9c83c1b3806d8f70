"""The registered queries in plain SQL, for a second engine to check."""

from __future__ import annotations

from pressmill.functions.language import FUNCTION_WORDS
from pressmill.operators.answers import NO_ANSWER, SEPARATOR, STUB_BANNER, SYSTEM_PROMPT

DIM = 64


def _text(value: str) -> str:
    """A string literal; line breaks and quotes as chr() keep it one line."""
    return "'" + value.replace("'", "''").replace("\n", "'||chr(10)||'") + "'"


def _uuid(url: str, index: str) -> str:
    h = f"sha1({url} || '#' || {index})"
    parts = [(1, 8), (9, 12), (13, 16), (17, 20), (21, 32)]
    return " || '-' || ".join(f"{h}[{a}:{b}]" for a, b in parts)


def _collapse(text: str) -> str:
    return rf"nullif(trim(regexp_replace({text}, '\s+', ' ', 'g')), '')"


def _unescape(text: str) -> str:
    """The references that occur in the pages; the ampersand comes last."""
    for entity, char in (("&copy;", 169), ("&middot;", 183), ("&quot;", 34), ("&lt;", 60), ("&gt;", 62), ("&amp;", 38)):
        text = f"replace({text}, '{entity}', chr({char}))"
    return text


def _no_script(html: str) -> str:
    for pattern in ("<script[^>]*>.*?</script>", "<style[^>]*>.*?</style>", "<!--.*?-->"):
        html = f"regexp_replace({html}, '(?is){pattern}', ' ', 'g')"
    return html


def _no_tags(html: str) -> str:
    return f"regexp_replace({html}, '(?is)<[a-z/!][^>]*>', ' ', 'g')"


ITEMS = rf"""items AS (
  SELECT doc_id, source AS source_id, 'https://docs.example/' || doc_id AS url, 'Document ' || doc_id AS title,
         {_collapse('text')} AS content, lang AS language,
         array_to_string(list_sort(list_distinct(['doc', lower(lang), 'doc'])), ',') AS tags
  FROM documents)"""

PAGE_ITEMS = rf"""visible AS (SELECT url, {_no_script('html')} AS h FROM pages),
scoped AS (
  SELECT url, h, coalesce(nullif(regexp_extract(h, '(?is)<article\b[^>]*>(.*?)(?:</article>|$)', 1), ''), h) AS a
  FROM visible),
cut AS (
  SELECT url, h, list_transform(
      string_split(regexp_replace(regexp_replace(a, '(?i)<p\b[^>]*>', chr(1), 'g'), '(?i)</p>', chr(2), 'g'), chr(1))[2:],
      lambda p: split_part(p, chr(2), 1)) AS ps
  FROM scoped),
items AS (
  SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS source_id, url,
         {_collapse(_unescape(_no_tags("regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)")))} AS title,
         {_collapse(_unescape(_no_tags("array_to_string(ps, ' ')")))} AS content,
         NULL::VARCHAR AS language, 'web' AS tags
  FROM cut)"""


def chunks(limit: int, overlap: int, items: str = "items", name: str = "chunks") -> str:
    """Greedy packing as a recursion over sentences."""
    return rf"""{name}_s AS (
  SELECT *, string_split(regexp_replace(content, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS ss
  FROM {items} WHERE content IS NOT NULL),
{name}_p AS (
  SELECT url, ss, list_transform(ss, lambda s: len(list_filter(string_split_regex(s, '\s+'), lambda w: w <> ''))) AS ns
  FROM {name}_s),
{name}_w AS (
  SELECT url, 1 AS i, 0 AS idx, 1 AS lo, 0 AS hi, 0::BIGINT AS l FROM {name}_p
  UNION ALL
  SELECT st.url, i + 1, idx + CAST(hi >= lo AND l + p.ns[i] > {limit} AS INT),
    CASE WHEN hi >= lo AND l + p.ns[i] > {limit} THEN t.lo2 ELSE lo END, i,
    CASE WHEN hi >= lo AND l + p.ns[i] > {limit} THEN coalesce(list_sum(p.ns[t.lo2:i]), 0)::BIGINT ELSE l + p.ns[i] END
  FROM {name}_w st JOIN {name}_p p USING (url),
    LATERAL (SELECT coalesce(min(j), i) AS lo2 FROM (SELECT unnest(range(lo, i)) AS j)
             WHERE coalesce(list_sum(p.ns[j:i - 1]), 0) <= {overlap}) t
  WHERE i <= len(ss)),
{name}_t AS (
  SELECT url, idx, array_to_string(any_value(ss)[min(lo):max(hi)], ' ') AS chunk_text
  FROM (SELECT * FROM {name}_w WHERE hi > 0) JOIN {name}_p USING (url) GROUP BY url, idx),
{name} AS (
  SELECT {_uuid('c.url', 'c.idx')} AS chunk_id, c.url, s.title, c.chunk_text, c.idx::INT AS chunk_index,
         (count(*) OVER (PARTITION BY c.url))::INT AS total_chunks, s.language, s.source_id, s.tags
  FROM {name}_t c JOIN {name}_s s USING (url))"""


CHUNK_COLUMNS = "chunk_id, url, title, chunk_text, chunk_index, total_chunks, language, source_id"
SMALL_CHUNKS = f"{ITEMS}, {chunks(64, 16)}"


def vectors(table: str, key: str, text: str, name: str) -> str:
    """Signed word hashing, unit length, kept as 32-bit floats."""
    return rf"""{name}_h AS (
  SELECT {key} AS k, md5(w) AS h
  FROM (SELECT {key}, unnest(string_split_regex(lower({text}), '\s+')) AS w FROM {table}) WHERE w <> ''),
{name}_b AS (
  SELECT k, CAST('0x' || h[1:8] AS BIGINT) % {DIM} AS b,
         sum(CASE WHEN CAST('0x' || h[9:9] AS BIGINT) < 8 THEN 1.0 ELSE -1.0 END)::DOUBLE AS s
  FROM {name}_h GROUP BY 1, 2),
{name}_n AS (SELECT k, sqrt(sum(s * s)) AS n FROM {name}_b GROUP BY k),
{name}_d AS (
  SELECT x.k, g.b, coalesce(CAST(v.s / x.n AS FLOAT)::DOUBLE, 0.0) AS w
  FROM {name}_n x, (SELECT unnest(range({DIM})) AS b) g LEFT JOIN {name}_b v ON v.k = x.k AND v.b = g.b
  WHERE x.n > 0),
{name} AS (SELECT k, list(w ORDER BY b) AS e FROM {name}_d GROUP BY k)"""


def ranked(questions: str, stored: str, k: str, threshold: float | None = None) -> str:
    """Exact top-k; scores equal to nine decimals tie and go by id."""
    cosine = "list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e)))"
    keep = "" if threshold is None else f"WHERE score >= {threshold}"
    return f"""scored AS (
  SELECT q.k AS question_id, q.top_k, v.k AS chunk_id, round({cosine}, 9) AS score
  FROM (SELECT *, {k} AS top_k FROM {questions}) q, {stored} v),
hits AS (
  SELECT question_id, chunk_id, score, rank FROM (
    SELECT *, (row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id))::INT AS rank
    FROM scored {keep}) WHERE rank <= top_k)"""


BENCHMARK = "asked AS (SELECT item_id AS question_id, text FROM benchmark)"
TURNS = "asked AS (SELECT conv_id * 1000 + turn AS question_id, text FROM conversations WHERE role = 'user')"


def retrieval(asked: str, k: int, threshold: float | None = None, where: str | None = None) -> str:
    stored = f"stored AS (SELECT * FROM chunks{f' WHERE {where}' if where else ''})"
    return ",\n".join([
        SMALL_CHUNKS, asked, stored,
        vectors("asked", "question_id", "text", "qv"),
        vectors("stored", "chunk_id", "chunk_text", "cv"),
        ranked("qv", "cv", str(k), threshold),
        "found AS (SELECT h.question_id, h.rank, c.chunk_id, c.url, c.title, c.chunk_text, h.score "
        "FROM hits h JOIN chunks c USING (chunk_id))",
    ])


CENTROIDS = """means AS (
  SELECT label, i, avg(w::DOUBLE) AS w
  FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding) AS w FROM embeddings) GROUP BY label, i),
qv AS (SELECT label::BIGINT AS k, list(w ORDER BY i) AS e FROM means GROUP BY label),
cv AS (SELECT vec_id AS k, embedding::DOUBLE[] AS e FROM embeddings)"""

_DOCS = rf"""string_agg('[' || rank || '] ' || coalesce(nullif(title, ''), 'Untitled') || chr(10) || 'URL: ' || url
  || chr(10) || chunk_text, {_text(SEPARATOR)} ORDER BY rank) AS context,
  string_agg(url, ' ' ORDER BY rank) AS sources"""


def answered(asked: str, k: int, threshold: float | None = None, where: str | None = None) -> str:
    return rf"""WITH RECURSIVE {retrieval(asked, k, threshold, where)},
blocks AS (SELECT question_id, {_DOCS} FROM found GROUP BY question_id)
SELECT a.question_id, coalesce({_text(STUB_BANNER)} || chr(10) || chr(10) || 'Context:' || chr(10) || b.context
  || chr(10) || chr(10) || 'Question: ' || a.text, {_text(NO_ANSWER)}) AS answer, coalesce(b.sources, '') AS sources
FROM asked a LEFT JOIN blocks b USING (question_id)"""


_LANG_WORDS = r"string_split_regex(lower(text), '[\s\p{P}\p{S}]+')"


def _hits_of(lang: str) -> str:
    known = ", ".join(f"'{w}'" for w in FUNCTION_WORDS[lang])
    return f"len(list_filter(ws, lambda w: list_contains([{known}], w)))::INT AS hits_{lang}"


LANGUAGE = f"""ws AS (SELECT doc_id, lang, {_LANG_WORDS} AS ws FROM documents),
scores AS (SELECT doc_id, lang, {', '.join(_hits_of(lang) for lang in FUNCTION_WORDS)} FROM ws),
best AS (
  SELECT *, greatest({', '.join(f'hits_{lang}' for lang in FUNCTION_WORDS)}) AS top FROM scores),
found AS (
  SELECT doc_id, lang AS labelled, CASE WHEN top = 0 THEN NULL {
      ' '.join(f"WHEN hits_{lang} = top THEN '{lang}'" for lang in sorted(FUNCTION_WORDS))} END AS language
  FROM best)"""

_KEYS = (
    "['source_id','url','title','summary','content','author','published_at','language','tags','fetched_at']"
)
RECORDS = rf"""doc AS (SELECT *, 'https://docs.example/' || doc_id AS url FROM documents),
records AS (
  SELECT to_json({{source_id: source, url: url, title: 'Document  ' || doc_id || ' ', summary: NULL, content: text,
      author: NULL, published_at: NULL, language: lang, tags: ['Doc', upper(lang), 'doc'], fetched_at: 0}})::VARCHAR AS value
    FROM doc
  UNION ALL SELECT text FROM documents
  UNION ALL SELECT '[' || doc_id || ']' FROM documents
  UNION ALL SELECT to_json({{url: url}})::VARCHAR FROM doc
  UNION ALL SELECT to_json({{source_id: source, url: url, published_at: lang}})::VARCHAR FROM doc
  UNION ALL SELECT to_json({{source_id: source, url: NULL}})::VARCHAR FROM doc
  UNION ALL SELECT to_json({{source_id: source, url: url, content: '<b> </b>'}})::VARCHAR FROM doc
  UNION ALL SELECT props FROM events
  UNION ALL SELECT NULL FROM labels),
typed AS (SELECT value, CASE WHEN json_valid(value) THEN value END AS j FROM records),
judged AS (
  SELECT value, j, CASE
    WHEN value IS NULL THEN 'null_value'
    WHEN j IS NULL THEN 'invalid_json'
    WHEN json_type(j) <> 'OBJECT' THEN 'not_object'
    WHEN len(list_filter(json_keys(j), lambda k: NOT list_contains({_KEYS}, k))) > 0 THEN 'unknown_key'
    WHEN NOT (list_contains(json_keys(j), 'url') AND list_contains(json_keys(j), 'source_id')) THEN 'missing_key'
    WHEN json_type(j, '$.published_at') NOT IN ('UBIGINT', 'BIGINT', 'NULL') THEN 'bad_type'
    WHEN json_type(j, '$.url') = 'NULL' OR json_type(j, '$.tags') = 'NULL' THEN 'normalize_failed'
  END AS reason FROM typed)"""

_LINES = r"""lines AS (
  SELECT doc_id, source, lang, unnest(range(len(ls))) AS i, unnest(ls) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"""

_TRIMMED = r"nullif(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '')"

LOADS = rf"""{ITEMS}, {chunks(64, 16, name='first')},
reviewed AS (
  SELECT i.source_id, i.url, i.title, 'Quality ' || l.quality || '. Toxic ' || l.toxic || '.' AS grade, i.language, i.tags,
         i.content FROM items i JOIN labels l USING (doc_id)),
older_i AS (SELECT source_id, url, title, grade || ' ' || content AS content, language, tags FROM reviewed),
newer_i AS (SELECT source_id, url, title, grade AS content, language, tags FROM reviewed),
{chunks(64, 16, 'older_i', 'older')}, {chunks(64, 16, 'newer_i', 'newer')},
loads AS (
  SELECT *, 0 AS v FROM first UNION ALL SELECT *, 1 FROM older UNION ALL SELECT *, 2 FROM newer),
latest AS (SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY v DESC) = 1)"""

_LATEST = f"WITH RECURSIVE {LOADS} SELECT {CHUNK_COLUMNS} FROM latest"
_HITS = "question_id, rank, chunk_id, url, title, chunk_text, round(score, 6) AS score"
_IDS = "SELECT question_id, rank, chunk_id, round(score, 6) AS score FROM hits"

ORACLE: dict[str, str] = {
    "normalize_documents": f"WITH {ITEMS} SELECT source_id, url, title, content, language, tags FROM items",
    "clean_pages": f"WITH {PAGE_ITEMS} SELECT source_id, url, title, content, tags FROM items",
    "page_text": f"SELECT page_id, {_collapse(_unescape(_no_tags(_no_script('html'))))} AS text FROM pages",
    "dedup_url": f"""WITH {ITEMS}, keyed AS (
  SELECT 'https://docs.example/' || md5(d.text) AS url, i.title, i.source_id, i.content, i.doc_id AS fetched_at
  FROM items i JOIN documents d USING (doc_id))
SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY url ORDER BY fetched_at) = 1""",
    "language_hits": f"WITH {LANGUAGE} SELECT doc_id, {', '.join(f'hits_{lang}' for lang in FUNCTION_WORDS)} FROM scores",
    "language_detected": f"WITH {LANGUAGE} SELECT * FROM found",
    "language_filter": f"WITH {LANGUAGE} SELECT doc_id, language FROM found WHERE language IN ('es', 'fr', 'de')",
    "validate_rejects": f"""WITH {RECORDS}
SELECT CASE WHEN length(value) > 200 THEN value[1:200] || '...' ELSE value END AS value_sample, reason
FROM judged WHERE reason IS NOT NULL""",
    "validate_accepted": f"""WITH {RECORDS}
SELECT j->>'$.source_id' AS source_id, j->>'$.url' AS url, j->>'$.title' AS title, j->>'$.content' AS content,
  j->>'$.summary' AS summary, j->>'$.author' AS author, (j->>'$.published_at')::BIGINT AS published_at, j->>'$.language' AS language,
  coalesce(array_to_string(CAST(j->'$.tags' AS VARCHAR[]), ','), '') AS tags,
  coalesce((j->>'$.fetched_at')::BIGINT, 0) AS fetched_at
FROM judged WHERE reason IS NULL""",
    "record_roundtrip": """SELECT 'https://docs.example/' || doc_id AS key, source AS source_id,
  'https://docs.example/' || doc_id AS url, 'Document  ' || doc_id || ' ' AS title, text AS content, lang AS language,
  'Doc,' || upper(lang) || ',doc' AS tags, 0::BIGINT AS fetched_at FROM documents""",
    "records_from_files": """SELECT 'https://docs.example/' || doc_id AS key, source AS source_id,
  'https://docs.example/' || doc_id AS url, 'Document  ' || doc_id || ' ' AS title, text AS content, lang AS language,
  'Doc,' || upper(lang) || ',doc' AS tags, 0::BIGINT AS fetched_at FROM documents""",
    "records_from_stream": """SELECT 'https://docs.example/' || doc_id AS key, source AS source_id,
  'https://docs.example/' || doc_id AS url, 'Document  ' || doc_id || ' ' AS title, text AS content, lang AS language,
  'Doc,' || upper(lang) || ',doc' AS tags, 0::BIGINT AS fetched_at FROM documents""",
    "outcome_counts": f"""WITH {RECORDS} SELECT CASE
    WHEN reason IN ('null_value', 'invalid_json') THEN 'schema_invalid'
    WHEN reason = 'normalize_failed' THEN reason
    WHEN reason IS NOT NULL THEN 'decode_failed'
    WHEN {_collapse(_no_tags("coalesce(j->>'$.title', '') || coalesce(j->>'$.content', '')"))} IS NULL
    THEN 'normalized_dropped' ELSE 'ingested' END AS stage, count(*) AS records
FROM judged GROUP BY 1""",
    "source_counts": "SELECT source AS source_id, count(*) AS items FROM documents GROUP BY source",
    "parse_rss": f"""WITH {_LINES}
SELECT source AS source_id, 'https://docs.example/' || doc_id || '#' || i AS url, 'Line ' || i AS title,
  {_TRIMMED.format('line')} AS summary, {_TRIMMED.format('line')} AS content, lang AS author,
  1704067200 + doc_id AS published_at, min(lang) OVER (PARTITION BY source) AS language, source AS tags, 9::BIGINT AS fetched_at FROM lines""",
    "parse_atom": f"""SELECT source AS source_id, 'https://docs.example/' || doc_id AS url, 'Doc ' || doc_id AS title,
  source AS summary, {_TRIMMED.format('text')} AS content, lang AS author, 1704067200::BIGINT AS published_at,
  min(lang) OVER (PARTITION BY source) AS language, source AS tags, 9::BIGINT AS fetched_at FROM documents""",
    "feeds_stream": f"""SELECT source AS source_id, 'https://docs.example/' || doc_id AS url, 'Doc ' || doc_id AS title,
  source AS summary, {_TRIMMED.format('text')} AS content, lang AS author, 1704067200::BIGINT AS published_at,
  CASE WHEN doc_id % 2 = 0 THEN min(lang) OVER (PARTITION BY source) ELSE 'xx' END AS language, source AS tags,
  9::BIGINT AS fetched_at FROM documents""",
    "refused_feeds": """SELECT CASE WHEN length(text) > 200 THEN text[1:200] || '...' ELSE text END AS value_sample,
  'invalid_feed' AS reason FROM documents""",
    "sentence_split": rf"""WITH {ITEMS}, cut AS (
  SELECT url, string_split(regexp_replace(content, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM items
  WHERE content IS NOT NULL),
rows AS (SELECT url, unnest(range(len(ss)))::INT AS sentence_index, unnest(ss) AS sentence FROM cut)
SELECT *, len(list_filter(string_split_regex(sentence, '\s+'), lambda w: w <> ''))::INT AS words FROM rows""",
    "chunk_documents": f"WITH RECURSIVE {ITEMS}, {chunks(512, 64)} SELECT {CHUNK_COLUMNS}, tags FROM chunks",
    "chunk_overlap": f"WITH RECURSIVE {SMALL_CHUNKS} SELECT {CHUNK_COLUMNS} FROM chunks",
    "chunk_pages": f"WITH RECURSIVE {PAGE_ITEMS}, {chunks(64, 16)} SELECT {CHUNK_COLUMNS} FROM chunks",
    "hash_embedding": f"""WITH {vectors('documents', 'doc_id', 'text', 'dv')}
SELECT k AS doc_id, b::INT AS bucket, round(w, 6) AS weight FROM dv_d WHERE w <> 0""",
    "embedded_output": f"""WITH RECURSIVE {SMALL_CHUNKS}, {vectors('chunks', 'chunk_id', 'chunk_text', 'cv')}
SELECT {CHUNK_COLUMNS}, tags, array_to_string(
  list_transform(coalesce(e, list_transform(range({DIM}), lambda i: 0.0::DOUBLE)), lambda x: round(x * 10000)::BIGINT), ' ') AS embedding
FROM chunks LEFT JOIN cv ON k = chunk_id""",
    "embedded_records": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT url AS key, {CHUNK_COLUMNS}, tags, NULL::BIGINT AS published_at, {DIM}::INT AS embedding FROM chunks""",
    "chunk_summary": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT url, 0::BIGINT AS fetched_at, count(*) AS chunks FROM chunks GROUP BY url
UNION ALL SELECT url, 1, 1 FROM items""",
    "chunk_summary_json": f"""WITH RECURSIVE {ITEMS}, {chunks(512, 64)}
SELECT '{{"url":"' || url || '","chunks":' || count(*) || '}}' AS value FROM chunks GROUP BY url""",
    "index_documents": f"WITH RECURSIVE {SMALL_CHUNKS} SELECT {CHUNK_COLUMNS} FROM chunks",
    "upsert_latest": _LATEST,
    "upsert_replace_url": f"""WITH RECURSIVE {LOADS}, totals AS (SELECT url, total_chunks AS n FROM newer)
SELECT {CHUNK_COLUMNS} FROM latest LEFT JOIN totals USING (url) WHERE n IS NULL OR chunk_index < n""",
    "compacted_table": _LATEST,
    "ingested_count": f"""WITH RECURSIVE {SMALL_CHUNKS}, {RECORDS}
SELECT (SELECT count(*) FROM chunks) AS written, (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS refused""",
    "retrieve_benchmark": f"WITH RECURSIVE {retrieval(BENCHMARK, 5)} SELECT {_HITS} FROM found",
    "retrieve_turns": f"""WITH RECURSIVE {retrieval(TURNS, 5)}
SELECT question_id, rank, chunk_id, url, chunk_text, round(score, 6) AS score FROM found""",
    "retrieve_filtered": f"""WITH RECURSIVE {retrieval(BENCHMARK, 5, 0.65, "language = 'en'")}
SELECT {_HITS} FROM found""",
    "topk_cosine": f"WITH {CENTROIDS}, {ranked('qv', 'cv', '5')} {_IDS}",
    "topk_per_question": f"WITH {CENTROIDS}, {ranked('qv', 'cv', 'k + 1')} {_IDS}",
    "topk_threshold": f"WITH {CENTROIDS}, {ranked('qv', 'cv', '100', 0.35)} {_IDS}",
    "topk_blocks": f"WITH {CENTROIDS}, {ranked('qv', 'cv', '5')} {_IDS}",
    "hit_projection": """SELECT page_id AS question_id, 1 AS rank, md5(url) AS chunk_id, '' AS url, NULL::VARCHAR AS title,
  url AS chunk_text, 0.0::DOUBLE AS score FROM pages""",
    "context_blocks": f"""WITH RECURSIVE {retrieval(BENCHMARK, 3)},
named AS (SELECT question_id, rank, url, chunk_text, CASE WHEN rank <> 2 THEN title END AS title FROM found)
SELECT question_id, {_DOCS} FROM named GROUP BY question_id""",
    "prompt_texts": f"""WITH RECURSIVE {retrieval(BENCHMARK, 2)},
blocks AS (SELECT question_id, {_DOCS} FROM found GROUP BY question_id)
SELECT question_id, text, {_text(SYSTEM_PROMPT)} AS system,
  'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || text AS prompt, coalesce(sources, '') AS sources
FROM asked LEFT JOIN blocks USING (question_id)""",
    "stub_answers": answered(BENCHMARK, 5),
    "turn_answers": answered(TURNS, 3, 0.65, "language = 'en'"),
    "failing_answers": f"""WITH RECURSIVE {retrieval(BENCHMARK, 5)},
blocks AS (SELECT question_id, {_DOCS} FROM found GROUP BY question_id),
p AS (SELECT a.question_id, 'Context:' || chr(10) || b.context || chr(10) || chr(10) || 'Question: ' || a.text AS prompt,
  coalesce(b.sources, '') AS sources FROM asked a LEFT JOIN blocks b USING (question_id))
SELECT question_id,
  CASE WHEN prompt IS NULL THEN {_text(NO_ANSWER)} WHEN length(prompt) % 2 = 0 THEN 'answered ' || length(prompt) END AS answer, sources,
  CASE WHEN length(prompt) % 2 = 1 THEN 'completion_failed: ValueError: odd prompt' END AS error
FROM p""",
    "no_hit_answers": f"SELECT item_id AS question_id, {_text(NO_ANSWER)} AS answer, '' AS sources FROM benchmark",
    "stream_ingest": f"WITH RECURSIVE {SMALL_CHUNKS} SELECT {CHUNK_COLUMNS} FROM chunks",
    "stream_summaries": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT url, count(*) AS chunks FROM chunks GROUP BY url UNION ALL SELECT url, 1 FROM items""",
    "stream_summaries_same_time": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT url, count(*) AS chunks FROM chunks GROUP BY url UNION ALL SELECT url, 1 FROM items""",
    "stream_counters": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT count(*)::BIGINT AS chunks, count(DISTINCT url)::BIGINT AS items, count(*)::BIGINT AS written,
  0::BIGINT AS embedding_failed, 0::BIGINT AS upsert_failed,
  (SELECT count(*) FROM items WHERE coalesce(content, title) IS NULL)::BIGINT AS chunked_dropped
FROM chunks""",
    "stream_failures": f"""WITH RECURSIVE {SMALL_CHUNKS}
SELECT url, CASE WHEN bool_or(contains(chunk_text, '7')) THEN 'embedding_failed' END AS reason FROM chunks GROUP BY url""",
    "stream_dedup": "SELECT DISTINCT md5(text) AS url, text AS content FROM documents",
    "stream_dedup_expiry": """SELECT doc_id::VARCHAR AS url, h::INT AS after, ((1000 + h) * 3600 + doc_id % 1800)::BIGINT AS fetched_at
FROM documents, (VALUES (0), (73)) AS kept(h)""",
    "stream_rejects": "SELECT props AS value_sample, 'unknown_key' AS reason FROM events",
}
