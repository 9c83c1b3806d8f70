"""Results of the queries in SQL, where SQL can express them over whole tables."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Escapes: one character more for each of these in a conversation that needs them.
_EXTRA = "(length({c}) - length(replace(replace(replace({c}, '\\', ''), '#', ''), '<', '')))"

OP9_CHAT_FORMAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), one AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    max(CASE WHEN contains(text, '###') OR contains(text, '</turn>') THEN 1 ELSE 0 END) AS escaped,
    sum(14 + length(role) + length(text)) AS plain,
    sum({_EXTRA.format(c="text")} + {_EXTRA.format(c="role")}) AS extra
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(5 + plain + escaped * extra AS BIGINT) AS formatted_chars
FROM one"""

OP10_NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS v, vec_id AS c FROM embeddings
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.v
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, min(r.c) AS component_id,
  e.vec_id = min(r.c) AS kept
FROM embeddings e JOIN reach r ON r.v = e.vec_id GROUP BY e.vec_id"""

OP5_SUBSTRING_DEDUP = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM words),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM starts),
firsts AS (SELECT g, min(doc_id) AS first FROM grams GROUP BY g),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM grams JOIN firsts USING (g) WHERE first < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM hit GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
    [w[k] FOR k IN range(1, len(w) + 1) IF gone IS NULL OR NOT list_contains(gone, k)] AS kept
  FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM kept"""

OP4_NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN sizes s ON s.doc_id = x.doc_id JOIN sizes t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, s.n, t.n HAVING 100 * count(*) >= 75 * (s.n + t.n - count(*))
), reach AS (
  SELECT doc_id AS v, doc_id AS c FROM documents
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.v
)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN reach r ON r.v = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""

def _op13_clustering(k: int = 40, rounds: int = 5) -> str:
    """Lloyd rounds unrolled: one assignment and one update per round, then a last assignment."""

    def assign(c: str) -> str:
        return f"""SELECT v.rid, v.vec_id, min(list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - {c}.c[i]) * (v.x[i] - {c}.c[i]))) * 64 + {c}.cid) AS m
      FROM v, {c} GROUP BY v.rid, v.vec_id"""

    steps = [
        """v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cid, x AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k})
)""",
    ]
    for r in range(rounds):
        steps.append(f"""a{r} AS ({assign(f"c{r}")})""")
        steps.append(f"""c{r + 1} AS (
  SELECT c.cid, coalesce(u.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT cid, list(y ORDER BY i) AS c FROM (
      SELECT a.m % 64 AS cid, i, CAST(floor(sum(v.x[i]) / count(*)) AS BIGINT) AS y
      FROM a{r} a JOIN v USING (rid), range(1, 65) t(i) GROUP BY a.m % 64, i
    ) GROUP BY cid
  ) u USING (cid)
)""")
    steps.append(f"""fin AS ({assign(f"c{rounds}")})""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT f.vec_id, CAST(f.m % 64 AS INTEGER) AS cluster, CAST(f.m // 64 AS BIGINT) AS distance,
  CAST(sum(f.m // 64) OVER (PARTITION BY f.m % 64) AS BIGINT) AS cluster_inertia,
  CAST(sum(f.m // 64) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM fin f JOIN c{rounds} c ON c.cid = f.m % 64"""


OP13_CLUSTERING = _op13_clustering()

#: The base spans of op3: the contract's patterns, leftmost without overlaps, failing matches dropped;
#: positions are sums of the lengths of the gaps and matches before.
OP3_PII_BASE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT * FROM (VALUES
  (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
  (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  (3, 'card', '[0-9]([ -]?[0-9])+'),
  (4, 'phone', '\+[0-9][ ().0-9-]+[0-9]')) AS k(o, kind, p)),
m AS (SELECT d.doc_id, k.o, k.kind, regexp_extract_all(d.t, k.p) AS ms, regexp_split_to_array(d.t, k.p) AS gs FROM d, k),
e AS (SELECT doc_id, o, kind, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0),
s AS (
  SELECT doc_id, o, kind, ms[i] AS x, regexp_replace(ms[i], '[^0-9]', '', 'g') AS dg,
    coalesce(list_sum(list_transform(gs[1:i], lambda g: length(g))), 0)
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda y: length(y))), 0) AS st
  FROM e),
v AS (
  SELECT * FROM s WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(x, '.'),
      lambda q: length(ltrim(q, '0')) <= 3 AND CAST(coalesce(nullif(ltrim(q, '0'), ''), '0') AS INTEGER) <= 255))
    WHEN 'card' THEN length(dg) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(dg) + 1), lambda j:
      CASE WHEN j % 2 = 1 THEN CAST(dg[length(dg) - j + 1] AS INTEGER)
           WHEN 2 * CAST(dg[length(dg) - j + 1] AS INTEGER) > 9 THEN 2 * CAST(dg[length(dg) - j + 1] AS INTEGER) - 9
           ELSE 2 * CAST(dg[length(dg) - j + 1] AS INTEGER) END)) % 10 = 0
    ELSE length(dg) BETWEEN 10 AND 15 END)
SELECT d.doc_id,
  count(v.x) FILTER (WHERE v.kind = 'email') AS n_email, count(v.x) FILTER (WHERE v.kind = 'ip') AS n_ip,
  count(v.x) FILTER (WHERE v.kind = 'card') AS n_card, count(v.x) FILTER (WHERE v.kind = 'phone') AS n_phone,
  sha256(coalesce(string_agg(v.kind || ':' || v.st || ':' || (v.st + length(v.x)), ',' ORDER BY v.st, v.o), '')) AS base_sha256
FROM d LEFT JOIN v ON v.doc_id = d.doc_id GROUP BY d.doc_id, d.t"""

#: The base measures of op1 (not the method's verdict): words, their characters, symbols, repeated lines,
#: and the words covered by 3-word windows seen twice or more.
OP1_QUALITY_BASE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), r AS (SELECT row_number() OVER () AS rid, * FROM d),
win AS (
  SELECT rid, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM r WHERE len(w) >= 3)
), twice AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) >= 2),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM win JOIN twice USING (rid, g), (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM r
)
SELECT r.doc_id, CAST(len(r.w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(r.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(r.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l.ls) - len(list_distinct(l.ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  len(r.w) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(r.w) AS base_failed
FROM r JOIN lines l USING (rid) LEFT JOIN covered c USING (rid)"""


#: Size, source size and target of op7 (not what the mix takes): weights by rank of source, null last,
#: targets capped at three times the source and the excess reshared until the capped set stops changing.
OP7_MIXING_TARGETS = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source AS src, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), src AS (
  SELECT src, source_size, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w,
    3.0 * source_size AS cap
  FROM (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY src)
), tot AS (SELECT CAST(sum(source_size) AS DOUBLE) AS total, sum(w) AS weight FROM src),
it(step, level, before) AS (
  SELECT 0, total / weight, 0 FROM tot WHERE weight > 0
  UNION ALL
  SELECT step + 1, CASE WHEN ow > 0 THEN (total - held) / ow ELSE 0.0 END, n
  FROM (
    SELECT it.step, it.before, min(tot.total) AS total,
      coalesce(sum(CASE WHEN src.w * it.level > src.cap THEN src.cap END), 0.0) AS held,
      coalesce(sum(CASE WHEN src.w * it.level <= src.cap THEN src.w END), 0.0) AS ow,
      count(*) FILTER (WHERE src.w * it.level > src.cap) AS n
    FROM it, src, tot GROUP BY it.step, it.before
  ) WHERE n <> before
), fin AS (SELECT level FROM it ORDER BY step DESC LIMIT 1)
SELECT s.doc_id, s.size, t.source_size, least(t.w * coalesce((SELECT level FROM fin), 0.0), t.cap) AS target
FROM sized s JOIN src t ON t.src IS NOT DISTINCT FROM s.src"""


ORACLE: dict[str, str] = {
    "op4_ngram_join": OP4_NGRAM_JOIN,
    "op5_substring_dedup": OP5_SUBSTRING_DEDUP,
    "op9_chat_format": OP9_CHAT_FORMAT,
    "op10_near_vectors": OP10_NEAR_VECTORS,
    "op13_clustering": OP13_CLUSTERING,
    "op1_quality_base": OP1_QUALITY_BASE,
    "op3_pii_base": OP3_PII_BASE,
    "op7_mixing_targets": OP7_MIXING_TARGETS,
}
