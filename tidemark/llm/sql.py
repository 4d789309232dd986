"""SQL counterparts (DuckDB) of those numbered queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Literal replacements stand for the pattern: a backslash after the first character of a control string.
_CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>"]


def _escaped(column: str) -> str:
    text = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for c in sorted(_CONTROL, key=len, reverse=True):
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


OP2 = f"""
WITH messages AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<|turn|><|text|><|end|>') + length({_escaped('role')}) + length({_escaped('text')})) AS chars
  FROM messages GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM said
"""

_AFTER = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"
_HOST = "translate(regexp_extract(coalesce({0}, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = """(VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r(host, path, verdict)"""
_BARE = "split_part({0}, '#', 1)"
_HEAD = f"regexp_extract({_BARE}, '(?s)^.*?://[^/?#]*')"
_REST = f"substr({_BARE}, length({_HEAD}) + 1)"
_NODE = f"""concat(translate({_HEAD}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  CASE WHEN {_HEAD} <> '' AND NOT starts_with({_REST}, '/') THEN '/' ELSE '' END, {_REST})"""
_REL = r"""(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|''(?:[^''>]*\s)?canonical(?:\s[^''>]*)?''|["'']?canonical(?:>|["''\s/][^>]*>))"""
_LINKS = rf"""list_transform(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*{_REL}[^>]*>?'),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1))"""
_GOTOS = r"""list_transform(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1))"""


def _ruled(source: str) -> str:
    """(url, host, path, rule, verdict) of the URLs in `source` as they are written."""
    return f"""SELECT u.url, u.host, u.path, arg_max(r.host || r.path, (length(r.host || r.path), r.host || r.path)) AS rule,
    arg_max(r.verdict, (length(r.host || r.path), r.host || r.path)) AS verdict
  FROM (SELECT url, {_HOST.format("rest")} AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT DISTINCT url, {_AFTER.format("url")} AS rest FROM {source})) u
  LEFT JOIN {_RULES} ON (u.host = r.host OR u.host LIKE '%.' || r.host) AND starts_with(u.path, r.path)
  GROUP BY u.url, u.host, u.path"""


OP10 = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(list_concat({_LINKS}, {_GOTOS})) AS link FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
), plain AS (
  SELECT url, split_part(replace(link, '&amp;', '&'), '#', 1) AS link, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS origin,
    regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)', 1) AS folder FROM tags
), links AS (
  SELECT url, CASE
    WHEN link = '' THEN NULL
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN origin = '' THEN NULL
    WHEN link LIKE '//%' THEN split_part(url, '://', 1) || ':' || link
    WHEN link LIKE '/%' THEN origin || link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE folder || CASE WHEN folder LIKE '%/' THEN '' ELSE '/' END || link END AS target
  FROM plain
), known AS (
  SELECT url, target FROM links WHERE target IS NOT NULL
), written AS (
  SELECT url FROM known UNION SELECT target FROM known
), both_ways AS (
  SELECT {_NODE.format("url")} AS a, {_NODE.format("target")} AS b FROM known
  UNION SELECT {_NODE.format("target")}, {_NODE.format("url")} FROM known
), reach AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), blocked AS (
  SELECT DISTINCT {_NODE.format("url")} AS node FROM ({_ruled("written")}) WHERE verdict = 'block'
), tainted AS (
  SELECT DISTINCT r.a AS node FROM reach r JOIN blocked ON blocked.node = r.b WHERE r.a <> r.b
), ruled AS ({_ruled("pages")})
SELECT p.page_id, ruled.host, ruled.path, ruled.rule,
  coalesce(ruled.verdict, CASE WHEN {_NODE.format("p.url")} IN (SELECT node FROM tainted) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p LEFT JOIN ruled ON ruled.url IS NOT DISTINCT FROM p.url
"""

OP7 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < best_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < best_id THEN best_id END AS refers_to
FROM best
"""

OP8 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), elements AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * c >= 85 * (s.n + t.n - c)
), both_ways AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(r.y)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id
"""

OP4 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, row_number() OVER () AS row FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.row AS a, a.vec_id AS vec_id, b.row AS b FROM usable a JOIN usable b ON a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT r.a, min(u.vec_id) AS vec_id FROM reach r JOIN usable u ON u.row = r.b GROUP BY r.a
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, l.vec_id) AS component_id,
  e.vec_id = least(e.vec_id, l.vec_id) AS kept, 1.0::DOUBLE AS recall
FROM (SELECT vec_id, row_number() OVER () AS at FROM embeddings) e
LEFT JOIN usable u ON u.vec_id = e.vec_id LEFT JOIN counted c ON c.a = u.row LEFT JOIN least l ON l.a = u.row
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), counts AS (
  SELECT lang, size, p, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS p
    FROM worded CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size
  ) GROUP BY ALL
), candidates AS (
  SELECT * FROM counts WHERE size >= 2 AND f >= 100
), inner_phrases AS (
  SELECT c.lang, c.p[i.at:i.at + s.size - 1] AS p, max(c.f) AS longer
  FROM candidates c, (SELECT unnest([2, 3, 4]) AS size) s, (SELECT unnest([1, 2, 3, 4]) AS at) i
  WHERE s.size < c.size AND i.at + s.size - 1 <= c.size GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases i ON i.lang = c.lang AND i.p = c.p
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.f
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, k.k, l.f AS l, r.f AS r, t.n,
    (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM kept c JOIN (SELECT unnest([1, 2, 3, 4]) AS k) k ON k.k < c.size
  JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k.k]
  JOIN counts r ON r.lang = c.lang AND r.p = c.p[k.k + 1:c.size]
  JOIN totals t ON t.lang = c.lang
), scored AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER best AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM scored WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000
"""


def _op13(clusters: int = 8, rounds: int = 10, components: int = 64) -> str:
    """One step after the other; a centroid is a row (cluster, c)."""
    nearest = """SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance, row FROM (
      SELECT k.*, c.cluster, list_sum(list_transform(list_zip(k.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM kept k CROSS JOIN centroids{0} c) GROUP BY vec_id, v, row"""
    steps = []
    for i in range(rounds):
        steps.append(f"nearest{i} AS MATERIALIZED ({nearest.format(i)})")
        # A quotient cut towards zero is one too large where it is negative and not whole.
        means = ", ".join(f"(sum(v[{j}]) // count(*) - CASE WHEN sum(v[{j}]) < 0 AND sum(v[{j}]) % count(*) <> 0 THEN 1 ELSE 0 END)::BIGINT" for j in range(1, components + 1))
        steps.append(f"""centroids{i + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(m.c, o.c) AS c FROM centroids{i} o
  LEFT JOIN (SELECT cluster, [{means}] AS c FROM nearest{i} GROUP BY cluster) m ON m.cluster = o.cluster)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, row_number() OVER () AS row
  FROM embeddings WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components}
), centroids0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c
  FROM kept QUALIFY cluster < {clusters}
), {", ".join(steps)}, final AS ({nearest.format(rounds)})
SELECT f.vec_id, f.cluster, f.distance, CAST(sum(f.distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(f.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM final f JOIN centroids{rounds} c ON c.cluster = f.cluster
"""


STATEMENTS = {
    "op2_chat_format": OP2,
    "op4_vector_graph": OP4,
    "op7_warc": OP7,
    "op8_ngram_join": OP8,
    "op10_url_filter": OP10,
    "op12_phrases": OP12,
    "op13_centroids": _op13(),
}
