"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

import string

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_REVISITS = r"""
WITH parts AS (
  SELECT page_id, page_id * 60 AS t, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS n,
         regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
pieces AS (
  SELECT page_id, t, digest, n, '"' || substring(digest, 1, 16) || '"' AS tag, cast(t - t % 3600 AS VARCHAR) AS modified,
         regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort([p for p in string_split(regexp_extract(rest, '\?(.*)$', 1), '&')
                                    if p <> '' and not regexp_matches(p, '^(utm_[a-z]*|fbclid|gclid)(=|$)')]), '&') AS query FROM parts),
pages_ AS (SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS curl FROM pieces),
revisits AS (
  SELECT page_id, page_id * 2 + 1 AS record_id, curl, CASE WHEN page_id % 13 = 5 THEN t - 30 ELSE t + 86400 END AS ts,
         CASE WHEN page_id % 8 IN (0, 4) THEN tag WHEN page_id % 8 IN (1, 5) THEN 'W/' || tag WHEN page_id % 8 = 3 THEN '"changed"' END AS etag,
         CASE WHEN page_id % 8 IN (2, 6) THEN modified END AS last_modified FROM pages_),
latest AS (
  SELECT r.record_id, max(struct_pack(ts := p.t, id := p.page_id * 2)) AS found FROM revisits r JOIN pages_ p ON r.curl = p.curl AND p.t < r.ts GROUP BY 1),
judged AS (
  SELECT r.*, p.t, p.n, p.digest, p.tag, p.page_id AS of_page,
         CASE WHEN p.page_id IS NULL THEN 'no_prior'
              WHEN r.etag IS NOT NULL THEN CASE WHEN regexp_replace(r.etag, '^W/', '') = p.tag THEN 'resolved' ELSE 'changed' END
              WHEN r.last_modified IS NOT NULL THEN CASE WHEN r.last_modified = p.modified THEN 'resolved' ELSE 'changed' END
              ELSE 'no_validator' END AS status
  FROM revisits r LEFT JOIN latest l USING (record_id) LEFT JOIN pages_ p ON p.page_id * 2 = l.found.id)
SELECT page_id, record_id, curl AS canonical_url, status, CASE WHEN status = 'resolved' THEN of_page * 2 END AS refers_to, CASE WHEN status = 'resolved' THEN digest END AS digest,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || n || chr(10) || 'content-type: text/html' || chr(10) ||
            'date: ' || ts || chr(10) || 'etag: ' || tag || chr(10) || 'x-cache: revalidated' END AS headers
FROM judged
"""

_DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS size FROM (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS passage FROM (
  SELECT item_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
doc_windows AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS passage FROM (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items) WHERE len(w) >= size)),
found AS (SELECT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows USING (size, passage)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _escaped(c: str) -> str:
    """The control strings inside content broken by a backslash; ``<`` and ``[``
    open them all."""
    out = rf"replace({c}, '\', '\\')"
    for control in ("<s>", "[INST]", "[/INST]", "</s>", "<|endoftext|>"):
        out = rf"replace({out}, '{control}', '{control[0]}\{control[1:]}')"
    return out


_CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x) AS turns,
         string_agg(CASE WHEN r = 'assistant' THEN x ELSE '' END, '' ORDER BY turn NULLS FIRST, r, x) AS loss,
         3 + sum(17 + length({_escaped('r')}) + length({_escaped('x')})) AS formatted FROM said GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, cast(formatted AS BIGINT) AS formatted_chars FROM whole
"""

_LINES = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
visible AS (SELECT doc_id, pos, regexp_replace(line, '[ \t\x0B\f\r]+$', '') AS v FROM lines),
wide AS (SELECT doc_id, pos AS first, lead(pos, 2) OVER o AS last, v || chr(10) || lead(v, 1) OVER o || chr(10) || lead(v, 2) OVER o AS passage
         FROM visible WHERE v <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, first, last FROM wide WHERE last IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM later),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY 1),
counted AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_lines, 0) - coalesce(k.n, 0) AS n_removed
FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_NEGATIVES = """
WITH part AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * cast(c AS DOUBLE)) for c in embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(cast(c AS DOUBLE))]) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, cast(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM part a JOIN part b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id) AS rank, n.id AS negative_id, positive_score,
         n.score AS negative_score
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, cast(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_revisits": _REVISITS.strip(),
    "op2_decontaminate": _DECONTAMINATE.strip(),
    "op7_chat": _CHAT.strip(),
    "op9_line_dedup": _LINES.strip(),
    "op12_hard_negatives": _NEGATIVES.strip(),
}
