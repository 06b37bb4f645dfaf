"""DuckDB SQL of the corpus queries that SQL can express."""

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = f"""
WITH lines AS (
    SELECT doc_id, pos, line, translate(trim(line, {_BLANK}), '{_UPPER}', '{_LOWER}') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), often AS (
    SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE often.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN often ON lines.key = often.key
GROUP BY doc_id
"""

AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), flags AS (
    SELECT doc_id, part,
           (len(w) < 100)::int
           + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int
           + 8 * regexp_matches(text, '[#$%&*|]')::int
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::int AS mask
    FROM words
), said AS (
    SELECT doc_id, max(coalesce(quality = 1, false)::int) AS good, max(coalesce(toxic = 1, false)::int) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counts AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
    FROM flags LEFT JOIN said USING (doc_id) GROUP BY part, mask
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b
), orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE p.b + q.b + r.b + s.b + t.b = 31 AND len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
    SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::int AS before
    FROM orders, range(1, 6) AS r(step)
), each AS (
    SELECT part, filter_order, step::int AS step, b, mask, n, good, bad, (mask & b) > 0 AS fails, (mask & before) = 0 AS passed
    FROM counts, steps
), sums AS (
    SELECT part, filter_order, step, b,
           coalesce(sum(n) FILTER (WHERE passed AND NOT fails), 0)::bigint AS kept,
           coalesce(sum(n) FILTER (WHERE passed AND fails), 0)::bigint AS removed,
           coalesce(sum(n) FILTER (WHERE fails AND NOT passed), 0)::bigint AS redundant,
           coalesce(sum(n) FILTER (WHERE mask = b), 0)::bigint AS unique_fails,
           coalesce(sum(good) FILTER (WHERE passed AND fails), 0)::bigint AS good_lost,
           coalesce(sum(bad) FILTER (WHERE passed AND fails), 0)::bigint AS toxic_lost
    FROM each GROUP BY part, filter_order, step, b
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, b)::bigint AS shapley
FROM sums
"""

ORACLE: dict[str, str] = {"op6_bloom_line_dedup": LINES, "op13_filter_audit": AUDIT}
