"""Substring dedup in SQL: every window as a text of its own, on all documents."""

from __future__ import annotations

from sessionloom.llm.mixing_sql import WORDS


def word_repeats_sql(size: int = 13) -> str:
    return f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents),
windows AS (
    SELECT doc_id, k, array_to_string(words[k:k + {size - 1}], ' ') AS said
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS k FROM split)),
first AS (SELECT said, min(doc_id) AS least FROM windows GROUP BY said),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(k, k + {size})) AS place
    FROM windows JOIN first USING (said) WHERE least < doc_id),
places AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""


def byte_repeats_sql(size: int = 50) -> str:
    """Bytes as pairs of hexadecimal digits."""
    return f"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
sized AS (SELECT doc_id, digits, length(digits) // 2 AS n FROM bytes),
windows AS (
    SELECT doc_id, k, substring(digits, 2 * k - 1, {2 * size}) AS said
    FROM (SELECT doc_id, digits, unnest(range(1, n - {size - 2})) AS k FROM sized)),
first AS (SELECT said, min(doc_id) AS least FROM windows GROUP BY said),
repeated AS (SELECT doc_id, k FROM windows JOIN first USING (said) WHERE least < doc_id),
starts AS (
    SELECT doc_id, k, coalesce(k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) > {size}, true) AS opens
    FROM repeated),
runs AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM starts),
spans AS (
    SELECT doc_id, run, min(k) AS a, max(k) + {size} AS b FROM runs GROUP BY doc_id, run),
pieces AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 1) AS a, a AS b, run FROM spans
    UNION ALL
    SELECT s.doc_id, coalesce(max(b), 1), any_value(n) + 1, 1e9 FROM sized s LEFT JOIN spans USING (doc_id)
    GROUP BY s.doc_id),
kept AS (
    SELECT doc_id, string_agg(substring(digits, 2 * a - 1, 2 * (b - a)), '' ORDER BY run) AS digits
    FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k.digits)) AS kept_sha256
FROM sized s JOIN kept k USING (doc_id) LEFT JOIN removed USING (doc_id)"""
