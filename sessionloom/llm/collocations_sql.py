"""The report on collocations in SQL, counted by plain grouping."""

from __future__ import annotations


def collocations_sql(longest: int = 5, least: int = 100, top: int = 2_000, scale: int = 1_000) -> str:
    breaks = "'[.,;:!?\\x0A-\\x0D]'"
    grams = " UNION ALL ".join(
        f"""SELECT lang, {k} AS k, array_to_string(words[i:i + {k - 1}], ' ') AS phrase
        FROM pieces, unnest(range(1, len(words) - {k} + 2)) AS t(i) WHERE len(words) >= {k}"""
        for k in range(1, longest + 1)
    )
    return f"""
WITH parts AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {breaks})) AS piece
    FROM documents),
pieces AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM parts),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= {least}),
listed AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE k >= 2),
inside AS (
    SELECT DISTINCT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, f
    FROM listed, unnest(range(2, k)) AS a(m), unnest(range(1, k - m + 2)) AS b(i)),
kept AS (
    SELECT * FROM listed c WHERE NOT EXISTS (
        SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f)),
splits AS (
    SELECT c.lang, c.phrase, c.f, j, array_to_string(c.words[1:j], ' ') AS head,
        array_to_string(c.words[j + 1:], ' ') AS rest
    FROM kept c, unnest(range(1, c.k)) AS s(j)),
cuts AS (
    SELECT s.lang, s.phrase, s.f AS a, p.f AS l, q.f AS r, t.n, s.j,
        CAST(({scale}::HUGEINT * s.f * t.n) // (p.f::HUGEINT * q.f) AS BIGINT) AS score
    FROM splits s JOIN counts p ON p.lang = s.lang AND p.phrase = s.head
        JOIN counts q ON q.lang = s.lang AND q.phrase = s.rest JOIN totals t ON t.lang = s.lang),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM lowest
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {top}
"""
