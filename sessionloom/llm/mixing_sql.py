"""The mixture report in SQL: the same plan, computed from the tables by DuckDB."""

from __future__ import annotations

from sessionloom.llm.common import permuted_sql
from sessionloom.llm.mixing import MixRule

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def word_count_sql(text: str) -> str:
    return f"len(regexp_extract_all(coalesce({text}, ''), '{WORDS}'))"


def _steps(table: str, column: str, n: str, key: str) -> tuple[str, str]:
    """Tables that put ``column`` through the permutation, one step each; the last one's name."""
    text, last = [], table
    for i, step in enumerate(permuted_sql(column, n, key)):
        name = f"{table}_{column}_{i}"
        text.append(f"{name} AS (SELECT * REPLACE (CAST({step} AS BIGINT) AS {column}) FROM {last})")
        last = name
    return ",\n".join(text), last


def mix_sql(rule: MixRule = MixRule()) -> str:
    w, block = list(rule.weights), rule.block_words
    blocks, dealt = _steps("deck", "block", "blocks", "key")
    return f"""
WITH sizes AS (
    SELECT doc_id, source, CAST({word_count_sql("text")} AS BIGINT) AS size,
        ((coalesce(doc_id, 0) % 2147483648 + 2147483648) % 2147483648) * 2654435761 % 4294967296 AS h
    FROM documents),
per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes GROUP BY source),
weighed AS (SELECT *, {w}[CAST(rank % {len(w)} AS INTEGER) + 1] AS weight FROM per),
levels AS (
    SELECT *, source_size * CAST({rule.cap} AS DOUBLE) AS most,
        ((SELECT sum(source_size) FROM weighed) * CAST({rule.share} AS DOUBLE)
        - coalesce(sum(source_size * CAST({rule.cap} AS DOUBLE)) OVER (
            ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (
            ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        AS level FROM weighed),
targets AS (
    SELECT source, source_size, rank,
        least(most, (SELECT max(level) FROM levels) * weight) AS target FROM levels),
takes AS (
    SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS take,
        CAST(ceil(source_size / {block}) AS BIGINT) AS blocks FROM targets),
passes AS (
    SELECT *, CASE WHEN source_size > 0 THEN take // source_size ELSE 0 END AS passes,
        CASE WHEN source_size > 0 THEN take % source_size ELSE 0 END AS rest FROM takes),
slots AS (
    SELECT *, CAST(passes * blocks + CASE WHEN rest > 0
        THEN least(CAST(ceil(rest / {block}) AS BIGINT) + 1, blocks) ELSE 0 END AS BIGINT) AS slots FROM passes),
numbered AS (
    SELECT *, unnest(generate_series(0, slots - 1)) AS k FROM slots WHERE slots > 0),
deck AS (
    SELECT *, k // blocks AS pass, k % blocks AS place, k % blocks AS block,
        rank * 2 + k // blocks + 5 AS key FROM numbered),
{blocks},
short AS (
    SELECT rank AS r, pass AS p, place AS short FROM {dealt} WHERE block = blocks - 1),
used AS (
    SELECT rank, pass, block, CASE WHEN pass < passes THEN length ELSE greatest(least(length,
        rest - (place * {block} - CASE WHEN place > short THEN blocks * {block} - source_size ELSE 0 END
        )), 0) END AS words
    FROM (SELECT *, CASE WHEN block < blocks - 1 THEN {block}
            ELSE source_size - (blocks - 1) * {block} END AS length FROM {dealt}) d
        LEFT JOIN short ON rank = r AND pass = p),
laid AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, t.rank, s.source, row_number() OVER () AS row,
        sum(size) OVER (PARTITION BY t.rank ORDER BY h, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (
    SELECT row, rank, start, size, unnest(generate_series(CAST(start // {block} AS BIGINT),
        CAST((start + size - 1) // {block} AS BIGINT))) AS block FROM laid WHERE size > 0),
taken AS (
    SELECT row, sum(greatest(0, least(p.block * {block} + words, start + size)
        - greatest(p.block * {block}, start))) AS taken
    FROM parts p JOIN used u ON p.rank = u.rank AND p.block = u.block GROUP BY row)
SELECT doc_id, source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM laid LEFT JOIN taken USING (row)"""
