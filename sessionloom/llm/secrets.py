"""Secrets: spans of three plain patterns, and values in credential contexts that are hard to guess.

The plain patterns (assignments to words such as password, access keys, long hexadecimal runs) give their
matches. Beyond them, a value that follows a credential word, or stands for the password of an address, is
reported as ``guess`` if an attacker who knows how people make passwords would need many guesses for it.

The number of guesses is the least over all ways to cut the value into segments:

* a word of the lexicon: its rank, times ways to write it in capitals and to replace letters by signs,
* a date or a year: the days or years it could have been,
* a unit said several times: the guesses for the unit, times how often,
* a walk over the keyboard or along the alphabet: where it begins, how long it is, how often it turns,
* brute force: the size of each character's class.

Each segment also costs the choice of its kind. Costs are thousandths of decimal digits, whole numbers; one pass
from left to right over the positions finds the least sum. The lexicon is ranked over all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import stored, text_key, whole_text
from sessionloom.llm.words import byte_slices, split_words, text_bytes, word_codes

BATCH_BYTES = 4_000_000

# The plain patterns, the least lengths of what they match, and their order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 6
ACCESS = re.compile("AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile("[0-9a-f]+")
HEX_LEAST = 24

# Words that announce a credential.
CONTEXT_WORDS = (
    "password", "passwd", "passphrase", "passcode", "pass", "pwd", "pin", "secret", "client_secret", "token",
    "access_token", "auth_token", "api_key", "api-key", "apikey", "access_key", "private_key", "secret_key",
    "credential", "credentials", "authorization", "bearer",
)
CONTEXT = re.compile(
    rf"""(?<![A-Za-z0-9])(?:{"|".join(sorted(CONTEXT_WORDS, key=len, reverse=True))})(?![A-Za-z0-9])"""
    r"""["']?[\x20\t]*(?::=|=>|[:=]|\bis\b)[\x20\t]*(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"'<>,;]+))""",
    re.IGNORECASE | re.ASCII,
)
ADDRESS = re.compile(r"://[^\s/:@]+:([^\s/@]+)@")

# Passwords in wide use, the commonest first.
COMMON = (
    "password", "qwerty", "admin", "welcome", "letmein", "dragon", "monkey", "iloveyou", "master", "sunshine",
    "football", "baseball", "princess", "shadow", "superman", "secret", "login", "changeme", "default", "guest",
    "root", "test", "user", "example", "sample", "dummy", "hello", "trustno", "whatever", "freedom",
)
# Signs written for letters.
SIGNS = str.maketrans("013457@$!", "oleastasi")
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


@dataclass(frozen=True)
class SecretRule:
    """``digits``: decimal digits of guesses a value has to cost; ``lexicon``: how many words are ranked."""

    digits: float = 10.0
    least_length: int = 6
    lexicon: int = 20_000


def _cost(guesses: float) -> int:
    return round(1000 * math.log10(guesses))


CHOICE = _cost(5)  # five kinds of segments
WORD_LENGTHS = range(3, 25)
UNIT = 16
WALK = 4
STARTS = 47
YEARS = 200
_CLASS = [_cost(100)] * 128
for _i in range(128):
    _c = chr(_i)
    _CLASS[_i] = _cost(10 if _c.isdigit() else 26 if _c.isalpha() else 33)


# --- guesses ------------------------------------------------------------------------------------


def guess_cost(value: str, ranks: dict[str, int]) -> int:
    """Thousandths of the decimal digits of the number of guesses that ``value`` takes."""
    ends = _segments(value, ranks)
    best, brute = 0, math.inf
    costs = [0]
    for i, c in enumerate(value):
        # A span of brute force goes on, or begins here.
        brute = min(brute, best + CHOICE) + (_CLASS[ord(c)] if ord(c) < 128 else _CLASS[0])
        best = brute
        for start, cost in ends.get(i + 1, ()):
            best = min(best, costs[start] + CHOICE + cost)
        costs.append(best)
    return best


def _segments(value: str, ranks: dict[str, int]) -> dict[int, list[tuple[int, int]]]:
    """(start, cost) of the segments other than brute force, by their ends."""
    ends: dict[int, list[tuple[int, int]]] = {}
    for found in (_words(value, ranks), _dates(value), _repeats(value, ranks), _walks(value)):
        for start, end, cost in found:
            ends.setdefault(end, []).append((start, cost))
    return ends


def _words(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, int]]:
    # Letter by letter, so that places stay what they are.
    low = "".join(c.lower() if c.isascii() else c for c in value)
    plain = low.translate(SIGNS)
    for a in range(len(value)):
        for n in WORD_LENGTHS:
            if a + n > len(value):
                break
            rank = ranks.get(plain[a : a + n])
            exact = ranks.get(low[a : a + n])
            for r, signs in ((exact, 0), (rank, sum(x != y for x, y in zip(plain[a : a + n], low[a : a + n])))):
                if r:
                    yield a, a + n, _cost(r) + _capitals(value[a : a + n]) + signs * _cost(2)


def _capitals(word: str) -> int:
    upper = sum(c.isupper() for c in word)
    if not upper:
        return 0
    if upper == len(word) or (upper == 1 and word[0].isupper()):
        return _cost(2)
    return len(word) * _cost(2)


# Forms of days, with a sign between the parts or without: year first, year last, year in two digits.
_DAYS = (
    re.compile(r"(?=((\d{4})([-./ ]?)(\d\d)\3(\d\d)))", re.ASCII),
    re.compile(r"(?=((\d\d)([-./ ]?)(\d\d)\3(\d{4})))", re.ASCII),
    re.compile(r"(?=((\d\d)([-./ ]?)(\d\d)\3(\d\d)))", re.ASCII),
)
_YEAR = re.compile(r"(?=((?:19|20)\d\d))", re.ASCII)


def _dates(value: str) -> Iterator[tuple[int, int, int]]:
    for m in _YEAR.finditer(value):
        yield m.start(), m.start() + 4, _cost(YEARS)
    for form, pattern in enumerate(_DAYS):
        for m in pattern.finditer(value):
            first, second, third = int(m[2]), int(m[4]), int(m[5])
            day, month, year = (third, second, first) if form == 0 else (first, second, third)
            if form < 2 and not 1900 <= year < 2100:
                continue
            if 1 <= month <= 12 and 1 <= day <= 31 or form and 1 <= day <= 12 and 1 <= month <= 31:
                yield m.start(), m.start() + len(m[1]), _cost(YEARS * 366 * (4 if m[3] else 1))


def _repeats(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, int]]:
    """The longest whole number of units from where a stretch of equal units begins."""
    for n in range(1, min(UNIT, len(value) // 2) + 1):
        a = 0
        while a + n < len(value):
            b = a
            while b + n < len(value) and value[b] == value[b + n]:
                b += 1
            times = (b - a) // n + 1
            if times >= (3 if n == 1 else 2):
                yield a, a + times * n, guess_cost(value[a : a + n], ranks) + _cost(times)
            a = max(b, a + 1)


_PLACE = {c: (r, k) for r, row in enumerate(KEYBOARD) for k, c in enumerate(row)}


@lru_cache(maxsize=4096)
def _step(a: str, b: str) -> tuple[int, int] | None:
    """The direction from one key to the next one to it, or along the alphabet and the digits."""
    if a in _PLACE and b in _PLACE:
        (r, k), (s, m) = _PLACE[a], _PLACE[b]
        if max(abs(r - s), abs(k - m)) == 1:
            return s - r, m - k
    if a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return 9, ord(b) - ord(a)
    return None


def _walks(value: str) -> Iterator[tuple[int, int, int]]:
    """The longest walks of four characters or more."""
    low = "".join(c.lower() if c.isascii() else c for c in value)
    a, turns, before = 0, 0, None
    for i in range(1, len(low) + 1):
        step = _step(low[i - 1], low[i]) if i < len(low) else None
        if step is None:
            if i - a >= WALK:
                yield a, i, _cost(STARTS * (i - a)) + turns * _cost(6)
            a, turns, before = i, 0, None
        else:
            turns += before is not None and step != before
            before = step


# --- spans --------------------------------------------------------------------------------------


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns, in code points, by start, then kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_spans(
    text: str, ranks: dict[str, int], rule: SecretRule = SecretRule()
) -> list[tuple[str, int, int, int | None]]:
    """(kind, start, end, cost) of all spans by start, then kind; plain ones have no cost."""
    plain = plain_spans(text)
    found: dict[tuple[int, int], int] = {}
    for pattern in (CONTEXT, ADDRESS):
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex)
            if end - start < rule.least_length or any(s <= start and end <= e for _, s, e in plain):
                continue
            cost = guess_cost(text[start:end], ranks)
            if cost >= 1000 * rule.digits:
                found[start, end] = cost
    spans = [(*s, None) for s in plain] + [("guess", *span, cost) for span, cost in found.items()]
    order = (*KINDS, "guess")
    return sorted(spans, key=lambda s: (s[1], order.index(s[0]), s[2]))


# What a text must hold for a pattern to match: stems of all credential words, in lower case.
_STEMS = (b"pass", b"pwd", b"pin", b"secret", b"token", b"key", b"credential", b"authorization", b"bearer", b"://")
_IS_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))


def _may_match(data: np.ndarray, ends: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Which texts may hold a span: a stem, AKIA, or enough hexadecimal digits in a row."""
    run, held = _IS_HEX[data], 1
    while held < HEX_LEAST:  # whether ``held`` digits begin at a byte
        step = min(held, HEX_LEAST - held)
        run, held = run[:-step] & run[step:] if len(run) > step else run[:0], held + step
    may = np.zeros(len(ends), dtype=bool)
    may[np.searchsorted(ends, np.flatnonzero(run), side="right")] = True
    for i in np.flatnonzero(~may).tolist():
        text = texts[i].as_buffer().to_pybytes()
        may[i] = b"AKIA" in text or any(s in (low := text.lower()) for s in _STEMS)
    return may


SPANS = "array<struct<kind: string, start: long, end: long, cost: long>>"


def _rows(rule: SecretRule, words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = words.value
        kind = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64())]
            )
        )
        names = ("kind", "start", "end", "cost")
        for whole in batches:
            for batch in byte_slices(whole, 2, BATCH_BYTES):
                texts = batch.column(2)
                spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for i in np.flatnonzero(_may_match(*text_bytes(texts), texts)).tolist():
                    found = secret_spans(texts[i].as_py().decode(), ranks, rule)
                    spans[i] = [dict(zip(names, s)) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(spans, kind)], names=["doc_id", "text_key", "spans"]
                )

    return run


# --- over a table -------------------------------------------------------------------------------

_IS_LETTER = np.isin(np.arange(256), list(range(65, 91)) + list(range(97, 123)))


def _letter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of letters in each batch, in lower case."""
    for whole in batches:
        for batch in byte_slices(whole, 0, BATCH_BYTES):
            data, ends = text_bytes(batch.column(0))
            spaced = np.where(_IS_LETTER[data], data | 0x20, 0x20).astype(np.uint8)
            letters, count, _ = split_words(spaced, ends)
            fits = (count >= WORD_LENGTHS[0]) & (count <= WORD_LENGTHS[-1])
            codes, words = word_codes(letters[np.repeat(fits, count)], count[fits])
            n = np.bincount(codes, minlength=len(words)) if len(words) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"]
            )


def lexicon(docs: DataFrame, size: int) -> dict[str, int]:
    """Ranks from 1: passwords in wide use, then the commonest words of all documents, ``size`` of them."""
    counts = docs.select(whole_text("text").cast("binary").alias("text"))
    counts = counts.mapInArrow(_letter_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    # Words below the octave of counts that completes the list go before the sort, not after it.
    octaves = counts.groupBy(F.floor(F.log2("n")).alias("octave")).count().orderBy(F.col("octave").desc())
    held, least = 0, 0
    for r in octaves.collect():
        held, least = held + r["count"], 1 << r["octave"]
        if held >= size:
            break
    top = counts.filter(F.col("n") >= least).orderBy(F.col("n").desc(), "word").limit(size).collect()
    words = dict.fromkeys([*COMMON, *(r.word for r in top)])
    return {w: i for i, w in enumerate(words, start=1)}


def secrets(docs: DataFrame, rule: SecretRule = SecretRule()) -> DataFrame:
    """doc_id, text_key and spans of every row, by start, then kind.

    A span has its kind, its first and its last code point (the latter exclusive) and, for ``guess``, the
    cost. A value inside a plain span is not given again. A null text is empty and has no spans. Rows with a
    null or repeated id are rows of their own. Other columns are not read; an empty table gives no rows.
    The lexicon has a fixed number of words, so its broadcast does not grow with the documents.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key("text").alias("text_key"),
        whole_text("text").cast("binary").alias("text"),
    )
    words = docs.sparkSession.sparkContext.broadcast(lexicon(docs, rule.lexicon))
    return rows.mapInArrow(_rows(rule, words), f"doc_id long, text_key long, spans {SPANS}")


def secret_digests(docs: DataFrame, rule: SecretRule = SecretRule()) -> DataFrame:
    """One row per document: how many spans of each kind, a digest of the plain ones, and all spans."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))

    def of(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter("spans", lambda s: s.kind != "guess")
    return secrets(docs, rule).select(
        "doc_id",
        *(of(k) for k in KINDS),
        F.sha2(joined(plain).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        of("guess"),
        F.array_max(F.transform("spans", lambda s: s.cost)).alias("greatest_cost"),
    )
