"""Periodic runs: stretches of words that repeat themselves, and texts with the repeats taken out.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word
extends, of at least four periods and six words. All runs of a text are found, whatever their period:

* Periods up to ``SHORT`` by direct scans: words q apart are compared all along the text.
* Longer ones scale by scale, S = 32, 64, ... for periods of S/2 < q <= S. At every position stands a hash
  of S words. Of each S/2 positions in a row the least hash is a minimizer. A run of four periods is long
  enough to hold a window and the same window one period later, so a minimizer comes again q words on,
  and, since S >= q, nowhere in between. Pairs of neighbouring equal minimizers therefore seed every run; a seed
  is extended word by word to both sides, so what is reported is exact.
* A stretch found with a multiple of its smallest period is dropped: a shorter period found it.

Each document is worked on where it is read, without a shuffle; many texts are handled at once as arrays.
A run could only be missed if two different stretches of one text had the same 64 hash bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import text_key, whole_text
from sessionloom.llm.words import byte_slices, split_words, text_bytes, word_codes

SHORT = 16
PERIODS = 4
LEAST_WORDS = 6
BATCH_BYTES = 4_000_000

#: From an id and its number of words: where words begin to be repeated, and with which period.
Repeat = Callable[[int, int], tuple[int, int] | None]

SCHEMA = """doc_id long, text_key long, runs array<struct<start: long, length: long, period: long>>,
    strongest struct<start: long, length: long, period: long>, collapsed string"""


# --- runs of many texts at once -----------------------------------------------------------------


def least_length(period: int) -> int:
    return max(LEAST_WORDS, PERIODS * period)


def find_runs(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run. ``words`` has numbers that are equal only for equal words
    of one text, ``size`` the numbers of words of the texts, which come longest first."""
    found = [_scanned(words, q) for q in range(1, SHORT + 1)]
    ends = np.cumsum(size)
    hashes, scale = _mixed(words.astype(np.uint64)), 1
    while True:
        # Hashes of 2 * scale words from those of ``scale`` words.
        hashes = _mixed(hashes[:-scale] * np.uint64(3) + hashes[scale:]) if len(hashes) > scale else hashes[:0]
        scale *= 2
        if scale <= SHORT:
            continue
        # Texts that can hold four periods of more than half a scale.
        texts = int(np.searchsorted(-size, -PERIODS * (scale // 2 + 1), side="right"))
        if not texts:
            break
        held = int(ends[texts - 1])
        hashes = hashes[: max(held - scale + 1, 0)]
        found.append(_extended(words, *_seeds(hashes, scale)))
    start, length, period = (np.concatenate(x) for x in zip(*found))
    keep = [_is_smallest(words, s, q) for s, q in zip(start.tolist(), period.tolist())]
    keep = np.array(keep, dtype=bool)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _scanned(words: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches with period q by comparing all words that are q apart."""
    same = np.flatnonzero(words[:-q] == words[q:]) if len(words) > q else np.zeros(0, dtype=np.int64)
    if not len(same):
        return same, same, same
    first = np.flatnonzero(np.diff(same, prepend=-2) > 1)
    length = np.diff(first, append=len(same)) + q
    held = length >= least_length(q)
    return same[first[held]], length[held], np.full(int(held.sum()), q)


def _seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of minimizers and how far on the next equal one is, where that is a period of this scale."""
    window = scale // 2
    if len(hashes) < window:
        return (np.zeros(0, dtype=np.int64),) * 2
    least = _slid(hashes, window, np.minimum)
    # A position is a minimizer if the largest of the minima of the windows around it is its own hash.
    edge = np.zeros(window - 1, dtype=np.uint64)
    around = _slid(np.concatenate([edge, least, edge]), window, np.maximum)
    place = np.flatnonzero(around == hashes)
    place = place[np.argsort(hashes[place], kind="stable")]
    value = hashes[place]
    apart = np.diff(place)
    seed = np.flatnonzero((value[1:] == value[:-1]) & (apart > window) & (apart <= scale))
    return place[seed], apart[seed]


def _slid(values: np.ndarray, window: int, least: np.ufunc) -> np.ndarray:
    """Minima or maxima of all windows; the window's length is a power of two."""
    step = 1
    while step < window:
        values = least(values[:-step], values[step:])
        step *= 2
    return values


def _extended(words, place, period) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches around the seeds that are long enough, each once."""
    out: list[tuple[int, int, int]] = []
    order = np.lexsort((place, period))
    last, end = 0, -1
    for p, q in zip(place[order].tolist(), period[order].tolist()):
        if q == last and p < end:
            continue  # in the stretch found before
        stop = _reach_right(words, p, q)
        start = _reach_left(words, p, q)
        last, end = q, max(stop, p + 1)
        if stop - start + q >= least_length(q):
            out.append((start, stop - start + q, q))
    return tuple(np.array([x[i] for x in out], dtype=np.int64) for i in range(3))


def _reach_right(words: np.ndarray, at: int, q: int) -> int:
    """The first position from ``at`` on whose word differs from the one q later."""
    step = 64
    while at + q < len(words):
        to = min(at + step, len(words) - q)
        differ = np.flatnonzero(words[at:to] != words[at + q : to + q])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return at


def _reach_left(words: np.ndarray, at: int, q: int) -> int:
    """The first position of the stretch before ``at`` whose words equal those q later."""
    step = 64
    while at > 0:
        to = max(at - step, 0)
        differ = np.flatnonzero(words[to:at] != words[to + q : at + q])
        if len(differ):
            return to + int(differ[-1]) + 1
        at, step = to, 2 * step
    return at


def _is_smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether the stretch from ``start`` on has no period that divides this one."""
    return not any(
        np.array_equal(words[start : start + period], words[start + q : start + q + period])
        for q in (period // prime for prime in _primes_of(period))
    )


@cache
def _primes_of(n: int) -> tuple[int, ...]:
    found, p = [], 2
    while n > 1:
        if p * p > n:
            p = n
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return tuple(found)


# --- over a table -------------------------------------------------------------------------------


def _rows(repeat: Repeat | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2, BATCH_BYTES):
                yield _found(batch, repeat)

    return run


def _found(batch: pa.RecordBatch, repeat: Repeat | None) -> pa.RecordBatch:
    n_docs = batch.num_rows
    letters, count, doc = split_words(*text_bytes(batch.column(2)))
    codes, vocabulary = word_codes(letters, count)
    codes = codes.astype(np.int64)
    size = np.bincount(doc, minlength=n_docs)
    ends = np.cumsum(size)
    if repeat:
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            n = int(size[i])
            change = repeat(doc_id, n) if doc_id is not None and n else None
            if change:
                a, p = change
                part = codes[ends[i] - n : ends[i]]
                part[a:] = part[a + np.arange(n - a) % p]
    # Longest text first; numbers tell texts apart.
    order = np.argsort(-size, kind="stable")
    first = np.cumsum(size[order]) - size[order]
    source = np.repeat((ends - size)[order] - first, size[order]) + np.arange(len(codes))
    owner = np.repeat(order, size[order])
    start, length, period = find_runs(owner * (len(vocabulary) + 1) + codes[source], size[order])
    owner = owner[start]
    start = source[start]  # a run lies in one text, so it is as long as before
    dropped = np.zeros(len(codes) + 1, dtype=np.int32)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.cumsum(dropped[:-1]) == 0
    # Per document, as lists.
    within = np.argsort(owner, kind="stable")
    owner, length, period = owner[within], length[within], period[within]
    start = start[within] - (ends - size)[owner]
    cut = np.searchsorted(owner, np.arange(n_docs + 1))
    columns = [pa.array(x, pa.int64()) for x in (start, length, period)]
    names = ["start", "length", "period"]
    runs = pa.StructArray.from_arrays(columns, names=names)
    runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs)
    best = [None] * n_docs
    for i in np.unique(owner).tolist():
        rows = zip(*(x[cut[i] : cut[i + 1]].tolist() for x in (start, length, period)))
        best[i] = dict(zip(names, min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))))
    strongest = pa.array(best, pa.struct([(n, pa.int64()) for n in names]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), runs, strongest, _joined(codes, kept, ends, vocabulary)],
        names=["doc_id", "text_key", "runs", "strongest", "collapsed"],
    )


def _joined(codes: np.ndarray, kept: np.ndarray, ends: np.ndarray, vocabulary: list[bytes]) -> pa.Array:
    """The kept words of each text, joined by one space."""
    offsets = np.concatenate([[0], np.cumsum(kept)[ends - 1] if len(codes) else np.zeros(len(ends), np.int64)])
    if len(codes):
        offsets[1:][ends == 0] = 0
    words = pa.array(vocabulary, pa.binary()).take(pa.array(codes[kept]))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words)
    return pc.binary_join(lists, b" ").cast(pa.string())


def periodic_runs(docs: DataFrame, repeat: Repeat | None = None) -> DataFrame:
    """doc_id, text_key, runs (by start, then period), strongest run and collapsed text of every row.

    Starts and lengths count words from 0. The strongest run has the greatest length in periods; of equal
    ones the first, then the one with the shorter period; null if there is none. The collapsed text has the
    words that no run holds after its first period, joined by one space. ``repeat`` lets words of a text be
    replaced by periodic ones before the search. Null texts and texts without words have no runs and an
    empty collapsed text. Rows with a null or repeated id are rows of their own and ``repeat`` leaves
    those without an id as they are. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key("text").alias("text_key"),
        whole_text("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(_rows(repeat), SCHEMA)


def planted(doc_id: int, n: int) -> tuple[int, int] | None:
    """Every tenth text by hash of its id ends in a periodic stretch, the period taken from the hash too."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def run_digests(docs: DataFrame, repeat: Repeat | None = planted) -> DataFrame:
    """One row per document: how many runs, the strongest, and digests of all runs and of the text left."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    text = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    best = F.col("strongest")
    return periodic_runs(docs, repeat).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
