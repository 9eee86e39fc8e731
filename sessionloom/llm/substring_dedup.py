"""Substring dedup over words: drop what a document with a smaller id has already said.

Every window of ``window`` consecutive words that also starts in a document with a smaller id is a
repeat, and the words it covers are removed. Windows are judged on the input, so the result does not
depend on any order of work.

Consecutive windows that share a minimiser (the two-word gram with the smallest hash) travel as one
packed string to its bucket, unless their contexts show that no other document has them
(``superkmers``). In a bucket all windows are sorted by a 64-bit hash and neighbours are
compared word for word, so equal windows are found exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionloom.llm.superkmers import (
    Bucket,
    Windows,
    buckets,
    covered,
    equal_ranges,
    keyed,
    range_hashes,
    spread,
    with_spans,
)


@dataclass(frozen=True)
class WordWindows:
    window: int = 13
    gram: int = 2


# Bytes sent over bytes of text: about six windows share a string of eighteen words, which makes three,
# but only strings that share half a window with another document are sent.
EXPANSION = 1.2


def window_classes(data: np.ndarray, start: np.ndarray, length: np.ndarray, hashes=None) -> np.ndarray:
    """For each range a number that equal ranges share: the row of one of them."""
    h = (hashes or range_hashes(data))(start, start + length)
    order = np.lexsort((length, h))
    a, b = order[:-1], order[1:]
    maybe = np.flatnonzero((h[a] == h[b]) & (length[a] == length[b]))
    same = equal_ranges(data, start[a[maybe]], start[b[maybe]], length[a[maybe]])
    twin = np.zeros(len(order), dtype=bool)
    twin[maybe + 1] = same
    head = np.maximum.accumulate(np.where(twin, 0, np.arange(len(order))))
    label = np.empty(len(order), dtype=np.int64)
    label[order] = order[head]
    if not same.all():  # different ranges of one hash: settle those hashes by their bytes
        for value in np.unique(h[a[maybe[~same]]]):
            rows = np.flatnonzero(h == value)
            first: dict[bytes, int] = {}
            for r in rows:
                text = data[start[r] : start[r] + length[r]].tobytes()
                label[r] = first.setdefault(text, int(r))
    return label


def runs(flag: np.ndarray, string: np.ndarray, window: np.ndarray):
    """Runs of flagged windows that follow one another in a string: string, first window, number."""
    at = np.flatnonzero(flag)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (string[at[1:]] != string[at[:-1]]) | (np.diff(window[at]) != 1)
    first = np.flatnonzero(new)
    return string[at[first]], window[at[first]], np.diff(first, append=len(at))


def smallest(label: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each row the smallest owner in its class."""
    _, which = np.unique(label, return_inverse=True)
    least = np.full(int(which.max()) + 1 if len(which) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, which, owner)
    return least[which]


def _decide(size: int):
    def decide(b: Bucket):
        # A word ends at a space or at the end of its string.
        border = np.append(b.data == 0x20, False)
        border[b.begin + b.length] = True
        stop = np.flatnonzero(border)
        begin = np.concatenate([[0], stop[:-1]])
        begin += (b.data[np.minimum(begin, len(b.data) - 1)] == 0x20) & (begin < len(b.data))
        string = np.searchsorted(b.begin, begin, side="right") - 1
        first = np.searchsorted(string, np.arange(len(b.begin)))
        of = np.repeat(np.arange(len(b.begin)), b.windows)
        window = np.arange(len(of)) - np.repeat(np.cumsum(b.windows) - b.windows, b.windows)
        word = first[of] + window
        at = begin[word]
        label = window_classes(b.data, at, stop[word + size - 1] - at)
        owner = b.owner[of]
        return runs(owner > smallest(label, owner), of, window)

    return decide


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, texts = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            words = text.as_py().split()  # bytes split at exactly the bytes that separate words
            cover = covered(spans.as_py(), len(words))
            if cover is not None:
                total.append(len(words))
                gone.append(int(cover.sum()))
                words = list(compress(words, (~cover).tolist()))
            else:
                total.append(len(words))
                gone.append(0)
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(total, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(texts, pa.binary()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for out in _kept(iter([batch.slice(at, 512)])):
                digest = [hashlib.sha256(t.as_py()).hexdigest() for t in out.column(3)]
                columns = [*out.columns[:3], pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"]
                )


def _with_repeats(docs: DataFrame, rule: WordWindows) -> DataFrame:
    win = Windows(rule.window, rule.gram, words=True)
    rows = keyed(docs)
    found = buckets(spread(rows, win, EXPANSION), win, _decide(rule.window))
    return with_spans(rows, found)


def drop_repeats(docs: DataFrame, rule: WordWindows = WordWindows()) -> DataFrame:
    """Each document with the words that are left: doc_id, n_words, n_removed, kept (UTF-8 bytes).

    One row per input row. A null text has no words. A row without an id is judged against all rows
    with one and counts as larger than they are; such rows are not compared with each other, nor are
    rows that repeat an id, since none of them has the smaller one. Other columns are not read. An
    empty table gives no rows.
    """
    schema = "doc_id long, n_words long, n_removed long, kept binary"
    return _with_repeats(docs, rule).mapInArrow(_kept, schema)


def repeat_digests(docs: DataFrame, rule: WordWindows = WordWindows()) -> DataFrame:
    """As ``drop_repeats``, with the SHA-256 of the kept words joined by one space."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_repeats(docs, rule).mapInArrow(_digests, schema)
