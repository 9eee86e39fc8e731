"""Words of many texts at once, as arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a binary array as one array of bytes, and where each of them ends."""
    large = pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends[1:] - ends[0]


def split_words(
    data: np.ndarray, ends: np.ndarray, cut: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words one after another, each word's length, and its document.

    Words are runs of bytes other than the six blanks; no word goes on in the next document. With
    ``cut`` a word also begins at each byte that is marked there.
    """
    begin = np.zeros(len(data) + 1, dtype=bool)
    begin[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = True
    letter = ~_IS_BREAK[data]
    first = letter & (begin[:-1] | ~np.concatenate([[False], letter[:-1]]))
    if cut is not None:
        first |= letter & cut
    start = np.flatnonzero(first)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return data[:0], none, none
    # Lengths: letters between one word's start and the next one's.
    place = np.cumsum(letter)
    count = np.diff(np.append(place[start] - 1, place[-1]))
    return data[letter], count, np.searchsorted(ends, start, side="right")


def word_codes(letters: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, and the distinct words by number."""
    offsets = np.concatenate([[0], np.cumsum(count)])
    kind, dtype = (pa.binary(), np.int32) if len(letters) < 2**31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(offsets.astype(dtype)), pa.py_buffer(np.ascontiguousarray(letters))]
    coded = pa.Array.from_buffers(kind, len(count), buffers).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def byte_slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes in a binary column, one row at least."""
    _, ends = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        base = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
