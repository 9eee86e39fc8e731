"""Windows of all documents, brought together by content.

A window is a number of consecutive units (words or bytes) of one document. Inside a window the first
gram with the smallest hash is its minimiser, so equal windows have equal minimisers in equal places.
Consecutive windows whose minimiser is in the same place travel together as one string to the bucket of
the minimiser: a window then costs a few bytes instead of a whole copy of its text, and all equal
windows meet in one bucket.

Most strings have no equal window anywhere, and need not travel. A window has at least half of its other
units on one side of its minimiser. So two documents share a window only if they agree on the
minimiser and that many units before it, or after it. ``shared_places`` sends hashes of these two
contexts of each string, and gives back which strings have one in common with another id.

``spread`` sends those strings. It runs inside a task over a few megabytes of documents at a time and
makes one compressed blob per bucket. Before anything travels, equal contexts and equal strings of a
batch are merged: of a passage that a third of all documents share, each batch sends one copy.

``buckets`` deals the blobs to their buckets and lets a function decide there, per string, which of
its windows also start in a document with a smaller id. ``with_spans`` joins the answers to the
documents; the shuffle of the texts is the one that ``spread`` has read before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import text_key, whole_text
from sessionloom.llm.words import split_words, text_bytes

NO_ID = np.iinfo(np.int64).max  # a row without an id: no document has a larger one
SLICE_BYTES = 400_000
FLUSH_BYTES = 16_000_000
CONTEXT_FLUSH_BYTES = 8_000_000
BUCKET_BYTES = 4_000_000
SEED = 20_240_501

POSITION_BITS = 24
SEGMENT_UNITS = 1 << (POSITION_BITS - 2)

BLOB_SCHEMA = "bucket int, blob binary"
PLACE_SCHEMA = "doc_id long, text_key long, places binary"
SPAN_SCHEMA = "doc_id long, text_key long, spans binary"


@dataclass(frozen=True)
class Windows:
    """``size`` and ``gram`` in units; the units are words or bytes."""

    size: int
    gram: int
    words: bool

    @property
    def side(self) -> int:
        """Units that every window has before its minimiser, or else after it."""
        return -(-(self.size - self.gram) // 2)


# --- hashes of byte ranges ----------------------------------------------------------------------


@cache
def _table() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 14


@cache
def _powers(base: int, step: int = 1) -> np.ndarray:
    """base**(i * step) modulo 2**64 for i below the block length."""
    p = np.full(_BLOCK, pow(base, step, 2**64), dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _power(base: int, at: np.ndarray) -> np.ndarray:
    """base**at modulo 2**64, put together from the places of ``at`` in the system of blocks."""
    out = _powers(base)[at % _BLOCK]
    step, at = _BLOCK, at // _BLOCK
    while len(at) and at.max() > 0:
        out *= _powers(base, step)[at % _BLOCK]
        step, at = step * _BLOCK, at // _BLOCK
    return out


def range_hashes(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives a 64-bit hash of data[start:end] for arrays of starts and ends."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    low, table = _powers(_BASE), _table()
    begins = np.arange(0, n, _BLOCK)
    for at, factor in zip(begins.tolist(), _power(_BASE, begins)):
        part = table[data[at : at + _BLOCK]]
        part *= low[: len(part)]
        part *= factor
        sums[at + 1 : at + 1 + len(part)] = part
    np.cumsum(sums, out=sums)
    inverse = pow(_BASE, -1, 2**64)

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * _power(inverse, start))

    return hashes


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes data[start:start+length] of all ranges, one after another."""
    if not len(start):
        return np.zeros(0, dtype=np.uint8)
    out, widest = [], int(length.max())
    if widest * len(start) > 4 * int(length.sum()):  # lengths differ much: long ranges on their own
        long = length > 4 * int(length.mean() + 1)
        if long.any() and not long.all():
            total = np.empty(int(length.sum()), dtype=np.uint8)
            mine = np.repeat(long, length)
            total[mine] = np.concatenate(
                [data[a : a + n] for a, n in zip(start[long].tolist(), length[long].tolist())]
            )
            total[~mine] = gathered(data, start[~long], length[~long])
            return total
    # Rows of equal width are copied whole, and what is beyond a range's length is left out.
    padded = np.concatenate([data, np.zeros(widest, dtype=np.uint8)])
    rows = np.ndarray((len(data) + 1, widest), dtype=np.uint8, buffer=padded, strides=(1, 1))
    step = max(1, 1_000_000 // widest)
    for at in range(0, len(start), step):
        part = rows[start[at : at + step]]
        out.append(part[np.arange(widest) < length[at : at + step, None]])
    return np.concatenate(out)


def equal_ranges(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a:a+length] equals data[b:b+length], for each row; eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    same = np.ones(len(a), dtype=bool)
    live = np.flatnonzero(length > 0)
    done = 0
    while len(live):
        left = length[live] - done
        x = words[a[live] + done] ^ words[b[live] + done]
        short = left < 8
        if short.any():
            keep = (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
            x[short] &= keep
        ok = x == 0
        same[live[~ok]] = False
        live = live[ok & (left > 8)]
        done += 8
    return same


# --- units --------------------------------------------------------------------------------------

def _byte_units(data: np.ndarray, ends: np.ndarray):
    at = np.arange(len(data), dtype=np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return data, at, at + 1, doc


def _word_units(data: np.ndarray, ends: np.ndarray):
    """The documents' words with one space after each, and where each word starts and ends."""
    letters, count, doc = split_words(data, ends)
    start = np.cumsum(count + 1) - (count + 1)
    out = np.full(int((count + 1).sum()), 0x20, dtype=np.uint8)
    at = np.ones(len(out), dtype=bool)
    at[start + count] = False
    out[at] = letters
    return out, start, start + count, doc


# --- map side -----------------------------------------------------------------------------------


@dataclass
class _Strings:
    """The super-k-mers of some documents, in order: per string the first unit (in the slice), the number
    of windows, the place of the minimiser, the document, its number in the document."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    unit0: np.ndarray
    hashes: Callable
    first: np.ndarray
    windows: np.ndarray
    gram: np.ndarray
    doc: np.ndarray
    number: np.ndarray


def _strings(data: np.ndarray, ends: np.ndarray, win: Windows) -> _Strings | None:
    data, start, end, doc = (_word_units if win.words else _byte_units)(data, ends)
    n = len(start)
    if n < win.size:
        return None
    hashes = range_hashes(data)
    first, windows, gram = [], [], []
    # Long documents in segments that overlap by a window less one unit.
    for lo in range(0, n - win.size + 1, SEGMENT_UNITS):
        hi = min(n, lo + SEGMENT_UNITS + win.size - 1)
        f, w, g = _runs(hashes, start[lo:hi], end[lo:hi], doc[lo:hi], win)
        first.append(f + lo)
        windows.append(w)
        gram.append(g + lo)
    first, windows, gram = np.concatenate(first), np.concatenate(windows), np.concatenate(gram)
    if not len(first):
        return None
    of = doc[first]
    docs = np.arange(len(ends))
    number = np.arange(len(of)) - np.searchsorted(of, docs)[of]
    return _Strings(
        data, start, end, np.searchsorted(doc, docs), hashes, first, windows, gram, of, number
    )


def _runs(hashes, start: np.ndarray, end: np.ndarray, doc: np.ndarray, win: Windows):
    """Runs of windows whose minimiser is in the same place: first window, number, that place."""
    n = len(start)
    if n < win.size:
        return (np.zeros(0, dtype=np.int64),) * 3
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = hashes(start[: n - win.gram + 1], end[win.gram - 1 :])
    least &= ~low
    least |= np.arange(len(least), dtype=np.uint64)  # of equal hashes the first
    width, span = win.size - win.gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    place = np.flatnonzero(doc[: n - win.size + 1] == doc[win.size - 1 :])
    if not len(place):
        return (np.zeros(0, dtype=np.int64),) * 3
    least = least[place]
    new = np.ones(len(place), dtype=bool)
    # A place is in one document only, but hashes of a place's gram may repeat with other bits.
    new[1:] = ((least[1:] ^ least[:-1]) & low != 0) | (np.diff(place) != 1)
    run = np.flatnonzero(new)
    return place[run], np.diff(run, append=len(place)), (least[run] & low).astype(np.int64)


class _Contexts:
    """Context hashes of many documents' strings, until there are enough for one set of blobs."""

    def __init__(self, win: Windows, buckets: int):
        self.win, self.buckets = win, buckets
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.docs, self.bytes = 0, 0

    def add(self, ids, keys, data, ends) -> None:
        win, s = self.win, _strings(data, ends, self.win)
        if s is not None:
            last = s.first + s.windows + win.size - 2
            left = np.flatnonzero(s.gram - s.first >= win.side)
            right = np.flatnonzero(last - (s.gram + win.gram - 1) >= win.side)
            for rows, side, a, b in (
                (left, 0, s.gram[left] - win.side, s.gram[left] + win.gram - 1),
                (right, 1, s.gram[right], s.gram[right] + win.gram + win.side - 1),
            ):
                h = mixed(s.hashes(s.start[a], s.end[b]) + np.uint64(side))
                self.parts.append((h, s.doc[rows] + self.docs, s.number[rows]))
        self.bytes += len(data)
        self.ids.append(ids)
        self.keys.append(keys)
        self.docs += len(ids)

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        if not self.parts:
            self.clear()
            return
        h, doc, number = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        ids, keys = np.concatenate(self.ids), np.concatenate(self.keys)
        self.clear()
        several, first = shared_keys(h, ids[doc])
        # Contexts of more than one id in this batch are known to be shared; one of each still goes out.
        yield from _place_blobs(several, doc, number, ids, keys, self.buckets)
        tell = first & several
        entry = np.flatnonzero(~several | tell)
        entry = entry[np.lexsort((number[entry], doc[entry]))]
        key = (h[entry] >> np.uint64(32)) * np.uint64(self.buckets)
        bucket = (key >> np.uint64(32)).astype(np.int64)
        low = (h[entry] ^ (h[entry] >> np.uint64(32))).astype(np.uint32)
        for no, rows in _split(bucket, np.arange(len(entry))):
            e = entry[rows]
            docs, at = np.unique(doc[e], return_inverse=True)
            yield no, _packed(
                2,
                [
                    low[rows],
                    np.packbits(tell[e]),
                    np.diff(at, prepend=0).astype(np.int32),
                    number[e].astype(np.int32),
                    np.diff(ids[docs], prepend=0),
                    keys[docs],
                ],
            )


def shared_keys(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row's key occurs with more than one owner, and whether the row is its key's first."""
    order = np.lexsort((owner, key))
    k, o = key[order], owner[order]
    same = k[1:] == k[:-1]
    start = np.flatnonzero(np.append(True, ~same)) if len(k) else np.zeros(0, np.int64)
    several, first = np.zeros(len(k), dtype=bool), np.zeros(len(k), dtype=bool)
    if len(k):
        differ = np.append(same & (o[1:] != o[:-1]), False)
        several[order] = np.repeat(
            np.logical_or.reduceat(differ, start), np.diff(start, append=len(k))
        )
        first[order[start]] = True
    return several, first


def _place_blobs(chosen, doc, number, ids, keys, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Strings that are known to share a context; any bucket passes them on."""
    at = np.flatnonzero(chosen)
    if len(at):
        # Both contexts of a string may be shared: it is sent once.
        at = at[np.unique(doc[at] << 32 | number[at], return_index=True)[1]]
        to = mixed(ids[doc[at]].astype(np.uint64)) % np.uint64(buckets)
        for no, part in _split(to.astype(np.int64), at):
            yield no, _packed(3, [number[part].astype(np.int32), ids[doc[part]], keys[doc[part]]])


def _shared_places(table: pa.Table) -> pa.Table:
    """The strings of a bucket that share a context with another id."""
    known, entries = [], []
    for blob in table.column("blob"):
        kind, a = _unpacked(blob.as_py())
        if kind == 3:
            known.append((a[1], a[2], a[0]))
            continue
        at = np.cumsum(a[2], dtype=np.int64)
        tell = np.unpackbits(a[1], count=len(a[0])).astype(bool)
        entries.append((a[0], tell, a[3], np.cumsum(a[4], dtype=np.int64)[at], a[5][at]))
    if entries:
        h, tell, number, ids, keys = (np.concatenate([e[i] for e in entries]) for i in range(5))
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.append(True, h[order[1:]] != h[order[:-1]]))
        told = np.logical_or.reduceat(tell[order], start)
        # What one id alone has is shared if another batch says that others have it.
        shared = np.empty(len(h), dtype=bool)
        shared[order] = np.repeat(told, np.diff(start, append=len(h)))
        shared |= shared_keys(h, ids)[0]
        shared &= ~tell
        known.append((ids[shared], keys[shared], number[shared]))
    none = np.zeros(0, dtype=np.int64)
    ids, keys, number = (np.concatenate([none, *[k[i] for k in known]]) for i in range(3))
    return _per_document(ids, keys, number[:, None], "places")


def _per_document(ids, keys, values: np.ndarray, name: str) -> pa.Table:
    """One row per document with its rows of ``values`` as 32-bit numbers."""
    order = np.lexsort((values[:, 0], keys, ids))
    ids, keys, values = ids[order], keys[order], values[order].astype(np.int32)
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    blobs = [p.tobytes() for p in np.split(values, first[1:])] if len(first) else []
    doc = ids[first]
    return pa.table(
        {
            "doc_id": pa.array(doc, pa.int64(), mask=doc == NO_ID),
            "text_key": pa.array(keys[first], pa.int64()),
            name: pa.array(blobs, pa.binary()),
        }
    )


class _Batch:
    """Super-k-mers of many documents, until there are enough for one set of blobs."""

    def __init__(self, win: Windows, buckets: int):
        self.win, self.buckets = win, buckets
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.docs, self.bytes = 0, 0

    def add(self, ids, keys, data, ends, places: list[np.ndarray]) -> None:
        s = _strings(data, ends, self.win)
        if s is not None:
            # The strings that were asked for, by document and number.
            wanted = np.concatenate([p + (d << 32) for d, p in enumerate(places)])
            own = s.number + (s.doc << 32)
            pick = np.flatnonzero(np.isin(own, wanted))
            first, windows = s.first[pick], s.windows[pick]
            begin, stop = s.start[first], s.end[first + windows + self.win.size - 2]
            gram = s.gram[pick]
            self.parts.append(
                (
                    s.data,
                    begin + self.bytes,
                    stop - begin,
                    windows,
                    s.hashes(begin, stop),
                    s.hashes(s.start[gram], s.end[gram + self.win.gram - 1]),
                    gram - first,
                    s.doc[pick] + self.docs,
                    first - s.unit0[s.doc[pick]],
                )
            )
            self.bytes += len(s.data)
        self.ids.append(ids)
        self.keys.append(keys)
        self.docs += len(ids)

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        if not self.parts:
            self.clear()
            return
        data, begin, length, windows, h, least, gram, doc, unit = (
            np.concatenate([p[i] for p in self.parts]) for i in range(9)
        )
        ids, keys = np.concatenate(self.ids), np.concatenate(self.keys)
        self.clear()
        # Equal strings next to each other, the smallest id first.
        order = np.lexsort((np.arange(len(h)), ids[doc], h))
        twin = np.zeros(len(order), dtype=bool)
        a, b = order[:-1], order[1:]
        maybe = np.flatnonzero((h[a] == h[b]) & (length[a] == length[b]))
        twin[maybe + 1] = equal_ranges(data, begin[a[maybe]], begin[b[maybe]], length[a[maybe]])
        head = np.maximum.accumulate(np.where(twin, 0, np.arange(len(order))))
        owner = order[head]
        larger = ids[doc[order]] > ids[doc[owner]]
        yield from self._span_blobs(order[larger], doc, unit, windows, ids, keys)
        # One string each, in the order of the documents, with its places in its own document.
        sent = ~larger
        place, owner = order[sent], owner[sent]
        strings, which = np.unique(owner, return_inverse=True)
        # Minimisers are small numbers by nature; hashed again they spread over the buckets.
        key = (mixed(least[strings] + np.uint64(1)) >> np.uint64(32)) * np.uint64(self.buckets)
        bucket = (key >> np.uint64(32)).astype(np.int64)
        ranked = np.argsort(bucket, kind="stable")
        position = np.empty(len(strings), dtype=np.int64)
        position[ranked] = np.arange(len(strings))
        which = position[which]
        by_string = np.lexsort((place, which))
        place, which = place[by_string], which[by_string]
        strings, bucket = strings[ranked], bucket[ranked]
        found, lo = np.unique(bucket, return_index=True)
        hi = np.append(lo[1:], len(bucket))
        places = np.searchsorted(which, np.append(lo, len(bucket)))
        for i, no in enumerate(found):
            s = strings[lo[i] : hi[i]]
            p, w = place[places[i] : places[i + 1]], which[places[i] : places[i + 1]] - lo[i]
            docs, at = np.unique(doc[p], return_inverse=True)
            # Of bytes the number of windows follows from the length, so only one of them is sent.
            yield int(no), _packed(
                1,
                [
                    gathered(data, begin[s], length[s]),
                    (length[s] if not self.win.words else windows[s]).astype(np.uint16),
                    length[s].astype(np.int32) if self.win.words else np.zeros(0, np.int32),
                    gram[s].astype(np.uint16) if not self.win.words else np.zeros(0, np.uint16),
                    np.diff(w, prepend=0).astype(np.int32),
                    np.diff(at, prepend=0).astype(np.int32),
                    unit[p].astype(np.int32),
                    np.diff(ids[docs], prepend=0),
                    keys[docs],
                ],
            )

    def _span_blobs(self, place, doc, unit, windows, ids, keys):
        if not len(place):
            return
        start = unit[place]
        stop = start + windows[place] - 1 + self.win.size
        to = mixed(ids[doc[place]].astype(np.uint64)) % np.uint64(self.buckets)
        for no, part in _split(to.astype(np.int64), np.arange(len(place))):
            d = doc[place[part]]
            yield no, _packed(
                0,
                [start[part].astype(np.int32), stop[part].astype(np.int32), ids[d], keys[d]],
            )


def _split(label: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(label, kind="stable")
    found, lo = np.unique(label[order], return_index=True)
    for no, part in zip(found, np.split(order, lo[1:])):
        yield int(no), rows[part]


def _packed(kind: int, arrays: list[np.ndarray]) -> bytes:
    head = np.array([kind, len(arrays), *[len(a) for a in arrays]], dtype=np.int64).tobytes()
    body = b"".join([head, *[np.ascontiguousarray(a).tobytes() for a in arrays]])
    return zstandard.ZstdCompressor(level=3).compress(body)


_KINDS = {
    0: (np.int32, np.int32, np.int64, np.int64),
    1: (np.uint8, np.uint16, np.int32, np.uint16, *[np.int32] * 3, np.int64, np.int64),
    2: (np.uint32, np.uint8, np.int32, np.int32, np.int64, np.int64),
    3: (np.int32, np.int64, np.int64),
}


def _unpacked(blob: bytes) -> tuple[int, list[np.ndarray]]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(body, dtype=np.int64, count=2)
    lengths = np.frombuffer(body, dtype=np.int64, count=int(n), offset=16)
    at, out = 16 + 8 * int(n), []
    for dtype, length in zip(_KINDS[int(kind)], lengths):
        out.append(np.frombuffer(body, dtype=dtype, count=int(length), offset=at))
        at += int(length) * np.dtype(dtype).itemsize
    return int(kind), out


def _columns(batch: pa.RecordBatch):
    """Ids (null: NO_ID), keys, and the texts as one array of bytes with the end of each."""
    ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, keys, *text_bytes(batch.column(2))


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch with a bounded number of bytes, one document at least."""
    ids, keys, data, ends = _columns(batch)
    at = 0
    while at < len(ids):
        begin = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
        to = min(to, len(ids))
        rows = slice(at, to)
        yield rows, ids[rows], keys[rows], data[begin : ends[to - 1]], ends[rows] - begin
        at = to


def _rows_of(pairs: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, bytes]] = []
    size = 0
    for pair in pairs:
        rows.append(pair)
        size += len(pair[1])
        if size > 8_000_000:
            yield _blob_rows(rows)
            rows, size = [], 0
    if rows:
        yield _blob_rows(rows)


def _contexts(win: Windows, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Contexts(win, buckets)
        for arrow in batches:
            for _, *columns in _sliced(arrow):
                held.add(*columns)
                if held.bytes > CONTEXT_FLUSH_BYTES:
                    yield from _rows_of(held.blobs())
        yield from _rows_of(held.blobs())

    return run


def _spread(win: Windows, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch(win, buckets)
        for arrow in batches:
            places = [
                np.unique(np.frombuffer(b"".join(p.as_py()), dtype=np.int32)).astype(np.int64)
                for p in arrow.column(3)
            ]
            for rows, *columns in _sliced(arrow):
                held.add(*columns, places[rows])
                if held.bytes > FLUSH_BYTES:
                    yield from _rows_of(held.blobs())
        yield from _rows_of(held.blobs())

    return run


def _blob_rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
        names=["bucket", "blob"],
    )


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and text as bytes. Where ids are unique the key is 0: it has nothing to tell."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    unique = ids.groupBy("doc_id").count().filter(F.col("count") > 1).isEmpty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.lit(0).cast("long") if unique else text_key("text")).alias("text_key"),
        whole_text("text").cast("binary").alias("text"),
    )


def _buckets_for(docs: DataFrame, share: float) -> int:
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, int(total * share / BUCKET_BYTES) + 1)


def shared_places(docs: DataFrame, win: Windows) -> DataFrame:
    """Rows of (doc_id, text_key, places): numbers of the strings that share a context with another id."""
    hashes = docs.mapInArrow(_contexts(win, _buckets_for(docs, 1.0)), BLOB_SCHEMA)
    return hashes.groupBy("bucket").applyInArrow(_shared_places, PLACE_SCHEMA)


def _joined(docs: DataFrame, found: DataFrame, name: str, how: str) -> DataFrame:
    """Documents with all that was found for them, one row per row."""
    per = found.groupBy("doc_id", "text_key").agg(F.collect_list(name).alias(name))
    per = per.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return docs.join(per, same, how).select("doc_id", "text_key", "text", name)


def spread(docs: DataFrame, win: Windows, expansion: float) -> DataFrame:
    """One row per batch of ``keyed`` documents and bucket; the number of buckets follows the bytes."""
    chosen = _joined(docs, shared_places(docs, win), "places", "inner")
    return chosen.mapInArrow(_spread(win, _buckets_for(docs, expansion)), BLOB_SCHEMA)


# --- bucket side --------------------------------------------------------------------------------


@dataclass
class Bucket:
    """The strings of one bucket: bytes, begin, length, windows, place of the minimiser, smallest id."""

    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    windows: np.ndarray
    gram: np.ndarray
    owner: np.ndarray


#: Gets a bucket, gives for each repeated run of windows its string, first window and number.
Decide = Callable[[Bucket], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _decided(win: Windows, decide: Decide):
    def run(table: pa.Table) -> pa.Table:
        spans: list[tuple[np.ndarray, ...]] = []
        parts: list[list[np.ndarray]] = []
        for blob in table.column("blob"):
            kind, arrays = _unpacked(blob.as_py())
            if kind == 0:
                spans.append((arrays[2], arrays[3], arrays[0], arrays[1]))
            else:
                parts.append(arrays)
        if parts:
            spans.append(_repeats(parts, win, decide))
        return _span_rows(spans)

    return run


def _repeats(parts: list[list[np.ndarray]], win: Windows, decide: Decide):
    data = np.concatenate([p[0] for p in parts])
    number = np.concatenate([p[1] for p in parts]).astype(np.int64)
    length = np.concatenate([p[2] for p in parts]).astype(np.int64) if win.words else number
    windows = number if win.words else number - win.size + 1
    gram = np.concatenate([p[3] for p in parts]).astype(np.int64)
    strings = np.cumsum([0] + [len(p[1]) for p in parts])
    docs = np.cumsum([0] + [len(p[7]) for p in parts])
    which = np.concatenate([np.cumsum(p[4], dtype=np.int64) + strings[i] for i, p in enumerate(parts)])
    doc = np.concatenate([np.cumsum(p[5], dtype=np.int64) + docs[i] for i, p in enumerate(parts)])
    unit = np.concatenate([p[6] for p in parts]).astype(np.int64)
    ids = np.concatenate([np.cumsum(p[7], dtype=np.int64) for p in parts])
    keys = np.concatenate([p[8] for p in parts])
    # Every place of a string is in documents of one id.
    first = np.searchsorted(which, np.arange(len(length)))
    owner = ids[doc[first]]
    begin = np.cumsum(length) - length
    string, window, n = decide(Bucket(data, begin, length, windows, gram, owner))
    # Each run, for each place of its string.
    lo, hi = np.searchsorted(which, string), np.searchsorted(which, string, side="right")
    times = hi - lo
    place = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    start = unit[place] + np.repeat(window, times)
    stop = start + np.repeat(n, times) - 1 + win.size
    return ids[doc[place]], keys[doc[place]], start, stop


def _span_rows(spans: list[tuple[np.ndarray, ...]]) -> pa.Table:
    """One row per document with its spans as pairs of 32-bit numbers."""
    none = np.zeros(0, dtype=np.int64)
    ids, keys, start, stop = (np.concatenate([none, *[s[i] for s in spans]]) for i in range(4))
    return _per_document(ids, keys, np.stack([start, stop], axis=1), "spans")


def buckets(blobs: DataFrame, win: Windows, decide: Decide) -> DataFrame:
    """Rows of (doc_id, text_key, spans) from every bucket; a document may have several."""
    return blobs.groupBy("bucket").applyInArrow(_decided(win, decide), SPAN_SCHEMA)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every ``keyed`` document's id and text with its spans (null if it has none), one row per row."""
    return _joined(docs, spans, "spans", "left").select("doc_id", "text", "spans")


def covered(spans: list[bytes] | None, n: int) -> np.ndarray | None:
    """Which of ``n`` units lie in a span; None if there are no spans."""
    if not spans:
        return None
    pairs = np.frombuffer(b"".join(spans), dtype=np.int32).reshape(-1, 2)
    change = np.bincount(pairs[:, 0], minlength=n + 1) - np.bincount(pairs[:, 1], minlength=n + 1)
    return np.cumsum(change[:n]) > 0
