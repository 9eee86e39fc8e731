"""Collocations: phrases of two to five words that are rarer as a product of their parts than as a whole.

Everything is counted per language. Counts are streams of (key, count) rows; a key is the language and the
words of a phrase, in bytes that sort like the sequence of words, so the phrases that begin with a phrase
follow it directly. No count is looked up by hash: streams are dealt out in ranges and read in order.

1. Window counts. The window at a position is its word and the next ones of the same piece. A task sends
   each distinct window of a batch once, with its count, to the range it belongs to; sorted there, the
   counts of all phrases are sums over neighbouring rows. Phrases at the borders of a batch of rows are
   given in parts, which are then summed.
   The first pass has windows of two words: it counts languages, words and pairs. The second has windows
   as long as all pairs in them may be frequent, by a bitmap of a fixed size of the frequent pairs. A bit set by
   chance only makes a window longer; no occurrence of a frequent phrase is left out.
2. Frequent phrases of all lengths are sorted twice, by their words from the front (prefix order) and from
   the back (suffix order). One pass over each merges the streams of all lengths in lockstep: a phrase's
   first parts are the rows last seen of each shorter length, and a phrase as frequent as its extension by a
   word is marked. Ranges are cut between any two keys; the few first parts of a cut are copied to it.
3. Both orders' rows of a phrase are put together and scored in exact decimals.

The cuts of the ranges come from samples. They decide where rows are worked on, not what comes out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import partitions, stored, whole_text
from sessionloom.llm.words import byte_slices, text_bytes, word_codes

BATCH_BYTES = 6_000_000
SAMPLE_DOCS = 2_000
CUTS_PER_RANGE = 32
#: Bits of the map of frequent pairs; 8 MB are broadcast.
PAIR_BITS = 26

# The bytes that end a piece, and those that end a word inside one.
PIECE_BREAK = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_BREAK = b" \t"
END = b"\0"


@dataclass(frozen=True)
class PhraseRule:
    """``longest``: words of a phrase; ``least``: its occurrences; ``top``: phrases reported per language."""

    longest: int = 5
    least: int = 100
    top: int = 2_000
    scale: int = 1_000


# --- words of a batch ---------------------------------------------------------------------------

_PIECE = np.isin(np.arange(256), list(PIECE_BREAK))
_BREAK = _PIECE | np.isin(np.arange(256), list(WORD_BREAK))
#: Lowers A-Z, and moves the bytes 0-8 up by one, into the gap the tab leaves, so that 0 is free to end words.
_CODED = np.arange(256, dtype=np.uint8)
_CODED[65:91] += 32
_CODED[0:9] += 1
_DECODED = bytes([*range(0, 1), *range(0, 9), *range(10, 256)])


def _words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """A number for each word, the words by number in ascending order, and the end of each word's piece."""
    data, ends = text_bytes(texts)
    letter = ~_BREAK[data]
    begin = np.zeros(len(data) + 1, dtype=bool)
    begin[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = True
    first = letter & (begin[:-1] | ~np.concatenate([[False], letter[:-1]]))
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64)
    place = np.cumsum(letter, dtype=np.int64)
    count = np.diff(np.append(place[start] - 1, place[-1]))
    codes, words = word_codes(_CODED[data[letter]], count)
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    # Pieces end at the marked bytes and at the ends of texts.
    border = _PIECE[data]
    border[ends[ends > 0] - 1] = True
    piece = np.cumsum(border, dtype=np.int32)[start] - border[start]
    new = np.flatnonzero(np.diff(piece, append=-1))
    stop = np.repeat(new + 1, np.diff(new, prepend=-1))
    return rank[codes], [words[i] for i in order], stop


def lang_key(lang: str) -> bytes:
    """The language without the byte 0."""
    return lang.encode().replace(b"\1", b"\1\2").replace(b"\0", b"\1\1")


def lang_of(key: bytes) -> str:
    return key.replace(b"\1\1", b"\0").replace(b"\1\2", b"\1").decode()


def phrase_of(words: bytes) -> str:
    """The words of a key, joined by spaces."""
    return b" ".join(w.translate(_DECODED) for w in words.split(END)).decode()


# --- windows ------------------------------------------------------------------------------------


def _pair_cells(lang: bytes, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of each pair of words, given by their hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= np.uint64(xxhash.xxh64_intdigest(lang))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def _windows(longest: int, shortest: int, cuts: list[bytes], pairs=None):
    """(lang, text) to (part, key, n): each window of at least ``shortest`` words, once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = np.frombuffer(pairs.value, dtype=np.uint8) if pairs is not None else None
        for whole in batches:
            for batch in byte_slices(whole, 1, BATCH_BYTES):
                langs = batch.column(0)
                for lang in pc.unique(langs).to_pylist():
                    texts = batch.column(1).filter(pc.equal(langs, lang))
                    yield from _counted(lang_key(lang), texts, longest, shortest, cuts, allowed)

    return run


def _counted(lang, texts, longest, shortest, cuts, allowed) -> Iterator[pa.RecordBatch]:
    codes, words, stop = _words(texts)
    n = len(codes)
    if not n:
        return
    length = np.minimum(stop - np.arange(n), longest)
    if allowed is not None:
        hashed = _hashes(words)[codes]
        cell = _pair_cells(lang, hashed[:-1], hashed[1:])
        bad = np.append((allowed[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0, True)
        # A window ends before the first pair that is not frequent.
        next_bad = np.minimum.accumulate(np.where(bad, np.arange(n), n)[::-1])[::-1]
        length = np.minimum(length, next_bad - np.arange(n) + 1)
    at = np.flatnonzero(length >= shortest)
    if not len(at):
        return
    # Columns of word numbers, from 1, and 0 beyond the window: rows sort like the keys.
    padded = np.concatenate([codes + 1, np.zeros(longest, np.int64)])
    columns = [np.where(length[at] > k, padded[at + k], 0) for k in range(longest)]
    # Two columns fit one number.
    packed = [
        (a << 32) | (columns[2 * i + 1] if 2 * i + 1 < longest else 0)
        for i, a in enumerate(columns[::2])
    ]
    if len(packed) == 1:
        distinct, counts = np.unique(packed[0], return_counts=True)
        packed = [distinct]
    else:
        order = np.lexsort(packed[::-1])
        packed = [p[order] for p in packed]
        new = np.ones(len(at), dtype=bool)
        new[1:] = np.logical_or.reduce([p[1:] != p[:-1] for p in packed])
        first = np.flatnonzero(new)
        counts = np.diff(first, append=len(at))
        packed = [p[first] for p in packed]
    columns = [c for p in packed for c in (p >> 32, p & 0xFFFFFFFF)][:longest]
    vocabulary = pa.array(words, pa.binary())
    size = len(counts)
    for a in range(0, size, 1 << 17):  # a bounded number of rows at a time
        b = min(a + (1 << 17), size)
        parts = [pa.array([lang] * (b - a), pa.binary())]
        for c in columns:
            no = c[a:b]
            parts.append(vocabulary.take(pa.array(no - 1, mask=no == 0)))
        keys = pc.binary_join_element_wise(*parts, END, null_handling="skip")
        part = _parts(keys, cuts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), keys, pa.array(counts[a:b], pa.int64())],
            names=["part", "key", "n"],
        )


class _Keys:
    """A sorted array of keys, as a sequence for bisection."""

    def __init__(self, keys: pa.Array):
        self.keys = keys

    def __len__(self):
        return len(self.keys)

    def __getitem__(self, i):
        return self.keys[i].as_py()


def _parts(keys: pa.Array, cuts: list[bytes]) -> np.ndarray:
    """The range of each key: how many cuts are not above it. The keys are sorted."""
    held = _Keys(keys)
    first = [bisect_left(held, c) for c in cuts]
    return np.searchsorted(np.array(first, dtype=np.int64), np.arange(len(keys)), side="right")


WINDOW = "part int, key binary, n long"
PHRASE = "key binary, words int, f long"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        whole_text("text").cast("binary").alias("text"),
    )


def _cuts(keys: DataFrame) -> list[bytes]:
    """Keys between which ranges begin, fewer than shuffle partitions, from a sample of keys by hash."""
    n = partitions(keys.sparkSession)
    sample = keys.select("key").distinct().orderBy(F.xxhash64("key")).limit(CUTS_PER_RANGE * n)
    found = sorted(bytes(r.key) for r in sample.collect())
    return sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []


def _phrases(docs: DataFrame, longest: int, shortest: int, least: int, pairs=None) -> DataFrame:
    """(key, words, f): phrases of ``shortest`` to ``longest`` words with at least ``least`` occurrences. With
    ``shortest`` 1 also the languages, as phrases of no words, with the number of all their words."""
    texts = _texts(docs)
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    sample = texts if share == 1.0 else texts.sample(share, seed=1)
    cuts = _cuts(sample.mapInArrow(_windows(longest, shortest, [], pairs), WINDOW))
    windows = texts.mapInArrow(_windows(longest, shortest, cuts, pairs), WINDOW)
    dealt = windows.repartitionById(partitions(docs.sparkSession), "part").sortWithinPartitions("key")
    lowest = 0 if shortest == 1 else shortest
    parts = dealt.select("key", "n").mapInArrow(_summed(longest, lowest, least), PHRASE)
    found = parts.groupBy("key", "words").agg(F.sum("f").alias("f"))
    return stored(found.filter((F.col("f") >= least) | (F.col("words") == 0)), "phrases")


def _table(keys: pa.Array, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per key the number of its words, and, in columns for the language and each word, numbers that are
    equal for equal words (-1: no word) and the byte of the key where the word ends."""
    data, ends = text_bytes(keys)
    begin = np.concatenate([[0], ends[:-1]])
    inner = np.flatnonzero(data == 0)
    place = np.concatenate([ends, inner])
    row = np.concatenate([np.arange(len(ends)), np.searchsorted(ends, inner, side="right")])
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    first = np.searchsorted(row, np.arange(len(ends)))
    column = np.arange(len(row)) - first[row]
    start = np.where(column == 0, begin[row], np.concatenate([[0], place[:-1]]) + 1)
    numbers, _ = word_codes(data[data != 0], place - start)
    codes = np.full((len(ends), longest + 1), -1, dtype=np.int64)
    stops = np.zeros((len(ends), longest + 1), dtype=np.int64)
    codes[row, column] = numbers
    stops[row, column] = place - begin[row]
    return np.bincount(row, minlength=len(ends)) - 1, codes, stops


def _summed(longest: int, lowest: int, least: int):
    """Sorted windows to counts of their first words. What a batch's border may cut is given in any case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _prefix_sums(batch.column(0), batch.column(1).to_numpy(), longest, lowest, least)

    return run


def _prefix_sums(keys: pa.Array, n: np.ndarray, longest: int, lowest: int, least: int) -> pa.RecordBatch:
    depth, codes, stops = _table(keys, longest)
    out_keys: list[bytes] = []
    out_words, out_f = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    changed = np.zeros(len(keys), dtype=bool)  # whether a row's first words differ from the row's before
    changed[0] = True
    for k in range(longest + 1):
        changed[1:] |= (codes[1:, k] != codes[:-1, k]) | (codes[1:, k] < 0)
        if k < lowest:
            continue
        first = np.flatnonzero(changed)
        sums = np.add.reduceat(n, first)
        after = np.append(first[1:], len(keys))
        keep = (sums >= least) | (first == 0) | (after == len(keys))
        keep &= depth[first] >= k
        first, sums = first[keep], sums[keep]
        out_keys += [keys[i].as_py()[: stops[i, k]] for i in first.tolist()]
        out_words.append(np.full(len(first), k, dtype=np.int32))
        out_f.append(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(out_keys, pa.binary()), *(pa.array(np.concatenate(x)) for x in (out_words, out_f))],
        names=["key", "words", "f"],
    )


# --- frequent pairs -----------------------------------------------------------------------------


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [k.as_py().split(END) for k in batch.column(0)]
        first, second = (_hashes([p[i] for p in parts]) for i in (1, 2))
        cells = np.zeros(len(parts), dtype=np.int64)
        for lang in {p[0] for p in parts}:
            mine = np.array([p[0] == lang for p in parts])
            cells[mine] = _pair_cells(lang, first[mine], second[mine])
        yield pa.RecordBatch.from_arrays([pa.array(cells + 1)], names=["cell"])


def pair_map(phrases: DataFrame) -> bytearray:
    """A bit for each cell that holds a frequent pair: 2**PAIR_BITS bits, however many pairs there are."""
    cells = phrases.filter("words = 2").select("key").mapInArrow(_cells, "cell long")
    # Spark's bitmaps hold 32,768 cells each and are numbered from 1.
    maps = cells.groupBy(F.bitmap_bucket_number("cell").alias("no")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    out = bytearray(1 << (PAIR_BITS - 3))
    for r in maps.collect():
        out[(r.no - 1) << 12 : r.no << 12] = r.bits
    return out


# --- lockstep over the streams of all lengths -----------------------------------------------------


def reversed_key(key: bytes) -> bytes:
    """The language and the words from the last to the first; twice gives the key again."""
    lang, *words = key.split(END)
    return END.join([lang, *words[::-1]])


def _dealt(reverse: bool, cuts: list[bytes]):
    """(key, f) to (part, key, f, copied): rows go to their range, and to those their phrase reaches into."""
    reached: dict[bytes, list[int]] = {}
    for part, cut in enumerate(cuts, start=1):
        words = cut.split(END)
        for k in range(1, len(words)):
            reached.setdefault(END.join(words[:k]), []).append(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = reversed_key(key) if reverse else key
                rows.append((bisect_right(cuts, key), key, f, False))
                rows += [(part, key, f, True) for part in reached.get(key, ())]
            yield _batch(rows, DEALT)

    return run


DEALT = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("f", pa.int64()), ("copied", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


MERGED = pa.schema([("key", pa.binary()), ("counts", pa.list_(pa.int64())), ("held", pa.bool_())])


def _merged(reverse: bool, longest: int):
    """Sorted phrases to the counts of each one's first parts (from the language on), and, in rows without
    counts, the phrases that an extension by one word equals in number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(longest + 1, dtype=np.int64)  # the count last seen of each length
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, f = batch.column(0), batch.column(1).to_numpy()
            own = ~batch.column(2).to_numpy(zero_copy_only=False)
            depth, _, stops = _table(keys, longest)
            counts = np.empty((len(f), longest + 1), dtype=np.int64)
            for k in range(longest + 1):
                at = np.maximum.accumulate(np.where(depth == k, np.arange(len(f)), -1))
                counts[:, k] = np.where(at >= 0, f[at], seen[k])
            seen = counts[-1].copy()
            turned = reversed_key if reverse else bytes
            rows = [
                (turned(keys[i].as_py()), counts[i, : depth[i] + 1].tolist(), False)
                for i in np.flatnonzero(own & (depth >= 2)).tolist()
            ]
            shorter = counts[np.arange(len(f)), depth - 1]
            rows += [
                (turned(keys[i].as_py()[: stops[i, depth[i] - 1]]), None, True)
                for i in np.flatnonzero(own & (depth >= 3) & (f >= shorter)).tolist()
            ]
            yield _batch(rows, MERGED)

    return run


def _in_order(phrases: DataFrame, reverse: bool, longest: int) -> DataFrame:
    dealt_schema = "part int, key binary, f long, copied boolean"
    rows = phrases.select("key", "f")
    cuts = _cuts(rows.mapInArrow(_dealt(reverse, []), dealt_schema))
    dealt = rows.mapInArrow(_dealt(reverse, cuts), dealt_schema)
    dealt = dealt.repartitionById(partitions(phrases.sparkSession), "part").sortWithinPartitions("key")
    return dealt.select("key", "f", "copied").mapInArrow(
        _merged(reverse, longest), "key binary, counts array<long>, held boolean"
    )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [k.as_py().split(END, 1) for k in batch.column(0)]
        columns = [pa.array([lang_of(p[0]) for p in parts], pa.string())]
        columns.append(pa.array([phrase_of(p[1]) for p in parts], pa.string()))
        yield pa.RecordBatch.from_arrays(
            [*columns, *batch.columns[1:]], names=["lang", "phrase", *batch.schema.names[1:]]
        )


def candidates(docs: DataFrame, rule: PhraseRule = PhraseRule()) -> DataFrame:
    """lang, phrase, a, l, r, n and score of every phrase that no longer one holds as often.

    A null language is ``und``, a null text empty. Ids and other columns are not read, repeated rows count
    each time, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    found = _phrases(docs, 2, 1, rule.least)
    if rule.longest > 2:
        pairs = spark.sparkContext.broadcast(pair_map(found))
        found = found.unionByName(_phrases(docs, rule.longest, 3, rule.least, pairs))
    front = _in_order(found, False, rule.longest).withColumnRenamed("counts", "lefts")
    back = _in_order(found, True, rule.longest).withColumnRenamed("counts", "rights")
    both = front.unionByName(back, allowMissingColumns=True).groupBy("key")
    both = both.agg(F.max("lefts").alias("lefts"), F.max("rights").alias("rights"), F.max("held").alias("held"))
    exact = "cast({} as decimal(38,0))".format
    of_cut = f"""transform(sequence(1, size(lefts) - 2), k -> named_struct(
        'score', ({rule.scale} * {exact("a")} * {exact("n")})
            div ({exact("get(lefts, k)")} * {exact("get(rights, size(lefts) - 1 - k)")}),
        'k', k, 'l', get(lefts, k), 'r', get(rights, size(lefts) - 1 - k)))"""
    scored = both.filter(~F.col("held")).select(
        "key", "lefts", "rights", F.element_at("lefts", -1).alias("a"), F.get("lefts", F.lit(0)).alias("n")
    )
    scored = scored.withColumn("cut", F.array_min(F.expr(of_cut)))
    rows = scored.select("key", "a", "cut.l", "cut.r", "n", "cut.score")
    schema = "lang string, phrase string, a long, l long, r long, n long, score long"
    return rows.mapInArrow(_decoded, schema)


def collocations(docs: DataFrame, rule: PhraseRule = PhraseRule()) -> DataFrame:
    """The first ``top`` phrases of each language by score, then count, then phrase; see ``candidates``."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = candidates(docs, rule)
    # First inside parts of a language, so that no task has to sort a language's phrases.
    part = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    within = Window.partitionBy("lang", "part").orderBy(*order)
    rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(within))
    rows = rows.filter(F.col("rank") <= rule.top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = rows.withColumn("rank", rank).filter(F.col("rank") <= rule.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
