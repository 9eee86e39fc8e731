"""Language-model scores of whole documents.

Tokens are lower-cased words and one end per document. Two scores come out: a base score from the
counts of all training tokens, and the score of a gated recurrent network (``gru``) that reads the whole
document, its state carried from window to window.

The network's outcomes are the most frequent words, the end, and ``SHAPES`` groups of all other words,
by a hash of their last bytes. A word outside the vocabulary has the probability of its group times its
own smoothed share of the group's tokens, (c + 1) / (sum of c + 1 over the group, plus 1 for unseen
ones), so every text has a probability.

What is gathered from the corpus covers every training document:

1. Each task counts its words; counts meet by a hash of the word. Out come the number of tokens, of
   distinct words, the groups' sizes and the most frequent words with their counts.
2. The network starts from the frequencies of all outcomes in all documents, and from weights that the
   driver learns from a bounded sample: ``train_documents`` documents, the first in order of a hash of
   their ids, of each at most ``train_segments`` segments spread over the text. From there it learns
   from the whole text of every training document: a hash deals them to ``passes``, and in each pass
   every task goes once over its documents of the pass, from the weights all tasks share. The means of
   the tasks' weights, by their numbers of tokens, are shared in the next pass.
3. Each task scores its documents and sends its other words, with the documents they are in, to the
   bucket of the word. There the exact count of each is known, and sums per document go back.

No list of words but the vocabulary is ever in one place.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm import gru
from sessionloom.llm.common import stored, text_key, whole_text

SHAPES = gru.MEMBERS
VOCABULARY = gru.OUTCOMES - SHAPES - 1
END = SHAPES  # outcomes: the groups, the end, the words
BUCKET_BYTES = 24_000_000
BATCH_BYTES = 12_000_000
SEGMENT = 256


@dataclass(frozen=True)
class LmRule:
    train_documents: int = 800
    train_segments: int = 6
    steps: int = 700
    passes: int = 4
    rate: float = 0.004
    folds: int = 7
    held_out: int = 2


def shape(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SHAPES


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: only A-Z change, and only the six blanks split


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``tokens`` of many texts: a number for every token, the words by number, how many each text has."""
    # Texts are taken as they are, valid UTF-8 or not: the two functions change and split bytes. They are
    # copied first, since ascii_lower misreads arrays whose bytes begin after their buffer's first.
    large = pa.types.is_large_binary(texts.type)
    copied = texts.take(pa.array(np.arange(len(texts)))).view(pa.large_string() if large else pa.string())
    found = pc.ascii_split_whitespace(pc.ascii_lower(copied))
    lengths = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
    every = found.flatten().dictionary_encode()
    number, words = every.indices.to_numpy(), every.dictionary.cast(pa.string()).view(pa.binary())
    blank = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if blank >= 0:  # before a blank that a text begins with, after one that it ends with
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths -= np.bincount(owner[number == blank], minlength=len(lengths))
        number = number[number != blank]
        number = number - (number > blank)
        words = pa.concat_arrays([words[:blank], words[blank + 1 :]])
    return number, words, lengths


def _as_list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches whose texts hold a bounded number of bytes, one row at least."""
    for batch in batches:
        sizes = np.cumsum([len(v.as_buffer()) for v in batch.column(column)])
        at = 0
        while at < batch.num_rows:
            base = int(sizes[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + BATCH_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _fold(docs: DataFrame, rule: LmRule) -> DataFrame:
    remainder = F.pmod(
        F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(rule.folds)
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder == rule.held_out, F.lit(False)).alias("held_out"),
        F.coalesce(remainder != rule.held_out, F.lit(False)).alias("train"),
        whole_text("text").cast("binary").alias("text"),
    )


def _squeezed(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(arrays), *[len(a) for a in arrays]], dtype=np.int64).tobytes()
    body = b"".join([head, *[np.ascontiguousarray(a).tobytes() for a in arrays]])
    return zstandard.ZstdCompressor(level=3).compress(body)


def _spread_out(blob: bytes, dtypes: tuple) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    lengths = np.frombuffer(body, dtype=np.int64, count=len(dtypes), offset=8)
    at, out = 8 + 8 * len(dtypes), []
    for dtype, n in zip(dtypes, lengths):
        out.append(np.frombuffer(body, dtype=dtype, count=int(n), offset=at))
        at += int(n) * np.dtype(dtype).itemsize
    return out


def _text(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b" ".join(words), dtype=np.uint8)


# --- 1. counts ----------------------------------------------------------------------------------

_COUNT_BLOB = (np.uint8, np.int64)
COUNT_SCHEMA = "kind int, word binary, a long, b long"
_TOP, _TOTAL, _SHAPE = 0, 1, 2


def _count_blobs(buckets: int):
    def flushed(counts: Counter) -> pa.RecordBatch:
        parts: list[list[bytes]] = [[] for _ in range(buckets)]
        for w in counts:
            parts[zlib.crc32(w) % buckets].append(w)
        rows = [
            (no, _squeezed([_text(ws), np.array([counts[w] for w in ws], dtype=np.int64)]))
            for no, ws in enumerate(parts)
            if ws
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["bucket", "blob"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in _batches(batches, 1):
            number, words, _ = _words(batch.column(1).filter(batch.column(0)))
            for w, k in zip(_as_list(words), np.bincount(number, minlength=len(words)).tolist()):
                counts[w] += k
            if len(counts) > 500_000:
                yield flushed(counts)
                counts = Counter()
        if counts:
            yield flushed(counts)

    return run


def _count_merged(table: pa.Table) -> pa.Table:
    counts: Counter = Counter()
    for blob in table.column("blob"):
        text, n = _spread_out(blob.as_py(), _COUNT_BLOB)
        for w, k in zip(text.tobytes().split(b" "), n.tolist()):
            counts[w] += k
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY]
    groups = np.zeros(SHAPES, dtype=np.int64)
    for w, k in counts.items():
        groups[shape(w)] += k + 1
    rows = [(_TOP, w, k, 0) for w, k in top]
    rows.append((_TOTAL, None, sum(counts.values()), len(counts)))
    rows += [(_SHAPE, None, s, int(n)) for s, n in enumerate(groups)]
    return pa.table(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(_COUNT_TYPES)],
        names=["kind", "word", "a", "b"],
    )


_COUNT_TYPES = (pa.int32(), pa.binary(), pa.int64(), pa.int64())


@dataclass
class Counts:
    """``words``: the vocabulary with counts. ``groups``: sum of c + 1 over the other words, plus 1."""

    words: list[tuple[bytes, int]]
    tokens: int
    distinct: int
    ends: int
    groups: np.ndarray

    def outcomes(self) -> dict[bytes, int]:
        return {w: END + 1 + i for i, (w, _) in enumerate(self.words)}

    def frequency(self) -> np.ndarray:
        out = np.zeros(gru.OUTCOMES)
        out[:SHAPES] = self.groups
        out[END] = self.ends
        out[END + 1 : END + 1 + len(self.words)] = [c for _, c in self.words]
        return out

    def log10_plus_1(self) -> np.ndarray:
        """log10(c + 1) per outcome; 0 for the groups, whose words have counts of their own."""
        out = np.log10(self.frequency() + 1)
        out[:SHAPES] = 0
        return out


def count_words(docs: DataFrame, rule: LmRule = LmRule()) -> Counts:
    """Exact counts over all training documents."""
    rows = _fold(docs, rule)
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(total / BUCKET_BYTES) + 1)
    blobs = rows.select("train", "text").mapInArrow(_count_blobs(buckets), "bucket int, blob binary")
    found = stored(blobs.groupBy("bucket").applyInArrow(_count_merged, COUNT_SCHEMA), "lm-counts")
    top = found.filter(F.col("kind") == _TOP).orderBy(F.desc("a"), "word").limit(VOCABULARY)
    words = [(bytes(r.word), r.a) for r in top.select("word", "a").collect()]
    n, v = found.filter(F.col("kind") == _TOTAL).agg(F.sum("a"), F.sum("b")).first()
    groups = np.ones(SHAPES, dtype=np.int64)
    per_shape = found.filter(F.col("kind") == _SHAPE).groupBy("a").agg(F.sum("b").alias("n"))
    for r in per_shape.collect():
        groups[r.a] += r.n
    for w, c in words:
        groups[shape(w)] -= c + 1
    ends = rows.filter("train").count()
    return Counts(words, (n or 0) + ends, (v or 0) + (ends > 0), ends, groups)


# --- 2. the network -----------------------------------------------------------------------------


class _Outcomes(dict):
    """Groups of words by the words' last bytes, kept until there are too many of them."""

    MOST = 300_000

    def __missing__(self, ending: bytes) -> int:
        group = shape(ending)
        if len(self) < self.MOST:
            self[ending] = group
        return group


def _outcomes(words: pa.Array, known: dict[bytes, int], groups: _Outcomes) -> np.ndarray:
    """The outcome of each word: its own or its group."""
    place = pc.index_in(words, value_set=pa.array([*known], pa.binary()))
    out = np.array([*known.values(), 0], dtype=np.int64)[place.fill_null(len(known)).to_numpy()]
    others = place.is_null()
    endings = pc.binary_slice(words.filter(others), -3, None).dictionary_encode()
    of = np.array([groups[e] for e in _as_list(endings.dictionary)], dtype=np.int64)
    out[others.to_numpy(zero_copy_only=False)] = of[endings.indices.to_numpy()]
    return out


def _outcome_arrays(
    texts: list[bytes] | pa.Array, known: dict[bytes, int], groups: _Outcomes | None = None
) -> list[np.ndarray]:
    number, words, lengths = _words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
    outcomes = _outcomes(words, known, _Outcomes() if groups is None else groups)
    flat, lengths = _with_ends(outcomes[number], lengths)
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _with_ends(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outcomes of all texts with an end after each text, and the texts' lengths with it."""
    out = np.full(len(flat) + len(lengths), END, dtype=np.int64)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = flat
    return out, lengths + 1


def _segments(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(0):
                words = t.as_py().split()
                starts = np.arange(0, max(1, len(words)), SEGMENT)
                if len(starts) > most:
                    starts = starts[np.linspace(0, len(starts) - 1, most).round().astype(int)]
                texts.append(b" ".join([w for s in starts for w in words[s : s + SEGMENT]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.binary()), *batch.columns[1:]], names=batch.schema.names
            )

    return run


def started(docs: DataFrame, counts: Counts, rule: LmRule = LmRule()) -> gru.Model:
    """The network before its passes, learned from the documented sample of the training documents."""
    rows = _fold(docs, rule)
    ids = rows.filter("train").select(F.col("doc_id").alias("_id")).distinct()
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(rule.train_documents)
    rows = rows.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # Texts are cut to their segments where they are read; only those meet in one place.
    rows = rows.select("text", "_id", text_key("text").alias("text_key"))
    cut = rows.mapInArrow(_segments(rule.train_segments), "text binary, _id long, text_key long")
    sample = cut.orderBy(F.xxhash64("_id"), "_id", "text_key").limit(rule.train_documents)
    texts = [bytes(r.text) for r in sample.select("text").collect()]
    sequences = _outcome_arrays(texts, counts.outcomes())
    return gru.train(sequences, counts.frequency(), rule.steps)


WEIGHT_SCHEMA = "slice int, task int, tokens long, weights binary"
_SLICE = 1 << 16  # weights in one row
_MERGE = 64  # tasks whose weights meet in one place


def _learned(model: gru.Model, counts: Counts, rate: float):
    known = counts.outcomes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        groups = _Outcomes()
        texts = (_outcome_arrays(rows.column(0), known, groups) for rows in _batches(batches, 0))
        own, n = gru.learn(model, texts, rate)
        if n:
            yield _weight_rows(_flat(own), n, TaskContext.get().partitionId())

    return run


def _flat(model: gru.Model) -> np.ndarray:
    return np.concatenate([model[k].reshape(-1) for k in sorted(model)])


def _weight_rows(flat: np.ndarray, n: int, task: int) -> pa.RecordBatch:
    parts = [flat[at : at + _SLICE].tobytes() for at in range(0, len(flat), _SLICE)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(parts)), pa.int32()),
            pa.array([task] * len(parts), pa.int32()),
            pa.array([n] * len(parts), pa.int64()),
            pa.array(parts, pa.binary()),
        ],
        names=["slice", "task", "tokens", "weights"],
    )


def _weights_merged(table: pa.Table) -> pa.Table:
    """The mean of a slice's weights by numbers of tokens, in order of tasks."""
    rows = sorted(table.to_pylist(), key=lambda r: r["task"])
    n = sum(r["tokens"] for r in rows)
    mean = sum(np.frombuffer(r["weights"], np.float32) * (r["tokens"] / n) for r in rows)
    first = rows[0]
    return pa.table(
        {
            "slice": pa.array([first["slice"]], pa.int32()),
            "task": pa.array([first["task"] // _MERGE], pa.int32()),
            "tokens": pa.array([n], pa.int64()),
            "weights": pa.array([mean.astype(np.float32).tobytes()], pa.binary()),
        }
    )


def fit(docs: DataFrame, counts: Counts, rule: LmRule = LmRule()) -> gru.Model:
    """Learn the network from the whole texts of all training documents."""
    model = started(docs, counts, rule)
    rows = _fold(docs, rule).filter("train")
    turn = F.pmod(F.xxhash64("doc_id", text_key("text")), F.lit(rule.passes))
    for no in range(rule.passes):
        rate = rule.rate * (1 - no / rule.passes)
        texts = rows.filter(turn == no).select("text")
        found = stored(texts.mapInArrow(_learned(model, counts, rate), WEIGHT_SCHEMA), "lm-weights")
        most = found.agg(F.max("task")).first()[0]
        if most is None:
            continue
        while most > 0:
            found = found.groupBy("slice", F.floor(F.col("task") / _MERGE).alias("part"))
            found = found.applyInArrow(_weights_merged, WEIGHT_SCHEMA)
            most //= _MERGE
        slices = [bytes(r.weights) for r in found.orderBy("slice").select("weights").collect()]
        flat, at = np.frombuffer(b"".join(slices), np.float32), 0
        for k in sorted(model):
            model[k] = flat[at : at + model[k].size].reshape(model[k].shape).copy()
            at += model[k].size
    return model


# --- 3. scores ----------------------------------------------------------------------------------

_DOC_BLOB = (np.int64, np.uint8, np.uint8, np.int64, np.int64, np.float64, np.float64)
# A bucket's words with the documents they are in; of a batch only documents that occur there are named.
_WORD_BLOB = (np.uint8, np.int32, np.int32, np.int32, np.int32, np.uint8)
_SUM_BLOB = (np.int32, np.float64, np.int64)
SCORE_SCHEMA = "bucket int, batch long, blob binary"


def _score_blobs(model: gru.Model, counts: Counts, buckets: int):
    known = counts.outcomes()
    plus_1 = counts.log10_plus_1()
    group_log = np.log10(counts.groups.astype(np.float64))
    has_count = counts.frequency() > 0
    groups = _Outcomes()

    def scored(ids: list, held: list, train: list, texts: pa.Array, batch: int) -> pa.RecordBatch:
        number, words, lengths = _words(texts)
        outcome = _outcomes(words, known, groups)
        other = outcome < SHAPES
        names = _as_list(words.filter(pa.array(other)))
        rare = other[number]
        words_of = (np.cumsum(other) - 1)[number[rare]]
        docs_of = np.repeat(np.arange(len(texts)), lengths)[rare]
        flat, lengths = _with_ends(outcome[number], lengths)
        owner = np.repeat(np.arange(len(texts)), lengths)
        sequences = np.split(flat, np.cumsum(lengths)[:-1])
        logs = gru.score(model, sequences) / np.log(10)
        n = len(texts)
        in_group = flat < SHAPES
        base = np.bincount(owner, plus_1[flat], n)
        # Words outside the vocabulary: their groups' sizes here, their own counts in the buckets.
        logs -= np.bincount(owner[in_group], group_log[flat[in_group]], n)
        seen = np.bincount(owner, has_count[flat] & ~in_group, n).astype(np.int64)
        rows = [
            (
                -1,
                _squeezed(
                    [
                        np.array([i if i is not None else 0 for i in ids], dtype=np.int64),
                        np.array([i is None for i in ids], dtype=np.uint8),
                        np.array(held, dtype=np.uint8),
                        lengths.astype(np.int64),
                        seen,
                        base,
                        logs,
                    ]
                ),
            )
        ]
        rows += _word_blobs(names, words_of, docs_of, np.array(train, dtype=np.uint8), n)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([batch] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
            ],
            names=["bucket", "batch", "blob"],
        )

    def _word_blobs(
        names: list[bytes], ids: np.ndarray, doc: np.ndarray, train: np.ndarray, n: int
    ):
        bucket = np.array([zlib.crc32(w) % buckets for w in names], dtype=np.int64)
        place = np.argsort(bucket, kind="stable")
        rank = np.empty(len(names), dtype=np.int64)
        rank[place] = np.arange(len(names))
        # One entry per (word, document), with how often it occurs there.
        entry, times = np.unique(rank[ids] * n + doc, return_counts=True)
        word, of = entry // n, entry % n
        per_word = np.bincount(word, minlength=len(names))
        end = np.cumsum(per_word)
        found, lo = np.unique(bucket[place], return_index=True)
        for no, a, b in zip(found, lo, np.append(lo[1:], len(names))):
            s = slice(int(end[a] - per_word[a]), int(end[b - 1]))
            docs, local_doc = np.unique(of[s], return_inverse=True)
            yield (
                int(no),
                _squeezed(
                    [
                        _text([names[k] for k in place[a:b]]),
                        per_word[a:b].astype(np.int32),
                        np.diff(local_doc, prepend=0).astype(np.int32),
                        times[s].astype(np.int32),
                        docs.astype(np.int32),
                        train[docs],
                    ]
                ),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        for rows in _batches(batches, 3):
            columns = [c.to_pylist() for c in rows.columns[:3]]
            yield scored(*columns, rows.column(3), batch)
            batch += 1

    return run


def _word_sums(table: pa.Table) -> pa.Table:
    """Exact counts of a bucket's words; per batch of documents, sums over its documents' words."""
    ids: dict[bytes, int] = {}
    parts = []
    for batch, blob in zip(table.column("batch"), table.column("blob")):
        text, per_word, step, times, docs, train = _spread_out(blob.as_py(), _WORD_BLOB)
        words = [ids.setdefault(w, len(ids)) for w in text.tobytes().split(b" ")]
        word = np.repeat(np.array(words, dtype=np.int64), per_word)
        parts.append((batch.as_py(), word, np.cumsum(step, dtype=np.int64), times, docs, train))
    count = np.zeros(len(ids), dtype=np.int64)
    for _, word, doc, times, _, train in parts:
        count += np.bincount(word, times * train[doc], len(ids)).astype(np.int64)
    log = np.log10(count + 1.0)
    rows = []
    for batch, word, doc, times, docs, train in parts:
        sums = np.bincount(doc, log[word] * times, len(train))
        seen = np.bincount(doc, (count[word] > 0) * times, len(train)).astype(np.int64)
        rows.append((batch, _squeezed([docs, sums, seen])))
    return pa.table(
        {
            "bucket": pa.array([0] * len(rows), pa.int32()),
            "batch": pa.array([r[0] for r in rows], pa.int64()),
            "blob": pa.array([r[1] for r in rows], pa.binary()),
        }
    )


def _finished(counts: Counts):
    space = np.log10(counts.tokens + counts.distinct + 1.0)

    def run(table: pa.Table) -> pa.Table:
        own, parts = None, []
        for bucket, blob in zip(table.column("bucket"), table.column("blob")):
            if bucket.as_py() < 0:
                own = _spread_out(blob.as_py(), _DOC_BLOB)
            else:
                parts.append(_spread_out(blob.as_py(), _SUM_BLOB))
        ids, null, held, n, known, base, logs = own
        sums, seen = np.zeros(len(n)), np.zeros(len(n), dtype=np.int64)
        if parts:
            # Always the same order of additions, whatever order the buckets come in.
            docs, part_sums, part_seen = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((part_sums, docs))
            sums = np.bincount(docs[order], part_sums[order], len(n))
            seen = np.bincount(docs, part_seen, len(n)).astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=null.astype(bool)),
                "held_out": pa.array(held.astype(bool)),
                "n_tokens": pa.array(n),
                "n_known": pa.array(known + seen),
                "train_tokens": pa.array(np.full(len(n), counts.tokens, dtype=np.int64)),
                "base_score": pa.array(base + sums - n * space),
                "score": pa.array(logs + sums),
            }
        )

    return run


def scored(docs: DataFrame, counts: Counts, model: gru.Model, rule: LmRule = LmRule()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A null or empty text is the end alone. A null id is neither held out nor learned from. Rows that
    repeat an id are scored one by one; other columns are not read; an empty table gives no rows.
    """
    rows = _fold(docs, rule)
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(total / BUCKET_BYTES) + 1)
    blobs = stored(
        rows.mapInArrow(_score_blobs(model, counts, buckets), SCORE_SCHEMA), "lm-scores"
    )
    words = blobs.filter(F.col("bucket") >= 0).groupBy("bucket")
    sums = words.applyInArrow(_word_sums, SCORE_SCHEMA)
    every = blobs.filter(F.col("bucket") < 0).unionByName(sums)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return every.groupBy("batch").applyInArrow(_finished(counts), schema)


def score_documents(docs: DataFrame, rule: LmRule = LmRule()) -> DataFrame:
    """Count, learn and score; see ``scored``."""
    counts = count_words(docs, rule)
    return scored(docs, counts, fit(docs, counts, rule), rule)
