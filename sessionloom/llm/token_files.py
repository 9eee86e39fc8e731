"""Token ids as ORC files.

The folder holds ``data`` (one row per document in ascending order of ids: its token ids as an integer
array, their number, and their place in the file) and ``index`` (one row per file: ids and tokens in
it, and the tokens before it). ORC keeps integers as run lengths, a row index per ``row_stride`` rows
and Bloom filters on the document id, so a reader skips files, stripes and row groups that cannot hold
what it asks for, and stripes of one file are read by different tasks.

Texts are range-partitioned by id once; each task encodes its texts and writes its file. The place of
a file's first token is a sum over the index, which has one row per file.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import partitions, text_key, whole_text
from sessionloom.llm.words import split_words, text_bytes, word_codes

BATCH_BYTES = 5_000_000
#: A remembered word takes about 200 bytes, so each half of the memory takes 40 MB at most.
CACHED_WORDS = 200_000
WORDS_AT_ONCE = 200
# ASCII punctuation but for what may be part of a token together with letters: ' < > |
PUNCTUATION = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_IS_MARK = np.isin(np.arange(256), list(PUNCTUATION.encode()))
_IS_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_LOWER = np.array([ord(chr(i).lower()) if i < 128 else i for i in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class TokenFormat:
    """``tokenizer``: path of a file of the tokenizers library, readable on every executor."""

    tokenizer: str
    end_id: int = 1
    stripe_bytes: int = 16 << 20
    row_stride: int = 1_000
    bloom_share: float = 0.01


_ENCODERS: dict[str, "_Encoder"] = {}


class _Encoder:
    """Encodes texts word by word and remembers words.

    No token spans a space: the tokenizer must treat the six ASCII blanks as borders, which the first lines
    try. One that marks word ends and lowers case also lets words be cut between ASCII letters and
    punctuation, and lowered, before they are looked up, so far fewer of them are new. Memory is bounded:
    when it is full, only words of late are kept.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.ends = self._word_ends()
        trial = b"so it\tis\n\x0b x1's\r\x0c  eNd. (The)--IT'S 'a,b'c!!'s"
        whole = self._each([trial.decode()])[0]
        if b"".join(self._each([w.decode() for w in trial.split()])) != whole:
            raise ValueError("this tokenizer has tokens that span blanks")
        self.finer = self.ends is not None
        if self.finer:
            self.finer = self(pa.array([trial], pa.binary()), 0)[0][:-1].tobytes() == whole

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a piece of text; None if this kind of tokenizer does not mark them."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return ends

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word. Words of letters, with punctuation after them or not, go in lines of many
        at once: such a word ends where its last piece does, so the line's ids can be told apart."""
        if self.ends is None:
            return self._each([w.decode("utf-8", "replace") for w in words])
        try:
            text = pa.array(words, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8: the slow way for the words of this batch
            return self._each([w.decode("utf-8", "replace") for w in words])
        core = pc.utf8_rtrim(text, characters=PUNCTUATION)
        plain = pc.utf8_is_alpha(pc.utf8_lower(core)).to_numpy(zero_copy_only=False)
        pieces = np.where(pc.equal(core, text).to_numpy(zero_copy_only=False), 1, 2)[plain]
        out = np.empty(len(words), dtype=object)
        odd = text.filter(pa.array(~plain)).to_pylist()
        out[~plain] = _objects(self._each(odd))
        texts = text.filter(pa.array(plain)).to_pylist()
        lines = range(0, len(texts), WORDS_AT_ONCE)
        joined = [" ".join(texts[a : a + WORDS_AT_ONCE]) for a in lines]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        parts: list[bytes] = []
        for a, line in zip(lines, found):
            ids = np.array(line.ids, dtype="<u4")
            last = np.cumsum(pieces[a : a + WORDS_AT_ONCE])
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != last[-1]:  # some word is in other pieces than it seems
                parts += self._each(texts[a : a + WORDS_AT_ONCE])
            else:
                cut, data = (4 * stop[last - 1]).tolist(), ids.tobytes()
                parts += [data[x:y] for x, y in zip([0, *cut[:-1]], cut)]
        out[plain] = _objects(parts)
        return out.tolist()

    @staticmethod
    def has_special(data: np.ndarray) -> bool:
        """Whether <| occurs: special tokens are matched before case is lowered."""
        return bool(((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any())

    def _lookup(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        new = [w for w in words if w not in self.known]
        again = [w for w in new if w in self.older]
        if len(self.known) + len(new) > CACHED_WORDS:
            # The words of late stay as the older half; what is used again moves back up.
            kept = {w: self.known[w] for w in words if w in self.known}
            kept.update((w, self.older[w]) for w in again)
            self.known, self.older = kept, self.known
        else:
            self.known.update((w, self.older[w]) for w in again)
        rest = [w for w in new if w not in self.known]
        self.known.update(zip(rest, self._encoded(rest)))
        return [self.known[w] for w in words]

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each ended by ``end_id``, and how many each has."""
        data, ends = text_bytes(texts)
        cut = None
        if self.finer:
            mark, letter = _IS_MARK[data], _IS_LETTER[data]
            cut = np.zeros(len(data), dtype=bool)
            cut[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
            if not self.has_special(data):
                data = _LOWER[data]
        letters, count, doc = split_words(data, ends, cut)
        codes, words = word_codes(letters, count)
        packed = [*self._lookup(words), _packed([end_id])]
        size = np.array([len(p) // 4 for p in packed], dtype=np.int64)
        flat, start = np.frombuffer(b"".join(packed), dtype="<u4"), np.cumsum(size) - size
        # The words of all texts, with an end after those of each.
        n = np.bincount(doc, minlength=len(texts))
        order = np.full(len(codes) + len(texts), len(words), dtype=np.int64)
        order[np.arange(len(codes)) + doc] = codes
        times = size[order]
        at = np.repeat(start[order] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        owner = np.repeat(np.arange(len(texts)), n + 1)
        return flat[at], np.bincount(owner, times, len(texts)).astype(np.int64)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:  # kept by the worker process for its next tasks
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes in a column, one row at least."""
    sizes = np.cumsum(
        [len(x) if (x := v.as_buffer()) is not None else 0 for v in batch.column(column)]
    )
    at = 0
    while at < batch.num_rows:
        base = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + BATCH_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _encode(form: TokenFormat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = _encoder(form.tokenizer)
        part = TaskContext.get().partitionId()
        place = 0
        for whole in batches:
            for batch in _slices(whole, 1):
                ids, sizes = encode(batch.column(1), form.end_id)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.array(ids.view(np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(sizes), part, dtype=np.int32)),
                        pa.array(place + offsets[:-1].astype(np.int64)),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets), ids),
                    ],
                    names=["doc_id", "file", "place", "n_tokens", "ids"],
                )
                place += int(offsets[-1])
        pa.default_memory_pool().release_unused()

    return run


def write_tokens(docs: DataFrame, path: str, form: TokenFormat) -> None:
    """Encode every whole text, end it with ``end_id`` and write the files.

    A null text is empty and gives the end id alone. Null ids come first; rows that repeat an id are
    ordered by a hash of their text, and wholly equal rows follow one another. An empty table gives
    files without rows. Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text("text").cast("binary").alias("text"),
        text_key("text").alias("text_key"),
    )
    order = ["doc_id", "text_key"]
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), *order)
    schema = "doc_id long, file int, place long, n_tokens long, ids array<int>"
    tokens = dealt.sortWithinPartitions(*order).mapInArrow(_encode(form), schema)
    (
        tokens.write.option("compression", "zstd")
        .option("orc.stripe.size", form.stripe_bytes)
        .option("orc.row.index.stride", form.row_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", form.bloom_share)
        .orc(f"{path}/data")
    )
    spark = docs.sparkSession
    files = (
        _data(spark, path)
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum("n_tokens").alias("tokens"),
            F.min("doc_id").alias("least_id"),
            F.max("doc_id").alias("largest_id"),
        )
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")
    files.select("*", start).coalesce(1).write.orc(f"{path}/index")


def _data(spark: SparkSession, path: str) -> DataFrame:
    schema = "doc_id long, file int, place long, n_tokens long, ids array<int>"
    return spark.read.schema(schema).orc(f"{path}/data")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per file."""
    schema = "file int, docs long, tokens long, least_id long, largest_id long, start long"
    return spark.read.schema(schema).orc(f"{path}/index")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document.

    A filter on ``doc_id`` reaches the files' statistics and Bloom filters. The index has one row per
    file that some task wrote, so it may be broadcast.
    """
    index = read_index(spark, path).select(F.col("file").alias("_file"), F.col("start").alias("_start"))
    rows = _data(spark, path).join(F.broadcast(index), F.col("file") == F.col("_file"))
    return rows.select("doc_id", (F.col("_start") + F.col("place")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        ids = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
        crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
        sizes = np.diff(offsets).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(sizes), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit numbers, as read."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_tokens(spark, path).mapInArrow(_checksums, schema)
