"""Document fingerprints: a homomorphic multiset hash of a document's paragraphs.

A paragraph is a line; long lines are cut at sentence ends. Each paragraph is hashed to a wide vector,
and the fingerprint is the sum of the vectors, lane by lane, modulo a power of two. So it does not
depend on the order of paragraphs, and paragraphs are inserted into or deleted from a fingerprint by
adding or subtracting their vectors, without the rest of the document.

A vector has two parts. All ``WIDE`` lanes of 64 bits are set by every paragraph; they tell equal from
unequal multisets. Then come ``LEVELS`` rows of ``CELLS`` lanes of 16 bits, of which a paragraph sets one
cell per level it belongs to: level k holds one paragraph in 4**k, chosen by hash. The cells are sums
too; they make fingerprints comparable. Two documents agree in a cell if they hold the same
paragraphs there, so the share of agreeing cells, taken at the level where cells are sparse, tells how
much of their paragraphs they share. The last level, one paragraph in 4**13, is sparse for a billion
different paragraphs, more than fit a row.

The edited text of a document needs the one after it in order of ids. Documents are dealt to ranges
of ids; of each range only the first document goes to the range before it as well, so texts are
shuffled once.
"""

from __future__ import annotations

import hashlib
import re
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import partitions, text_key, whole_text

WIDE, LEVELS, CELLS = 8, 14, 32
LONG_LINE = 200
_SENTENCE = re.compile(rb"(?<=[.!?]) +")
_LANES = WIDE + LEVELS * CELLS
_BYTES = WIDE * 8 + LEVELS * CELLS * 2


def paragraphs(text: bytes) -> list[bytes]:
    """Lines without blanks at their ends, long ones in sentences; empty ones do not count."""
    out = []
    for line in text.split(b"\n"):
        line = line.strip()
        if len(line) > LONG_LINE:
            out += _SENTENCE.split(line)
        elif line:
            out.append(line)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def vectors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each paragraph its wide lanes, and for each level its cell (-1: none) and its value there."""
    digest = b"".join([hashlib.blake2b(p, digest_size=16).digest() for p in parts])
    seed = np.frombuffer(digest, dtype="<u8").reshape(-1, 2)
    lane = np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wide = _mix(seed[:, :1] + lane) + _mix(seed[:, 1:] ^ lane)
    return wide, seed


def cells(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, lane (level * CELLS + cell) and value of every cell that the paragraphs set."""
    rows, lanes, values = [], [], []
    pick = _mix(seed[:, 0] + np.uint64(7))
    for level in range(LEVELS):
        row = np.flatnonzero(pick & np.uint64(4**level - 1) == 0)
        own = _mix(seed[row, 1] + np.uint64(level + 1))
        rows.append(row)
        lanes.append((level * CELLS + (own & np.uint64(CELLS - 1)).astype(np.int64)))
        values.append((own >> np.uint64(40)).astype(np.uint16) | np.uint16(1))
    return np.concatenate(rows), np.concatenate(lanes), np.concatenate(values)


def fingerprints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Wide lanes (uint64) and cells (uint16) of each text."""
    split = [paragraphs(t) for t in texts]
    count = np.array([len(s) for s in split], dtype=np.int64)
    wide, seed = vectors([p for s in split for p in s])
    doc = np.repeat(np.arange(len(texts)), count)
    sums = np.zeros((len(texts), WIDE), dtype=np.uint64)
    held = np.flatnonzero(count)
    if len(held):
        sums[held] = np.add.reduceat(wide, (np.cumsum(count) - count)[held], axis=0)
    low = np.zeros(len(texts) * LEVELS * CELLS, dtype=np.int64)
    row, lane, value = cells(seed)
    np.add.at(low, doc[row] * (LEVELS * CELLS) + lane, value.astype(np.int64))
    return sums, (low % 65536).astype(np.uint16).reshape(len(texts), -1)


def inserted(fingerprint: str, parts: list[bytes], sign: int = 1) -> str:
    """The fingerprint after paragraphs have come (``sign`` 1) or gone (-1), in any order."""
    wide, low = decoded(fingerprint)
    added, cell = fingerprints([b"\n".join(parts)])
    wide = wide + added[0] if sign > 0 else wide - added[0]
    low = low + cell[0] if sign > 0 else low - cell[0]
    return encoded(wide[None], low[None])[0]


def encoded(wide: np.ndarray, low: np.ndarray) -> list[str]:
    rows = np.concatenate([wide.astype("<u8").view(np.uint8), low.astype("<u2").view(np.uint8)], axis=1)
    return [r.tobytes().hex() for r in rows]


def decoded(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: WIDE * 8], dtype="<u8"), np.frombuffer(raw[WIDE * 8 :], dtype="<u2")


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1 for equal fingerprints; else the share of agreeing cells among those either one has set.

    Taken at the first level where at most half of the cells are set; below 1 if the wide lanes differ.
    """
    equal = (a[0] == b[0]).all(axis=1)
    x, y = (v.reshape(-1, LEVELS, CELLS) for v in (a[1], b[1]))
    either = ((x != 0) | (y != 0)).sum(axis=2)
    both = ((x == y) & (x != 0)).sum(axis=2)
    # The first sparse level; if that one is empty, the last one that is not.
    level = np.argmax(either <= CELLS // 2, axis=1)
    level = np.where((either > CELLS // 2).all(axis=1), LEVELS - 1, level)
    row = np.arange(len(x))
    level = np.where(either[row, level] > 0, level, np.maximum(level - 1, 0))
    n = either[row, level]
    share = np.where(n > 0, both[row, level] / np.maximum(n, 1), 0.0)
    return np.where(equal, 1.0, np.minimum(share, 1 - 1 / 64))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text's first ones."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# --- over a table -------------------------------------------------------------------------------

BATCH = 256


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (range, guest, order of ids); a range's last row is the guest from the next one."""
    held: list[tuple[int | None, str, int]] = []
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            held += [
                (i.as_py(), t.as_py().decode("utf-8", "replace"), r.as_py())
                for i, t, r in zip(batch.column(0), batch.column(1), batch.column(2))
            ]
            if len(held) > BATCH:
                yield _pairs(held)
                held = held[-1:]
    if len(held) > 1:
        yield _pairs(held)


def _pairs(rows: list[tuple[int | None, str, int]]) -> pa.RecordBatch:
    """One result per row whose follower is in the same range."""
    known = fingerprints([t.encode() for _, t, _ in rows])
    own = [k for k in range(len(rows) - 1) if rows[k][2] == rows[k + 1][2]]
    new = [edited(rows[k][1], rows[k + 1][1]).encode() for k in own]
    changed = fingerprints(new)
    mine = (known[0][own], known[1][own])
    after = [k + 1 for k in own]
    follower = (known[0][after], known[1][after])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[k][0] for k in own], pa.int64()),
            pa.array([len(rows[k][1]) for k in own], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in new], pa.string()),
            pa.array(encoded(*mine), pa.string()),
            pa.array(encoded(*changed), pa.string()),
            pa.array(likeness(mine, changed), pa.float64()),
            pa.array(likeness(mine, follower), pa.float64()),
        ],
        names=[
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            "near_edited",
            "near_next",
        ],
    )


REPORT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            found = encoded(*fingerprints([t.as_py() for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"]
            )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; a null or empty text has the fingerprint of nothing (zeros).

    Needs no shuffle. Null ids are kept, rows that repeat an id are rows of their own, other columns
    are not read, and an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(_fingerprint_rows, "doc_id long, fingerprint string")


def _larger(cuts: list[int], value: Column) -> Column:
    """How many of the descending cuts are larger than the value: first by every so many-th cut, then among the
    cuts that follow, so that a row is compared with about twice the root of their number."""
    step = math.isqrt(len(cuts)) + 1
    none = F.array().cast("array<long>")
    every, some = (F.array(*[F.lit(c).cast("long") for c in x]) if x else none for x in (cuts, cuts[step - 1 :: step]))
    passed = F.size(F.filter(some, lambda c: c > value)) * step
    return passed + F.size(F.filter(F.slice(every, passed + 1, step), lambda c: c > value))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The next document is the one with the next smaller id; after the last comes the first. Null ids come
    after all others, rows that repeat an id follow one another by a hash of their text, and a single
    row is its own next one. Null texts are empty. An empty table gives no rows; other columns are not
    read.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text("text").cast("binary").alias("text"),
        (-text_key("text").bitwiseAND(F.lit((1 << 62) - 1))).alias("turn"),
    )
    cuts = rows.select("doc_id").stat.approxQuantile(
        "doc_id", [i / n for i in range(1, n)], 0.2 / n
    )
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    # Descending ids are ranges 0, 1, ...: how many of the cuts are larger than the id.
    range_no = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(_larger(cuts, F.col("doc_id")))
    dealt = rows.withColumn("range", range_no.cast("int"))
    # The first row of each range, in (id descending, null last, turn descending).
    first = F.max(F.struct(F.col("doc_id"), F.col("turn"))).alias("first")
    heads = dealt.drop("text").groupBy("range").agg(first).orderBy("range").collect()
    if not heads:
        return spark.createDataFrame([], REPORT_SCHEMA)
    guests = [
        (before.range, h.first.doc_id, h.first.turn)
        for before, h in zip([heads[-1], *heads[:-1]], heads)
    ]
    guests = spark.createDataFrame(guests, "_range int, _id long, _turn long")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("turn") == F.col("_turn"))
    copies = (
        rows.join(F.broadcast(guests), same)
        .dropDuplicates(["_range"])
        .select("doc_id", "text", "turn", F.col("_range").alias("range"), F.lit(1).alias("guest"))
    )
    every = dealt.withColumn("guest", F.lit(0)).unionByName(copies)
    order = ["range", "guest", F.desc_nulls_last("doc_id"), F.desc("turn")]
    placed = every.repartitionById(n, F.col("range")).sortWithinPartitions(*order)
    return placed.select("doc_id", "text", "range").mapInArrow(_report, REPORT_SCHEMA)
