"""SimHash near-dedup with pivot distance tables.

A document's fingerprint has 64 bits; two documents are linked if theirs differ in at most
``distance`` bits, and what is linked, directly or over others, is one component.

1. Fingerprints: one pass over the texts, no shuffle. Equal ones are one node from here on, so a group
   of copies of any size costs one row.
2. Candidates: the 64 bits are cut into ``distance + 2`` blocks. Fingerprints that differ in at most
   ``distance`` bits agree in at least two whole blocks, so each is dealt to one bucket per pair of
   blocks, by the value of the two.
3. Inside a bucket the distances of all fingerprints to ``PIVOTS`` reference fingerprints make a table.
   By the triangle inequality a pair whose distances to any pivot differ by more than ``distance`` is
   no link; such pairs are discarded, the others verified bit by bit. In a large bucket the rows are
   sorted by the first pivot's distance, only a narrow range of which has to be looked at, and a
   search from node to node takes each found node out, so a dense group costs about one look at each.
   Only links that join two parts of a bucket are written: fewer than it has nodes.
4. Components of those links, by Spark joins.

Buckets with more than ``HOT_BUCKET`` rows are dealt again: the blocks that two linked members may differ
in are cut into ``distance + 1`` parts, one of which they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import partitions, stored, text_key, whole_text
from sessionloom.llm.components import components

PIVOTS = 24
SMALL_BUCKET = 48
HOT_BUCKET = 100_000
BATCH = 512


@dataclass(frozen=True)
class SimHashRule:
    shingle: int = 3
    distance: int = 3
    seed: int = 42


# --- fingerprints -------------------------------------------------------------------------------


def fingerprint(text: bytes, rule: SimHashRule = SimHashRule()) -> int:
    """Lower-case A-Z, words, shingles with repeats; a bit is set if it is in over half the hashes."""
    return int(_fingerprints([text], rule)[0])


def _fingerprints(texts: list[bytes], rule: SimHashRule) -> np.ndarray:
    """The fingerprints as unsigned 64-bit numbers."""
    digest, seed, k = xxhash.xxh64_intdigest, rule.seed, rule.shingle
    hashes: list[int] = []
    count = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()  # bytes: only A-Z change, and only the six blanks split
        n = len(words)
        if not n:
            continue
        if n < k:
            hashes.append(digest(b" ".join(words), seed))
            count[i] = 1
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1)
        begin = [0, *ends[: n - k].tolist()]
        stop = (ends[k - 1 :] - 1).tolist()
        hashes += [digest(line[a:b], seed) for a, b in zip(begin, stop)]
        count[i] = n - k + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    if not hashes:
        return out
    held = np.flatnonzero(count)
    first = (np.cumsum(count) - count)[held]
    data = np.array(hashes, dtype="<u8")
    ones = np.zeros((len(held), 64), dtype=np.int64)
    for bit in range(64):  # column by column, so that memory stays at one number per shingle
        ones[:, bit] = np.add.reduceat(((data >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), first)
    majority = ones * 2 > count[held][:, None]
    weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
    out[held] = (majority * weight).sum(axis=1, dtype=np.uint64)
    return out


def _fingerprint_rows(rule: SimHashRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                found = _fingerprints([t.as_py() for t in batch.column(2)], rule)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(found.view(np.int64))],
                    names=["doc_id", "text_key", "fp"],
                )

    return run


def fingerprinted(docs: DataFrame, rule: SimHashRule = SimHashRule()) -> DataFrame:
    """doc_id, text_key and fp (the fingerprint as a signed long) of every row, stored."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key("text").alias("text_key"),
        whole_text("text").cast("binary").alias("text"),
    )
    found = rows.mapInArrow(_fingerprint_rows(rule), "doc_id long, text_key long, fp long")
    return stored(found, "simhash")


# --- links --------------------------------------------------------------------------------------


def _blocks(lo: int, hi: int, n: int) -> list[int]:
    """Masks of ``n`` runs of bits that make up the bits lo..hi-1."""
    cuts = [lo + (hi - lo) * i // n for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masked(mask: int) -> Column:
    return F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long"))


def _keys(masks: list[int]) -> Column:
    return F.array(
        *[F.struct(F.lit(i).alias("no"), _masked(m).alias("bits")) for i, m in enumerate(masks)]
    )


def links(nodes: DataFrame, rule: SimHashRule = SimHashRule()) -> DataFrame:
    """Links (a, b) that connect what the rule connects; ``nodes`` has distinct fingerprints ``fp``."""
    n = rule.distance + 2
    blocks = _blocks(0, 64, n)
    pairs = list(combinations(range(n), 2))
    masks = [blocks[i] | blocks[j] for i, j in pairs]
    keyed = nodes.select("fp", F.explode(_keys(masks)).alias("k")).select(
        "fp", F.xxhash64("k.no", "k.bits").alias("bucket"), F.col("k.no").alias("no")
    )
    sizes = stored(
        keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1), "buckets"
    )
    keyed = keyed.join(sizes, "bucket")
    # The remaining blocks of a hot bucket, cut so that one part has to be equal.
    hot = keyed.filter(F.col("n") > HOT_BUCKET)
    rest = [[b for k, b in enumerate(blocks) if k not in p] for p in pairs]
    parts = F.array(*[_keys(_thinned(r, rule.distance + 1)) for r in rest])
    again = hot.select("fp", "bucket", F.explode(F.element_at(parts, F.col("no") + 1)).alias("k"))
    again = again.select("fp", F.xxhash64("bucket", "k.no", "k.bits").alias("bucket"))
    rows = keyed.filter(F.col("n") <= HOT_BUCKET).select("fp", "bucket").unionByName(again)
    placed = rows.repartition(partitions(nodes.sparkSession), "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(_linked(rule.distance), "a long, b long").distinct()


def _thinned(masks: list[int], n: int) -> list[int]:
    """The bits of some blocks, dealt into ``n`` masks."""
    bits = [b for b in range(64) if any(m >> b & 1 for m in masks)]
    return [sum(1 << b for b in bits[i::n]) for i in range(n)]


def pivots() -> np.ndarray:
    return np.random.default_rng(17).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def _linked(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried_fp, carried_bucket = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            fp = np.concatenate([carried_fp, batch.column(0).to_numpy().view(np.uint64)])
            bucket = np.concatenate([carried_bucket, batch.column(1).to_numpy()])
            if not len(bucket):
                continue
            # The last bucket may go on in the next batch.
            end = int(np.searchsorted(bucket, bucket[-1]))
            if end:
                yield _edges(fp[:end], bucket[:end], distance)
            carried_fp, carried_bucket = fp[end:], bucket[end:]
        if len(carried_fp) > 1:
            yield _edges(carried_fp, carried_bucket, distance)

    return run


def _edges(fp: np.ndarray, bucket: np.ndarray, distance: int) -> pa.RecordBatch:
    table = np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int8)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(first, append=len(fp))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Small buckets all at once: each row against the next ones of its bucket.
    small = np.repeat(size <= SMALL_BUCKET, size)
    last = np.repeat(first + size, size)
    for step in range(1, SMALL_BUCKET):
        a = np.flatnonzero(small & (np.arange(len(fp)) + step < last))
        if not len(a):
            break
        near = np.abs(table[a] - table[a + step]).max(axis=1) <= distance
        a = a[near]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= distance]
        found.append((fp[a], fp[a + step]))
    for f, s in zip(first[size > SMALL_BUCKET], size[size > SMALL_BUCKET]):
        found.append(_search(fp[f : f + s], table[f : f + s], distance))
    a, b = (np.concatenate([x[i] for x in found] or [np.zeros(0, np.uint64)]) for i in range(2))
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
    )


def _search(fp: np.ndarray, table: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a large bucket: from each node to those not reached before."""
    order = np.argsort(table[:, 0], kind="stable")
    fp, table = fp[order], table[order]
    lo = np.searchsorted(table[:, 0], np.arange(-distance, 65 - distance))
    hi = np.searchsorted(table[:, 0], np.arange(distance, 65 + distance), side="right")
    free = np.ones(len(fp), dtype=bool)
    a, b = [], []
    for root in range(len(fp)):
        if not free[root]:
            continue
        free[root] = False
        todo = [root]
        while todo:
            node = todo.pop()
            d = table[node, 0]
            near = lo[d] + np.flatnonzero(free[lo[d] : hi[d]])
            for pivot in range(1, table.shape[1]):
                if len(near) < 64:
                    break
                near = near[np.abs(table[near, pivot] - table[node, pivot]) <= distance]
            near = near[np.abs(table[near] - table[node]).max(axis=1, initial=0) <= distance]
            near = near[np.bitwise_count(fp[near] ^ fp[node]) <= distance]
            free[near] = False
            todo += near.tolist()
            a.append(np.repeat(fp[node], len(near)))
            b.append(fp[near])
    return np.concatenate(a), np.concatenate(b)


# --- over a table -------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, rule: SimHashRule = SimHashRule()) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and text_key of every row.

    ``component_id`` is the smallest id in the component. Null texts are empty; texts without words have
    the fingerprint zero and are linked like any other. Rows without an id belong to components like
    the others but do not name them: a component without any id has a null ``component_id``. Rows that
    repeat an id are rows of their own. Other columns are not read; an empty table gives no rows.
    """
    rows, named = _named(docs, rule)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", hexed.alias("fingerprint"), F.col("first.doc_id").alias("component_id"), "text_key"
    )


def _named(docs: DataFrame, rule: SimHashRule) -> tuple[DataFrame, DataFrame]:
    """The fingerprinted rows, and of every fingerprint its component's root and first row: the smallest
    id, and of its texts the smallest key. Null if no row of the component has an id."""
    rows = fingerprinted(docs, rule)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key")))
    nodes = stored(rows.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    roots = components(links(nodes, rule))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    joined = joined.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("first").alias("first"))
    per_node = joined.drop("first").join(named, "root")
    return rows, per_node.select(F.col("fp").alias("_fp"), "root", "first")


def one_of_each(docs: DataFrame, rule: SimHashRule = SimHashRule()) -> DataFrame:
    """One document of each component, with the columns it came with.

    It is the one with the smallest id, and if rows of the component share that id, the one whose text has the
    smallest key; of wholly equal rows one stays. Rows of one id that are in different components stand for
    each of them. Null texts are empty. A component without any id is kept whole: there is nothing to
    choose by. An empty table gives no rows.
    """
    rows, named = _named(docs, rule)
    firsts = named.filter(F.col("first").isNotNull()).select("first.*").distinct()
    alone = rows.join(named.filter(F.col("first").isNull()), F.col("fp") == F.col("_fp"), "left_semi")
    keep = firsts.unionByName(alone.select("doc_id", "text_key").distinct())
    keep = keep.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), "doc_id", text_key("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    kept = rows.join(keep, same, "left_semi")
    one = kept.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text_key"])
    return one.unionByName(kept.filter(F.col("doc_id").isNull())).select("doc.*")
