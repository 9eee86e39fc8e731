"""A quality classifier that reads bytes: a small convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it. Each byte has a learned vector; learned
filters of ``WIDTH`` bytes slide over the chunk in steps of ``STEP``, and of each filter the largest
response in the chunk counts. A small layer turns a chunk's responses into features; their mean and
maximum over all chunks give one probability.

Training takes place on the driver, over a bounded sample: at most ``train_documents`` labelled
documents, the first ones in order of a hash of their ids, and of each at most ``train_chunks`` chunks,
spread evenly over the whole text. The number of steps is fixed. Scoring needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import text_key, whole_text

CHUNK, OVERLAP = 512, 64
WIDTH, STEP = 8, 4
PLACES = (CHUNK - WIDTH) // STEP + 1
BYTE_DIM, FILTERS, FEATURES = 8, 32, 12
CHUNKS_AT_ONCE = 512


@dataclass(frozen=True)
class QualityRule:
    """``folds`` and ``held_out``: ids whose CRC-32 leaves that remainder are never learned from."""

    train_documents: int = 3_000
    train_chunks: int = 8
    steps: int = 500
    batch: int = 48
    rate: float = 0.004
    seed: int = 5
    threshold: float = 0.7
    folds: int = 4
    held_out: int = 2


Model = dict[str, np.ndarray]


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the chunks of a text of n bytes: every byte is in one, and an empty text has one."""
    step = CHUNK - OVERLAP
    return np.arange(max(1, -(-(n - OVERLAP) // step)), dtype=np.int64) * step


def chunks_of(texts: list[bytes], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All chunks, zero-padded, and how many each text has; at most ``most`` of each, spread evenly."""
    starts = []
    for t in texts:
        s = chunk_starts(len(t))
        if most and len(s) > most:
            s = s[np.linspace(0, len(s) - 1, most).round().astype(np.int64)]
        starts.append(s)
    count = np.array([len(s) for s in starts], dtype=np.int64)
    out = np.zeros((int(count.sum()), CHUNK), dtype=np.uint8)
    row = 0
    for t, s in zip(texts, starts):
        data = np.frombuffer(t, dtype=np.uint8)
        for a in s:
            part = data[a : a + CHUNK]
            out[row, : len(part)] = part
            row += 1
    return out, count


# --- the network --------------------------------------------------------------------------------


def new_model(rng: np.random.Generator) -> Model:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "byte": normal(256, BYTE_DIM, scale=0.5),
        "filter": normal(WIDTH * BYTE_DIM, FILTERS, scale=(WIDTH * BYTE_DIM) ** -0.5),
        "shift": np.zeros(FILTERS, dtype=np.float32),
        "layer": normal(FILTERS, FEATURES, scale=FILTERS**-0.5),
        "layer_shift": np.zeros(FEATURES, dtype=np.float32),
        "out": normal(2 * FEATURES, scale=0.2),
        "out_shift": np.zeros(1, dtype=np.float32),
    }


def _responses(model: Model, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows' vectors and the filters' responses, (chunks, places, filters)."""
    vectors = model["byte"][chunks].reshape(len(chunks), CHUNK * BYTE_DIM)
    windows = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH * BYTE_DIM, axis=1)
    windows = np.ascontiguousarray(windows[:, :: STEP * BYTE_DIM])
    flat = windows.reshape(-1, WIDTH * BYTE_DIM) @ model["filter"]
    return windows, flat.reshape(len(chunks), PLACES, FILTERS)


def _pooled(model: Model, chunks: np.ndarray) -> np.ndarray:
    _, out = _responses(model, chunks)
    return np.maximum(out.max(axis=1) + model["shift"], 0)


def _features(model: Model, pooled: np.ndarray) -> np.ndarray:
    return np.tanh(pooled @ model["layer"] + model["layer_shift"])


def _combined(features: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean and maximum over each text's chunks."""
    first = np.cumsum(count) - count
    mean = np.add.reduceat(features, first, axis=0) / count[:, None]
    return np.concatenate([mean, np.maximum.reduceat(features, first, axis=0)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 for each text, from all of its chunks."""
    if not texts:
        return np.zeros(0)
    count, found = [], []
    held: list[bytes] = []
    weight = 0

    def flush() -> None:
        nonlocal held, weight
        chunks, n = chunks_of(held)
        parts = [
            _features(model, _pooled(model, chunks[a : a + CHUNKS_AT_ONCE]))
            for a in range(0, len(chunks), CHUNKS_AT_ONCE)
        ]
        found.append(_combined(np.concatenate(parts), n))
        count.append(n)
        held, weight = [], 0

    for t in texts:
        held.append(t)
        weight += len(t) + CHUNK
        if weight > CHUNKS_AT_ONCE * CHUNK:
            flush()
    if held:
        flush()
    logit = np.concatenate(found) @ model["out"] + model["out_shift"]
    return _sigmoid(logit.astype(np.float64))


def _gradients(model: Model, chunks: np.ndarray, count: np.ndarray, label: np.ndarray) -> Model:
    windows, response = _responses(model, chunks)
    best = response.argmax(axis=1)
    row = np.arange(len(chunks))[:, None]
    raw = response[row, best, np.arange(FILTERS)[None, :]] + model["shift"]
    pooled = np.maximum(raw, 0)
    features = _features(model, pooled)
    doc = _combined(features, count)
    p = _sigmoid(doc @ model["out"] + model["out_shift"])
    d_logit = ((p - label) / len(label)).astype(np.float32)
    d_doc = d_logit[:, None] * model["out"][None, :]
    of = np.repeat(np.arange(len(count)), count)
    d_features = (d_doc[:, :FEATURES] / count[:, None])[of].astype(np.float32)
    top = features == doc[:, FEATURES:][of]
    d_features += d_doc[:, FEATURES:][of] * top
    d_hidden = d_features * (1 - features**2)
    d_pooled = (d_hidden @ model["layer"].T) * (raw > 0)
    picked = windows[row, best]  # chunks, filters, width * dim
    d_window = d_pooled[:, :, None] * model["filter"].T[None]
    place = best[:, :, None] * STEP + np.arange(WIDTH)[None, None, :]
    which = chunks[row[:, :, None], place].reshape(-1)
    spread = d_window.reshape(-1, BYTE_DIM)
    d_byte = np.stack([np.bincount(which, spread[:, k], 256) for k in range(BYTE_DIM)], axis=1)
    return {
        "byte": d_byte,
        "filter": np.einsum("cf,cfk->kf", d_pooled, picked),
        "shift": d_pooled.sum(axis=0),
        "layer": pooled.T @ d_hidden,
        "layer_shift": d_hidden.sum(axis=0),
        "out": doc.T @ d_logit,
        "out_shift": d_logit.sum(keepdims=True),
    }


def train(texts: list[bytes], labels: list[int], rule: QualityRule = QualityRule()) -> Model:
    """Minimise the log loss by Adam, with a falling rate and a fixed number of steps.

    Without any example the model gives 0.5 to about everything; with one label only, it learns that.
    """
    rng = np.random.default_rng(rule.seed)
    model = new_model(rng)
    if not texts:
        return model | {"out": np.zeros(2 * FEATURES, dtype=np.float32)}
    chunks, count = chunks_of(texts, rule.train_chunks)
    first = np.cumsum(count) - count
    label = np.array(labels, dtype=np.float32)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, rule.steps + 1):
        docs = rng.integers(0, len(texts), rule.batch)
        at = np.concatenate([np.arange(first[d], first[d] + count[d]) for d in docs])
        grads = _gradients(model, chunks[at], count[docs], label[docs])
        rate = rule.rate * min(1.0, 2 * (1 - step / (rule.steps + 1)))
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            m, s = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.99**step)
            model[k] = (model[k] - rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return model


# --- over a table -------------------------------------------------------------------------------


def remainder(doc_id: str, folds: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def _sampled(most: int):
    """Of each text only the chunks to learn from, joined; the driver gets no whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for t in batch.column(1):
                text = t.as_py()
                whole = len(chunk_starts(len(text))) <= most
                parts.append(text if whole else chunks_of([text], most)[0].tobytes())
            long = pa.array([len(chunk_starts(len(t.as_py()))) > most for t in batch.column(1)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(parts, pa.binary()), long, *batch.columns[2:]],
                names=["label", "text", "cut", *batch.schema.names[2:]],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, rule: QualityRule = QualityRule()) -> Model:
    """Learn ``labels.quality`` from the texts of the training fold.

    A document labelled more than once has the label of most of its rows, 1 if they are even. Rows
    without id, label or document teach nothing.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.filter(remainder("doc_id", rule.folds) != rule.held_out)
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    # The sample is chosen by id before any text is read.
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rule.train_documents)
    rows = docs.select("doc_id", whole_text("text").alias("text"), text_key("text").alias("text_key"))
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.select("label", F.col("text").cast("binary").alias("text"), "_id", "text_key")
    # Texts are cut to their chunks where they are read; only those meet in one place.
    schema = "label int, text binary, cut boolean, _id long, text_key long"
    cut = rows.withColumn("_id", F.col("_id").cast("long")).mapInArrow(_sampled(rule.train_chunks), schema)
    found = cut.orderBy(F.xxhash64("_id"), "_id", "text_key").limit(rule.train_documents).collect()
    texts = [bytes(r.text) for r in found]
    return train(texts, [r.label for r in found], rule)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = scores(model, [t.as_py() for t in batch.column(2)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(found, pa.float64())],
                    names=["doc_id", "held_out", "score"],
                )

    return run


def scored(docs: DataFrame, model: Model, rule: QualityRule = QualityRule()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    A null text is empty and is scored like any other. A null id is never held out, since it is never
    learned from. Rows that repeat an id are scored one by one; other columns are not read; an empty
    table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder("doc_id", rule.folds) == rule.held_out, F.lit(False)).alias("held_out"),
        whole_text("text").cast("binary").alias("text"),
    )
    found = rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    predicted = F.when(F.col("score") >= rule.threshold, 1).otherwise(0)
    return found.withColumn("predicted", predicted)


def accepted(docs: DataFrame, model: Model, rule: QualityRule = QualityRule()) -> DataFrame:
    """The documents that are predicted to be good, with the columns they came with."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [t.as_py() or b"" for t in batch.column(place).cast(pa.binary())]
                good = scores(model, texts) >= rule.threshold
                if good.any():
                    yield batch.filter(pa.array(good))

    place = docs.columns.index("text")
    return docs.mapInArrow(keep, docs.schema)
