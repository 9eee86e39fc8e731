"""The quality classifier and the language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sessionloom.llm import gru, lm_scoring, quality
from sessionloom.llm.lm_scoring import LmRule, count_words, score_documents
from sessionloom.llm.quality import QualityRule


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- quality --------------------------------------------------------------------------------------


def good_and_bad(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "river", "was", "calm", "and", "she", "read", "slowly", "home"]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 300))]
        bad = i % 4 == 0
        out.append((i, " ".join(w.upper() + "$$$" if bad else w for w in text) + ".", int(not bad)))
    return out


def test_chunks_cover_every_byte():
    for n in (0, 1, 63, 64, 65, 447, 448, 449, 511, 512, 513, 960, 961, 5000):
        text = bytes(i % 250 + 1 for i in range(n))
        chunks, (count,) = quality.chunks_of([text])
        starts = quality.chunk_starts(n)
        assert count == len(starts) == len(chunks) >= 1
        seen = bytearray(n)
        for s, c in zip(starts, chunks):
            part = text[s : s + quality.CHUNK]
            assert bytes(c[: len(part)]) == part and not c[len(part) :].any()
            seen[s : s + len(part)] = b"\1" * len(part)
        assert all(seen)


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in quality.new_model(rng).items()}
    model["out"] = rng.standard_normal(model["out"].shape)
    chunks = rng.integers(1, 256, (5, quality.CHUNK)).astype(np.uint8)
    count, label = np.array([2, 3]), np.array([1.0, 0.0])

    def loss():
        features = quality._features(model, quality._pooled(model, chunks))
        p = quality._sigmoid(quality._combined(features, count) @ model["out"] + model["out_shift"])
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    grads = quality._gradients(model, chunks, count, label)
    for name, g in grads.items():
        flat = np.argsort(-np.abs(np.asarray(g)).reshape(-1))[:3]
        for at in flat:
            place = np.unravel_index(at, model[name].shape)
            kept = model[name][place]
            model[name][place] = kept + 1e-5
            up = loss()
            model[name][place] = kept - 1e-5
            down = loss()
            model[name][place] = kept
            assert g[place] == pytest.approx((up - down) / 2e-5, rel=0.02, abs=1e-6), name


def plain_score(model, text):
    """The classifier's forward pass, place by place, from the method's description alone."""
    step = quality.CHUNK - quality.OVERLAP
    features, start = [], 0
    while True:
        chunk = text[start : start + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        pooled = np.zeros(quality.FILTERS)
        for at in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STEP):
            window = np.concatenate([model["byte"][b] for b in chunk[at : at + quality.WIDTH]])
            pooled = np.maximum(pooled, window @ model["filter"] + model["shift"])
        features.append(np.tanh(pooled @ model["layer"] + model["layer_shift"]))
        start += step
        if start + quality.OVERLAP >= len(text):
            break
    every = np.concatenate([np.mean(features, axis=0), np.max(features, axis=0)])
    return 1 / (1 + math.exp(-float(every @ model["out"] + model["out_shift"][0])))


def test_quality_scores_against_plain_forward_pass(spark, frame):
    rng = np.random.default_rng(9)
    model = quality.new_model(rng)
    model["shift"] += rng.normal(size=quality.FILTERS).astype(np.float32) * 0.1
    model["out_shift"] += np.float32(0.2)
    sizes = [0, 1, 5, 63, 448, 449, 512, 513, 1700]
    docs = [(i, "".join(map(chr, rng.integers(32, 300, n)))) for i, n in enumerate(sizes)] + [(50, None)]
    got = {r.doc_id: r.score for r in quality.scored(frame(docs), model).collect()}
    want = {i: plain_score(model, (t or "").encode()) for i, t in docs}
    assert got.keys() == want.keys() and max(want.values()) - min(want.values()) > 1e-3
    assert all(got[i] == pytest.approx(want[i], abs=1e-5) for i in want)


def test_classifier_on_held_out_rows(spark, frame):
    known = good_and_bad(240)
    docs = frame([(i, t) for i, t, _ in known])
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in known], "doc_id long, quality int, toxic int")
    rule = QualityRule(steps=120)
    out = quality.scored(docs, quality.fit(docs, labels, rule), rule).collect()
    truth = {i: q for i, _, q in known}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if fold(i, 4) == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_held_out_labels_teach_nothing(spark, frame):
    known = good_and_bad(60)
    docs = frame([(i, t) for i, t, _ in known])
    schema, rule = "doc_id long, quality int, toxic int", QualityRule(steps=5)
    one = spark.createDataFrame([(i, q, 0) for i, _, q in known], schema)
    other = spark.createDataFrame([(i, q if fold(i, 4) != 2 else 1 - q, 0) for i, _, q in known], schema)
    a, b = quality.fit(docs, one, rule), quality.fit(docs, other, rule)
    assert all((a[k] == b[k]).all() for k in a)


def test_quality_of_awkward_rows(spark, frame, rows):
    schema, rule = "doc_id long, quality int, toxic int", QualityRule(steps=5, train_documents=20)
    labels = spark.createDataFrame([(i, k % 2, 0) for k, (i, _) in enumerate(rows)] + [(3, None, 0)], schema)
    docs = frame(rows)
    out = quality.scored(docs, quality.fit(docs, labels, rule), rule).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    assert not any(r.held_out for r in out if r.doc_id is None)
    nothing = spark.createDataFrame([], schema)
    model = quality.fit(docs, nothing, rule)
    assert all(r.score == pytest.approx(0.5) for r in quality.scored(docs, model, rule).collect())
    assert quality.scored(frame([]), model, rule).count() == 0
    kept = quality.accepted(docs, model, QualityRule(threshold=0.4))
    assert kept.schema == docs.schema and kept.count() == len(rows)
    assert quality.accepted(docs, model, rule).count() == 0


# --- language model -------------------------------------------------------------------------------


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + [None]


def check_counts(rows, out):
    counts = Counter()
    for i, t in rows:
        if i is not None and fold(i, 7) != 2:
            counts.update(words(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        held = i is not None and fold(i, 7) == 2
        want[i, held, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    assert want == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out
    )


@pytest.mark.parametrize("batch", [lm_scoring.BATCH_BYTES, 2_000])
def test_counts_and_base_scores(frame, rows, batch):
    out = score_documents(frame(rows), LmRule(steps=3, train_documents=5)).collect()
    check_counts(rows, out)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_base_scores_of_empty_and_tiny_tables(frame):
    rule = LmRule(steps=2, train_documents=5)
    assert score_documents(frame([]), rule).count() == 0
    held = next(i for i in range(50) if fold(i, 7) == 2)
    for rows in ([(held, "a b")], [(1, None)], [(None, "a"), (None, None)]):
        check_counts(rows, score_documents(frame(rows), rule).collect())


def test_gru_probabilities_add_up():
    rng = np.random.default_rng(1)
    model = gru.new_model(rng.integers(0, 50, gru.OUTCOMES).astype(float), rng)
    h = rng.standard_normal((3, gru.HIDDEN)).astype(np.float32)
    for row in h:
        every = gru.log_probabilities(model, np.repeat(row[None], gru.OUTCOMES, 0), np.arange(gru.OUTCOMES))
        assert np.exp(every.astype(np.float64)).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_windows_or_company(monkeypatch):
    rng = np.random.default_rng(2)
    model = gru.new_model(np.ones(gru.OUTCOMES), rng)
    sequences = [rng.integers(0, gru.OUTCOMES, n) for n in (1, 5, 200, 64, 65, 3)]
    together = gru.score(model, sequences)
    alone = [gru.score(model, [s])[0] for s in sequences]
    monkeypatch.setattr(gru, "WINDOW", 7)
    assert together == pytest.approx(alone, rel=1e-5)
    assert gru.score(model, sequences) == pytest.approx(alone, rel=1e-5)
    assert gru.score(model, []).tolist() == []


def test_gru_gradients_are_right():
    rng = np.random.default_rng(3)
    model = {k: v.astype(np.float64) for k, v in gru.new_model(np.ones(gru.OUTCOMES), rng).items()}
    model["class"] = rng.standard_normal(model["class"].shape) * 0.3
    model["member"] = rng.standard_normal(model["member"].shape) * 0.3
    y = rng.integers(0, gru.OUTCOMES, (6, 4))
    x = rng.integers(0, gru.OUTCOMES, (6, 4))
    fresh = np.zeros((6, 4), dtype=bool)
    fresh[3, 1] = True
    h0 = rng.standard_normal((4, gru.HIDDEN))

    def loss():
        h, total = h0, 0.0
        for t in range(6):
            h = np.where(fresh[t][:, None], 0.0, h)
            h = gru._step(model, x[t], h)[0]
            total -= gru.log_probabilities(model, h, y[t]).sum()
        return total / y.size

    grads, _ = gru._window_gradients(model, x, y, fresh, h0)
    for name, g in grads.items():
        for at in np.argsort(-np.abs(g).reshape(-1))[:3]:
            place = np.unravel_index(at, g.shape)
            kept = model[name][place]
            model[name][place] = kept + 1e-5
            up = loss()
            model[name][place] = kept - 1e-5
            down = loss()
            model[name][place] = kept
            assert g[place] == pytest.approx((up - down) / 2e-5, rel=0.02, abs=1e-7), name


def test_model_beats_the_base_on_held_out_rows(frame):
    rng = random.Random(5)
    rows = []
    for i in range(300):  # the language of a document shows in its first words
        tongue = ["der die und haus", "the and of house", "le la et maison"][i % 3].split()
        rows.append((i, " ".join(rng.choice(tongue) for _ in range(rng.randrange(20, 80)))))
    out = score_documents(frame(rows), LmRule(steps=250)).collect()
    held = [r for r in out if r.held_out]
    assert held and sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_counts_cover_all_training_documents(frame, rows):
    counts = count_words(frame(rows))
    assert counts.ends == sum(i is not None and fold(i, 7) != 2 for i, _ in rows)


def test_padding_teaches_nothing():
    rng = np.random.default_rng(6)
    model = gru.new_model(np.ones(gru.OUTCOMES), rng)
    x, y = rng.integers(0, gru.OUTCOMES, (2, 6, 1))
    fresh, h0 = np.zeros((6, 2), dtype=bool), np.zeros((2, gru.HIDDEN), dtype=np.float32)
    alone, _ = gru._window_gradients(model, x, y, fresh[:, :1], h0[:1])
    pad = np.zeros((6, 1), dtype=np.int64)
    real = np.array([[True, False]] * 6)
    both, _ = gru._window_gradients(model, np.hstack([x, pad]), np.hstack([y, pad]), fresh, h0, real)
    assert all(np.allclose(alone[k], both[k], atol=1e-6) for k in alone)


@pytest.mark.parametrize("piece", [1024, 16, 7])
@pytest.mark.parametrize("streams", [1, 3, 50])
def test_a_pass_reads_every_token(monkeypatch, streams, piece):
    monkeypatch.setattr(gru, "PIECE", piece)
    rng = np.random.default_rng(7)
    model = gru.new_model(np.ones(gru.OUTCOMES), rng)
    lengths = [[1, 5, 300, 16], [], [17, 0, 2, 33], [1]]
    batches = [[rng.integers(0, gru.OUTCOMES, n) for n in b] for b in lengths]
    read, gradients = Counter(), gru._window_gradients

    def watched(model, x, y, fresh, h0, real=None):
        real = np.ones(x.shape, dtype=bool) if real is None else real
        read.update(zip(x[real].tolist(), y[real].tolist()))
        return gradients(model, x, y, fresh, h0, real)

    monkeypatch.setattr(gru, "_window_gradients", watched)
    _, n = gru.learn(model, batches, 0.01, streams)
    every = [s for b in batches for s in b if len(s)]
    want = Counter(p for s in every for p in zip([gru.OUTCOMES, *s.tolist()], s.tolist()))
    assert n == sum(want.values()) and read == want


def test_weights_come_from_all_training_documents(frame):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(40)]
    rule = LmRule(steps=2, train_documents=3)
    counts = count_words(frame(rows), rule)
    model = lm_scoring.fit(frame(rows, parts=1), counts, rule)
    first = lm_scoring.started(frame(rows), counts, rule)

    def other(i):  # the same words of one document in another order
        turned = [(j, " ".join(reversed(t.split())) if i == j else t) for j, t in rows]
        docs = frame(turned, parts=1)
        begun, learned = lm_scoring.started(docs, counts, rule), lm_scoring.fit(docs, counts, rule)
        return [any((a[k] != b[k]).any() for k in a) for a, b in ((first, begun), (model, learned))]

    train = [i for i in range(40) if fold(i, 7) != 2]
    changed = [other(i) for i in train[:5]]
    assert all(learned for _, learned in changed) and not all(begun for begun, _ in changed)
    assert other(next(i for i in range(40) if fold(i, 7) == 2)) == [False, False]


def test_weights_of_many_tasks_are_averaged(frame, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(10 + i))) for i in range(40)]
    rule = LmRule(steps=2, train_documents=3, passes=1)
    counts = count_words(frame(rows), rule)
    model = lm_scoring.fit(frame(rows, parts=7), counts, rule)
    monkeypatch.setattr(lm_scoring, "_MERGE", 2)
    again = lm_scoring.fit(frame(rows, parts=7), counts, rule)
    assert all(np.allclose(model[k], again[k], atol=1e-5) for k in model)


def test_products_by_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    a, b, c = rng.normal(size=(1000, 24)), rng.normal(size=(24, 72)), rng.normal(size=(1000, 72))
    monkeypatch.setattr(gru, "ONE_THREAD", 24 * 72 * 37)
    assert np.allclose(gru._dot(a, b), a @ b) and np.allclose(gru._dot_down(a, c), a.T @ c)
    x = rng.normal(size=(50, 64)).astype(np.float32) * 8
    assert np.allclose(gru._log_sum(x.copy(), True), gru._log_sum(x.copy(), False), rtol=1e-5)
    assert np.allclose(gru._softmax(x.copy(), True), gru._softmax(x.copy(), False), atol=1e-6)


def test_sums_by_word():
    rng = np.random.default_rng(7)
    word = np.minimum(rng.geometric(0.03, 900), gru.OUTCOMES)  # some once, some far more than ``FEW`` times
    rows = rng.normal(size=(900, 5))
    found, sums = gru._sums_by_word(word, rows)
    assert found.tolist() == sorted(set(word.tolist()))
    assert np.bincount(word).max() > gru.FEW > 1 == np.bincount(word)[found].min()
    assert np.allclose(sums, [rows[word == w].sum(axis=0) for w in found])


def test_outcomes_of_words_not_kept(monkeypatch):
    texts, known = [b"one two three two four", b"", b"five ONE three"], {b"one": 70}
    kept = lm_scoring._outcome_arrays(texts, known)
    monkeypatch.setattr(lm_scoring._Outcomes, "MOST", 2)
    bounded = lm_scoring._outcome_arrays(texts, known)
    assert [a.tolist() for a in kept] == [a.tolist() for a in bounded] and known == {b"one": 70}
    assert kept[0][0] == kept[2][1] == 70 and kept[1].tolist() == [lm_scoring.END]
    assert kept[0][1] == kept[0][3] == lm_scoring.shape(b"two")


def test_large_weights_take_the_careful_way():
    model = gru.new_model(np.ones(gru.OUTCOMES), np.random.default_rng(5))
    assert gru._plain(model)[0] and gru._plain(model)[1].all()
    model["class"] *= 1e6
    model["member"][3] *= 1e6
    plain, members = gru._plain(model)
    assert not plain and not members[3] and members[4]
    sequences = [np.random.default_rng(6).integers(0, gru.OUTCOMES, 300)]
    assert np.isfinite(gru.score(model, sequences)).all()


def test_scores_against_plain_python(frame, rows, monkeypatch):
    """The score column through Spark, rare words with their share of the group included."""
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 20)
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 3_000)
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 20_000)
    docs = frame(rows)
    counts = count_words(docs)
    model = gru.new_model(counts.frequency(), np.random.default_rng(1))
    got = sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.n_known, r.score) for r in lm_scoring.scored(docs, counts, model).collect())
    seen = Counter()
    for i, t in rows:
        if i is not None and fold(i, 7) != 2:
            seen.update(lm_scoring.tokens((t or "").encode()))
    known, want = counts.outcomes(), []
    size = Counter()
    for w, n in seen.items():
        if w not in known:
            size[lm_scoring.shape(w)] += n + 1
    for i, t in rows:
        words = lm_scoring.tokens((t or "").encode())
        sequence = np.array([known.get(w, lm_scoring.shape(w)) for w in words] + [lm_scoring.END])
        score = gru.score(model, [sequence])[0] / np.log(10)
        score += sum(np.log10((seen[w] + 1) / (size[lm_scoring.shape(w)] + 1)) for w in words if w not in known)
        want.append((i is not None, i, len(words) + 1, sum(seen[w] > 0 for w in words) + 1, score))
    want.sort()
    assert [r[:4] for r in got] == [r[:4] for r in want] and len(known) == 20
    assert np.allclose([r[4] for r in got], [r[4] for r in want], rtol=1e-4)


def test_word_transport_does_not_grow_with_the_buckets():
    """What buckets get of a batch names its documents only where they occur."""
    rng = random.Random(3)
    texts = [" ".join(f"rare{rng.randrange(10**9)}" for _ in range(4)).encode() for _ in range(2000)]
    counts = lm_scoring.Counts([], 10, 10, 1, np.ones(lm_scoring.SHAPES, dtype=np.int64))
    model = gru.new_model(counts.frequency(), np.random.default_rng(1))
    entries = []
    for buckets in (8, 4000):
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(2000)), pa.array([False] * 2000), pa.array([True] * 2000), pa.array(texts, pa.binary())],
            names=["doc_id", "held_out", "train", "text"],
        )
        from unittest import mock

        with mock.patch("pyspark.TaskContext.get") as task:
            task.return_value.partitionId.return_value = 0
            (out,) = lm_scoring._score_blobs(model, counts, buckets)(iter([batch]))
        blobs = [b.as_py() for no, b in zip(out.column(0), out.column(2)) if no.as_py() >= 0]
        docs = [lm_scoring._spread_out(b, lm_scoring._WORD_BLOB)[4] for b in blobs]
        entries.append(sum(len(d) for d in docs))
    assert entries[0] <= 8000 and entries[1] <= 8000


def test_words_of_many_texts_at_once():
    """Blanks at the edges, blanks alone, no blanks, bytes that are no UTF-8, words shorter than their endings."""
    import pyarrow as pa

    rng = random.Random(11)
    alphabet = [bytes([c]) for c in range(256)] + [b" ", b"\n", b"a", b"B"] * 60
    known = {b"a": 70, b"ab": 71, b"baa": 72}
    for _ in range(200):
        texts = [b"".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(rng.randrange(6))]
        want = [lm_scoring.tokens(t) for t in texts]
        column = pa.array([b"x y", *texts], rng.choice([pa.binary(), pa.large_binary()])).slice(1)
        if rng.random() < 0.5:
            column = column.cast(pa.binary())  # may leave bytes before the first text
        number, found, lengths = lm_scoring._words(column)
        names = lm_scoring._as_list(found)
        assert [names[i] for i in number.tolist()] == [w for t in want for w in t]
        assert lengths.tolist() == [len(t) for t in want]
        assert len(set(names)) == len(names) and b"" not in names
        arrays = lm_scoring._outcome_arrays(column, known)
        assert [a.tolist() for a in arrays] == [
            [known.get(w, lm_scoring.shape(w)) for w in t] + [lm_scoring.END] for t in want
        ]


@pytest.mark.parametrize("window", [64, 1])
def test_scores_of_more_sequences_than_go_side_by_side(monkeypatch, window):
    monkeypatch.setattr(gru, "BESIDE", 4)
    monkeypatch.setattr(gru, "TOGETHER", 8)
    monkeypatch.setattr(gru, "WINDOW", window)
    rng = np.random.default_rng(12)
    model = gru.new_model(np.ones(gru.OUTCOMES), rng)
    sequences = [rng.integers(0, gru.OUTCOMES, n) for n in (3, 0, 90, 7, 7, 1, 0, 200, 30, 30, 2)]
    want = []
    for s in sequences:
        h, x, total = np.zeros((1, gru.HIDDEN), dtype=np.float32), np.array([gru.OUTCOMES]), 0.0
        for y in s:
            h, x = gru._step(model, x, h)[0], np.array([y])
            total += float(gru.log_probabilities(model, h, x)[0])
        want.append(total)
    assert gru.score(model, sequences) == pytest.approx(want, rel=1e-5)


def test_gradients_do_not_depend_on_groups_of_rows(monkeypatch):
    rng = np.random.default_rng(13)
    model = gru.new_model(np.ones(gru.OUTCOMES), rng)
    x, y = rng.integers(0, gru.OUTCOMES, (2, 16, 40))
    fresh, h0 = rng.random((16, 40)) < 0.1, rng.normal(size=(40, gru.HIDDEN)).astype(np.float32)
    one, h_one = gru._window_gradients(model, x, y, fresh, h0)
    monkeypatch.setattr(gru, "TOGETHER", 5)
    other, h_other = gru._window_gradients(model, x, y, fresh, h0)
    assert all(np.allclose(one[k], other[k], atol=1e-6) for k in one) and np.allclose(h_one, h_other)


def test_adam_against_its_description():
    rng = np.random.default_rng(14)
    model = {"a": rng.normal(size=(4, 3)).astype(np.float32), "b": rng.normal(size=5).astype(np.float32)}
    want = {k: v.astype(np.float64) for k, v in model.items()}
    mean, square = ({k: np.zeros(v.shape) for k, v in model.items()} for _ in range(2))
    adam = gru._Adam(model)
    for step in range(1, 40):
        grads = {k: (rng.normal(size=v.shape) * 10.0 ** (step % 5 - 3)).astype(np.float32) for k, v in model.items()}
        size = math.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g.astype(np.float64) * min(1, 1 / size)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.995 * square[k] + 0.005 * g**2
            up = np.sqrt(square[k] / (1 - 0.995**step)) + 1e-6
            want[k] -= 0.01 * mean[k] / (1 - 0.9**step) / up
        adam.step(model, grads, 0.01)
    assert all(np.allclose(model[k], want[k], atol=1e-4) for k in model)


def test_a_task_looks_a_word_up_once_a_batch(monkeypatch):
    """Python's work in counting, encoding and scoring grows with distinct endings, not with tokens."""
    import pyarrow as pa

    texts = pa.array([b"Lorem ipsum dolor sit amet " * 500] * 20, pa.binary())
    asked = []
    shape = lm_scoring.shape
    monkeypatch.setattr(lm_scoring, "shape", lambda word: asked.append(word) or shape(word))
    monkeypatch.setattr(lm_scoring, "tokens", None)  # word by word
    arrays = lm_scoring._outcome_arrays(texts, {b"sit": 70})
    assert sum(map(len, arrays)) == 20 * 2501 and sorted(asked) == [b"lor", b"met", b"rem", b"sum"]
