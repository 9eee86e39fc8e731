"""A gated recurrent network with a class-factored softmax, in numpy.

It predicts the next of ``CLASSES`` x ``MEMBERS`` outcomes: first its class, then the member of the class.
Sequences run side by side, the longest first; windows of time steps follow one another and hand on the
state, so a sequence of any length is scored whole with bounded memory.

Products are taken in blocks small enough for one thread: tasks run side by side already, and threads that
wait for one another inside a small product burn as much time as they save.

States and gates have a row per sequence and are held by columns: each gate is then one run of memory.
"""

from __future__ import annotations

import heapq
import math
import os
from collections.abc import Iterable, Iterator

import numpy as np

CLASSES = MEMBERS = 64
OUTCOMES = CLASSES * MEMBERS
HIDDEN = 24
WINDOW = 64
PIECE = 1024

Model = dict[str, np.ndarray]


def new_model(frequency: np.ndarray, rng: np.random.Generator) -> Model:
    """A model that predicts the frequencies of the outcomes, until it has learned more."""
    share = (frequency + 0.5).reshape(CLASSES, MEMBERS)
    by_class = share.sum(axis=1)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    gates = normal(OUTCOMES + 1, 3 * HIDDEN, scale=0.3)
    gates[OUTCOMES] = 0  # the start of a text
    return {
        "gates": gates,
        "recurrent": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "class": normal(HIDDEN, CLASSES, scale=0.02),
        "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
        "member": normal(CLASSES, HIDDEN, MEMBERS, scale=0.02),
        "member_bias": np.log(share / by_class[:, None]).astype(np.float32),
    }


# Multiplications in a product up to which the libraries behind numpy stay with one thread. Where they are
# told to, as in Spark's Python workers, blocks need only fit a cache.
ONE_THREAD = 1 << (20 if os.environ.get("OMP_NUM_THREADS") == "1" else 18)
# Logits up to which exponentials of single precision neither overflow nor vanish.
PLAIN = 60.0


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b, by blocks of rows; held by columns if a is."""
    rows = max(1, ONE_THREAD // (b.shape[0] * b.shape[1]))
    order = "F" if a.flags.f_contiguous else "C"
    out = np.empty((len(a), b.shape[1]), dtype=np.result_type(a, b), order=order)
    for at in range(0, len(a), rows):
        np.matmul(a[at : at + rows], b, out=out[at : at + rows])
    return out


def _dot_down(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b, by blocks of rows of both."""
    rows = max(1, ONE_THREAD // (a.shape[1] * b.shape[1]))
    out = a[:rows].T @ b[:rows]
    for at in range(rows, len(a), rows):
        out += a[at : at + rows].T @ b[at : at + rows]
    return out


def _step(model: Model, x: np.ndarray, h: np.ndarray):
    """The states after ``x``, and what gradients need; all held by columns if h is."""
    gates = model["gates"].take(x, axis=0).T.copy()
    own = np.ascontiguousarray(_dot(h, model["recurrent"]).T)
    both = 2 * HIDDEN
    zr = gates[:both]
    zr += own[:both]
    zr *= 0.5  # the logistic function by way of tanh
    np.tanh(zr, out=zr)
    zr += 1
    zr *= 0.5
    z, r, own_n = gates[:HIDDEN], gates[HIDDEN:both], own[both:]
    n = r * own_n
    n += gates[both:]
    np.tanh(n, out=n)
    after = h.T - n
    after *= z
    after += n
    return after.T, z.T, r.T, n.T, own_n.T


def _plain(model: Model) -> tuple[bool, np.ndarray]:
    """Whether the logits of the classes, and of each class's members, are small for any state.

    The values of a state lie between -1 and 1, so sums of weights bound its logits.
    """
    by_class = (np.abs(model["class"]).sum(axis=0) + np.abs(model["class_bias"])).max() < PLAIN
    members = (np.abs(model["member"]).sum(axis=1) + np.abs(model["member_bias"])).max(axis=1) < PLAIN
    return bool(by_class), members


_ONES = np.ones(max(CLASSES, MEMBERS), dtype=np.float32)


def _row_sums(x: np.ndarray) -> np.ndarray:
    """As a product, which is several times as fast as a sum along short rows."""
    return x @ _ONES[: x.shape[1]].astype(x.dtype, copy=False)


def _log_sum(x: np.ndarray, plain: bool) -> np.ndarray:
    """Logarithms of the rows' sums of exponentials; x is used up."""
    if plain:
        return np.log(_row_sums(np.exp(x, out=x)))
    top = x.max(axis=1)
    x -= top[:, None]
    return top + np.log(_row_sums(np.exp(x, out=x)))


def _softmax(x: np.ndarray, plain: bool, scale: np.ndarray | float = 1) -> np.ndarray:
    """The rows' probabilities times ``scale``, in the place of x."""
    if not plain:
        x -= x.max(axis=1)[:, None]
    np.exp(x, out=x)
    x *= (scale / _row_sums(x))[:, None]
    return x


def _blocks(n: int) -> Iterator[slice]:
    """Rows whose classes' logits fit a core's own cache, and their products one thread."""
    rows = max(1, min(TOGETHER, ONE_THREAD // ((HIDDEN + 1) * CLASSES)))
    for at in range(0, n, rows):
        yield slice(at, min(n, at + rows))


def _with_biases(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and of their members, the biases as those of a last value that is always 1."""
    by_class = np.concatenate([model["class"], model["class_bias"][None]])
    return by_class, np.concatenate([model["member"], model["member_bias"][:, None]], axis=1)


def log_probabilities(model: Model, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of outcomes ``y`` after states ``h``."""
    states = np.ones((len(y), HIDDEN + 1), dtype=h.dtype)
    states[:, :HIDDEN] = h
    return _log_probabilities(model, states, y, _plain(model), _with_biases(model))


def _log_probabilities(model: Model, states: np.ndarray, y: np.ndarray, plain, weights) -> np.ndarray:
    by_class, by_member = weights
    cls, member = y // MEMBERS, y % MEMBERS
    row = np.arange(TOGETHER)
    out = np.empty(len(y), dtype=states.dtype)
    for block in _blocks(len(y)):
        logits = states[block] @ by_class
        own = logits[row[: len(logits)], cls[block]]
        own -= _log_sum(logits, plain[0])
        out[block] = own
    order, groups = _by_class(cls)
    states, member = states.take(order, axis=0), member[order]
    logs = np.empty(len(y), dtype=states.dtype)
    for rows, parts in groups:
        logits = np.empty((rows.stop - rows.start, MEMBERS), dtype=states.dtype)
        for c, part in parts:
            np.matmul(states[part], by_member[c], out=logits[part.start - rows.start : part.stop - rows.start])
        own = logits[row[: len(logits)], member[rows]]
        own -= _log_sum(logits, all(plain[1][c] for c, _ in parts))
        logs[rows] = own
    out[order] += logs
    return out


# Rows whose members' logits are turned into probabilities together, whatever their classes.
TOGETHER = 1024


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, list[tuple[int, slice]]]]]:
    """The order of rows by class, and groups of consecutive rows, each with its classes and their rows."""
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(cls, minlength=CLASSES)).tolist()
    groups: list[tuple[slice, list[tuple[int, slice]]]] = []
    for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
        for block in _blocks(b - a):
            part = slice(a + block.start, a + block.stop)
            if groups and part.stop - groups[-1][0].start <= TOGETHER:
                rows, parts = groups[-1]
                groups[-1] = (slice(rows.start, part.stop), [*parts, (c, part)])
            else:
                groups.append((part, [(c, part)]))
    return order, groups


# Sequences that are scored side by side: their states stay in a core's cache.
BESIDE = 512


def score(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """The natural log-likelihood of each whole sequence of outcomes."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    plain, weights = _plain(model), _with_biases(model)
    out = np.zeros(len(order))
    for at in range(0, len(order), BESIDE):
        own = order[at : at + BESIDE]
        out[own] = _scored_beside(model, [sequences[i] for i in own], plain, weights)
    return out


def _scored_beside(model: Model, sequences: list[np.ndarray], plain, weights) -> np.ndarray:
    """Of sequences in the order of their lengths, the longest first."""
    lengths = np.array([len(s) for s in sequences])
    flat = np.concatenate(sequences)
    first = np.cumsum(lengths) - lengths
    # How many sequences are longer than t, and in how many rows their outcomes up to t lie, step by step.
    longer = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    rows = np.append(0, np.cumsum(longer))
    total = np.zeros(len(lengths))
    halved = _halved(model)
    h = np.zeros((longer[0] if len(longer) else 0, HIDDEN), dtype=np.float32, order="F")
    x = np.full(len(h), OUTCOMES, dtype=np.int64)
    at = 0
    while at < len(longer):
        to = max(at + 1, int(np.searchsorted(rows, rows[at] + WINDOW * len(lengths), side="right")) - 1)
        active = longer[at:to]
        start = rows[at:to] - rows[at]
        owner = np.arange(rows[to] - rows[at]) - np.repeat(start, active)
        truth = flat[first[owner] + np.repeat(np.arange(at, to), active)]
        states = np.ones((len(truth), HIDDEN + 1), dtype=np.float32)
        for a, n in zip(start.tolist(), active.tolist()):
            if n < len(h):
                h, x = h[:n].copy(order="F"), x[:n]
            h = _next(halved, x, h)
            x = truth[a : a + n]
            states[a : a + n, :HIDDEN] = h
        logs = _log_probabilities(model, states, truth, plain, weights)
        total += np.bincount(owner, logs, len(total))
        at = to
    return total


def _halved(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a logistic function by way of tanh: all but those a word gives the new state directly."""
    gates = model["gates"].copy()
    gates[:, : 2 * HIDDEN] *= 0.5
    return gates, model["recurrent"] * np.float32(0.5)


def _next(halved: tuple[np.ndarray, np.ndarray], x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The states of ``_step`` alone, in fewer steps."""
    both = 2 * HIDDEN
    gates = halved[0].take(x, axis=0).T
    own = _dot(h, halved[1]).T
    zr, n = own[:both], own[both:]
    zr += gates[:both]
    np.tanh(zr, out=zr)
    own_n = n * zr[HIDDEN:]
    n += own_n
    n += gates[both:]
    np.tanh(n, out=n)
    rest = h.T - n
    after = rest * zr[:HIDDEN]
    after += rest
    after *= 0.5
    after += n
    return after.T


# --- training -----------------------------------------------------------------------------------


def _window_gradients(
    model: Model,
    x: np.ndarray,
    y: np.ndarray,
    fresh: np.ndarray,
    h0: np.ndarray,
    real: np.ndarray | None = None,
):
    """Gradients over one window (steps, streams) of truncated backpropagation, and the last state.

    Places that are not ``real`` pad the ends of streams and teach nothing.
    """
    steps, streams = x.shape
    h, tape = np.asfortranarray(h0), []
    states = np.ones((steps, streams, HIDDEN + 1), dtype=h0.dtype)
    anew = fresh.any(axis=1).tolist()
    for t in range(steps):
        before = h
        if anew[t]:
            before = h.copy(order="F")
            before[fresh[t]] = 0
        h, z, r, n, own = _step(model, x[t], before)
        tape.append((before.T, z.T, r.T, n.T, own.T))
        states[t, :, :HIDDEN] = h
    states = states.reshape(-1, HIDDEN + 1)
    truth = y.reshape(-1)
    real = np.ones(len(truth)) if real is None else real.reshape(-1)
    scale = (real / real.sum()).astype(h0.dtype)
    plain, plain_members = _plain(model)
    by_class, by_member = _with_biases(model)
    d_class, d_member = np.zeros_like(by_class), np.zeros_like(by_member)
    cls, member = truth // MEMBERS, truth % MEMBERS
    row = np.arange(TOGETHER)
    d_states = np.empty((len(truth), HIDDEN), dtype=h0.dtype)
    for block in _blocks(len(truth)):
        p = _softmax(states[block] @ by_class, plain, scale[block])
        p[row[: len(p)], cls[block]] -= scale[block]
        np.matmul(p, model["class"].T, out=d_states[block])
        d_class += states[block].T @ p
    order, groups = _by_class(cls)
    states, member, scale = states.take(order, axis=0), member[order], scale[order]
    d_sorted = np.empty_like(d_states)
    for rows, parts in groups:
        logits = np.empty((rows.stop - rows.start, MEMBERS), dtype=h0.dtype)
        places = [slice(part.start - rows.start, part.stop - rows.start) for _, part in parts]
        for (c, part), place in zip(parts, places):
            np.matmul(states[part], by_member[c], out=logits[place])
        p = _softmax(logits, all(plain_members[c] for c, _ in parts), scale[rows])
        p[row[: len(p)], member[rows]] -= scale[rows]
        for (c, part), place in zip(parts, places):
            np.matmul(p[place], model["member"][c].T, out=d_sorted[part])
            d_member[c] += states[part].T @ p[place]
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    d_states += d_sorted.take(place, axis=0)
    grads = {
        "gates": np.zeros_like(model["gates"]),
        "recurrent": np.zeros_like(model["recurrent"]),
        "class": d_class[:HIDDEN],
        "class_bias": d_class[HIDDEN],
        "member": d_member[:, :HIDDEN],
        "member_bias": d_member[:, HIDDEN],
    }
    d_states = d_states.reshape(steps, streams, HIDDEN)
    d_gates = np.empty((steps, streams, 3 * HIDDEN), dtype=h0.dtype)
    d_h = np.zeros((HIDDEN, streams), dtype=h0.dtype)
    d_own = np.empty((3 * HIDDEN, streams), dtype=h0.dtype)
    d_z, d_r, d_n = d_own.reshape(3, HIDDEN, streams)
    back = model["recurrent"].T
    for t in reversed(range(steps)):
        before, z, r, n, own = tape[t]
        d_h += d_states[t].T
        rest = 1 - z
        np.multiply(n, n, out=d_n)
        np.subtract(1, d_n, out=d_n)
        d_n *= rest
        d_n *= d_h
        np.subtract(before, n, out=d_z)
        d_z *= d_h
        rest *= z
        d_z *= rest
        np.subtract(1, r, out=d_r)
        d_r *= r
        d_r *= own
        d_r *= d_n
        d_gates[t] = d_own.T
        d_n *= r
        grads["recurrent"] += _dot_down(before.T, d_own.T)
        d_h *= z
        d_h += _dot(d_own.T, back).T
        if anew[t]:
            d_h[:, fresh[t]] = 0
    found, sums = _sums_by_word(x.reshape(-1), d_gates.reshape(-1, 3 * HIDDEN))
    grads["gates"][found] = sums
    grads["gates"][OUTCOMES] = 0
    return grads, h


# Occurrences of a word in a window up to which they are added to others' of the same rank.
FEW = 16


def _sums_by_word(word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that occur, and the sum of each one's rows.

    The rows of a frequent word are added up by a product, those of all others occurrence by occurrence.
    """
    order = np.argsort(word.astype(np.uint16), kind="stable")
    times = np.bincount(word)
    found = np.flatnonzero(times)
    times = times[found]
    first = np.cumsum(times) - times
    sums = rows.take(order[first], axis=0)
    for no in range(1, FEW):
        more = np.flatnonzero((times > no) & (times <= FEW))
        sums[more] += rows.take(order[first[more] + no], axis=0)
    ones = np.ones(times.max(), dtype=rows.dtype)
    for i in np.flatnonzero(times > FEW).tolist():
        own = rows.take(order[first[i] : first[i] + times[i]], axis=0)
        np.matmul(ones[: len(own)], own, out=sums[i])
    return found, sums


class _Adam:
    """Adam over the arrays of a model, with gradients clipped to a norm of 1; they are used up."""

    def __init__(self, model: Model):
        self.steps = 0
        self.mean = {k: np.zeros_like(v) for k, v in model.items()}
        self.square = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, model: Model, grads: Model, rate: float) -> None:
        self.steps += 1
        size = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        clip = min(1.0, 1.0 / (size + 1e-9))
        # Step sizes with the means' start from zero made good.
        by_mean, by_square = 1 - 0.9**self.steps, 1 - 0.995**self.steps
        for k, g in grads.items():
            mean, square = self.mean[k], self.square[k]
            g *= np.float32(0.1 * clip)
            mean *= np.float32(0.9)
            mean += g
            g *= g  # a hundredth of the gradient's square, and so all of ``square``
            square *= np.float32(0.995)
            square += g
            # rate x mean / by_mean / (sqrt(0.5 x square / by_square) + 1e-6)
            np.sqrt(square, out=g)
            g += np.float32(1e-6 * math.sqrt(2 * by_square))
            np.divide(mean, g, out=g)
            g *= np.float32(rate / by_mean * math.sqrt(2 * by_square))
            model[k] -= g


def train(
    sequences: list[np.ndarray],
    frequency: np.ndarray,
    steps: int,
    streams: int = 96,
    window: int = 16,
    rate: float = 0.01,
    seed: int = 3,
) -> Model:
    """Truncated backpropagation through time over streams of texts, with Adam.

    Texts follow one another in a stream; the state is handed from window to window and starts anew with
    each text. ``steps`` windows are seen, however many texts there are.
    """
    rng = np.random.default_rng(seed)
    model = new_model(frequency, rng)
    sequences = [s for s in sequences if len(s)]
    if not sequences:
        return model
    x = np.concatenate([np.concatenate([[OUTCOMES], s[:-1]]) for s in sequences])
    y = np.concatenate(sequences)
    fresh = x == OUTCOMES
    start = rng.integers(0, len(y), streams)  # each stream runs from its own place, around the end
    h = np.zeros((streams, HIDDEN), dtype=np.float32)
    adam = _Adam(model)
    for step in range(1, steps + 1):
        at = (start[None, :] + np.arange(window)[:, None] + (step - 1) * window) % len(y)
        grads, h = _window_gradients(model, x[at], y[at], fresh[at], h)
        adam.step(model, grads, rate * min(1.0, 2 * (1 - step / (steps + 1))))
    return model


def _pieces(sequence: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of what is read, what comes next, and where a state begins."""
    if not len(sequence):
        return
    rows = np.zeros((3, len(sequence)), dtype=np.int32)
    rows[0, 0], rows[0, 1:], rows[1] = OUTCOMES, sequence[:-1], sequence
    rows[2, ::PIECE] = 1
    for at in range(0, len(sequence), PIECE):
        yield rows[:, at : at + PIECE]


def learn(
    model: Model,
    batches: Iterable[list[np.ndarray]],
    rate: float,
    streams: int = 512,
    window: int = 16,
) -> tuple[Model, int]:
    """The model after one pass over every token of all sequences, and the number of tokens.

    Sequences follow one another in ``streams`` streams, each put where the fewest tokens wait; one longer
    than ``PIECE`` goes on in another stream, from a state of its own, so that no stream outlasts the others.
    Windows run while all streams can fill them; what is left waits for the next batch, and at the end
    streams drop out one by one. Windows of few tokens are added up to one step.
    """
    model = {k: v.copy() for k, v in model.items()}
    adam = _Adam(model)
    waiting = [np.zeros((3, 0), dtype=np.int32)] * streams
    h = np.zeros((streams, HIDDEN), dtype=np.float32)
    total, held, sums = 0, 0, None

    def run(rounds: int) -> None:
        nonlocal held, sums
        size = np.array([w.shape[1] for w in waiting])
        # Side by side, as long as the longest; what is beyond a stream's end is not real.
        every = np.zeros((3, rounds * window, streams), dtype=np.int64)
        for stream, w in enumerate(waiting):
            held_here = min(size[stream], rounds * window)
            every[:, :held_here, stream] = w[:, :held_here]
        for no in range(rounds):
            n = np.clip(size - no * window, 0, window)
            active = np.flatnonzero(n)
            xy = every[:, no * window : (no + 1) * window]
            xy = xy if len(active) == streams else xy[:, :, active]
            full = n[active].min() == window
            real = None if full else np.arange(window)[:, None] < n[active]
            grads, h[active] = _window_gradients(
                model, xy[0], xy[1], xy[2] > 0, h[active], real
            )
            count = int(n.sum())
            if not held and count * 2 >= streams * window:
                adam.step(model, grads, rate)
                continue
            part = {k: g * np.float32(count) for k, g in grads.items()}
            sums = {k: sums[k] + g for k, g in part.items()} if held else part
            held += count
            if held * 2 >= streams * window:
                step()

    def step() -> None:
        nonlocal held, sums
        adam.step(model, {k: g / np.float32(held) for k, g in sums.items()}, rate)
        held, sums = 0, None

    for sequences in batches:
        queue = [(w.shape[1], i) for i, w in enumerate(waiting)]
        heapq.heapify(queue)
        parts = [[w] for w in waiting]
        pieces = [piece for s in sequences for piece in _pieces(s)]
        for piece in sorted(pieces, key=lambda p: -p.shape[1]):
            n, i = queue[0]
            parts[i].append(piece)
            heapq.heapreplace(queue, (n + piece.shape[1], i))
            total += piece.shape[1]
        waiting = [np.concatenate(p, axis=1) for p in parts]
        rounds = min(w.shape[1] for w in waiting) // window
        run(rounds)
        waiting = [w[:, rounds * window :].copy() for w in waiting]
    run(-(-max(w.shape[1] for w in waiting) // window))
    if held:
        step()
    return model, total
