"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Tokens are numbers: first the words of the vocabulary, ``CLASS_WORDS`` to a
class by rank, then the end of a text, then the classes of rarer words. The
output first chooses a class; within a class of the vocabulary the state
chooses the word, the words of a rare class follow their counts (see lm.py).
"""

from __future__ import annotations

import ctypes
import heapq

import numpy as np

HIDDEN = 16
CLASS_WORDS = 64
CLASSES = 32
VOCABULARY = CLASS_WORDS * CLASSES
END = VOCABULARY
RARE = 8
INPUTS = VOCABULARY + 1 + RARE
OUTPUTS = CLASSES + 1 + RARE
WINDOW = 32
LANES = 256  # of texts that are scored
SCORE_WINDOW = 64
TRAIN_LANES = 512
RATE = 0.014

Weights = dict[str, np.ndarray]


def start_weights(class_bias: np.ndarray, word_bias: np.ndarray) -> Weights:
    """Small random weights; the biases make the untrained model the class-factored unigram model."""
    random = np.random.default_rng(3)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    return {
        "inputs": normal(INPUTS, 3 * HIDDEN, scale=0.1),
        "state": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "state_bias": np.zeros(3 * HIDDEN, dtype=np.float32),
        "classes": normal(HIDDEN, OUTPUTS, scale=0.05),
        "class_bias": class_bias.astype(np.float32),
        "words": normal(CLASSES, HIDDEN, CLASS_WORDS, scale=0.05),
        "word_bias": word_bias.astype(np.float32),
    }


def flatten(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in sorted(weights)])


def unflatten(flat: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for name in sorted(like):
        size = like[name].size
        out[name] = flat[at : at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    return out


def class_of(tokens: np.ndarray) -> np.ndarray:
    return np.where(tokens < VOCABULARY, tokens // CLASS_WORDS, tokens - VOCABULARY + CLASSES)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of ``x``."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _outputs(states: np.ndarray, slopes: np.ndarray, bias: np.ndarray) -> np.ndarray:
    x = states @ slopes
    x += bias
    return x


def _step(weights: Weights, given: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    own = _outputs(state, weights["state"], weights["state_bias"])
    gates = _sigmoid(given[:, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
    reset, keep = gates[:, :HIDDEN], gates[:, HIDDEN:]
    fresh = reset * own[:, 2 * HIDDEN :]
    fresh += given[:, 2 * HIDDEN :]
    np.tanh(fresh, out=fresh)
    new = state - fresh
    new *= keep
    new += fresh
    return new, reset, keep, fresh, own[:, 2 * HIDDEN :]


def keep_memory() -> None:
    """Let this process keep freed memory for its next arrays.

    By default the C library returns every array of some megabytes to the
    system, which then clears the same pages for the next one; that takes as
    long as the sums. What is kept is what the largest block needed.
    """
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):  # another C library
        return
    # The names M_TRIM_THRESHOLD, M_TOP_PAD and M_MMAP_THRESHOLD stand for
    for option, size in ((-1, 256 << 20), (-2, 16 << 20), (-3, 32 << 20)):
        mallopt(option, size)


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers in place of the rows less one number that keeps them in range, and their sums.

    Rows differ by what a state adds to the log counts, far less than float32
    can span; a row beyond that is taken by its own maximum.
    """
    top = x.max()
    sums = x - top
    np.exp(sums, out=sums)
    total = sums @ np.ones(x.shape[1], dtype=x.dtype)
    if total.size and total.min() < 1e-30:
        sums = np.exp(x - x.max(axis=1, keepdims=True))
        total = sums.sum(axis=1)
    return sums, total


def _softmax(x: np.ndarray) -> np.ndarray:
    powers, total = _exp(x)
    powers /= total[:, None]
    return powers


def _chosen_logs(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log softmax of one entry of each row."""
    powers, total = _exp(x)
    entry = powers[np.arange(len(x)), chosen]
    if entry.size and entry.min() < 1e-30:
        x = x - x.max(axis=1, keepdims=True)
        return x[np.arange(len(x)), chosen] - np.log(np.exp(x).sum(axis=1))
    return np.log(entry / total)


def _sums_by(keys: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each key, by sorting."""
    order = np.argsort(keys.astype(np.int16), kind="stable")  # 16 bits are sorted by digits
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.zeros((size, rows.shape[1]), dtype=rows.dtype)
    sums[keys[cuts]] = np.add.reduceat(rows[order], cuts, axis=0)
    return sums


def _by_class(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the tokens by class, and where each class of the vocabulary begins in it."""
    order = np.argsort(classes.astype(np.int16), kind="stable")
    return order, np.searchsorted(classes[order], np.arange(CLASSES + 1))


def token_logs(weights: Weights, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log probability of each token after each state; a rare token's is that of its class."""
    classes = class_of(tokens)
    order, cuts = _by_class(classes)
    states, tokens, classes = states[order], tokens[order], classes[order]
    logs = _chosen_logs(_outputs(states, weights["classes"], weights["class_bias"]), classes)
    for c in range(CLASSES):
        rows = slice(cuts[c], cuts[c + 1])
        if cuts[c + 1] > cuts[c]:
            inner = _outputs(states[rows], weights["words"][c], weights["word_bias"][c])
            logs[rows] += _chosen_logs(inner, tokens[rows] - c * CLASS_WORDS)
    unsorted = np.empty_like(logs)
    unsorted[order] = logs
    return unsorted


def _lanes(lengths: list[int]) -> list[list[int]]:
    """Texts dealt to lanes, the longest first and each to the shortest lane; the lanes by falling length."""
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    heap = [(0, lane) for lane in range(min(LANES, len(order)))]
    lanes: list[list[int]] = [[] for _ in heap]
    for i in order:
        load, lane = heap[0]
        lanes[lane].append(i)
        heapq.heapreplace(heap, (load + lengths[i], lane))
    return sorted(lanes, key=lambda lane: -sum(lengths[i] for i in lane))


def score_texts(weights: Weights, texts: list[np.ndarray]) -> np.ndarray:
    """Log probability of each whole text (tokens with their end), by windows with the state carried on.

    Lanes run side by side, and one takes its next text where the last ended,
    with a new state. A window handles the lanes that still have tokens, so no
    text is cut and none waits for another.
    """
    scores = np.zeros(len(texts))
    lanes = _lanes([len(text) for text in texts])
    streams = [np.concatenate([texts[i] for i in lane]) for lane in lanes]
    cuts = [np.cumsum([0, *(len(texts[i]) for i in lane[:-1])]) for lane in lanes]
    goes_on = [np.ones(len(stream), dtype=np.float32) for stream in streams]
    for lane, begins in zip(goes_on, cuts, strict=True):
        lane[begins] = 0
    lengths = np.array([len(stream) for stream in streams])
    logs = [np.empty(n) for n in lengths]
    state = np.zeros((len(lanes), HIDDEN), dtype=np.float32)
    last = np.full(len(lanes), END)
    for start in range(0, int(lengths.max(initial=0)), SCORE_WINDOW):
        active = int(np.searchsorted(-lengths, -start, side="left"))
        steps = min(SCORE_WINDOW, int(lengths[0]) - start)
        tokens = np.full((active, steps), END)
        held = np.zeros((active, steps), dtype=np.float32)
        for j in range(active):
            part = streams[j][start : start + steps]
            tokens[j, : len(part)] = part
            held[j, : len(part)] = goes_on[j][start : start + steps]
        inputs = np.where(held > 0, np.concatenate([last[:active, None], tokens[:, :-1]], axis=1), END).T
        last = tokens[:, -1]
        state, held = state[:active], held.T
        states = np.empty((steps, active, HIDDEN), dtype=np.float32)
        given = weights["inputs"][inputs]
        for t in range(steps):
            # the state that predicts token t has seen all tokens of its text before it
            state = _step(weights, given[t], state * held[t][:, None])[0]
            states[t] = state
        found = token_logs(weights, states.reshape(-1, HIDDEN), tokens.T.ravel()).reshape(steps, active).T
        for j in range(active):
            stop = min(steps, lengths[j] - start)
            logs[j][start : start + stop] = found[j, :stop]
    for lane, begins, values in zip(lanes, cuts, logs, strict=True):
        scores[lane] = np.add.reduceat(values, begins)
    return scores


class Trainer:
    """Adam on windows of texts that run side by side."""

    def __init__(self, weights: Weights, rate: float):
        self.weights = {name: value.copy() for name, value in weights.items()}
        self.mean = {name: np.zeros_like(value) for name, value in weights.items()}
        self.square = {name: np.zeros_like(value) for name, value in weights.items()}
        self.rate, self.steps, self.tokens = rate, 0, 0

    def stream(self, tokens: np.ndarray, begins: np.ndarray) -> None:
        """Learn whole texts that follow each other, each with its end; ``begins`` marks their first tokens.

        The stream is cut into lanes of equal length that run side by side, so
        no step is empty. Windows follow in order; the state goes from each to
        the next, and starts anew where a text does, but gradients do not. Only
        a lane that begins inside a text has no state yet; it starts from the
        word before it.
        """
        lanes = min(TRAIN_LANES, -(-len(tokens) // WINDOW))
        if not lanes:
            return
        length = -(-len(tokens) // lanes)
        inputs = np.concatenate([[END], tokens[:-1]])
        inputs = np.where(begins, END, inputs)

        def across(values: np.ndarray, rest: int) -> np.ndarray:
            padded = np.full(lanes * length, rest, dtype=values.dtype)
            padded[: len(values)] = values
            return np.ascontiguousarray(padded.reshape(lanes, length).T)

        inputs, goes_on = across(inputs, END), across(~begins, 0).astype(np.float32)
        real = across(np.ones(len(tokens), dtype=bool), 0)
        tokens = across(tokens, END)
        state = np.zeros((lanes, HIDDEN), dtype=np.float32)
        for low in range(0, length, WINDOW):
            part = slice(low, low + WINDOW)
            state = self._window(inputs[part], tokens[part], real[part], goes_on[part], state)

    def _window(
        self, inputs: np.ndarray, tokens: np.ndarray, real: np.ndarray, goes_on: np.ndarray, state: np.ndarray
    ) -> np.ndarray:
        w = self.weights
        shape, h = (*tokens.shape, HIDDEN), HIDDEN
        befores, resets, keeps, news, owns, states = (np.empty(shape, dtype=np.float32) for _ in range(6))
        given = w["inputs"][inputs]
        for t in range(len(tokens)):
            befores[t] = state * goes_on[t][:, None]
            state, resets[t], keeps[t], news[t], owns[t] = _step(w, given[t], befores[t])
            states[t] = state
        slopes, back = self._output_slopes(states.reshape(-1, h), tokens.ravel(), real.ravel())
        back = back.reshape(shape)
        # all that does not depend on the slope, for all steps at once
        by_new = (1 - keeps) * (1 - news * news)
        by_reset = by_new * owns * resets * (1 - resets)
        by_keep = (befores - news) * keeps * (1 - keeps)
        by_own = by_new * resets
        to_own = np.empty_like(given)
        slope_at = np.empty(shape, dtype=np.float32)
        carried = np.zeros_like(state)
        back_state = np.ascontiguousarray(w["state"].T)
        for t in range(len(tokens) - 1, -1, -1):
            slope = np.add(back[t], carried, out=slope_at[t])
            np.multiply(slope, by_reset[t], out=to_own[t, :, :h])
            np.multiply(slope, by_keep[t], out=to_own[t, :, h : 2 * h])
            np.multiply(slope, by_own[t], out=to_own[t, :, 2 * h :])
            carried = (slope * keeps[t] + to_own[t] @ back_state) * goes_on[t][:, None]
        flat = to_own.reshape(-1, 3 * h)
        slopes["state"] = befores.reshape(-1, h).T @ flat
        slopes["state_bias"] = flat.sum(axis=0)
        to_own[:, :, 2 * h :] = slope_at * by_new
        slopes["inputs"] = _sums_by(inputs.ravel(), flat, INPUTS)
        self._update(slopes)
        self.tokens += int(real.sum())
        return state

    def _output_slopes(self, states: np.ndarray, tokens: np.ndarray, real: np.ndarray) -> tuple[Weights, np.ndarray]:
        w = self.weights
        classes = class_of(tokens)
        order, cuts = _by_class(classes)
        # in the order of classes, so that the tokens of a class are one slice
        states, tokens, classes = states[order], tokens[order], classes[order]
        weight = real[order][:, None].astype(np.float32) / max(1, int(real.sum()))
        miss = _softmax(_outputs(states, w["classes"], w["class_bias"]))
        miss[np.arange(len(tokens)), classes] -= 1
        miss *= weight
        back = miss @ w["classes"].T
        slopes = {"classes": states.T @ miss, "class_bias": miss.sum(axis=0)}
        slopes["words"], slopes["word_bias"] = np.zeros_like(w["words"]), np.zeros_like(w["word_bias"])
        for c in range(CLASSES):
            rows = slice(cuts[c], cuts[c + 1])
            some = states[rows]
            if not len(some):
                continue
            inner = _softmax(_outputs(some, w["words"][c], w["word_bias"][c]))
            inner[np.arange(len(some)), tokens[rows] - c * CLASS_WORDS] -= 1
            inner *= weight[rows]
            back[rows] += inner @ w["words"][c].T
            slopes["words"][c] = some.T @ inner
            slopes["word_bias"][c] = inner.sum(axis=0)
        unsorted = np.empty_like(back)
        unsorted[order] = back
        return slopes, unsorted

    def _update(self, slopes: Weights) -> None:
        length = np.sqrt(sum(float((s * s).sum()) for s in slopes.values()))
        clip = min(1.0, 1.0 / max(length, 1e-9))
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for name, slope in slopes.items():
            slope *= clip
            self.mean[name] += 0.1 * (slope - self.mean[name])
            self.square[name] += 0.01 * (slope * slope - self.square[name])
            self.weights[name] -= rate * self.mean[name] / (np.sqrt(self.square[name]) + 1e-7)
