"""A gated recurrent language model in numpy with a class-factored output layer.

P(token | history) = P(class | state) P(token | class, state).  The vocabulary's words are dealt to classes of about equal
frequency mass with at most ``CLASS_WORDS`` members each, with a softmax over the members.  All other words
belong to open classes, by a hash of their first characters; within those a word has the share of its corpus count.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Sizes: words of the vocabulary, classes they are dealt to, members of a class at most, open classes, embedding, state.
VOCABULARY, CLASSES, CLASS_WORDS, OPEN_CLASSES, EMBED, STATE = 1024, 24, 64, 32, 16, 16
#: Steps of truncated backpropagation, sequences that run side by side, and tokens after which training begins a new state.
STEPS, LANES, PIECE = 20, 128, 1000
#: Rows whose scores of classes are held at once.
CHUNK = 1024

END = b"\n"  # no word is a line feed


def open_class(word: bytes) -> int:
    """Open class of a word outside the vocabulary."""
    return zlib.crc32(word[:3]) % OPEN_CLASSES


class Vocabulary:
    """Ids: 0 is the end, then the words from the most frequent on, then one for each open class."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.words = [END, *words]
        self.index = {w: i for i, w in enumerate(self.words)}
        size = len(self.words)
        mass = np.cumsum(np.maximum(np.array(counts, float), 1.0))
        of = np.zeros(size, np.int64)
        label = members = 0
        for i in range(1, size):
            of[i] = label
            members += 1
            if members >= CLASS_WORDS or (label < CLASSES - 1 and mass[i - 1] >= mass[-1] * (label + 1) / CLASSES):
                label, members = label + 1, 0
        of = np.unique(of, return_inverse=True)[1]
        self.closed = int(of.max()) + 1
        self.class_of = np.concatenate([of, self.closed + np.arange(OPEN_CLASSES)])
        self.members = [np.flatnonzero(of == k) for k in range(self.closed)]
        self.slot = np.zeros(size, np.int64)
        for m in self.members:
            self.slot[m] = np.arange(len(m))
        self.size = size

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Ids of an Arrow array of words; each different start of a word outside the vocabulary is hashed once."""
        out = np.array(pc.index_in(words, value_set=pa.array(self.words, pa.binary())).fill_null(-1))
        if (out < 0).any():
            start = pc.binary_slice(words.filter(pa.array(out < 0)), 0, 3).dictionary_encode()
            out[out < 0] = np.array([self.size + open_class(w) for w in start.dictionary.to_pylist()], np.int32)[start.indices.to_numpy()]
        return out

    def ids(self, words: list[bytes], cache: dict[bytes, int]) -> list[int]:
        """Ids of words; ``cache`` keeps those of words outside the vocabulary and is emptied when large."""
        if len(cache) > 400_000:
            cache.clear()
        get, out = self.index.get, []
        for w in words:
            i = get(w)
            if i is None:
                i = cache.get(w)
                if i is None:
                    i = cache[w] = self.size + open_class(w)
            out.append(i)
        return out


NAMES = ("embed", "input", "bias", "hidden", "to_class", "class_bias", "to_word", "word_bias")


def initial(vocabulary: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    n, classes = vocabulary.size, vocabulary.closed + OPEN_CLASSES
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {
        "embed": (0.3 * rng.standard_normal((n + OPEN_CLASSES, EMBED))).astype(np.float32), "input": draw(EMBED, 3 * STATE), "bias": np.zeros(3 * STATE, np.float32),
        "hidden": draw(STATE, 3 * STATE), "to_class": 0.3 * draw(STATE, classes), "class_bias": np.zeros(classes, np.float32),
        "to_word": (0.05 * rng.standard_normal((n, STATE))).astype(np.float32), "word_bias": np.zeros(n, np.float32),
    }


def lanes(documents: list[np.ndarray], width: int = LANES, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Deal documents to lanes, longest first to the shortest lane: whole, or in pieces of at most ``most`` tokens.

    Returns inputs and targets (step, lane; -1 beyond the lane's end), where a state begins, and the document of each cell.
    A document's inputs start with the end mark, its targets finish with it.  A later piece begins with the token before it and a new state.
    """
    pieces = [(i, a, min(a + (most or len(d) + 1), len(d) + 1)) for i, d in enumerate(documents) for a in range(0, len(d) + 1, most or len(d) + 1)]
    length = [b - a for _, a, b in pieces]
    # no more lanes than fill the longest piece's steps twice: the arrays stay in proportion to the tokens
    width = max(1, min(width, len(pieces), 2 * sum(length) // max(length, default=1) + 1))
    heap = [(0, k) for k in range(width)]
    dealt: list[list[tuple[int, int, int]]] = [[] for _ in range(width)]
    for i, a, b in sorted(pieces, key=lambda x: (x[1] - x[2], x)):
        length, k = heapq.heappop(heap)
        dealt[k].append((i, a, b))
        heapq.heappush(heap, (length + b - a, k))
    size = lambda own: sum(b - a for _, a, b in own)
    dealt.sort(key=lambda own: -size(own))
    steps = size(dealt[0])
    inputs, targets = np.zeros((steps, width), np.int32), np.full((steps, width), -1, np.int32)
    begins, of = np.zeros((steps, width), bool), np.full((steps, width), -1, np.int32)
    for k, own in enumerate(dealt):
        at = 0
        for i, a, b in own:
            d, n = documents[i], b - a
            inputs[at + (a == 0) : at + n, k] = d[max(a - 1, 0) : b - 1]
            targets[at : at + n, k] = 0
            targets[at : at + min(b, len(d)) - a, k] = d[a:b]
            begins[at, k] = True
            of[at : at + n, k] = i
            at += n
    return inputs, targets, begins, of


def _exps(score: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """exp of scores, in place, and 1 / its sums by row; rows are shifted by their largest score unless no exp can leave the numbers' range."""
    if not safe:
        score -= score.max(axis=1, keepdims=True)
    np.exp(score, out=score)
    return score, 1 / (score @ np.ones(score.shape[1], score.dtype))


def run_window(p: dict[str, np.ndarray], v: Vocabulary, table: np.ndarray, inputs, targets, begins, h: np.ndarray, learn: bool):
    """One window of steps: log probabilities of the targets (0 where there is none), the last state, and gradients.

    Inside, states and gates lie lane by lane (unit, lane), so that every step works on whole arrays; a last column of ones carries the biases.
    """
    steps, width = inputs.shape
    s, kind = STATE, table.dtype
    sign = np.repeat(np.array([-1, 1], kind), [2 * s, s])  # exp(-x) is what the gates are made of
    u = np.ascontiguousarray((p["hidden"] * sign).T)
    added = np.ascontiguousarray((table * sign)[inputs].transpose(0, 2, 1))
    keep, new = (~begins).astype(kind), begins.any(axis=1)
    states, h = np.empty((steps, s, width), kind), np.ascontiguousarray(h.T, kind)
    gates, news = np.empty((steps, 3 * s, width), kind), np.empty((steps, s, width), kind)
    before = np.empty((steps, s, width), kind) if learn else None
    with np.errstate(over="ignore"):
        for t in range(steps):
            if new[t]:
                h = h * keep[t]
            g, n = np.matmul(u, h, out=gates[t]), news[t]
            d = g[: 2 * s]  # 1 / d are the gates z and r
            d += added[t, : 2 * s]
            np.exp(d, out=d)
            d += 1
            np.divide(g[2 * s :], d[s:], out=n)
            n += added[t, 2 * s :]
            np.tanh(n, out=n)
            if learn:
                before[t] = h
            h = np.subtract(h, n, out=states[t])
            h /= d[:s]
            h += n
    flat = np.ones((steps * width, s + 1), kind)
    flat.reshape(steps, width, s + 1)[:, :, :s] = states.transpose(0, 2, 1)
    goal = targets.ravel()
    some = np.flatnonzero(goal >= 0)
    label = v.class_of[goal[some]].astype(np.uint16)
    by = np.argsort(label, kind="stable")  # of 16 bits: by radix
    some, label = some[by], label[by]
    x, y = flat[some], goal[some]
    rows = np.arange(len(y))
    to_class, to_word = np.vstack([p["to_class"], p["class_bias"]]), np.column_stack([p["to_word"], p["word_bias"]])
    # no state is beyond 1, so weights bound the scores
    safe = [np.abs(to_class).sum(axis=0).max() <= 60, np.abs(to_word).sum(axis=1).max() <= 60]
    chosen, grads, dx = np.empty(len(y), kind), None, None
    if learn:
        grads, dx = {k: np.zeros_like(a) for k, a in p.items()}, np.empty((len(y), s), kind)
        into_class, into_word = np.zeros_like(to_class), np.zeros_like(to_word)
    for a in range(0, len(y), CHUNK):  # rows whose scores stay in the processor's cache
        own = slice(a, a + CHUNK)
        share, part_of = _exps(x[own] @ to_class, safe[0])
        at = rows[: len(share)], label[own]
        chosen[own] = share[at] * part_of
        if learn:
            share *= part_of[:, None]
            share[at] -= 1
            np.matmul(share, p["to_class"].T, out=dx[own])
            into_class += x[own].T @ share
    log_p = np.log(np.maximum(chosen, 1e-30))
    edge = np.searchsorted(label, np.arange(v.closed + 1)).tolist()
    slot = v.slot[np.minimum(y, v.size - 1)]
    for k, m in enumerate(v.members):
        own, of = slice(edge[k], edge[k + 1]), slice(m[0], m[-1] + 1)  # a class has neighbouring ids
        if edge[k] < edge[k + 1] and len(m) > 1:
            part, part_of = _exps(x[own] @ to_word[of].T, safe[1])
            at = rows[: len(part)], slot[own]
            chosen[own] = part[at] * part_of
            if learn:
                part *= part_of[:, None]
                part[at] -= 1
                dx[own] += part @ to_word[of, :s]
                into_word[of] = part.T @ x[own]
        else:
            chosen[own] = 1
    chosen[edge[-1] :] = 1
    log_p += np.log(np.maximum(chosen, 1e-30))
    out = np.zeros(steps * width, np.float32)
    out[some] = log_p
    if learn:
        grads["to_class"], grads["class_bias"] = into_class[:s], into_class[s]
        grads["to_word"], grads["word_bias"] = np.ascontiguousarray(into_word[:, :s]), into_word[:, s].copy()
        dflat = np.zeros((steps * width, s), kind)
        dflat[some] = dx
        dstates = np.ascontiguousarray(dflat.reshape(steps, width, s).transpose(0, 2, 1))
        # what a change of the state, times these, is for each gate's sum, whole windows at once
        zr = 1 / gates[:, : 2 * s]
        z, r = zr[:, :s], zr[:, s:]
        for_n = (1 - z) * (1 - news * news)
        factor = np.empty((steps, 3, s, width), kind)
        factor[:, 0] = (before - news) * z * (1 - z)
        factor[:, 1] = for_n * gates[:, 2 * s :] * r * (1 - r)
        factor[:, 2] = for_n * r
        dh, hidden = np.zeros((s, width), kind), np.ascontiguousarray(p["hidden"])
        for t in range(steps - 1, -1, -1):
            change = dstates[t]
            change += dh
            factor[t] *= change
            dh = hidden @ factor[t].reshape(3 * s, width)
            dh += change * z[t]
            if new[t]:
                dh *= keep[t]
        grads["hidden"] = np.matmul(before, factor.reshape(steps, 3 * s, width).transpose(0, 2, 1)).sum(axis=0)
        factor[:, 2] = dstates * for_n
        changes = factor.reshape(steps, 3 * s, width)
        token = inputs.ravel().astype(np.uint16)
        by = np.argsort(token, kind="stable")
        first = np.flatnonzero(np.diff(token[by].astype(np.int32), prepend=-1))
        # each cell's change of its token's embedding, summed by token
        each = np.matmul(p["input"], changes).transpose(1, 0, 2).reshape(EMBED, -1)
        grads["embed"][token[by[first]]] = np.add.reduceat(each[:, by], first, axis=1).T
        grads["bias"] = changes.sum(axis=(0, 2))
        grads["input"] = np.matmul(p["embed"].T[:, inputs].transpose(1, 0, 2), changes.transpose(0, 2, 1)).sum(axis=0)
    return out.reshape(steps, width), h.T, grads


def input_table(p: dict[str, np.ndarray]) -> np.ndarray:
    """What each token adds to the gates."""
    return p["embed"] @ p["input"] + p["bias"]


def train(p: dict[str, np.ndarray], v: Vocabulary, documents: list[np.ndarray], memory: dict | None = None, rate: float = 0.01, width: int = LANES, steps: int = STEPS) -> dict:
    """One pass of truncated backpropagation over whole documents; states run on from window to window of a piece, gradients don't.

    Changes ``p`` by Adam and returns the optimiser's memory.
    """
    memory = memory if memory is not None else {"step": 0, "m": {k: np.zeros_like(a) for k, a in p.items()}, "s": {k: np.zeros_like(a) for k, a in p.items()}}
    if not documents:
        return memory
    inputs, targets, begins, _ = lanes(documents, width, PIECE)
    h = np.zeros((inputs.shape[1], STATE), np.float32)
    for t in range(0, len(inputs), steps):
        live = int((targets[t] >= 0).sum())
        cut = slice(t, t + steps)
        _, h, grads = run_window(p, v, input_table(p), inputs[cut, :live], targets[cut, :live], begins[cut, :live], h[:live], True)
        tokens = max(int((targets[cut, :live] >= 0).sum()), 1)
        memory["step"] += 1
        k = memory["step"]
        for name in NAMES:
            g = grads[name] / tokens
            m, s = memory["m"][name], memory["s"][name]
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            p[name] -= np.float32(rate / (1 - 0.9**k)) * m / (np.sqrt(s / np.float32(1 - 0.99**k)) + np.float32(1e-6))
    return memory


def log_likelihoods(p: dict[str, np.ndarray], v: Vocabulary, documents: list[np.ndarray], width: int = LANES, steps: int = 64) -> np.ndarray:
    """Natural log probability of each whole document, its end included; a word of an open class counts as its class."""
    total = np.zeros(len(documents))
    if not documents:
        return total
    inputs, targets, begins, of = lanes(documents, width)
    table = input_table(p)
    h = np.zeros((inputs.shape[1], STATE), np.float32)
    for t in range(0, len(inputs), steps):
        live = int((targets[t] >= 0).sum())
        cut = slice(t, t + steps)
        log_p, h, _ = run_window(p, v, table, inputs[cut, :live], targets[cut, :live], begins[cut, :live], h[:live], False)
        own = of[cut, :live].ravel()
        some = own >= 0
        total += np.bincount(own[some], weights=log_p.ravel()[some], minlength=len(documents))
    return total
