"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label.  Every passage is encoded from its characters; a gated attention
network learns from the documents' labels how much each passage counts, and the weighted mean of the passages' codes is scored:

    h = tanh(x W + b),   e = w . (tanh(h V) * sigmoid(h U)),   a = softmax of e over the document,   score = sigmoid(c . sum(a h) + d)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, crc32_fold, documents, map_blocks
from .toxicity import labelled_sample

#: Words of a passage, and passages of a document at most: those of a text with more words are longer, so the whole text is read.
PASSAGE_WORDS, MOST_PASSAGES = 64, 64
#: Bound of the sample the model is learned from (documents of either label, on average), and the share of it that only calibrates.
FIT_DOCS, CALIBRATION = 1_200, 0.2
#: Sizes of the network: hashed three-byte pieces, codes of a passage, gates; documents of a step, passes over the sample, rate and decay.
BUCKETS, CODES, GATES, STEP_DOCS, PASSES, RATE, DECAY = 256, 24, 16, 64, 25, 4e-3, 1e-4
#: Fixed by the task: the score from which on the label 1 is predicted.
CUT = 0.7

#: Bytes that are turned into features at once, and of a block of texts.
_CHUNK, _BLOCK = 250_000, 1_000_000
# Kinds of bytes: other ones, letters, digits, blanks, line ends, marks by their use, and bytes beyond ASCII.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\v\f", "\n\r", ".", ",;:", "!", "?", "'\"`-", "()[]{}", "#*~^", "$%+=", "&@_", "|<>/\\"]
_KIND = np.zeros(256, np.int32)
for _i, _chars in enumerate(_KINDS):
    _KIND[[ord(c) for c in _chars]] = _i + 1
_KIND[128:] = _KIND[ord("a")]
KINDS = len(_KINDS) + 1
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_PAIRS, _STATS = KINDS * KINDS, 5
#: Features of a passage: pairs of kinds, hashed pieces, and a few measures.
FEATURES = _PAIRS + BUCKETS + _STATS


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """(text, start, end) of all bytes in order, in lists of about ``_CHUNK`` bytes; a long text is cut."""
    part, size = [], 0
    for i, x in enumerate(texts):
        for a in range(0, len(x), _CHUNK):
            part.append((i, a, min(a + _CHUNK, len(x))))
            size += part[-1][2] - a
            if size >= _CHUNK:
                yield part
                part, size = [], 0
    if part:
        yield part


def _read(texts: list[bytes], part: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of some pieces with two more of the text behind each (0 where it ends), text of each, whether it counts and whether a word starts there."""
    slices = [texts[i][a : b + 2] + b"\0" * max(0, b + 2 - len(texts[i])) for i, a, b in part]
    raw = np.frombuffer(b"".join(slices), np.uint8)
    size = np.array([len(x) for x in slices])
    of = np.repeat([i for i, _, _ in part], size)
    end = np.cumsum(size)
    own = np.ones(len(raw), bool)
    own[end - 1] = own[end - 2] = False
    space = _SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    before[end - size] = [a == 0 or bool(_SPACE[texts[i][a - 1]]) for i, a, _ in part]
    return raw, of, own, ~space & before & own


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (a row each), and the place of each text's first passage; a text without words has one passage."""
    words = np.zeros(len(texts), np.int64)
    for part in _pieces(texts):
        _, of, _, start = _read(texts, part)
        words += np.bincount(of[start], minlength=len(texts))
    width = np.maximum(PASSAGE_WORDS, -(-words // MOST_PASSAGES))
    number = np.maximum(1, -(-words // width))
    first = np.concatenate([[0], np.cumsum(number)])
    total = int(first[-1])
    kinds, pieces = np.zeros(total * _PAIRS, np.int64), np.zeros(total * BUCKETS, np.int64)
    begun, capital = np.zeros(total, np.int64), np.zeros(total, np.int64)
    done = np.zeros(len(texts), np.int64)
    for part in _pieces(texts):
        raw, of, own, start = _read(texts, part)
        upto = np.cumsum(start)
        edge = np.flatnonzero(np.diff(of, prepend=-1))
        nth = upto - np.repeat(upto[edge] - start[edge], np.diff(np.append(edge, len(of)))) + done[of]
        done += np.bincount(of[start], minlength=len(texts))
        passage = first[of] + np.maximum(nth - 1, 0) // width[of]
        kind, low = _KIND[raw], _LOWER[raw]
        two = np.flatnonzero(own[:-1] & (raw[1:] > 0))
        begin, end = int(passage[0]), int(passage[-1]) + 1  # passages of this part
        passage = passage - begin
        here = lambda n: slice(begin * n, end * n)
        kinds[here(_PAIRS)] += np.bincount(passage[two] * _PAIRS + kind[two] * KINDS + kind[two + 1], minlength=(end - begin) * _PAIRS)
        three = two[two < len(raw) - 2]
        three = three[raw[three + 2] > 0]
        h = (low[three] * _FACTORS[0] + low[three + 1] * _FACTORS[1] + low[three + 2] * _FACTORS[2]) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        pieces[here(BUCKETS)] += np.bincount(passage[three] * BUCKETS + h.astype(np.int64), minlength=(end - begin) * BUCKETS)
        begun[here(1)] += np.bincount(passage[start], minlength=end - begin)
        capital[here(1)] += np.bincount(passage[start & (kind == 2)], minlength=end - begin)
    share = lambda x, n: (x.reshape(total, n) / np.maximum(x.reshape(total, n).sum(axis=1, keepdims=True), 1)).astype(np.float32)
    of_kinds, of_pieces = share(kinds, _PAIRS), share(pieces, BUCKETS)
    bytes_ = kinds.reshape(total, _PAIRS).sum(axis=1)
    stats = np.empty((total, _STATS), np.float32)
    stats[:, 0] = np.log1p(begun) / 5
    stats[:, 1] = 4 * begun / np.maximum(bytes_, 1)
    stats[:, 2] = capital / np.maximum(begun, 1)
    stats[:, 3] = np.log(np.maximum((of_pieces**2).sum(axis=1), 1 / BUCKETS)) / 5 + 1
    stats[:, 4] = begun == 0
    return np.concatenate([np.sqrt(of_kinds), np.sqrt(of_pieces), stats], axis=1), first[:-1]


Weights = dict[str, np.ndarray]


def initial(features: int = FEATURES, seed: int = 11) -> Weights:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"W": draw(features, CODES) * 2, "b": np.zeros(CODES, np.float32), "V": draw(CODES, GATES), "U": draw(CODES, GATES), "w": draw(GATES), "c": draw(CODES), "d": np.zeros(1, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(m: Weights, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """All that the network makes of some documents: ``first`` has the place of each one's first passage."""
    h = np.tanh(x @ m["W"] + m["b"])
    t, u = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * u) @ m["w"]
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    weight = np.exp(e - np.maximum.reduceat(e, first)[of])
    a = weight / np.add.reduceat(weight, first)[of]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return {"h": h, "t": t, "u": u, "a": a, "of": of, "z": z, "s": z @ m["c"] + m["d"]}


def gradient(m: Weights, x: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, Weights]:
    """Mean weighted loss (cross-entropy) of documents with labels 0 and 1, and its gradient."""
    f = forward(m, x, first)
    h, t, u, a, of, z, s = (f[k] for k in ("h", "t", "u", "a", "of", "z", "s"))
    p, n = _sigmoid(s), len(label)
    loss = -(weight * (label * np.log(np.maximum(p, 1e-12)) + (1 - label) * np.log(np.maximum(1 - p, 1e-12)))).sum() / n
    ds = weight * (p - label) / n
    dz = ds[:, None] * m["c"]
    da = (dz[of] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, first)[of])
    dg = de[:, None] * m["w"]
    dt, du = dg * u * (1 - t * t), dg * t * u * (1 - u)
    dh = a[:, None] * dz[of] + dt @ m["V"].T + du @ m["U"].T
    pre = dh * (1 - h * h)
    return float(loss), {"W": x.T @ pre, "b": pre.sum(axis=0), "V": h.T @ dt, "U": h.T @ du, "w": (t * u).T @ de, "c": z.T @ ds, "d": ds.sum(keepdims=True)}


def fit(bags: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> Weights:
    """Adam on groups of documents in an order of its own; the same bags give the same weights."""
    m = initial(bags[0].shape[1])
    mean, square = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    rng, step = np.random.default_rng(5), 0
    steps = PASSES * -(-len(bags) // STEP_DOCS)
    for _ in range(PASSES):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), STEP_DOCS):
            own = order[at : at + STEP_DOCS]
            x = np.concatenate([bags[i] for i in own]).astype(np.float32)
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])[:-1]])
            _, g = gradient(m, x, first, label[own], weight[own])
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k, v in m.items():
                d = g[k] + DECAY * v
                mean[k] += 0.1 * (d - mean[k])
                square[k] += 0.001 * (d * d - square[k])
                v -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def calibrated(s: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0.05) and offset of the logistic curve from scores to labels, by Newton steps with a little decay towards 1 and 0."""
    x, v = np.stack([s, np.ones_like(s)], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(x @ v)
        g = x.T @ (weight * (p - label)) + 1e-2 * (v - [1.0, 0.0])
        v = v - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), g)
        v[0] = min(max(v[0], 0.05), 20.0)
    return float(v[0]), float(v[1])


@dataclass
class Quality:
    """The network with its calibration; without weights all documents get the same score."""

    weights: Weights | None
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, its number of passages, and the largest attention that one of them has."""
        x, first = passages(texts)
        number = np.diff(np.append(first, len(x)))
        if self.weights is None:
            return np.full(len(texts), _sigmoid(np.array(self.offset))), number, 1 / number
        f = forward(self.weights, x, first)
        return _sigmoid(self.slope * f["s"].astype(float) + self.offset), number, np.maximum.reduceat(f["a"], first)


def train(df: DataFrame, text: str = "text", label: str = "quality", shares: tuple[float, float] | None = None) -> Quality:
    """Learn from rows with a label of 0 or 1 (a bounded sample, such as ``labelled_sample`` draws); null texts count as empty.

    ``shares`` are the frequencies of labels 0 and 1 that scores shall be right for, by default those of ``df``.  Repeated rows count as often as
    they occur.  With one label only, or none, all scores are the share of label 1, or else 0.5.
    """
    known = df.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(19), *df.columns).alias("place")).where("label in (0, 1)")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, first = passages(as_bytes(batch.column("text")))
            edge = np.append(first, len(x))
            bags = [x[a:b].astype(np.float16).tobytes() for a, b in zip(edge, edge[1:])]
            return pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), pa.array(bags, pa.binary())], ["label", "place", "bag"])

        return step

    rows = sorted((r["place"], r["label"], bytes(r["bag"])) for r in map_blocks(known, "text", make, "label int, place long, bag binary", _BLOCK).collect())
    y = np.array([r[1] for r in rows], float)
    each = np.array([(y == 0).sum(), (y == 1).sum()], float)
    if shares is None:
        shares = tuple(each / max(len(y), 1)) if len(y) else (0.5, 0.5)
    if not each.all():
        return Quality(None, offset=float(np.clip(np.log(max(shares[1], 1e-3) / max(shares[0], 1e-3)), -6, 6)))
    weight = (np.array(shares) * len(y) / each)[y.astype(int)]
    bags = [np.frombuffer(r[2], np.float16).reshape(-1, FEATURES) for r in rows]
    apart = np.zeros(len(y), bool)
    for k in (0, 1):  # some of each label, in the order of their hashes
        own = np.flatnonzero(y == k)
        apart[own[: int(len(own) * CALIBRATION)]] = True
    use = np.flatnonzero(~apart)
    m = fit([bags[i] for i in use], y[use], weight[use])
    if not apart.any():
        return Quality(m)
    own = np.flatnonzero(apart)
    x = np.concatenate([bags[i] for i in own]).astype(np.float32)
    first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])[:-1]])
    return Quality(m, *calibrated(forward(m, x, first)["s"].astype(float), y[own], weight[own]))


def score(df: DataFrame, model: Quality, text: str = "text") -> DataFrame:
    """Add score (0 to 1), n_passages and top_attention (the largest weight of one passage) to every row.

    The whole text counts; null and empty texts have one passage without words.  Columns of these names are replaced; an empty table gives no rows.
    """
    added = [T.StructField("score", T.DoubleType()), T.StructField("n_passages", T.LongType()), T.StructField("top_attention", T.DoubleType())]
    df = df.drop(*[f.name for f in added])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            value, number, most = sent.value.scores(as_bytes(batch.column(text)))
            made = [pa.array(value.astype(float)), pa.array(number, pa.int64()), pa.array(most.astype(float))]
            return pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *(f.name for f in added)])

        return step

    return map_blocks(df, text, make, T.StructType([*df.schema.fields, *added]), _BLOCK)


def op11_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; learned from labels where crc32(doc_id) mod 4 is not 2."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("quality")).where((crc32_fold("doc_id", 4) != 2) & F.col("quality").isin(0, 1))
    counts = {r[0]: r[1] for r in labels.groupBy("quality").count().collect()}
    n = max(sum(counts.values()), 1)
    model = train(labelled_sample(docs, labels, toxic="quality", toxic_docs=FIT_DOCS, clean_docs=FIT_DOCS), shares=(counts.get(0, 0) / n, counts.get(1, 0) / n) if counts else None)
    out = score(docs, model)
    return out.select("doc_id", (crc32_fold("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
