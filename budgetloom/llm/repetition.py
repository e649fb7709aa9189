"""How much of a text repeats itself (problem 6).

A logistic regression over hashed word and character n-grams picks the texts
that may repeat themselves: its inputs are hashed n-gram frequencies, and for
words, word pairs, word triples and character n-grams the share that occurred
before.  It is trained on a bounded sample of labelled rows, calibrated by
Platt's method on rows held out, and scored in Arrow batches against a fixed
threshold.  The label of a sample row, and what is reported of a text that
passes, is the exact measure; its runs of six words are no input of the model.

The exact measure: the share of a text's words that lie in a run of six words
of which the same run begins earlier, possibly overlapping; the first place
does not count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.shingles import mix, runs, word_hashes

RUN, SHARE = 6, 0.3
WORD_ORDERS, HASHED_WORDS, CHARS = (1, 2, 3), 1, 5
BUCKETS = 256
#: Inputs of the model: length, shares of words and of characters, buckets of words and of characters.
DENSE = 2 + len(WORD_ORDERS)
INPUTS = DENSE + 2 * BUCKETS
#: Calibrated probability from which a text is measured: low, as a text below it is not found.
THRESHOLD = 0.002
#: Rows of the labelled sample at most, half of them held out.
SAMPLE_ROWS = 4_000


def _later(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether the same hash occurred earlier in the same text."""
    key = mix(hashes + mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.append(False, key[order][1:] == key[order][:-1]) if len(key) else np.zeros(0, bool)
    out = np.zeros(len(key), bool)
    out[order] = same
    return out


def repeated_share(hashes: np.ndarray, counts: np.ndarray, run: int = RUN) -> np.ndarray:
    """The exact measure of each text, 0 for texts without a word."""
    owner = np.repeat(np.arange(len(counts)), counts)
    gram, inside = runs(hashes, counts, run)
    at = np.flatnonzero(inside)
    at = at[_later(gram[at], owner[at])]
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + run, -1)
    covered = np.cumsum(step)[:-1] > 0
    return np.bincount(owner[covered], minlength=len(counts)) / np.maximum(1, counts)


def _rate(flag: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    total = np.bincount(owner, minlength=n)
    return np.bincount(owner[flag], minlength=n) / np.maximum(1, total)


def _char_grams(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the character n-grams that lie within a text, where these begin)."""
    last = max(0, len(data) - CHARS + 1)
    acc = np.zeros(last, np.uint32)
    for k in range(CHARS):
        acc = acc * np.uint32(0x01000193) + data[k : k + last]
    acc = acc * np.uint32(0x9E3779B1) >> np.uint32(24)
    inside = np.ones(last, bool)
    for k in range(1, CHARS):  # n-grams that run over the end of a text
        over = np.cumsum(sizes) - k
        inside[over[(over >= 0) & (over < last)]] = False
    return acc[inside].astype(np.int64) % BUCKETS, inside


def inputs(texts: list[str | None], hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(dense inputs of each text, [(bucket, text) of hashed n-grams] for words and for characters)."""
    n = len(texts)
    owner = np.repeat(np.arange(n), counts)
    dense, hashed = [np.log1p(counts)], []
    for k in WORD_ORDERS:
        gram, inside = runs(hashes, counts, k)
        g, o = gram[inside], owner[inside]
        dense.append(_rate(_later(g, o), o, n))
        if k == HASHED_WORDS:
            hashed.append(((g >> np.uint64(40)).astype(np.int64) % BUCKETS, o))
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, n)
    bucket, inside = _char_grams(np.frombuffer(b"".join(raw), np.uint8), sizes)
    hashed.append((bucket, np.repeat(np.arange(n), sizes)[: len(inside)][inside]))
    words, distinct = np.zeros(n), np.zeros(n)
    w, o = hashed[0]
    np.add.at(distinct, np.unique(o * BUCKETS + w) // BUCKETS, 1)
    words += counts
    dense.append(distinct / np.maximum(1, np.minimum(words, BUCKETS)))
    return np.stack(dense, 1), hashed


class Model:
    """Weights of the regression, its calibration and its threshold."""

    def __init__(self, dense: np.ndarray, buckets: np.ndarray, scale: tuple, platt: tuple[float, float], threshold: float, held_out: dict):
        self.dense, self.buckets, self.scale, self.platt, self.threshold, self.held_out = dense, buckets, scale, platt, threshold, held_out

    def logit(self, dense: np.ndarray, hashed: list) -> np.ndarray:
        z = (dense - self.scale[0]) / self.scale[1] @ self.dense[:-1] + self.dense[-1]
        for w, (bucket, owner) in zip(self.buckets, hashed):
            n = np.bincount(owner, minlength=len(dense))
            z += np.bincount(owner, w[bucket], len(dense)) / np.maximum(1, n)
        return z

    def probability(self, dense: np.ndarray, hashed: list) -> np.ndarray:
        return self.calibrated(self.logit(dense, hashed))

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.platt[0] * z + self.platt[1], -30, 30)))


def _frequencies(hashed: list, n: int) -> np.ndarray:
    parts = []
    for bucket, owner in hashed:
        m = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
        parts.append(m / np.maximum(1, m.sum(1, keepdims=True)))
    return np.concatenate(parts, 1)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(inputs of each text in a fixed number of columns, its exact measure)."""
    hashes, counts = word_hashes(texts)
    dense, hashed = inputs(texts, hashes, counts)
    return np.column_stack([dense, _frequencies(hashed, len(texts))]).astype(np.float32), repeated_share(hashes, counts)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the constant's and has no penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(x: np.ndarray, measure: np.ndarray, share: float = SHARE) -> Model:
    """Fit on one half of the sample, calibrate on the other; the threshold is fixed.

    A sample without a positive or a negative row in either half teaches
    nothing: the model then passes every text on.
    """
    label = (measure >= share).astype(float)
    fit = np.arange(len(x)) % 2 == 0
    x = x.astype(float).reshape(-1, INPUTS)
    mean, spread = (x[:, :DENSE].mean(0), x[:, :DENSE].std(0) + 1e-9) if len(x) else (np.zeros(DENSE), np.ones(DENSE))
    if not (0 < label[fit].sum() < fit.sum() and 0 < label[~fit].sum() < (~fit).sum()):
        return Model(np.zeros(DENSE + 1), np.zeros((2, BUCKETS)), (mean, spread), (1.0, 0.0), 0.0, {})
    x[:, :DENSE] = (x[:, :DENSE] - mean) / spread
    w = _fit(x[fit], label[fit], 0.01, 12)
    z = x[~fit] @ w[:-1] + w[-1]
    size = np.abs(z).max() + 1e-9
    a, b = _fit((z / size)[:, None], label[~fit], 1e-3, 20)
    model = Model(np.append(w[:DENSE], w[-1]), w[DENSE:-1].reshape(2, BUCKETS), (mean, spread), (max(a, 1e-9) / size, b), THRESHOLD, {})
    p, positive = model.calibrated(z), label[~fit] > 0
    model.held_out = {"rows": int(len(p)), "positive": int(positive.sum()), "recall": float((p[positive] >= model.threshold).mean()), "passed": float((p >= model.threshold).mean())}
    return model


def sample(df: DataFrame, key: str, text: str, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, exact measures) of at most ``rows`` rows, those of the least hashed keys: a bounded sample for training only.

    The inputs are made where the rows are; the driver gets ``INPUTS`` numbers of
    each row, 8 MB in all, however long the texts.
    """
    few = df.select(F.col(text).alias("text"), F.xxhash64(F.lit("repetition"), F.col(key)).alias("h")).orderBy("h").limit(rows).select("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = features(batch.column(0).to_pylist())
        flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * INPUTS), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([flat, pa.array(y)], ["x", "y"])

    got = over_batches(few, run, "x binary, y double", 500).toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, INPUTS)
    return x, got["y"].to_numpy()


def repeating(df: DataFrame, key: str, text: str, share: float = SHARE, model: Model | None = None) -> DataFrame:
    """(key, share): texts of which ``share`` or more repeats itself.

    Repeated rows of a key count once.  Null and empty texts and texts under
    six words have a share of 0; null keys are kept; an empty table gives an
    empty one; other columns do not matter; texts are measured whole.
    """
    model = model or train(*sample(df, key, text), share)
    sent = df.sparkSession.sparkContext.broadcast(model)  # some hundred numbers, whatever the corpus

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        hashes, counts = word_hashes(texts)
        m = sent.value
        likely = np.flatnonzero(m.probability(*inputs(texts, hashes, counts)) >= m.threshold)
        ends = np.cumsum(counts)
        index = np.concatenate([np.arange(ends[i] - counts[i], ends[i]) for i in likely]) if len(likely) else np.zeros(0, np.int64)
        exact = repeated_share(hashes[index], counts[likely])
        good = exact >= share
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(likely[good])), pa.array(exact[good])], [key, "share"])

    kind = df.schema[key].dataType.simpleString()
    return over_batches(df.select(key, text), run, f"`{key}` {kind}, share double", 1_000).groupBy(key).agg(F.max("share").alias("share"))


def shares(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_words, share) of every row, exactly; repeated rows of a key count once."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, counts = word_hashes(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), pa.array(repeated_share(hashes, counts))], [key, "n_words", "share"])

    kind = df.schema[key].dataType.simpleString()
    return over_batches(df.select(key, text), run, f"`{key}` {kind}, n_words long, share double").groupBy(key).agg(F.max("n_words").alias("n_words"), F.max("share").alias("share"))
