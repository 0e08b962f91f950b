"""Quality classifier: random-indexing word vectors and a small network.

A word's *kind* is its lower-cased letters, how they are cased and the marks
around them; kinds that are rare in the sample keep casing and marks only. Every
kind has a sparse ternary index vector made from its hash. A kind's vector is
the sum of the index vectors of the kinds within two words of it, damped by
their frequencies: random indexing. A document is pooled into the mean and the
spread of its words' vectors, how far they agree, how often a word follows
itself, and its length. A network of two layers, fitted in numpy, gives a logit;
a temperature, fitted on rows that the network didn't see, turns it into a
calibrated probability.

Everything is fitted on a sample of labelled rows of at most ``SAMPLE`` (those
with the least hash of their key); scoring covers every whole text. Nulls count
as empty texts, which have no words and are scored by that. Labels that are
null, and keys that occur with both labels, are not used. With one label only,
or without labelled rows, every score is the share of label 1 (0.5 without any).
"""
from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hotcache import HotCache, frugal, release

#: Labelled rows that are fitted on, at most.
SAMPLE = 5_000
DIMENSIONS = 64
NONZERO = 6
WINDOW = 2
MIN_COUNT = 5
HIDDEN = 32
EPOCHS = 60
#: At least; a small sample is gone through more often.
STEPS = 1500
CACHED_WORDS = 100_000


def kind(word: str) -> tuple[str, str]:
    """Letters, and casing with marks."""
    letters = "".join([c for c in word if c.isalpha()])
    marks = "".join([c for c in word if not c.isalnum()])
    case = "0" if not letters else "u" if letters.isupper() and len(letters) > 1 else \
        "t" if letters[0].isupper() else "l" if letters.islower() else "m"
    digits = "9" if any(c.isdigit() for c in word) else ""
    return letters.lower(), f"{case}{digits}/{marks[:8]}"


def index_vector(name: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of a kind's sparse ternary vector."""
    raw = np.frombuffer(hashlib.blake2b(name.encode(), digest_size=4 * NONZERO).digest(), "<u4")
    return (raw >> 1) % DIMENSIONS, (raw & 1).astype(np.float32) * 2 - 1


class Vectors:
    """Word vectors by random indexing over the sample's texts."""

    def __init__(self, texts: list[str]):
        counts: Counter = Counter()
        for text in texts:
            counts.update(text.split())
        full, shapes = Counter(), Counter()
        for w, n in counts.items():
            letters, shape = kind(w)
            full[f"{letters}|{shape}"] += n
            shapes["|" + shape] += n
        names = ["", *[k for k, n in shapes.items() if n >= MIN_COUNT],
                 *[k for k, n in full.items() if n >= MIN_COUNT and not k.startswith("|")]]
        self.row = {k: i for i, k in enumerate(dict.fromkeys(names))}
        size = len(self.row)
        rows = {w: self.row_of(w) for w in counts}
        seen = np.zeros(size + 1)
        for w, n in counts.items():
            seen[rows[w]] += n
        damped = 1 / np.sqrt(np.maximum(seen, 1))
        places, signs = (np.stack(x) for x in zip(*map(index_vector, self.row)))
        total = np.zeros(size * DIMENSIONS)
        # A gap as wide as the window keeps documents apart.
        gap = [size] * WINDOW
        for at in range(0, len(texts), 100):
            stream = np.fromiter((r for t in texts[at:at + 100]
                                  for r in (*[rows[w] for w in t.split()], *gap)), np.int64)
            for step in range(1, WINDOW + 1):
                a, b = stream[:-step], stream[step:]
                both = (a < size) & (b < size)
                a, b = a[both], b[both]
                for of, by in ((a, b), (b, a)):
                    for j in range(NONZERO):
                        total += np.bincount(of * DIMENSIONS + places[by, j],
                                             damped[by] * signs[by, j], size * DIMENSIONS)
        matrix = total.reshape(size, DIMENSIONS)
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        self.matrix = (matrix / np.where(norm > 0, norm, 1)).astype(np.float32)

    def row_of(self, word: str) -> int:
        letters, shape = kind(word)
        row = self.row
        return row.get(f"{letters}|{shape}", row.get("|" + shape, 0))


def pooled(words: list[str], row_of, matrix: np.ndarray) -> np.ndarray:
    """Features of a document from its words, whose vectors ``row_of`` finds."""
    rows = np.fromiter(map(row_of, words), np.int64, len(words))
    out = np.zeros(2 * DIMENSIONS + 3, np.float32)
    n = len(rows)
    if n:
        vectors = matrix[rows]
        mean = vectors.mean(axis=0)
        out[:DIMENSIONS] = mean
        out[DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(
            np.einsum("ij,ij->j", vectors, vectors) / n - mean * mean, 0))
        out[-3] = np.linalg.norm(mean)
        out[-2] = sum(map(eq, words, words[1:])) / n
    out[-1] = np.log1p(n)
    return out


class Network:
    """One hidden layer and a logistic output, fitted by Adam; then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        held, used = order[:len(x) // 6], order[len(x) // 6:]
        if len(set(y[used])) < 2:  # of few rows both labels are needed to learn from
            held, used = order[:0], order
        self.shift, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 0.02
        z = self.standard(x)
        sizes = (x.shape[1], HIDDEN)
        self.p = [rng.normal(0, sizes[0] ** -0.5, sizes), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m, v, step = [0 * p for p in self.p], [0 * p for p in self.p], 0
        batches = max(1, len(used) // 128)
        for _ in range(max(EPOCHS, STEPS // batches)):
            for part in np.array_split(rng.permutation(used), batches):
                a, t = z[part], y[part]
                h = np.tanh(a @ self.p[0] + self.p[1])
                d = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - t) / len(part)
                back = np.outer(d, self.p[2]) * (1 - h * h)
                grads = [a.T @ back + 1e-3 * self.p[0], back.sum(axis=0),
                         h.T @ d + 1e-3 * self.p[2], d.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - 2e-3 * (m[i] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.temperature = 1.0
        if len(held):
            logits, t = self.logit(x[held]), y[held]
            choices = np.geomspace(0.25, 8, 61)
            loss = [np.logaddexp(0, np.where(t > 0, -logits, logits) / c).mean() for c in choices]
            self.temperature = float(choices[int(np.argmin(loss))])

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Features on one scale; what lies far outside the sample is brought near."""
        return np.clip((x - self.shift) / self.scale, -6, 6)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standard(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


class Model:
    """Vectors and network; picklable, and small: it goes to every executor."""

    def __init__(self, texts: list[str], labels: list[int]):
        y = np.array(labels, float)
        self.constant = float(y.mean()) if len(y) else 0.5
        self.network = None
        if len(set(labels)) == 2:
            self.vectors = Vectors(texts)
            matrix, row_of = self.vectors.matrix, self.vectors.row_of
            x = np.stack([pooled(t.split(), row_of, matrix) for t in texts])
            self.network = Network(x, y)

    def scorer(self):
        """A function from texts to probabilities, with a cache of words."""
        if self.network is None:
            return lambda texts: np.full(len(texts), self.constant)
        matrix, get = self.vectors.matrix, HotCache(
            self.vectors.row_of, CACHED_WORDS).__getitem__

        def score(texts: list[str | None]) -> np.ndarray:
            features = [pooled((t or "").split(), get, matrix) for t in texts]
            return self.network.probability(np.stack(features)) if features else np.zeros(0)

        return score


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
        bound: int = SAMPLE) -> Model:
    """Fit on at most ``bound`` labelled rows of ``docs``, chosen by a hash of their keys.

    ``labels`` should hold the rows that may be learned from only. The sample is
    what reaches the driver; its ids are found before any text is read.
    """
    ids = (labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_y"))
           .dropna().groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z"))
           .filter("_y = _z").orderBy(F.xxhash64("_id"), "_id").limit(bound))
    rows = (docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
            .join(F.broadcast(ids), F.col("_key") == F.col("_id"))  # at most ``bound`` ids
            .groupBy("_id", "_y").agg(F.min("_t").alias("_t"))
            .orderBy(F.xxhash64("_id"), "_id").collect())
    return Model([r["_t"] for r in rows], [r["_y"] for r in rows])


def scored(docs: DataFrame, text: str, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the probability ``into`` of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(into)
    names = docs.columns

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        score = shared.value.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score(part[text].to_pylist()), pa.float64())],
                    [*names, into])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, {into} double")
