"""Quality classifier on random-indexing word vectors (operator 9).

Random indexing: every word has a sparse ternary index vector made from its
hash; a word's context vector is the sum of the index vectors of the words
around it, learned from a bounded sample of labelled training documents. A
document is the mean of its words' context vectors and of the index vectors of
their shapes (case, digits, marks, repetition of the word before), which also
cover words never seen. A network of two layers, in numpy, is trained on these
by Adam; a temperature fitted on rows kept out of training calibrates it.

The sample is bounded by SAMPLE rows (the smallest by a hash of doc_id), a
parameter; its vocabulary is every word that it holds LEAST times. Rows whose
crc32(doc_id as text) mod 4 is 2 are held out and never learned from. Labels,
lang, source and doc_id are no inputs. Scoring reads each whole text once.

Cases: null text scores as the empty text, whose vector is zero; without any
training row, or with one class only, all scores are the (smoothed) share of
label 1; a null label is no training row; equal rows score equally; a document
labelled twice is learned twice; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SAMPLE, LEAST, DIM, NONZERO, WINDOW = 4000, 3, 64, 6, 2
SHAPES, HIDDEN, EPOCHS, SEED = 64, 32, 60, 11
_SHAPE = [(re.compile(p), r) for p, r in (("[a-zß-öø-ÿ]+", "a"), ("[A-ZÀ-ÖØ-Þ]+", "A"), ("[0-9]+", "9"), (r"(.)\1+", r"\1"))]


def index_vector(word: str, dim: int = DIM) -> np.ndarray:
    """Sparse ternary: NONZERO places, half of them negative."""
    r = np.random.default_rng(zlib.crc32(word.encode("utf-8", "surrogatepass")))
    v = np.zeros(dim, np.float32)
    v[r.choice(dim, NONZERO, replace=False)] = np.repeat([1, -1], NONZERO // 2)
    return v


def shape(word: str) -> str:
    for p, r in _SHAPE:
        word = p.sub(r, word)
    return word[:8]


def learn_words(texts: list[str], dim: int = DIM, least: int = LEAST) -> tuple[list[str], np.ndarray]:
    """The words that occur `least` times or more, and their context vectors of unit length."""
    docs = [[w.lower() for w in t.split()] for t in texts]
    counts = Counter(w for d in docs for w in d)
    words = sorted(w for w, n in counts.items() if n >= least)
    place = {w: i for i, w in enumerate(words)}
    index = np.stack([index_vector(w, dim) for w in words]) if words else np.zeros((0, dim), np.float32)
    index = np.vstack([index, np.zeros((1, dim), np.float32)])
    context = index * 0.5
    for d in docs:
        at = np.array([place.get(w, len(words)) for w in d], np.int64)
        for k in range(1, WINDOW + 1):
            if len(at) > k:
                np.add.at(context, at[k:], index[at[:-k]])
                np.add.at(context, at[:-k], index[at[k:]])
    context = context[: len(words)]
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    return words, (context / np.maximum(norm, 1e-6)).astype(np.float32)


class Pooler:
    """The vector of a document: means over its words of context and shape vectors."""

    def __init__(self, words: list[str], context: np.ndarray):
        self.place = {w: i for i, w in enumerate(words)}
        self.context = np.vstack([context, np.zeros((1, context.shape[1]), np.float32)])
        self.shapes = np.stack([index_vector(f"shape {i}") for i in range(SHAPES)])
        self.memo: dict[str, int] = {}

    def code(self, word: str) -> int:
        """Vocabulary place and shape of a word in one number, and 30 bits of its hash to tell repeats."""
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        c = (self.place.get(word.lower(), len(self.place)) << 38) | (zlib.crc32(shape(word).encode()) % (SHAPES - 2) << 30) | h >> 2
        if len(self.memo) > 200_000:
            self.memo.clear()
        self.memo[word] = c
        return c

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        n = len(words)
        if not n:
            return np.zeros(self.context.shape[1] + DIM + 1, np.float32)
        got = list(map(self.memo.get, words))
        if None in got:
            got = [self.code(w) if c is None else c for w, c in zip(words, got, strict=True)]
        x = np.array(got, np.int64)
        shapes = np.bincount((x >> 30) & 255, minlength=SHAPES).astype(np.float32)
        shapes[SHAPES - 1] = np.count_nonzero(x[1:] == x[:-1])
        shapes[SHAPES - 2] = sum(np.count_nonzero(x[k:] == x[:-k]) for k in (2, 3, 4, 5) if n > k)
        seen = np.bincount(x >> 38, minlength=len(self.context)) if n > 2000 else None
        mean = (seen @ self.context if seen is not None else self.context[x >> 38].sum(0)) / n
        return np.concatenate([mean, shapes[:SHAPES] @ self.shapes / n, [np.float32(min(1.0, np.log1p(n) / 10))]]).astype(np.float32)


class Network:
    """Two layers (tanh, then logistic), trained by Adam, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        self.prior = float((y.sum() + 1) / (len(y) + 2))
        self.fitted = len(y) >= 20 and 0 < y.sum() < len(y)
        self.temperature = 1.0
        if not self.fitted:
            return
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        order = r.permutation(len(y))
        hold, train = order[: len(y) // 5], order[len(y) // 5 :]
        d = x.shape[1]
        p = [r.standard_normal((d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), r.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            for batch in np.array_split(r.permutation(train), max(1, len(train) // 64)):
                a, b = x[batch], y[batch]
                h = np.tanh(a @ p[0] + p[1])
                g = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - b) / len(b)
                gh = np.outer(g, p[2]) * (1 - h * h)
                grads = [a.T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g, np.array([g.sum()])]
                t += 1
                for i, q in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * q
                    v[i] = 0.999 * v[i] + 0.001 * q * q
                    p[i] = p[i] - 3e-3 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.p = p
        if len(hold):
            z, b = self.logits(x[hold]), y[hold]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
            loss = [np.mean(np.logaddexp(0, z / k) - b * z / k) for k in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        z = self.logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> tuple[list[str], np.ndarray, Network]:
    rows = labels.where(~held_out(F.col("doc_id")) & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("y"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    texts = docs.select("doc_id", "text").join(rows, "doc_id").select("doc_id", "text", "y")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((d, t or "") for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        names, context = learn_words([t for _, t in got])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([c.tobytes() for c in context], pa.binary())], ["word", "vec"])

    texts = materialize(texts, "sample")  # SAMPLE rows; texts are searched for them once
    found = texts.select("doc_id", "text").repartition(1).mapInArrow(words, "word string, vec binary").collect()  # the sample alone moves to one task; it is bounded, and so are its words
    names = [r.word for r in found]
    context = np.array([np.frombuffer(r.vec, np.float32) for r in found], np.float32).reshape(-1, DIM)

    def pool(batches):
        pooler = Pooler(names, context)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([pooler(t or "").tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["doc_id", "y", "x"])

    data = sorted((r.doc_id, r.y, bytes(r.x)) for r in texts.mapInArrow(pool, "doc_id long, y double, x binary").collect())  # sample rows at most
    x = np.array([np.frombuffer(r[2], np.float32) for r in data], np.float64).reshape(len(data), 2 * DIM + 1)
    return names, context, Network(x, np.array([r[1] for r in data], np.float64))


def score(docs: DataFrame, model: tuple[list[str], np.ndarray, Network], cutoff: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    names, context, network = model

    def run(batches):
        pooler = Pooler(names, context)
        for b in batches:
            x = np.array([pooler(t or "") for t in b.column(1).to_pylist()], np.float64).reshape(b.num_rows, 2 * context.shape[1] + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(network(x), pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))
