"""A quality classifier: random-indexing word vectors pooled per document, and a small network with calibrated scores.

Words fall into ``BUCKETS`` buckets by hash, their shapes (letters of either case, digits, marks, length) into 256
more. A bucket has a fixed sparse index vector of ``WIDTH`` numbers, four of them +1 or -1. Its context vector is the sum of
the index vectors of the words up to ``REACH`` places away, over all documents; it is summed in the tasks and then in
Spark, and is bounded by the number of buckets whatever the corpus. A document's features are the mean of its
words' context vectors (rare words weigh more), the mean of its shapes' index vectors, and how far its index vectors
repeat: among neighbours and overall. A network of one hidden layer learns ``labels.quality`` from at most ``SAMPLE``
labelled rows, chosen by the hash of their id among those with crc32(id) mod 4 other than 2. A fifth of them sets
the temperature by which scores are divided. Labels, lang, source and ids are never features.

Null and empty texts have features of zero and get the score the network gives those. Without labels of both classes
every score is the share of class 1, or 0.5 without any. Every row is scored on its own; of several labels of one id
the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import mix, words_of

BUCKETS = 1 << 13
SHAPES = 256
WIDTH = 32
NONZERO = 4
REACH = 2
SAMPLE = 20_000
HIDDEN = 24
EPOCHS = 40
KEEP = 0.7          # score of class 1
FLOOD = 500_000     # words worked on at a time
RARE = 1e-3
FLOOR = 0.1         # added to each feature's deviation
PRIOR = 10.0         # weight of the prior that weights are small, in rows

_VECTOR = [f"v{k}" for k in range(WIDTH)]
VECTOR_SCHEMA = "bucket int, n double, " + ", ".join(f"{v} double" for v in _VECTOR)
N_FEATURES = 2 * WIDTH + 6


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors' numbers, by bucket; a bucket's places differ."""
    number = np.arange(BUCKETS + SHAPES, dtype=np.uint64)
    places = np.empty((len(number), NONZERO), np.int64)
    signs = np.empty((len(number), NONZERO))
    for k in range(NONZERO):
        h = mix(number * np.uint64(NONZERO) + np.uint64(k + 1))
        step = WIDTH // NONZERO
        places[:, k] = k * step + (h % np.uint64(step)).astype(np.int64)
        signs[:, k] = np.where(h >> np.uint64(63), 1.0, -1.0)
    return places, signs


PLACES, SIGNS = _index()
DENSE = np.zeros((BUCKETS + SHAPES, WIDTH))
np.put_along_axis(DENSE, PLACES, SIGNS, axis=1)

_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 16                               # marks
_KIND[[ord(c) for c in ".,;:!?'\""]] = 8         # marks of ordinary prose
_KIND[48:58] = 4
_KIND[65:91] = 2
_KIND[97:123] = 1
_KIND[128:] = 1                                  # letters beyond ASCII, mostly


def _bucket(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word and shape buckets of the words of a text."""
    raw = (text or "").encode()
    words, start, end = words_of(raw, lower=False)
    if not len(words):
        return words.astype(np.int64), words.astype(np.int64)
    kinds = np.bitwise_or.reduceat(_KIND[np.frombuffer(raw, np.uint8)], start).astype(np.int64)
    length = np.digitize(end - start, (3, 6, 11, 21, 41, 81, 161)).astype(np.int64)
    return (words % np.uint64(BUCKETS)).astype(np.int64), BUCKETS + (kinds & 31) + 32 * length


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's share of every bucket's context vector and count."""
    total = np.zeros(BUCKETS * WIDTH)
    count = np.zeros(BUCKETS)
    held, size = [], 0

    def add() -> None:
        nonlocal held, size
        gap = np.full(REACH, -1, np.int64)
        words = np.concatenate([x for h in held for x in (h, gap)])
        count[:] += np.bincount(words[words >= 0], minlength=BUCKETS)
        for reach in range(1, REACH + 1):
            a, b = words[:-reach], words[reach:]
            both = (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            for x, y in ((a, b), (b, a)):
                for k in range(NONZERO):
                    total[:] += np.bincount(x * WIDTH + PLACES[y, k], SIGNS[y, k], minlength=len(total))
        held, size = [], 0

    for batch in batches:
        for text in batch.column("text"):
            held.append(_bucket(text.as_py())[0])
            size += len(held[-1])
            if size >= FLOOD:
                add()
    if held:
        add()
    seen = np.flatnonzero(count)
    vectors = total.reshape(BUCKETS, WIDTH)[seen]
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(count[seen]), *(pa.array(vectors[:, k]) for k in range(WIDTH))],
        ["bucket", "n", *_VECTOR])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors of length one, weighted for pooling: BUCKETS x WIDTH, counted over all documents."""
    shares = docs.select("text").mapInArrow(_contexts, VECTOR_SCHEMA)
    rows = shares.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("n", *_VECTOR))).toPandas()  # <= BUCKETS rows
    out = np.zeros((BUCKETS, WIDTH))
    if len(rows):
        vectors = rows[_VECTOR].to_numpy(float)
        share = rows["n"].to_numpy(float) / rows["n"].sum()
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        out[rows["bucket"].to_numpy(int)] = vectors / np.maximum(norm, 1e-9) * (RARE / (RARE + share))[:, None]
    return out


def features(text: str | None, vectors: np.ndarray) -> np.ndarray:
    words, shapes = _bucket(text)
    out = np.zeros(N_FEATURES)
    n = len(words)
    if n:
        counts = np.bincount(words, minlength=BUCKETS)
        out[:WIDTH] = counts @ vectors / n
        out[WIDTH:2 * WIDTH] = np.bincount(shapes - BUCKETS, minlength=SHAPES) @ DENSE[BUCKETS:] / n
        pooled = counts @ DENSE[:BUCKETS] / n
        out[2 * WIDTH] = np.linalg.norm(pooled)
        for k in (1, 2, 3):
            out[2 * WIDTH + k] = np.mean(words[k:] == words[:-k]) if n > k else 0.0
        out[2 * WIDTH + 4] = np.count_nonzero(counts) / n
        out[2 * WIDTH + 5] = np.log1p(n)
    return out


def _featured(vectors: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), vectors.value) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label_id"), batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))],
                                             ["label_id", "quality", "features"])
    return run


class Network:
    """Two layers, trained with Adam, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.share = float(y.mean()) if len(y) else 0.5
        self.learnt = len(np.unique(y)) == 2
        if not self.learnt:
            return
        order = rng.permutation(len(x))
        aside = order[:len(x) // 5]
        fit = order[len(x) // 5:] if len(np.unique(y[order[len(x) // 5:]])) == 2 else order
        self.mean, self.dev = x[fit].mean(0), x[fit].std(0) + FLOOR
        self.parts = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                      rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        self._fit(self._scaled(x[fit]), y[fit], rng)
        if len(aside):
            z = self.logit(x[aside])
            choices = np.geomspace(0.25, 8, 60)
            loss = [np.mean(np.logaddexp(0, z / t) - y[aside] * z / t) for t in choices]
            self.temperature = float(choices[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.dev, -6, 6)

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        decay = PRIOR / len(x)
        first, second, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                xs, ys = x[order[a:a + 256]], y[order[a:a + 256]]
                w, b, v, c = self.parts
                h = np.tanh(xs @ w + b)
                error = (1 / (1 + np.exp(-(h @ v + c))) - ys) / len(ys)
                back = np.outer(error, v) * (1 - h * h)
                slopes = [xs.T @ back + decay * w, back.sum(0), h.T @ error + decay * v, error.sum(keepdims=True)]
                step += 1
                for p, g, m, s in zip(self.parts, slopes, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= 0.005 * m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts
        return np.tanh(self._scaled(x) @ w + b) @ v + c

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.learnt:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors: Broadcast) -> Network:
    usable = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("quality").cast("double").alias("quality")))
    sample = usable.orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE)  # at most SAMPLE rows, so broadcast
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
            .select("label_id", "quality", "text").mapInArrow(_featured(vectors), "label_id long, quality double, features array<double>"))
    # an id may have any number of rows; it counts once, so no more than SAMPLE rows come back
    got = rows.groupBy("label_id", "quality").agg(F.min("features").alias("features")).select("quality", "features").toPandas()
    got = got.iloc[np.lexsort(np.array([list(f) for f in got["features"]]).T)] if len(got) else got  # the same in any order
    x = np.array([list(f) for f in got["features"]]) if len(got) else np.zeros((0, N_FEATURES))
    return Network(x, got["quality"].to_numpy(float))


def fit(docs: DataFrame, labels: DataFrame) -> Broadcast:
    """(word vectors, network), ready for tasks."""
    context = docs.sparkSession.sparkContext
    vectors = word_vectors(docs)
    network = train(docs, labels, context.broadcast(vectors))
    return context.broadcast((vectors, network))


def score(docs: DataFrame, model: Broadcast, keep: float = KEEP) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    def run(batches):
        for batch in batches:
            vectors, network = model.value
            x = np.array([features(t.as_py(), vectors) for t in batch.column("text")]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(network.score(x), pa.float64())],
                ["doc_id", "held_out", "score"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return (rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= keep).cast("int")))


def clean(docs: DataFrame, model: Broadcast, keep: float = KEEP) -> DataFrame:
    """The rows of docs with a score of class 1."""
    def run(batches):
        for batch in batches:
            vectors, network = model.value
            x = np.array([features(t.as_py(), vectors) for t in batch.column("text")]).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(network.score(x) >= keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
