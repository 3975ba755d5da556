"""Operator 10: document quality by random-indexing word vectors and a small network.

1. Tokens (words, runs of punctuation; case kept) hash into ``BUCKETS``.  Each
   bucket has a fixed sparse index vector of +1 and -1; a word's vector is
   the sum of the index vectors of its neighbours (``WINDOW`` tokens to each
   side) over *all* texts.  The table of sums has a fixed size.
2. A document is the mean and the deviation of its tokens' vectors.
3. A two-layer network is fitted with numpy on a bounded sample of labelled rows,
   pooled where they lie, so that no text reaches the driver;
   a temperature fitted on a fifth of them, which the network does not see,
   calibrates its probabilities.

Inputs of a score are the text alone.  Edge cases: null is the empty text; a
text without tokens has zero vectors; without labelled rows of both classes
every score is 0.5; repeated rows and null doc_ids are kept; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import (ByteHash, TOKENS, U64, accumulate, full_text, mix, owners,
                                  prepare, slices, tokens)
from civicflow.llm.decontaminate import filtered
from civicflow.llm.toxicity import labelled_rows

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 32
NONZERO = 2
WINDOW = 2
#: Most labelled rows that the network is fitted on (least hash of doc_id first).
SAMPLE_ROWS = 4000
HIDDEN = 24
EPOCHS, RATE, PENALTY = 400, 0.01, 1e-3
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SCHEMA = "doc_id long, score double"


def token_buckets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token of all texts and the n + 1 offsets."""
    raw, start, end, offsets = tokens(text, TOKENS)
    return (ByteHash(raw).range(start, end) >> U64(64 - BUCKET_BITS)).astype(np.int32), offsets


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    h = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + U64(0x5EED))
    place = (h % U64(DIMENSIONS)).astype(np.int32).reshape(BUCKETS, NONZERO)
    sign = np.where(h >> U64(40) & U64(1), 1, -1).astype(np.int8).reshape(BUCKETS, NONZERO)
    return place, sign


def count_contexts(batch: pa.RecordBatch, total: np.ndarray) -> None:
    """Adds the index vectors of each token's neighbours to its bucket's sum."""
    bucket, offsets = token_buckets(full_text(batch))
    if not len(bucket):
        return
    place, sign = index_vectors() if "index" not in _CACHE else _CACHE["index"]
    _CACHE["index"] = place, sign
    own = owners(offsets)
    up, down = [], []
    for d in range(1, WINDOW + 1):
        same = np.flatnonzero(own[d:] == own[:-d])
        for a, b in ((same, same + d), (same + d, same)):
            where = bucket[a].astype(np.int64) * DIMENSIONS
            for k in range(NONZERO):
                cell = where + place[bucket[b], k]
                plus = sign[bucket[b], k] > 0
                up.append(cell[plus])
                down.append(cell[~plus])
    total += np.bincount(np.concatenate(up), minlength=len(total))
    total -= np.bincount(np.concatenate(down), minlength=len(total))


_CACHE: dict = {}


def word_vectors(total: np.ndarray) -> np.ndarray:
    """Unit vectors of the buckets, without the direction they all share."""
    v = total.reshape(BUCKETS, DIMENSIONS).astype(np.float64)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    v = v / np.maximum(norm, 1)
    seen = norm[:, 0] > 0
    if seen.any():
        v[seen] -= v[seen].mean(0)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of each text's token vectors, and log of its number of tokens."""
    bucket, offsets = token_buckets(text)
    n = np.diff(offsets)
    out = np.zeros((len(n), 2 * DIMENSIONS + 1))
    full = n > 0
    if full.any():
        at = offsets[:-1][full]
        v = vectors[bucket]
        mean = np.add.reduceat(v, at, axis=0, dtype=np.float64) / n[full, None]
        np.multiply(v, v, out=v)
        square = np.add.reduceat(v, at, axis=0, dtype=np.float64) / n[full, None]
        out[full, :DIMENSIONS] = mean
        out[full, DIMENSIONS:-1] = np.sqrt(np.maximum(square - mean ** 2, 0))
        out[full, -1] = np.log1p(n[full])
    return out


@dataclass
class Network:
    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray] | None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, text: pa.Array) -> np.ndarray:
        if self.layers is None:
            return np.full(len(text), 0.5)
        z = self.logits(pooled(text, self.vectors)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    rng = np.random.default_rng(1)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    for step in range(1, EPOCHS + 1):
        h = np.tanh(x @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40)))
        d = (p - y) / len(y)
        dh = np.outer(d, params[2]) * (1 - h ** 2)
        grads = [x.T @ dh + PENALTY * params[0], dh.sum(0), h.T @ d + PENALTY * params[2],
                 np.array([d.sum()])]
        for i, g in enumerate(grads):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g ** 2
            params[i] = params[i] - RATE * (mean[i] / (1 - 0.9 ** step)) / (
                np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return params


def _temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows the network has not seen."""
    if not len(y) or y.min() == y.max():
        return 1.0
    def loss(t):
        z = np.clip(logit / t, -40, 40)
        return np.mean(np.logaddexp(0, z) - y * z)
    return float(min(np.geomspace(0.25, 8, 60), key=loss))


def fit(x: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> Network:
    """The network of pooled texts ``x`` and their labels ``y``."""
    if not len(y) or y.min() == y.max():
        return Network(vectors, np.zeros(1), np.ones(1), None)
    held = np.arange(len(y)) % 5 == 4
    if y[~held].min() == y[~held].max():
        held[:] = False
    net = Network(vectors, x[~held].mean(0), x[~held].std(0) + 1e-6, None)
    net.layers = _train((x[~held] - net.center) / net.scale, y[~held])
    net.temperature = _temperature(net.logits(x[held]), y[held])
    return net


def pooled_sample(rows: DataFrame, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most ``most`` of ``rows`` (doc_id, text, label), least hash first.

    Texts are pooled in the tasks; 2 * DIMENSIONS + 1 numbers a row reach the driver."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                x = pooled(full_text(part), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))],
                    ["doc_id", "label", "x"])
    found = rows.mapInArrow(run, "doc_id long, label int, x array<double>").orderBy(
        F.xxhash64("doc_id"), "doc_id", "x").limit(most).select("label", "x").toArrow()
    shared.destroy()
    x = found["x"].combine_chunks()
    x = x.flatten() if isinstance(x, pa.Array) else pa.concat_arrays([c.flatten() for c in x.chunks])
    return (x.to_numpy(zero_copy_only=False).reshape(found.num_rows, 2 * DIMENSIONS + 1),
            found["label"].to_numpy().astype(float))


def classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """A broadcast network: vectors from all of ``docs``, layers from the labelled sample."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text"))
    vectors = word_vectors(accumulate(rows, count_contexts, BUCKETS * DIMENSIONS))
    sample = labelled_rows(docs, labels, "quality", FOLDS, HELD_OUT, sample_rows)
    return spark.sparkContext.broadcast(fit(*pooled_sample(sample, vectors, sample_rows), vectors))


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and score (probability of label 1) of every row of ``docs``."""
    shared = classifier(docs, labels, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shared.value.scores(full_text(part)))],
                    ["doc_id", "score"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def accepted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows that score below THRESHOLD; all columns kept."""
    shared = classifier(docs, labels, sample_rows)
    return filtered(docs, lambda batch: shared.value.scores(full_text(batch)) >= THRESHOLD)
