"""Operator 9: toxic spans by a linear-chain conditional random field.

Labels mark documents; tokens of a bounded sample of labelled rows are
labelled from them: a token of a toxic document is toxic if one of its
features (word, beginning, ending) occurs in significantly many toxic and in
hardly any other documents of the sample.  The two-state chain is trained on
these tokens by gradient ascent of the conditional log-likelihood; gradients
and scores come from forward-backward marginals.  A document's score is a
logistic function of its largest marginal, fitted on the same sample; its
offending offsets are the tokens whose marginal is at least one half.

The chain is evaluated in chunks of ``CHUNK`` tokens, all in lockstep: first
each chunk's 2 x 2 transfer matrix, then the messages between the chunks of
a document, then the messages inside.  That is exact for whole texts of any
length.  Scoring is one pass without a shuffle.

Inputs of a score are the text alone.  Edge cases: null is the empty text; a
text without words has the score of marginal 0; without labelled rows of both
classes every score is 0; repeated rows and null doc_ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import (ByteHash, U64, full_text, owners, prepare, slices, text_slices,
                                  tokens)

#: Most labelled rows that the model is fitted on (least hash of doc_id first).
SAMPLE_ROWS = 4000
FEATURE_BITS = 18
BEGINNINGS, ENDINGS = (3, 4, 5, 6, 7), (3, 4)
CHUNK = 64
#: Documents whose arrays the driver holds at a time while it fits the chain.
GROUP = 512
ITERATIONS = 80
RATE, PENALTY = 0.2, 1e-6
#: A feature marks toxic tokens from this share of toxic documents and this much evidence (nats).
PURITY, EVIDENCE = 0.9, 14.0
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
SCHEMA = ("doc_id long, score double, n_toxic int, "
          "spans array<struct<start:int,end:int,marginal:double>>")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                  rows: int) -> DataFrame:
    """doc_id, text, label of the rows of at most ``rows`` labelled documents, none of them held out.

    The ids with least hash are chosen from the labels; that bounded list is
    broadcast to fetch the texts.  A repeated doc_id brings all its rows."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                     & ~held_out(F.col("doc_id"), folds, fold))
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return text.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                    rows: int) -> list[tuple[int, str, int]]:
    """At most ``rows`` of the ``labelled_rows`` (doc_id, text, label), least hash of doc_id first."""
    found = labelled_rows(docs, labels, label, folds, fold, rows)
    return [tuple(r) for r in found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()]


def token_features(text: pa.Array):
    """Feature numbers (tokens x features), byte starts and ends, token offsets, and the bytes."""
    lower = pc.utf8_lower(text)
    same = pc.equal(pc.utf8_length(lower), pc.utf8_length(text))
    if not pc.all(same).as_py() and len(text):
        lower = pc.if_else(same, lower, text)
    raw, start, end, offsets = tokens(lower)
    hashes = ByteHash(raw)
    cols = [hashes.range(start, end)]
    cols += [hashes.range(start, np.minimum(start + n, end)) for n in BEGINNINGS]
    cols += [hashes.range(np.maximum(end - n, start), end) for n in ENDINGS]
    f = np.stack([(c * U64(2 * k + 3) + U64(k)) >> U64(64 - FEATURE_BITS)
                  for k, c in enumerate(cols)], 1).astype(np.int32)
    return f, start, end, offsets, raw


@dataclass
class Chain:
    """Scores of the toxic state against the clean one: weights, transitions (log), start."""
    weights: np.ndarray
    transitions: np.ndarray
    start: float
    slope: float = 1.0
    shift: float = 0.0

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(features))
        for k in range(features.shape[1]):
            out += self.weights[features[:, k]]
        return out

    def score(self, top: np.ndarray) -> np.ndarray:
        """Document score of the largest marginal."""
        return 1 / (1 + np.exp(-(self.slope * _logit(top) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    """Log odds within +-6, where a marginal says no more."""
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.clip(np.log(p / (1 - p)), -6, 6)


class Messages:
    """Forward and backward odds (toxic : clean) of all tokens of a batch of texts."""

    def __init__(self, emission: np.ndarray, offsets: np.ndarray, chain: Chain):
        size = np.diff(offsets)
        chunks = -(-size // CHUNK)
        base = np.concatenate([[0], np.cumsum(chunks)])
        n = int(base[-1])
        # Token k of a text sits at (chunk, k mod CHUNK).
        inside = np.arange(len(emission)) - np.repeat(offsets[:-1], size)
        at = (np.repeat(base[:-1], size) + inside // CHUNK) * CHUNK + inside % CHUNK
        power = np.ones(n * CHUNK)
        power[at] = np.exp(np.clip(emission, -30, 30))
        real = np.zeros(n * CHUNK, bool)
        real[at] = True
        power, real = power.reshape(n, CHUNK).T.copy(), real.reshape(n, CHUNK).T.copy()
        t = np.exp(chain.transitions)
        # A text's first token has the start score instead of a transition.
        head = np.zeros(n, bool)
        head[base[:-1][size > 0]] = True
        first = np.exp(chain.start)
        # 1. Transfer matrix of each chunk (row vector times matrix).
        m = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
        for k in range(CHUNK):
            e, ok = power[k], real[k]
            new = [m[0] * t[0, 0] + m[1] * t[1, 0], (m[0] * t[0, 1] + m[1] * t[1, 1]) * e,
                   m[2] * t[0, 0] + m[3] * t[1, 0], (m[2] * t[0, 1] + m[3] * t[1, 1]) * e]
            if k == 0:
                # Both rows of a first chunk: (1, start * e), whatever comes in.
                for i, v in enumerate((np.ones(n), first * e) * 2):
                    new[i] = np.where(head, v, new[i])
            top = np.maximum.reduce(new)
            m = [np.where(ok, x / top, y) for x, y in zip(new, m)]
        # 2. Odds that enter each chunk from before and from after.
        enter, leave = np.ones(n), np.ones(n)
        order = np.argsort(-chunks, kind="stable")
        counts = chunks[order]
        for j in range(1, int(chunks.max(initial=0))):
            rows = base[:-1][order[:np.searchsorted(-counts, -j, side="left")]] + j - 1
            a = enter[rows]
            enter[rows + 1] = (m[1][rows] + a * m[3][rows]) / (m[0][rows] + a * m[2][rows])
        for j in range(int(chunks.max(initial=0)) - 1, 0, -1):
            rows = base[:-1][order[:np.searchsorted(-counts, -j, side="left")]] + j
            b = leave[rows]
            leave[rows - 1] = (m[2][rows] + m[3][rows] * b) / (m[0][rows] + m[1][rows] * b)
        # 3. Odds inside the chunks.
        forward, backward = np.ones((CHUNK, n)), np.ones((CHUNK, n))
        a = enter
        for k in range(CHUNK):
            new = power[k] * (t[0, 1] + a * t[1, 1]) / (t[0, 0] + a * t[1, 0])
            if k == 0:
                new = np.where(head, first * power[k], new)
            a = np.where(real[k], new, a)
            forward[k] = a
        b = leave
        for k in range(CHUNK - 1, -1, -1):
            backward[k] = b
            x = power[k] * b
            b = np.where(real[k], (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x), b)
        flat = lambda x: x.T.reshape(-1)[at]
        self.forward, self.backward, self.power = flat(forward), flat(backward), flat(power)

    def marginals(self) -> np.ndarray:
        odds = self.forward * self.backward
        return odds / (1 + odds)


def _log_sum(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-12, None))


def label_tokens(features: np.ndarray, offsets: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0/1 of each token from the labels of the documents."""
    size = 1 << FEATURE_BITS
    own = owners(offsets)
    found = np.zeros((2, size))
    for k in range(features.shape[1]):
        pair = np.unique(own.astype(np.int64) * size + features[:, k])
        for y in (0, 1):
            found[y] += np.bincount((pair % size)[toxic[pair // size] == y], minlength=size)
    n, rate = found.sum(0), max(toxic.mean(), 1e-9)
    share = np.divide(found[1], n, out=np.zeros(size), where=n > 0)
    evidence = n * (share * _log_sum(share / rate)
                    + (1 - share) * (_log_sum(1 - share) - np.log(max(1 - rate, 1e-9))))
    marks = (share >= PURITY) & (evidence >= EVIDENCE)
    return marks[features].any(1) & (toxic[own] == 1)


def _groups(offsets: np.ndarray):
    """First and last document and own offsets of each group of GROUP documents."""
    for i in range(0, len(offsets) - 1, GROUP):
        j = min(i + GROUP, len(offsets) - 1)
        yield i, j, offsets[i:j + 1] - offsets[i]


def _all_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and offsets of all texts, a slice at a time."""
    parts, sizes = [], [np.zeros(1, np.int64)]
    for part in text_slices(texts):
        f, _, _, offsets, _ = token_features(part)
        parts.append(f)
        sizes.append(np.diff(offsets))
    return np.concatenate(parts), np.cumsum(np.concatenate(sizes))


def _gradient(chain: Chain, words: np.ndarray, code: np.ndarray, y: np.ndarray, offsets: np.ndarray):
    """Observed minus expected counts: of each distinct word, of the four transitions, of the start."""
    score = chain.emissions(words)
    by_word, on_edges, on_start = np.zeros(len(words)), np.zeros(4), 0.0
    t = np.exp(chain.transitions)
    for i, j, own in _groups(offsets):
        at = slice(offsets[i], offsets[j])
        seen = y[at].astype(float)
        msg = Messages(score[code[at]], own, chain)
        rest = seen - msg.marginals()
        by_word += np.bincount(code[at], rest, len(words))
        starts = own[:-1][np.diff(own) > 0]
        on_start += rest[starts].sum()
        inner = np.ones(len(seen), bool)
        inner[starts] = False
        here = np.flatnonzero(inner)
        a, x = msg.forward[here - 1], msg.power[here] * msg.backward[here]
        joint = np.stack([np.full(len(here), t[0, 0]), t[0, 1] * x, a * t[1, 0], a * t[1, 1] * x])
        on_edges += np.bincount((2 * seen[here - 1] + seen[here]).astype(int), minlength=4)
        on_edges -= (joint / joint.sum(0)).sum(1)
    return by_word, on_edges, on_start


def fit(rows: list[tuple[int, str, int]]) -> Chain | None:
    """The chain fitted on labelled documents; None without both classes."""
    toxic = np.array([r[2] for r in rows], np.int64)
    if not len(rows) or toxic.min() == toxic.max():
        return None
    f, offsets = _all_features([r[1] for r in rows])
    y = label_tokens(f, offsets, toxic)
    # Emissions depend on the word alone: work on distinct words.
    _, first, code = np.unique(f[:, 0].astype(np.int64) << 32 | f[:, 3].astype(np.int64) << 14
                               | f[:, 7] >> 4, return_index=True, return_inverse=True)
    words, code = f[first], code.astype(np.int32)
    del f
    chain = Chain(np.zeros(1 << FEATURE_BITS), np.zeros((2, 2)), 0.0)
    params = np.zeros(len(chain.weights) + 5)
    params[-4:-1] = [-4.0, 0.0, 0.0]     # clean -> toxic is rare at first
    params[-5] = -4.0
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, ITERATIONS + 1):
        chain.weights, chain.start = params[:-5], params[-5]
        chain.transitions = np.array([[0.0, params[-4]], [params[-3], params[-2]]])
        by_word, on_edges, on_start = _gradient(chain, words, code, y, offsets)
        gradient = np.zeros_like(params)
        for k in range(words.shape[1]):
            gradient[:-5] += np.bincount(words[:, k], by_word, len(chain.weights))
        gradient[-5], gradient[-4:-1] = on_start, on_edges[1:]
        gradient = gradient / len(rows) - PENALTY * params
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        params = params + RATE * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    chain.weights, chain.start = params[:-5].copy(), float(params[-5])
    chain.transitions = np.array([[0.0, params[-4]], [params[-3], params[-2]]])
    score = chain.emissions(words)
    top = np.concatenate([_top(Messages(score[code[offsets[i]:offsets[j]]], own, chain).marginals(), own)
                          for i, j, own in _groups(offsets)])
    _calibrate(chain, top, toxic)
    return chain


def _top(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Largest marginal of each text, 0 without words."""
    out = np.zeros(len(offsets) - 1)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.maximum.reduceat(p, offsets[:-1][full])
    return out


def _calibrate(chain: Chain, top: np.ndarray, toxic: np.ndarray) -> None:
    """Slope and shift of the document score by Newton's method (penalised logistic regression)."""
    x = np.stack([_logit(top), np.ones(len(top))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (toxic - q) - (beta - np.array([1.0, 0.0]))
        h = (x * (q * (1 - q))[:, None]).T @ x + np.eye(2)
        beta = beta + np.linalg.solve(h, g)
    chain.slope, chain.shift = float(max(beta[0], 0.05)), float(beta[1])


def _scored(shared, batches: Iterator[pa.RecordBatch]):
    chain = shared.value
    for batch in batches:
        for part in slices(batch):
            n = part.num_rows
            if chain is None:
                top, spans = np.zeros(n), [[] for _ in range(n)]
                score = np.zeros(n)
            else:
                f, start, end, offsets, raw = token_features(full_text(part))
                p = Messages(chain.emissions(f), offsets, chain).marginals()
                top = _top(p, offsets)
                score = chain.score(top)
                spans = [[] for _ in range(n)]
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                own = owners(offsets)
                base = _row_starts(part)
                for t in np.flatnonzero(p >= 0.5).tolist():
                    r = int(own[t])
                    zero = int(base[r])
                    spans[r].append({"start": int(chars[start[t]]) - zero,
                                     "end": int(chars[end[t]]) - zero, "marginal": float(p[t])})
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(score, pa.float64()),
                 pa.array([len(s) for s in spans], pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                     ("marginal", pa.float64())])))],
                ["doc_id", "score", "n_toxic", "spans"])


def _row_starts(part: pa.RecordBatch) -> np.ndarray:
    """Code points before each text of the batch."""
    n = pc.utf8_length(full_text(part)).to_numpy()
    return np.concatenate([[0], np.cumsum(n)])


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score, n_toxic, spans (code points and marginals) of every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    chain = fit(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, sample_rows))
    shared = spark.sparkContext.broadcast(chain)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _scored(shared, it), SCHEMA)
