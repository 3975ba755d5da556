"""Operator 5: benchmark decontamination by n-gram seeds and local alignment.

1. Words are runs of letters and digits, lower case.  Every ``N`` consecutive
   words of a test item are a seed.  None is left out: in an edited or partial
   copy the seeds that survive are the frequent ones, those it broke the rare.
2. One scan joins seeds to texts.  Hits of one item on near diagonals form a
   window of the text.  An alignment scores at most 2 for each word that item
   and window share, so windows with too few shared words are dropped unaligned.
3. Smith-Waterman alignment of item and window (match +2, mismatch and gap
   -1) scores each window; the score is divided by that of a full match.
   A pair counts from ``MIN_SCORE``, or from ``MIN_RUN`` words' worth of a long item.

A text's hits are taken at most ``HITS`` at a time (or those of one text and
item), so seeds that many items share need no more memory.
The items are a stated query set: they are taken in blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text, and each block's index is
broadcast.  Nothing else is shuffled or gathered.

Edge cases: null or empty texts match nothing; items with fewer than
``MIN_WORDS`` words can't tell a leak from chance and are not sought; repeated
rows each give their rows; empty tables give none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import (ByteHash, U64, full_text, mix, owners, prepare, ragged, slices,
                                  tokens)

N = 3
MIN_WORDS = 5
MIN_SCORE = 0.5
MIN_RUN = 40
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
#: Cells of one row of a batch of alignments.
CELLS = 1 << 20
#: Hits that are grouped into windows at a time.
HITS = 1 << 19
SCHEMA = "doc_id long, item_id long, score double, first_word int, last_word int"

_BITS = 20


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts and the n + 1 offsets."""
    raw, start, end, offsets = tokens(pc.utf8_lower(text))
    return ByteHash(raw).range(start, end), offsets


def ngrams(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the N words from each position."""
    h = words[at]
    for j in range(1, N):
        h = mix(h * U64(3) + words[at + j])
    return h


class Index:
    """Words, seeds and postings of one block of items."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, offsets = word_hashes(pa.array(texts, pa.large_string()))
        enough = np.flatnonzero(np.diff(offsets) >= MIN_WORDS)
        self.ids = np.asarray(ids, np.int64)[enough] if ids else np.zeros(0, np.int64)
        starts, lengths = offsets[:-1][enough], np.diff(offsets)[enough]
        self.words = words[ragged(starts, lengths)]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.common = np.zeros(1 << _BITS, bool)
        self.common[(self.words >> U64(64 - _BITS)).astype(np.int64)] = True
        per = np.maximum(lengths - N + 1, 0)
        at = ragged(self.offsets[:-1], per)
        grams = ngrams(self.words, at) if len(at) else np.zeros(0, U64)
        self.seeds, seed_of = np.unique(grams, return_inverse=True)
        item = np.repeat(np.arange(len(lengths)), per)
        # Postings (item, place) by seed and item.
        order = np.argsort(seed_of, kind="stable")
        self.post_item = item[order]
        self.post_place = (at - self.offsets[:-1][item])[order]
        self.post_key = seed_of[order] * (len(lengths) + 1) + self.post_item
        # How often each item has each of its words.
        self.vocabulary, word = np.unique(self.words, return_inverse=True)
        self.bag, self.bag_count = np.unique(
            owners(self.offsets) * len(self.vocabulary) + word, return_counts=True)

    def hits(self, text: pa.Array):
        """Word hashes, offsets, and (row, word position, seed) of each seed candidate."""
        words, offsets = word_hashes(text)
        known = self.common[(words >> U64(64 - _BITS)).astype(np.int64)]
        known = np.append(known, np.zeros(N, bool))
        run = known[:len(words)].copy()
        for j in range(1, N):
            run &= known[j:len(words) + j]
        at = np.flatnonzero(run)
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + N <= offsets[row + 1] if len(at) else np.zeros(0, bool)
        at, row = at[inside], row[inside]
        if not len(at) or not len(self.seeds):
            zero = np.zeros(0, np.int64)
            return words, offsets, zero, zero, zero
        grams = ngrams(words, at)
        seed = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        same = self.seeds[seed] == grams
        return words, offsets, row[same], at[same] - offsets[:-1][row[same]], seed[same]

    def matches(self, text: pa.Array):
        """row, item, score, first and last word (in the text) of all pairs that count."""
        words, offsets, *hits = self.hits(text)
        found = [self._windows(words, offsets, *part) for part in self._parts(*hits, 0, len(self.ids))]
        if not found:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) + (np.zeros(0, np.int64),) * 2
        return tuple(np.concatenate(x) for x in zip(*found))

    def _parts(self, row, place, seed, low, high):
        """row, item, diagonal of the hits of items low..high - 1, all of a row and item together."""
        first = np.searchsorted(self.post_key, seed * (len(self.ids) + 1) + low)
        count = np.searchsorted(self.post_key, seed * (len(self.ids) + 1) + high) - first
        if not count.any():
            return
        if count.sum() > HITS and row[0] < row[-1]:
            cut = np.searchsorted(row, (row[0] + row[-1]) // 2, side="right")
            yield from self._parts(row[:cut], place[:cut], seed[:cut], low, high)
            yield from self._parts(row[cut:], place[cut:], seed[cut:], low, high)
        elif count.sum() > HITS and high - low > 1:
            middle = (low + high) // 2
            yield from self._parts(row, place, seed, low, middle)
            yield from self._parts(row, place, seed, middle, high)
        else:
            at = ragged(first, count)
            yield (np.repeat(row, count), self.post_item[at],
                   np.repeat(place, count) - self.post_place[at])

    def _shared(self, words, start, length, item):
        """Words that each window shares with its item, repeated ones as often as both have them."""
        out = np.zeros(len(item), np.int64)
        ends = np.cumsum(length)
        at = 0
        while at < len(item):
            done = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, done + CELLS, side="right")), at + 1)
            word = words[ragged(start[at:to], length[at:to])]
            window = np.repeat(np.arange(to - at), length[at:to])
            v = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
            known = self.vocabulary[v] == word
            window, key = window[known], item[at:to][window[known]] * len(self.vocabulary) + v[known]
            own = np.minimum(np.searchsorted(self.bag, key), len(self.bag) - 1)
            known = self.bag[own] == key
            pair, n = np.unique(window[known] * len(self.bag) + own[known], return_counts=True)
            n = np.minimum(n, self.bag_count[pair % len(self.bag)])
            out[at:to] = np.bincount(pair // len(self.bag), weights=n, minlength=to - at)
            at = to
        return out

    def _windows(self, words, offsets, row, item, diagonal):
        """The pairs that count, from hits (row, item, diagonal)."""
        order = np.lexsort((diagonal, item, row))
        row, item, diagonal = row[order], item[order], diagonal[order]
        size = np.diff(self.offsets)
        new = np.ones(len(row), bool)
        new[1:] = ((row[1:] != row[:-1]) | (item[1:] != item[:-1])
                   | (diagonal[1:] - diagonal[:-1] > size[item[1:]] // 2 + 8))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        r, i = row[first], item[first]
        slack = size[i] // 4 + 4
        lo = np.maximum(diagonal[first] - slack, 0)
        hi = np.minimum(diagonal[last] + size[i] + slack, np.diff(offsets)[r])
        counts = lambda score, i: (score >= 2 * MIN_SCORE * size[i]) | (score >= 2 * MIN_RUN)
        good = counts(2 * self._shared(words, offsets[:-1][r] + lo, hi - lo, i), i)
        r, i, lo, hi = (x[good] for x in (r, i, lo, hi))
        best, where = self._align(words, offsets[:-1][r] + lo, hi - lo, i)
        good = counts(best, i)
        r, i, lo, hi, best, where = (x[good] for x in (r, i, lo, hi, best, where))
        _, back = self._align(words, offsets[:-1][r] + lo, hi - lo, i, reverse=True)
        a, b = lo + (hi - lo - 1 - back), lo + where
        # The best window of each pair.
        order = np.lexsort((a, -best, i, r))
        pick = order[np.concatenate([[True], (r[order][1:] != r[order][:-1])
                                     | (i[order][1:] != i[order][:-1])])] if len(r) else order
        return r[pick], i[pick], best[pick] / (2 * size[i[pick]]), a[pick], b[pick]

    def _align(self, words, start, length, item, reverse=False):
        """Best local score of each (window, item) and the window's word where it ends."""
        best, where = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        if not len(item):
            return best, where
        size = np.diff(self.offsets)[item]
        order = np.argsort(length * 10_000 + size, kind="stable")
        at = 0
        while at < len(order):
            # As many of like size as fit; the widest is last.
            n = 1
            while at + n < len(order) and (n + 1) * length[order[at + n]] <= CELLS:
                n += 1
            group = order[at:at + n]
            at += n
            w, m = int(length[group].max()), int(size[group].max())
            text = np.zeros((n, w), U64)
            own = np.zeros((n, m), U64)
            in_text = np.arange(w) < length[group][:, None]
            in_item = np.arange(m) < size[group][:, None]
            text[in_text] = words[ragged(start[group], length[group])]
            own[in_item] = self.words[ragged(self.offsets[:-1][item[group]], size[group])]
            if reverse:
                flip = lambda x, k: x[np.arange(n)[:, None], (k[:, None] - 1 - np.arange(x.shape[1])) % x.shape[1]]
                text, own = flip(text, length[group]), flip(own, size[group])
            ramp = np.arange(w, dtype=np.int32)
            row = np.zeros((n, w + 1), np.int32)
            top, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
            for j in range(m):
                equal = (text == own[:, j:j + 1]) & in_text & in_item[:, j:j + 1]
                h = np.maximum(row[:, :-1] + np.where(equal, 2, -1), row[:, 1:] - 1)
                np.maximum(h, 0, out=h)
                h = np.maximum.accumulate(h + ramp, axis=1) - ramp
                high = h.max(1)
                better = high > top
                if better.any():
                    end[better] = h[better].argmax(1)
                    top = np.maximum(top, high)
                row[:, 1:] = h
            best[group], where[group] = top, end
        return best, where


def blocks(items: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """The items (item_id, text) in blocks of bounded size, as the driver meets them."""
    ids, texts, size = [], [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item, text in rows.where("text IS NOT NULL").toLocalIterator():
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text)
    if ids:
        yield ids, texts


def indexes(docs: DataFrame, items: DataFrame) -> Iterator:
    """A broadcast index of each block."""
    spark = prepare(docs.sparkSession)
    for ids, texts in blocks(items):
        index = Index(ids, texts)
        if len(index.seeds):
            yield spark.sparkContext.broadcast(index)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word of each document that holds a copy of an item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    out = None
    for shared in indexes(docs, items):
        def find(batches: Iterator[pa.RecordBatch], shared=shared):
            index = shared.value
            for batch in batches:
                for part in slices(batch):
                    r, i, score, a, b = index.matches(full_text(part))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": part.column(0).take(pa.array(r)),
                        "item_id": pa.array(index.ids[i], pa.int64()),
                        "score": pa.array(score, pa.float64()),
                        "first_word": pa.array(a.astype(np.int32)),
                        "last_word": pa.array(b.astype(np.int32))})
        found = rows.mapInArrow(find, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else rows.sparkSession.createDataFrame([], SCHEMA)


def filtered(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Rows of ``docs`` (all columns) for which ``keep`` says so, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part)))
    return docs.mapInArrow(run, docs.schema)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a copy of an item; all columns kept."""
    for shared in indexes(docs, items):
        def keep(batch: pa.RecordBatch, shared=shared) -> np.ndarray:
            row = shared.value.matches(full_text(batch))[0]
            out = np.ones(batch.num_rows, bool)
            out[row] = False
            return out
        docs = filtered(docs, keep)
    return docs
