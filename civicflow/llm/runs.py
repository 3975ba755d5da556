"""Operator 13: periodic runs of words, found in a Re-Pair grammar of each document.

1. Words are the longest stretches of bytes other than space and 0x09-0x0D;
   Arrow's dictionary gives equal words of a batch one id.
2. Re-Pair, per document, all documents of a batch in one pass of arrays: each
   round counts the pairs of neighbouring symbols (in ``aaa`` every second one), and
   a pair's occurrences that outrank those they overlap, by count and then by
   id, become a new symbol, if there are two at least.  The most frequent pair of a document
   always goes through, so the rounds end when no pair occurs twice.  The
   sequence that is left is joined by a balanced tree of further symbols.
3. Each symbol's first derivation is searched once for runs that cross the boundary
   between its two parts: a period q is a candidate if the word beside the boundary
   recurs q words on or back; common extensions by binary search on prefix
   hashes give the stretch (Main and Lorentz' two cases, so q is at most the longer part).
4. The stretches are moved to all derivation positions of their symbol, and of
   one period only maximal intervals stay; of one interval the least period.

A run lies whole in the lowest symbol over it and crosses that symbol's
boundary, so each is found; what a smaller symbol sees of it lies inside.
Work is n log n for a document of n words.  Each run is compared word by
word in the end; if a hash ever deceived, the batch is done again with another one.

A document stays in one row of its scan task: no shuffle, no state beyond a batch.

Edge cases: null is the empty text, n = 0; a null ``doc_id`` has no hash, so its
words stay as they are; repeated rows are kept; a text without words or runs has four nulls
and the digests of the empty list and of its words; bytes beyond ASCII are word bytes;
an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import U64, full_text, mix, owners, prepare, ragged, slices, tokens

#: Least words of a run.
LEAST = 12
#: Candidates (boundary, period) that are tried at a time.
PORTION = 1 << 20

OUT_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, "
              "exponent_milli long, runs_sha256 string, collapsed_sha256 string")

#: White space of the word rule (fixed values): space, tab, line feed, VT, form feed, return.
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_BYTES = np.ones(256, np.uint8)
WORD_BYTES[list(_SPACES)] = 0


class Grammar:
    """Nodes over positions of all words: span [start, end), boundary, and derivations.

    ``node`` / ``at`` list the start of every derivation of the symbols that
    occur more than once; tree nodes occur once, at their own span."""

    def __init__(self, start, middle, end, node, at):
        self.start, self.middle, self.end = start, middle, end
        self.node, self.at = node, at


def _occurrences(pair: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Positions whose pair counts: in a chain of one overlapping pair every second one."""
    same = np.zeros(len(pair), bool)
    same[1:] = joined[1:] & joined[:-1] & (pair[1:] == pair[:-1])
    head = np.flatnonzero(~same)
    rank = np.arange(len(pair)) - np.repeat(head, np.diff(np.append(head, len(pair))))
    return joined & (rank % 2 == 0)


def repair(words: np.ndarray, offsets: np.ndarray) -> Grammar:
    """Re-Pair grammar of the documents ``words[offsets[i]:offsets[i + 1]]``."""
    n = len(words)
    doc = owners(offsets)
    # A symbol belongs to one document, so equal pairs of two documents are two pairs.
    _, symbol = np.unique(doc * (int(words.max(initial=0)) + 1) + words, return_inverse=True)
    symbol = symbol.astype(np.int64)
    at, fresh = np.arange(n, dtype=np.int64), int(symbol.max(initial=0)) + 1
    starts, middles, ends, nodes, places = [], [], [], [], []
    n_nodes = 0
    live = np.ones(len(offsets) - 1, bool)      # documents in which a pair may still recur
    done_symbol, done_at = [], []
    end_of = offsets[1:]
    while len(symbol):
        size = len(symbol)
        joined = np.zeros(size, bool)
        joined[:-1] = doc[1:] == doc[:-1]
        pair = np.full(size, -1, np.int64)
        pair[:-1] = symbol[:-1] * fresh + symbol[1:]
        pair[~joined] = -1
        place = np.flatnonzero(_occurrences(pair, joined))
        key, inverse, count = np.unique(pair[place], return_inverse=True, return_counts=True)
        # Rank of a position: its pair's count, then the pair; 0 if it occurs once.
        rank = np.zeros(size + 2, np.int64)
        rank[place + 1] = np.where(count[inverse] > 1, count[inverse] * (len(key) + 1) + inverse + 1, 0)
        own = rank[1:-1]
        # Equal neighbours do not overlap: alternate positions of a chain are two apart.
        chosen = (own > 0) & (own > rank[:-2]) & (own > rank[2:])
        place = place[chosen[place]]
        key, inverse, count = np.unique(pair[place], return_inverse=True, return_counts=True)
        keep = count[inverse] > 1
        place, inverse = place[keep], inverse[keep]
        going = np.zeros(len(live), bool)
        going[doc[place]] = True
        ended = live & ~going
        if ended.any():
            out = ended[doc]
            done_symbol.append(doc[out])
            done_at.append(at[out])
            shift = np.cumsum(~out) - 1
            place = shift[place]
            symbol, at, doc = symbol[~out], at[~out], doc[~out]
            live = going
        if not len(place):
            break
        _, inverse, first = _dense(inverse)
        stop = np.append(at[1:], n)
        last = np.append(doc[1:] != doc[:-1], True)
        stop[last] = end_of[doc[last]]
        starts.append(at[place[first]])
        middles.append(at[place[first] + 1])
        ends.append(stop[place[first] + 1])
        nodes.append(inverse + n_nodes)
        places.append(at[place])
        symbol[place] = fresh + inverse
        n_nodes += len(first)
        fresh += len(first)
        gone = np.ones(len(symbol), bool)
        gone[place + 1] = False
        symbol, at, doc = symbol[gone], at[gone], doc[gone]
        # Ids stay dense, so that a pair of them fits a long.
        _, symbol = np.unique(symbol, return_inverse=True)
        symbol = symbol.astype(np.int64)
        fresh = int(symbol.max(initial=0)) + 1
    doc = np.concatenate([*done_symbol, doc])
    at = np.concatenate([*done_at, at])
    order = np.lexsort((at, doc))
    tree = _balanced(at[order], doc[order], end_of)
    for found, more in zip((starts, middles, ends), tree):
        found.append(more)
    node = np.concatenate([*nodes, np.arange(len(tree[0])) + n_nodes])
    place = np.concatenate([*places, tree[0]])
    return Grammar(*(np.concatenate(x) for x in (starts, middles, ends)), node, place)


def _dense(inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, their numbers per element, and the first element of each."""
    return tuple(np.unique(inverse, return_inverse=True, return_index=True)[i] for i in (0, 2, 1))


def _balanced(at: np.ndarray, doc: np.ndarray, end_of: np.ndarray):
    """Spans and boundaries of the balanced binary trees over each document's symbols."""
    spans = [[], [], []]
    while len(at):
        first = np.append(True, doc[1:] != doc[:-1])
        head = np.flatnonzero(first)
        size = np.diff(np.append(head, len(at)))
        rank = np.arange(len(at)) - np.repeat(head, size)
        stop = np.append(at[1:], 0)
        last = np.append(first[1:], True)
        stop[last] = end_of[doc[last]]
        left = np.flatnonzero((rank % 2 == 0) & ~last)
        if not len(left):
            break
        spans[0].append(at[left])
        spans[1].append(at[left + 1])
        spans[2].append(stop[left + 1])
        # A document with one symbol is done.
        stay = (rank % 2 == 0) & np.repeat(size > 1, size)
        at, doc = at[stay], doc[stay]
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in spans]


class Extension:
    """Common extensions of two places by binary search on prefix hashes of the word ids.

    Hashes are polynomials modulo a prime: modulo a power of two, sequences
    such as Thue and Morse's deceive every base."""

    PRIME = np.int64((1 << 31) - 1)

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 20, int(self.PRIME) - 1))
        power = np.ones(1, np.int64)
        while len(power) <= len(words):
            power = np.concatenate([power, power * (pow(base, len(power), int(self.PRIME)))
                                    % self.PRIME])
        self.power = power[:len(words) + 1]
        salt = U64(int(rng.integers(1, 1 << 62)))
        value = (mix(words.astype(U64) + salt) >> U64(34)).astype(np.int64)
        self.sums = np.zeros(len(words) + 1, np.int64)
        np.cumsum(value * self.power[:-1] % self.PRIME, out=self.sums[1:])

    def _equal(self, a, b, size) -> np.ndarray:
        """Stretches of ``size`` from a and from b >= a are equal."""
        left = (self.sums[a + size] - self.sums[a]) % self.PRIME * self.power[b - a]
        return (left - (self.sums[b + size] - self.sums[b])) % self.PRIME == 0

    def _search(self, limit, test) -> np.ndarray:
        low, high = np.zeros(len(limit), np.int64), limit.astype(np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) >> 1
            good = test(open_, mid)
            low[open_[good]] = mid[good]
            high[open_[~good]] = mid[~good] - 1

    def forward(self, a, b, limit) -> np.ndarray:
        """Equal words from a and from b on, at most ``limit``."""
        return self._search(limit, lambda i, m: self._equal(a[i], b[i], m))

    def backward(self, a, b, limit) -> np.ndarray:
        """Equal words before a and before b."""
        return self._search(limit, lambda i, m: self._equal(a[i] - m, b[i] - m, m))


def _crossing(words: np.ndarray, g: Grammar, ext: Extension):
    """node, start, end, period of the periodic stretches over each node's boundary."""
    found = [[], [], [], []]
    wide = np.flatnonzero(g.end - g.start >= LEAST)
    # Longest parts first come in portions of bounded size.
    sizes = (g.end - g.start)[wide]
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // PORTION)) + 1
    for rows in np.split(wide, cuts):
        a, m, b = g.start[rows], g.middle[rows], g.end[rows]
        for right in (True, False):
            length = b - m if right else m - a
            # q beyond half of the span has no place for two periods.
            length = np.minimum(length, (b - a) // 2)
            own = np.repeat(np.arange(len(rows)), length)
            q = ragged(np.ones(len(rows), np.int64), length)
            edge = m[own]
            # The word beside the boundary recurs a period on (or before).
            hit = words[edge - 1] == words[edge - 1 + q] if right else words[edge] == words[edge - q]
            own, q = own[hit], q[hit]
            low, edge, high = a[own], m[own], b[own]
            x, y = (edge, edge + q) if right else (edge - q, edge)
            before = ext.backward(x, y, x - low)
            after = ext.forward(x, y, high - y)
            s, e = x - before, y + after
            good = e - s >= np.maximum(LEAST, 2 * q)
            for out, values in zip(found, (rows[own], s, e, q)):
                out.append(values[good])
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in found)


def _derived(g: Grammar, node, s, e, q):
    """The stretches at all derivation positions of their nodes."""
    order = np.argsort(g.node, kind="stable")
    nodes = g.node[order]
    first = np.searchsorted(nodes, node)
    count = np.searchsorted(nodes, node, side="right") - first
    own = np.repeat(np.arange(len(node)), count)
    shift = g.at[order][ragged(first, count)] - g.start[node][own]
    return s[own] + shift, e[own] + shift, q[own]


def _maximal(s, e, q):
    """Of one period the intervals in no other, of one interval the least period; by start, period."""
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    if len(s):
        # Ends grow by more than any text from period to period, so one running maximum serves.
        group = np.cumsum(np.append(True, q[1:] != q[:-1])) - 1
        reach = np.maximum.accumulate(e + group * (int(e.max()) + 1))
        keep = np.append(True, reach[1:] > reach[:-1])
        s, e, q = s[keep], e[keep], q[keep]
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        keep = np.append(True, (s[1:] != s[:-1]) | (e[1:] != e[:-1]))
        s, e, q = s[keep], e[keep], q[keep]
        order = np.lexsort((q, s))
        s, e, q = s[order], e[order], q[order]
    return s, e, q


def _true(words, s, e, q) -> bool:
    """Every stretch has its period, word by word."""
    at = 0
    while at < len(s):
        size = (e - s - q)[at:]
        k = max(int(np.searchsorted(np.cumsum(size), PORTION)), 1)
        i = ragged(s[at:at + k], size[:k])
        if not (words[i] == words[i + np.repeat(q[at:at + k], size[:k])]).all():
            return False
        at += k
    return True


def find_runs(words: np.ndarray, offsets: np.ndarray):
    """start, end, period of all runs, as places in ``words``; by start, then period."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    g = repair(words, offsets)
    seed = 13
    while True:
        s, e, q = _maximal(*_derived(g, *_crossing(words, g, Extension(words, seed))))
        if _true(words, s, e, q):
            return s, e, q
        seed += 1


def _changed(doc_ids: list, n: int, offsets: np.ndarray) -> np.ndarray:
    """Source place of each word: every tenth document, by hash, repeats a stretch of its own."""
    source = np.arange(n)
    for row, doc in enumerate(doc_ids):
        lo, size = int(offsets[row]), int(offsets[row + 1] - offsets[row])
        if doc is None or not size:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % size
        p = 1 + (size - a) // (3 + g % 8)
        source[lo + a:lo + size] = lo + a + np.arange(size - a) % p
    return source


def word_ids(text: pa.Array):
    """Bytes, starts and ends of the words, n + 1 offsets, and an id of each word."""
    raw, start, end, offsets = tokens(text, WORD_BYTES)
    size = end - start
    flat = np.concatenate([[0], np.cumsum(size)])
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start),
        [None, pa.py_buffer(flat.astype(np.int64)), pa.py_buffer(raw[WORD_BYTES[raw] > 0])])
    ids = column.dictionary_encode().indices.to_numpy().astype(np.int64)
    return raw, start, end, offsets, ids


def _digests(doc_ids: list, text: pa.Array, change: bool):
    raw, start, end, offsets, ids = word_ids(text)
    source = _changed(doc_ids, len(ids), offsets) if change else np.arange(len(ids))
    s, e, q = find_runs(ids[source], offsets)
    # Words after the first period of a run go.
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, s + q, 1)
    np.add.at(cover, e, -1)
    kept = np.cumsum(cover[:-1]) == 0
    doc = owners(offsets)
    left = np.concatenate([[0], np.cumsum(kept)])[offsets]
    # The kept words, each with a space after it.
    first, size = start[source[kept]], (end - start)[source[kept]]
    ends = np.cumsum(size + 1)
    joined = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    joined[ragged(ends - size - 1, size)] = raw[ragged(first, size)]
    bound = np.concatenate([[0], ends])[left].tolist()
    data = memoryview(joined)
    run_at = np.searchsorted(s, offsets)
    rows = []
    for i in range(len(doc_ids)):
        lo = int(offsets[i])
        a, b = int(run_at[i]), int(run_at[i + 1])
        best, listed = (None,) * 4, ""
        if b > a:
            rs, rl, rq = s[a:b] - lo, (e - s)[a:b], q[a:b]
            listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(rs.tolist(), rl.tolist(), rq.tolist()))
            k = int(np.lexsort((rq, rs, -rl))[0])
            best = (int(rs[k]), int(rl[k]), int(rq[k]), 1000 * int(rl[k]) // int(rq[k]))
        text_end = max(bound[i + 1] - 1, bound[i])
        rows.append((doc_ids[i], b - a, *best, hashlib.sha256(listed.encode()).hexdigest(),
                     hashlib.sha256(data[bound[i]:text_end]).hexdigest()))
    return rows, (s, e, q, doc)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
                    ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
                    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _reported(change: bool, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            rows, _ = _digests(part.column(0).to_pylist(), full_text(part), change)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _docs(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def run_report(docs: DataFrame, change: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): number of runs, the longest one, digests of the runs and
    of the collapsed words.  ``change`` plants a repeated stretch in every tenth document."""
    return _docs(docs).mapInArrow(lambda it: _reported(change, it), OUT_SCHEMA)


def _listed(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            _, start, end, offsets, ids = word_ids(full_text(part))
            s, e, q = find_runs(ids, offsets)
            row = np.searchsorted(offsets, s, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array(s - offsets[row]), pa.array(e - s),
                 pa.array(q)], ["doc_id", "start", "length", "period"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period (words) of every run of every row of ``docs``."""
    return _docs(docs).mapInArrow(_listed, "doc_id long, start long, length long, period long")


def _collapsed(position: int, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            raw, start, end, offsets, ids = word_ids(full_text(part))
            s, e, q = find_runs(ids, offsets)
            text = part.column(position).to_pylist()
            drop: dict[int, list] = {}
            for row, a, b in zip((np.searchsorted(offsets, s, side="right") - 1).tolist(),
                                 (s + q).tolist(), e.tolist()):
                drop.setdefault(row, []).append((a, b))
            for row, cuts in drop.items():
                kept = np.ones(int(offsets[row + 1] - offsets[row]), bool)
                for a, b in cuts:
                    kept[a - offsets[row]:b - offsets[row]] = False
                at = np.flatnonzero(kept) + offsets[row]
                text[row] = b" ".join(raw[start[i]:end[i]].tobytes() for i in at.tolist()).decode()
            columns = list(part.columns)
            columns[position] = pa.array(text, part.schema.field(position).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)


def collapsed(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats of every run dropped, all columns; texts without a run stay untouched."""
    prepare(docs.sparkSession)
    position = docs.columns.index("text")
    return docs.mapInArrow(lambda it: _collapsed(position, it), docs.schema)
