"""Elias-Fano coding of rising integers and an n-gram trie over it, in flat words.

A sequence of n values below u keeps the low ``l`` bits of each value packed
and the high bits as a bit vector (value ``v[i] >> l`` sets bit ``(v[i] >> l) + i``).
Element i is the i-th one of the vector; the first element not below x (the *successor*)
lies between two of its zeros.  All queries take arrays of arguments.

Everything is read in place from one buffer of little-endian words, whether
the bytes of an Arrow value or a memory-mapped file (``Trie.open``).  Opening a
sequence makes its select directories, 32-bit numbers for each one and each zero of
the vector, for queries in constant time; a shard of the model is open in one task at a time.
"""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
_SIXTY_FOUR = U64(64)


def _pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    n = len(values)
    out = np.zeros((n * bits + 63) // 64 + 1, U64)
    if not bits or not n:
        return out
    place = np.arange(n, dtype=np.int64) * bits
    word, shift = place >> 6, (place & 63).astype(U64)
    v = values.astype(U64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    out[word[first]] = np.bitwise_or.reduceat(v << shift, first)
    # What crosses into the next word; one value at most does so per word.
    over = np.flatnonzero(shift + U64(bits) > _SIXTY_FOUR)
    out[word[over] + 1] |= v[over] >> (_SIXTY_FOUR - shift[over])
    return out


class EliasFano:
    """A rising sequence in a buffer; ``encode`` gives the words, ``EliasFano(words, at)`` reads them."""

    def __init__(self, words: np.ndarray, at: int = 0):
        n, bits, n_low, n_high = (int(x) for x in words[at:at + 4])
        self.n, self.bits = n, bits
        at += 4
        self.low = words[at:at + n_low]
        self.high = words[at + n_low:at + n_low + n_high]
        self.size = 4 + n_low + n_high
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        kind = np.int32 if n_high < 1 << 25 else np.int64
        # High bits of each element, and the first element of each value of the high bits.
        self.top = (ones - np.arange(n)).astype(kind)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.top))]).astype(kind)
        self.mask = U64((1 << bits) - 1)

    @staticmethod
    def encode(values: np.ndarray) -> np.ndarray:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max((top // n).bit_length() - 1, 0) if n else 0
        high = (values >> bits) + np.arange(n)
        # One zero after the last bucket at least, and whole words.
        size = (((n + (top >> bits) + 2) + 63) // 64) * 64
        flags = np.zeros(size, np.uint8)
        flags[high] = 1
        vector = np.packbits(flags, bitorder="little").view("<u8")
        low = _pack_low(values & ((1 << bits) - 1), bits)
        return np.concatenate([np.array([n, bits, len(low), len(vector)], U64), low, vector])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        place = i * self.bits
        word, shift = place >> 6, (place & 63).astype(U64)
        first = self.low[word] >> shift
        rest = self.low[word + 1] << ((_SIXTY_FOUR - shift) & U64(63))
        return (first | np.where(shift > 0, rest, U64(0))) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """Elements at i (all within the sequence)."""
        i = np.asarray(i, np.int64)
        return (self.top[i].astype(np.int64) << self.bits) | self._low(i).astype(np.int64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element that is not below x (n if there is none)."""
        x = np.maximum(np.asarray(x, np.int64), 0)
        out = np.full(len(x), self.n, np.int64)
        if not self.n:
            return out
        h = x >> self.bits
        there = np.flatnonzero(h < len(self.starts) - 1)
        x, h = x[there], h[there]
        low, high = self.starts[h].astype(np.int64), self.starts[h + 1].astype(np.int64)
        want = x.astype(U64) & self.mask
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            less = self._low(mid) < want[open_]
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        out[there] = low
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of x, -1 where it does not occur."""
        i = self.successor(x)
        hit = i < self.n
        hit[hit] = self.access(i[hit]) == x[hit]
        return np.where(hit, i, -1)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (one byte) and the table of 256 values; a value becomes the next lower one of the table.

    Up to 256 distinct values stay as they are; else each code has a like share of the entries."""
    values = values.astype(np.float32)
    table = np.unique(values)
    if len(table) > 256:
        ranked = np.sort(values)
        table = np.unique(ranked[np.arange(256) * len(ranked) // 256])
    code = np.searchsorted(table, values, side="right") - 1
    full = np.zeros(256, np.float32)
    full[:len(table)] = table
    return code.astype(np.uint8), full


def _words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as whole words."""
    raw = np.frombuffer(np.ascontiguousarray(data).tobytes(), np.uint8)
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)]).view("<u8")


def _relative(child: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rising values of the children of all contexts: each range goes on from the last value of
    the one before.  ``first`` marks the places where a context's range begins."""
    if not len(child):
        return child
    last = np.append(first[1:], len(child)) - 1
    base = np.concatenate([[0], np.cumsum(child[last] + 1)])[:-1]
    return child + 1 + np.repeat(base, np.diff(np.append(first, len(child))))


class Trie:
    """Levels of words, pairs and triples of word ids.

    lexicon: the ids in the trie (Elias-Fano); level 1: the first words, as
    places in the lexicon; levels 2 and 3: pointers to each context's children (Elias-Fano)
    and the children, rising over the whole level because each context's range starts
    at the last value of the one before; so a child is sought by the successor of
    that value plus its place in the lexicon.  Values: the discounted probability of pairs and
    triples, and the weight that a pair, as context, leaves to shorter contexts.
    """

    MAGIC = b"EFNG"

    def __init__(self, buffer):
        words = np.frombuffer(buffer, "<u8") if not isinstance(buffer, np.ndarray) else buffer
        if words[:1].tobytes()[:4] != self.MAGIC:
            raise ValueError("not an n-gram trie")
        at, parts = 1, []
        for _ in range(6):
            parts.append(EliasFano(words, at))
            at += parts[-1].size
        self.lexicon, self.first, self.pairs_at, self.pairs, self.triples_at, self.triples = parts
        self.codes = []
        for n in (self.pairs.n, self.pairs.n, self.triples.n):
            table = words[at:at + 128].view("<f4")
            size = (n + 7) // 8
            self.codes.append((words[at + 128:at + 128 + size].view(np.uint8), table))
            at += 128 + size

    @classmethod
    def open(cls, path: str) -> "Trie":
        """The trie in a file, memory-mapped."""
        # As a plain array: the subclass of a mapped one slows every index.
        return cls(np.asarray(np.memmap(path, "<u8", mode="r")))

    @classmethod
    def build(cls, a, b, pair_p, pair_rest, parent, c, triple_p) -> bytes:
        """Bytes of the trie of the pairs (a, b), in order, and the triples (parent pair, c), in order."""
        ids = np.unique(np.concatenate([a, b, c]))
        la, lb, lc = (np.searchsorted(ids, x) for x in (a, b, c))
        head = np.flatnonzero(np.append(True, la[1:] != la[:-1])) if len(la) else np.zeros(0, np.int64)
        pairs_at = np.append(head, len(la))
        triples_at = np.searchsorted(parent, np.arange(len(la) + 1))
        starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(lc) else head[:0]
        parts = [np.frombuffer(cls.MAGIC + struct.pack("<I", 1), "<u8")]
        for values in (ids, la[head], pairs_at, _relative(lb, head), triples_at,
                       _relative(lc, starts)):
            parts.append(EliasFano.encode(values))
        for values in (pair_p, pair_rest, triple_p):
            code, table = quantise(values)
            parts += [_words_of(table), _words_of(code)]
        return b"".join(p.astype("<u8").tobytes() for p in parts)

    def _child(self, pointers, level, node, word) -> np.ndarray:
        """Place of ``word`` among the children of ``node``; -1 where either is missing."""
        out = np.full(len(node), -1, np.int64)
        rows = np.flatnonzero((node >= 0) & (word >= 0))
        begin, end = pointers.access(node[rows]), pointers.access(node[rows] + 1)
        some = begin < end
        rows, begin, end = rows[some], begin[some], end[some]
        if len(rows):
            base = np.zeros(len(rows), np.int64)
            later = begin > 0
            base[later] = level.access(begin[later] - 1)
            target = base + word[rows] + 1
            at = level.successor(target)
            hit = at < end
            hit[hit] = level.access(at[hit]) == target[hit]
            out[rows] = np.where(hit, at, -1)
        return out

    def lookup(self, ids, a, b, parent, c):
        """Codes of the pairs (ids[a], ids[b]), of the weights they leave, and of the triples (pair number,
        ids[c]), each plus 1; 0 is unseen.  ``codes`` has the tables of their values."""
        place = self.lexicon.find(ids)
        root = np.where(place >= 0, self.first.find(np.maximum(place, 0)), -1)
        pair = self._child(self.pairs_at, self.pairs, root[a], place[b])
        triple = self._child(self.triples_at, self.triples, pair[parent], place[c])
        found = []
        for (code, _), node in zip(self.codes, (pair, pair, triple)):
            value = np.zeros(len(node), np.int64)
            value[node >= 0] = code[node[node >= 0]].astype(np.int64) + 1
            found.append(value)
        return found

    def values(self, ids, a, b, parent, c):
        """The values of ``lookup``: 0 for an unseen pair or triple, which leaves the whole weight of 1."""
        return [np.append(np.float32(missing), table)[code] for code, (_, table), missing in zip(
            self.lookup(ids, a, b, parent, c), self.codes, (0, 1, 0))]
