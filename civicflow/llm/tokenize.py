"""Whole-text encoding with the ``tokenizers`` library, one call per *distinct* piece.

Texts are cut at places that no token can cross, the pieces of a batch are
dictionary-encoded by Arrow, and only pieces a worker has not met go through
the tokenizer.  The ids are those of encoding the whole text at once.  Both
pre-tokenizers separate letters or digits from punctuation, so a place between
an ASCII letter or digit and ASCII punctuation is one, but for the apostrophe
(contractions) and ``< | >`` (special tokens).  Further:

* ``word``: the tokenizer drops white space, so ASCII white space is such a
  place.  It also lowers the text; pure ASCII pieces are lowered before.
* ``byte``: a token starts at a single space or line end between two
  characters that are not white space; the space goes with the piece after
  it.  A text with any other white space is encoded whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from civicflow.llm.common import buffer_of, ragged

#: Bytes of text that are cut into pieces at a time: each distinct piece of it is looked up once.
TOKEN_SLICE = 4 << 20
#: Pieces a worker remembers (about 150 bytes each); further ones are encoded when met.
CACHE_PIECES = 500_000
#: Longer pieces are encoded without being remembered.
CACHE_CHARS = 64

#: Classes of bytes: other, ASCII letter or digit, ASCII punctuation, space, other ASCII white space.
_OTHER, _ALNUM, _PUNCT, _SPACE, _WHITE = range(5)
_CLASS = np.zeros(256, np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (_ALNUM if _c.isalnum() else _SPACE if _c == " " else _WHITE if _c in "\t\n\v\f\r"
                  else _PUNCT if 32 < _b < 127 and _c not in "'<|>" else _OTHER)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: White space beyond ASCII (fixed values of Unicode's White_Space property).
_WIDE_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _unsafe(text: pa.Array, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with white space beside white space or at the end, or with any beyond ASCII."""
    white = kind >= _SPACE
    bad = np.zeros(len(kind) + 1, np.int64)
    after = np.append(white[1:], False)
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    # A line end that starts a text, too: only a space goes with the next piece.
    found = white & after
    head = offsets[:-1][np.diff(offsets) > 0]
    found[head] |= kind[head] == _WHITE
    np.cumsum(found, out=bad[1:])
    wide = pc.match_substring_regex(text, _WIDE_SPACE).to_numpy(zero_copy_only=False)
    return (bad[offsets[1:]] > bad[offsets[:-1]]) | wide


def _pieces(text: pa.Array, kind: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts and the n + 1 offsets."""
    raw, offsets = buffer_of(text)
    if not len(raw):
        return pa.array([], pa.large_string()), np.zeros(len(text) + 1, np.int64)
    cls = _CLASS[raw]
    left, right = cls[:-1], cls[1:]
    edge = np.zeros(len(raw) + 1, bool)
    edge[1:-1] = (left == _ALNUM) & (right == _PUNCT) | (left == _PUNCT) & (right == _ALNUM)
    white = cls >= _SPACE
    if kind == "word":
        edge[:-1] |= white
        edge[1:] |= white
    else:
        edge[:-1] |= white
        edge[1:] |= cls == _WHITE
        bad = _unsafe(text, cls, offsets)
        if bad.any():
            edge[:-1][np.repeat(bad, np.diff(offsets))] = False
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    if kind == "word":
        real = ~white[start]
        start, end = start[real], end[real]
        high = np.concatenate([[0], np.cumsum((raw >= 128) | (raw == 124))])
        plain = np.repeat(high[end] == high[start], end - start)
        raw = raw[~white]
        raw = np.where(plain, _LOWER[raw], raw)
    ends = np.concatenate([[0], np.cumsum(end - start)])
    flat = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes()))
    return flat, np.searchsorted(start, offsets)


class Encoder:
    """ids of texts; kept per worker process and vocabulary file."""

    _made: dict[tuple[str, str], "Encoder"] = {}

    @classmethod
    def get(cls, path: str, kind: str) -> "Encoder":
        if (path, kind) not in cls._made:
            cls._made[path, kind] = cls(path, kind)
        return cls._made[path, kind]

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = kind
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.n_ids = 0

    def _remember(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids and lengths of new pieces; remembers the short ones while there is room."""
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32, int(size.sum()))
        room = CACHE_PIECES - len(self.known)
        short = np.fromiter((len(p) <= CACHE_CHARS for p in pieces), bool, len(pieces))
        keep = np.flatnonzero(short)[:room]
        if len(keep):
            k = len(self.known)
            start = np.cumsum(size) - size
            own = ids[ragged(start[keep], size[keep])]
            self.starts = _grown(self.starts, k + len(keep))
            self.lengths = _grown(self.lengths, k + len(keep))
            self.ids = _grown(self.ids, self.n_ids + len(own))
            self.starts[k:k + len(keep)] = self.n_ids + np.cumsum(size[keep]) - size[keep]
            self.lengths[k:k + len(keep)] = size[keep]
            self.ids[self.n_ids:self.n_ids + len(own)] = own
            self.n_ids += len(own)
            self.known.update(zip((pieces[i] for i in keep.tolist()), range(k, k + len(keep))))
        return ids, size

    def _table(self, pieces: list[str]):
        """Starts and lengths of each piece in one id array (remembered ids, then new ones)."""
        get = self.known.get
        at = np.fromiter((get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        starts = self.starts[at]
        lengths = self.lengths[at].astype(np.int64)
        ids = self.ids[:self.n_ids]
        if len(missing):
            n = self.n_ids
            new, size = self._remember([pieces[i] for i in missing.tolist()])
            starts[missing] = n + np.cumsum(size) - size
            lengths[missing] = size
            ids = np.concatenate([ids[:n], new])
        return ids, starts, lengths

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts (uint32, concatenated) and the n + 1 offsets."""
        flat, offsets = _pieces(text, self.kind)
        if not len(flat):
            return np.zeros(0, np.uint32), np.zeros(len(text) + 1, np.int64)
        coded = flat.dictionary_encode()
        code = coded.indices.to_numpy()
        ids, starts, lengths = self._table(
            coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = lengths[code]
        out = ids[ragged(starts[code], size)]
        return out, np.concatenate([[0], np.cumsum(size)])[offsets]


def _grown(values: np.ndarray, n: int) -> np.ndarray:
    """``values`` with room for n at least."""
    while n > len(values):
        values = np.concatenate([values, np.zeros_like(values)])
    return values


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's, and the new offsets."""
    n = len(offsets) - 1
    return (np.insert(ids, offsets[1:], np.uint32(end)),
            offsets + np.arange(n + 1))
