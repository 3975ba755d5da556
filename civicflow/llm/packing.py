"""Operator 4: vector bin packing of examples into training sequences.

An example is a vector (tokens, one segment, loss-bearing tokens) and a
sequence has a limit on each.  The open sequence takes, among the pooled
pieces that fit, the one with the largest dot product of its demand and the
sequence's remaining room (both as shares of the limits).  When none fits and
cutting is allowed, the best piece is cut to fill the room exactly; its rest
goes back to the pool.  What a task has left at its end, or a sequence closed
by another limit, is cut at powers of two, which are lengths that need no
padding.

Packing is local to a scan partition: nothing is shuffled, a task holds at
most ``POOL`` pieces shorter than a sequence, and a re-run task repeats its
result.  The loss-bearing tokens of an example are its last ``loss_tokens``
(all by default).

Edge cases: a null or empty text is the end id alone; a null ``doc_id`` is
packed and returned as null; repeated rows are packed each; an empty table
gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import full_text, prepare, slices
from civicflow.llm.tokenize import TOKEN_SLICE, Encoder, with_end

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
POOL = 256
END_ID = 1
#: Sequences of a task count from its partition number times this.
TASK_SPAN = 1 << 40

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, segment int, loss_tokens long, ids binary")


@dataclass(slots=True)
class Piece:
    row: int | None          # doc_id
    start: int
    ids: np.ndarray
    doc_tokens: int
    loss_from: int           # the document's tokens from here on bear loss

    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.loss_from))

    def cut(self, k: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.row, self.start, self.ids[:k], self.doc_tokens, self.loss_from),
                Piece(self.row, self.start + k, self.ids[k:], self.doc_tokens, self.loss_from))


class Packer:
    """Packs a stream of pieces; ``sequences`` collects finished lists of pieces."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                 max_loss: int | None = None, pool: int = POOL, cut: bool = True):
        self.limits = np.array([max_tokens, max_segments, max_loss or max_tokens], float)
        self.pool_size, self.may_cut = pool, cut
        self.pool: list[Piece] = []
        self.demand = np.zeros((0, 3))
        self.sequences: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        full = int(self.limits[0])
        while self.may_cut and len(piece.ids) >= full:
            head, rest = piece.cut(full)
            if head.loss() > self.limits[2]:
                break
            self.sequences.append([head])
            piece = rest
        if not len(piece.ids):
            return
        if not self.may_cut and (self._vector(piece) > self.limits).any():
            raise ValueError("an example exceeds the limits and may not be cut")
        self._put(piece)
        while len(self.pool) >= self.pool_size:
            self._fill()

    def finish(self) -> None:
        while self.pool:
            self._fill()

    def _vector(self, p: Piece) -> np.ndarray:
        return np.array([len(p.ids), 1, p.loss()], float)

    def _put(self, piece: Piece) -> None:
        self.pool.append(piece)
        self.demand = np.vstack([self.demand, self._vector(piece)])

    def _take(self, i: int) -> Piece:
        piece = self.pool.pop(i)
        self.demand = np.delete(self.demand, i, 0)
        return piece

    def _fill(self) -> None:
        """Fill one sequence from the pool."""
        room, chosen = self.limits.copy(), []
        scale = 1 / self.limits ** 2
        while self.pool and room[0] > 0 and room[1] > 0:
            score = self.demand @ (room * scale)
            fits = (self.demand <= room).all(1)
            if fits.any():
                piece = self._take(int(np.argmax(np.where(fits, score, -1))))
            elif self.may_cut:
                i = int(np.argmax(score))
                k = min(int(room[0]), len(self.pool[i].ids) - 1)
                p = self.pool[i]
                # No more loss-bearing tokens than there is room for.
                k = min(k, max(p.loss_from - p.start, 0) + int(room[2]))
                if k <= 0:
                    break
                piece, rest = self._take(i).cut(k)
                self._put(rest)
            else:
                break
            chosen.append(piece)
            room -= self._vector(piece)
        self._close(chosen)

    def _close(self, chosen: list[Piece]) -> None:
        total = sum(len(p.ids) for p in chosen)
        if total == self.limits[0] or not self.may_cut:
            self.sequences.append(chosen)
            return
        while chosen:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part: list[Piece] = []
            while size:
                piece = chosen.pop(0)
                if len(piece.ids) > size:
                    piece, rest = piece.cut(size)
                    chosen.insert(0, rest)
                size -= len(piece.ids)
                part.append(piece)
            self.sequences.append(part)


def _pieces(packer: Packer, first: int) -> tuple[pa.RecordBatch, int]:
    """The finished sequences as rows; empties the packer's list."""
    cols: dict[str, list] = {c.split()[0]: [] for c in PIECE_SCHEMA.split(", ")}
    for sequence in packer.sequences:
        offset = 0
        for k, p in enumerate(sequence):
            data = p.ids.astype("<u4").tobytes()
            for name, v in (("doc_id", p.row), ("start", p.start), ("length", len(p.ids)),
                            ("ids_crc32", zlib.crc32(data)), ("doc_tokens", p.doc_tokens),
                            ("sequence_id", first), ("offset", offset), ("segment", k),
                            ("loss_tokens", p.loss()), ("ids", data)):
                cols[name].append(v)
            offset += len(p.ids)
        first += 1
    packer.sequences = []
    kinds = {"segment": pa.int32(), "ids": pa.binary()}
    return pa.RecordBatch.from_pydict(
        {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in cols.items()}), first


def _pack(tokenizer: str, limits: dict, batches: Iterator[pa.RecordBatch]):
    encoder = Encoder.get(tokenizer, "byte")
    packer = Packer(**limits)
    number = TaskContext.get().partitionId() * TASK_SPAN
    for batch in batches:
        for part in slices(batch, limit=TOKEN_SLICE):
            docs = part.column(0).to_pylist()
            loss = part.column(2).to_pylist()
            ids, offsets = with_end(*encoder.encode(full_text(part)), END_ID)
            for i, doc in enumerate(docs):
                own = ids[offsets[i]:offsets[i + 1]].copy()
                n = len(own)
                packer.add(Piece(doc, 0, own, n, 0 if loss[i] is None else max(n - loss[i], 0)))
            rows, number = _pieces(packer, number)
            yield rows
    packer.finish()
    yield _pieces(packer, number)[0]


def pack(docs: DataFrame, tokenizer: str, loss_tokens: str | None = None, **limits) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) packed into sequences, with their ids.

    ``loss_tokens`` names a column with the number of last tokens that bear
    loss; ``limits``: max_tokens, max_segments, max_loss, pool, cut."""
    prepare(docs.sparkSession)
    loss = F.col(loss_tokens).cast("long") if loss_tokens else F.lit(None).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), loss.alias("loss"))
    return rows.mapInArrow(lambda it: _pack(tokenizer, limits, it), PIECE_SCHEMA)
