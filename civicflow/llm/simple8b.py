"""Operator 1: token-id files in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector in its high bits and 60 bits of payload;
the selector says how many ids of how many bits the word packs.  Selector 15
is an escape: the id (up to 64 bits) follows raw in the next word.  Ids are
coded in blocks of ``BLOCK`` ids; a frame stores the word offset of each
block, so blocks can be decoded on their own and all words of one selector
are unpacked by one vectorised shift.

File format: a Parquet table, one row per frame (Spark's committed, splittable
container).  Columns: ``first_doc`` (smallest id of the part), ``part``,
``frame``, ``start`` (ids of the part before the frame), ``n_ids`` and
``payload``, the frame itself::

    "S8B1" | u32 n_docs | u32 block | u64 n_ids | u32 n_blocks |
    i64 doc_ids[n_docs] | u32 n_tokens[n_docs] | u32 block_words[n_blocks + 1] | u64 words[]

Edge cases: a null or empty text has only the end id; a null ``doc_id`` sorts
first and comes back null; repeated rows are kept, in order of their ids; an empty
table gives no frame and no row; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm.common import NULL_ID, full_text, prepare, slices
from civicflow.llm.tokenize import TOKEN_SLICE, Encoder, with_end
from civicflow.session import shared_path

BLOCK = 1024
END_ID = 1
#: Selector -> (ids in a word, bits of each); the fixed Simple-8b table for 60 payload bits.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
         (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
_LIMITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
#: Ids of a frame, about.
FRAME_IDS = 1 << 18
#: Bytes of a Parquet row group: what a reader holds of the payload column at once.
ROW_GROUP = 16 << 20
MAGIC = b"S8B1"

FRAME_SCHEMA = ("first_doc long, part int, frame int, start long, n_ids long, payload binary")
DOC_SCHEMA = ("first_doc long, part int, doc_id long, part_start long, n_tokens long, "
              "ids_crc32 long")


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words and the word offsets of the blocks.

    Greedy: at each place the selector that packs most ids, or all ids left
    in the block (unused places of its last word are zero).  Which selectors fit
    is known for all places at once; only the walk from word to word is a loop."""
    values = np.asarray(ids, np.uint64)
    n = len(values)
    # Bits of each id, so that a selector's test is on bytes.
    length = np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    end = np.minimum((np.arange(n, dtype=np.int64) // block + 1) * block, n)
    choice = np.full(n, ESCAPE, np.uint8)
    following = np.arange(1, n + 1, dtype=np.int64)
    open_ = np.arange(n, dtype=np.int64)
    # From the widest: where a selector doesn't fit, no narrower one does.
    for s in range(len(PACKS) - 1, -1, -1):
        count, bits = PACKS[s]
        wide = np.zeros(n + 1, np.int32)
        np.cumsum(length > bits, dtype=np.int32, out=wide[1:])
        last = np.minimum(open_ + count, end[open_])
        fits = wide[last] == wide[open_]
        open_, last = open_[fits], last[fits]
        choice[open_], following[open_] = s, last
        if not len(open_):
            break
    starts, at, jump = [], 0, following.tolist()
    while at < n:
        starts.append(at)
        at = jump[at]
    start = np.array(starts, np.int64)
    sel = choice[start]
    place = np.arange(len(start)) + np.concatenate([[0], np.cumsum(sel[:-1] == ESCAPE)])
    words = np.zeros(int(place[-1]) + 1 + int(sel[-1] == ESCAPE), np.uint64)
    words[place] = sel.astype(np.uint64) << np.uint64(60)
    words[place[sel == ESCAPE] + 1] = values[start[sel == ESCAPE]]
    for s, (count, bits) in enumerate(PACKS):
        rows = np.flatnonzero(sel == s)
        if not len(rows):
            continue
        size = following[start[rows]] - start[rows]
        for j in range(int(size.max())):
            r = rows[size > j]
            words[place[r]] |= values[start[r] + j] << np.uint64(j * bits)
    first = np.searchsorted(start, np.arange(0, n, block))
    return words, np.append(place[first], len(words)).astype(np.uint32)


def decode_blocks(words: np.ndarray, offsets: np.ndarray, n_ids: int,
                  block: int = BLOCK) -> np.ndarray:
    """The ids of all blocks; one vectorised unpacking per selector."""
    words = np.asarray(words, np.uint64)
    if not n_ids:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (sel == ESCAPE).any():
        # A raw word after an escape may itself look like one: walk the escapes in order.
        skip = -1
        for i in np.flatnonzero(sel == ESCAPE).tolist():
            if i != skip:
                skip = i + 1
                raw[skip] = True
        sel = np.where(raw, -1, sel)
    count = np.array([c for c, _ in PACKS] + [0, 0], np.int64)
    size = np.where(raw, 1, count[np.maximum(sel, 0)])
    # Cut what the last word of each block holds beyond the block's ids.
    block_ids = np.full(len(offsets) - 1, block, np.int64)
    block_ids[-1] = n_ids - block * (len(offsets) - 2)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets.astype(np.int64)))
    ends = np.cumsum(size)
    base = np.concatenate([[0], ends])[offsets[:-1].astype(np.int64)]
    before = ends - size - base[owner]
    size = np.minimum(size, block_ids[owner] - before)
    where = owner * block + before
    out = np.zeros(n_ids, np.uint64)
    out[where[raw]] = words[raw]
    for s, (c, bits) in enumerate(PACKS):
        rows = np.flatnonzero(sel == s)
        mask = np.uint64((1 << bits) - 1)
        for j in range(c):
            r = rows[size[rows] > j]
            if not len(r):
                break
            out[where[r] + j] = words[r] >> np.uint64(j * bits) & mask
    return out


def pack_frame(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray,
               block: int = BLOCK) -> bytes:
    words, offsets = encode_blocks(ids, block)
    return b"".join((
        MAGIC, struct.pack("<IIQI", len(doc_ids), block, len(ids), len(offsets) - 1),
        doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes(),
        offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def unpack_frame(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of a frame."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b frame")
    n_docs, block, n_ids, n_blocks = struct.unpack_from("<IIQI", payload, 4)
    at = 24
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    lengths = np.frombuffer(payload, "<u4", n_docs, at := at + 8 * n_docs)
    offsets = np.frombuffer(payload, "<u4", n_blocks + 1, at := at + 4 * n_docs)
    words = np.frombuffer(payload[at + 4 * (n_blocks + 1):], "<u8")
    return doc_ids, lengths, decode_blocks(words, offsets, n_ids, block)


def _bins(doc: np.ndarray, ids: np.ndarray, offsets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Range of each document: the first bound not below its id.  An id that fills several ranges
    (equal bounds) is dealt out over them by a checksum of its ids."""
    first = np.searchsorted(bounds, doc)
    many = np.searchsorted(bounds, doc, side="right") - first
    for i in np.flatnonzero(many > 1).tolist():
        first[i] += zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) % int(many[i])
    return first


def _tokenised(tokenizer: str, end_id: int, bounds: np.ndarray, batches: Iterator[pa.RecordBatch]):
    """The ids of each document, in two bytes each where all of the slice fit, with its range."""
    encoder = Encoder.get(tokenizer, "word")
    for batch in batches:
        for piece in slices(batch, limit=TOKEN_SLICE):
            doc = piece.column(0).to_numpy(zero_copy_only=False)
            ids, offsets = with_end(*encoder.encode(full_text(piece)), end_id)
            width = 2 if ids.max(initial=0) < 1 << 16 else 4
            column = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), piece.num_rows,
                [None, pa.py_buffer(offsets.astype(np.int64) * width), pa.py_buffer(ids.astype(f"<u{width}"))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_bins(doc, ids, offsets, bounds).astype(np.int32)), piece.column(0),
                 pa.array(np.full(piece.num_rows, width, np.int32)), column.cast(pa.binary())],
                ["part", "doc_id", "width", "ids"])


def _frames(batches: Iterator[pa.RecordBatch]):
    """Frames of about FRAME_IDS ids (or one document) from documents in order; a range is a part."""
    part, frame, start, first = None, 0, 0, None
    docs, held, size = [], [], 0

    def row():
        ids = np.concatenate(held)
        payload = pack_frame(np.array(docs, np.int64), np.array([len(x) for x in held], np.int64), ids)
        return pa.RecordBatch.from_pydict({
            "first_doc": pa.array([first], pa.int64()), "part": pa.array([part], pa.int32()),
            "frame": pa.array([frame], pa.int32()), "start": pa.array([start], pa.int64()),
            "n_ids": pa.array([len(ids)], pa.int64()), "payload": pa.array([payload], pa.binary())})

    for batch in batches:
        for p, doc, width, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            ids = np.frombuffer(data.as_buffer(), f"<u{width}")
            if held and (p != part or size + len(ids) > FRAME_IDS):
                yield row()
                frame, start = frame + 1, start + size
                docs, held, size = [], [], 0
            if p != part:
                part, frame, start, first = p, 0, 0, doc
            docs.append(doc)
            held.append(ids)
            size += len(ids)
    if held:
        yield row()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> str:
    """Encode ``docs`` (doc_id, text) and write the frames to ``path`` in doc_id order.

    Approximate quantiles of the ids bound the ranges (one scan of the ids alone; as many as
    there are shuffle partitions).  The texts are tokenised where they are scanned,
    and only ids are shuffled, once, to their range and packed there in order."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else None
    bounds = np.array(found or [], np.int64)
    coded = rows.mapInArrow(lambda it: _tokenised(tokenizer, end_id, bounds, it),
                            "part int, doc_id long, width int, ids binary")
    (coded.repartition("part").sortWithinPartitions("part", "doc_id", "ids")
          .mapInArrow(_frames, FRAME_SCHEMA)
          .write.option("parquet.block.size", ROW_GROUP).parquet(path))
    return path


def _documents(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for r in batch.to_pylist():
            doc, size, ids = unpack_frame(r["payload"])
            data = ids.astype("<u4").tobytes()
            ends = np.cumsum(size, dtype=np.int64)
            starts = ends - size
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(doc)
            yield pa.RecordBatch.from_pydict({
                "first_doc": pa.array([r["first_doc"]] * n, pa.int64()),
                "part": pa.array([r["part"]] * n, pa.int32()),
                "doc_id": pa.array(doc, pa.int64()),
                "part_start": pa.array(starts + r["start"], pa.int64()),
                "n_tokens": pa.array(size.astype(np.int64), pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the ids of all earlier parts: one row per part file meets
    in that prefix sum."""
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    parts = frames.groupBy("first_doc", "part").agg(
        F.max(F.col("start") + F.col("n_ids")).alias("n"))
    base = parts.selectExpr(
        "first_doc", "part",
        "coalesce(sum(n) OVER (ORDER BY first_doc, part ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS base")
    docs = frames.mapInArrow(_documents, DOC_SCHEMA)
    return docs.join(base, ["first_doc", "part"]).select(
        F.nullif(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id"),
        (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token files (below the shared folder unless ``path`` is given), read back."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or shared_path(spark, "llm", "token_files", unique=True)
    return read_token_files(spark, write_token_files(docs, path, tokenizer))
