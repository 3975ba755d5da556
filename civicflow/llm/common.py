"""Helpers shared by the operators: session set-up, staged tables, byte-level words.

Text is tokenised for hashing straight from Arrow's UTF-8 buffer: character
classes come from a 256-entry table and the hash of any byte range is a
difference of two prefix sums, so no Python string is made per word.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from civicflow.session import ensure_checkpoint_dir, shared_path

#: Rows of an Arrow batch; a batch is cut further at SLICE_BYTES of text.
BATCH_ROWS = 512
SLICE_BYTES = 1 << 20
NULL_ID = -(1 << 63)

U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1          # odd: invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the Python stages; the package's folder goes to the workers' path.

    On a cluster the package is shipped with ``--py-files``; the extra path
    entry serves local runs that were not started in the repository.
    """
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)
    return spark


@contextmanager
def arrow_bytes(spark: SparkSession, most: int):
    """Arrow batches of the jobs run inside hold at most about ``most`` bytes, however long the texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage at files that survive a lost executor."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstaged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch into parts of at most ``limit`` bytes of text (or one row)."""
    text = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, n in enumerate(size):
        if total and total + n > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(n)
    if first < batch.num_rows:
        yield batch.slice(first)


def full_text(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column as large strings; null is the empty text."""
    text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    return pc.fill_null(text, "")


def text_slices(texts: list[str]):
    """The texts as Arrow arrays of at most SLICE_BYTES (or one text)."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    for part in slices(batch):
        yield full_text(part)


def buffer_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them."""
    if len(text) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = text.buffers()
    offsets = np.frombuffer(off, np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        m = max(n, SLICE_BYTES + 1024)
        for key, base in (("p", _P), ("q", _P_INV)):
            steps = np.full(m, base, U64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=U64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


class ByteHash:
    """Hashes of byte ranges of one buffer by prefix sums modulo 2**64."""

    def __init__(self, raw: np.ndarray):
        p, self.inverse = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, U64)
        np.cumsum((raw.astype(U64) + U64(1)) * p[:-1], out=self.sums[1:])

    def range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _classes(punctuation: bool) -> np.ndarray:
    """0: separator, 1: word byte (ASCII letter or digit, any non-ASCII byte), 2: punctuation."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 128 or chr(b).isalnum():
            table[b] = 1
        elif punctuation and b > 32 and b != 127:
            table[b] = 2
    return table


WORDS = _classes(False)
TOKENS = _classes(True)


def tokens(text: pa.Array, classes: np.ndarray = WORDS):
    """Tokens of all texts: bytes, starts, ends (byte positions) and n + 1 token offsets.

    A token is a longest run of bytes of one class; it never crosses texts."""
    raw, offsets = buffer_of(text)
    if not len(raw):
        zero = np.zeros(0, np.int64)
        return raw, zero, zero, np.zeros(len(text) + 1, np.int64)
    kind = classes[raw]
    edge = np.empty(len(raw), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    edge[cuts] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(raw))
    real = kind[start] > 0
    start, end = start[real], end[real]
    return raw, start, end, np.searchsorted(start, offsets)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Row number of each element of a ragged array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingles(words: np.ndarray, offsets: np.ndarray, n: int):
    """Hashes of n consecutive words of each text; a shorter non-empty text is one shingle.

    Returns the hashes, the n + 1 offsets and the first word of each shingle."""
    count = np.diff(offsets)
    out = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    new = np.concatenate([[0], np.cumsum(out)])
    own = owners(new)
    first = offsets[:-1][own] + (np.arange(new[-1]) - new[:-1][own])
    left = np.minimum(offsets[1:][own] - first, n)
    h = np.full(len(first), U64(n), U64)
    for j in range(n):
        there = left > j
        at = np.where(there, first + j, 0)
        step = words[at] if len(words) else np.zeros(len(first), U64)
        h = np.where(there, mix(h * U64(_P) + step), h)
    return h, new, first


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 of all i, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


#: Pieces of an accumulated array and how many partial ones a task of a merge sums.
CHUNKS = 32
FAN_IN = 64
_PART_SCHEMA = "part long, chunk int, payload binary"


def _pack_array(values: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i8").tobytes())


def _unpack_array(payload: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), "<i8")


def accumulate(df: DataFrame, kernel, length: int) -> np.ndarray:
    """Sum over all rows of an integer array of fixed ``length``.

    ``kernel(batch, total)`` adds a batch's share to ``total`` (int64).  Each
    task sums its rows first; the tasks' arrays, cut in CHUNKS pieces, are
    merged FAN_IN at a time.  Only the total, ``length`` numbers, reaches the
    driver."""
    def partial(batches):
        from pyspark import TaskContext

        total = np.zeros(length, np.int64)
        for batch in batches:
            for piece in slices(batch):
                kernel(piece, total)
        part = TaskContext.get().partitionId()
        for c, values in enumerate(np.array_split(total, CHUNKS)):
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "chunk": pa.array([c], pa.int32()),
                "payload": pa.array([_pack_array(values)], pa.binary())})

    def merge(rows):
        import pandas as pd

        total = None
        for payload in rows["payload"]:
            values = _unpack_array(payload)
            total = values if total is None else total + values
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN_IN],
                             "chunk": [int(rows["chunk"].iloc[0])],
                             "payload": [_pack_array(total)]})

    parts, n = df.mapInArrow(partial, _PART_SCHEMA), df.rdd.getNumPartitions()
    while True:
        parts = parts.groupBy(expr_div("part", FAN_IN), "chunk").applyInPandas(merge, _PART_SCHEMA)
        n = -(-n // FAN_IN)
        if n <= 1:
            break
    found = {r["chunk"]: _unpack_array(r["payload"]) for r in parts.collect()}
    if not found:
        return np.zeros(length, np.int64)
    return np.concatenate([found[c] for c in range(CHUNKS)])


def expr_div(column: str, by: int):
    from pyspark.sql import functions as F
    return F.expr(f"{column} div {by}").alias("__group")
