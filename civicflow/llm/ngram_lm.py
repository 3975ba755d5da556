"""Operator 11: trigram language model in sharded Elias-Fano tries.

1. *Chunks.*  Texts (A-Z in lower case, words between white space, one end token each) become
   arrays of word numbers with the chunk's distinct 62-bit word hashes, staged compressed.
2. *Vocabulary.*  The words of each chunk go to hash buckets, one row per chunk and bucket.  A bucket's
   task sums the training counts of its words, ranks them by count, and answers each chunk with
   the counts and the ranks, from which word ids are made.  The number of buckets grows with the words
   of all chunks, so that a bucket stays small; a frequent word is one entry per chunk.
3. *Model.*  A chunk's distinct pairs and triples, with their training counts, go to the shard
   of their leading pair: no first word, however frequent, lies in one shard.  A
   shard's task merges them as they stream in and writes its trie (``elias_fano.Trie``) as a file
   below the shared folder.
4. *Scores.*  The distinct pairs and triples of the chunks to score stream to the tasks of their shards,
   which memory-map the trie (or read it, where the folder is no mounted one);
   answers go back to the chunk and are summed per document.

With counts c and numbers of distinct followers t, the probability of w after (u, v) is
``p3 = (c(uvw)-D)/c(uv) + D*t(uv)/c(uv) * p2`` (absolute discounting), ``p2 = (1-r)*c(vw)/c(v) + r*p1``
and ``p1 = (c(w)+1)/(N+V+1)``.  The weight r is that of v's class, words of like count: D times the distinct
pairs over all pairs of its words (one word's followers lie in many shards).  Pair
shares, triples' first terms and the weight that (u, v) leaves to p2 are stored in one byte each,
rounded down, so the probabilities after a context sum to one at most.

Memory of a task: a chunk (``CHUNK_BYTES`` of text, or one longer text) or a shard (``SHARD_TOKENS``
of training tokens on average).  A shard that got far more events than others is
scored in parts by several tasks; their list holds one entry for every ``PART_BYTES`` of events at
most.  What a leading pair gathers is bounded by the vocabulary.

Two words share an id only if their 62-bit hashes are equal (for a million words: with a
probability of 1e-7).  Edge cases: null is the empty text (its end token alone); a null ``doc_id``
is a training document; repeated rows are kept and each counts; without training tokens N and V are 0
and every token has probability 1; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import (ByteHash, NULL_ID, U64, full_text, mix, owners, prepare, ragged,
                                  slices, staged, tokens, unstaged)
from civicflow.llm.elias_fano import Trie
from civicflow.llm.runs import WORD_BYTES
from civicflow.session import shared_path

FOLDS, HELD_OUT = 7, 2
#: What absolute discounting takes from each count.
DISCOUNT = 0.75
CHUNK_BYTES = 4 << 20
SHARD_TOKENS = 3_000_000
#: Words, summed over the chunks, of a hash bucket, about; CHUNK_SHARE for each chunk at least, so
#: that words which all chunks have do not outweigh the rest.
BUCKET_WORDS = 1 << 20
CHUNK_SHARE = 4
#: Classes of like count: two for each doubling.
CLASSES = 128
#: Events of a shard that are scored by one task, in bytes.
PART_BYTES = 64 << 20
#: Pairs and triples that are gathered before they are merged.
MERGE_AT = 1 << 19

#: Hashes beyond 62 bits stand for the end token and for the start of a text.
END, START = 1 << 62, (1 << 62) + 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

CHUNK_SCHEMA = "chunk long, n_train long, n_words long, words binary, body binary"
WORD_SCHEMA = "bucket long, chunk long, payload binary"
COUNTED_SCHEMA = "chunk long, n_new long, payload binary"
EVENT_SCHEMA = "shard long, part int, chunk long, payload binary"
TRIE_SCHEMA = "shard long, bytes_in long, pairs array<long>, tokens array<long>"
SCORE_SCHEMA = ("doc_id long, train boolean, n_tokens long, n_known long, base_score double, "
                "score double")


# -- compact arrays -----------------------------------------------------------

def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Integer arrays, each in the narrowest type that holds it, byte planes apart, compressed."""
    import zstandard
    parts = [bytes([len(arrays)])]
    for values in arrays:
        top = int(values.max(initial=0))
        size = 8 if values.min(initial=0) < 0 else next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
        planes = values.astype(f"<i{size}" if size == 8 else f"<u{size}").view(np.uint8).reshape(-1, size).T
        parts += [bytes([size]), len(values).to_bytes(8, "little"), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack_arrays(payload: bytes) -> list[np.ndarray]:
    import zstandard
    data = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 1
    for _ in range(data[0]):
        size, n = data[at], int.from_bytes(data[at + 1:at + 9], "little")
        planes = np.frombuffer(data, np.uint8, n * size, at + 9).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view("<i8" if size == 8 else f"<u{size}")
                   .ravel().astype(np.int64))
        at += 9 + n * size
    return out


# -- chunks -------------------------------------------------------------------

def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end token after each text's, and the n + 1 offsets."""
    raw, start, end, offsets = tokens(text, WORD_BYTES)
    if len(raw):
        words = (ByteHash(_LOWER[raw]).range(start, end) >> U64(2)).astype(np.int64)
    else:
        words = np.zeros(0, np.int64)
    return np.insert(words, offsets[1:], END), offsets + np.arange(len(offsets))


def _chunked(batches: Iterator[pa.RecordBatch]):
    task, seq = TaskContext.get().partitionId(), 0
    held, size = [], 0

    def row():
        docs, train, counts, words = (np.concatenate(x) for x in zip(*held))
        known, number, often = np.unique(words, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, whose bytes compress.
        order = np.argsort(-often, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        known, number = known[order], place[number]
        learned = np.bincount(number, np.repeat(train, counts), len(known)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + seq], pa.int64()), pa.array([int(learned.sum())], pa.int64()),
             pa.array([len(known)], pa.int64()),
             pa.array([pack_arrays(known, learned, train.sum(keepdims=True))], pa.binary()),
             pa.array([pack_arrays(docs, train, counts, number)], pa.binary())],
            ["chunk", "n_train", "n_words", "words", "body"])

    for batch in batches:
        for part in slices(batch):
            text = full_text(part)
            words, offsets = word_hashes(text)
            held.append((part.column(0).to_numpy(zero_copy_only=False),
                         part.column(1).to_numpy(zero_copy_only=False).astype(np.int64),
                         np.diff(offsets), words))
            size += part.nbytes
            if size >= CHUNK_BYTES:
                yield row()
                held, size, seq = [], 0, seq + 1
    if held:
        yield row()


def chunks_of(docs: DataFrame, train: Column) -> DataFrame:
    """Chunks of ``docs`` (doc_id, text); ``train`` marks the rows that the model learns from."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce(train, F.lit(False)).alias("train"),
                       F.col("text").cast("string").alias("text"))
    return staged(rows.mapInArrow(_chunked, CHUNK_SCHEMA), "lm_chunks")


# -- vocabulary ---------------------------------------------------------------

def _word_counts(buckets: int, batches: Iterator[pa.RecordBatch]):
    """For each chunk and bucket the words' hashes (sorted) and training counts; START counts texts."""
    for batch in batches:
        for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            known, learned, texts = unpack_arrays(payload)
            h, n = np.append(known, START), np.append(learned, texts)
            for bucket, at in _in_buckets(h, buckets):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int64()), pa.array([chunk], pa.int64()),
                     pa.array([pack_arrays(_gaps(h[at]), n[at])], pa.binary())], ["bucket", "chunk", "payload"])


def _in_buckets(h: np.ndarray, buckets: int):
    """Bucket and places of its hashes, rising."""
    bucket = h % buckets
    order = np.lexsort((h, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for at in np.split(order, cuts) if len(h) else ():
        yield int(bucket[at[0]]), at


def _gaps(values: np.ndarray) -> np.ndarray:
    """Differences of a rising array."""
    return np.diff(values, prepend=0)


def _ranked(buckets: int, batches: Iterator[pa.RecordBatch]):
    """Answers of each bucket: the words' ids (from 1; 0: not learned) and counts, in the order of the question."""
    bucket, held = None, []

    def rows():
        words = [unpack_arrays(p) for _, p in held]
        every, of = np.unique(np.concatenate([np.cumsum(g) for g, _ in words]), return_inverse=True)
        count = np.bincount(of, np.concatenate([n for _, n in words]), len(every)).astype(np.int64)
        order = np.lexsort((every, -count))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        ids = np.where(count > 0, rank * buckets + bucket + 1, 0)
        # How many words the vocabulary gets from here goes with the first answer.
        new, at = int(((count > 0) & (every != START)).sum()), 0
        for (chunk, _), (gaps, _) in zip(held, words):
            own = of[at:at + len(gaps)]
            at += len(gaps)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int64()), pa.array([new], pa.int64()),
                 pa.array([pack_arrays(ids[own], count[own])], pa.binary())],
                ["chunk", "bucket", "n_new", "payload"])
            new = 0

    for batch in batches:
        for b, chunk, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if b != bucket and held:
                yield from rows()
                held = []
            bucket = b
            held.append((chunk, payload))
    if held:
        yield from rows()


class Model:
    """A trained model: totals, the folder of the tries and the weights of the count classes."""

    def __init__(self, tokens: int, words: int, shards: int, folder: str):
        self.tokens, self.words, self.shards, self.folder = tokens, words, shards, folder
        self.weights = np.ones(CLASSES)
        self.parts: dict[int, int] = {}


def _class_of(n: np.ndarray) -> np.ndarray:
    """Class of a count: two for each doubling."""
    return (2 * np.log2(np.maximum(n, 1))).astype(np.int64)


def _ordered(buckets: int, batches: Iterator[pa.RecordBatch]):
    """Bodies of the chunks with, in place of the hashes, the places of the words in bucket order."""
    for batch in batches:
        for chunk, words, body in zip(*(c.to_pylist() for c in batch.columns)):
            h = np.append(unpack_arrays(words)[0], START)
            order = np.concatenate([at for _, at in _in_buckets(h, buckets)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([body], pa.binary()),
                 pa.array([pack_arrays(order)], pa.binary())], ["chunk", "payload", "places"])


def _counted_chunks(batches: Iterator[pa.RecordBatch]):
    """Chunks with the ids and counts of their words; a chunk comes before the answers of its buckets."""
    chunk, texts, order, at, ids, n, new = None, None, None, 0, None, None, 0

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([new], pa.int64()),
             pa.array([pack_arrays(*texts, ids, n)], pa.binary())], ["chunk", "n_new", "payload"])

    for batch in batches:
        for key, bucket, more, payload, places in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket is None:
                if chunk is not None:
                    yield row()
                (order,), at = unpack_arrays(places), 0
                chunk, texts, new = key, unpack_arrays(payload), 0
                ids, n = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            else:
                # Buckets come in order, and so do the places of their words.
                found = unpack_arrays(payload)
                own = order[at:at + len(found[0])]
                ids[own], n[own] = found
                at, new = at + len(own), new + more
    if chunk is not None:
        yield row()


def _with_ids(chunks: DataFrame) -> DataFrame:
    """The chunks with their words' ids and training counts."""
    size = chunks.agg(F.sum("n_words").alias("words"), F.count("*").alias("chunks")).first()
    buckets = max(1, -(-(size["words"] or 0) // max(BUCKET_WORDS, CHUNK_SHARE * size["chunks"])))
    words = chunks.select("chunk", "words").mapInArrow(lambda it: _word_counts(buckets, it), WORD_SCHEMA)
    answers = _streamed(words, "bucket", "chunk").mapInArrow(
        lambda it: _ranked(buckets, it), "chunk long, bucket long, n_new long, payload binary")
    # Null buckets sort first: the chunk, then the answers.
    none = F.lit(None).cast("long")
    bodies = chunks.select("chunk", "words", "body").mapInArrow(
        lambda it: _ordered(buckets, it), "chunk long, payload binary, places binary")
    rows = bodies.select("chunk", none.alias("bucket"), none.alias("n_new"), "payload", "places").unionByName(
        answers.withColumn("places", F.lit(None).cast("binary")))
    return staged(_streamed(rows, "chunk", "bucket").mapInArrow(_counted_chunks, COUNTED_SCHEMA), "lm_counted")


# -- pairs and triples of a chunk ------------------------------------------------

class Grams:
    """Distinct pairs (a, b) and triples (pair number, c) of a chunk, and where its tokens use them."""

    def __init__(self, payload: bytes):
        self.docs, self.train, self.counts, number, ids, n = unpack_arrays(payload)
        self.word_id, self.word_n = ids[:-1] - 1, n[:-1]
        start_id, start_n = int(ids[-1]) - 1, int(n[-1])
        offsets = np.concatenate([[0], np.cumsum(self.counts)])
        first = offsets[:-1]
        self.number = number
        token = self.word_id[number]
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[first] = start_id
        # Counts of the word before, as context.
        self.before_n = np.empty_like(token)
        self.before_n[1:] = self.word_n[number[:-1]]
        self.before_n[first] = start_n
        pair = np.flatnonzero((token >= 0) & (before >= 0))
        top = int(max(token.max(initial=0), start_id)) + 1
        key, used = np.unique(before[pair] * top + token[pair], return_inverse=True)
        self.pair_of = np.full(len(token), -1, np.int64)
        self.pair_of[pair] = used
        self.a, self.b = key // top, key % top
        # The pair that ends before a token; none before a text's first token.
        lead = np.full(len(token), -1, np.int64)
        lead[1:] = self.pair_of[:-1]
        lead[first] = -1
        self.lead = lead
        triple = np.flatnonzero((token >= 0) & (lead >= 0))
        key, used = np.unique(lead[triple] * top + token[triple], return_inverse=True)
        self.triple_of = np.full(len(token), -1, np.int64)
        self.triple_of[triple] = used
        self.parent, self.c = key // top, key % top
        self.learned = np.repeat(self.train, self.counts)

    def pair_counts(self) -> np.ndarray:
        own = self.pair_of >= 0
        return np.bincount(self.pair_of[own], self.learned[own], len(self.a)).astype(np.int64)

    def triple_counts(self) -> np.ndarray:
        own = self.triple_of >= 0
        return np.bincount(self.triple_of[own], self.learned[own], len(self.c)).astype(np.int64)

    def first_counts(self) -> np.ndarray:
        """Count of each pair's first word."""
        out = np.zeros(len(self.a), np.int64)
        own = self.pair_of >= 0
        out[self.pair_of[own]] = self.before_n[own]
        return out

    def by_shard(self, shards: int, pair_keep: np.ndarray, triple_keep: np.ndarray):
        """For each shard: numbers of its pairs and of its triples, in order."""
        # Small numbers sort by radix.
        kind = np.uint16 if shards < 1 << 16 else np.int64
        shard = np.where(pair_keep, shard_of(self.a, self.b, shards), shards).astype(kind)
        pairs = np.argsort(shard, kind="stable")
        own = np.where(triple_keep, shard[self.parent] if len(self.parent) else 0, shards).astype(kind)
        triples = np.argsort(own, kind="stable")
        every = np.unique(shard)
        every = every[every < shards]
        pair_cuts = np.searchsorted(shard[pairs], np.append(every, shards).astype(kind))
        triple_cuts = np.searchsorted(own[triples], np.append(every, shards).astype(kind))
        for i, s in enumerate(every.tolist()):
            yield (s, pairs[pair_cuts[i]:pair_cuts[i + 1]],
                   triples[triple_cuts[i]:triple_cuts[i + 1]])


def shard_of(a: np.ndarray, b: np.ndarray, shards: int) -> np.ndarray:
    h = mix(mix(a.astype(U64) + U64(1)) ^ (b.astype(U64) * U64(0x9E3779B97F4A7C15)))
    return (h % U64(shards)).astype(np.int64)


def _grams(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield chunk, Grams(payload.as_py())


def _events(shards: int, learn: bool, parts, batches: Iterator[pa.RecordBatch]):
    """One row per chunk and shard: the ids, the pairs and triples in terms of them, and, to learn, counts."""
    parts = parts.value if parts is not None else {}
    for chunk, g in _grams(batches):
        if learn:
            pair_n, triple_n, first_n = g.pair_counts(), g.triple_counts(), g.first_counts()
            keep = (pair_n > 0, triple_n > 0)
        else:
            keep = np.ones(len(g.a), bool), np.ones(len(g.c), bool)
        for shard, p, t in g.by_shard(shards, *keep):
            a, b, c = g.a[p], g.b[p], g.c[t]
            ids = np.unique(np.concatenate([a, b, c]))
            children = np.bincount(np.searchsorted(p, g.parent[t]), minlength=len(p))
            arrays = [_gaps(ids), _gaps(np.searchsorted(ids, a)), np.searchsorted(ids, b),
                      children, np.searchsorted(ids, c)]
            if learn:
                head = np.append(True, a[1:] != a[:-1])
                arrays += [first_n[p][head], pair_n[p], triple_n[t]]
            k = parts.get(shard, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([int(mix(np.array([chunk], U64))[0] % U64(k))], pa.int32()),
                 pa.array([chunk], pa.int64()), pa.array([pack_arrays(*arrays)], pa.binary())],
                ["shard", "part", "chunk", "payload"])


# -- the tries ------------------------------------------------------------------

class Merger:
    """Sums the events of one shard; merges whenever MERGE_AT new pairs and triples have come."""

    def __init__(self):
        self.held, self.waiting, self.bytes_in = [], 0, 0

    def add(self, payload: bytes) -> None:
        gaps, a, b, children, c, first_n, pair_n, triple_n = unpack_arrays(payload)
        ids, a = np.cumsum(gaps), np.cumsum(a)
        head = np.append(True, a[1:] != a[:-1])
        self.held.append((ids[a], ids[b], first_n[np.cumsum(head) - 1], pair_n,
                          np.repeat(np.arange(len(a)), children), ids[c], triple_n))
        self.waiting += len(a) + len(c)
        self.bytes_in += len(payload)
        if self.waiting >= MERGE_AT:
            self.merge()

    def merge(self) -> None:
        if len(self.held) > 1:
            shift = np.concatenate([[0], np.cumsum([len(x[0]) for x in self.held])])
            a, b, first_n, pair_n, c, triple_n = (
                np.concatenate([x[i] for x in self.held]) for i in (0, 1, 2, 3, 5, 6))
            parent = np.concatenate([x[4] + s for x, s in zip(self.held, shift)])
            top = int(max(b.max(), c.max(initial=0))) + 1
            key, at, own = np.unique(a * top + b, return_index=True, return_inverse=True)
            triple, used = np.unique(own[parent] * top + c, return_inverse=True)
            self.held = [(key // top, key % top, first_n[at],
                          np.bincount(own, pair_n, len(key)).astype(np.int64), triple // top, triple % top,
                          np.bincount(used, triple_n, len(triple)).astype(np.int64))]
        # Merging costs what is there, so it waits until as much again has come.
        self.waiting = -sum(len(x[0]) + len(x[5]) for x in self.held)

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and all pairs whose first word is of each class."""
        _, _, first_n, pair_n, *_ = self.held[0]
        kind = _class_of(first_n)
        return (np.bincount(kind, minlength=CLASSES),
                np.bincount(kind, pair_n, minlength=CLASSES).astype(np.int64))

    def trie(self) -> bytes:
        a, b, first_n, pair_n, parent, c, triple_n = self.held[0]
        # As a context a pair counts as often as something follows it: a text's end has no follower.
        context = np.bincount(parent, triple_n, len(a))
        followers = np.bincount(parent, minlength=len(a))
        rest = np.where(followers > 0, DISCOUNT * followers / np.maximum(context, 1), 1.0)
        return Trie.build(a, b, pair_n / first_n, rest, parent, c,
                          (triple_n - DISCOUNT) / context[parent])


def _files(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system of a folder and its path there."""
    return pa.fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _write(folder: str, shard: int, data: bytes) -> None:
    """The shard's file, whole or not at all; a second attempt writes the same bytes."""
    files, path = _files(folder)
    with files.open_output_stream(f"{path}/{shard}.{TaskContext.get().taskAttemptId()}.part") as out:
        out.write(data)
    files.move(f"{path}/{shard}.{TaskContext.get().taskAttemptId()}.part", f"{path}/{shard}.trie")


def _open(folder: str, shard: int) -> Trie | None:
    """The shard's trie, memory-mapped from a mounted folder, else read; None if nothing was learned for it."""
    files, path = _files(folder)
    path = f"{path}/{shard}.trie"
    if files.get_file_info(path).type == pa.fs.FileType.NotFound:
        return None
    if isinstance(files, pa.fs.LocalFileSystem):
        return Trie.open(path)
    with files.open_input_file(path) as f:
        return Trie(f.read())


def _built(folder: str, batches: Iterator[pa.RecordBatch]):
    shard, merger = None, None

    def row():
        merger.merge()
        _write(folder, shard, merger.trie())
        pairs, tokens_ = merger.classes()
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([merger.bytes_in], pa.int64()),
             pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([tokens_.tolist()], pa.list_(pa.int64()))],
            ["shard", "bytes_in", "pairs", "tokens"])

    for batch in batches:
        for i in range(batch.num_rows):
            s = batch.column(0)[i].as_py()
            if s != shard:
                if merger:
                    yield row()
                shard, merger = s, Merger()
            merger.add(batch.column(1)[i].as_py())
    if merger:
        yield row()


def _streamed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the first key columns, in order of all: a group streams through one task."""
    return rows.repartition(*keys[:-1]).sortWithinPartitions(*keys)


def train(chunks: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the chunks' training rows, and the chunks with their words' ids and counts."""
    spark = chunks.sparkSession
    counted = _with_ids(chunks)
    tokens_ = int(chunks.agg(F.sum("n_train")).first()[0] or 0)
    words = int(counted.agg(F.sum("n_new")).first()[0] or 0)
    shards, folder = max(1, -(-tokens_ // SHARD_TOKENS)), shared_path(spark, "llm", "lm_tries", unique=True)
    files, path = _files(folder)
    files.create_dir(path)
    model = Model(tokens_, words, shards, folder)
    events = counted.select("chunk", "payload").mapInArrow(
        lambda it: _events(shards, True, None, it), EVENT_SCHEMA)
    built = staged(_streamed(events.select("shard", "payload", "chunk"), "shard", "chunk")
                   .select("shard", "payload").mapInArrow(lambda it: _built(folder, it), TRIE_SCHEMA), "lm_built")
    # One entry for every PART_BYTES of events at most.
    model.parts = {r["shard"]: -(-r["bytes_in"] // PART_BYTES) for r in built.where(
        F.col("bytes_in") > PART_BYTES).select("shard", "bytes_in").collect()}
    for r in (built.select(F.posexplode(F.arrays_zip("pairs", "tokens")).alias("class", "x"))
              .groupBy("class").agg(F.sum("x.pairs").alias("p"), F.sum("x.tokens").alias("t")).collect()):
        if r["t"]:
            model.weights[r["class"]] = DISCOUNT * r["p"] / r["t"]
    return model, counted


# -- scores -----------------------------------------------------------------------

def _answered(folder: str, batches: Iterator[pa.RecordBatch]):
    """Codes and tables of the values of each event's pairs and triples."""
    shard, trie, held, size = None, None, [], 0

    def rows():
        # The events of several chunks are sought at once; their numbers are shifted, so they stay apart.
        ids, a, b, parent, c = [], [], [], [], []
        words = pairs = 0
        for _, (gaps, own_a, own_b, children, own_c) in held:
            ids.append(np.cumsum(gaps))
            a.append(np.cumsum(own_a) + words)
            b.append(own_b + words)
            parent.append(np.repeat(np.arange(len(own_a)) + pairs, children))
            c.append(own_c + words)
            words, pairs = words + len(gaps), pairs + len(own_a)
        found = trie.lookup(*(np.concatenate(x) for x in (ids, a, b, parent, c)))
        tables = [np.ascontiguousarray(table).view("<u4") for _, table in trie.codes]
        p = t = 0
        for chunk, (_, own_a, _, _, own_c) in held:
            own = (found[0][p:p + len(own_a)], found[1][p:p + len(own_a)], found[2][t:t + len(own_c)])
            p, t = p + len(own_a), t + len(own_c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([shard], pa.int64()),
                 pa.array([pack_arrays(*own, *tables)], pa.binary())], ["chunk", "shard", "payload"])

    for batch in batches:
        for s, chunk, payload in zip(*(col.to_pylist() for col in batch.columns)):
            if s != shard or size > MERGE_AT:
                if held and trie is not None:
                    yield from rows()
                held, size = [], 0
            if s != shard:
                shard, trie = s, _open(folder, s)
            held.append((chunk, unpack_arrays(payload)))
            size += len(held[-1][1][2]) + len(held[-1][1][4])
    if held and trie is not None:
        yield from rows()


def _token_scores(g: Grams, weights, pair_p, rest, triple_p, n_tokens: int, n_words: int):
    """Per document: known tokens, log10 of the base and of the model's probability."""
    c = g.word_n[g.number]
    total = float(n_tokens + n_words + 1)
    p = (c + 1) / total
    base = np.log10(p)
    # After an unknown word the shorter context decides alone.
    left = np.where(g.before_n > 0, weights[_class_of(g.before_n)], 1.0)
    p2 = left * p
    seen = g.pair_of >= 0
    p2[seen] += (1 - left[seen]) * pair_p[g.pair_of[seen]]
    p3 = p2.copy()
    led = g.lead >= 0
    p3[led] *= rest[g.lead[led]]
    seen = g.triple_of >= 0
    p3[seen] += triple_p[g.triple_of[seen]]
    own = owners(np.concatenate([[0], np.cumsum(g.counts)]))
    add = lambda x: np.bincount(own, x, minlength=len(g.counts))        # noqa: E731
    return add(c > 0).astype(np.int64), add(base), add(np.log10(p3))


def _values(code: np.ndarray, table: np.ndarray, missing: float) -> np.ndarray:
    """Values of codes + 1; 0 stands for an unseen pair or triple."""
    return np.append(missing, table.astype("<u4").view("<f4").astype(np.float64))[code]


def _scored(shards: int, weights: np.ndarray, n_tokens: int, n_words: int, batches: Iterator[pa.RecordBatch]):
    """Scores of the documents; a chunk comes before the answers of its shards."""
    g, places, values = None, {}, None

    def done():
        known, base, score = _token_scores(g, weights, *values, n_tokens, n_words)
        return pa.RecordBatch.from_arrays(
            [pa.array(g.docs), pa.array(g.train.astype(bool)), pa.array(g.counts), pa.array(known),
             pa.array(base), pa.array(score)],
            ["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for i in range(batch.num_rows):
            shard, payload = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
            if shard is None:
                if g is not None:
                    yield done()
                g = Grams(payload)
                values = (np.zeros(len(g.a)), np.ones(len(g.a)), np.zeros(len(g.c)))
                places = {s: (p, t) for s, p, t in g.by_shard(
                    shards, np.ones(len(g.a), bool), np.ones(len(g.c), bool))}
                continue
            pairs, triples = places[shard]
            found = unpack_arrays(payload)
            for out, at, code, table, missing in zip(values, (pairs, pairs, triples), found[:3], found[3:], (0, 1, 0)):
                out[at] = _values(code, table, missing)
    if g is not None:
        yield done()


def score(model: Model, counted: DataFrame) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score of every document of the chunks."""
    shards, n, v, folder, weights = model.shards, model.tokens, model.words, model.folder, model.weights
    parts = counted.sparkSession.sparkContext.broadcast(model.parts)
    chunks = counted.select("chunk", "payload")
    events = chunks.mapInArrow(lambda it: _events(shards, False, parts, it), EVENT_SCHEMA)
    answers = (_streamed(events.select("shard", "part", "chunk", "payload"), "shard", "part", "chunk")
               .select("shard", "chunk", "payload")
               .mapInArrow(lambda it: _answered(folder, it), "chunk long, shard long, payload binary"))
    # Null shards sort first: the chunk, then the answers of its shards.
    rows = chunks.select("chunk", F.lit(None).cast("long").alias("shard"), "payload").unionByName(answers)
    return _streamed(rows, "chunk", "shard").mapInArrow(
        lambda it: _scored(shards, weights, n, v, it), SCORE_SCHEMA)


def language_model_scores(docs: DataFrame, train_rows: Column) -> DataFrame:
    """Trains on the rows that ``train_rows`` marks and scores all of ``docs`` (doc_id, text)."""
    chunks = chunks_of(docs, train_rows)
    model, counted = train(chunks)
    # The counted chunks hold all that scoring needs.
    unstaged(chunks)
    return score(model, counted).select(
        F.nullif(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id"), (~F.col("train")).alias("held_out"),
        "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")
