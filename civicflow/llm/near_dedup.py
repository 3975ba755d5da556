"""Operator 8: near-duplicates by consistent weighted sampling over TF-IDF shingles.

1. A document's features are its shingles of ``SHINGLE`` words (lower case) with
   weight tf * idf.  Document frequencies of all texts are counted in ``BUCKETS``
   hashed counters, so the idf table is of fixed size at any corpus size; a
   shingle has one weight everywhere.
2. Improved consistent weighted sampling (Ioffe) draws ``BANDS * ROWS`` samples
   per document: two documents share a sample with the probability of their
   weighted Jaccard similarity.  ``ROWS`` samples form a band.
3. Equal texts are one node.  Nodes that share a band are candidates and are
   compared by the exact weighted Jaccard similarity; pairs from
   ``SIMILARITY`` up are links, and links join components.
4. Band mates are compared in rounds.  In each band, some nodes that
   are not in the band's largest component so far (one node in the first
   round, ``PIVOTS`` in the next, then twice as many each) are compared with all mates of
   other components; then they leave the band.  A band is done when its nodes
   are of one component.  So every pair of mates is compared unless it is
   known to be of one component or known to be less similar: classes
   lose no link, and a group of near copies, which one pivot joins, is never paired off.
5. A band of more than ``CROWD`` nodes that the first pivot did not join (many texts just below the
   similarity) goes over to an exact prefix filter.  With features in one order for all, rarest
   first, two nodes of weights W can only reach similarity t if their least common
   feature has at least ``t / (1 + t) * (W + W')`` of either node's weight at and after it.  So
   rows (feature, node) of the rarest ``1 - t`` of each node's weight take the place of the
   bands, pairs that fail the bound are not formed, and the same rounds find all links among these nodes.
   Features of one document only, nearly all of an edited copy's rarest, are common to no pair and give no row.
6. Links and copies give connected components by alternating large and small stars.

Every table between the steps is written below the shared checkpoint folder.
The pivot rows of a hot band and the edges of a hot node are plain equi-joins,
which Spark splits by skew.

Edge cases: null is the empty text; texts without words link only with equal
texts (null, empty and repeated rows included); a text shorter than a shingle
is one shingle; the class id is the least doc_id of the class, null only if
all its doc_ids are null; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.common import (ByteHash, NULL_ID, U64, accumulate, arrow_bytes, full_text, mix, owners,
                                  prepare, shingles, slices, staged, tokens)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
#: How much more the rarest shingle weighs than one that every document has.  Small, so
#: that near copies in a large group, whose common shingles are frequent, stay similar.
DAMP = 0.1
BUCKETS = 1 << 20
#: Pivots of a band in the second round.
PIVOTS = 32
#: Nodes of a band from which on the prefix filter takes over.
CROWD = 64
#: What sums of 32-bit weights may be off by.
SLACK = 1e-5
#: Features that are sampled at a time, so that their arrays stay in the cache.
PORTION = 1 << 14
#: Bytes of an Arrow batch; rows that carry two long texts would else make batches of 64 MB.
BATCH_BYTES = 4 << 20
#: Bits of a feature's hash.
_FEATURE = 44

SAMPLE_SCHEMA = "doc_id long, node binary, w double, bands array<long>"
STATE = ["band", "node", "root", "w", "before"]


def features(text: pa.Array):
    """Distinct shingles of each text: hashes (44 bits), counts and the n + 1 offsets."""
    raw, start, end, offsets = tokens(pc.utf8_lower(text))
    words = ByteHash(raw).range(start, end)
    h, offsets, _ = shingles(words, offsets, SHINGLE)
    key = (owners(offsets).astype(U64) << U64(_FEATURE)) | (h >> U64(64 - _FEATURE))
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    rows = (key >> U64(_FEATURE)).astype(np.int64)
    return (key & U64((1 << _FEATURE) - 1), count,
            np.searchsorted(rows, np.arange(len(text) + 1)))


def _bucket(feature: np.ndarray) -> np.ndarray:
    return (feature & U64(BUCKETS - 1)).astype(np.int64)


def count_features(batch: pa.RecordBatch, total: np.ndarray) -> None:
    """Adds the batch's document frequencies; the last place counts documents."""
    feature, _, _ = features(full_text(batch))
    total[:BUCKETS] += np.bincount(_bucket(feature), minlength=BUCKETS)
    total[BUCKETS] += batch.num_rows


def idf_table(frequency: np.ndarray) -> np.ndarray:
    """Damped inverse document frequency of each counter: 1 + DAMP * ln(N / df) / ln(N)."""
    n = max(int(frequency[-1]), 2)
    share = np.clip(frequency[:-1], 1, n) / n
    return (1 - DAMP * np.log(share) / np.log(n)).astype(np.float32)


def weights(feature: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return count.astype(np.float32) * idf[_bucket(feature)]


def _gamma_quantiles(n: int) -> np.ndarray:
    """Gamma(2, 1) at n evenly spaced probabilities, by bisection of 1 - (1 + x) e^-x."""
    u = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < u
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return ((low + high) / 2).astype(np.float32)


class Sampler:
    """Draws the samples; each (sample, feature) has its own r, c ~ Gamma(2, 1) and b ~ U(0, 1)."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(1, 1 << 63, samples, dtype=np.uint64) * U64(2) + U64(1)
        self.gamma = _gamma_quantiles(1 << 16)
        self.log_gamma = np.log(self.gamma)

    def samples(self, feature: np.ndarray, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One hash of (feature, level) per sample and non-empty row: shape (samples, rows)."""
        size = np.diff(offsets)
        edges = np.append(offsets[:-1][size > 0], len(feature))
        out, row = [np.zeros((len(self.factor), 0), U64)], 0
        while row < len(edges) - 1:
            last = max(int(np.searchsorted(edges, edges[row] + PORTION, side="right")) - 1, row + 1)
            a, b = edges[row], edges[last]
            out.append(self._portion(feature[a:b], weight[a:b], edges[row:last] - a))
            row = last
        return np.concatenate(out, 1)

    def _portion(self, feature: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
        size = np.diff(np.append(start, len(feature)))
        own = np.repeat(np.arange(len(start), dtype=np.int32), size)
        out = np.zeros((len(self.factor), len(start)), U64)
        log_w, base = np.log(weight), feature + U64(1)
        for i, factor in enumerate(self.factor):
            z = base * factor
            z ^= z >> U64(29)
            z *= U64(0xBF58476D1CE4E5B9)
            z ^= z >> U64(32)
            bits = z.view(np.uint16).reshape(-1, 4)
            r = self.gamma[bits[:, 0]]
            b = bits[:, 2].astype(np.float32)
            b *= np.float32(2.0 ** -16)
            level = log_w / r
            level += b
            np.floor(level, out=level)
            log_a = b
            log_a -= level
            log_a -= 1
            log_a *= r
            log_a += self.log_gamma[bits[:, 1]]
            least = np.minimum.reduceat(log_a, start)
            at = np.flatnonzero(log_a == least[own])
            if len(at) > len(start):
                at = at[np.append(True, own[at[1:]] != own[at[:-1]])]
            out[i] = mix(feature[at] ^ mix(level[at].astype(np.int64).astype(U64) + U64(i)))
        return out

    def bands(self, feature: np.ndarray, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Band keys of the non-empty rows: shape (rows, BANDS)."""
        s = self.samples(feature, weight, offsets)
        out = []
        for b in range(len(s) // ROWS):
            h = np.full(s.shape[1], U64(b + 1))
            for j in range(ROWS):
                h = mix(h * U64(31) + s[b * ROWS + j])
            out.append(h)
        return np.stack(out, 1) if out else np.zeros((0, 0), U64)


def _sampled(idf, sampler: Sampler, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            feature, count, offsets = features(full_text(part))
            weight = weights(feature, count, idf.value)
            keys = sampler.bands(feature, weight, offsets)
            size = np.where(np.diff(offsets) > 0, BANDS, 0)
            bands = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(_totals(weight, offsets)), bands],
                ["doc_id", "node", "w", "bands"])


def _totals(weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Weight of each row's features."""
    return np.diff(np.concatenate([[0.0], np.cumsum(weight, dtype=np.float64)])[offsets])


def prefixes(feature: np.ndarray, count: np.ndarray, offsets: np.ndarray, idf: np.ndarray):
    """row, feature, weight before it, of the rarest features that hold 1 - SIMILARITY of a row's weight.

    The order, by idf and then by hash, is the same for all rows.  A feature that the counters give to one
    document weighs before the others, but no other row can share it: it is left out."""
    weight, rare = weights(feature, count, idf), idf[_bucket(feature)]
    row = owners(offsets)
    order = np.lexsort((feature, -rare, row))
    ends = np.cumsum(weight[order], dtype=np.float64)
    total = _totals(weight, offsets)
    start = np.concatenate([[0.0], ends])[offsets[:-1]]
    before = ends - weight[order] - start[row]
    shared = rare[order] < 1 + DAMP - SLACK
    keep = (before <= (1 - SIMILARITY + SLACK) * total[row]) & shared
    return row[keep], feature[order][keep], before[keep], total


def _prefixed(idf, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            row, feature, before, total = prefixes(*features(full_text(part)), idf.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature.astype(np.int64)), part.column(0).take(pa.array(row)),
                 part.column(1).take(pa.array(row)), pa.array(total[row]), pa.array(before)], STATE)


def similarity(fa, wa, fb, wb) -> float:
    """Weighted Jaccard similarity of two sorted feature lists."""
    _, ia, ib = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
    low = np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64)
    total = wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - low
    return float(low / total) if total > 0 else 0.0


def _distinct_features(text: pa.Array, idf: np.ndarray):
    """Features, weights and offsets of the distinct texts, and each row's text."""
    coded = text.dictionary_encode()
    f, c, offsets = features(coded.dictionary)
    return f, weights(f, c, idf), offsets, coded.indices.to_numpy().tolist()


def _compared(idf, batches: Iterator[pa.RecordBatch]):
    """Similarity of each row's two texts; a text that many rows hold is cut into features once."""
    for batch in batches:
        for part in slices(batch):
            (fa, wa, a, i), (fb, wb, b, j) = (
                _distinct_features(full_text(part, c), idf.value) for c in ("text", "pivot_text"))
            sims = [similarity(fa[a[x]:a[x + 1]], wa[a[x]:a[x + 1]], fb[b[y]:b[y + 1]], wb[b[y]:b[y + 1]])
                    for x, y in zip(i, j)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sims, pa.float64())],
                ["node", "pivot", "sim"])


def _least(members: DataFrame, n: int) -> DataFrame:
    """The n least nodes of each band; sub-ranks in salted parts come first, so no hot band is sorted whole."""
    rank = F.row_number()
    rows = members.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(64)))
    rows = rows.withColumn("k", rank.over(Window.partitionBy("band", "part").orderBy("node")))
    rows = rows.where(F.col("k") <= n).drop("k", "part")
    rows = rows.withColumn("k", rank.over(Window.partitionBy("band").orderBy("node")))
    return rows.where(F.col("k") <= n).select(
        "band", *(F.col(c).alias(f"pivot_{c}") for c in STATE[1:]))


def _open(state: DataFrame) -> DataFrame:
    """Rows of bands with nodes of several components, with the band's largest component and size;
    rows that no mate's weight allows a link to are left out."""
    t = SIMILARITY - SLACK
    state = state.withColumn("reach", F.col("w") - F.col("before"))
    bands = state.groupBy("band", "root").agg(
        F.count("*").alias("n"), F.min("w").alias("light"), F.max(F.col("reach") * (1 + t) / t - F.col("w")).alias("far"))
    bands = bands.groupBy("band").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), F.count("*").alias("roots"),
        F.sum("n").alias("size"), F.min("light").alias("light"), F.max("far").alias("far"))
    return (state.join(bands.where("roots > 1").drop("roots"), "band")
            .where((F.col("light") <= F.col("reach") * (1 + t) / t - F.col("w")) & (F.col("far") >= F.col("w")))
            .drop("reach", "light", "far"))


def _links(state: DataFrame, pivots: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Links (node, pivot) between the pivots and their mates of other components."""
    t = SIMILARITY - SLACK
    bound = F.least(F.col("w") - F.col("before"), F.col("pivot_w") - F.col("pivot_before"))
    # Weights decide before texts meet: overlap is at most the smaller reach, and W >= t * W' holds.
    pairs = state.join(pivots, "band").where(
        (F.col("root") != F.col("pivot_root")) & (bound >= (F.col("w") + F.col("pivot_w")) * (t / (1 + t)))
        & (F.least("w", "pivot_w") >= F.greatest("w", "pivot_w") * t))
    pairs = pairs.select(F.least("node", "pivot_node").alias("node"),
                         F.greatest("node", "pivot_node").alias("pivot")).distinct()
    other = texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
    sims = (pairs.join(texts, "node").join(other, "pivot").select("node", "pivot", "text", "pivot_text")
            .mapInArrow(lambda it: _compared(idf, it), "node binary, pivot binary, sim double"))
    return staged(sims.where(F.col("sim") >= SIMILARITY).select("node", "pivot"), "links")


def _merged(found: DataFrame, roots: DataFrame) -> DataFrame:
    """old, new root of the components that the links ``found`` join; ``roots`` has each node's present one."""
    old = roots.select(F.col("node").alias("n"), F.col("root").alias("r"))
    ends = (found.join(old, F.col("node") == F.col("n")).select("pivot", F.col("r").alias("a"))
            .join(old, F.col("pivot") == F.col("n")).select(F.col("a").alias("node"), F.col("r").alias("pivot")))
    return components(ends.where("node <> pivot")).select(F.col("node").alias("old"), F.col("root").alias("new"))


def _relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` with the new roots of ``merged``."""
    return rows.join(merged, F.col("root") == F.col("old"), "left").withColumn(
        "root", F.coalesce("new", "root")).drop("old", "new")


def _rounds(state: DataFrame, texts: DataFrame, idf, edges: list, crowds: bool) -> DataFrame | None:
    """Rounds of pivots until every band is done; appends the links to ``edges``.

    With ``crowds``, nodes of large bands that are left after the first round
    are returned (node, root) in place of going on."""
    number, pivots_of, crowd = 0, 1 if crowds else PIVOTS, None
    while True:
        rows = _open(state)
        if crowds and number == 1:
            rows = staged(rows, "open")
            crowd = staged(rows.where(F.col("size") > CROWD).select("node", "root").distinct(), "crowd")
            rows = rows.where(F.col("size") <= CROWD)
        pivots = staged(_least(rows.where("root <> major"), pivots_of), "pivots")
        if pivots.isEmpty():
            return crowd
        rows = rows.select(*STATE)
        found = _links(rows, pivots, texts, idf)
        state = rows.join(pivots.select("band", F.col("pivot_node").alias("node")), ["band", "node"], "left_anti")
        if not found.isEmpty():
            edges.append(found)
            merged = _merged(found, rows.select("node", "root").distinct())
            state = _relabelled(state, merged)
            if crowd is not None:
                crowd = staged(_relabelled(crowd, merged), "crowd")
        state = staged(state.select(*STATE), "members")
        number, pivots_of = number + 1, max(2 * pivots_of, PIVOTS)


def _roots(members: DataFrame, texts: DataFrame, idf) -> DataFrame | None:
    """node, root of the nodes that are linked; None without a link."""
    edges: list[DataFrame] = []
    state = members.select("band", "node", F.col("node").alias("root"), "w", F.lit(0.0).alias("before"))
    crowd = _rounds(state, texts, idf, edges, crowds=True)
    if crowd is not None and not crowd.isEmpty():
        rows = (crowd.join(texts, "node").select("node", "root", "text")
                .mapInArrow(lambda it: _prefixed(idf, it),
                            "band long, node binary, root binary, w double, before double"))
        count = F.count("*").over(Window.partitionBy("band"))
        rows = staged(rows.withColumn("n", count).where("n > 1").drop("n"), "members")
        _rounds(rows, texts, idf, edges, crowds=False)
    if not edges:
        return None
    found = edges[0]
    for more in edges[1:]:
        found = found.unionByName(more)
    return components(found)


def components(links: DataFrame) -> DataFrame:
    """node, root of all nodes of ``links`` (node, pivot): the least node of its component.

    Alternates large stars (neighbours above a node join its least neighbour)
    and small stars (neighbours below join the least of them) until only stars are
    left, whose centres are minima; minima are partial aggregates, neighbours are never gathered."""
    edges = staged(links.select(F.greatest("node", "pivot").alias("u"),
                                F.least("node", "pivot").alias("v")).distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each upper node of ``edges`` (u > v) has one edge and is no lower node of another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up + down > 1 AND up > 0").isEmpty()


def node_key(text: Column) -> Column:
    """128-bit key of a whole text; equal texts are one node."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       node_key(text).alias("node"), text.alias("text"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, node, root, class_doc, class_node, class_size of every row of ``docs`` (doc_id, text).

    (class_doc, class_node) is the least row of the class, its representative."""
    with arrow_bytes(prepare(docs.sparkSession), BATCH_BYTES):
        return _classes(keyed(docs))


def _classes(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    idf = spark.sparkContext.broadcast(
        idf_table(accumulate(rows.select("text"), count_features, BUCKETS + 1)))
    sampler = Sampler()
    sampled = staged(rows.mapInArrow(lambda it: _sampled(idf, sampler, it), SAMPLE_SCHEMA),
                     "samples")
    # One row per distinct text; its bands are a function of the text.
    one = staged(sampled.groupBy("node").agg(F.first("bands").alias("bands"), F.first("w").alias("w"),
                                             F.min("doc_id").alias("doc_id")), "nodes")
    bands = one.select("node", "w", F.explode("bands").alias("band"))
    # The count travels with the rows: one shuffle of the bands.
    mates = F.count("*").over(Window.partitionBy("band"))
    members = staged(bands.withColumn("n", mates).where("n > 1").select("band", "node", "w"), "members")
    if members.isEmpty():
        roots = sampled.select("node", F.col("node").alias("root")).distinct()
    else:
        # One row's text per node; the doc_id in the key spreads a hot group of copies.
        wanted = one.join(members.select("node").distinct(), "node", "left_semi").select(
            "doc_id", "node")
        texts = staged(rows.join(wanted, ["doc_id", "node"], "left_semi")
                       .dropDuplicates(["doc_id", "node"]).select("node", "text"), "texts")
        roots = _roots(members, texts, idf)
        if roots is None:
            roots = members.select("node", F.col("node").alias("root")).distinct()
    labelled = sampled.select("doc_id", "node").join(roots, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"))
    labelled = staged(labelled, "labelled")
    idf.destroy()
    heads = labelled.groupBy("root").agg(
        F.min(F.struct(F.expr(f"CASE WHEN doc_id = {NULL_ID} THEN 1 ELSE 0 END").alias("void"),
                       F.col("doc_id").alias("d"), F.col("node").alias("k"))).alias("head"),
        F.count("*").alias("class_size"))
    return labelled.join(heads, "root").select(
        "doc_id", "node", "root", F.col("head.d").alias("class_doc"),
        F.col("head.k").alias("class_node"), "class_size")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size of every row; the class id is the class's least doc_id."""
    return classes(docs).select(
        F.nullif(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id"),
        F.nullif(F.col("class_doc"), F.lit(NULL_ID)).alias("class_id"), "class_size")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, all columns; a repeated row stays once."""
    kept = classes(docs).where("doc_id = class_doc AND node = class_node").select(
        F.col("doc_id").alias("__doc"), F.col("node").alias("__node")).distinct()
    kept = staged(kept, "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
                             "__node": node_key(text)})
    return (rows.join(kept, ["__doc", "__node"], "left_semi")
            .dropDuplicates(["__doc", "__node"]).select(*docs.columns))
