"""Decontamination and near-duplicates against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from civicflow.llm import decontaminate, near_dedup

RNG = random.Random(3)
VOCABULARY = [f"{a}{b}" for a in "ba ce di fo gu ha je ki lo mu".split() for b in "na pe ri so tu va xe yi zo".split()]


def _words(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def _smith_waterman(a, b):
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[-1] - 1))
            best = max(best, new[-1])
        row = new
    return best


def test_leaks_match_full_alignment(spark):
    items = [(i, " ".join(_words(30 + i))) for i in range(12)] + [(50, None), (51, ""), (52, "too short")]
    docs, planted = [], set()
    for d in range(120):
        body = _words(120)
        if d % 3 == 0:
            item, text = items[d % 12]
            copy = text.split()
            if d % 2:                                   # edited: every seventh word another, one dropped
                copy = [w if k % 7 else "edited" for k, w in enumerate(copy)]
                del copy[5]
            at = d % 100
            body[at:at] = copy
            planted.add((d, item))
        docs.append((d, " ".join(body).upper() if d % 5 == 0 else ", ".join(body), 1.0))
    docs += [(500, None, 0.0), (501, "", 0.0), (0, docs[0][1], 0.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    got = decontaminate.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert sum(r.doc_id == 0 for r in got) == 2         # the repeated row
    texts = {d: re.findall(r"\w+", t.lower()) for d, t, _ in docs if t and d < 500}
    for r in got:
        item = dict(items)[r.item_id].split()
        full = _smith_waterman(item, texts[r.doc_id])
        assert abs(r.score - full / (2 * len(item))) < 1e-9
        span = texts[r.doc_id][r.first_word:r.last_word + 1]
        assert _smith_waterman(item, span) == full
    clean = decontaminate.clean(df, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _, _ in docs} - {d for d, _ in planted}


def test_leaked_passage_in_a_third_of_all_documents(spark):
    item = " ".join(_words(40))
    docs = [(d, " ".join(_words(60) + (item.split() if d % 3 == 0 else []))) for d in range(300)]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 300, 3))


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, " ".join(_words(25))) for i in range(9)]
    docs = [(i, "start " + t + " end") for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(d, q).collect()) == [(i, i) for i in range(9)]
    assert decontaminate.leaks(d, q.limit(0)).count() == 0
    assert decontaminate.leaks(d.limit(0), q).count() == 0


def test_samples_collide_with_weighted_jaccard():
    rng = np.random.default_rng(0)
    f = np.sort(rng.choice(1 << 40, 400, replace=False).astype(np.uint64))
    wa = rng.uniform(0.5, 9, 300).astype(np.float32)
    a, b = f[:300], f[60:360]
    wb = np.concatenate([wa[60:] * rng.uniform(0.7, 1.2, 240).astype(np.float32),
                         rng.uniform(0.5, 9, 60).astype(np.float32)])
    sampler = near_dedup.Sampler(samples=3000)
    s = sampler.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 300, 600]))
    true = near_dedup.similarity(a, wa, b, wb)
    assert abs((s[:, 0] == s[:, 1]).mean() - true) < 0.03


def _weighted(texts):
    """Brute-force TF-IDF shingles and all links of at least the similarity."""
    shingles, df = [], defaultdict(int)
    for t in texts:
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        grams = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        counts = defaultdict(int)
        for g in grams:
            counts[g] += 1
        shingles.append(counts)
        for g in counts:
            df[g] += 1
    n = len(texts)
    idf = {g: 1 + near_dedup.DAMP * np.log(n / c) / np.log(n) for g, c in df.items()}

    def sim(a, b):
        keys = set(a) | set(b)
        total = sum(max(a.get(k, 0), b.get(k, 0)) * idf[k] for k in keys)
        return sum(min(a.get(k, 0), b.get(k, 0)) * idf[k] for k in keys) / total if total else 0
    return shingles, sim


def test_classes_match_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for g in range(14):
        base = _words(160, rng)
        texts.append(" ".join(base))
        for k in range(g % 5):
            copy = list(base)
            for _ in range(1 + 3 * k):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    common = _words(60, rng)
    texts += [" ".join(_words(60, rng) + common) for _ in range(40)]     # a shared passage is no copy
    texts += ["exact copy of a short text"] * 5 + [None, "", "  ", "one two", "one two", "x"]
    ids = [3 * i + 1 for i in range(len(texts))]
    df = spark.createDataFrame([(t, i, "n") for i, t in zip(ids, texts)] + [(texts[0], ids[0], "n")],
                               "text string, doc_id long, node string")
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(texts) + 1
    shingles, sim = _weighted(texts)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            s = 1 if same else sim(shingles[i], shingles[j])
            assert same or not 0.795 < s < 0.805, "no borderline pair in this fixture"
            if s >= near_dedup.SIMILARITY:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    want = {ids[i]: min(ids[j] for j in range(len(texts)) if find(j) == find(i)) for i in range(len(texts))}
    assert {r.doc_id: r.class_id for r in got} == want
    kept = near_dedup.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_hot_group_of_near_copies_and_null_ids(spark):
    base = _words(100)
    rows = [(i, " ".join(base[:95] + _words(5))) for i in range(150)] + [(None, "alone here"), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(df).collect()
    assert {r.class_id for r in got if r.doc_id is not None} == {0}
    assert [r.class_size for r in got if r.doc_id is None] == [2, 2]
    assert near_dedup.deduplicated(df).count() == 2
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(500, 560)]
    edges = [(max(a, b), min(a, b)) for a, b in edges if a != b]
    rows = [(a.to_bytes(4, "big"), b.to_bytes(4, "big")) for a, b in edges]
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in
           near_dedup.components(spark.createDataFrame(rows, "node binary, pivot binary")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for x in parent}


def test_features_count_whole_texts():
    f, count, offsets = near_dedup.features(pa.array(["a b c d e a b c d e", "", "One, two"], pa.large_string()))
    assert offsets.tolist() == [0, 5, 5, 6]
    assert sorted(count[:5].tolist()) == [1, 1, 1, 1, 2]


def test_heavily_edited_and_partial_copies_beside_exact_ones(spark):
    rng = random.Random(21)
    items = [(i, _words(40, rng)) for i in range(40)] + [(40, _words(100, rng))]
    docs, planted, d = [], set(), 0
    for i, words in items[:40]:
        for edits in (10, 0)[:1 + i % 2]:               # a quarter of the words another; every second item also whole
            copy = list(words)
            for j in rng.sample(range(40), edits):
                copy[j] = "edited"
            docs.append((d, " ".join(_words(50, rng) + copy + _words(50, rng))))
            planted.add((d, i))
            d += 1
    for at in (0, 30, 55):                              # 45 words in a row of a long item
        docs.append((d, " ".join(_words(50, rng) + items[40][1][at:at + 45] + _words(50, rng))))
        planted.add((d, 40))
        d += 1
    got = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted


def test_few_hits_at_a_time_give_the_same(monkeypatch):
    rng = random.Random(22)
    items = [" ".join(["which", "of", "the", "following"] + _words(25, rng)) for _ in range(30)]
    docs = [" ".join(_words(30, rng) + rng.choice(items).split()[:22] + ["which", "of", "the", "following"])
            for _ in range(40)]
    text = pa.array(docs + [""], pa.large_string())
    index = decontaminate.Index(list(range(30)), items)
    whole = [x.tolist() for x in index.matches(text)]
    assert len(whole[0]) == 40
    monkeypatch.setattr(decontaminate, "HITS", 7)
    monkeypatch.setattr(decontaminate, "CELLS", 50)
    assert [x.tolist() for x in index.matches(text)] == whole


def test_crowds_below_the_similarity_match_brute_force(spark, monkeypatch):
    rng = random.Random(31)
    base = _words(90, rng)
    texts = []
    for k in range(60):                                 # around 0.7 to each other, some pairs above 0.8
        copy = list(base)
        for j in rng.sample(range(90), rng.choice([0, 1, 1, 2, 2, 3])):
            copy[j] = f"w{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    texts = sorted(set(texts))
    monkeypatch.setattr(near_dedup, "CROWD", 8)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    shingles, sim = _weighted(texts)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    below = 0
    for i in range(len(texts)):
        for j in range(i):
            s = sim(shingles[i], shingles[j])
            below += s < near_dedup.SIMILARITY
            if s >= near_dedup.SIMILARITY + 0.005:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    want = {i: find(i) for i in range(len(texts))}
    # Pairs within 0.005 of the similarity may fall either way; no other link is lost or made.
    assert below > len(texts)
    for i, j in ((i, j) for i in range(len(texts)) for j in range(i)):
        if want[i] == want[j]:
            assert got[i] == got[j]


def test_prefix_bound_keeps_every_similar_pair():
    rng = random.Random(32)
    texts = []
    for _ in range(12):
        base = _words(rng.randrange(8, 80), rng)
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            texts.append(" ".join(copy[rng.randrange(0, 4):]))
    f, c, offsets = near_dedup.features(pa.array(texts, pa.large_string()))
    total = np.zeros(near_dedup.BUCKETS + 1, np.int64)
    near_dedup.count_features(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), total)
    idf = near_dedup.idf_table(total)
    w = near_dedup.weights(f, c, idf)
    row, feature, before, weight = near_dedup.prefixes(f, c, offsets, idf)
    kept = [dict(zip(feature[row == i].tolist(), before[row == i].tolist())) for i in range(len(texts))]
    t, near = near_dedup.SIMILARITY - near_dedup.SLACK, 0
    for i in range(len(texts)):
        for j in range(i):
            a, b = slice(offsets[i], offsets[i + 1]), slice(offsets[j], offsets[j + 1])
            if near_dedup.similarity(f[a], w[a], f[b], w[b]) >= near_dedup.SIMILARITY:
                near += 1
                assert any(min(weight[i] - x, weight[j] - kept[j][k]) >= t / (1 + t) * (weight[i] + weight[j])
                           for k, x in kept[i].items() if k in kept[j])
    assert near > 10


def test_features_of_one_document_give_no_prefix_row():
    rng = random.Random(33)
    base = _words(60, rng)
    texts = []
    for k in range(40):                                 # every copy has shingles of its own
        copy = list(base)
        for j in rng.sample(range(60), 3):
            copy[j] = f"own{k}x{j}"
        texts.append(" ".join(copy))
    f, c, offsets = near_dedup.features(pa.array(texts, pa.large_string()))
    total = np.zeros(near_dedup.BUCKETS + 1, np.int64)
    near_dedup.count_features(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), total)
    row, feature, before, _ = near_dedup.prefixes(f, c, offsets, near_dedup.idf_table(total))
    df = total[near_dedup._bucket(feature)]
    assert len(df) and df.min() >= 2
    # What stands before a row's first feature counts the weight of those that are left out.
    assert before.min() > 0


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written = []
    staged = near_dedup.staged
    monkeypatch.setattr(near_dedup, "staged", lambda df, name: written.append(name) or staged(df, name))
    pairs = [(bytes([g, k]), bytes([g, 0])) for g in range(3) for k in range(1, 9)]
    links = spark.createDataFrame(pairs, "node binary, pivot binary")
    got = {bytes(r.node): bytes(r.root) for r in near_dedup.components(links).collect()}
    assert got == {bytes([g, k]): bytes([g, 0]) for g in range(3) for k in range(9)}
    assert written == ["edges"]
