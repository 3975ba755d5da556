"""Operator 13 against a quadratic search."""

import hashlib
import random
import re
import zlib

import numpy as np

from civicflow.llm import runs as R
from conftest import SF_SMALL

SCHEMA = "doc_id long, text string, start long, node string"


def brute_runs(words):
    """(start, length, period) of all runs, by trying every period at every place."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_row(doc_id, text, change):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if change and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()      # noqa: E731
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_query_matches_brute_force(spark):
    from civicflow.llm.queries import op13_periodic_runs
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in op13_periodic_runs(spark, SF_SMALL).collect()), key=key)
    # The quadratic search is for texts of up to some thousand words.
    small = {r["doc_id"] for r in docs if len((r["text"] or "").split()) < 1500}
    want = sorted((brute_row(r["doc_id"], r["text"], True) for r in docs if r["doc_id"] in small), key=key)
    assert len(small) > 0.9 * len(docs) and len(got) == len(docs)
    assert [g for g in got if g[0] in small] == want
    assert sum(g[1] for g in got) > 10


def test_random_words_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 5)):
            k = rng.choice([1, 2, 2, 3, 4])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 70))]
            if w and rng.random() < 0.5:
                a = rng.randrange(len(w))
                p = rng.randint(1, min(12, len(w) - a))
                w = w[:a] + [w[a + i % p] for i in range(rng.randint(0, 60))] + w[a:]
            docs.append(w)
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        s, e, q = R.find_runs(np.array([x for d in docs for x in d], np.int64), offsets)
        for i, d in enumerate(docs):
            inside = (s >= offsets[i]) & (e <= offsets[i + 1])
            assert sorted(zip((s - offsets[i])[inside].tolist(), (e - s)[inside].tolist(),
                              q[inside].tolist())) == brute_runs(d)


def test_grammar_derives_the_words_and_no_pair_is_left():
    rng = random.Random(2)
    words = np.array([rng.randrange(5) for _ in range(600)] + [1, 2] * 50 + [7] * 40, np.int64)
    g = R.repair(words, np.array([0, 300, 300, len(words)]))
    assert (g.start < g.middle).all() and (g.middle < g.end).all()
    for node, at in zip(g.node.tolist(), g.at.tolist()):
        size = g.end[node] - g.start[node]
        assert (words[at:at + size] == words[g.start[node]:g.end[node]]).all()
    # A symbol that occurs twice stands for many: far fewer nodes than derivations.
    assert len(g.start) < 0.7 * len(g.node)


def test_long_and_hostile_texts():
    for words, count in ((np.zeros(20000, np.int64), 1), (np.arange(20000) % 7, 1)):
        s, e, q = R.find_runs(words.astype(np.int64), np.array([0, len(words)]))
        assert len(s) == count and (s[0], e[0]) == (0, 20000)
    # Thue-Morse words deceive hashes modulo a power of two.
    words = np.array([bin(i).count("1") % 2 for i in range(2048)], np.int64)
    s, e, q = R.find_runs(words, np.array([0, len(words)]))
    assert sorted(zip(s.tolist(), (e - s).tolist(), q.tolist())) == brute_runs(words.tolist())


def test_edges(spark):
    loop = "a b\tc\n" * 10
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, " \n\t ", 1, "x"), (4, loop, 1, "x"), (4, loop, 1, "x"),
            (None, loop, 1, "x"), (5, "ä b " * 14, 1, "x"), (6, "one two three", 1, "x"),
            (-7, "x " * 11, 1, "x"), (8, "x " * 12 + "y", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    for change in (False, True):
        got = sorted((tuple(r) for r in R.run_report(df, change).collect()), key=key)
        assert got == sorted((brute_row(r[0], r[1], change) for r in rows), key=key)
    assert R.run_report(spark.createDataFrame([], SCHEMA)).collect() == []
    spans = sorted((r["doc_id"] or 0, r["start"], r["length"], r["period"])
                   for r in R.periodic_runs(df).collect())
    assert spans == [(0, 0, 30, 3), (4, 0, 30, 3), (4, 0, 30, 3), (5, 0, 14, 1), (8, 0, 12, 1)]
    kept = {(r["doc_id"], r["text"]) for r in R.collapsed(df).collect()}
    assert {(4, "a b c"), (8, "x y"), (1, None), (6, "one two three"), (3, " \n\t ")} <= kept
    assert R.collapsed(df).columns == df.columns
