"""Operator 11: Elias-Fano against arrays, the trie against dicts, scores against a plain trigram model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicflow.llm import ngram_lm as L
from civicflow.llm.elias_fano import EliasFano, Trie, quantise
from conftest import SF_SMALL

SCHEMA = "doc_id long, text string, shard long, h string"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</s>"]


def trains(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def brute(rows):
    """doc_id, n_tokens, n_known, N, base, score of each row, with exact probabilities."""
    uni, bi, tri, followers = Counter(), Counter(), Counter(), {}
    context = Counter()
    for doc, text in rows:
        if trains(doc):
            w = words_of(text)
            uni.update(w)
            for i, x in enumerate(w):
                keys = [(w[i - 1] if i else "<s>",)] + ([(w[i - 2] if i > 1 else "<s>", w[i - 1])] if i else [])
                for key in keys:
                    (bi if len(key) == 1 else tri)[key + (x,)] += 1
                    context[key] += 1
                    followers.setdefault(key, set()).add(x)
    n, v, d = sum(uni.values()), len(uni), L.DISCOUNT
    kinds, seen = Counter(), Counter()
    kind = lambda key: int(2 * math.log2(context[key]))         # noqa: E731
    for (a, _), c in bi.items():
        kinds[kind((a,))] += 1
        seen[kind((a,))] += c
    out = []
    for doc, text in rows:
        w = words_of(text)
        base = score = 0.0
        for i, x in enumerate(w):
            p = (uni[x] + 1) / (n + v + 1)
            base += math.log10(p)
            keys = [(w[i - 1] if i else "<s>",)] + ([(w[i - 2] if i > 1 else "<s>", w[i - 1])] if i else [])
            if context[keys[0]]:
                r = d * kinds[kind(keys[0])] / seen[kind(keys[0])]
                p = (1 - r) * bi[keys[0] + (x,)] / context[keys[0]] + r * p
            for key, counts in zip(keys[1:], (tri,)):
                if context[key]:
                    p = max(counts[key + (x,)] - d, 0) / context[key] + d * len(followers[key]) / context[key] * p
            score += math.log10(p)
        out.append((doc, not trains(doc), len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def compare(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])       # noqa: E731
    got, want = sorted((tuple(r) for r in got), key=key), sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        # Stored values are rounded down to one of 256.
        assert g[6] <= w[6] + 1e-4 * g[2] and g[6] >= w[6] - 0.02 * g[2] - 1e-6
        assert g[6] <= 1e-9


def scores(df):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return L.language_model_scores(df, ~held).collect()


def test_query_matches_a_plain_model(spark):
    from civicflow.llm.queries import op11_language_model
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op11_language_model(spark, SF_SMALL).collect()
    compare(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_many_shards_in_parts_give_the_same(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
            if len(r["text"] or "") < 5000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(L, "SHARD_TOKENS", 1500)
    monkeypatch.setattr(L, "PART_BYTES", 700)
    monkeypatch.setattr(L, "BUCKET_WORDS", 300)
    compare(scores(df), rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b c a B c"), (4, "A b c a B c"), (None, "a b x"), (None, "a b x"),
            (5, "b c"), (6, "ÄB äb"), (7, "new words only"), (8, "a " * 3000)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    compare(scores(df), rows)
    assert scores(spark.createDataFrame([], SCHEMA)) == []
    held = [d for d in range(50) if not trains(d)][:3]
    alone = [(d, "some words") for d in held]
    got = scores(spark.createDataFrame([(d, t, 1, "x") for d, t in alone], SCHEMA))
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(0, 0, 0.0, 0.0)] * 3


@pytest.mark.parametrize("n, top", [(0, 10), (1, 1), (1, 0), (5, 3), (1000, 900), (1000, 10 ** 6),
                                    (5000, 1 << 60), (70, 4096), (3000, 1 << 62)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n + 1)
    v = np.sort(rng.integers(0, top + 1, n))
    coded = EliasFano(EliasFano.encode(v))
    if n:
        assert (coded.access(np.arange(n)) == v).all()
    q = np.concatenate([v, v + 1, v - 1, rng.integers(0, top + 5, 200), [0, 1, 1 << 61]])
    assert (coded.successor(q) == np.searchsorted(v, np.maximum(q, 0))).all()
    assert (coded.find(v) == np.searchsorted(v, v)).all()
    # Two bits and the low bits of an element, and a few words.
    if n > 500:
        assert coded.size * 64 < n * (3 + max(math.log2((top + 1) / n), 0)) + 600


def test_trie_in_a_buffer_and_memory_mapped(tmp_path):
    rng = np.random.default_rng(4)
    ids = np.sort(rng.choice(10000, 300, replace=False))
    pairs = sorted({(int(ids[i]), int(ids[j])) for i, j in rng.integers(0, 300, (2000, 2))})
    triples = sorted({(int(i), int(ids[j])) for i, j in zip(rng.integers(0, len(pairs), 3000),
                                                            rng.integers(0, 300, 3000))})
    a, b = np.array(pairs).T
    parent, c = np.array(triples).T
    values = rng.random(len(a)), rng.random(len(a)), rng.random(len(c))
    data = Trie.build(a, b, values[0], values[1], parent, c, values[2])
    (tmp_path / "trie").write_bytes(data)
    qa, qb = rng.integers(0, 10000, 4000), rng.choice(ids, 4000)
    qa[1000:] = rng.choice(ids, 3000)
    qa, qb = np.concatenate([qa, a]), np.concatenate([qb, b])
    qp, qc = np.concatenate([rng.integers(0, len(qa), 5000), parent + 4000]), np.concatenate([rng.choice(ids, 5000), c])
    at = {p: i for i, p in enumerate(pairs)}
    known = {t: i for i, t in enumerate(triples)}
    for trie in (Trie(data), Trie.open(str(tmp_path / "trie"))):
        p, rest, t = trie.values(np.arange(10000), qa, qb, qp, qc)
        for i, k in enumerate(zip(qa.tolist(), qb.tolist())):
            if k in at:
                assert 0 <= values[0][at[k]] - p[i] + 1e-6 < 0.02 and 0 <= values[1][at[k]] - rest[i] + 1e-6 < 0.02
            else:
                assert (p[i], rest[i]) == (0, 1)
        for i, (k, w) in enumerate(zip(qp.tolist(), qc.tolist())):
            j = known.get((at.get((int(qa[k]), int(qb[k]))), w))
            assert t[i] == 0 if j is None else 0 <= values[2][j] - t[i] + 1e-6 < 0.02
    with pytest.raises(ValueError):
        Trie(b"nothing of that kind....")


def test_quantised_values_are_lower_neighbours():
    code, table = quantise(np.array([0.5, 0.25, 0.5]))
    assert table[code].tolist() == [0.5, 0.25, 0.5]
    v = np.random.default_rng(0).random(10000).astype(np.float32)
    code, table = quantise(v)
    assert (table[code] <= v).all() and (v - table[code]).max() < 0.01
