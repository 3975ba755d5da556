"""Token files and packing against whole-text encoding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from civicflow.llm import packing, simple8b

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "One two, three!", "line\nline\n\nline  two", "It's don't <|endoftext|> a|b",
         "Ünïcode é é 中文 😀", "\tindent space ", "x" * 5000, "the quick brown fox " * 700]
ROWS = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "no id", "x")]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 1 << 20), st.integers(0, (1 << 64) - 1)),
                max_size=300))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids):
    values = np.array(ids, np.uint64)
    words, offsets = simple8b.encode_blocks(values, 64)
    assert simple8b.decode_blocks(words, offsets, len(values), 64).tolist() == ids
    # Blocks can be decoded alone.
    for b in range(len(offsets) - 1):
        own = values[64 * b:64 * b + 64]
        part = words[offsets[b]:offsets[b + 1]]
        alone = simple8b.decode_blocks(part, np.array([0, len(part)], np.uint32), len(own), 64)
        assert (alone == own).all()


def test_simple8b_packs_small_ids_densely():
    words, _ = simple8b.encode_blocks(np.ones(60, np.uint64), 64)
    assert len(words) == 1
    words, _ = simple8b.encode_blocks(np.full(3, (1 << 20) - 1, np.uint64), 64)
    assert len(words) == 1


def _docs(spark, rows=ROWS):
    # A clashing column name and the columns in another order.
    return spark.createDataFrame([(r[2], r[1], r[0], 7) for r in rows],
                                 "start string, text string, doc_id long, n_ids int")


def test_token_files_hold_whole_texts_in_order(spark, tmp_path):
    path = str(tmp_path / "files")
    got = simple8b.token_files(_docs(spark), WORD, path).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want, at = [], 0
    for doc, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)


def test_token_files_of_nothing(spark, tmp_path):
    assert simple8b.token_files(_docs(spark, []), WORD, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("limits", [{}, {"max_tokens": 64, "max_segments": 4},
                                    {"max_tokens": 128, "max_loss": 40}])
def test_packing_keeps_each_id_once_within_limits(spark, limits):
    rows = packing.pack(_docs(spark), BYTE, **limits).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    top = limits.get("max_tokens", packing.MAX_TOKENS)
    want = defaultdict(list)
    for doc, text, _ in ROWS:
        want[doc].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    found = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        found[r.doc_id] += [(r.start, i, t) for i, t in enumerate(ids.tolist())]
    for doc, texts in want.items():
        every = sorted((a + i, t) for a, i, t in found[doc])
        assert every == sorted((i, t) for ids in texts for i, t in enumerate(ids))
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= top and len(pieces) <= limits.get("max_segments", packing.MAX_SEGMENTS)
        assert sum(p.loss_tokens for p in pieces) <= limits.get("max_loss", top)
        # Whatever is not full needs no padding.
        assert at == top or at & (at - 1) == 0


def test_packing_without_cutting_and_with_partial_loss(spark):
    df = spark.createDataFrame([(i, "word " * n, n // 2) for i, n in enumerate([30, 50, 20, 60, 40, 10])],
                               "doc_id long, text string, answer int")
    rows = packing.pack(df, BYTE, loss_tokens="answer", max_tokens=100, max_loss=60, cut=False).collect()
    assert all(r.start == 0 and r.length == r.doc_tokens for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    assert all(sum(r.length for r in v) <= 100 and sum(r.loss_tokens for r in v) <= 60
               for v in by.values())
    assert len(by) < len(rows)
