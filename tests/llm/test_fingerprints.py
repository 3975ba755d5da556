"""Order MinHash against a plain Python version; PII against the plain patterns."""

import hashlib
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from civicflow.llm import order_minhash, pii

TEXTS = {0: "a b c d e f g h", 1: None, 2: "a b c d e f g h", 5: "", 7: "solo", 9: "x y",
         12: "the cat sat on the mat the cat sat on the mat the cat sat", 13: "  \n ",
         20: "é " * 300, 21: "nospace" * 400, 30: " ".join(f"w{i % 37}" for i in range(900)),
         31: " ".join(f"w{i % 37}" for i in range(880))}


def _hash(*values):
    """xxhash64 of Spark: each value seeds the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v
        if isinstance(v, int):
            data = (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def _signed(v):
    return v - (1 << 64) if v >> 63 else v


def brute_fingerprint(text):
    words = [_hash(w) for w in re.findall(r"\S{1,12}", text, re.A)]
    k = order_minhash.K
    if not words:
        return ""
    grams = [_hash(*words)] if len(words) < k else \
        [_hash(*words[i:i + k]) for i in range(len(words) - k + 1)]
    seen, bins = Counter(), {}
    for place, g in enumerate(grams):
        h = _hash(g, seen[g].to_bytes(4, "little"))
        seen[g] += 1
        bins.setdefault(h >> 58, []).append((_signed(h), place))
    out = []
    for b, pairs in sorted(bins.items()):
        kept = sorted(sorted(pairs)[:2], key=lambda p: p[1])
        out.append(b << 32 | _hash(*(h for h, _ in kept)) & 0xFFFFFFFF)
    return "".join(f"{v:010X}" for v in out)


def test_order_minhash_matches_brute_force(spark):
    df = spark.createDataFrame([(v, k, "c") for k, v in TEXTS.items()], "text string, doc_id long, fp string")
    rows = {r.doc_id: r for r in order_minhash.edited_fingerprints(df).collect()}
    ids = sorted(TEXTS)
    for i, doc in enumerate(ids):
        text, after = TEXTS[doc] or "", TEXTS[ids[(i + 1) % len(ids)]] or ""
        n = len(text)
        edited = text[:n - n // 4] + after[:n // 4]
        r = rows[doc]
        assert r.n_chars == n
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == brute_fingerprint(text)
        assert r.edited_fingerprint == brute_fingerprint(edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert rows[0].fingerprint == rows[2].fingerprint != ""
    assert rows[30].near_next > 0.5


def test_order_minhash_sees_order(spark):
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    df = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(swapped))], "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in order_minhash.edited_fingerprints(df).collect()}
    assert 0.2 < near[0] < 0.8          # nearly the same set of k-mers in another order


def test_order_minhash_edge_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.edited_fingerprints(df).count() == 0
    one = spark.createDataFrame([(4, "a b c d"), (4, "a b c d"), (None, None)], "doc_id long, text string")
    assert order_minhash.edited_fingerprints(one).count() == 3


def _luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def _digits(m):
    return re.sub(r"\D", "", m)


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15))
PIECES = ["a@b.com", "a@b.com_x@c.de", "x@y", "@", "é", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "0010.1.1.1",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "1  2", "+49 (30) 1234-567",
          "+1 2", "++44 20 7946 0958", "1234567890123456789012", " ", ".", "-", "😀", "tel", "GB82 WEST 1234 5698 7654 32",
          "123-45-6789", "SSN 078-05-1120", "call 555-123-4567", "a.b-c%d@e-f.g.h.", "\n"]


def _texts():
    import random
    rng = random.Random(5)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    return out + [None, "", "7" * 30000, "a" * 30000 + "@", "1.2.3.4 " * 700, "a@b.c " * 300]


def test_pii_base_spans_match_plain_patterns(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.pii_report(df).collect():
        text = texts[r.doc_id] or ""
        base = [(k, m.start(), m.end()) for k, p, ok in PLAIN for m in re.finditer(p, text) if ok(m.group())]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (text, r.spans, joined)
        n = Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in ("email", "ip", "card", "phone"))
        assert not joined or r.spans.startswith(joined)


def test_pii_checksums_and_context_add_spans(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "IBAN GB82 WEST 1234 5698 7654 33 ok",
             "078-05-1120", "my social security number is 078-05-1120", "please call 555-123-4567", "555-123-4567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in pii.pii_report(df).collect()}
    assert kinds == {0: ["iban"], 1: [], 2: [], 3: ["ssn"], 4: ["local_phone"], 5: []}


def test_redact_masks_every_span_and_keeps_the_rest(spark):
    texts = ["mail a@b.com now", None, "", "ip 1.2.3.4, +49 30 1234567 end", "none", "1.2.3.4 " * 300]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    assert [got[i].text for i in range(5)] == ["mail [EMAIL] now", None, "", "ip [IP], [PHONE] end", "none"]
    assert got[5].text == "[IP] " * 300 and got[5].spans == "s"
    assert pii.redact(df.limit(0)).count() == 0
    assert pii.pii_report(pii.redact(df)).agg(F.max(F.length("spans"))).first()[0] == 0
