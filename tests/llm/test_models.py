"""The chain and the vectors against brute force; classifiers on planted labels; the wrapper."""

import random

import numpy as np
import pyarrow as pa

from civicflow.llm import quality, toxicity, wrapper

GOOD = [f"{a}{b}" for a in ("lan", "mer", "tos", "vi") for b in ("da", "ro", "li", "ne", "su")]


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    chain = toxicity.Chain(np.zeros(1), rng.normal(size=(2, 2)), 0.3)
    for n in (1, 2, 5, 9):
        e = rng.normal(size=n)
        p = toxicity.Messages(e, np.array([0, n]), chain).marginals()
        total, on = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            s = chain.start * y[0] + sum(e[i] * y[i] for i in range(n)) + sum(
                chain.transitions[y[i - 1], y[i]] for i in range(1, n))
            total += np.exp(s)
            on += np.exp(s) * np.array(y)
        assert np.allclose(p, on / total)


def test_chunks_do_not_change_marginals():
    rng = np.random.default_rng(4)
    chain = toxicity.Chain(np.zeros(1), rng.normal(size=(2, 2)), -0.5)
    sizes = [0, 3, 500, 64, 65, 1, 0, 128]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    e = rng.normal(size=offsets[-1])
    p = toxicity.Messages(e, offsets, chain).marginals()
    t = np.exp(chain.transitions)
    for a, b in zip(offsets, offsets[1:]):
        if a == b:
            continue
        f = [np.array([1, np.exp(chain.start + e[a])])]
        for x in e[a + 1:b]:
            v = f[-1] @ t * [1, np.exp(x)]
            f.append(v / v.sum())
        g = [np.ones(2)]
        for x in e[a + 1:b][::-1]:
            v = t @ (g[-1] * [1, np.exp(x)])
            g.append(v / v.sum())
        q = np.array(f) * np.array(g[::-1])
        assert np.allclose(p[a:b], q[:, 1] / q.sum(1))


def _labelled(n=700, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD) for _ in range(rng.randint(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = "grobi" + rng.choice(["an", "el", "us", "om"])
        junk = i % 4 == 1
        text = " ".join(words) if not junk else " | ".join(w + "!!" for w in words)
        docs.append((text, i, "en"))
        labels.append((i, int(toxic), int(not junk)))
    docs += [(None, 9001, "x"), ("", 9002, "x"), ("grobian", 9003, "x"), (docs[0][0], 0, "again"), ("free", None, "x")]
    return docs, labels


def _frames(spark):
    docs, labels = _labelled()
    return (spark.createDataFrame(docs, "text string, doc_id long, score string"),
            spark.createDataFrame(labels + labels[:3], "doc_id long, toxic int, quality int"), docs, dict(
                (i, (t, q)) for i, t, q in labels))


def test_toxicity_learns_words_and_marks_them(spark):
    df, labels, docs, truth = _frames(spark)
    rows = toxicity.toxicity(df, labels).collect()
    assert len(rows) == len(docs)
    text = {d: t for t, d, _ in docs}
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id in truth:
            assert (r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id][0])
            if truth[r.doc_id][0]:
                assert {text[r.doc_id][s.start:s.end][:5] for s in r.spans} == {"grobi"}
    by = {r.doc_id: r.score for r in rows}
    assert by[9003] > 0.7 and by[9001] == by[9002] < 0.3
    none = toxicity.toxicity(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(df.limit(0), labels).count() == 0


def test_quality_learns_held_out_junk(spark):
    df, labels, docs, truth = _frames(spark)
    rows = quality.quality(df, labels).collect()
    assert len(rows) == len(docs)
    good = [(r.score >= quality.THRESHOLD) == bool(truth[r.doc_id][1]) for r in rows if r.doc_id in truth]
    assert np.mean(good) > 0.97
    kept = quality.accepted(df, labels)
    assert kept.columns == df.columns and 0 < kept.count() < len(docs)
    assert {r.score for r in quality.quality(df, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(df.limit(0), labels).count() == 0


def test_context_sums_match_brute_force():
    texts = ["a b c, d! a", "", "x", "a b a b"]
    column = pa.array(texts, pa.large_string())
    total = np.zeros(quality.BUCKETS * quality.DIMENSIONS, np.int64)
    quality.count_contexts(pa.RecordBatch.from_arrays([column], ["text"]), total)
    place, sign = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIMENSIONS), np.int64)
    bucket, offsets = quality.token_buckets(column)
    for a, b in zip(offsets, offsets[1:]):
        for i in range(a, b):
            for j in range(max(a, i - quality.WINDOW), min(b, i + quality.WINDOW + 1)):
                if i != j:
                    for k in range(quality.NONZERO):
                        want[bucket[i], place[bucket[j], k]] += sign[bucket[j], k]
    assert (total.reshape(want.shape) == want).all()


def test_quality_scores_match_brute_force(spark):
    """Pooling and network, number by number; the sample pooled in tasks gives the same fit."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    texts = [None, "", "one", "a b c, d! a", "déjà vu 東京 x", "w " * 40_000]
    column = pa.array([t or "" for t in texts], pa.large_string())
    bucket, offsets = quality.token_buckets(column)
    want = []
    for a, b in zip(offsets, offsets[1:]):
        v = [vectors[k].astype(float) for k in bucket[a:b]]
        mean = [sum(c) / len(v) for c in zip(*v)] if v else [0.0] * quality.DIMENSIONS
        off = [max(sum(x * x for x in c) / len(v) - m * m, 0) ** 0.5 for c, m in zip(zip(*v), mean)] \
            if v else [0.0] * quality.DIMENSIONS
        want.append(mean + off + [np.log1p(b - a)])
    got = quality.pooled(column, vectors)
    assert np.allclose(got, want, atol=1e-3)     # squares are taken in 32 bits

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    rows = quality.labelled_rows(docs, labels, "quality", 1_000_003, 7, 10)
    x, y = quality.pooled_sample(rows, vectors, 10)
    assert sorted(map(tuple, np.round(x, 6))) == sorted(map(tuple, np.round(got, 6)))
    assert sorted(y) == [0, 0, 0, 1, 1, 1]
    net = quality.fit(x, y, vectors)
    w1, b1, w2, b2 = net.layers
    for score, row in zip(net.scores(column), got):
        h = np.tanh(((row - net.center) / net.scale) @ w1 + b1)
        z = ((h * w2).sum() + b2[0]) / net.temperature
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9
    assert quality.pooled_sample(rows.limit(0), vectors, 10)[0].shape == (0, 2 * quality.DIMENSIONS + 1)


PAGE = ("<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>"
        "<nav><a href='/'>home</a></nav><header>Site</header>{notice}<div class=\"ad\">buy</div>"
        "<article><h1>Head &amp; line</h1><p>First <b>bold</b>\n text.<br>More<p>Second &lt;3 {i}"
        "<div class='comments'>reader says</div></article><aside>side</aside><footer>&copy; me</footer>")


def test_extract_reads_the_article():
    text = wrapper.extract(PAGE.format(notice="", i=1))
    assert text == "Head & line\n\nFirst bold text. More\n\nSecond <3 1"
    assert wrapper.extract(None) == wrapper.extract("") == wrapper.extract("<nav>x</nav>") == ""
    assert wrapper.extract("plain &eacute; words") == "plain é words"
    assert wrapper.extract("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\n\nb\n\nc\n\nd"
    assert wrapper.extract("<p>cut <b>off &am") == "cut off &am"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert wrapper.extract(deep) == "deep"


def _brute_match(a, b):
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[2]) + 1) for _ in range(len(a[2]) + 1)]
    for i, x in enumerate(a[2], 1):
        for j, y in enumerate(b[2], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + _brute_match(x, y))
    return m[-1][-1] + 1


def test_simple_tree_matching_size_and_order():
    rng = random.Random(6)

    def tree(d):
        return [rng.choice("abc"), 0, [tree(d - 1) for _ in range(rng.randint(0, 3))] if d else []]
    for _ in range(60):
        a, b = tree(3), tree(3)
        b[0] = a[0]
        pairs = wrapper.match(a, b)
        assert len(pairs) == _brute_match(a, b)
        left, right = zip(*sorted(pairs))
        assert list(right) == sorted(right) and len(set(left)) == len(left)


def test_wrapper_drops_what_all_pages_of_a_host_share(spark):
    body = "<html><body><div><p>Everything here is by us.</p></div><div><p>story {0} one</p><p>story {0} two</p></div></body>"
    rows = [(i, f"https://a.example/{i}", body.format(i)) for i in range(8)]
    rows += [(100 + i, f"https://b.example/{i}", PAGE.format(notice="<div><p>We moved!</p></div>", i=i)) for i in range(5)]
    rows += [(200, "https://lone.example/", body.format(7)), (201, None, body.format(8)), (202, "https://a.example/x", None),
             (0, "https://a.example/0", body.format(0))]
    df = spark.createDataFrame([(u, i, h, "t") for i, u, h in rows], "url string, page_id long, html string, text string")
    got = wrapper.main_text(df).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[3] == "story 3 one\n\nstory 3 two"
    assert text[102] == "Head & line\n\nFirst bold text. More\n\nSecond <3 2"
    assert text[200] == "Everything here is by us.\n\nstory 7 one\n\nstory 7 two"
    assert text[201].startswith("Everything") and text[202] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert wrapper.main_text(df.limit(0)).count() == 0


def test_wrapper_drops_boxes_inside_articles_and_knows_layouts(spark):
    story = ("<html><body><div class='w1'><article id='post-{0}'><h1>Title {0}</h1><p>Told by us.</p>"
             "<div class='k7'><p>Join our <b>list</b>!</p></div><div><p>story {0} one</p></div>{1}"
             "<p class='z9'>Pass it on.</p></article></div></body></html>")
    video = ("<html><body><div class='v2'><main><div>Clip {0}</div><div class='q4'>Watch more</div>"
             "<p>about {0}</p></main></div></body></html>")
    more = lambda i: "".join(f"<div><p>part {i} {k}</p></div>" for k in range(i % 3))
    rows = [(i, f"https://a.example/{i}", story.format(i, more(i))) for i in range(7)]
    rows += [(100 + i, f"https://a.example/v{i}", video.format(i)) for i in range(4)]
    # Copies of one article under other surroundings are no evidence.
    copy = "<html><body><p>{0}</p><article><h1>One</h1><div><p>same text</p></div></article></body></html>"
    rows += [(200 + i, f"https://c.example/{i}", copy.format(i)) for i in range(5)]
    df = spark.createDataFrame([(i, u, h) for i, u, h in rows], "page_id long, url string, html string")
    text = {r.page_id: r.text for r in wrapper.main_text(df).collect()}
    for i in range(7):
        assert text[i].split("\n\n") == [f"Title {i}", "Told by us.", f"story {i} one"] + [
            f"part {i} {k}" for k in range(i % 3)]
    assert [text[100 + i] for i in range(4)] == [f"Clip {i}\n\nabout {i}" for i in range(4)]
    assert {text[200 + i] for i in range(5)} == {"One\n\nsame text"}


def test_class_words_do_not_cut_the_article():
    article = "<h1>Head</h1><p>Long enough a story to outweigh the rest.</p>"
    for page in ("<div class='layout has-sidebar'><article>{0}</article><div class='sidebar'>links</div></div><div>tail</div>",
                 "<article class='post comment-open'>{0}<div class='share'>send</div></article>",
                 "<div id='social-page'><div class='header-wide'><main class='with-related'>{0}</main></div></div>",
                 "<article>{0}</article><div class='comments'><article>" + "reader says " * 30 + "</article></div>",
                 "<div class='page with-sidebar'>{0}<div class='ad'>buy</div></div>",
                 "<div class='widget'><div class='promo'>{0}</div></div>"):
        assert wrapper.extract(page.format(article)) == "Head\n\nLong enough a story to outweigh the rest."
    comments = "<div>{0}</div><div class='comments'><article>reader</article><article>says</article></div>"
    assert wrapper.extract(comments.format(article)) == "Head\n\nLong enough a story to outweigh the rest."
    assert wrapper.extract("<div class='notice'>closed</div><nav>home</nav>") == "closed"
