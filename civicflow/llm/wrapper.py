"""Operator 7: main text of web pages by wrapper induction.

1. A page is parsed into a tree.  Elements that are no article by their kind
   (menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
   styles, comments) are cut off.
2. The rest's skeleton (containers and blocks, each with its label and a hash
   of its text) is aligned with that of one reference page of the host and
   layout by simple tree matching, the largest order-preserving matching of
   equally labelled nodes and, of these, one with most equal texts.  A layout is
   the containers around the article; one with fewer than ``LEAST_PAGES``
   distinct pages takes the reference and counts of the whole host.
3. Per node of the reference, matches and matches with equal text are counted
   over all distinct skeletons.  A node that is equal in at least ``CONSTANT``
   of ``LEAST_PAGES`` or more is template; the others are slots.  Inside an
   article only boxes are nodes: containers, and blocks with a class or id
   that no sibling has.  Plain paragraphs that pages share stay, and so does
   what two copies of one article share.
4. Each page is aligned with its wrapper and loses the template nodes; the
   blocks of the article (or main part, or body) are its text.

Counts are sums per (host, layout, node), so a host may hold any share of the
pages; a wrapper is one small row, and only those that have template nodes are
kept.  That table is joined to the pages, without a hint.

Edge cases: null or empty html gives the empty text; a page without article
and main part is read from its body; a word of a class or id does not cut what
is or holds the article (see ``_spare``); if the template would leave a page
without text, the page is read without it, and if the class words would,
without them; null urls have no host and no
wrapper; unclosed and cut-off pages are read as far as they go; repeated rows
are kept; an empty table gives no row.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import prepare, slices, staged

CONSTANT = 0.9
LEAST_PAGES = 3
#: Share of a page's text that no word of a class cuts off.
MOST = 0.75
#: Nesting of blocks that the skeleton follows.
DEPTH = 60
SCHEMA = "page_id long, url string, text string, n_chars long"

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("body div section article main table ul ol dl figure blockquote details".split())
SKIPPED = frozenset(
    "head script style noscript template title nav footer aside form button select option "
    "textarea input iframe svg canvas dialog menu object audio video".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                          "alertdialog menu menubar toolbar".split())
SKIPPED_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter "
    "notice notification paywall popup promo promoted promotion related respond share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Start tags that end an open element of the same group.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"\d+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"


class Node:
    """An element; ``worded`` if only a word of its class or id cuts it."""

    __slots__ = ("tag", "label", "skipped", "worded", "children")

    def __init__(self, tag: str, label: str, skipped: bool, worded: bool = False):
        self.tag, self.label, self.children = tag, label, []
        self.skipped, self.worded = skipped or worded, worded and not skipped


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTR.findall(text)}


def _node(tag: str, attributes: str, in_article: bool) -> Node:
    label, skipped, worded = tag, tag in SKIPPED or tag == "header" and not in_article, False
    if attributes.strip(" /\n\t\r"):
        a = _attributes(attributes)
        names = f"{a.get('class', '')} {a.get('id', '')}".lower().strip()
        if names:
            # Numbers in ids and classes differ from page to page.
            label = tag if tag in ("body", "article", "main") else f"{tag}.{_DIGITS.sub('0', names)}"
            words = set(_SPLIT.split(names))
            worded = tag not in ("body", "html") and (
                bool(words & SKIPPED_WORDS) or not in_article and bool(words & HEADER_WORDS))
        style = a.get("style", "").replace(" ", "").lower()
        skipped = (skipped or a.get("role", "").lower() in SKIPPED_ROLES or "hidden" in a
                   or a.get("aria-hidden", "").lower() == "true" or "display:none" in style
                   or "visibility:hidden" in style)
    return Node(tag, label, skipped, worded)


def parse(html: str) -> Node:
    """The page's tree; children are nodes and pieces of undecoded text."""
    root = Node("html", "html", False)
    stack = [root]
    articles, at, n = 0, 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    articles -= sum(x.tag in ("article", "main") for x in stack[i:])
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "main", "td", "th") and tag not in BLOCK:
                    break
            continue
        if tag == "html":
            continue
        if tag in BLOCK or tag in ENDS:
            # A block ends an open paragraph, an item the item before it.
            ends = ENDS.get(tag, ()) + ("p",)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    if tag not in ENDS:
                        break
                elif stack[i].tag in CONTAINER or stack[i].tag in ("td", "th", "li") and tag not in ENDS:
                    break
        node = _node(tag, m[3], articles > 0)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            articles += tag in ("article", "main")
    _spare(root)
    return root


def _spare(page: Node) -> None:
    """Takes back cuts by a class word of elements that are or hold the page's article or most of its text.

    These are all that are or hold a main part; without one, those that are or
    hold the first article, if it outweighs all text that is not cut (a comment
    or teaser after the article does not); else, on a page that keeps no
    article, those with more than ``MOST`` of its text."""
    order: list[tuple[Node, int]] = []       # nodes that are not cut by kind, with their parent's number
    stack = [(page, -1)]
    while stack:
        x, parent = stack.pop()
        order.append((x, parent))
        stack += [(c, len(order) - 1) for c in reversed(x.children)
                  if isinstance(c, Node) and (c.worded or not c.skipped)]
    if not any(x.worded for x, _ in order):
        return
    size = [sum(len(c.strip()) for c in x.children if isinstance(c, str)) for x, _ in order]
    cut = [False] * len(order)               # below or at an element cut by a word
    for i, (x, parent) in enumerate(order):
        cut[i] = x.worded or parent >= 0 and cut[parent]
    for i in range(len(order) - 1, 0, -1):
        size[order[i][1]] += size[i]

    def around(i: int) -> Iterator[int]:
        while i >= 0:
            if order[i][0].worded:
                yield i
            i = order[i][1]

    kept = sum(len(c.strip()) for (x, _), off in zip(order, cut) if not off
               for c in x.children if isinstance(c, str))
    mains = [i for i, (x, _) in enumerate(order) if x.tag == "main"]
    articles = [i for i, (x, _) in enumerate(order) if x.tag == "article"]
    spared = {j for i in mains for j in around(i)}
    if articles and not mains and size[articles[0]] > kept:
        spared.update(around(articles[0]))
    if not spared and all(cut[i] for i in mains + articles):
        spared.update(i for i, (x, _) in enumerate(order) if x.worded and size[i] > MOST * size[0])
    for i in spared:
        order[i][0].skipped = order[i][0].worded = False


def _find(node: Node, tag: str) -> list[Node]:
    """The outermost elements of a kind, in page order."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if x.tag == tag and x is not node:
            out.append(x)
        else:
            stack += [c for c in reversed(x.children) if isinstance(c, Node) and not c.skipped]
    return out


def roots(page: Node) -> list[Node]:
    """The main part, else the articles, else the page."""
    return _find(page, "main") or _find(page, "article") or [page]


def blocks(node: Node, template: set[int]) -> list[str]:
    """Texts of the blocks below ``node``, without cut-off and template nodes."""
    out: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(piece)).split())
        piece.clear()
        if text:
            out.append(text)

    stack = [(node, iter(node.children))]
    while stack:
        parent, rest = stack[-1]
        for c in rest:
            if not isinstance(c, Node):
                piece.append(c)
            elif c.tag == "br":
                piece.append(" ")
            elif not c.skipped and id(c) not in template:
                if c.tag in BLOCK:
                    flush()
                stack.append((c, iter(c.children)))
                break
            elif c.tag in BLOCK:
                flush()
        else:
            stack.pop()
            if parent.tag in BLOCK:
                flush()
    flush()
    return out


def _inner(node: Node, boxes: bool = False) -> Iterator[Node | str]:
    """Texts and outermost blocks (of an article: boxes) below ``node``, in page order."""
    def once(x: Node) -> set[str]:
        labels = [c.label for c in x.children if isinstance(c, Node)] if boxes else []
        return {k for k, n in Counter(labels).items() if n == 1 and "." in k}

    stack = [(iter(node.children), once(node))]
    while stack:
        rest, single = stack[-1]
        for c in rest:
            if not isinstance(c, Node):
                yield c
            elif not c.skipped:
                if c.tag in BLOCK and (not boxes or c.tag in CONTAINER or c.label in single):
                    yield c
                else:
                    stack.append((iter(c.children), once(c)))
                    break
        else:
            stack.pop()


def skeleton(page: Node) -> tuple[list, list[Node]]:
    """[label, text hash, children] of containers and blocks, and the nodes in pre-order.

    Inside an article only boxes are nodes.  What lies deeper than ``DEPTH`` blocks is one node."""
    nodes: list[Node] = []

    def build(node: Node, depth: int, boxes: bool) -> list:
        nodes.append(node)
        own: list = [node.label, 0, []]
        if depth == DEPTH:
            own[1] = zlib.crc32("\n".join(blocks(node, set())).encode("utf-8", "replace"))
            return own
        boxes = boxes or node.tag in ("article", "main")
        for c in _inner(node, boxes):
            if isinstance(c, Node):
                own[2].append(build(c, depth + 1, boxes))
                own[1] = zlib.crc32(own[2][-1][1].to_bytes(4, "little"), own[1])
            elif text := " ".join(c.split()):
                own[1] = zlib.crc32(text.encode("utf-8", "replace"), own[1])
        return own
    return build(page, 0, False), nodes


def layout(page: Node) -> int:
    """Hash of the labels around the main part or article, else of the page's labelled outer blocks."""
    for tag in ("main", "article"):
        stack = [(page, ())]
        while stack:
            x, path = stack.pop()
            if x.tag == tag:
                return zlib.crc32("/".join(path).encode("utf-8", "replace"))
            if len(path) < DEPTH:
                path += (x.label,)
                stack += [(c, path) for c in reversed(x.children) if isinstance(c, Node) and not c.skipped]
    outer = [c for c in _inner(page) if isinstance(c, Node)]
    outer += [c for x in outer if x.tag == "body" for c in _inner(x) if isinstance(c, Node)]
    return zlib.crc32("|".join(sorted({c.label for c in outer if "." in c.label})).encode("utf-8", "replace"))


#: A matched node weighs more than any number of equal texts.
_NODE = 1 << 24


def match(left: list, right: list) -> list[tuple[int, int]]:
    """Simple tree matching: pairs of pre-order numbers of the largest matching of equal labels.

    Of the largest matchings it is one with most equal texts."""
    def numbered(tree: list, at: int) -> tuple[tuple, int]:
        number, children = at, []
        at += 1
        for c in tree[2]:
            child, at = numbered(c, at)
            children.append(child)
        return (tree[0], number, children, tree[1]), at

    def best(a: tuple, b: tuple) -> tuple[int, list]:
        m, n = len(a[2]), len(b[2])
        score = [[0] * (n + 1) for _ in range(m + 1)]
        pairs: dict[tuple[int, int], tuple[int, list]] = {}
        for i, x in enumerate(a[2], 1):
            above, row, left = score[i - 1], score[i], 0
            for j, y in enumerate(b[2], 1):
                if left < above[j]:
                    left = above[j]
                if x[0] == y[0]:
                    if x[2] and y[2]:
                        w = pairs[i, j] = best(x, y)
                        w = w[0]
                    else:
                        w = _NODE + (x[3] == y[3])
                    if left < above[j - 1] + w:
                        left = above[j - 1] + w
                row[j] = left
        found, i, j = [(a[1], b[1])], m, n
        while i and j:
            if score[i][j] == score[i - 1][j]:
                i -= 1
            elif score[i][j] == score[i][j - 1]:
                j -= 1
            else:
                x, y = a[2][i - 1], b[2][j - 1]
                found += pairs[i, j][1] if x[2] and y[2] else [(x[1], y[1])]
                i, j = i - 1, j - 1
        return score[m][n] + _NODE + (a[3] == b[3]), found
    if left[0] != right[0]:
        return []
    return best(numbered(left, 0)[0], numbered(right, 0)[0])[1]


def _flat(tree: list) -> list[list]:
    out = [tree]
    for c in tree[2]:
        out += _flat(c)
    return out


def extract(html: str | None, wrapper: str | None = None, constant: list[int] | None = None) -> str:
    """Main text of a page, given its layout's reference skeleton and template nodes, if any."""
    page = parse(html or "")
    template: set[int] = set()
    if wrapper:
        own, nodes = skeleton(page)
        chosen = set(constant)
        template = {id(nodes[i]) for i, j in match(own, json.loads(wrapper))
                    if j in chosen and nodes[i].tag not in ("article", "main")}
    read = lambda cut: "\n\n".join(b for r in roots(page) for b in blocks(r, cut))
    text = read(template)
    if not text and template:
        text = read(set())
    if not text and html:
        stack: list = [page]
        while stack:
            x = stack.pop()
            if x.worded:
                x.skipped = x.worded = False
            stack += [c for c in x.children if isinstance(c, Node)]
        text = read(set())
    return text


def _skeletons(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "html"):
            out = []
            for html in part.column(2).to_pylist():
                page = parse(html or "")
                out.append((layout(page), json.dumps(skeleton(page)[0], separators=(",", ":"))))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.string())], ["h", "host", "layout", "tree"])


def _inside_copies(tree: list, pairs: list[tuple[int, int]], a: list[list], b: list[list]) -> set[int]:
    """Pre-order numbers of the nodes of ``tree`` inside articles whose whole text equals the reference's."""
    equal = {i for i, j in pairs if a[i][0] in ("article", "main") and a[i][1] == b[j][1]}
    out: set[int] = set()
    for i in equal:
        out.update(range(i + 1, i + len(_flat(a[i]))))
    return out


def _aligned(batches: Iterator[pa.RecordBatch]):
    """(host, layout, node, pages, equal) of each batch's alignments with the reference."""
    for batch in batches:
        found: dict[tuple[str, int, int], list[int]] = {}
        parsed: dict[str, list] = {}
        for host, kind, tree, reference in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if reference not in parsed:
                parsed[reference] = json.loads(reference)
            ref = parsed[reference]
            own = json.loads(tree)
            a, b = _flat(own), _flat(ref)
            pairs = match(own, ref)
            copies = _inside_copies(own, pairs, a, b) if tree != reference else set()
            for i, j in pairs:
                if i in copies:
                    continue
                n = found.setdefault((host, kind, j), [0, 0])
                n[0] += 1
                n[1] += a[i][1] == b[j][1]
        rows = [(*key, n, e) for key, (n, e) in found.items()]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                         ["host", "kind", "node", "pages", "equal"])


def wrappers(pages: DataFrame) -> DataFrame:
    """host, layout, reference (skeleton), constant (its template nodes) of layouts with template nodes."""
    rows = pages.where("host IS NOT NULL").select(
        F.xxhash64("page_id", "url").alias("h"), "host", F.col("html").cast("string").alias("html"))
    trees = staged(rows.mapInArrow(_skeletons, "h long, host string, layout long, tree string")
                   .groupBy("host", "layout", "tree").agg(F.min("h").alias("h")), "skeletons")
    # Rare layouts are of the kind -1, which covers all pages of the host.
    kinds = (trees.groupBy("host", "layout").agg(F.count("*").alias("n"))
             .select("host", "layout", F.when(F.col("n") >= LEAST_PAGES, F.col("layout"))
                     .otherwise(-1).alias("kind")))
    common = kinds.where("kind >= 0")
    whole = kinds.where("kind < 0").select("host").distinct()
    trees = (trees.join(common, ["host", "layout"]).select("host", "kind", "tree", "h")
             .unionByName(trees.join(whole, "host", "left_semi")
                          .select("host", F.lit(-1).cast("long").alias("kind"), "tree", "h")))
    reference = trees.groupBy("host", "kind").agg(F.min_by("tree", F.struct("h", "tree")).alias("reference"))
    counts = (trees.join(reference, ["host", "kind"]).select("host", "kind", "tree", "reference")
              .mapInArrow(_aligned, "host string, kind long, node int, pages long, equal long")
              .groupBy("host", "kind", "node").agg(F.sum("pages").alias("pages"), F.sum("equal").alias("equal")))
    # Node 0 is the page itself; a reference has few nodes, so a list is small.
    constant = (counts.where((F.col("node") > 0) & (F.col("pages") >= LEAST_PAGES)
                             & (F.col("equal") >= F.col("pages") * CONSTANT))
                .groupBy("host", "kind").agg(F.sort_array(F.collect_list("node")).alias("constant")))
    return staged(constant.join(reference, ["host", "kind"]).join(kinds, ["host", "kind"])
                  .select("host", "layout", "reference", "constant"), "wrappers")


def _layouts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "html"):
            found = [layout(parse(html or "")) for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.int64())],
                                             [*part.schema.names, "layout"])


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [extract(*row) for row in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.expr("nullif(lower(regexp_extract(url, '" + _HOST.replace("\\", "\\\\") + "', 1)), '')").alias("host"))
    known = rows.mapInArrow(_layouts, "page_id long, url string, html string, host string, layout long")
    return (known.join(wrappers(rows), ["host", "layout"], "left")
            .select("page_id", "url", "html", "reference", "constant").mapInArrow(_texts, SCHEMA))
