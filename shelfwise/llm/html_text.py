"""Main text of web pages by wrapper induction over each host's pages.

Every page's DOM tree, with neighbouring siblings of one label folded into one slot, is merged into its host's tree
by simple tree matching: two children match when their labels are equal and the order-preserving matching with most
matched nodes pairs them. A slot whose text is the same on all the host's pages is template, a slot whose text varies
is content. Copies of a page count once: a slot keeps a few digests of the whole pages that show it, so only pages that
differ elsewhere make it template. Partitions merge their own pages first, so the shuffle carries one small tree per
partition and host, and a host with a third of all pages is merged in two steps.

Extraction drops template slots and the elements that are no article by their meaning: menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments. Where a page marks its article, only that counts,
and inside it classes, ids and roles speak only as whole names of known widgets.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import durable

#: Different pages of a host that must show a slot before its constant text counts as template.
LEAST_PAGES = 8
#: Trees of so many bytes in all go to every executor; more are joined by shuffle.
BROADCAST_BYTES = 32 << 20
SALTS = 64

#: Element names by what they do in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
NO_ARTICLE = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title".split()
)
#: Names of classes, ids and roles for what is no article.
NO_ARTICLE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent notice popup modal newsletter subscribe share sharing "
    "social related comment comments discussion disqus respond reviews complementary contentinfo".split()
)
#: Whole names of widgets that stand inside articles; words that may name a part of the article are left out.
WIDGET_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle banner promo ad-slot ad-container ad-wrapper ad-unit ad-banner banner-ad "
    "sponsored sponsored-content nav navbar navigation breadcrumb breadcrumbs sidebar widget cookie-notice cookie-banner "
    "cookie-consent cookie-bar popup modal newsletter newsletter-signup newsletter-form newsletter-box subscribe subscribe-form "
    "subscribe-box share sharing share-buttons share-bar share-links share-tools sharedaddy addthis_toolbox social social-share "
    "social-links social-icons social-buttons social-media related related-posts related-articles related-links related-content "
    "comment comments comment-list comment-form comments-area comment-respond disqus disqus_thread complementary contentinfo".split()
)
#: Elements whose id names their subject, as the target of a link to it.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
PAGE_HEADERS = frozenset({"header", "masthead", "topbar", "site-header", "page-header"})

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)(?:>|\Z|(?=<))|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def excluded(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NO_ARTICLE or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main", "article") or not attributes:
        return False
    for kind, quoted, single, bare in NAMED.findall(attributes):
        if tag in TITLED and kind.lower() == "id":
            continue
        for name in (quoted or single or bare).lower().split():
            if in_article:
                if name in WIDGET_NAMES:
                    return True
                continue
            ends = re.split(r"[-_]+", name)
            if name in NO_ARTICLE_NAMES or ends[0] in NO_ARTICLE_NAMES or ends[-1] in NO_ARTICLE_NAMES - {"aside", "related", "reviews"}:
                return True
            if name in PAGE_HEADERS:
                return True
    return False


class Node:
    __slots__ = ("label", "kids", "texts")

    def __init__(self, label: str):
        self.label, self.kids, self.texts = label, [], []


def walk(page: str):
    """``("open", tag, excluded, in article)``, ``("close", tag)``, ``("text", text)`` and ``("break",)`` in page order.

    Ends of elements that the page leaves out are supplied, so opens and closes always pair.
    """
    stack: list[str] = []
    articles = 0
    at, end = 0, len(page)
    match = TAG.search(page)
    while at < end:
        start = match.start() if match else end
        if start > at:
            yield "text", page[at:start]
        if match is None:
            break
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if tag and (match[1] or match[4]):
            if tag in stack:
                while True:
                    last = stack.pop()
                    articles -= last in ("article", "main")
                    yield "close", last
                    if last == tag:
                        break
        elif tag in VOID:
            if tag in ("br", "hr"):
                yield ("break",)
        elif tag:
            shuts = SELF_CLOSING.get(tag, set()) | ({"p"} if tag in BLOCK else set())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] in shuts:
                    while len(stack) > depth:
                        yield "close", stack.pop()
                    break
                if stack[depth] in BLOCK and stack[depth] not in shuts:
                    break
            stack.append(tag)
            yield "open", tag, excluded(tag, match[3] or match[6] or "", articles > 0), articles > 0
            articles += tag in ("article", "main")
            if tag in RAW:
                shut = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
                at = shut.start() if shut else end
        match = TAG.search(page, at)
    while stack:
        yield "close", stack.pop()


def words(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def tree_of(page: str) -> list:
    """The folded tree ``[label, pages, text digest, varies, kids, seen]``; a label is a tag, marked where it is excluded.

    ``seen`` of a slot with text holds the digest of the whole page: its tags and the texts of all its slots.
    """
    root = Node("#")
    path, skip = [root], 0
    for event in walk(page):
        if event[0] == "open":
            if not skip:
                node = Node(event[1] + "!" * event[2])
                path[-1].kids.append(node)
                path.append(node)
            skip += bool(skip or event[2])
        elif event[0] == "close":
            if skip:
                skip -= 1
            if not skip:
                path.pop()
        elif event[0] == "text" and not skip:
            path[-1].texts.append(event[1])
    return _stamped(_folded(root))


def _stamped(tree: list) -> list:
    page = hashlib.md5(dumped(tree).encode()).hexdigest()[:12]
    waiting = [tree]
    while waiting:
        node = waiting.pop()
        if node[2]:
            node[5] = [page]
        waiting += node[4]
    return tree


def dumped(tree: list) -> str:
    """A tree as JSON of any depth: its nodes in page order, each behind its depth."""
    out, waiting = [], [(0, tree)]
    while waiting:
        depth, node = waiting.pop()
        out.append([depth, *node[:4], node[5]])
        waiting += [(depth + 1, kid) for kid in reversed(node[4])]
    return json.dumps(out, separators=(",", ":"))


def loaded(text: str) -> list:
    path: list[list] = []
    for depth, label, pages, digest, varies, seen in json.loads(text):
        node = [label, pages, digest, varies, [], seen]
        del path[depth:]
        if path:
            path[-1][4].append(node)
        path.append(node)
    return path[0]


def _folded(root: Node) -> list:
    """The tree with neighbouring siblings of one label joined; the open nodes are a list, not calls."""
    open_nodes, kids = [(root, iter(root.kids))], [[]]
    while True:
        node, rest = open_nodes[-1]
        kid = next(rest, None)
        if kid is not None:
            open_nodes.append((kid, iter(kid.kids)))
            kids.append([])
            continue
        open_nodes.pop()
        text = words(" ".join(node.texts))
        tree = [node.label, 1, hashlib.md5(text.encode()).hexdigest()[:12] if text else "", False, kids.pop(), []]
        if not open_nodes:
            return tree
        if kids[-1] and kids[-1][-1][0] == tree[0]:
            kids[-1][-1] = merge(kids[-1][-1], tree, fold=True)
        else:
            kids[-1].append(tree)


class Matching:
    """Simple tree matching: the most nodes that can be paired, parents before children and in order; each pair of subtrees
    is worked out once, children first."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, int], int] = {}

    def same(self, a: list, b: list) -> int:
        if a[0] != b[0]:
            return 0
        waiting = [(a, b)]
        while waiting:
            x, y = waiting[-1]
            if (id(x), id(y)) in self.known:
                waiting.pop()
                continue
            missing = [(p, q) for p in x[4] for q in y[4] if p[0] == q[0] and (id(p), id(q)) not in self.known]
            if missing:
                waiting += missing
            else:
                waiting.pop()
                self.known[id(x), id(y)] = 1 + self.table(x[4], y[4])[-1][-1]
        return self.known[id(a), id(b)]

    def table(self, left: list, right: list) -> list[list[int]]:
        table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + self.same(a, b))
        return table


def _aligned(left: list, right: list):
    """Pairs of matched children and single children, in an order both sides allow; equal ends are matched as they are."""
    names = [k[0] for k in left], [k[0] for k in right]
    most = min(map(len, names))
    head = next((k for k in range(most) if names[0][k] != names[1][k]), most)
    tail = next((k for k in range(most - head) if names[0][-1 - k] != names[1][-1 - k]), most - head)
    ends = list(zip(left[:head], right[:head], strict=True)), list(zip(left[len(left) - tail :], right[len(right) - tail :], strict=True))
    left, right = left[head : len(left) - tail], right[head : len(right) - tail]
    matching, out = Matching(), []
    table, i, j = matching.table(left, right), len(left), len(right)
    while i or j:
        pair = matching.same(left[i - 1], right[j - 1]) if i and j else 0
        if pair and table[i][j] == table[i - 1][j - 1] + pair:
            i, j = i - 1, j - 1
            out.append((left[i], right[j]))
        elif i and table[i][j] == table[i - 1][j]:
            i -= 1
            out.append((left[i], None))
        else:
            j -= 1
            out.append((None, right[j]))
    return [*ends[0], *out[::-1], *ends[1]]


def merge(a: list, b: list, fold: bool = False) -> list:
    """Two trees with one root label as one. ``fold`` joins siblings of one page, whose texts form one slot."""
    top: list = [None]
    waiting = [(a, b, top, 0)]
    while waiting:
        x, y, place, at = waiting.pop()
        kids: list = []
        for p, q in _aligned(x[4], y[4]):
            if p and q:
                waiting.append((p, q, kids, len(kids)))
            kids.append(p or q)
        if fold:
            text = hashlib.md5((x[2] + y[2]).encode()).hexdigest()[:12] if x[2] or y[2] else ""
            place[at] = [x[0], 1, text, False, kids, []]
        else:
            varies = x[3] or y[3] or x[2] != y[2]
            place[at] = [x[0], x[1] + y[1], x[2], varies, kids, [] if varies else sorted({*x[5], *y[5]})[:LEAST_PAGES]]
    return top[0]


def step(path: int, label: str) -> int:
    """The number of the path one label further down; a path is as long as its number however deep it leads."""
    return xxhash.xxh3_64_intdigest(f"{path}/{label}")


def template_paths(tree: list, least: int = LEAST_PAGES) -> set[int]:
    """Paths of slots that are template wherever the path leads: same text on all of at least ``least`` different pages."""
    constant: dict[int, bool] = {}
    waiting = [(tree, step(0, tree[0]))]
    while waiting:
        node, path = waiting.pop()
        if node[2] or node[3]:
            constant[path] = constant.get(path, True) and not node[3] and len(node[5]) >= least
        waiting += [(kid, step(path, kid[0])) for kid in node[4]]
    return {path for path, same in constant.items() if same}


def main_text(page: str, template: set[int] = frozenset()) -> str:
    """The page's article: blocks in page order, one to a line, white space inside a block as one space."""
    blocks: list[str] = []
    marked: list[str] = []
    held: list[str] = []
    skip, articles, path = 0, 0, [step(0, "#")]

    def flush() -> None:
        text = words("".join(held))
        held.clear()
        if text:
            (marked if articles else blocks).append(text)

    found = False
    for event in walk(page):
        if event[0] == "open":
            if event[1] in BLOCK:
                flush()
            skip += bool(skip or event[2])
            path.append(step(path[-1], event[1] + "!" * event[2]))
            if event[1] in ("article", "main"):
                articles += 1
                found = found or not skip
        elif event[0] == "close":
            if event[1] in BLOCK:
                flush()
            skip -= bool(skip)
            path.pop()
            articles -= event[1] in ("article", "main")
        elif event[0] == "break":
            held.append(" ")
        elif not skip and path[-1] not in template:
            held.append(event[1])
    flush()
    return "\n".join(marked if found else blocks)


def _merged(trees) -> str:
    whole = None
    for tree in trees:
        whole = tree if whole is None else merge(whole, tree)
    return dumped(whole)


def induce(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``(host, tree)``: one merged tree for every host, over all its pages."""

    def local(batches):
        trees: dict[str, list] = {}
        salt = TaskContext.get().partitionId() % SALTS
        for batch in batches:
            for host, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tree = tree_of(body)
                trees[host] = merge(trees[host], tree) if host in trees else tree
        rows = [(host, salt, _merged([tree])) for host, tree in trees.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string()), strict=True)], ["host", "salt", "tree"]
        )

    def together(table: pa.Table) -> pa.Table:
        tree = _merged(map(loaded, table["tree"].to_pylist()))
        return pa.table({n: table[n][:1] if n != "tree" else pa.array([tree]) for n in table.column_names})

    rows = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    partial = rows.mapInArrow(local, "host string, salt int, tree string")
    salted = partial.groupBy("host", "salt").applyInArrow(together, "host string, salt int, tree string")
    return salted.select("host", "tree").groupBy("host").applyInArrow(together, "host string, tree string")


def host_of(url):
    """The host in lower case; pages without one share the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row for each row of ``pages``.

    Null or empty html gives an empty text; a null url stays null and its page shares the wrapper of pages without a
    host. Repeated rows are repeated. Text is decoded once; broken markup is closed where the next element or the end
    of the page requires it. Trees
    of any depth are walked without recursion.
    """
    trees = durable(induce(pages, url, page))
    if (trees.agg(F.sum(F.length("tree"))).first()[0] or 0) <= BROADCAST_BYTES:
        trees = F.broadcast(trees)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"), host_of(F.col(url)).alias("host"),
    ).join(trees, "host", "left")

    def read(batches):
        paths: dict[str | None, set[int]] = {None: set()}
        for batch in batches:
            texts = []
            for body, tree in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if tree not in paths:
                    if len(paths) > 10_000:
                        paths = {None: set()}
                    paths[tree] = template_paths(loaded(tree))
                texts.append(main_text(body, paths[tree]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.select("page_id", "url", "html", "tree").mapInArrow(read, "page_id long, url string, text string, n_chars long")
