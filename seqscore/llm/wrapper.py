"""Main text of web pages by wrapper induction (op 11).

Pages of one host share templates.  Every page's DOM is reduced to its block
elements (a run of equal siblings such as paragraphs is one node), and the
trees of a host are aligned by simple tree matching: the largest top-down
mapping that keeps the order of siblings, found by dynamic programming over
the children of matched nodes.  Aligned nodes become one node of the host's
wrapper, others are inserted beside their left neighbours.

A text that stays constant in one node over the host's pages is template, what
varies is content.  Of the varying nodes, those remain that are no menus,
headers, footers, sidebars, notices, adverts, forms or comments by their
element, role or class, and that don't consist of links.

Equal trees of a host are one before they are aligned, and wrappers are merged
in rounds of bounded groups, so neither a large host nor many copies of a page
gather in one task.  Constant texts are counted by partial aggregation.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_path

# A text is template if so many differently titled pages of a host, and at
# least this share of them, hold it in the same node.
CONSTANT_PAGES, CONSTANT_SHARE = 3, 0.6
# A node of whose text more than this lies in links is a menu.
LINK_SHARE = 0.6
# Pages with this share of their candidate text in main or article elements
# keep to these.
ARTICLE_SHARE = 0.4
# Of several articles of a page, those count with this share of the longest's text.
TEASER_SHARE = 0.2
# Nodes below this depth count as children of their ancestor there.
MAX_DEPTH = 60
MERGED_AT_ONCE = 64

# FIXED VALUES of HTML: elements that start a block, that have no end tag,
# whose content is no markup, that repeat beside each other, and that never
# hold article text.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html iframe legend li main menu nav
noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead title
tr ul video audio canvas datalist""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
REPEATED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption".split())
NEVER = frozenset("""head nav aside form footer select button dialog menu fieldset template noscript iframe object svg
video audio canvas datalist dir search""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar"
                  .split())
# Words of class and id names that mark what is no article text; of these, what
# marks a header of the site only outside articles, and readers' comments.
MARKED = frozenset("""menu menus nav navbar navigation subnav breadcrumb breadcrumbs pagination pager toolbar
masthead topbar branding footer colophon copyright sidebar sidebars aside widget widgets rail related recommended
recommendations trending popular cookie cookies consent gdpr notice notices notification banner alert popup modal
overlay newsletter subscribe subscription paywall promo promotion ad ads adv advert adverts advertisement advertising
adsense sponsor sponsored sponsors share sharing social login signin signup search form""".split())
HEADERS = frozenset({"header"})
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
# First words of names that tell what else a page has (has-sidebar).
HAVING = frozenset("has with no without".split())
# Whole class names of hidden elements.
HIDDEN = frozenset("hidden d-none visually-hidden sr-only screen-reader-text".split())
# How a written tree marks a node: left out unless it holds the page's only
# article, left out in any case, left out outside articles.
MARK, MARK_ALWAYS, MARK_OUTSIDE = "!", "~", "^"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NUMBER = re.compile(r"\d+")
_CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
              "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
              "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
              "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
              "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCOPE = frozenset("td th table button caption object template html".split())


class Node:
    """An element of the reduced tree: label, what its names say, children."""

    __slots__ = ("label", "children", "cursor", "number")

    def __init__(self, label: str):
        self.label = label
        self.children: list[Node] = []
        self.cursor = 0
        self.number = -1

    def child(self, label: str, repeated: bool) -> Node:
        """The child for the next element of this label.  A repeated element
        beside its like is the same node; where this node stands for several
        elements, the children of the first are met again in order."""
        if self.cursor and repeated and self.children[self.cursor - 1].label == label:
            node = self.children[self.cursor - 1]
        else:
            for i in range(self.cursor, len(self.children)):
                if self.children[i].label == label:
                    node, self.cursor = self.children[i], i + 1
                    break
            else:
                node = Node(label)
                self.children.insert(self.cursor, node)
                self.cursor += 1
        node.cursor = 0
        return node


@lru_cache(maxsize=20_000)
def _label(tag: str, attributes: str) -> str:
    """Label of an element: its mark, name, classes and id, digits as 0."""
    names, role, hidden = "", "", False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id"):
            names += (" #" if key == "id" else " .") + " ".join(sorted(value.split()))
            hidden = hidden or not HIDDEN.isdisjoint(value.lower().split())
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
        elif key == "itemprop" and value.lower() == "articlebody":
            role = "main"
    words: set[str] = set()
    for name in names.split():
        said = [w.lower() for w in _NAME.findall(name)]
        if said and said[0] not in HAVING:
            words.update(said)
    layout = tag in ("html", "body", "main") or role == "main"
    mark = ""
    if hidden or (not layout and not COMMENTS.isdisjoint(words)):
        mark = MARK_ALWAYS
    elif role in ROLES or (not layout and tag != "article" and not MARKED.isdisjoint(words)):
        mark = MARK
    elif not layout and not HEADERS.isdisjoint(words):
        mark = MARK_OUTSIDE
    name = tag + _NUMBER.sub("0", names) + ("@main" if role == "main" else "")
    return mark + re.sub(r"[\s();]+", " ", name)


def parse(page: str) -> tuple[Node, list[list], str]:
    """Reduced tree, texts in page order as [node, text, characters in links],
    and the page's title.

    Tags needn't be closed or nested properly: a block ends an open paragraph,
    list items and table cells end their like, an end tag without start is
    ignored.  Character references are decoded and white space is one space."""
    root = Node("html")
    stack: list[tuple[str, Node]] = [("html", root)]
    texts: list[list] = []
    title = ""
    parts: list[str] = []
    links: list[str] = []
    anchors = 0

    def text(raw: str) -> None:
        if raw:
            parts.append(raw)
            if anchors:
                links.append(raw)

    def flush() -> None:
        if not parts:
            return
        words = " ".join(html.unescape("".join(parts)).split())
        if words:
            node = stack[-1][1].child("#", True)
            linked = " ".join(html.unescape(" ".join(links)).split()) if links else ""
            texts.append([node, words, min(len(linked), len(words))])
        parts.clear()
        links.clear()

    def pop_to(tags, bounds) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                flush()
                del stack[i:]
                return
            if stack[i][0] in bounds:
                return

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1], m[3]) if m[2] else (m[4], m[6])
        if closing:
            if tag == "a":
                anchors = 0
            elif tag in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag or (tag in _HEADINGS and stack[i][0] in _HEADINGS):
                        flush()
                        del stack[i:]
                        anchors = 0
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else size
            if tag == "title" and not title:
                title = " ".join(html.unescape(page[at:stop]).split())
            close = page.find(">", stop)
            at = size if end is None or close < 0 else close + 1
            continue
        if tag == "br" or tag == "hr" or tag not in BLOCKS:
            if tag == "hr":
                pop_to({"p"}, _SCOPE)
                flush()
            elif tag == "br":
                text(" ")
            elif tag == "a":
                anchors = 1
            continue
        if tag == "html":
            continue
        if tag == "body":
            pop_to({"head"}, set())
        flush()
        if tag in _CLOSED_BY:
            pop_to(*_CLOSED_BY[tag])
        if tag not in ("td", "th", "tr", "option", "caption"):
            pop_to({"p"}, _SCOPE)
        if tag in _HEADINGS and stack[-1][0] in _HEADINGS:
            stack.pop()
        anchors = 0
        if attributes.rstrip().endswith("/") and tag == "svg":
            continue
        parent = stack[-1][1]
        stack.append((tag, parent.child(_label(tag, attributes.strip()), tag in REPEATED)
                      if len(stack) < MAX_DEPTH else parent))
    flush()
    return root, texts, title


def numbered(root: Node) -> str:
    """Number the nodes in preorder and write the tree: ``label(child child)``,
    ``label;`` for a node without children."""
    out: list[str] = []
    count = 0

    def walk(node: Node) -> None:
        nonlocal count
        node.number = count
        count += 1
        out.append(node.label)
        if node.children:
            out.append("(")
            for c in node.children:
                walk(c)
            out.append(")")
        else:
            out.append(";")

    walk(root)
    return "".join(out)


Tree = tuple[str, tuple]
_PART = re.compile(r"[^();]+|[();]")


@lru_cache(maxsize=4096)
def read_tree(written: str) -> Tree:
    """(label, children) of a written tree."""
    stack: list[tuple[str, list]] = [("", [])]
    label = None
    for part in _PART.findall(written):
        if part == "(":
            stack.append((label, []))
            label = None
        elif part == ";":
            stack[-1][1].append((label, ()))
            label = None
        elif part == ")":
            name, children = stack.pop()
            stack[-1][1].append((name, tuple(children)))
        else:
            label = part
    return stack[0][1][0]


def write_tree(tree: Tree) -> str:
    label, children = tree
    return label + ("(" + "".join(map(write_tree, children)) + ")" if children else ";")


class Matching:
    """Simple tree matching of two trees: sizes of largest top-down mappings
    of equal labels that keep the order of siblings."""

    def __init__(self):
        self._size: dict[tuple[Tree, Tree], int] = {}

    def table(self, a: tuple, b: tuple) -> list[list[int]]:
        m = [[0] * (len(b) + 1)]
        for x in a:
            above, row = m[-1], [0]
            for j, y in enumerate(b):
                best = max(above[j + 1], row[j])
                if x[0] == y[0]:
                    best = max(best, above[j] + self.size(x, y))
                row.append(best)
            m.append(row)
        return m

    def size(self, a: Tree, b: Tree) -> int:
        if a[0] != b[0]:
            return 0
        if not a[1] or not b[1]:
            return 1
        key = (a, b)
        if key not in self._size:
            self._size[key] = 1 + self.table(a[1], b[1])[-1][-1]
        return self._size[key]

    def pairs(self, a: tuple, b: tuple) -> list[tuple[int, int]]:
        """Matched positions of two lists of siblings, in order."""
        m = self.table(a, b)
        i, j, out = len(a), len(b), []
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((i, j))
        return out[::-1]


def merge(a: Tree, b: Tree, matching: Matching) -> Tree:
    """The wrapper of two trees of the same label: matched nodes are one, the
    others of ``b`` stand behind their left neighbours' partners."""
    if a == b:
        return a
    children: list[Tree] = []
    i = j = 0
    for x, y in [*matching.pairs(a[1], b[1]), (len(a[1]), len(b[1]))]:
        children += a[1][i:x]
        children += b[1][j:y]
        if x < len(a[1]) and y < len(b[1]):
            children.append(merge(a[1][x], b[1][y], matching))
        i, j = x + 1, y + 1
    return (a[0], tuple(children))


def merge_all(written: list[str]) -> str:
    """One wrapper of several written trees, merged in the order of their text
    from the largest on."""
    trees = [read_tree(w) for w in sorted(set(written), key=lambda w: (-len(w), w))]
    matching = Matching()
    first = trees[0]
    for t in trees[1:]:
        first = merge(first, t, matching)
    return write_tree(first)


def _sizes(tree: Tree) -> int:
    return 1 + sum(map(_sizes, tree[1]))


@lru_cache(maxsize=4096)
def align(written: str, wrapper: str) -> tuple[int, ...]:
    """The wrapper's node (by preorder number) for every node of a tree, -1
    where it has none."""
    matching = Matching()
    out: list[int] = []

    def walk(a: Tree, b: Tree, number: int) -> None:
        out.append(number)
        partner = dict(matching.pairs(a[1], b[1]))
        numbers, n = [], number + 1
        for c in b[1]:
            numbers.append(n)
            n += _sizes(c)
        for i, c in enumerate(a[1]):
            if i in partner:
                walk(c, b[1][partner[i]], numbers[partner[i]])
            else:
                out.extend([-1] * _sizes(c))

    walk(read_tree(written), read_tree(wrapper), 0)
    return tuple(out)


def _tag(label: str) -> str:
    return re.split(r"[ @]", label.lstrip(MARK + MARK_ALWAYS + MARK_OUTSIDE), maxsplit=1)[0]


def _is_article(label: str) -> bool:
    return _tag(label) in ("article", "main") or label.endswith("@main")


def _articles(tree: Tree) -> int:
    """Article and main elements in a tree, but for those of asides, menus,
    footers and comments."""
    label, children = tree
    if label.startswith(MARK_ALWAYS) or _tag(label) in ("aside", "nav", "footer"):
        return 0
    return _is_article(label) + sum(map(_articles, children))


@lru_cache(maxsize=4096)
def roles(written: str) -> tuple[tuple[bool, bool, int], ...]:
    """For every node in preorder: whether its text may be article text, the
    same whatever its class names are (but for comments and hidden elements),
    and the outermost main or article element around it (-1: none)."""
    out: list[tuple[bool, bool, int]] = []
    root = read_tree(written)
    articles = _articles(root)

    def walk(tree: Tree, may: bool, by_tag: bool, inside: int) -> None:
        label = tree[0]
        tag = _tag(label)
        only = articles > 0 and sum(map(_articles, tree[1])) == articles
        by_tag = (by_tag and not label.startswith(MARK_ALWAYS) and not (tag in NEVER and not (tag == "form" and only))
                  and not (tag == "header" and inside < 0))
        left_out = ((label.startswith(MARK) and not only)
                    or (label.startswith(MARK_OUTSIDE) and inside < 0 and not only))
        may = may and by_tag and not left_out
        if inside < 0 and _is_article(label):
            inside = len(out)
        out.append((may, by_tag, inside))
        for c in tree[1]:
            walk(c, may, by_tag, inside)

    walk(root, True, True, -1)
    return tuple(out)


def host_of(url: Column) -> Column:
    """Host name of a URL, lower-case, without user and port; empty if none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _parsed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """(keys, host, html) -> keys, host, tree, title and page hashes, and the
    candidate texts (those whose node may hold article text by its element)
    with their nodes: whole, or as hashes."""
    import xxhash
    signed = lambda b: int.from_bytes(xxhash.xxh64_digest(b), "big", signed=True)
    for batch in batches:
        for lo, hi in _slices(batch.column(batch.num_columns - 1)):
            part = batch.slice(lo, hi - lo)
            rows: list[tuple] = []
            for page in part.column(part.num_columns - 1).to_pylist():
                root, texts, title = parse(page or "")
                tree = numbered(root)
                may = roles(tree)
                texts = [t for t in texts if may[t[0].number][1]]
                raw = (page or "").encode("utf-8", "surrogatepass")
                rows.append((tree, signed(title.encode("utf-8", "surrogatepass") or raw), [t[0].number for t in texts],
                             [t[1] if with_text else signed(t[1].encode("utf-8", "surrogatepass")) for t in texts],
                             [t[2] for t in texts], [len(t[1]) for t in texts]))
            tree, title, nodes, texts, linked, size = zip(*rows, strict=True)
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            names = part.schema.names[:-1]
            cols = [pa.array(tree, pa.string()), pa.array(title, pa.int64()), pa.array(nodes, pa.list_(pa.int32())),
                    pa.array(texts, pa.list_(pa.string() if with_text else pa.int64())),
                    pa.array(linked, pa.list_(pa.int32())), pa.array(size, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept, *cols], names=[*names, *_TREE_COLUMNS])


_TREE_COLUMNS = ["tree", "title", "nodes", "texts", "linked", "size"]
_SLICE_CHARS = 4_000_000


def _slices(pages: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive pages of bounded length, for bounded output."""
    import pyarrow.compute as pc
    held, first = 0, 0
    sizes = pc.fill_null(pc.binary_length(pages), 0).to_pylist()
    for i, n in enumerate(sizes):
        if i > first and held + n > _SLICE_CHARS:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


def _parse(pages: DataFrame, keys: list[str], with_text: bool) -> DataFrame:
    """``pages``: keys, host, html."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    text = "string" if with_text else "bigint"
    made = _parse_datatype_string(f"tree string, title bigint, nodes array<int>, texts array<{text}>, "
                                  "linked array<int>, size array<int>")
    schema = StructType([pages.schema[k] for k in [*keys, "host"]] + made.fields)

    def run(batches):
        yield from _parsed(batches, with_text)

    return pages.select(*keys, "host", "html").mapInArrow(run, schema)


def _wrappers(trees: DataFrame) -> DataFrame:
    """host, wrapper: all different trees of a host merged to one, in rounds:
    each merges groups of about ``MERGED_AT_ONCE`` trees of a host."""
    most = trees.groupBy("host").count().agg(F.max("count").alias("n")).first()["n"] or 1
    rounds = 0
    while MERGED_AT_ONCE ** (rounds + 1) < most:
        rounds += 1
    merged = trees
    for left in range(rounds, -1, -1):
        def run(key, batch):
            return pa.table({"host": pa.array([key[0].as_py()], pa.string()),
                             "tree": pa.array([merge_all(batch.column("tree").to_pylist())], pa.string())})

        group = F.pmod(F.xxhash64("tree"), F.lit(MERGED_AT_ONCE ** left))
        merged = (merged.withColumn("part", group).groupBy("host", "part")
                  .applyInArrow(run, "host string, tree string"))
    return merged.select("host", F.col("tree").alias("wrapper"))


def _counted(parsed: DataFrame, wrappers: DataFrame) -> DataFrame:
    """host, title, node (of the wrapper), hash, size, linked: every candidate
    text of every page, placed in its host's wrapper."""
    schema = "host string, title bigint, node int, hash bigint, size int, linked int"

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for host, tree, title, nodes, hashes, linked, size, wrapper in zip(
                    *(batch.column(i).to_pylist() for i in range(8)), strict=True):
                place = align(tree, wrapper)
                out += [(host, title, place[n], h, s, k)
                        for n, h, k, s in zip(nodes, hashes, linked, size, strict=True)]
            if out:
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.int64(),
                                                           pa.int32(), pa.int32()), strict=True)],
                    names=["host", "title", "node", "hash", "size", "linked"])

    return (parsed.join(wrappers, "host").select("host", "tree", "title", "nodes", "texts", "linked", "size", "wrapper")
            .mapInArrow(run, schema))


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper, constant, menus: the wrapper of every host, the hashes of
    its template texts by node, and its nodes that consist of links.

    Pages of equal title count once: copies of a page make no template."""
    spark = pages.sparkSession
    path = scratch_path(spark, "wrapper-trees")
    source = pages.select(host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html"))
    _parse(source, [], with_text=False).write.mode("error").parquet(path)
    parsed = spark.read.parquet(path)
    trees = parsed.select("host", "tree").distinct()
    wrapper_path = scratch_path(spark, "wrapper-hosts")
    _wrappers(trees).write.mode("error").parquet(wrapper_path)
    wrappers = spark.read.parquet(wrapper_path)
    placed = _counted(parsed, wrappers)
    met = (placed.groupBy("host", "node", "hash", "title").agg(F.sum("size").alias("size"), F.sum("linked").alias("linked"))
           .groupBy("host", "node", "hash").agg(F.count(F.lit(1)).alias("pages"), F.sum("size").alias("size"),
                                                F.sum("linked").alias("linked")))
    met_path = scratch_path(spark, "wrapper-texts")
    # texts of one page alone only matter for their node's share of links
    rare = F.when(F.col("pages") >= CONSTANT_PAGES, F.col("hash"))
    (met.groupBy("host", "node", rare.alias("hash")).agg(F.max("pages").alias("pages"), F.sum("size").alias("size"),
                                                         F.sum("linked").alias("linked"))
     .write.mode("error").parquet(met_path))
    met = spark.read.parquet(met_path)
    titles = parsed.groupBy("host", "title").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    constant = (met.filter("hash is not null").join(titles, "host")
                .filter((F.col("pages") >= F.col("n") * CONSTANT_SHARE) & (F.col("node") >= 0))
                .groupBy("host").agg(F.collect_list(F.struct("node", "hash")).alias("constant")))
    menus = (met.groupBy("host", "node").agg(F.sum("size").alias("size"), F.sum("linked").alias("linked"))
             .filter((F.col("linked") > F.col("size") * LINK_SHARE) & (F.col("node") >= 0))
             .groupBy("host").agg(F.collect_list("node").alias("menus")))
    return (wrappers.join(constant, "host", "left").join(menus, "host", "left")
            .select("host", "wrapper", "constant", "menus"))


def _content(tree: str, wrapper: str, nodes: list[int], texts: list[str], size: list[int], constant: set, menus: set,
             hashed) -> list[str]:
    """The article's blocks of one page."""
    place, may = align(tree, wrapper), roles(tree)
    varying = [(may[n], t, s) for n, t, s in zip(nodes, texts, size, strict=True)
               if place[n] not in menus and (place[n], hashed(t)) not in constant]
    kept = [v for v in varying if v[0][0]]
    # where class names mark everything, they describe the layout: the longest article counts
    share = TEASER_SHARE if kept else 1.0
    kept = kept or varying
    articles: dict[int, int] = {}
    for role, _, s in kept:
        articles[role[2]] = articles.get(role[2], 0) + s
    outside = articles.pop(-1, 0)
    within = sum(articles.values())
    if within and within >= ARTICLE_SHARE * (within + outside):
        long = share * max(articles.values())
        kept = [v for v in kept if v[0][2] >= 0 and articles[v[0][2]] >= long]
    return [t for _, t, _ in kept]


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url"),
              wrappers: DataFrame | None = None) -> DataFrame:
    """``keys``, text, n_chars for every row: the article's blocks in page
    order joined by an empty line, empty if there are none (null and empty
    pages).  ``n_chars`` are code points.

    A block is the text between two block elements' tags, character references
    decoded and white space one space; ``br`` is white space.  Pages whose URL
    is null or names no host count as one host.  Repeated rows give repeated,
    equal results.  Only ``keys``, the URL and the page are read, so further
    columns can't clash; a key may have any name."""
    import xxhash
    if wrappers is None:
        spark = pages.sparkSession
        path = scratch_path(spark, "wrappers")
        induce(pages, url_col, html_col).write.mode("error").parquet(path)
        wrappers = spark.read.parquet(path)
    names = [f"key{i}" for i in range(len(keys))]
    source = pages.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)),
                          host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html"))
    parsed = _parse(source, names, with_text=True).drop("title", "linked")
    n = len(names)

    def signed(text: str) -> int:
        return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)

    def run(batches):
        for batch in batches:
            out = []
            # the columns behind the keys: host, tree, nodes, texts, size, wrapper, constant, menus
            for _, tree, nodes, texts, size, wrapper, constant, menus in zip(
                    *(batch.column(i).to_pylist() for i in range(n, n + 8)), strict=True):
                fixed = {(c["node"], c["hash"]) for c in constant or ()}
                out.append("\n\n".join(_content(tree, wrapper, nodes, texts, size, fixed, set(menus or ()), signed)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n)), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], names=[*names, "text", "n_chars"])

    joined = parsed.hint("merge").join(wrappers, "host").select(*names, "host", "tree", "nodes", "texts", "size",
                                                               "wrapper", "constant", "menus")
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([joined.schema[k] for k in names] + [StructField("text", StringType()),
                                                             StructField("n_chars", LongType())])
    return joined.mapInArrow(run, schema).toDF(*keys, "text", "n_chars")
