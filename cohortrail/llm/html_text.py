"""Main text of web pages by wrapper induction.

A node is known by its path, the tags with class and id from the root to it, and its own text. Trees of a host's pages are
aligned by simple tree matching, the largest match of two trees that keeps order and parents:

1. Path and text are counted over all distinct pages of a host. An alignment pairs nodes of equal paths only, so just those
   that more than half of the pages hold, and two at least, can be template; trees are reduced to them and what is above.
2. Of each such text (and of its second, third, ... place in a page, if more than half of the pages have that) the most
   frequent reduced tree that holds it is a reference of the host; so no text is missed for lack of a reference.
3. Each different reduced tree is aligned with its host's references. A reference's node is template if more than half of
   the distinct pages have an equal one aligned with it. The references, reduced to those nodes, are the host's wrapper.
4. Each page is aligned with the wrapper of its host. What matches a template node is dropped, what varies is content,
   unless its element or its class says that it is a menu, header, footer, sidebar, notice, advert, form or comment.

A page with an article takes its text from there. A page whose whole text would be template keeps it.

No task ever gathers a host; a wrapper has less than twice as many nodes as the host's mean page for each of its references.
Wrappers go to the pages by broadcast while their measured size is at most BROADCAST_BYTES, else by a shuffled join. What two
lists of children have in common at both ends is paired at once; the rest takes time by the product of its lengths.

Null, empty or text-free html: the empty text. Null url, or one without a host: no wrapper. Broken markup: elements
close as their parents do. Repeated rows: each gets its text. Very long pages: whole.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.operators.skew import materialize

# Pages that `induce` takes for a host; the query takes two.
AGREEING = 3
BROADCAST_BYTES = 64 << 20
# Cells of an alignment that are kept; longer lists are halved until theirs are fewer.
CELLS = 1 << 20
# Nodes of a host's reduced trees of which a task keeps what is template.
KNOWN = 4096

# Elements by their role in a page (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template iframe object svg canvas form button input select option textarea nav footer aside "
    "head title menu dialog datalist noembed noframes audio video map".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
# An open element ends where one of these starts.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
LISTS = frozenset("ul ol dl table select menu".split())
# Words of classes, ids and roles that tell what is no article (fixed values).
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget widgets related recommended footer header masthead cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "comment comments commentlist respond reply replies discussion disqus pagination pager toolbar skip copyright "
    "contentinfo complementary search dialog form".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and texts
    key: str = ""
    template: bool = False
    holds: bool = False  # an article or main element below

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def text(self) -> str:
        """The node's own text."""
        return " ".join(" ".join(c for c in self.children if isinstance(c, str)).split())


def parse(page: str) -> Node:
    """The tree of a page; `key` is the tag with class and id."""
    root = Node("#root")
    stack, at = [root], 0
    opened: Counter[str] = Counter()  # the tags on the stack
    find = _TOKEN.search
    while True:
        m = find(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            while opened[tag]:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
            continue
        if tag not in INLINE:
            _close(stack, opened, tag)
        node = Node(tag)
        if m[3].strip(" /\n\t"):
            for name, value in _ATTRIBUTE.findall(m[3]):
                node.attributes.setdefault(name.lower(), html.unescape(value.strip("\"'")))
        node.key = f"{tag}|{node.attributes.get('class', '')}|{node.attributes.get('id', '')}"
        stack[-1].children.append(node)
        if tag in ("article", "main"):
            for above in reversed(stack):
                if above.holds:
                    break
                above.holds = True
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            node.children.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else len(page)
        elif tag not in VOID:
            stack.append(node)
            opened[tag] += 1


def _close(stack: list[Node], opened: Counter[str], tag: str) -> None:
    """Close what the start of a block element ends."""
    for i in range(len(stack) - 1, 0, -1):
        open_tag = stack[i].tag
        if tag in ENDS.get(open_tag, ()) or open_tag in CLOSED_BY_BLOCK:
            opened.subtract(n.tag for n in stack[i:])
            del stack[i:]
            return
        if open_tag in LISTS or (open_tag not in INLINE and open_tag not in ENDS):
            return


def _rows(weights: Iterable[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """For each list of weights, a row of an alignment's sizes."""
    row = np.zeros(size + 1, np.int64)
    yield row
    for w in weights:
        new = row.copy()
        new[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + w))
        row = new
        yield row


def _aligned(weights: list[np.ndarray], size: int) -> list[tuple[int, int]]:
    """The pairs, in order, of the heaviest alignment of a list with one of `size`; weights[i][j] is that of a pair."""
    out, todo = [], [(0, len(weights), 0, size)]
    while todo:
        top, bottom, left, right = todo.pop()
        part = [w[left:right] for w in weights[top:bottom]]
        if len(part) > 1 and len(part) * (right - left) > CELLS:
            middle = len(part) // 2
            *_, above = _rows(part[:middle], right - left)
            *_, below = _rows((w[::-1] for w in part[:middle - 1 : -1]), right - left)
            cut = left + int(np.argmax(above + below[::-1]))
            todo += [(top, top + middle, left, cut), (top + middle, bottom, cut, right)]
            continue
        sizes = list(_rows(part, right - left))
        i, j = len(part), right - left
        while i and j:
            if sizes[i][j] == sizes[i - 1][j]:
                i -= 1
            elif sizes[i][j] == sizes[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((top + i, left + j))
    return sorted(out)


class _Shapes:
    """Subtrees by number, equal ones the same, each after those below it."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.labels: dict[object, int] = {}
        self.keys: list[int] = []
        self.texts: list[int] = []
        self.below: list[tuple[int, ...]] = []

    def add(self, root: Node) -> dict[Node, int]:
        """The numbers of a tree's subtrees."""
        order, out = [root], {}
        for node in order:
            order += node.nodes()
        for node in reversed(order):
            below = tuple(out[n] for n in node.nodes())
            key, text = (self.labels.setdefault(x, len(self.labels)) for x in (("key", node.key), ("text", node.text())))
            number = out[node] = self.numbers.setdefault((key, text, below), len(self.numbers))
            if number == len(self.keys):
                self.keys.append(key)
                self.texts.append(text)
                self.below.append(below)
        return out

    def _all_below(self, roots: tuple[int, ...]) -> list[int]:
        found, todo = set(roots), list(roots)
        while todo:
            new = set(self.below[todo.pop()]) - found
            found |= new
            todo += new
        return sorted(found)

    def weights(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> list[np.ndarray]:
        """For each of `xs`, the sizes of its matches with `ys`."""
        mine, others = self._all_below(xs), self._all_below(ys)
        at = {y: i for i, y in enumerate(others)}
        # By key and number of children: places in `others`, texts, and a column of children's places for each child.
        alike: dict[int, dict[int, list[int]]] = {}
        for y in others:
            alike.setdefault(self.keys[y], {}).setdefault(len(self.below[y]), []).append(y)
        groups = {
            key: [
                (
                    np.array([at[y] for y in some]),
                    np.array([self.texts[y] for y in some]),
                    np.array([[at[c] for c in self.below[y]] for y in some], np.int64).reshape(len(some), n).T,
                )
                for n, some in by_size.items()
            ]
            for key, by_size in alike.items()
        }
        left = Counter(c for x in mine for c in set(self.below[x])) + Counter(set(xs))
        sizes: dict[int, np.ndarray] = {}
        for x in mine:
            out = sizes[x] = np.zeros(len(others), np.int64)
            below = self.below[x]
            for places, texts, children in groups.get(self.keys[x], ()):
                found = 1 + (texts == self.texts[x])
                if below and len(children) > len(places):
                    for k, own in enumerate(children.T):
                        *_, last = _rows((sizes[c][own] for c in below), len(own))
                        found[k] += last[-1]
                elif below and len(children):
                    before = [np.zeros(len(places), np.int64)] * (len(children) + 1)
                    for c in below:
                        row = before[:1]
                        for j, column in enumerate(children):
                            row.append(np.maximum(np.maximum(before[j + 1], row[j]), before[j] + sizes[c][column]))
                        before = row
                    found += before[-1]
                out[places] = found
            for c in set(below):
                left[c] -= 1
                if not left[c]:
                    del sizes[c]
        wanted = np.array([at[y] for y in ys])
        rows = {x: sizes[x][wanted] for x in set(xs)}
        return [rows[x] for x in xs]


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size of the largest match of two trees of equal roots, and its pairs of nodes.

    Equal own texts count once more, so that equal nodes find each other in lists.
    """
    if a.key != b.key:
        return 0, []
    shapes = _Shapes()
    of_a, of_b = shapes.add(a), shapes.add(b)
    size, out, todo = 0, [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        size += 1 + (x.text() == y.text())
        x_nodes, y_nodes = x.nodes(), y.nodes()
        if of_a[x] == of_b[y]:
            todo += zip(x_nodes, y_nodes, strict=True)
            continue
        # Equal subtrees at the ends are in a largest match: no other pair of theirs is larger.
        while x_nodes and y_nodes and of_a[x_nodes[-1]] == of_b[y_nodes[-1]]:
            todo.append((x_nodes.pop(), y_nodes.pop()))
        head = 0
        while head < min(len(x_nodes), len(y_nodes)) and of_a[x_nodes[head]] == of_b[y_nodes[head]]:
            head += 1
        todo += zip(x_nodes[:head], y_nodes[:head], strict=True)
        x_nodes, y_nodes = x_nodes[head:], y_nodes[head:]
        if len(x_nodes) == len(y_nodes) == 1:
            if x_nodes[0].key == y_nodes[0].key:
                todo.append((x_nodes[0], y_nodes[0]))
        elif x_nodes and y_nodes:
            weights = shapes.weights(tuple(of_a[n] for n in x_nodes), tuple(of_b[n] for n in y_nodes))
            todo += [(x_nodes[i], y_nodes[j]) for i, j in _aligned(weights, len(y_nodes))]
    return size, out


@dataclass(slots=True)
class Tree:
    """The nodes of a page that are not dropped anyway, in document order: where their parents are (-1 for the root), the
    hash of their path, and that of path and own text (0 if they have none)."""

    parents: list[int]
    paths: list[int]
    places: list[int]

    def reduced(self, places: Iterable[int] | None = None) -> tuple[Tree, list[int]]:
        """The tree with the nodes of these places (all, if none are given) and what is above, and their numbers here."""
        kept = [x != 0 if places is None else x in places for x in self.places]
        held = kept.copy()
        for i in range(len(held) - 1, 0, -1):
            if held[i]:
                held[self.parents[i]] = True
        numbers = [i for i, x in enumerate(held) if x]
        new = {n: i for i, n in enumerate(numbers)} | {-1: -1}
        places = [self.places[i] if kept[i] else 0 for i in numbers]
        return Tree([new[self.parents[i]] for i in numbers], [self.paths[i] for i in numbers], places), numbers

    def pack(self) -> bytes:
        return b"".join(np.array(c, k).tobytes() for c, k in ((self.paths, "<i8"), (self.places, "<i8"), (self.parents, "<i4")))

    @staticmethod
    def unpack(blob: bytes) -> Tree:
        n = len(blob) // 20
        paths, places = (np.frombuffer(blob, "<i8", n, at).tolist() for at in (0, 8 * n))
        return Tree(np.frombuffer(blob, "<i4", n, 16 * n).tolist(), paths, places)

    def nodes(self) -> list[Node]:
        """The same as nodes for `match`; a text is its place."""
        out = []
        for parent, path, place in zip(self.parents, self.paths, self.places, strict=True):
            node = Node("", children=[str(place)] if place else [], key=str(path))
            if out:
                out[parent].children.append(node)
            out.append(node)
        return out

    def items(self) -> Iterator[tuple[int, int]]:
        """Each place, with how often it came before."""
        seen: Counter[int] = Counter()
        for place in filter(None, self.places):
            yield place, seen[place]
            seen[place] += 1


def _flat(root: Node) -> tuple[Tree, list[Node]]:
    tree, nodes = Tree([], [], []), []
    todo = [(root, -1, 0)]
    while todo:
        node, parent, above = todo.pop()
        if node.tag in DROPPED:
            continue
        path, text = xxhash.xxh64_intdigest(node.key, above), node.text()
        todo += [(n, len(nodes), path) for n in node.nodes()[::-1]]
        nodes.append(node)
        tree.parents.append(parent)
        tree.paths.append(path - (1 << 63))
        tree.places.append(xxhash.xxh64_intdigest(text, path) - (1 << 63) if text else 0)
    return tree, nodes


def _paired(tree: Tree, other: Tree) -> list[tuple[int, int]]:
    """The numbers of the nodes of equal text that the match of two trees pairs."""
    a, b = tree.nodes(), other.nodes()
    of_a, of_b = ({n: i for i, n in enumerate(x)} for x in (a, b))
    pairs = ((of_a[x], of_b[y]) for x, y in match(a[0], b[0])[1]) if a and b else ()
    return [(i, j) for i, j in pairs if tree.places[i] and tree.places[i] == other.places[j]]


def _id(blob: bytes) -> int:
    return xxhash.xxh64_intdigest(blob) - (1 << 63)


def _template(reference: bytes, numbers: Iterable[int]) -> bytes:
    """A reference reduced to these nodes."""
    tree, numbers = Tree.unpack(reference), set(numbers)
    return Tree(tree.parents, tree.paths, [x if i in numbers else 0 for i, x in enumerate(tree.places)]).reduced()[0].pack()


def induce(pages: list[str]) -> str:
    """The wrapper of a few pages as JSON, found as `wrappers` does; empty if there is none."""
    distinct = set(pages)
    if len(distinct) < AGREEING:
        return ""
    trees = [_flat(parse(page))[0] for page in distinct]
    counts = Counter(x for tree in trees for x in set(tree.places))
    kept = {x for x, n in counts.items() if x and 2 * n > len(trees)}
    reduced = Counter(tree.reduced(kept)[0].pack() for tree in trees if not kept.isdisjoint(tree.places))
    pages_of, best = Counter(), {}
    for blob, n in reduced.items():
        for item in Tree.unpack(blob).items():
            pages_of[item] += n
            best[item] = max(best.get(item, (0, 0, b"")), (n, _id(blob), blob))
    references = {blob for item, (_, _, blob) in best.items() if 2 * pages_of[item] > len(trees)}
    out = []
    for reference in sorted(references):
        counts = Counter()
        for blob, n in reduced.items():
            for _, j in _paired(Tree.unpack(blob), Tree.unpack(reference)):
                counts[j] += n
        if numbers := [j for j, n in counts.items() if 2 * n > len(trees)]:
            out.append(_template(reference, numbers).hex())
    return json.dumps(out) if out else ""


class Wrapper:
    def __init__(self, trees: list[bytes]):
        self.trees = [Tree.unpack(t) for t in trees]
        self.places = frozenset(x for t in self.trees for x in t.places if x)
        self.known: dict[bytes, list[int]] = {}
        self.held = 0

    def template(self, tree: Tree) -> list[int]:
        """The numbers of the nodes that match one of a template."""
        if self.places.isdisjoint(tree.places):
            return []
        reduced, numbers = tree.reduced(self.places)
        blob = reduced.pack()
        if blob not in self.known:
            if self.held + len(numbers) > KNOWN:
                self.known.clear()
                self.held = 0
            self.held += len(numbers)
            self.known[blob] = list({i for t in self.trees for i, _ in _paired(reduced, t)})
        return [numbers[i] for i in self.known[blob]]


def _restore(kept: list[bytes | str]) -> Wrapper:
    return Wrapper([bytes.fromhex(t) if isinstance(t, str) else t for t in kept])


def mark(page: Node, wrapper: Wrapper) -> None:
    """Mark the nodes of the page that match template nodes of the wrapper."""
    tree, nodes = _flat(page)
    for i in wrapper.template(tree):
        nodes[i].template = True


def _is_noise(node: Node, in_article: bool) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag in ("html", "body", "main", "#root"):
        return False
    if node.tag == "header" and not in_article:
        return True
    a = node.attributes
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    words = _WORDS.split(f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".lower())
    if HINTS.isdisjoint(words):
        return False
    # A container of the article may be named after what else it holds.
    return node.tag == "article" or not node.holds


def _descend(node: Node):
    stack = node.nodes()[::-1]
    while stack:
        child = stack.pop()
        yield child
        stack += child.nodes()[::-1]


def _articles(node: Node) -> list[Node]:
    """The outermost articles, or main elements, that are not noise."""
    out = []
    todo: list[tuple[Node, int | None]] = [(n, None) for n in node.nodes()[::-1]]
    while todo:
        child, before = todo.pop()
        if before is not None:  # behind a main element: itself, if nothing in it was found
            if len(out) == before:
                out.append(child)
        elif not _is_noise(child, False):
            if child.tag == "article":
                out.append(child)
                continue
            if child.tag == "main":
                todo.append((child, len(out)))
            todo += [(n, None) for n in child.nodes()[::-1]]
    return out


def _blocks(node: Node, in_article: bool, template: bool, out: list[list[str]]) -> None:
    """Append the texts of the node to `out`, a list per block."""
    todo: list[tuple[Node, Node | str] | None] = [(node, c) for c in node.children[::-1]]
    while todo:
        step = todo.pop()
        if step is None:  # the end of a block
            out.append([])
            continue
        parent, child = step
        if isinstance(child, str):
            if not (template and parent.template):
                out[-1].append(child)
        elif child.tag == "br":
            out[-1].append(" ")
        elif not _is_noise(child, in_article):
            if child.tag not in INLINE:
                out.append([])
                todo.append(None)
            todo += [(child, c) for c in child.children[::-1]]


def _joined(roots: list[Node], in_article: bool, template: bool) -> str:
    blocks: list[list[str]] = [[]]
    for root in roots:
        blocks.append([])
        _blocks(root, in_article, template, blocks)
    return "\n".join(t for t in (" ".join("".join(b).split()) for b in blocks) if t)


def _is_menu(node: Node) -> bool:
    """A list in which links hold nearly all text."""
    total = len(" ".join(_all_text(node)).split())
    linked = sum(len(" ".join(_all_text(n)).split()) for n in _descend(node) if n.tag == "a")
    return total > 0 and linked >= 0.8 * total


def _all_text(node: Node):
    stack = node.children[::-1]
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            yield child
        elif child.tag not in DROPPED:
            stack += child.children[::-1]


def extract(page: str | None, wrapper: Wrapper | None) -> str:
    root = parse(page or "")
    if wrapper:
        mark(root, wrapper)
    roots = _articles(root)
    in_article = bool(roots)
    if not roots:
        roots = [root]
        for node in [n for n in _descend(root) if n.tag in ("ul", "ol") and _is_menu(n)]:
            node.children = []
    return _joined(roots, in_article, True) or _joined(roots, in_article, False)


HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '')"


def _by_host(rows: DataFrame, found: DataFrame, size: str, how: str = "inner") -> DataFrame:
    """`rows` joined to the row of their host; `size`: of that row, in bytes."""
    size = found.agg(F.expr(f"coalesce(sum({size} + octet_length(host) + 64), 0)")).first()[0]
    return rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", how)


def _reduced(trees: DataFrame) -> DataFrame:
    """host, its number of distinct pages, and each reduced tree of them with its id and its number of pages."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per place of a page, and one without place for the page itself."""
        for batch in batches:
            for host, tree in zip(batch.column("host"), batch.column("tree"), strict=True):
                found = [None, *{x for x in Tree.unpack(tree.as_py()).places if x}]
                hosts = pa.array([host.as_py()] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([hosts, pa.array(found, pa.int64())], ["host", "place"])

    counted = trees.mapInArrow(held, "host string, place bigint").groupBy("host", "place").agg(F.expr("count(1) AS n"))
    counted = materialize(counted.where("n > 1"), "places")
    total = counted.where("place IS NULL").selectExpr("host", "n AS pages")
    kept = counted.where("place IS NOT NULL").join(total, "host").where("2 * n > pages")
    kept = materialize(kept.groupBy("host", "pages").agg(F.expr("collect_list(place) AS places")), "shared-places")

    def work():
        known: dict[str, frozenset[int]] = {}

        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            blobs = []
            for host, tree, places in zip(batch.column("host").to_pylist(), *batch.columns[1:], strict=True):
                if host not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[host] = frozenset(places.as_py())
                tree = Tree.unpack(tree.as_py())
                blobs.append(None if known[host].isdisjoint(tree.places) else tree.reduced(known[host])[0].pack())
            ids = [None if b is None else _id(b) for b in blobs]
            return [pa.array(blobs, pa.binary()), pa.array(ids, pa.int64())]

        return each

    inputs = {"host": "host", "tree": "tree", "places": "places"}
    reduced = common.add_columns(_by_host(trees, kept, "8 * size(places)"), inputs, "reduced binary, id bigint", work)
    reduced = reduced.where("id IS NOT NULL").groupBy("host", "pages", "id", "reduced")
    return materialize(reduced.agg(F.expr("count(1) AS n")), "reduced-trees")


def wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (array of trees) of each host that has one, as a written table."""
    hosted = pages.selectExpr(f"{HOST} AS host", "html").where("host IS NOT NULL AND html IS NOT NULL")

    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = (_flat(parse(page.as_py()))[0].reduced()[0].pack() for page in batch.column("html"))
            columns = [batch.column("host"), batch.column("page"), pa.array(trees, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "page", "tree"])

    # Equal pages have equal digests, so they make one row.
    trees = hosted.selectExpr("host", "unhex(sha2(html, 256)) AS page", "html")
    trees = trees.mapInArrow(planted, "host string, page binary, tree binary").distinct()
    reduced = _reduced(materialize(trees.select("host", "page", "tree"), "trees"))

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "pages", "n", "id", "place", "nth"]
        for batch in batches:
            for *row, tree in zip(*(batch.column(c).to_pylist() for c in (*names[:4], "reduced")), strict=True):
                found = list(Tree.unpack(tree).items())
                columns = [[x] * len(found) for x in row] + [list(x) for x in zip(*found, strict=True)]
                kinds = [pa.string(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    chosen = (
        reduced.mapInArrow(items, "host string, pages bigint, n bigint, id bigint, place bigint, nth bigint")
        .groupBy("host", "pages", "place", "nth")
        .agg(F.expr("sum(n) AS held"), F.expr("max(struct(n, id)).id AS id"))
        .where("2 * held > pages")
        .select("host", "id")
        .distinct()
    )
    references = reduced.join(chosen, ["host", "id"]).groupBy("host")
    references = materialize(references.agg(F.expr("sort_array(collect_set(reduced)) AS references")), "references")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each node of a reference that is aligned with an equal one, the number of pages."""
        names = ["host", "pages", "n", "reference", "number"]
        for batch in batches:
            columns = (batch.column(c) for c in (*names[:3], "reduced", "references"))
            for *row, tree, trees in zip(*columns, strict=True):
                tree, host_pages_n = Tree.unpack(tree.as_py()), [x.as_py() for x in row]
                found = [(k, j) for k, t in enumerate(trees.as_py()) for _, j in _paired(tree, Tree.unpack(t))]
                columns = [[x] * len(found) for x in host_pages_n] + [[x[k] for x in found] for k in (0, 1)]
                kinds = [pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    size = "aggregate(references, 0L, (s, x) -> s + octet_length(x))"
    aligned = _by_host(reduced.select("host", "pages", "n", "reduced"), references, size)
    aligned = aligned.mapInArrow(align, "host string, pages bigint, n bigint, reference bigint, number bigint")
    agreed = aligned.groupBy("host", "pages", "reference", "number").agg(F.expr("sum(n) AS n")).where("2 * n > pages")
    agreed = agreed.groupBy("host").agg(F.expr("collect_list(struct(reference, number)) AS agreed"))

    def work():
        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            out = []
            for trees, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers: dict[int, list[int]] = {}
                for x in found:
                    numbers.setdefault(x["reference"], []).append(x["number"])
                out.append([_template(trees[k], numbers[k]) for k in sorted(numbers)])
            return [pa.array(out, pa.list_(pa.binary()))]

        return each

    inputs = {"references": "references", "agreed": "agreed"}
    done = common.add_columns(references.join(agreed, "host"), inputs, "wrapper array<binary>", work)
    return materialize(done.select("host", "wrapper"), "wrappers")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and `text`, the main text of each row."""
    found = wrappers(pages.select("page_id", "url", "html"))
    rows = pages.selectExpr("page_id", "url", "html", f"{HOST} AS host")
    joined = _by_host(rows, found, "aggregate(wrapper, 0L, (s, x) -> s + octet_length(x))", "left")

    def work():
        known: dict[str, Wrapper] = {}

        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            out = []
            columns = batch.column("html"), batch.column("host").to_pylist(), batch.column("wrapper")
            for page, host, wrapper in zip(*columns, strict=True):
                if wrapper.is_valid and host not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[host] = _restore(wrapper.as_py())
                out.append(extract(page.as_py(), known[host] if wrapper.is_valid else None))
            return [pa.array(out, pa.string())]

        return each

    done = common.add_columns(joined, {"html": "html", "host": "host", "wrapper": "wrapper"}, "text string", work)
    return done.selectExpr("page_id", "url", "text", "CAST(char_length(text) AS bigint) AS n_chars")
