"""Main text of web pages by composite text density.

A page is read into a tree of elements, without those that are never text (``DROPPED``, such as
scripts, nav, footer and aside, and hidden ones). An element is called like boilerplate if it is
a form, if a whole class, id or role is one of ``NAMES`` (ad, sidebar, comments and so on), or if
all parts of one are names or ``GENERIC`` words and one is of ``STRONG`` (ad-slot,
commentList, but not ad-hoc or has-sidebar). Such an element, and a header that stands in no
article or main, is cut off unless it looks like the page's text (``_looks_like_text``).
Every node left has ``C`` characters, ``T`` tags below it, of these ``LC``
characters and ``LT`` tags in links, and the link-adjusted density

    C/T * log(C/LC * T/LT) base ln(C/nLC * LC + LCb/Cb * C + e)

with ``nLC = C - LC``, every count at least one, and ``Cb``, ``LCb`` those of the body. The main
text is the container with the largest sum of its children's densities, or the outermost
article or else main around it, and beside it, in page order, every subtree that reaches the
threshold, the least density on the path from the body to it. Text and inline elements between
two blocks count as one subtree. What belongs to the container is kept whatever its density,
unless more than half of it is links: the heading before it and all between them, other
articles beside an article, sections of its kind and plain blocks beside a container that is
neither article nor main. Lists of links are left out of the kept text if they are less
dense than the threshold and stand in no article.

Defined cases: a null or empty page has no text; unclosed and stray tags are closed as
browsers do; what stands in an unfinished tag at the end is dropped; repeated rows are read
each on their own; a page of nothing but elements that are never text has none; time grows with
the length of a page, however its tags are nested or left open; a table without pages gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES_AT_ONCE = 256
LEAST_LOG = 0.1  # of a base, where a page has no links

# fixed values: element names of HTML by how they are treated
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript head nav footer aside "
    "menu button select template svg canvas object dialog audio video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body center".split())
#: An opening tag of the key closes an open element of these.
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_CELLS, _ROWS = frozenset({"td", "th"}), frozenset({"tr", "td", "th"})
_GROUPS = _ROWS | {"tbody", "thead", "tfoot"}
_TERMS, _TABLE = frozenset({"dt", "dd"}), frozenset({"table"})
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (_TERMS, frozenset({"dl"})),
    "dd": (_TERMS, frozenset({"dl"})),
    "tr": (_ROWS, _TABLE),
    "td": (_CELLS, _TABLE | {"tr"}),
    "th": (_CELLS, _TABLE | {"tr"}),
    "tbody": (_GROUPS, _TABLE),
    "thead": (_GROUPS, _TABLE),
    "tfoot": (_GROUPS, _TABLE),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
#: What a new open element changes: sets it bounds, and sets it is the first of.
BOUNDS: dict[str, list[frozenset[str]]] = {}
FIRST: dict[str, list[frozenset[str]]] = {}
for _closed, _bounds in dict.fromkeys(CLOSES.values()):
    for _name in _bounds:
        BOUNDS.setdefault(_name, []).append(_closed)
    for _name in _closed - _bounds:
        FIRST.setdefault(_name, []).append(_closed)
#: Classes, ids and roles by which boilerplate names itself.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup popover modal overlay toast "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside "
    "complementary footer contentinfo header masthead topbar toolbar comment comments commentlist "
    "disqus respond reply replies discussion share sharing social follow related recommended "
    "recommendations newsletter subscribe subscription signup login search searchbox form widget "
    "skip tags tagcloud".split()
)
#: Parts of longer names (comment-list, adSlot) that tell boilerplate, beside generic parts only.
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent "
    "gdpr popup popover modal overlay toast nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination sidebar footer masthead topbar toolbar comment comments disqus newsletter "
    "subscribe subscription signup login search share sharing social".split()
)
GENERIC = frozenset(
    "area bar block body bottom bottoms box button buttons container content form group holder "
    "inner item items left link links list main module outer page panel place placeholder primary "
    "reader right secondary section site slot thread top unit user widget wrap wrapper zone".split()
)
READERS = frozenset("comment comments commentlist disqus discussion respond replies".split())
LISTS = frozenset("ul ol dl table menu div section center td".split())
HOLDS_P = CONTAINERS | {"li", "blockquote", "th"}  # an open p outside of these stays open
# every loop is possessive: nothing is looked at again after a failure
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?/](?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)"
    r"|<[/]?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
#: The same for a stretch with a quote that is never closed: a tag ends at the next >.
PLAIN_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?/](?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)",
    re.S,
)
QUOTED = re.compile(r"</?[a-zA-Z][^\s/>]*+(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+|[^\W\d_]")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")


class Node:
    __slots__ = (
        "name", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "named", "kind",
        "depth", "block_depth", "open_p", "scopes",
    )

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent = name, parent
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0
        self.named = self.kind = ""
        self.depth, self.block_depth = 0, 0
        self.open_p: Node | None = None  # the nearest p that a block would close
        self.scopes: dict[frozenset[str], Node] = {}  # of CLOSES, the outermost element that would go
        if parent is None:
            return
        self.depth = parent.depth + 1
        self.block_depth = self.depth if name in BLOCKS else parent.block_depth
        if name == "p":
            self.open_p = self
        elif name not in HOLDS_P:
            self.open_p = parent.open_p
        self.scopes = parent.scopes
        if name in BOUNDS and self.scopes:
            self.scopes = {c: n for c, n in self.scopes.items() if c not in BOUNDS[name]}
        for closed in FIRST.get(name, ()):
            if closed not in self.scopes:
                self.scopes = {**self.scopes, closed: self}

    @property
    def mostly_links(self) -> bool:
        return 2 * self.link_chars > self.chars


def _boilerplate(token: str) -> str:
    """What a class, id or role tells: nothing, "name" or "readers"."""
    if token.lower() in NAMES:
        return "readers" if token.lower() in READERS else "name"
    parts = [part.lower() for part in PART.findall(token)]
    told = STRONG.intersection(parts)
    if not told or not all(p in NAMES or p in STRONG or p in GENERIC or p.isdigit() for p in parts):
        return ""
    return "name" if READERS.isdisjoint(told) else "readers"


def _told(name: str, attributes: str) -> tuple[bool, str, str]:
    """Whether an element is never text, how it is called boilerplate, and its classes."""
    named, kind = {"form": "name", "header": "header"}.get(name, ""), ""
    if name in DROPPED:
        return True, named, kind
    if not attributes or name in ("body", "html", "main"):
        return False, named, kind
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role"):
            value = html.unescape(value.strip("\"'"))
            kind = value if key == "class" else kind
            for token in value.split():
                told = _boilerplate(token)
                if told and named != "readers":
                    named = told
        elif key == "hidden" or key == "aria-hidden" and "true" in value.lower():
            return True, named, kind
    return False, named, kind


def _cut_named(root: Node) -> None:
    """Cuts off what is called like boilerplate and does not look like the page's text."""
    order, stack = [], [(root, False)]
    own: dict[int, list[int]] = {}  # characters outside links, articles and the like
    while stack:
        node, in_link = stack.pop()
        order.append(node)
        in_link = in_link or node.name == "a"
        chars = 0 if in_link else sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        real = node.name in ("article", "main") and not node.named
        own[id(node)] = [chars, real, node.name == "main", node.name == "h1"]
        stack.extend((p, in_link) for p in node.parts if not isinstance(p, str) and p.name)
    for node in reversed(order):
        if node.parent is not None:
            above, here = own[id(node.parent)], own[id(node)]
            for i, count in enumerate(here):
                above[i] += count
    around = {id(root): 0}  # articles and mains that an element stands in
    for node in order:
        if node.parent is not None:
            real = node.parent.name in ("article", "main") and not node.parent.named
            around[id(node)] = around[id(node.parent)] + real
    cut = {
        id(node)
        for node in order
        if node.named and not _looks_like_text(node, own[id(node)], own[id(root)], around[id(node)])
    }
    for above in {id(n.parent): n.parent for n in order if id(n) in cut}.values():
        above.parts = [Node("", None) if id(p) in cut and p.name in BLOCKS else p
                       for p in above.parts if id(p) not in cut or p.name in BLOCKS]


def _looks_like_text(node: Node, here: list[int], page: list[int], around: int) -> bool:
    """Whether an element is the page's text although it is called like boilerplate.

    It is if it holds a main, or an article (readers write articles too: not what
    is called comments) while none stands elsewhere or around it; if it holds an h1 and no article
    stands elsewhere; or if it holds more than half of the characters outside links and no
    article stands elsewhere or around it. A header is boilerplate only outside articles, as
    the page's own or beside an article.
    """
    chars, articles, mains, headings = here
    elsewhere = page[1] - articles - around > 0
    if node.named == "header" and (around or not elsewhere and node.parent.parent is not None):
        return True
    if mains or articles and node.named != "readers" and not elsewhere and not around:
        return True
    if headings and not elsewhere:
        return True
    return not elsewhere and not around and 2 * chars > page[0]


class Tree:
    """Open elements, found by name without a walk."""

    def __init__(self) -> None:
        self.root = Node("html", None)
        self.open = [self.root]
        self.by_name: dict[str, list[Node]] = {}

    @property
    def here(self) -> Node:
        return self.open[-1]

    def push(self, node: Node) -> None:
        self.open.append(node)
        self.by_name.setdefault(node.name, []).append(node)

    def close_from(self, node: Node) -> None:
        """Closes an open element and all inside it."""
        while True:
            last = self.open.pop()
            self.by_name[last.name].pop()
            if last is node:
                return

    def has(self, name: str) -> bool:
        return bool(self.by_name.get(name))

    def end(self, name: str) -> None:
        """An end tag. One of an inline element does not close a block."""
        if self.has(name):
            node = self.by_name[name][-1]
            if name in BLOCKS or node.depth > self.here.block_depth:
                self.close_from(node)

    def make_room(self, name: str) -> None:
        """Closes what a new element closes."""
        if name in CLOSES_P:
            while self.here.open_p is not None:
                self.close_from(self.here.open_p)
        if name in CLOSES:
            found = self.here.scopes.get(CLOSES[name][0])
            if found is not None:
                self.close_from(found)


def parse(page: str) -> Node:
    """The tree of elements, without what is never text and boilerplate that names itself."""
    tree, any_named = Tree(), False
    at, plain_until = 0, 0
    dropped: list[str] = []  # open elements from the outermost dropped one inwards
    inside: Counter[str] = Counter()  # of them by name
    while True:
        token = (PLAIN_TOKEN if at < plain_until else TOKEN).search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text and not dropped:
            tree.here.parts.append(html.unescape(text) if "&" in text else text)
        if token is None:
            return _finished(tree.root, any_named)
        at = token.end()
        closing, name, attributes, end = token.group(1, 2, 3, 4)
        if name is None and page[token.start() + 1] not in "!?" and QUOTED.match(page, token.start()):
            plain_until = QUOTED.match(page, token.start()).end()  # where a quote is never closed
        if name is None or not end:
            continue
        name = name.lower()
        if dropped:
            if closing:
                if inside[name]:
                    while (last := dropped.pop()) != name:
                        inside[last] -= 1
                    inside[name] -= 1
                elif name in BLOCKS and dropped[0] not in RAW and len(dropped) == 1 and tree.has(name):
                    dropped.clear()  # the dropped element was never closed
                    inside.clear()
                    tree.end(name)
            elif name in RAW:
                at = _behind_raw(page, name, at)
            elif name not in VOID and not attributes.endswith("/"):
                dropped.append(name)
                inside[name] += 1
            continue
        if closing:
            tree.end(name)
            if name == "p" or name in BLOCKS:
                tree.here.parts.append(Node("", None))  # a block ends here
            continue
        if name in ("html", "body"):
            continue
        tree.make_room(name)
        never, named, kind = _told(name, attributes)
        if never:
            if name in RAW:
                at = _behind_raw(page, name, at)
            elif name not in VOID:
                dropped.append(name)
                inside[name] += 1
            continue
        node = Node(name, tree.here)
        node.named, node.kind = named, kind
        any_named = any_named or bool(named)
        tree.here.parts.append(node)
        if name not in VOID:
            tree.push(node)


def _finished(root: Node, any_named: bool) -> Node:
    if any_named:
        _cut_named(root)
    return root


def _behind_raw(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
    return end.end() if end else len(page)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """The link-adjusted density; ``ratio`` is the share of link characters in the body."""
    c, t = max(1, chars), max(1, tags)
    lc, lt = max(1, link_chars), max(1, link_tags)
    text = max(1, chars - link_chars)
    base = math.log(c / text * link_chars + ratio * c + math.e)
    return chars / t * math.log(max(1.0, c / lc * t / lt)) / max(LEAST_LOG, math.log(base))


def _measure(root: Node) -> list[Node]:
    """Counts of every node, children before their parents; all nodes."""
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append(node)
        for part in node.parts:
            if isinstance(part, str):
                n = len("".join(part.split()))
                node.chars += n
                node.link_chars += n * in_link
            elif part.name:
                linked = in_link or part.name == "a"
                stack.append((part, linked))
                node.link_tags += linked
                node.tags += 1
    for node in reversed(order):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.tags += node.tags
            node.parent.link_chars += node.link_chars
            node.parent.link_tags += node.link_tags
    body = root
    ratio = body.link_chars / max(1, body.chars)
    for node in order:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
    return order


def _densest(root: Node, order: list[Node]) -> tuple[Node, float]:
    """The container with the largest sum of densities, and the threshold on its path."""
    best, largest = root, -1.0
    for node in order:
        if node.name in CONTAINERS or node is root:
            total = sum(p.density for p in node.parts if not isinstance(p, str) and p.name)
            own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
            total += own / max(1, node.tags)  # text that stands in no child
            if total > largest:
                best, largest = node, total
    # a part of an article is not all of it
    around: dict[str, Node] = {}  # the outermost ones
    node = best
    while node is not None:
        around[node.name] = node
        node = node.parent
    best = around.get("article") or around.get("main") or best
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    return best, threshold


def _runs(node: Node) -> Iterator[list[Node | str]]:
    """The parts of a node: each block alone, what stands in line between two together."""
    run: list[Node | str] = []
    for part in node.parts:
        if isinstance(part, str) or part.name == "br" or part.name and part.name not in BLOCKS:
            run.append(part)
            continue
        if run:
            yield run
        yield [part]
        run = []
    if run:
        yield run


def _run_density(run: list[Node | str], in_link: bool, ratio: float) -> float:
    if len(run) == 1 and not isinstance(run[0], str):
        return run[0].density
    chars = tags = link_chars = link_tags = 0
    for part in run:
        if isinstance(part, str):
            n = len("".join(part.split()))
            chars, link_chars = chars + n, link_chars + n * in_link
        else:
            chars, tags = chars + part.chars, tags + part.tags + (part.name != "br")
            link_chars += part.link_chars
            link_tags += part.link_tags + (part.name == "a")
    return _density(chars, tags, link_chars, link_tags, ratio)


def _kept(root: Node, best: Node, threshold: float) -> list[Node | str]:
    """``best`` and all that reaches the threshold beside it, outermost subtrees in page order."""
    ratio = root.link_chars / max(1, root.chars)
    belongs = _belonging(root, best)
    path, node = set(), best.parent
    while node is not None:
        path.add(id(node))
        node = node.parent
    kept: list[Node | str] = []
    stack: list[tuple[list[Node | str], Node | None, bool]] = [([root], root, False)]
    while stack:
        run, apart, in_link = stack.pop()
        if apart is best:
            kept.append(best)
        elif apart is not None and id(apart) in path:
            in_link = in_link or apart.name == "a"
            split = reversed(list(_split(apart, path, best)))
            stack.extend((r, _apart(r, path, best), in_link) for r in split)
        elif any(id(part) in belongs for part in run) or (
            (density := _run_density(run, in_link, ratio)) >= threshold and density > 0
        ):
            kept += [Node("", None), *run, Node("", None)]
        else:
            for part in reversed(run):
                if not isinstance(part, str):
                    linked = in_link or part.name == "a"
                    stack.extend((r, None, linked) for r in reversed(list(_runs(part))))
    return kept


def _belonging(root: Node, best: Node) -> set[int]:
    """Elements outside ``best`` that belong to it whatever their density."""
    nodes, stack = [], [root]
    while stack:
        nodes.append(stack.pop())
        stack.extend(p for p in nodes[-1].parts if not isinstance(p, str) and p.name)
    headed: set[int] = set()  # elements that are or hold an h1
    for node in reversed(nodes):
        if node.name == "h1" or id(node) in headed:
            headed.add(id(node))
            if node.parent is not None:
                headed.add(id(node.parent))
    found: list[Node] = []
    if best.name == "article":
        found += [node for node in nodes if node.name == "article"]
    elif best.name != "main" and best.parent is not None:
        beside = [p for p in best.parent.parts if not isinstance(p, str) and p.name and p is not best]
        alike = [p for p in beside if p.name == best.name and p.kind == best.kind]
        found += [p for p in alike if best.name == "section" or best.kind]
        if best.parent is not root:
            found += [p for p in beside if p.name in BLOCKS and p.name not in CONTAINERS]
    node = best
    before: list[Node] = []
    while node.parent is not None and id(best) not in headed:
        siblings = [p for p in node.parent.parts if not isinstance(p, str) and (p.name or p is node)]
        earlier = siblings[: next(i for i, p in enumerate(siblings) if p is node)]
        at = next((i for i in reversed(range(len(earlier))) if id(earlier[i]) in headed), None)
        before += earlier if at is None else earlier[at:]
        if at is not None:
            found += before
            break
        node = node.parent
    return {id(node) for node in found if not node.mostly_links}


def _apart(run: list[Node | str], path: set[int], best: Node) -> Node | None:
    """The node on the path, or ``best``, if a run is just that."""
    part = run[0]
    return part if len(run) == 1 and (part is best or id(part) in path) else None


def _split(node: Node, path: set[int], best: Node) -> Iterator[list[Node | str]]:
    """The runs of a node, cut around an element that leads to ``best``."""
    for run in _runs(node):
        at = next((i for i, p in enumerate(run) if p is best or id(p) in path), None)
        if at is None:
            yield run
        else:
            yield from (part for part in (run[:at], run[at : at + 1], run[at + 1 :]) if part)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    best, threshold = _densest(root, _measure(root))
    in_article = best.name == "article"
    out: list[str] = []
    stack: list[Node | str] = _kept(root, best, threshold)[::-1]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.name:
            out.append(" ")
        else:
            links = part.mostly_links and part.name in LISTS and not in_article
            if part is not best and links and part.density < threshold:
                continue
            if part.name in BLOCKS:
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed(part.parts))
    return " ".join("".join(out).split())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            part = batch.slice(at, PAGES_AT_ONCE)
            texts = [main_text(page) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    columns = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string"))
    return columns.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
