"""Main text of web pages by wrapper induction.

Pages of one host are made from one template. Every page's tree is aligned with that of
its host's reference page (the one with the smallest id) by simple tree matching: the
pairing of ordered children that matches most nodes. Aligned blocks whose text is the same on
nearly all pages are template, blocks whose text varies are slots. The host's wrapper
is the container that holds most of the slots' text, and the template blocks within
it. A page's main text is what its wrapper's container holds, without template, menus,
adverts and the like.

All pages count towards a wrapper. They are aligned by outlines, which hold labels and text
digests instead of html; what pages find is added up per host and node before it is
shuffled, and a page meets only its host's reference outline and wrapper, one row each, so
that the pages of a hot host can be split over tasks.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import count

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import in_batches, stored

# A block is template if it is the same on this share of a host's pages, of which there
# must be a few.
TEMPLATE_SHARE = 0.9
TEMPLATE_PAGES = 10
# A container is entered as long as one of its children holds this share of all text; an
# article or main element is the container if it holds the other share.
ENTER_SHARE = 0.9
MAIN_SHARE = 0.5
# An element cut by its name is opened again if it holds the page's only top heading and so
# many times the text outside.
OPENED_TIMES = 9

# Elements of HTML by how they are laid out.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "xmp")
NOT_TEXT = set(RAW) | set("head nav footer aside form button select dialog menu object video audio canvas".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
MAIN = {"article", "main"}
NOT_MAIN_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sidebar menu nav navbar navigation"
    " footer header masthead cookie cookies notice notices consent gdpr comment comments disqus"
    " discussion replies share sharing social related recommended promo promotion sponsor sponsored"
    " newsletter subscribe subscription signup login popup modal overlay breadcrumb breadcrumbs"
    " widget toolbar pagination pager skip".split()
)
NOT_MAIN_STEMS = ("advert", "comment", "sidebar", "cookie", "newsletter", "sponsor", "promo", "breadcrumb")
NOT_MAIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert",
                  "dialog", "menu", "menubar"}

# A tag whose quotes do not close ends at the first ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|(?P<broken>[^>]*)>)",
    re.S,
)
_CDATA = "<![CDATA["
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']*)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_NAME_PARTS = re.compile(r"[\s_\-:]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    """A block: label, text pieces and child blocks in page order, or main text or not.

    ``named`` is for a block that is no main text by its name alone; ``inside`` for one with an
    article or main element around it.
    """

    __slots__ = ("label", "tag", "items", "main", "inline", "named", "inside")

    def __init__(
        self, tag: str, label: str, main: bool, inline: bool, named: bool = False, inside: bool = False
    ) -> None:
        self.tag, self.label, self.main, self.inline = tag, label, main, inline
        self.named, self.inside = named, inside
        self.items: list[str | Node] = []

    @property
    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def own_texts(self) -> list[str]:
        """Its own text, one entry per stretch between child blocks, white space folded."""
        found, piece = [], []
        for x in [*self.items, None]:
            if isinstance(x, str):
                piece.append(x)
            else:
                text = " ".join("".join(piece).split())
                if text:
                    found.append(text)
                piece = []
        return found


def _is_main(tag: str, attrs: str, inside_main: bool) -> tuple[bool, bool, str]:
    """Whether an element may hold main text, whether only its name (or being a form) says no,
    and its class for the label."""
    if tag == "form":
        return False, True, ""
    if tag in NOT_TEXT or (tag == "header" and not inside_main):
        return False, False, ""
    if not attrs.strip():
        return True, False, ""
    names, hidden = [], False
    for name, *values in _ATTR.findall(attrs):
        name = name.lower()
        value = next((v for v in values if v), "").lower()
        if name == "role":
            if value in NOT_MAIN_ROLES:
                return False, False, value
        elif name == "class":
            names += value.split()
        elif name == "id":
            names.append(value)
        elif name == "hidden" or (name == "aria-hidden" and value.startswith("true")):
            hidden = True
        elif name == "style" and _NO_DISPLAY.search(value):
            hidden = True
    if tag not in MAIN and tag != "body":
        for name in names:
            parts = _NAME_PARTS.split(name)
            if NOT_MAIN_NAMES.intersection(parts) or any(x.startswith(NOT_MAIN_STEMS) for x in parts):
                return False, not hidden, name
    if hidden:
        return False, False, "hidden"
    return True, False, names[0] if names else ""


def parse(source: str | None) -> Node:
    """The tree of block elements; unclosed and stray tags are put up with."""
    root = Node("root", "root", True, False)
    stack = [root]
    opened: Counter[str] = Counter()
    if not source:
        return root
    at = 0
    n = len(source)
    last = source.rfind(">")  # no tag ends behind it
    last_cdata = source.rfind("]]>")
    while at < n:
        match = _TOKEN.search(source, at) if at <= last else None
        stop = match.start() if match else n
        if stop > at:
            stack[-1].items.append(html.unescape(source[at:stop]))
        if not match:
            break
        at = match.end()
        name = match["name"]
        if name is None:
            if source.startswith(_CDATA, stop) and stop < last_cdata:
                at = source.find("]]>", stop) + 3
            continue
        tag = name.lower()
        top = stack[-1]
        if match["end"]:
            if not opened[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    _leave(stack, depth, opened)
                    break
                # An inline end tag does not close the block around it.
                if tag in INLINE and not stack[depth].inline:
                    break
            continue
        if tag in ("br", "hr", "wbr"):
            if tag != "wbr":
                top.items.append(" ")
            continue
        if tag in VOID:
            continue
        attrs = match["attrs"] or match["broken"] or ""
        if tag in RAW:
            if not attrs.rstrip().endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = close.end() if close else n
            if tag not in ("script", "style", "template", "noscript"):
                top.items.append(" ")
            continue
        if tag in CLOSES_P or tag in ("li", "dd", "dt", "tr", "td", "th"):
            _close_implied(stack, tag, opened)
            top = stack[-1]
        main, named, label = _is_main(tag, attrs, top.inside)
        inside = top.inside or tag in MAIN
        node = Node(tag, f"{tag}.{label}" if label else tag, main, tag in INLINE, named, inside)
        if node.inline and main:
            node.items = top.items  # inline text belongs to the block around it
        else:
            node.inline = False
            top.items.append(node)
        if not attrs.rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    _open_named(root)
    return root


def _text_size(node: Node) -> int:
    return sum(len(x.strip()) for x in node.items if isinstance(x, str))


def _open_named(root: Node) -> None:
    """Let the names of containers not hide what is the page's article by its elements.

    Where no article or main element with text is left, the elements around the largest one cut
    by their names (or as forms) count as main again if it is longer than what is left. Where
    there is none at all, the element that holds the page's only h1 and nearly all of its text
    does.
    """
    todo: list[Node] = [root]
    while todo:  # most pages end here, at their article
        node = todo.pop()
        if node.inside and _text_size(node):
            return
        todo += [c for c in reversed(node.children) if c.main]
    order: list[tuple[Node, int, bool]] = [(root, -1, True)]  # node, its parent's place, kept
    for at, (node, _, kept) in enumerate(order):
        order += [(c, at, kept and c.main) for c in node.children if c.main or c.named]
        if len(order) == 1:
            return
    if all(kept for _, _, kept in order):
        return
    size = [_text_size(node) for node, _, _ in order]
    heads = [node.tag == "h1" for node, _, _ in order]
    outside = sum(s for s, (_, _, kept) in zip(size, order) if kept)
    has_head = any(h and kept for h, (_, _, kept) in zip(heads, order))
    for at in range(len(order) - 1, 0, -1):
        size[order[at][1]] += size[at]
        heads[order[at][1]] |= heads[at]
    articles = [at for at, (node, _, _) in enumerate(order) if node.tag in MAIN and size[at]]
    if articles:
        at = max(articles, key=lambda a: (size[a], -a))
        while at > 0 and size[at] > outside:  # less may be comments
            order[at][0].main = True
            at = order[at][1]
        return
    named = [at for at, (node, up, kept) in enumerate(order) if not kept and order[up][2]]
    at = max(named, key=lambda a: (size[a], -a))
    if heads[at] and not has_head and size[at] > OPENED_TIMES * outside:
        order[at][0].main = True


def _leave(stack: list[Node], depth: int, opened: Counter[str]) -> None:
    opened.subtract(x.tag for x in stack[depth:])
    del stack[depth:]


def _close_implied(stack: list[Node], tag: str, opened: Counter[str]) -> None:
    """Open elements that a new block of this kind ends."""
    ends = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}}.get(tag, {"p"})
    holds = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "td", "blockquote"}
    if not any(opened[x] for x in ends):
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in ends:
            _leave(stack, depth, opened)
            return
        if stack[depth].tag in holds and stack[depth].tag not in ends:
            return


def blocks(root: Node) -> Iterator[tuple[str, str]]:
    """(path of the container, text) of every main-text block in page order."""
    for path, text, _ in numbered_blocks(root):
        yield path, text


def numbered_blocks(root: Node) -> Iterator[tuple[str, str, int]]:
    """:func:`blocks` with the block's number in :func:`tree_of` its outline, -1 if too deep."""
    stack: list[tuple[Node, str, int, Iterator]] = [(root, "", 0, iter(_stretches(root)))]
    numbered = 1
    while stack:
        _, path, number, rest = stack[-1]
        for x in rest:
            if isinstance(x, str):
                yield path, x, number
            elif x.main:
                at = numbered if len(stack) <= DEPTH else -1
                numbered += at >= 0
                # Paths end at the same depth as outlines.
                below = path if at < 0 else f"{path}/{x.label}"
                stack.append((x, below, at, iter(_stretches(x))))
                break
        else:
            stack.pop()


def _stretches(node: Node) -> list[str | Node]:
    """A node's folded texts and child blocks in page order."""
    found: list[str | Node] = []
    piece: list[str] = []
    for x in [*node.items, None]:
        if isinstance(x, str):
            piece.append(x)
            continue
        text = " ".join("".join(piece).split())
        if text:
            found.append(text)
        piece = []
        if x is not None:
            found.append(x)
    return found


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 16


# --- wrapper induction ---------------------------------------------------------

# A tree for matching: (label, text digest or 0, characters, children, path, number).
Tree = tuple

# Trees are shallow as a rule; a page nested deeper is cut there, which only leaves its
# lower nodes unaligned.
DEPTH = 200


def outline(node: Node, depth: int = 0) -> list:
    """What matching needs of a tree: [label, digest, characters, children].

    What is no main text is left out.
    """
    joined = " ".join(node.own_texts())
    children = []
    if depth < DEPTH:
        children = [outline(c, depth + 1) for c in node.children if c.main]
    return [node.label, _digest(joined) if joined else 0, len(joined), children]


def tree_of(found: list, path: str = "", numbers: Iterator[int] | None = None) -> Tree:
    """An outline with the path of every node and its number in page order."""
    label, digest, size, children = found
    numbers = numbers or count()
    number = next(numbers)
    below = tuple(tree_of(c, f"{path}/{c[0]}", numbers) for c in children)
    return label, digest, size, below, path, number


def match_trees(a: Tree, b: Tree) -> list[tuple[Tree, Tree]]:
    """Pairs of aligned nodes of two trees with equal roots."""
    memo: dict[tuple[int, int], float] = {}

    def table(x: Tree, y: Tree) -> list[list[float]]:
        above = [0.0] * (len(y[3]) + 1)
        grid = [above]
        for p in x[3]:
            row = [0.0]
            for j, q in enumerate(y[3]):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if p[0] == q[0]:
                    paired = above[j] + weight(p, q)
                    if paired > best:
                        best = paired
                row.append(best)
            grid.append(row)
            above = row
        return grid

    def weight(x: Tree, y: Tree) -> float:
        # A node counts one, and half more if its text is the same.
        own = 1.5 if x[1] and x[1] == y[1] else 1.0
        if not x[3] or not y[3]:
            return own
        key = (id(x), id(y))
        if key not in memo:
            memo[key] = own + table(x, y)[-1][-1]
        return memo[key]

    pairs = []
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        if not x[3] or not y[3]:
            continue
        grid = table(x, y)
        i, j = len(x[3]), len(y[3])
        while i and j:
            here = grid[i][j]
            p, q = x[3][i - 1], y[3][j - 1]
            if p[0] == q[0] and here == grid[i - 1][j - 1] + weight(p, q):
                todo.append((p, q))
                i, j = i - 1, j - 1
            elif here == grid[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return pairs


def host_of(url: str | None) -> str:
    match = _HOST.match(url or "")
    return match[1].lower() if match else ""


def _hosted(url: str) -> Column:
    """:func:`host_of` as a column."""
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST.pattern, 1), F.lit("")))


def _outlines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_batches(batches, 500):
        found = [json.dumps(outline(parse(x.as_py())), separators=(",", ":")) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string())],
            names=["page_id", "host", "outline"],
        )


def _align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pages of a batch say about their hosts' nodes, added up."""
    references: dict[str, Tree] = {}
    for batch in in_batches(batches, 2000):
        found: dict[tuple, list[int]] = {}
        for host, own, other in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if host not in references:
                if len(references) > 200:
                    references.clear()
                references[host] = tree_of(json.loads(other))
            for node, page_node in match_trees(references[host], tree_of(json.loads(own))):
                if not node[1] and not page_node[1]:
                    continue
                # The container of a childless block is its parent.
                path = node[4] if node[3] else node[4].rpartition("/")[0]
                same = node[1] == page_node[1]
                entry = found.setdefault((host, path, node[1], node[5]), [0, 0, 0])
                entry[0] += 1
                entry[1] += same
                entry[2] += 0 if same else page_node[2]
        if found:
            keys = list(zip(*found))
            sums = list(zip(*found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0]), pa.array(keys[1]), pa.array(keys[2], pa.int64()),
                 pa.array(keys[3], pa.int32()), *(pa.array(s, pa.int64()) for s in sums)],
                names=["host", "path", "digest", "node", "aligned", "same", "varying"],
            )


def container(mass: dict[str, int], enter_share: float = ENTER_SHARE) -> str:
    """The path that holds most of the text, entered from the top; "" is the whole page."""
    below: dict[str, int] = {}
    for path, size in mass.items():
        while True:
            below[path] = below.get(path, 0) + size
            if not path:
                break
            path = path.rpartition("/")[0]
    children: dict[str, list[str]] = {}
    for path in below:
        if path:
            children.setdefault(path.rpartition("/")[0], []).append(path)
    at, total = "", below.get("", 0)
    mains = [p for p in below if p and p.rpartition("/")[2].partition(".")[0] in MAIN]
    mains = [p for p in mains if below[p] >= MAIN_SHARE * total]
    if mains:
        return min(mains, key=lambda p: (len(p), -below[p], p))
    while at in children and at.rpartition("/")[2].partition(".")[0] not in MAIN:
        largest = max(children[at], key=lambda p: (below[p], p))
        if below[largest] < enter_share * total:
            break
        at = largest
    return at


def wrappers(
    pages: DataFrame, template_share: float = TEMPLATE_SHARE, template_pages: int = TEMPLATE_PAGES
) -> DataFrame:
    """(_host, container, template, reference): per host a path, the numbers of the
    reference outline's template nodes, and that outline if there are any.

    ``pages`` has the columns page_id, host and html. Pages of a host with equal outlines
    count once, so that copies do not make their own text template.
    """
    outlines = stored(
        pages.select("page_id", "host", "html").mapInArrow(
            _outlines, "page_id long, host string, outline string"
        ),
        "outlines",
    )
    different = stored(
        outlines.groupBy("host", F.xxhash64("outline").alias("digest"))
        .agg(F.min(F.struct("page_id", "outline")).alias("least"))
        .select("host", "least.page_id", "least.outline"),
        "different-outlines",
    )
    references = stored(
        different.groupBy("host").agg(F.min(F.struct("page_id", "outline")).alias("least"))
        .select(F.col("host").alias("_host"), F.col("least.outline").alias("reference")),
        "reference-pages",
    )
    aligned = (
        different.join(references, F.col("host") == F.col("_host"))
        .select("host", "outline", "reference")
        .mapInArrow(
            _align,
            "host string, path string, digest long, node int, aligned long, same long, varying long",
        )
        .groupBy("host", "path", "digest", "node")
        .agg(F.sum("aligned").alias("aligned"), F.sum("same").alias("same"),
             F.sum("varying").alias("varying"))
    )

    def induce(frame: pd.DataFrame) -> pd.DataFrame:
        # As many rows as the reference page has blocks.
        mass = frame.groupby("path")["varying"].sum()
        constant = frame[
            (frame["digest"] != 0) & (frame["aligned"] >= template_pages)
            & (frame["same"] >= template_share * frame["aligned"])
        ]
        at = container({p: int(v) for p, v in mass.items() if v > 0})
        varied = mass.sum() > 0
        return pd.DataFrame({
            "_host": [frame["host"].iloc[0]],
            "container": [at if varied else None],
            "template": [sorted(constant["node"].tolist()) if varied else []],
        })

    induced = aligned.groupBy("host").applyInPandas(
        induce, "_host string, container string, template array<int>"
    )
    return induced.join(references, "_host").withColumn(
        "reference", F.when(F.size("template") > 0, F.col("reference"))
    )


def main_text(
    source: str | None, path: str | None, template: set[int], reference: Tree | None = None
) -> str:
    """The text below ``path``; without one, below the page's own main container.

    Blocks aligned with a node of ``reference`` whose number is in ``template`` are left
    out if their text is the same; equal text elsewhere stays.
    """
    root = parse(source)
    found = list(numbered_blocks(root))
    inside = [] if path is None else [x for x in found if _below(x[0], path)]
    if not inside and found:
        mass: dict[str, int] = {}
        for p, t, _ in found:
            parent = p.rpartition("/")[0]
            mass[parent] = mass.get(parent, 0) + len(t)
        own = container(mass)
        inside = [x for x in found if _below(x[0], own)]
    gone: set[int] = set()
    if template and reference and inside:
        pairs = match_trees(reference, tree_of(outline(root)))
        gone = {y[5] for x, y in pairs if x[5] in template and x[1] == y[1]}
    return " ".join(t for _, t, number in inside if number not in gone)


def _below(path: str, top: str) -> bool:
    return not top or path == top or path.startswith(top + "/")


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    references: dict[str, Tree] = {}
    for batch in in_batches(batches, 500):
        texts = []
        for s, p, t, r in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
            if r and r not in references:
                if len(references) > 200:
                    references.clear()
                references[r] = tree_of(json.loads(r))
            texts.append(main_text(s, p, set(t or ()), references.get(r)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html",
    template_share: float = TEMPLATE_SHARE, template_pages: int = TEMPLATE_PAGES,
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Null, empty and broken html give what text there is, at worst an empty one. A null url
    and one without a host share the empty host. A host whose pages do not vary, such as
    one with a single page, has no wrapper; its pages' own fullest container counts.
    Repeated rows and rows without an id are extracted like others. Other columns play no part; an
    empty table gives an empty result.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html")
    ).withColumn("host", _hosted("url"))
    # Stored, so that Spark knows how small it is before it joins the pages to it.
    found = stored(
        wrappers(rows.select("page_id", "host", "html"), template_share, template_pages), "wrappers"
    )
    return (
        rows.join(found, F.col("host") == F.col("_host"), "left")
        .select("page_id", "url", "html", "container", "template", "reference")
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
    )
