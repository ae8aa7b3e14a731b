"""Main text of web pages by tag-path ratios.

A page is a sequence of text nodes (what stands between two block-level tags),
each under a root-to-leaf path of tags with their class and id words.  For
every path, text length outside links and punctuation are summed and divided
by its number of nodes; the two ratios are smoothed along the page, fused by
their product and thresholded by their deviation.  A path is content where the
nodes above the threshold hold most of its text, and its nodes are selected.

The main element is the article (or main) with most of the selected text, or
the least element that holds ``WHOLE`` of it.  The text is every selected node
of it, and what stands between them.  What stands before the first or after
the last of them is kept too where the element is marked off from the rest of
the page (it is no body), unless most of it is links; in a body only headings
before the text are.  Tags that are no content (menus, footers, forms ...) stay
out; names (menu, advert, comments ...) are evidence, which puts out no element
that holds ``MOST`` of the selected text, unless an article stands elsewhere.

References are decoded, white space inside a node is one space, empty nodes
go, and nodes are joined in page order by one line feed.  A null page has
empty text; unclosed tags, comments and scripts end where browsers end them;
equal rows give equal texts, a null page_id or url stays null, no rows give no
rows, and a kept column with a made one's name becomes ``<name>_in``.
"""

from __future__ import annotations

import html as references
import math
import re
from bisect import bisect_left
from statistics import fmean, pstdev
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import held

NAME = re.compile(r"""[a-zA-Z][^\s/>"']*""")
SPECIAL = re.compile(r"""[>"']""")
RAW = {x: re.compile(rf"</{x}\s*>", re.I) for x in "script style noscript template textarea svg iframe".split()}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# fixed values: elements of HTML
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"option", "body", "html", "head", "title"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# fixed values: what is no main text, by tag and by word of class, id or role
NO_CONTENT = set("head title nav header footer aside form button select option dialog menu label legend".split())
NO_CONTENT_WORDS = re.compile(
    r"^(?:ad|ads|advert|adverts|advertisement|advertising|banner|banners|breadcrumb|breadcrumbs|comment|comments|complementary|contentinfo|consent|cookie|cookies|disqus|footer|gdpr|header|login|masthead|menu|menus|modal|nav|navbar|navigation|newsletter|notice|notices|overlay|pagination|pager|popup|promo|promos|promotion|recommended|related|replies|reply|respond|share|sharing|sidebar|sidebars|signup|skip|social|sponsor|sponsored|subscribe|subscription|toc|toolbar|widget|widgets)$"
)
CONTAINERS = set("article main section div td body html blockquote figure".split())
MARKS = re.compile(r"[.,;:!?…。，、！？]")
WIDTH = 1  #: nodes to each side in smoothing
MOST = 0.5  #: of the selected text; what holds more is no menu or advert, whatever its name
WHOLE = 0.9  #: of the selected text that the main element holds
LINKS = 0.5  #: of a node's characters; one with more in links is no text where text begins or ends
HEADING = re.compile(r"h[1-6](?:\.|$)")


class Node(NamedTuple):
    """A text node: its text, the numbers of its path and of its innermost element (0: none), characters in links."""

    text: str
    path: int
    element: int
    links: int


class Page:
    """Text nodes and the elements above them, by number in the order in which they open; 0 is the page itself.

    An element knows the one around it, and by that all above it.  Paths are
    numbers too, one for each sequence of labels.
    """

    def __init__(self) -> None:
        self.nodes: list[Node] = []
        self.parent, self.last, self.tag, self.path = [0], [0], [""], [0]
        self.named, self.doubtful, self.article, self.heading = [0], [False], [0], [False]
        self.paths: dict[tuple[int, str], int] = {}

    def open(self, above: int, tag: str, label: str, doubtful: bool) -> int:
        number = len(self.parent)
        self.parent.append(above)
        self.last.append(number)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[above], label), len(self.paths) + 1))
        self.doubtful.append(doubtful)
        self.named.append(number if doubtful else self.named[above])  # the innermost doubtful element
        self.article.append(number if tag in ("article", "main") else self.article[above])
        self.heading.append(self.heading[above] or bool(HEADING.match(label)))
        return number

    def gathered(self, own: list[int]) -> list[int]:
        """Sums over all that is inside each element."""
        out = list(own)
        for k in range(len(out) - 1, 0, -1):
            out[self.parent[k]] += out[k]
        return out


def tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of ``>``, ``"`` and ``'``, and for each where a tag ends whose attributes go on there; -1: nowhere."""
    places = [m.start() for m in SPECIAL.finditer(page)]
    ends, after = [-1] * len(places), {'"': -1, "'": -1}  # after: number of the next quote of the kind
    for k in range(len(places) - 1, -1, -1):
        mark = page[places[k]]
        if mark == ">":
            ends[k] = places[k]
            continue
        shut = after[mark]
        ends[k] = ends[shut + 1] if 0 <= shut < len(places) - 1 else -1
        after[mark] = k
    return places, ends


def tokens(page: str):
    """Start and end of everything that is no text, with slash, tag name and attributes of tags ("" and "" for others)."""
    places, ends = tag_ends(page)
    at = page.find("<")
    while at >= 0:
        to, slash, tag, rest = -1, "", "", ""
        if page.startswith("<!--", at):
            to = page.find("-->", at + 4)
            to = to + 3 if to >= 0 else len(page)
        elif page[at + 1 : at + 2] in ("!", "?"):
            to = page.find(">", at + 1) + 1 or -1
        else:
            begin = at + 1 + page.startswith("/", at + 1)
            k = bisect_left(places, begin)
            end = ends[k] if k < len(places) else -1
            name = NAME.match(page, begin, end) if end >= 0 else None
            if name:
                slash, tag, rest, to = page[at + 1 : begin], name[0].lower(), page[name.end() : end], end + 1
                if not slash and tag in RAW:
                    shut = RAW[tag].search(page, to)
                    tag, to = "", shut.end() if shut else len(page)
        if to >= 0:
            yield at, to, slash, tag, rest
        at = page.find("<", max(to, at + 1))


def parsed(page: str) -> Page:
    """Every text node outside tags of no content, in time that grows with the page's length."""
    made = Page()
    stack: list[tuple[str, int, bool]] = []  # tag, number, no content by tag
    places: dict[str, list[int]] = {}  # of each tag's open elements in the stack
    hidden = 0
    pieces, linked, at = [], [], 0

    def take(piece: str) -> None:
        pieces.append(piece)
        if places.get("a"):
            linked.append(piece)

    def flush() -> None:
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            links = len(" ".join(references.unescape(" ".join(linked)).split()))
            pieces.clear()
            linked.clear()
            if text and not hidden:
                element = stack[-1][1] if stack else 0
                made.nodes.append(Node(text, made.path[element], element, min(links, len(text))))

    def close(tags: set[str], barriers: set[str]) -> None:
        nonlocal hidden
        deepest = lambda names: max((places[x][-1] for x in names if places.get(x)), default=-1)
        k = deepest(tags)
        if k < 0 or deepest(barriers - tags) > k:
            return
        flush()
        while len(stack) > k:
            tag, number, out = stack.pop()
            places[tag].pop()
            hidden -= out
            made.last[number] = len(made.parent) - 1

    for start, end, slash, tag, rest in tokens(page):
        if start > at:
            take(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if slash:
            close({tag}, set() if tag in BLOCK else CONTAINERS)
            continue
        if tag in CLOSES_P:
            close({"p"}, CONTAINERS)
        if tag in SIBLINGS:
            close(SIBLINGS[tag], {"ul", "ol", "table", "dl", "select", "menu"})
        if tag in VOID or rest.endswith("/") and tag not in BLOCK:
            continue
        named = [w for m in NAMES.finditer(rest) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()) if w]
        out = tag in NO_CONTENT and tag != "form" and not (tag == "header" and bool(places.get("article")))
        doubtful = tag == "form" or any(map(NO_CONTENT_WORDS.match, named)) and tag not in ("body", "html", "article", "main")
        number = made.open(stack[-1][1] if stack else 0, tag, ".".join([tag, *named]), doubtful)
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, number, out))
        hidden += out
    if at < len(page):
        take(page[at:])
    flush()
    for _, number, _ in stack:
        made.last[number] = len(made.parent) - 1
    made.last[0] = len(made.parent) - 1
    return made


def smoothed(values: list[float]) -> list[float]:
    """Gaussian weights over the neighbours."""
    weights = [math.exp(-k * k / (2 * (WIDTH / 2) ** 2)) for k in range(-WIDTH, WIDTH + 1)]
    out = []
    for i in range(len(values)):
        near = [(values[i + k], w) for k, w in zip(range(-WIDTH, WIDTH + 1), weights, strict=True) if 0 <= i + k < len(values)]
        out.append(sum(v * w for v, w in near) / sum(w for _, w in near))
    return out


def fused(nodes: list[Node]) -> list[float]:
    """Length and punctuation ratios of the nodes' paths, smoothed along the page, and their product."""
    totals: dict[int, list[int]] = {}
    for node in nodes:
        total = totals.setdefault(node.path, [0, 0, 0])
        total[0] += len(node.text) - node.links
        total[1] += len(MARKS.findall(node.text)) if node.links < len(node.text) else 0
        total[2] += 1
    length = smoothed([totals[n.path][0] / totals[n.path][2] for n in nodes])
    marks = smoothed([totals[n.path][1] / totals[n.path][2] for n in nodes])
    return [a * (1 + b) for a, b in zip(length, marks, strict=True)]


def selected(nodes: list[Node]) -> list[bool]:
    """Whether each node is on a content path: nodes above the threshold hold most of the path's text."""
    values = fused(nodes)
    least = min(0.5 * pstdev(values), 0.5 * fmean(values))
    above: dict[int, int] = {}
    for node, value in zip(nodes, values, strict=True):
        above[node.path] = above.get(node.path, 0) + (len(node.text) if value >= least else -len(node.text))
    return [above[n.path] > 0 for n in nodes]


def unnamed(page: Page) -> list[Node]:
    """Nodes outside elements named as no content; a name does not put out what holds most, unless an article is elsewhere and none in it."""
    size, plain = [0] * len(page.parent), False
    for node, chosen in zip(page.nodes, selected(page.nodes), strict=True):
        size[node.element] += len(node.text) if chosen else 0
        plain |= page.article[node.element] > 0 and not page.named[node.element]
    # the innermost article above a node, of the nodes inside each element: the greatest number
    inner = [0] * len(page.parent)
    for node in page.nodes:
        inner[node.element] = page.article[node.element]
    for k in range(len(inner) - 1, 0, -1):
        inner[page.parent[k]] = max(inner[page.parent[k]], inner[k])
    weight = page.gathered(size)
    out = [False] * len(page.parent)
    for k in range(1, len(out)):
        stays = weight[k] > MOST * weight[0] and (inner[k] > k or not plain)
        out[k] = out[page.parent[k]] or page.doubtful[k] and not stays
    return [n for n in page.nodes if not out[n.element]]


def main_element(page: Page, nodes: list[Node], chosen: list[bool]) -> tuple[int, bool]:
    """Number of the element that holds the main text (0: the page), and whether it is marked off from the page."""
    size, there = [0] * len(page.parent), [0] * len(page.parent)
    for node, take in zip(nodes, chosen, strict=True):
        there[node.element] = 1
        size[node.element] += len(node.text) if take else 0
    weight, there = page.gathered(size), page.gathered(there)
    held = [k for k in range(1, len(weight)) if there[k]]
    articles = [k for k in held if page.tag[k] in ("article", "main")]
    if articles:
        best = max(articles, key=lambda k: (weight[k], k))
        if weight[best] > MOST * weight[0]:
            return best, True
    # elements are numbered as they open: the last is the least
    best = max((k for k in held if page.tag[k] in CONTAINERS and weight[k] >= WHOLE * weight[0]), default=0)
    return best, (page.tag[best] or "body") not in ("body", "html")


def main_text(text: str | None) -> str:
    page = parsed(text or "")
    nodes = page.nodes
    if any(page.named[n.element] for n in nodes):
        nodes = unnamed(page)
    if not nodes:
        return ""
    chosen = selected(nodes)
    element, apart = main_element(page, nodes, chosen)
    inside = [(n, take) for n, take in zip(nodes, chosen, strict=True) if element <= n.element <= page.last[element]]
    at = [i for i, (_, take) in enumerate(inside) if take]
    kept = []
    for i, (node, take) in enumerate(inside):
        heading = page.heading[node.element] and i < at[0]
        if take or at[0] < i < at[-1] or ((apart or heading) and node.links <= LINKS * len(node.text)):
            kept.append(node.text)
    return "\n".join(kept)


def main_texts(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars of every page."""
    source = pages.select(*held(pages, keep, ["_html", "text", "n_chars"]), F.col(html).alias("_html"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("_html").to_pylist()]
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)
