"""Main text of web pages by composite text density.

A page is parsed into a tree, from which elements that cannot be article text are
removed by tag, role or class name. Each node's density is its characters per tag,
adjusted for links: text inside links lowers it, the more so the less of the whole
page is links. A node's density sum adds its children's densities. The node with the
largest sum holds most of the content; the lowest density on its path up to the
body is the threshold. Every node from the body down that reaches the threshold marks
the subtree of the largest sum below it. A marked subtree inside an ``article`` or
``main`` element is widened to that element.

Text: character references are decoded, white space within a block becomes one
space, blocks are trimmed and joined by one line feed in page order.

Defined results: null and empty pages, and pages without text, give an empty text of
length 0. Unclosed tags end where the next block or their parent ends; an unfinished
tag or comment at the end is dropped. Repeated rows are extracted one by one; a null
key stays null; columns beside those named are not read. An empty table gives an
empty result. Nothing is capped: time grows with the page's length.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template xmp noembed noframes title textarea".split())
REMOVED = RAW | frozenset(
    "head nav aside footer form menu dialog button select option input label object applet canvas svg math "
    "audio video map".split()
)
REMOVED_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar".split())
NAMED = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advert\w*|adsense|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|newsletter|"
    r"subscri\w*|popups?|modals?|nav\w*|menus?|breadcrumbs?|sidebars?|side|footers?|masthead|comments?|disqus|replies|"
    r"respond|share|sharing|social|related|recommend\w*|widgets?|toolbar|pagination|pager|login|signup|skip)(?![a-z])"
)
# An element ends an open one of these when it starts.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"},
    "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
HOLDS_LISTS = frozenset("ul ol dl table select body article section div nav".split())

TAG = re.compile(r"</?([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


@dataclass
class Tree:
    """Nodes in page order; node 0 is the root.

    Texts are (node, text) in page order; a None marks where a block begins or ends.
    """

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    gone: list[bool] = field(default_factory=lambda: [False])
    texts: list[tuple[int, str | None]] = field(default_factory=list)


def _unwanted(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in REMOVED or (tag == "header" and not inside_article):
        return True
    if tag in ("body", "html", "article", "main") or not attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"' ").lower()
        if name == "role":
            if value in REMOVED_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return name == "aria-hidden" or not value or value == "hidden"
        elif tag not in ("p", "h1", "h2", "h3") and NAMED.search(value):
            return True
    return False


def parse(page: str) -> Tree:
    """A tolerant parser: whatever the markup, it ends and keeps the text's order."""
    tree, stack, holds, at, lower = Tree(), [0], [False], 0, None

    def text(value: str) -> None:
        if value and not tree.gone[stack[-1]]:
            tree.texts.append((stack[-1], value))

    def close(depth: int) -> None:
        if any(tree.tag[node] in BLOCKS for node in stack[depth:]):
            tree.texts.append((stack[depth], None))
        del stack[depth:]

    while True:
        open_at = page.find("<", at)
        if open_at < 0:
            text(page[at:])
            return tree
        text(page[at:open_at])
        after = page[open_at + 1 : open_at + 3]
        first = after[1:2] if after[:1] == "/" else after[:1]
        if not (first.isascii() and first.isalpha()):
            if page.startswith("<!--", open_at):
                end = page.find("-->", open_at + 4)
                at = end + 3
            elif after[:1] in ("!", "?", "/"):
                end = page.find(">", open_at)
                at = end + 1
            else:
                text("<")
                end, at = 0, open_at + 1
            if end < 0:
                return tree
            continue
        found = TAG.match(page, open_at) or LOOSE_TAG.match(page, open_at)
        if not found:
            return tree
        at, tag = found.end(), found[1].lower()
        if after[0] == "/":
            inline = tag not in BLOCKS
            for depth in range(len(stack) - 1, 0, -1):
                name = tree.tag[stack[depth]]
                if name == tag:
                    close(depth)
                    break
                if inline and name in BLOCKS:
                    break
            continue
        if tag in BLOCKS:
            # A paragraph cannot hold a block; neither can what is open inside it.
            for depth in range(len(stack) - 1, 0, -1):
                name = tree.tag[stack[depth]]
                if name == "p":
                    close(depth)
                    break
                if name in BLOCKS:
                    break
        if tag in ENDS:
            last = None
            for depth in range(len(stack) - 1, 0, -1):
                name = tree.tag[stack[depth]]
                if name in HOLDS_LISTS:
                    break
                if name in ENDS[tag]:
                    last = depth
            if last is not None:
                close(last)
        top = stack[-1]
        node = len(tree.tag)
        inside = holds[top] or tag in ("article", "main")
        tree.tag.append(tag)
        tree.parent.append(top)
        holds.append(inside)
        tree.gone.append(tree.gone[top] or _unwanted(tag, found[2], inside))
        if tag in BLOCKS:
            tree.texts.append((node, None))
        elif tag == "br":
            text(" ")
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else page
            end = lower.find("</" + tag, at)
            if end < 0:
                return tree
            at = end
            stack.append(node)
        elif tag not in VOID and not found[2].endswith("/"):
            stack.append(node)


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Link-adjusted density and density sum of each node; removed nodes have none."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    direct, in_link = [0] * n, [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
    for node, value in tree.texts:
        if value is None:
            continue
        size = len("".join(value.split()))
        chars[node] += size
        direct[node] += size
        link_chars[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not tree.gone[i]:
            up = tree.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (tree.tag[i] == "a")
    body = body_of(tree)
    share = link_chars[body] / chars[body] if chars[body] else 0.0
    own, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if tree.gone[i] or not chars[i]:
            continue
        per_tag, links = max(tags[i], 1), link_chars[i]
        own[i] = chars[i] / per_tag
        if share:
            ratio = (chars[i] / max(links, 1)) * (per_tag / max(link_tags[i], 1))
            base = math.log(chars[i] / max(chars[i] - links, 1) * links + share * chars[i] + math.e)
            own[i] *= math.log(max(ratio, 1.0)) / math.log(base)
        # Text that stands in the node itself counts like a child without tags.
        sums[i] += 0 if in_link[i] else direct[i]
        if i:
            sums[tree.parent[i]] += own[i]
    return own, sums


def body_of(tree: Tree) -> int:
    return next((i for i, t in enumerate(tree.tag) if t == "body" and not tree.gone[i]), 0)


def content_nodes(tree: Tree) -> list[bool]:
    """Which nodes belong to the content."""
    n, body = len(tree.tag), body_of(tree)
    own, sums = densities(tree)
    # Largest sum within each node's subtree, found from the leaves up.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        if not tree.gone[i] and sums[best[i]] > sums[best[up]]:
            best[up] = best[i]
    top, threshold = best[body], math.inf
    node = top
    while node >= 0:
        threshold = min(threshold, own[node])
        node = -1 if node == body else tree.parent[node]
    wide, reached, kept = list(range(n)), [False] * n, [False] * n
    marked = set()
    for i in range(n):
        up = tree.parent[i]
        if up >= 0 and tree.tag[wide[up]] in ("article", "main"):
            wide[i] = wide[up]
        reached[i] = not tree.gone[i] and own[i] > 0 and own[i] >= threshold and (i == body or (up >= 0 and reached[up]))
        if reached[i]:
            marked.add(best[i])
    marked = {wide[m] for m in marked}
    for i in range(n):
        kept[i] = not tree.gone[i] and (i in marked or (i > 0 and kept[tree.parent[i]]))
    return kept


def main_text(page: str) -> str:
    tree = parse(page)
    kept = content_nodes(tree)
    blocks: list[list[str]] = [[]]
    for node, value in tree.texts:
        if value is None:
            blocks.append([])
        elif kept[node]:
            blocks[-1].append(value)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of each row."""
    slim = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "") for p in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return slim.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
