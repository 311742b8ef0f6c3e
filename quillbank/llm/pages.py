"""HTML extraction with a site style tree."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.llm.urls import url_parts

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+|[^>]*+)>|<[!?/][^>]*+>""", re.S)
#: A whole name and its value, so that no name is found inside another name or a value.
ATTRIBUTE = re.compile(r"""([^\s"'=/>]++)(?:\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s"'>][^\s>]*+))?""")
#: Fixed values of HTML: elements without content, with raw text, and that stand as blocks of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of a page, and elements that are usually no part of an article.
SILENT = frozenset("script style head noscript template button select svg iframe object embed textarea title audio video canvas".split())
CHROME = frozenset("nav header footer aside form dialog menu search".split())
#: Words of class, id or role that speak against content, and words that say nothing beside them.
NOISE = frozenset(
    "ad ads adv advert advertisement adverts advertising adbox adsense banner banners sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login sidebar sidebars widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs "
    "pagination pager menu menus nav navbar navigation footer header masthead topbar toolbar comment comments commentlist disqus reply replies respond copyright "
    "contentinfo complementary search form skip".split()
)
NEUTRAL = frozenset("area article bar block bottom box container content entry global group inner item items js left link links list main outer page panel post posts primary right row secondary section site slot top unit wrap wrapper".split())
MAIN = frozenset(("article", "main"))
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_WORDS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


def _noisy(token: str) -> bool:
    """Whether a token of class, id or role speaks against content: one word that does, and none that says something else."""
    if token in NOISE:
        return True
    words = [w for w in _WORDS.split(token) if w and not w.isdigit()]
    return any(w in NOISE for w in words) and all(w in NOISE or w in NEUTRAL for w in words)


#: What marks add to a branch's importance (which is 0 to 1, ``UNKNOWN`` where a host has too few pages): for elements and
#: names that speak against content, a header within an article, and other branches of an article. Comments and lists of
#: related pages change from page to page as much as articles do, so no importance outweighs what speaks against them.
AGAINST, HEADER, WITHIN, UNKNOWN = -0.8, 0.0, 0.1, 0.5


def _style(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The element's name in the style tree, whether it holds no text to read, and whether its names speak against content."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    silent = tag in SILENT or "hidden" in found or found.get("aria-hidden") == "true"
    noise = tag not in ("html", "body", "main") and any(map(_noisy, " ".join(found.get(k, "") for k in ("class", "id", "role")).split()))
    return f"{tag}.{found['class']}" if found.get("class") else tag, silent, noise


@dataclass
class Node:
    """A style node of one page: all containers of one path of element names. ``path`` hashes that path."""

    path: int
    up: int
    noise: bool
    main: bool
    chrome: bool = False
    shift: float = 0.0
    texts: list[str] = field(default_factory=list)
    children: list[str] = field(default_factory=list)
    linked: int = 0


class Page:
    """One pass over a page: ``nodes`` (parents first), of menus and footers too, and ``blocks`` of text, each with its node."""

    def __init__(self, page: str) -> None:
        self.nodes, self.blocks = [Node(0, -1, False, False)], []
        self._known: dict[tuple[int, str, bool], int] = {}
        self._stack: list[tuple[str, int, bool]] = []  # tag, node, silent
        self._open: Counter[str] = Counter()
        self._text: list[str] = []
        self._links = self._anchors = 0
        self._read(page)

    def _flush(self) -> None:
        if self._text:
            joined = " ".join(entities.unescape("".join(self._text)).split())
            self._text.clear()
            if joined:
                node = self._stack[-1][1] if self._stack else 0
                self.blocks.append((node, joined))
                self.nodes[node].texts.append(joined)
                self.nodes[node].linked += min(self._links, len(joined))
        self._links = 0

    def _pop(self) -> None:
        if self._stack[-1][1] != (self._stack[-2][1] if len(self._stack) > 1 else 0):
            self._flush()  # the end of a node is the end of its text
        tag = self._stack.pop()[0]
        self._open[tag] -= 1
        self._anchors -= tag == "a"

    def _close(self, names: tuple[str, ...], within: tuple[str, ...]) -> None:
        if not any(self._open[n] for n in names):
            return
        for k in range(len(self._stack) - 1, -1, -1):
            if self._stack[k][0] in names:
                while len(self._stack) > k:
                    self._pop()
                return
            if self._stack[k][0] in within:
                return

    def _push(self, tag: str, attributes: str) -> None:
        name, no_text, noise = _style(tag, attributes)
        noise = noise and not (self._open["pre"] or self._open["code"])  # listings give their words classes
        node, silent = self._stack[-1][1:] if self._stack else (0, False)
        if no_text and not silent:
            self._flush()
        if not silent and not no_text and (tag in BLOCKS or noise):
            up = self.nodes[node]
            up.children.append(name)
            if tag not in BLOCKS:
                self._flush()
            chrome = tag in CHROME and not (tag == "header" and up.main)
            if noise or chrome or tag != "p":
                key = (node, name, noise)
                if key not in self._known:
                    self._known[key] = len(self.nodes)
                    shift = AGAINST if noise or chrome else HEADER if tag == "header" else WITHIN if up.main or tag in MAIN else 0.0
                    self.nodes.append(Node(xxhash.xxh64_intdigest(name, up.path), node, noise, up.main or tag in MAIN, chrome, shift))
                node = self._known[key]
        self._stack.append((tag, node, silent or no_text))
        self._open[tag] += 1
        self._anchors += tag == "a"

    def _read(self, page: str) -> None:
        at, end = 0, page.rfind(">") + 1
        while at < len(page):
            m = TOKEN.search(page, at, end)
            stop = m.start() if m else len(page)
            if stop > at and not (self._stack and self._stack[-1][2]):
                self._text.append(page[at:stop])
                if self._anchors > 0:
                    self._links += len(page[at:stop].strip())
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if tag == "br":
                self._text.append(" ")
                continue
            if tag in BLOCKS:
                self._flush()
            if m[1]:
                self._close((tag,), ())
                continue
            if tag in BLOCKS:
                self._close(("p",), ("td", "th", "table", "button", "article"))
            if tag in CLOSES:
                self._close(CLOSES[tag], ("ul", "ol", "dl", "table"))
            if tag in RAW:
                shut = re.compile(rf"</{tag}[^>]*>", re.I).search(page, at)
                at = shut.end() if shut else len(page)
            elif tag not in VOID:
                self._push(tag, m[3])
        self._flush()

    def branches(self) -> Iterator[tuple[int, int, int, float]]:
        """(path, content, presentation) hashes of every branch with text, and its shift; a node that adds nothing to its only branch is left out unless it has marks of its own."""
        content = [xxhash.xxh64("\n".join(n.texts), 1) if n.texts else None for n in self.nodes]
        below = [0] * len(self.nodes)
        for k in range(len(self.nodes) - 1, -1, -1):
            node, here = self.nodes[k], content[k]
            if here is None:
                continue
            if node.texts or below[k] > 1 or node.shift == AGAINST:
                yield node.path, here.intdigest() >> 1, xxhash.xxh64_intdigest(" ".join(node.children)) >> 1, node.shift
            if node.up >= 0:
                if content[node.up] is None:
                    content[node.up] = xxhash.xxh64(seed=2)
                content[node.up].update(here.digest())
                below[node.up] += 1


def article(page: str, less: frozenset[int]) -> str:
    """The page's blocks but for branches without importance, by path.

    ``less``: branches that the host's style tree removes though their marks don't. The marks of a page remove menus,
    footers, sidebars and forms, names that speak against content, and branches of three or more blocks that are
    mostly links.
    Where the articles left hold at least half of the text left, text outside of them is removed as well. A page
    without an article of importance keeps the branch that holds half of its text, unless its element is no content.
    """
    found = Page(page)
    nodes, own = found.nodes, [sum(map(len, n.texts)) for n in found.nodes]

    def branch(counts: list[int]) -> list[int]:
        out = counts[:]
        for k in range(len(out) - 1, 0, -1):
            out[nodes[k].up] += out[k]
        return out

    def under(marks: list[bool]) -> list[bool]:
        out = marks[:]
        for k in range(1, len(out)):
            out[k] = out[k] or out[nodes[k].up]
        return out

    def main_text(gone: list[bool]) -> int:
        return sum(c for c, n, g in zip(own, nodes, gone, strict=True) if n.main and not g)

    gone = under([n.chrome for n in nodes])
    # then in two rounds, first by what the marks say, then by the tree
    noisy = [n.noise or (not n.main and len(n.texts) > 2 and n.linked >= 0.8 * c) for n, c in zip(nodes, own, strict=True)]
    for marks in (noisy, [n.path in less for n in nodes]):
        size = branch([0 if g else c for c, g in zip(own, gone, strict=True)])
        some = main_text(under([a or b for a, b in zip(marks, gone, strict=True)])) > 0
        holds = branch([c if n.main and not g else 0 for c, n, g in zip(own, nodes, gone, strict=True)])
        gone = under([g or (m and (some or (2 * size[k] < size[0] and not holds[k]))) for k, (m, g) in enumerate(zip(marks, gone, strict=True))])
    inside = main_text(gone)
    if inside and 2 * inside >= sum(c for c, g in zip(own, gone, strict=True) if not g):
        gone = [g or not n.main for n, g in zip(nodes, gone, strict=True)]
    return "\n\n".join(t for k, t in found.blocks if not gone[k])


def style_tree(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The merged DOMs of each host: ``host, path, pages, content, presentation, shift, importance`` per style node (``path`` hashes its element names).

    ``content`` and ``presentation`` are entropies over the host's pages, each as a share of its maximum: of a node's
    text, and of the sequence of its child elements. The importance is their mean; ``shift`` is what the marks of the node
    add to it. Menus, footers and sidebars are nodes like all others. Pages with equal content count once. Tasks send
    three hashes for each node and page; sums per node are combined before they are shuffled.
    """
    schema = "host string, page long, path long, content long, presentation long, shift double"
    host, _ = url_parts(F.col(url).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                branches = list(Page(t.as_py() or "").branches())
                rows += [(h, branches[-1][1], p - (1 << 63), c, s, shift) for p, c, s, shift in branches]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), *[pa.int64()] * 4, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["host", "page", "path", "content", "presentation", "shift"])

    nodes = pages.select(host.alias("host"), F.col(html).cast("string").alias("html")).mapInArrow(run, schema).distinct()
    top = F.log2(F.greatest(F.sum("n"), F.lit(2)))
    entropy = (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")) / top
    spread = lambda c: nodes.groupBy("host", "path", c).agg(F.count("*").alias("n"), F.max("shift").alias("shift")).groupBy("host", "path").agg(F.sum("n").alias("pages"), F.max("shift").alias("shift"), entropy.alias(f"h_{c}"))
    both = spread("content").join(spread("presentation").drop("pages", "shift"), ["host", "path"])
    return both.select("host", "path", "pages", F.col("h_content").alias("content"), F.col("h_presentation").alias("presentation"), "shift", ((F.col("h_content") + F.col("h_presentation")) / 2).alias("importance"))


def extract_articles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", *, least: float = 0.45, min_pages: int = 3, broadcast_rows: int = 20_000) -> DataFrame:
    """The main text of every page: ``page_id, url, text``, a row per input row.

    Every branch of a page that holds text, menus and footers as well as articles, is weighed by the host's style tree
    (:func:`style_tree`). Its importance, plus what its marks add (``AGAINST``, ``HEADER``, ``WITHIN``), must reach
    ``least``: a branch without marks goes if it hardly changes from page to page, one of an article must repeat even
    more to go, and a header within an article stays if its text differs. The tree knows nodes of at least
    ``min_pages`` different pages; others have the importance ``UNKNOWN``, so their marks decide (:func:`article`).

    Only the nodes that the tree removes and the marks don't are sent to the pages: broadcast while they are at most
    ``broadcast_rows``, so that pages aren't shuffled, else joined by host, where adaptive execution splits a large
    one. Null html: empty text. Null url: the host is empty. Rows that repeat a page are extracted one by one. Very
    long, broken or deeply nested pages take one linear pass. An empty table gives an empty result.
    """
    use_checkpoints(pages.sparkSession)
    goes = (F.col("importance") + F.col("shift") < least) & (F.lit(UNKNOWN) + F.col("shift") >= least)
    by_host = style_tree(pages, html, url).filter(goes & (F.col("pages") >= min_pages)).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("less")).checkpoint()
    rows = by_host.agg(F.sum(F.size("less"))).first()[0] or 0
    host, _ = url_parts(F.col(url).cast("string"))
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(html).cast("string").alias("html"))
    met = base.join(F.broadcast(by_host) if rows <= broadcast_rows else by_host, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sets = [], {}
            for t, u in zip(b.column(2), b.column(3), strict=True):
                key = tuple(u.as_py() or ())
                if key not in sets:
                    sets[key] = frozenset(p + (1 << 63) for p in key)
                texts.append(article(t.as_py() or "", sets[key]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(base.dtypes)
    return met.select("page_id", "url", "html", "less").mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string")
