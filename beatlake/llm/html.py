"""Main text of web pages by wrapper induction over the pages of a host.

A page's elements are folded into a skeleton: siblings with the same label (tag and first class) are one node.
The most frequent skeleton of a host is its reference, and every page's skeleton is aligned with it by simple
tree matching. Blocks of text that stand in the same aligned node on nearly all pages of a host, and in nearly all
of several distinct articles, are template; what varies there is a slot, whose text is content unless its place
says otherwise (menus, adverts, notices, forms, comments; lists of links where a page has no article).

Pages are not evidence by themselves, as copies of one article share its whole body. A page whose own text is
shorter than what it shares with nearly all others counts as a copy, and all copies of a host are one article.
The others are told apart by the least hash of their own blocks, so that copies among them mostly count once.

Skeletons and blocks are counted over all pages, partially before each shuffle, so that a host may hold any
share of them. What a page needs of its host is one row, joined by host: Spark broadcasts it where it is small
and else shuffles both sides, splitting hot hosts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import saved

TEMPLATE_SHARE = 0.8
TEMPLATE_ARTICLES = 5
LINK_SHARE = 0.5
MAX_DEPTH = 200
TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|/([a-zA-Z][^\s/>]*)[^>]*>
    |([a-zA-Z][^\s/>]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>)""",
    re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# Which open element of its own kind a start tag ends, and what it doesn't look beyond.
ENDS_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
DROPPED = set(
    "head script style template noscript nav footer aside form button select textarea iframe svg object embed canvas "
    "dialog menu audio video map title xmp noembed noframes".split()
)
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer masthead cookie cookies consent notice notices gdpr popup modal newsletter subscribe "
    "subscription share sharing social related recommended comment comments respond disqus login signup toolbar widget "
    "pagination pager banner".split()
)
COMMENT_WORDS = set("comment comments respond disqus".split())
# Words that only say where or how large something is; a name made of these and the words above means the same.
PLACE_WORDS = set(
    "area bar block bottom box buttons col column container content global group header inner item items left links list "
    "main outer page primary right row secondary section side site thread top unit wrap wrapper".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+")

Block = tuple[int, str, int, bool, bool, bool]  # skeleton node, text, characters in links, dropped, in an article, heading


class Page:
    """Skeleton and blocks of a page. ``nodes`` are (parent, label) in order of appearance, the first is the root."""

    def __init__(self, html: str) -> None:
        self.nodes: list[tuple[int, str]] = [(-1, "")]
        self.blocks: list[Block] = []
        self._children: dict[tuple[int, str], int] = {}
        self._depth = [0]  # of every node
        # Open elements: tag, node, dropped, in an article. All are kept; how many are open of each tag saves searches.
        self._open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self._count: Counter[str] = Counter()
        self._drops: Counter[str] = Counter()  # inline elements where dropped text begins
        self._text: list[str] = []
        self._links = self._link_chars = 0
        self._read(html)

    def _read(self, html: str) -> None:
        # Behind the last ">" no tag ends, so that no search runs to the end in vain.
        at, last = 0, html.rfind(">") + 1
        while found := TOKEN.search(html, at, last):
            if found.start() > at:
                self._add(html[at : found.start()])
            at = found.end()
            if found[1]:
                self._end(found[1].lower())
            elif found[2]:
                tag = found[2].lower()
                self._start(tag, found[3] or "")
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
                    at = end.start() if end else len(html)
            elif found[0].startswith("<!--") and not found[0].endswith("-->"):
                at = len(html)
        rest = html[at:]
        self._add(rest[: rest.find("<!--")] if "<!--" in rest else rest)
        self._flush()

    def _add(self, text: str) -> None:
        if self._open[-1][0] in RAW:
            return
        self._text.append(text)
        if self._links:
            self._link_chars += len(text.strip())

    def _flush(self) -> None:
        if self._text:
            joined = "".join(self._text)
            text = SPACE.sub(" ", unescape(joined)).strip()
            if text:
                tag, node, dropped, article = next(x for x in reversed(self._open) if x[0] not in INLINE)
                self.blocks.append((node, text, min(self._link_chars, len(text)), dropped, article, tag in HEADINGS))
        self._text, self._link_chars = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            if tag in ("br", "wbr"):
                self._text.append(" " if tag == "br" else "")
            elif tag not in VOID:
                self._links += tag == "a"
                parent = self._open[-1]
                dropped = parent[2] or bool(attributes) and _dropped(tag, attributes, parent[3])
                if dropped and not parent[2]:
                    self._flush()
                    self._drops[tag] += 1
                self._push(tag, parent[1], dropped, parent[3])
            return
        self._flush()
        if tag in ENDS_PARAGRAPH:
            self._end("p")
        if tag in ENDS_SAME:
            same, stop = ENDS_SAME[tag]
            for x in reversed(self._open):
                if x[0] in stop or not any(self._count[name] for name in same):
                    break
                if x[0] in same:
                    self._end(x[0])
        if tag in VOID:
            return
        _, above, dropped, article = self._open[-1]
        key = (above, _label(tag, attributes))
        # In the skeleton, though not among the open elements, deeper elements count as part of the deepest.
        node = self._children.get(key) if self._depth[above] < MAX_DEPTH else above
        if node is None:
            node = self._children[key] = len(self.nodes)
            self.nodes.append(key)
            self._depth.append(self._depth[above] + 1)
        inside = article or tag in ("article", "main") or "main" in attributes and _attributes(attributes).get("role") == "main"
        self._push(tag, node, dropped or _dropped(tag, attributes, article), inside)

    def _push(self, tag: str, node: int, dropped: bool, article: bool) -> None:
        self._open.append((tag, node, dropped, article))
        self._count[tag] += 1

    def _end(self, tag: str) -> None:
        if not self._count[tag]:
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] == tag:
                break
            if tag in INLINE and self._open[at][0] not in INLINE and not self._drops[tag]:
                return  # as below
        if tag not in INLINE or self._open[at][2] and not self._open[at - 1][2]:
            self._flush()
        elif any(x[0] not in INLINE for x in self._open[at:]):
            return  # an inline end tag doesn't reach out of a block
        self._links -= sum(x[0] == "a" for x in self._open[at:])
        for below, x in zip(self._open[at - 1 :], self._open[at:]):
            self._count[x[0]] -= 1
            self._drops[x[0]] -= x[0] in INLINE and x[2] and not below[2]
        del self._open[at:]

    def skeleton(self) -> str:
        """The folded tree as text, children in brackets, in order of their first appearance."""
        below: list[list[int]] = [[] for _ in self.nodes]
        for node, (parent, _) in enumerate(self.nodes[1:], 1):
            below[parent].append(node)
        texts = [""] * len(self.nodes)
        for node in range(len(self.nodes) - 1, -1, -1):  # children come after their parents
            texts[node] = self.nodes[node][1] + (f"({','.join(texts[x] for x in below[node])})" if below[node] else "")
        return texts[0]


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): unescape(value.strip("\"'")) for name, value in ATTRIBUTE.findall(text)}


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> str:
    first = _attributes(attributes).get("class", "").split()[:1] if "class" in attributes.lower() else []
    return re.sub(r"[^a-z0-9.:-]", "", tag) + "".join("." + re.sub(r"[^A-Za-z-]", "", name) for name in first)


@lru_cache(maxsize=4096)
def _dropped(tag: str, attributes: str, article: bool) -> bool:
    """Whether the element's name, class, id or role says that it is not main text.

    A class or id says so only as a whole: "top-menu" does, "restaurant-menu" or "related-work" may be anything. An
    article is one whatever it is called, unless it is a reader's comment.
    """
    if tag in DROPPED or tag == "header" and not article:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    told = _attributes(attributes)
    if "hidden" in told or told.get("aria-hidden") == "true" or "display:none" in told.get("style", "").replace(" ", ""):
        return True
    if told.get("role", "").lower() in DROPPED_ROLES:
        return True
    if article and tag in INLINE:  # a word of a sentence, whatever its class
        return False
    names = [set(WORDS.findall(name)) for name in (*told.get("class", "").lower().split(), told.get("id", "").lower())]
    told_words = set().union(*(words for words in names if words <= DROPPED_WORDS | PLACE_WORDS))
    return bool(told_words & (COMMENT_WORDS if tag == "article" else DROPPED_WORDS))


def tree_of(skeleton: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children of the nodes of a skeleton, in its order."""
    labels, below, open_nodes = [""], [[]], [0]
    current = 0
    for token in re.findall(r"[^(),]+|[(),]", skeleton):
        if token == "(":
            open_nodes.append(current)
        elif token == ")":
            open_nodes.pop()
        elif token != ",":
            labels.append(token)
            below.append([])
            current = len(labels) - 1
            below[open_nodes[-1]].append(current)
    return labels, below


def simple_tree_matching(one: str, other: str) -> dict[int, int]:
    """The largest order-keeping matching of two skeletons: nodes of the first to nodes of the second.

    Roots match if their labels are equal; then their children are aligned in order for the most matches below.
    """
    (labels_a, below_a), (labels_b, below_b) = tree_of(one), tree_of(other)
    sizes: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    stack = [(0, 0, False)]
    while stack:
        a, b, ready = stack.pop()
        if not ready:
            stack.append((a, b, True))
            stack += [(x, y, False) for x in below_a[a] for y in below_b[b] if labels_a[x] == labels_b[y]]
            continue
        rows, columns = below_a[a], below_b[b]
        best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
        for i, x in enumerate(rows, 1):
            for j, y in enumerate(columns, 1):
                pair = sizes[x, y][0] if labels_a[x] == labels_b[y] else 0
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + pair)
        pairs, i, j = [], len(rows), len(columns)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((rows[i], columns[j]))
        sizes[a, b] = (1 + best[-1][-1], pairs)
    matched, ahead = {}, [(0, 0)]
    while ahead:
        a, b = ahead.pop()
        matched[a] = b
        ahead += sizes[a, b][1]
    return matched


@lru_cache(maxsize=1024)
def aligned(nodes: tuple[tuple[int, str], ...], skeleton: str, reference: str) -> list[int]:
    """For each node of a page the reference's node that it matches, or -1."""
    order: list[int] = []  # the page's nodes in the order in which its skeleton lists them
    below: list[list[int]] = [[] for _ in nodes]
    for node, (parent, _) in enumerate(nodes[1:], 1):
        below[parent].append(node)
    ahead = [0]
    while ahead:
        node = ahead.pop()
        order.append(node)
        ahead += reversed(below[node])
    matching = simple_tree_matching(skeleton, reference)
    out = [-1] * len(nodes)
    for at, node in enumerate(order):
        out[node] = matching.get(at, -1)
    return out


def name_of(node: int, text: str) -> int:
    """A signed 64-bit name of a block of the template: where it stands and what it says."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), node + 1)
    return value - (1 << 64) if value >> 63 else value


def block_names(page: Page, reference: str) -> list[int | None]:
    """Names of the page's blocks in the reference's nodes; None where a block stands in no matched node."""
    places = aligned(tuple(page.nodes), page.skeleton(), reference)
    return [name_of(places[block[0]], block[1]) if places[block[0]] >= 0 else None for block in page.blocks]


def placed(page: Page, names: list[int | None]) -> list[tuple[Block, int | None]]:
    """Blocks with their names where main text may stand: in the article, or without one where not mostly links are."""
    article = any(block[4] and not block[3] for block in page.blocks)
    return [
        (block, name)
        for block, name in zip(page.blocks, names)
        if not block[3] and (block[4] if article else block[2] <= LINK_SHARE * len(block[1]))
    ]


def article_of(page: Page, names: list[int | None], common: set[int]) -> int:
    """The least hash of the page's own blocks, or zero for a copy: a page whose common blocks are longer than its own."""
    blocks = [(block[1], name in common) for block, name in placed(page, names) if not block[5]]
    own = [text for text, shared in blocks if not shared]
    if not own or 2 * sum(map(len, own)) < sum(len(text) for text, _ in blocks):
        return 0
    return min(name_of(0, text) for text in own)


def main_text(page: Page, reference: str, template: set[int]) -> str:
    """Blocks of the article, or without one all blocks that aren't mostly links, less what the template has."""
    names = block_names(page, reference) if template else [None] * len(page.blocks)
    chosen = [(block, name in template and not block[5]) for block, name in placed(page, names)]
    # Where all of a page is like its siblings, it is a copy, and its text is still its text.
    varying = [block[1] for block, fixed in chosen if not fixed]
    if not any(not fixed and not block[5] for block, fixed in chosen):
        varying = [block[1] for block, _ in chosen]
    return "\n".join(varying)


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Page(html.as_py() or "").skeleton() for html in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["host", "skeleton"])


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and name of every block, once a page."""
    for batch in batches:
        hosts, names = [], []
        for host, html, reference in zip(*(batch.column(at) for at in range(3))):
            own = {name for name in block_names(Page(html.as_py() or ""), reference.as_py()) if name is not None}
            hosts += [host.as_py()] * len(own)
            names += sorted(own)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(names, pa.int64())], names=["host", "name"])


def _articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, name and article of every common block once a page, and once with name NULL for the page."""
    for batch in batches:
        hosts, names, articles = [], [], []
        for host, html, reference, common in zip(*(batch.column(at).to_pylist() for at in range(4))):
            page, wanted = Page(html or ""), set(common)
            found = block_names(page, reference)
            own = [None, *sorted(wanted.intersection(found))]
            hosts += [host] * len(own)
            names += own
            articles += [article_of(page, found, wanted)] * len(own)
        columns = [pa.array(hosts, pa.string()), pa.array(names, pa.int64()), pa.array(articles, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "name", "article"])


def _extractor(schema_names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, reference, template in zip(*(batch.column(at) for at in (2, 3, 4))):
                texts.append(main_text(Page(html.as_py() or ""), reference.as_py(), set(template.as_py() or ())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=schema_names)

    return extract


def host_of(url: str = "url") -> Column:
    """The host of an address in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame, share: float = TEMPLATE_SHARE) -> DataFrame:
    """host, reference, template; a written table.

    The template are names of blocks on at least ``share`` of the host's pages, and of its articles, and in several.
    """
    rows = pages.select(host_of().alias("host"), "html")
    counts = saved(
        rows.mapInArrow(_skeletons, "host string, skeleton string").groupBy("host", "skeleton").agg(F.count("*").alias("n")), "html-skeletons"
    )
    references = saved(
        counts.groupBy("host").agg(F.max(F.struct("n", "skeleton"))["skeleton"].alias("reference"), F.sum("n").alias("pages")),
        "html-references",
    )
    names = rows.join(references, "host").select("host", "html", "reference").mapInArrow(_names, "host string, name long")
    common = (
        names.groupBy("host", "name").agg(F.count("*").alias("n"))
        .where("n > 1")
        .join(references.select("host", "pages"), "host")
        .where(F.col("n") >= share * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("name").alias("common"))  # 1 / share as many as a page has blocks, on average
    )
    shared = saved(references.where(F.col("pages") >= TEMPLATE_ARTICLES).join(common, "host").select("host", "reference", "common"), "html-common")
    seen = saved(
        rows.join(shared, "host").select("host", "html", "reference", "common")
        .mapInArrow(_articles, "host string, name long, article long")
        .distinct()
        .groupBy("host", "name")
        .agg(F.count("*").alias("n")),
        "html-articles",
    )
    articles = seen.where(F.col("name").isNull()).select("host", F.col("n").alias("articles"))
    template = (
        seen.where(F.col("name").isNotNull() & (F.col("n") >= TEMPLATE_ARTICLES))
        .join(articles, "host")
        .where(F.col("n") >= share * F.col("articles"))
        .groupBy("host")
        .agg(F.collect_list("name").alias("template"))
    )
    return saved(references.join(template, "host", "left").select("host", "reference", "template"), "html-wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """A row a page: page_id, url, text, n_chars.

    NULL and empty html give empty text. Pages without a host in their address share one wrapper; a host with few
    articles has a wrapper without template. Repeated rows and ids are pages of their own, no rows give no rows, and
    further columns don't matter.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of().alias("host"))
    joined = source.join(wrappers(pages), "host").select("page_id", "url", "html", "reference", "template")
    texts = joined.mapInArrow(_extractor(["page_id", "url", "text"]), "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
