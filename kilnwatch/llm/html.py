"""Main text of web pages by tag-path ratios (operator 2).

A page is cut into text nodes, each with the path of tags from the root. Per path, the lengths of its texts, their
punctuation and the text inside links are added up. Two ratios per path, text per block and punctuation per block, are
smoothed over the paths in page order, fused by multiplication and compared with a threshold: paths above it, most of
whose text is no link, hold content. Around them stay short blocks that the ratios alone would lose: inside an element
that marks an article and holds content, all paths but those of links; elsewhere, blocks beside content (children of
the same path) that stand between it, and headings beside it.

Names of elements, classes, ids and roles that never hold the article (menus, adverts, forms, comments) are left out
first. A class excludes by a name as a whole; a part of a longer name ("left-sidebar") excludes only a box, never a
heading, a paragraph or a marked article, and not in names that tell of a box elsewhere ("has-sidebar"). Nothing
excluded by a class, and no form, may hold most of the page's text: such an element is taken for a frame around it.

Parsing is linear in the page, in the depth of its elements and in what is left open: paths are numbered, and an end
tag looks for its element only if there is one.

Defined results: a null or empty page gives an empty text; a page without markup is its own text; broken nesting is
closed as browsers do; repeated rows are extracted one by one; an empty table gives an empty result; extra columns are
ignored, null ids and addresses are passed on.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from kilnwatch.llm.tables import map_texts

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

#: Elements that start a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p"
    " pre section summary table tbody td tfoot th thead title tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; only their own end tag closes them.
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
#: Elements that never hold the article's text.
OUTSIDE = frozenset(
    "head nav footer header aside menu button select script style noscript template textarea title iframe svg"
    " math dialog object audio video canvas option datalist noembed noframes label input".split()
)
#: Elements inside an article that stay part of it although they are outside elsewhere.
INSIDE_ARTICLE = frozenset(["header"])
#: Words of class, id and role that mark what is not the article.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner popup modal cookie cookies"
    " consent gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget"
    " widgets related recommended recommendations footer header masthead toolbar comment comments disqus respond reply"
    " replies share sharing social newsletter subscribe subscription signup login search form pagination pager"
    " copyright skip outbrain taboola complementary contentinfo".split()
)
HIDDEN = re.compile(r"(?:^|[\s;])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Elements that name the article.
ARTICLE = frozenset(["article", "main"])
ARTICLE_WORDS = frozenset(
    "article articlebody post entry content story main maincontent postcontent entrycontent articlecontent".split()
)
#: Boxes that a part of a class name may exclude, and parts that say a name is about another box.
BOXES = frozenset("div section ul ol dl table tr td span figure header footer aside nav form details".split())
ELSEWHERE = frozenset("has with without no not is hide show main body page".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening one of the same group closes when it is still open.
CLOSES = {
    "p": frozenset(["p"]),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
#: Block elements close an open paragraph.
CLOSE_PARAGRAPH = BLOCKS - {"br", "p", "option", "optgroup", "caption", "tbody", "thead", "tfoot", "tr", "td", "th"}
#: Nothing closes an element beyond these.
SCOPES = frozenset("table ul ol dl article section main div body html aside nav footer header form td th".split())

OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
QUOTED = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?。，！？；…]")
SPACE = re.compile(r"\s+")

#: Weight of the neighbouring paths, and the share of the mean score that a content path reaches.
SMOOTH = (0.25, 0.5, 0.25)
THRESHOLD = 0.5


@dataclass(slots=True)
class Node:
    """A piece of text: its path, its block and what its ancestors say."""

    path: int
    block: int
    text: str
    excluded: int
    article: int
    link: bool


@dataclass(slots=True)
class Element:
    tag: str
    path: int
    outside: bool
    excluded: int
    article: int
    link: bool


@dataclass(slots=True)
class PathSum:
    nodes: int = 0
    chars: int = 0
    linked: int = 0
    marks: int = 0
    score: float = 0.0
    blocks: set[int] = field(default_factory=set)

    @property
    def mostly_links(self) -> bool:
        return 2 * self.linked >= self.chars


@dataclass
class Page:
    """Text nodes in order; the parent and tag of each path; the parents of what classes exclude."""

    nodes: list[Node] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    within: list[int] = field(default_factory=lambda: [0])


def _attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)
    }


def _excludes(tag: str, names: list[str]) -> bool:
    """Whether one of the names says that a box is not the article."""
    for name in names:
        if name.lower() in OUTSIDE_WORDS:
            return True
        parts = set(WORD.findall(CAMEL.sub(" ", name).lower()))
        if tag in BOXES and parts & OUTSIDE_WORDS and not parts & ELSEWHERE:
            return True
    return False


class _Parser:
    """Builds a ``Page``.

    ``open`` counts the elements of each tag on the stack, ``scopes`` and ``flows`` those since each element that
    limits what an opening tag closes, or an inline end tag: what is looked for is there, and goes with all above it.
    """

    def __init__(self, source: str):
        self.source = source
        self.page = Page()
        self.paths: dict[tuple[int, str], int] = {}
        self.stack = [Element("", 0, False, 0, 0, False)]
        self.open: Counter[str] = Counter()
        self.scopes, self.flows = [Counter()], [Counter()]
        self.block = 0
        self.unpaired = {'"': False, "'": False}

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if raw and not top.outside:
            self.page.nodes.append(Node(top.path, self.block, html.unescape(raw), top.excluded, top.article, top.link))

    def push(self, element: Element) -> None:
        self.stack.append(element)
        self.open[element.tag] += 1
        for limits, counts in ((SCOPES, self.scopes), (BLOCKS, self.flows)):
            if element.tag in limits:
                counts.append(Counter())
            counts[-1][element.tag] += 1

    def close(self, wanted: frozenset[str]) -> None:
        """Close the innermost element of these tags, which there is."""
        while True:
            tag = self.stack.pop().tag
            self.open[tag] -= 1
            for limits, counts in ((SCOPES, self.scopes), (BLOCKS, self.flows)):
                counts[-1][tag] -= 1
                if tag in limits:
                    counts.pop()
            if tag in wanted:
                return

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag, outside quotes where these are closed; -1 without one."""
        place = at
        while found := QUOTED.search(self.source, place):
            place = found.end()
            if found[0] == ">":
                return found.start()
            if not self.unpaired[found[0]]:
                closing = self.source.find(found[0], place)
                if closing < 0:
                    self.unpaired[found[0]] = True
                else:
                    place = closing + 1
        return self.source.find(">", at)

    def element(self, tag: str, attributes: str, number: int) -> Element:
        above = self.stack[-1]
        names: list[str] = []
        hidden = False
        if attributes.strip(" /\n\t"):
            known = _attributes(attributes)
            names = [w for key in ("class", "id", "role", "itemprop") for w in known.get(key, "").split()]
            hidden = (
                "hidden" in known
                or known.get("aria-hidden", "").lower() == "true"
                or bool(HIDDEN.search(known.get("style", "")))
            )
        barred = tag not in ("html", "body") and _excludes(tag, names) or tag == "form"
        marked = tag in ARTICLE or any(
            WORD.findall(CAMEL.sub(" ", n).lower()) and set(WORD.findall(CAMEL.sub(" ", n).lower())) <= ARTICLE_WORDS
            for n in names
        )
        article = above.article or number * (marked and not barred)
        outside = above.outside or hidden or tag in OUTSIDE and not (above.article and tag in INSIDE_ARTICLE)
        excluded = above.excluded
        if barred and not outside:
            self.page.within.append(excluded)
            excluded = len(self.page.within) - 1
        key = above.path, f"{tag}.{names[0]}" if names else tag
        path = self.paths.get(key)
        if path is None:
            path = self.paths[key] = len(self.page.parents)
            self.page.parents.append(above.path)
            self.page.tags.append(tag)
        return Element(tag, path, outside, excluded, article, above.link or tag == "a")

    def end(self, tag: str) -> None:
        # An inline end tag does not close a block around it.
        if (self.open if tag in BLOCKS else self.flows[-1])[tag]:
            self.close(frozenset([tag]))

    def close_for(self, tag: str) -> None:
        """Close what an opening tag ends."""
        closes = CLOSES.get(tag) or (frozenset(["p"]) if tag in CLOSE_PARAGRAPH else frozenset())
        while any(self.scopes[-1][closed] for closed in closes):
            self.close(closes)

    def raw_end(self, tag: str, at: int) -> int:
        """Where the content of a raw element has ended, its end tag included."""
        stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(self.source, at)
        closing = self.source.find(">", stop.start()) if stop else -1
        return len(self.source) if closing < 0 else closing + 1

    def run(self) -> Page:
        source, at, end = self.source, 0, len(self.source)
        while at < end:
            found = OPENING.search(source, at)
            if not found:
                self.text(source[at:])
                break
            tag = (found[2] or "").lower()
            if not tag:
                self.text(source[at : found.start()])
                mark = "-->" if found[0] == "<!--" else ">"
                closing = source.find(mark, found.end())
                at = end if closing < 0 else closing + len(mark)
                continue
            stop = self.tag_end(found.end())
            if stop < 0:
                # No tag ends any more.
                self.text(source[at:])
                break
            self.text(source[at : found.start()])
            at = stop + 1
            if tag in BLOCKS:
                self.block += 1
            if found[1]:
                self.end(tag)
                continue
            self.close_for(tag)
            if tag in VOID:
                continue
            attributes = source[found.end() : stop]
            if tag in RAW and not attributes.endswith("/"):
                at = self.raw_end(tag, at)
                continue
            self.push(self.element(tag, attributes, at))
        return self.page


def parsed(source: str) -> Page:
    """The page's text nodes in order."""
    return _Parser(source).run()


def shown(page: Page) -> list[Node]:
    """The nodes that no class excludes; what holds most of the text is not excluded."""
    sizes = [0] * len(page.within)
    for node in page.nodes:
        sizes[node.excluded] += len(node.text.strip())
    total = sum(sizes)
    for number in range(len(sizes) - 1, 0, -1):
        sizes[page.within[number]] += sizes[number]
    barred = [False] * len(sizes)
    for number in range(1, len(sizes)):
        barred[number] = barred[page.within[number]] or 2 * sizes[number] <= total
    return [node for node in page.nodes if not barred[node.excluded]]


def path_scores(nodes: list[Node]) -> dict[int, PathSum]:
    """Ratios per path, smoothed over neighbouring paths and fused."""
    paths: dict[int, PathSum] = {}
    for node in nodes:
        own = paths.setdefault(node.path, PathSum())
        size = len(node.text.strip())
        own.nodes += 1
        own.chars += size
        own.linked += size * node.link
        own.marks += len(PUNCTUATION.findall(node.text))
        own.blocks.add(node.block)
    sums = list(paths.values())
    # Texts inside links count as much against a path as its other texts count for it.
    lengths = [max(0, s.chars - 2 * s.linked) / max(1, len(s.blocks)) for s in sums]
    marks = [s.marks / max(1, len(s.blocks)) for s in sums]
    for place, own in enumerate(sums):
        smooth = [
            sum(
                weight * values[place + step]
                for step, weight in zip((-1, 0, 1), SMOOTH, strict=True)
                if 0 <= place + step < len(values)
            )
            for values in (lengths, marks)
        ]
        own.score = math.log1p(smooth[0]) * (1 + math.log1p(smooth[1]))
    return paths


def chosen(page: Page) -> list[Node]:
    """The nodes of the article."""
    nodes = shown(page)
    paths = path_scores(nodes)
    weight = sum(s.chars for s in paths.values())
    mean = sum(s.score * s.chars for s in paths.values()) / weight if weight else 0.0
    content = {
        path for path, own in paths.items() if own.score >= THRESHOLD * mean and own.chars and not own.mostly_links
    }
    # Links in a running text belong to it: their path lies below a content path.
    parents = page.parents
    below = [False] * len(parents)
    for path in range(1, len(parents)):
        below[path] = below[parents[path]] or parents[path] in content
    articles = {n.article for n in nodes if n.article and n.path in content and n.text.strip()}
    if articles:

        def held(node: Node) -> bool:
            return node.path in content or below[node.path] or not paths[node.path].mostly_links

        return [n for n in nodes if n.article in articles and (held(n) or not n.text.strip())]
    beside = {parents[path] for path in content}
    places = [k for k, n in enumerate(nodes) if n.path in content and n.text.strip()]
    if not places:
        return []
    first, last = places[0], places[-1]

    def stays(k: int, node: Node) -> bool:
        if node.path in content or below[node.path]:
            return True
        if paths[node.path].mostly_links and node.text.strip() or parents[node.path] not in beside:
            return False
        return first < k < last or page.tags[node.path] in HEADINGS

    return [n for k, n in enumerate(nodes) if stays(k, n)]


def main_text(page: str) -> str:
    """The article of a page, one line per block."""
    if not page:
        return ""
    blocks: dict[int, list[str]] = {}
    for node in chosen(parsed(page)):
        blocks.setdefault(node.block, []).append(node.text)
    lines = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length for each page."""

    def work(batch, sources):
        texts = [main_text(source.decode("utf-8", "replace")) for source in sources]
        return {
            "page_id": batch.column(0),
            "url": batch.column(1),
            "text": texts,
            "n_chars": list(map(len, texts)),
        }

    return map_texts(pages.select("page_id", "url", "html"), "html", SCHEMA, work)
