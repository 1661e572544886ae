"""Page extraction: ratios against a plain parser, pages with known articles, odd class names, broken and huge markup."""

from __future__ import annotations

import html as entities
import math
import random
import time
from html.parser import HTMLParser

import pytest
from samples import prose

from kilnwatch.llm import html


class Plain(HTMLParser):
    """Paths and texts of well-formed pages without anything excluded."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.path, self.rows, self.block, self.links = [], [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.block += tag in html.BLOCKS
        name = dict(attrs).get("class")
        self.path.append(f"{tag}.{name}" if name else tag)
        self.links += tag == "a"

    def handle_endtag(self, tag):
        self.block += tag in html.BLOCKS
        self.path.pop()
        self.links -= tag == "a"

    def handle_data(self, data):
        self.rows.append((tuple(self.path), self.block, data, self.links > 0))


def plain_scores(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    sums = {}
    for path, block, text, link in parser.rows:
        own = sums.setdefault(path, {"chars": 0, "linked": 0, "marks": 0, "blocks": set()})
        own["chars"] += len(text.strip())
        own["linked"] += len(text.strip()) if link else 0
        own["marks"] += sum(c in ".,;:!?。，！？；…" for c in text)
        own["blocks"].add(block)
    values = list(sums.values())
    lengths = [max(0, v["chars"] - 2 * v["linked"]) / len(v["blocks"]) for v in values]
    marks = [v["marks"] / len(v["blocks"]) for v in values]

    def smooth(of, k):
        around = (0.25, of[k - 1] if k else 0), (0.5, of[k]), (0.25, of[k + 1] if k + 1 < len(of) else 0)
        return sum(w * x for w, x in around)

    return [
        (v["chars"], v["linked"], v["marks"], math.log1p(smooth(lengths, k)) * (1 + math.log1p(smooth(marks, k))))
        for k, v in enumerate(values)
    ]


def tree(rng, depth):
    parts = []
    for _ in range(rng.randint(1, 4)):
        tag = rng.choice(["div", "section", "b", "i", "a", "span", "h2"])
        name = rng.choice(["", "", ' class="x1"', ' class="lead"'])
        inside = tree(rng, depth - 1) if depth and rng.random() < 0.6 else entities.escape(prose(rng, rng.randint(1, 30)))
        parts.append(f"<{tag}{name}>{inside}</{tag}>{rng.choice(['', ' tail.', ' and, more!'])}")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(20))
def test_ratios_of_paths(seed):
    page = tree(random.Random(seed), 4)
    nodes = html.shown(html.parsed(page))
    found = [(s.chars, s.linked, s.marks, s.score) for s in html.path_scores(nodes).values()]
    for own, want in zip(found, plain_scores(page), strict=True):
        assert own[:3] == want[:3] and math.isclose(own[3], want[3], rel_tol=1e-12, abs_tol=1e-12)


def a_page(rng, marked, wrapper):
    """A page and its article: headings, paragraphs with links, a list, beside menus, adverts, shares and comments."""
    blocks, lines = [], []

    def add(tag, inside, text):
        blocks.append(f"<{tag}>{inside}</{tag}>")
        lines.append(text)

    title = "A title of some words"
    add("h1", title, title)
    for _ in range(rng.randint(4, 9)):
        words = " ".join(prose(rng, rng.randint(25, 60)).split()) + "."
        head, _, tail = words.partition(" ")
        add("p", f"{head} <a href='/x'>{head}</a> {tail}", f"{head} {head} {tail}")
        if rng.random() < 0.4:
            short = "Short " + rng.choice(["one", "two"])
            add("h2", short, short)
    share = "<ul class='links'><li><a href=1>Tell</a></li><li><a href=2>Send</a></li><li><a href=3>Print</a></li></ul>"
    blocks.insert(len(blocks) // 2, share)
    menu = "".join(f"<li><a href='/{k}'>{prose(rng, 2)}</a></li>" for k in range(8))
    inner = "".join(blocks)
    body = f"<{'article' if marked else 'div'} class='{wrapper}'>{inner}</{'article' if marked else 'div'}>"
    comment = f"<div class='reader-comments'><p>{prose(rng, 30)}</p><p>{prose(rng, 25)}</p></div>"
    side = f"<div class='left-sidebar'><p>{prose(rng, 12)}</p></div>"
    page = (
        f"<html><head><title>t</title></head><body class='page-with-header'><ul id='main-menu'>{menu}</ul>{side}"
        f"{body}{comment}<div class='site-footer'>About us, and more.</div></body></html>"
    )
    return page, "\n".join(" ".join(line.split()) for line in lines)


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("wrapper", ["has-sidebar", "text", "no-comments wide", "story-body"])
def test_known_articles(marked, wrapper):
    for seed in range(12):
        page, article = a_page(random.Random(seed), marked, wrapper)
        assert html.main_text(page) == article


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>out</p><article class='has-sidebar'><p>One, two. And three, four.</p></article>", "One, two. And three, four."),
        ("<main class='with-sidebar'><p>One, two. And three.</p></main>", "One, two. And three."),
        ("<article><h1 class='page-header'>T</h1><p class='story-form'>One, two. Three.</p></article>", "T\nOne, two. Three."),
        ("<form><article><p>All in a form, one, two. Three.</p></article></form>", "All in a form, one, two. Three."),
        ("<div class='ad'>Buy, now. Here.</div><p>Text is longer than that, one, two. Three.</p>", "Text is longer than that, one, two. Three."),
        ("<article><p title='a > b < c'>One, two.</p><p data-x=\"'\">It's 1 < 2 &amp; 3.</p></article>", "One, two.\nIt's 1 < 2 & 3."),
        ("<article><p>One, two.<!-- <p>no</p> --> Three.</p></article><!-- open", "One, two. Three."),
        ("<article hidden><p>No.</p></article><article><p>Yes, one. Two.</p></article>", "Yes, one. Two."),
        ("", ""), ("<", "<"), ("<p", "<p"), ("</p>", ""), ("<a href='x", "<a href='x"),
    ],
)
def test_odd_names_and_marks(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 100_000, "<a " * 350_000, '<a "' * 250_000, "<a '>" * 200_000, "<b>" * 100_000 + "<p>x" * 100_000,
        "<div>" * 100_000 + "</p>x" * 100_000, "<p><b>x" * 100_000, "<ul><li>x" * 100_000, "<li><ul>" + "<b>" * 100_000 + "<li>x" * 100_000,
        "<i><div>" + "<b>" * 100_000 + "</i>x" * 100_000, "<!--" * 250_000, "<script>" * 120_000, "<" * 1_000_000, "word " * 400_000,
    ],
)
def test_huge_markup_takes_linear_time(page):
    begin = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - begin < 20


def test_clashing_columns(spark, documents):
    pages = spark.createDataFrame([(1, "u", "<p>One, two.</p>")], "page_id bigint, url string, html string")
    extra = pages.selectExpr("*", "1 AS text", "2 AS n_chars", "'x' AS path")
    assert [tuple(r) for r in html.main_texts(extra).collect()] == [(1, "u", "One, two.", 9)]
