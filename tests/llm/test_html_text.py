"""Pages whose names or markup must not hide the article, and pages that are expensive to read."""

import time

import numpy as np
import pytest

from ledgerloom.llm.html_text import LABELLED, LONG, blocks, decide, extract_text, features, main_text, trained

TREE = trained()


@pytest.mark.parametrize("page", [
    '<div class="page has-sidebar"><article><p>%s</p></article></div>',
    '<div id="content" class="with-sidebar"><p>%s</p></div>',
    '<div class="overflow-hidden"><main><p>%s</p></main></div>',
    '<div class="search"><main><p>%s</p></main></div>',
    '<article><p title="the hidden valley">%s</p></article>',
    '<article><p data-note="class=comments">%s</p></article>',
    '<article><section class="legal-history"><p>%s</p></section></article>',
    '<div id="share-price"><p>%s</p></div>',
    "<article><p title=it's>%s</p></article>",
    '<article><p title="a > b">%s</p></article>',
    "<article><p title = 'a > b' lang=en>%s</p></article>",
])
def test_the_article_stays(page):
    assert main_text(page % LONG, TREE) == LONG


@pytest.mark.parametrize("page", [
    '<article><div class="article-header"><h1>On wells</h1></div><p>%s</p></article>',
    '<article><h1 class="post-header">On wells</h1><p>%s</p></article>',
    '<article><div class="header"><h1>On wells</h1></div><p>%s</p></article>',
])
def test_an_articles_header_is_part_of_it(page):
    assert main_text(page % LONG, TREE) == f"On wells {LONG}"


@pytest.mark.parametrize("page", [
    '<div class="comments"><article><p>%s</p></article></div>',
    '<div class="related"><article><p>%s</p></article></div>',
    '<div class="share-buttons"><p>%s</p></div>',
    '<aside><article><p>%s</p></article></aside>',
    '<div class="legal-notice"><p>%s</p></div>',
    '<div STYLE="display: none"><p>%s</p></div>',
    "<div hidden><article><p>%s</p></article></div>",
    "<article class='comment'><p>%s</p></article>",
])
def test_other_parts_go(page):
    assert main_text(page % LONG, TREE) == ""


@pytest.mark.parametrize("piece", ["<p ", '<a "', '<a b="', "<a b='", "<!", "</p", "<x>", "<p>", "< ", "<!--", "&amp", "<script>"])
def test_a_megabyte_of_one_piece_is_read_in_linear_time(piece):
    start = time.process_time()
    blocks(piece * (1_000_000 // len(piece)))
    assert time.process_time() - start < 8


def test_a_tag_that_is_never_closed_is_text():
    assert [b.text for b in blocks("<p>one</p>two <b three")] == ["one", "two <b three"]


def test_the_tree_is_the_best_of_all_splits():
    """The first split of the trained tree against every column and limit."""
    rows = np.concatenate([features(blocks(page)) for page, _ in LABELLED])
    labels = np.array([int(m) for _, marks in LABELLED for m in marks])

    def cost(low):
        return sum(len(x) * x.mean() * (1 - x.mean()) for x in (labels[low], labels[~low]))

    costs = [
        cost(rows[:, c] <= limit) for c in range(rows.shape[1]) for limit in np.unique(rows[:, c])[:-1]
        if 2 <= (rows[:, c] <= limit).sum() <= len(rows) - 2
    ]
    assert cost(rows[:, TREE[0]] <= TREE[1]) == pytest.approx(min(costs))
    # Two short lines without a name or link (a login line, a year) are like short paragraphs to the tree.
    assert sum(decide(TREE, row) != label for row, label in zip(rows, labels.tolist(), strict=True)) <= 2


def test_repeated_rows_and_very_long_pages(spark):
    page = "<nav>Home</nav><article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    frame = spark.createDataFrame([(1, None, page), (1, None, page), (2, "u", ""), (3, "u", None)], "page_id long, url string, html string")
    got = sorted(map(tuple, extract_text(frame).select("page_id", "n_chars").collect()))
    size = 20_000 * (len(LONG) + 1) - 1
    assert got == [(1, size), (1, size), (2, 0), (3, 0)]
