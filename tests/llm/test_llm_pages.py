"""Main text of pages: forward-backward against enumeration, and pages that the training generator doesn't make."""

import itertools

import numpy as np
import pytest

from voxtile.llm import html_crf

TEXT = "<p>One long sentence about the weather in the north of the country.</p><p>Another paragraph that tells more about it, and ends.</p>"
LINES = ["One long sentence about the weather in the north of the country.", "Another paragraph that tells more about it, and ends."]
NAV = '<nav><ul><li><a href="#">Home</a></li><li><a href="#">About us</a></li></ul></nav>'
FOOT = "<footer><p>© 2024 Some site. All rights reserved.</p></footer>"


@pytest.fixture(scope="module")
def chain():
    return html_crf.fit(html_crf.labelled_pages())


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    lengths, longest = [1, 3, 5], 5
    score, t = rng.normal(size=(3, longest, 2)), rng.normal(size=(2, 2))
    mask = np.arange(longest) < np.array(lengths)[:, None]
    node, joint, total = html_crf.marginals(score, t, mask)
    for i, n in enumerate(lengths):
        weights = {y: np.exp(sum(score[i, k, v] for k, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=n)}
        whole = sum(weights.values())
        assert np.isclose(np.log(whole), total[i])
        for k in range(n):
            assert np.isclose(node[i, k, 1], sum(w for y, w in weights.items() if y[k]) / whole)
            if k:
                assert np.isclose(joint[i, k - 1, 0, 1], sum(w for y, w in weights.items() if (y[k - 1], y[k]) == (0, 1)) / whole)
        assert not node[i, n:].any() and not joint[i, max(n - 1, 0) :].any()


@pytest.mark.parametrize(
    "page",
    [
        f'{NAV}<article class="blog-post with-sidebar"><h1>Title</h1>{TEXT}</article>{FOOT}',
        f'{NAV}<div class="widget-content"><h1>Title</h1>{TEXT}</div>{FOOT}',
        f'{NAV}<div class="tabs"><h1>Title</h1>{TEXT}</div>{FOOT}',
        f"<header><h1>The site</h1></header>{NAV}<article><header><h1>Title</h1></header>{TEXT}</article>{FOOT}",
        f'{NAV}<div id="content"><h1>Title</h1>{TEXT}</div><div class="sidebar"><h3>Related</h3><p>Read this other text now.</p></div>{FOOT}',
        f'{NAV}<article><h1>Title</h1>{TEXT}</article><div class="comments">{TEXT * 6}</div>{FOOT}',
        f'{NAV}<article><h1>Title</h1>{TEXT}</article><section id="comments"><article class="comment"><p>Thank you for all of this.</p></article></section>',
        f'{NAV}<main><h1>Title</h1><svg class="i"/>{TEXT}</main><noscript>{FOOT}',
    ],
)
def test_pages_of_other_makes(chain, page):
    assert html_crf.main_text(chain, f"<html><body>{page}</body></html>").split("\n") == ["Title", *LINES]


@pytest.mark.parametrize(
    "part, lines",
    [
        ('<h2 id="search-strategy">How we searched</h2><p>We looked at all of it.</p>', ["How we searched", "We looked at all of it."]),
        ('<p class="lead share">The first paragraph, which says it all.</p>', ["The first paragraph, which says it all."]),
        ('<section class="related-work"><h2>Related work</h2><p>Others have looked at this before us.</p></section>', ["Related work", "Others have looked at this before us."]),
        ('<div class="header"><h1>A title in a box</h1></div>', ["A title in a box"]),
        ('<div class="post-header"><h1>A title in a box</h1></div>', ["A title in a box"]),
        ('<h3 class="footer-design">On the design of bridges</h3>', ["On the design of bridges"]),
        ('<ul class="contact-tracing"><li>First we asked who met whom.</li></ul>', ["First we asked who met whom."]),
        ('<div class="ad">Buy now</div><aside><h3>More</h3><ul><li><a href="/x">Other text</a></li></ul></aside>', []),
        ('<div class="newsletter-signup-form"><p>Get our letter every week.</p><input><button>Go</button></div>', []),
    ],
)
def test_parts_of_an_article_with_misleading_names(chain, part, lines):
    page = f"<html><body>{NAV}<article>{part}{TEXT}</article>{FOOT}</body></html>"
    assert html_crf.main_text(chain, page).split("\n") == [*lines, *LINES]


@pytest.mark.parametrize("last", ["Copyright 2024", "© 2024 The paper", "(c) 2019 A site", "Some Site. All rights reserved."])
def test_plain_pages_with_a_last_line(chain, last):
    assert html_crf.main_text(chain, f"<html><body>{NAV}<h1>Title</h1>{TEXT}<p>{last}</p></body></html>").split("\n") == ["Title", *LINES]


@pytest.mark.parametrize("name", ["prose", "markdown-body", "story-body"])
def test_names_learned_beside_the_lists(chain, name):
    page = f'{NAV}<div class="{name}"><h1>Title</h1>{TEXT}</div><div class="outbrain"><p>You may also like this one.</p></div>{FOOT}'
    assert html_crf.main_text(chain, f"<html><body>{page}</body></html>").split("\n") == ["Title", *LINES]


def test_given_pages_against_their_articles(chain, sf):
    """The pages of the tables have one article each: its text, cut at block tags by a plain pattern, is what has to come out."""
    import html
    import re

    duckdb = pytest.importorskip("duckdb")
    pages = duckdb.sql(f"select html from '{sf}/pages.parquet' where html is not null").fetchall()
    assert pages
    for (page,) in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S)
        if body is None or re.search(r"<(?!/?(?:h[1-6]|p|b|i|br|a|em|strong|ul|li)\b)", body[1]):
            continue
        cut = re.split(r"</?(?:h[1-6]|p|ul|li)\b[^>]*>", body[1])
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", x)).split()) for x in cut]
        assert html_crf.main_text(chain, page).split("\n") == [x for x in want if x]


def test_side_text_larger_than_the_article(chain):
    page = f'{NAV}<article><h1>Title</h1><p>Short but whole text of the article.</p></article><div class="sidebar">{TEXT * 5}</div>'
    assert html_crf.main_text(chain, page) == "Title\nShort but whole text of the article."


def test_extraction_of_odd_rows(spark, chain):
    """Null and empty pages, repeated rows, a very long page, a column named text and an empty table."""
    long = f"<article>{'<p>Some words of a long article, again and again.</p>' * 20_000}</article>"
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, f"<article>{TEXT}</article>", 5), (3, f"<article>{TEXT}</article>", 5), (4, long, 5)], "page_id long, html string, text int")
    got = sorted((r["page_id"], len(r["text"].split("\n")) if r["text"] else 0) for r in html_crf.extract(df, chain=chain).collect())
    assert got == [(1, 0), (2, 0), (3, 2), (3, 2), (4, 20_000)]
    assert html_crf.extract(df.limit(0), chain=chain).count() == 0
