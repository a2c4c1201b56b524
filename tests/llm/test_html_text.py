import html
import random
import re
import time

import pytest

from paylake.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style></head><body>
<header class="site-header"><h1>My site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies to make this site better for everyone. <button>OK</button></div>
<div id="content"><h2>A  headline</h2><p>Caf&eacute; &amp; <i>bar</i> op<b>en</b>ed <a href=x>today</a> in
the old town, and many people came to look at it for the first time.</p><!-- <p>no</p> -->
<p class="ad">Buy now, the best offer of the whole year for all of our many readers.</p><p>Short.</p>
<script>if (a < b) { x("</p>") }</script><p>It will stay open until the end of summer&#46;</p>
<section class="comments"><p>I think this was a great article, thanks for writing it.</p></section></div>
<aside><p>Related things that you might also like to read in the coming days.</p></aside>
<form><label>Name</label><input></form><footer><p>Copyright by all the people who made it.</p></footer>
"""
TEXT = (
    "A headline Café & bar opened today in the old town, and many people came to look at it for"
    " the first time. Short. It will stay open until the end of summer."
)


def test_structured_page():
    assert html_text.texts_of([PAGE]) == [TEXT]


def test_containers_by_class_and_id():
    body = "<p>The council met on Monday to talk about the new bridge, and many came to listen.</p>"
    page = (
        '<body class="has-sidebar"><div id="page" class="no-menu"><div class="site-header">Daily News'
        ' of the town, every day</div><article id="post-1" class="post tag-council category-alert">'
        f"<header><h1>A bridge</h1></header>{body}<div class=sponsored>Buy a boat, boats are cheap"
        " this week at the harbour.</div><p class='notice'>Please sign in to read more of this"
        " today.</p><h2>Costs</h2><p>Nine.</p><footer>Written by staff, shared by all of us.</footer>"
        '</article><div id="comments"><article class="comment"><p>I have always wanted a bridge'
        " there, thank you for the report.</p></article></div><div class='right-rail'><p>More news"
        " that you could read on another page of ours.</p></div></div></body>"
    )
    want = (
        "A bridge The council met on Monday to talk about the new bridge, and many came to listen."
        " Costs Nine."
    )
    assert html_text.texts_of([page]) == [want]


def test_page_without_telling_containers():
    page = (
        "<body><div><a href=a>One</a> | <a href=b>Two</a> | <a href=c>Three</a></div><div>"
        "<p>First paragraph of a page without any container that says what it is, long enough to"
        " be kept by its words.</p><p>Another one.</p><p>Second long paragraph of the same page,"
        " which also has quite a number of words in it to read.</p></div>"
        "<div><a href=x>Terms</a> <a href=y>Privacy</a></div></body>"
    )
    (text,) = html_text.texts_of([page])
    assert text.startswith("First paragraph") and "Another one." in text
    assert "Terms" not in text and "One" not in text


def test_articles_match_their_markup(spark, sf_dir):
    """On the given pages the article element is the main text: take it out by expression."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        inner = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")
        want = " ".join(html.unescape(inner).split())
        assert got[r.page_id].text == want
        assert got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_odd_pages(spark):
    pages = [
        (1, "u", None),
        (2, None, ""),
        (None, "u", "<p>" * 5000),
        (3, "u", "<!-- open <p>lost"),
        (4, "u", "<script>never closed"),
        (5, "u", "<article><p>&am; &amp &notareal; &#x41;&#0;</p></article>"),
        (5, "u", "<article><p>" + "word " * 200_000 + "</p></article>"),
        (6, "u", "<article>a < b and <unclosed"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = html_text.extract_text(df.selectExpr("*", "'x' as text", "1 as n_chars")).collect()
    assert len(got) == len(pages)
    by_size = {r.n_chars for r in got if r.page_id == 5}
    assert 5 * 200_000 - 1 in by_size
    assert [r.text for r in got if r.page_id in (1, 2, 3, 4)] == [""] * 4
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_tree_agrees_with_its_table():
    x, y = html_text.labelled_table()
    assert (html_text.classify(html_text.trained_tree(), x) == (y == 1)).mean() > 0.95


def test_shape_decides_where_nothing_tells(spark, sf_dir):
    """Names scrambled and article elements made plain: nearly all blocks are told by shape."""
    rng, right = random.Random(3), {True: [0, 0], False: [0, 0]}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        page = re.sub(
            r'(class|id|role)="[^"]*"', lambda m: f'{m.group(1)}="x{rng.randrange(999)}"', r.html
        )
        first, _, rest = page.partition("<article>")
        body, _, last = rest.partition("</article>")
        blocks = html_text.blocks_of(f"{first}<div>{body}</div>{last}")
        before = len(html_text.blocks_of(first))
        inside = range(before, before + len(html_text.blocks_of(f"<div>{body}</div>")))
        kept = html_text.classify(html_text.trained_tree(), html_text.features(blocks))
        for i, keep in enumerate(kept):
            right[i in inside][int(keep == (i in inside))] += 1
    for wrong, good in right.values():
        assert good > 100 and good >= 0.95 * (wrong + good)


def test_most_plain_blocks_are_told_by_words_and_links(spark, sf_dir):
    """Paths of the tree that look at no container, on the pages as they are."""
    tree, shape, all_blocks = html_text.trained_tree(), 0, 0
    telling = {html_text.FEATURES.index(x) for x in ("boiler", "inside", "hint")}
    assert html_text.FEATURES[tree.feature] not in ("boiler", "inside", "hint")
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        x = html_text.features(html_text.blocks_of(r.html))
        plain = x.copy()
        plain[:, sorted(telling)] = 0
        same = html_text.classify(tree, x) == html_text.classify(tree, plain)
        shape, all_blocks = shape + int(same.sum()), all_blocks + len(x)
    assert shape >= 0.95 * all_blocks


ARTICLE = (
    "<article><h1>A bridge</h1><p>The council met on Monday to talk about the new bridge, and"
    " many came to listen.</p><p>Nine.</p></article>"
)
READ = "A bridge The council met on Monday to talk about the new bridge, and many came to listen. Nine."


@pytest.mark.parametrize(
    "wrapper",
    [
        '<form id="aspnetForm">%s</form>',
        '<div class="content-sidebar-wrap">%s</div>',
        '<div class="page-search-layout">%s</div>',
        '<div class="social-history">%s</div>',
        '<div class="site-banner-offset">%s</div>',
        '<div class="legal">%s</div>',
    ],
)
def test_an_article_outweighs_a_name_around_it(wrapper):
    menu = "<nav><a href=a>One</a><a href=b>Two</a></nav>"
    assert html_text.texts_of([f"<body>{menu}{wrapper % ARTICLE}</body>"]) == [READ]


@pytest.mark.parametrize("wrapper", ["<aside>%s</aside>", '<div id="comments">%s</div>', '<div class="related-posts">%s</div>'])
def test_but_not_asides_comments_and_other_pages(wrapper):
    assert html_text.texts_of([f"<body>{ARTICLE}{wrapper % ARTICLE}</body>"]) == [READ]


def test_a_hint_inside_an_article_leaves_it_to_the_shape():
    page = (
        '<article><h1>Law</h1><div class="legal-analysis"><p>The court held that the statute'
        " applies to all of the parties in this case.</p><p>Short one.</p></div>"
        '<div class="share-buttons"><a href=x>Share</a> this</div></article>'
    )
    want = "Law The court held that the statute applies to all of the parties in this case. Short one."
    assert html_text.texts_of([page]) == [want]


@pytest.mark.parametrize(
    "part, end",
    [
        ('<p title="', ""), ("<script ", ""), ("<!", ""), ("<p '", ""), ("<p \"'", ">"), ('<a <b "', ">"),
        ('<p title="x', ">"), ("<div>", "</ul>" * 200_000), ("<!--", ""), ("&", ""),
    ],
)
def test_pages_of_open_markup_take_seconds(part, end):
    page = part * (2_000_000 // len(part)) + end
    start = time.perf_counter()
    html_text.texts_of([page])
    assert time.perf_counter() - start < 8
