"""Main text of pages: nothing of the article lost, nothing else kept, blocks joined as the markup says."""

from __future__ import annotations

import time

import pytest

from tablegate.llm.htmltext import extract_main_text, main_text

ARTICLE = "It was a long day, and the road went on, past the mill, past the river, and past the last house of the town."
BODY = f"<p>{ARTICLE}</p><p>{ARTICLE[:60]}, again.</p>"
TEXT = f"{ARTICLE}\n\n{ARTICLE[:60]}, again."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content-header">{BODY}</div><p>Copyright 2024</p>',
        f"<div class='post-header-wrap'>{BODY}</div><p>tiny</p>",
        f'<form id="aspnetForm">{BODY}</form><p>A line outside</p>',
        f'<form id="aspnetForm"><div id="page">{BODY}</div></form><div><p>A line outside</p></div>',
        f'<div class="header">{BODY}</div><p>tiny</p>',
        f'<div class="has-sidebar no-banner">{BODY}</div>',
        f'<article><img class="header-image" src=x>{BODY}</article>',
    ],
)
def test_the_article_is_found_whatever_its_wrapper_is_called(page):
    assert TEXT in main_text(page)


@pytest.mark.parametrize(
    "other",
    [
        "<nav><p>X1, menu</p></nav>", "<header><h1>X1</h1></header>", "<footer><p>X1</p></footer>", "<aside><p>X1, aside, long</p></aside>",
        '<div class="ad"><p>X1, buy</p></div>', '<div class="sidebar"><p>X1</p></div>', '<div id="comments"><p>X1, said, a reader</p></div>',
        '<div class="cookie-notice"><p>X1</p></div>', "<form><p>X1</p></form>", "<script>X1</script>", "<style>X1</style>", "<!-- X1 -->",
        "<div hidden><p>X1</p></div>", '<div style="display: none"><p>X1</p></div>', '<p aria-hidden="true">X1</p>', "<noscript>X1</noscript>",
        "<svg><svg><text>X1</text></svg><text>X1</text></svg>", "<button>X1</button>", "<template><p>X1</p></template>", "<select><option>X1</select>",
        '<ul class="post-comments"><li>X1, a reply</li></ul>', '<div class="article-share">X1</div>', '<div class="entry-related"><p>X1, more, of it</p></div>',
    ],
)
def test_what_is_not_the_article_is_absent(other):
    for page in (f"{other}<article>{BODY}</article>", f"<main>{BODY}{other}</main>", f"<div>{BODY}{other}</div>"):
        assert main_text(f"<html><body>{page}</body></html>") == TEXT


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ('see <span class="social-handle">@x</span> for more', "see for more"),
        ('a <span class="share-x"><span>A</span> LEAK</span> b', "a b"),
        ('a <a class="share">S</a> b <a hidden>T</a> c', "a b c"),
        ("a <svg><g><svg>x</svg> LEAK</g></svg> b", "a b"),
        ("a <b>bold</b><i>er</i> <em>and</em>\n\t so on", "a bolder and so on"),
        ("one<br>two", "one two"),
        ("x &lt;b&gt; &amp;amp; &#233;&nbsp;&hellip;", "x <b> &amp; é …"),
        ('a <span class="share">never closed', "a"),
        ('a <img class="ad" src="x"> b', "a b"),
        ("a <span hidden/> b", "a b"),
    ],
)
def test_inline_elements_leave_the_block_whole(inner, text):
    assert main_text(f"<div><p>{inner}</p><p>{ARTICLE}</p></div>") == f"{text}\n\n{ARTICLE}"


def test_blocks_inside_a_skipped_inline_element():
    page = f'<div><p>{ARTICLE}</p><span class="comments"><div><p>no, no, no</p></div></span><p>end, of it</p></div>'
    assert main_text(page) == f"{ARTICLE}\n\nend, of it"
    # never closed: it ends with the element it began in
    page = f'<main><div><p>{ARTICLE}</p><span class="comments"><p>no, no, no</p></div><p>end, of it</p></main>'
    assert main_text(page) == f"{ARTICLE}\n\nend, of it"


def test_long_comments_do_not_win_over_the_article():
    said = "".join(f"<p>{ARTICLE} {i}</p>" for i in range(30))
    assert main_text(f'<div id="story">{BODY}</div><div class="comments">{said}</div>') == TEXT
    assert main_text(f'<div id="story">{BODY}</div><form class="respond">{said}</form>') == TEXT


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + f"<p>{ARTICLE}</p>" + "</p>" * 50_000,
        "<div>" * 50_000 + f"<p>{ARTICLE}</p>" + "</div>" * 50_000,
        f"<p>{ARTICLE}</p>" + "<span class='ad'>" * 50_000,
        f"<p>{ARTICLE}</p>" + "</span>" * 100_000,
        "<li>" * 50_000 + f"<p>{ARTICLE}</p>",
        f"<p>{ARTICLE}</p><" + "x" * 200_000,
        "<p" * 20_000 + f"><p>{ARTICLE}</p>",
    ],
)
def test_deep_and_broken_markup_in_short_time(html):
    began = time.time()
    assert ARTICLE in main_text(html)
    assert time.time() - began < 5


def test_rows_of_any_kind(spark):
    rows = [(1, "u", None, 0), (2, None, "", 0), (None, "u", BODY, 0), (3, "u", BODY, 0), (3, "u", BODY, 0), (4, "u", "<p></p>", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = sorted(map(str, map(tuple, extract_main_text(frame).collect())))
    size = len(TEXT)
    expected = [(1, "u", "", 0), (2, None, "", 0), (None, "u", TEXT, size), (3, "u", TEXT, size), (3, "u", TEXT, size), (4, "u", "", 0)]
    assert found == sorted(map(str, expected))
    assert extract_main_text(frame.limit(0)).count() == 0
