"""Wrappers that are named after a part of the page."""

import pytest

from shoptally.llm import html_text

TEXT = "A long article about many things that people like to read. " * 4
TAIL = "<div class='comments'><p>First!</p></div><div class='sidebar'><p>More of us</p></div>"


def _extract(html):
    path = html_text.best_path(html_text.read(html))
    return html_text.extract(html, path and path[0])


@pytest.mark.parametrize("name", ["layout with-sidebar", "no-sidebar", "ad-free", "search-results", "has_comments"])
def test_an_article_in_a_wrapper(name):
    page = f"<body><div>Site</div><div class='{name}'><article><p>{TEXT}</p>{TAIL}</article>{TAIL}</div></body>"
    assert _extract(page) == TEXT.strip()


def test_a_wrapper_without_an_article():
    page = f"<body><div>Site</div><div class='with-sidebar'><div class='post'><p>{TEXT}</p></div>{TAIL}</div></body>"
    assert _extract(page) == TEXT.strip()


def test_a_page_of_which_names_leave_nothing():
    assert _extract(f"<body><div class='ad-free'><p>{TEXT}</p></div><nav>menu</nav></body>") == TEXT.strip()


def test_long_comments_stay_hidden():
    comments = f"<section class='comments'><article class='comment'><p>{TEXT * 3}</p></article></section>"
    assert _extract(f"<body><article><p>{TEXT}</p></article>{comments}</body>") == TEXT.strip()
    assert _extract(f"<body><div class='post'><p>{TEXT}</p></div><div id='comments'>{TEXT * 3}</div></body>") == TEXT.strip()


def test_a_host_of_wrapped_pages(spark):
    page = "<body><div>Site</div><div class='layout with-sidebar'><article><p>{} {}</p></article></div></body>"
    rows = [(i, "http://h/x", page.format(TEXT, i)) for i in range(3)]
    found = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in found) == [f"{TEXT.strip()} {i}" for i in range(3)]


# --- parts of the article --------------------------------------------------------------------------

CONTENT = TEXT.strip()


@pytest.mark.parametrize(
    "part, text",
    [
        ('<h2 id="search-algorithms">Search algorithms</h2>', "Search algorithms"),
        ('<h2 id="navigation">Navigation</h2>', "Navigation"),
        ('<p>See <span id="Related_work" class="related">related work</span>.</p>', "See related work."),
        ('<section id="comments-on-the-theory"><p>It is old.</p></section>', "It is old."),
        ('<p class="header-text">First words.</p>', "First words."),
        ('<p>Let <math><mi>x</mi><mo>&lt;</mo><mn>2</mn><annotation>x<2</annotation></math> hold.</p>', "Let x<2 hold."),
        ('<p class="x>Not closed.</p>', "Not closed."),
    ],
)
def test_parts_of_an_article_stay(part, text):
    assert _extract(f"<body><article><p>{TEXT}</p>{part}</article></body>") == f"{CONTENT}\n{text}"


def test_a_form_around_the_page():
    page = f'<body><form id="aspnetForm"><div class="content"><p>{TEXT}</p></div><div class="sidebar">More</div></form></body>'
    assert _extract(page) == CONTENT
    small = "<form><p>Your name</p><button>Send</button></form>"
    assert _extract(f"<body><article><p>{TEXT}</p>{small}</article></body>") == CONTENT
    assert _extract(f"<body><div class='post'><p>{TEXT}</p></div>{small}</body>") == CONTENT


def test_empty_and_clashing_tables(spark):
    rows = [(1, "http://h/x", f"<article><p>{TEXT}</p></article>", "a", "b", "c"), (None, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, text string")
    found = html_text.main_texts(pages).collect()
    assert {tuple(r) for r in found} == {(1, "http://h/x", CONTENT, len(CONTENT)), (None, None, "", 0)}
    assert html_text.main_texts(pages.limit(0)).collect() == []


def test_ties_go_to_the_larger_path(spark):
    page = "<body><div class='{}'><p>{}</p></div></body>"
    rows = [(i, "http://h/", page.format(c, TEXT)) for i, c in enumerate("ab")]
    paths = html_text.host_paths(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.path for r in paths] == [">body>div.b"]


def test_a_very_long_page(spark):
    body = "<p>word and word</p>" * 1_000_000
    rows = [(1, "http://h/", f"<body><nav>menu</nav><article>{body}</article></body>")]
    (row,) = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert row.n_chars == 1_000_000 * 14 - 1 and row.text[:27] == "word and word\nword and word"


def test_paths_too_large_to_broadcast(spark):
    rows = [(i, f"http://h{i % 3}/", f"<article><p>{TEXT}{i}</p></article>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    kept, shuffled = html_text.main_texts(pages), html_text.main_texts(pages, broadcast_bytes=0)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, shuffled.collect()))
    plan = kept._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(host" not in plan
