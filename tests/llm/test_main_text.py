import pytest
from hypothesis import given
from hypothesis import strategies as st

from filingmill.llm import main_text

WEIGHTS = main_text.learn()


def text(page):
    return main_text.blocks(page, WEIGHTS)


def marked(page):
    """(content words, other words) of a labelled page, by its marks alone."""
    inside, outside, stack = set(), set(), []
    for kind, what, attributes in main_text.parsed(page):
        if kind == "open":
            if what not in main_text.VOID:
                stack.append((what, "data-content" in attributes, "data-out" in attributes))
        elif kind == "close":
            while stack and stack.pop()[0] != what:
                pass
        else:
            good = any(c for _, c, _ in stack) and not any(o for _, _, o in stack)
            (inside if good else outside).update(what.split())
    return inside, outside


def test_labelled_pages_left_out_of_the_fit():
    """Each labelled page by weights of all others: most content words are kept, most others go."""
    kept = lost = wrong = right = 0
    for n, page in enumerate(main_text.LABELLED):
        weights = main_text.learn([p for k, p in enumerate(main_text.LABELLED) if k != n])
        got = set(" ".join(main_text.blocks(page, weights)).split())
        inside, outside = marked(page)
        kept, lost = kept + len(inside & got), lost + len(inside - got)
        wrong, right = wrong + len((outside - inside) & got), right + len((outside - inside) - got)
    assert len(main_text.LABELLED) >= 20
    assert kept / (kept + lost) > 0.9 and right / (right + wrong) > 0.75


def brute_run(scores):
    """The first, then shortest, of the contiguous runs of the greatest sum above 0."""
    best, found = 0.0, (0, 0)
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            if sum(scores[a:b]) > best:
                best, found = sum(scores[a:b]), (a, b)
    return best, found


@given(st.lists(st.integers(-5, 5), max_size=30))
def test_the_run_has_the_greatest_sum(scores):
    start, end = main_text.best_run(scores)
    assert sum(scores[start:end]) == brute_run(scores)[0] and (start, end) != (0, 0) or brute_run(scores)[1] == (0, 0)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><article class='post no-comments'><h1>The headline</h1><p>words of a story here</p></article></body>", ["The headline", "words of a story here"]),
        ("<body><div class='search-results'><article><h1>The headline</h1><p>words of a story here</p></article></div></body>", ["The headline", "words of a story here"]),
        ("<body><article><h1>Head</h1><ul>" + "<li><a href='#'>part</a></li>" * 12 + "</ul><p>" + "w " * 50 + "</p></article></body>", ["Head", *["part"] * 12, ("w " * 50).strip()]),
        ("<body><div class='layout has-sidebar'><div class='sidebar'>some entries here</div><div class='content'><h1>Title</h1><p>" + "w " * 30 + "</p><ul>" + "<li><a>x</a></li>" * 30 + "</ul></div></div><div class='footer'>foot words</div></body>", ["Title", ("w " * 30).strip(), *["x"] * 30]),
        ("<body><form id='aspnetForm'><div class='header'>site name</div><div class='bodytext'><h1>T</h1><p>" + "w " * 30 + "</p></div></form></body>", ["T", ("w " * 30).strip()]),
        ("<body><main><h1>T</h1><p>" + "w " * 30 + "</p><section class='comments'><article><p>" + "reader " * 80 + "</p></article></section></main></body>", ["T", ("w " * 30).strip()]),
        ("<body><div class='body'><p>" + "w " * 30 + "</p></div><p>copyright all rights reserved</p></body>", [("w " * 30).strip()]),
    ],
)
def test_wrappers_lists_and_comments(page, want):
    assert text(page) == want


def test_blocks_entities_and_white_space():
    page = "<body><nav><a href='/'>Menu item</a></nav><article><h1>A &amp; B&nbsp;C</h1><p>one\n  two<br>three &lt;b&gt; <b>bo</b>ld &amp;amp; &am</p>tail text of it<ul><li>x1 y<li>x2 y</ul></article><footer>&copy; foot words</footer></body>"
    assert text(page) == ["A & B C", "one two three <b> bold &amp; &am", "tail text of it", "x1 y", "x2 y"]


@pytest.mark.parametrize(
    ("page", "want"),
    [("", []), ("   ", []), ("<p></p>", []), ("just words", ["just words"]), ("<p>open <i>tags", ["open tags"]), ("<script>var t='</p>'; x < y", []), ("<p>a b c</p><!-- no --><style>p{}</style>", ["a b c"]), ("words then <div class='cut", ["words then"]), ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"])],
)
def test_odd_pages(page, want):
    assert text(page) == want


def test_comments_forms_and_notices_inside_are_left_out():
    page = "<html><body><div class='article'><p>first part of the story is here</p><div class='ad-slot ad'>buy now cheap</div><p>second part of the story is here</p><form><p>your mail</p><input></form><div id='comments'><p>a reader wrote many words here that go on and on</p></div></div></body></html>"
    assert text(page) == ["first part of the story is here", "second part of the story is here"]


def test_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "y"), (None, "w", "<p>words in a page</p>", None), (4, "x", "<p>" + "long word " * 200_000 + "</p>", "t"), (4, "x", "<p>same</p>", "t"), (4, "x", "<p>same</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(((r["page_id"], r["url"], r["n_chars"], len(r["text"])) for r in main_text.extracted(pages).collect()), key=str)
    assert got == sorted([(1, "u", 0, 0), (2, None, 0, 0), (None, "w", 15, 15), (4, "x", 1_999_999, 1_999_999), (4, "x", 4, 4), (4, "x", 4, 4)], key=str)
    assert main_text.extracted(pages.where("false")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='layout has-sidebar'><article><h1>The headline</h1><p>words of a story here</p></article></div></body>",
        "<body><article class='post ad-free'><h1>The headline</h1><p>words of a story here</p></article></body>",
        "<body><article><h1 class='page-header'>The headline</h1><p>words of a story here</p></article></body>",
        "<body><article><div class='article-header'><h1>The headline</h1></div><p>words of a story here</p></article></body>",
    ],
)
def test_names_do_not_leave_out_the_article_or_its_headline(page):
    assert text(page) == ["The headline", "words of a story here"]


def test_comments_that_are_articles_are_left_out():
    page = "<body><article><p>first part of the story is here</p></article><section id='comments'><article class='comment'><p>a reader liked it</p></article></section></body>"
    assert text(page) == ["first part of the story is here"]


@pytest.mark.parametrize("tag", ["svg", "math"])
def test_self_closed_elements_are_empty(tag):
    assert text(f"<p>words before it</p><{tag} class='x'/><p>words after it</p>") == ["words before it", "words after it"]


@pytest.mark.parametrize("script", ["これは長い記事の本文です", "这是一篇很长的文章的正文", "นี่คือเนื้อหาบทความยาว"])
def test_text_without_spaces_keeps_its_paragraphs_with_links(script):
    page = "<body><article>" + f"<p>{script * 3}<a href='x'>{script}</a>{script * 2}</p>" * 4 + "</article></body>"
    assert text(page) == [script * 6] * 4


def test_odd_pages_end_soon():
    """Unclosed tags, stray quotes and deep nesting take time in proportion to the page."""
    import time

    quoted = " ".join(f'd{i}="x"' for i in range(200))
    pages = [
        f"<a {quoted} <b>" * 50 + "<p>one two three four</p>",
        f"<a {quoted} " * 50,
        "<a \"" * 20_000,
        "<a b='" * 20_001 + "<p>x</p>",
        "<" * 100_000 + "<p>x</p>",
        "<!--" * 30_000,
        "<div>" * 100_000 + "deep words here",
        "<article>" * 100_000 + "deep words here" + "</p></b>" * 50_000,
        "<p>" * 100_000 + "<h1>a</h1>" * 1000,
        "<li><td><dd>" * 30_000 + "x",
    ]
    for page in pages:
        began = time.process_time()
        text(page)
        assert time.process_time() - began < 10 * len(page) / 500_000 + 2


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p>shown words are here</p><p hidden>not this at all</p><div style="color: red; display : none">nor that one</div>', ["shown words are here"]),
        ('<p>kept words of the page</p><p style="visibility:hidden">gone words</p><p data-x="hidden">and these stay too</p>', ["kept words of the page", "and these stay too"]),
        ('<a href="x>y">link words one two</a> <p title=\'a>b\'>more words there</p>', ["link words one two", "more words there"]),
        ('<div class="related"><p>All of the words of this page are in here.</p></div>', ["All of the words of this page are in here."]),
        ("<p>before the end <!-- open comment <p>lost</p>", ["before the end"]),
    ],
)
def test_what_is_shown(page, want):
    assert text(page) == want
