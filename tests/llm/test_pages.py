"""Main text of hand-made pages."""

import pytest

from listora.llm import html_text
from listora.llm.html_text import main_text

LONG = "The quick brown fox is in the garden and it was seen by the dog, which is not at all what she had in mind. " * 3
LINE = "A short line of it."


def body(inner):
    return f"<!DOCTYPE html><html><head><title>Title here</title><style>p{{}}</style></head><body>{inner}</body></html>"


PAGE = f"""
<header><a href=/>Home</a> <p>{LONG}</p></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>{LONG}</p></div><div class=ad>{LONG}</div>
<main><article class="post has-sidebar"><h1>Main &amp; heading</h1><p>{LINE}<p>{LONG}</p><!-- <p>{LONG}</p> -->
<script>document.write("<p>{LONG}</p>")</script><p>Tom &lt;b&gt; &eacute;t&eacute;&nbsp;&#x41;\n\t two<br>three</p>
<div class="share-buttons"><a href="#">Share</a></div><p>{LINE}</p></article></main>
<aside><p>{LONG}</p></aside><form><p>{LONG}</p><select><option>One</select></form>
<section id="comments"><article><p>{LONG}</p></article></section><footer>&copy; us</footer>"""


def test_article_alone():
    clean = " ".join(LONG.split())
    assert main_text(body(PAGE)).split("\n") == ["Main & heading", LINE, clean, "Tom <b> été A two three", LINE]


def test_without_marked_article():
    page = body(f"<div id=menu><a>x</a></div><div><p>{LONG}</p><p>{LINE}</p><p>{LONG}</p></div><div class=footer>{LINE}</div>")
    clean = " ".join(LONG.split())
    assert main_text(page).split("\n") == [clean, LINE, clean]


def test_open_blocks_follow_the_nearest():
    links = "<p><a href=/x>Some link and another link of this menu</a></p>"
    page = body(f"<div>{links}{links}<p>{LINE}</p>{links}<p>Nearer to it.</p><p>{LONG}</p></div>")
    assert main_text(page).split("\n")[0] != LINE
    assert "\n".join(main_text(page).split("\n")[1:]) == "" or LINE not in main_text(page)


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("<", ""),
        ("no markup at all", ""),
        ("<article>tiny</article>", "tiny"),
        ("<article>a < b and <p>c</article", "a < b and\nc"),
        ("<article><p title='x > y'>one</p><p class=\"ad\">two</p></article>", "one"),
        ("<article>cut <!-- off", "cut"),
        ("<article>cut <script>off", "cut"),
        ("<article><p>one</p></div></p></article></article><p>two", "one"),
        ("<main><p>&amp;amp; &am &copy</p></main>", ""),
        ("<article><p hidden>no</p><p>yes</p></article>", "yes"),
        (f"<form id=page><p>{LONG}</p></form>", " ".join(LONG.split())),
        ("</>" * 50 + "<article>x</article>", "x"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ],
)
def test_odd_pages(source, wanted):
    assert main_text(source or "") == wanted


def test_rows(rows_of):
    rows = [{"page_id": i, "url": "u", "html": html, "text": "old"} for i, html in enumerate([None, "", body(PAGE), body(PAGE)])]
    rows.append({"page_id": None, "url": None, "html": "<article>é</article>"})
    pages = rows_of(rows, "page_id long, url string, html string, text string, n_chars int")
    found = html_text.page_texts(pages).collect()
    assert [len(r.text) for r in found] == [r.n_chars for r in found] and len(found) == 5
    assert sorted(r.n_chars for r in found)[:3] == [0, 0, 1]
    assert html_text.page_texts(pages.where("false")).count() == 0


def test_deep_and_broken_pages_take_linear_time():
    for source in ("<div>" * 20_000, '<p a="' * 20_000, "<!--" * 20_000, "</p>" * 20_000, "<" * 50_000, "<article>" + "a " * 200_000):
        main_text(source)


@pytest.mark.parametrize("quote", ['"', "'"])
def test_long_attribute_values(quote):
    """A value with markup is read to its closing quote, and its own markup gives no hints."""
    value = f"data-x={quote}" + "<b>not text</b> <i class=ad hidden>" * 300 + quote
    assert len(value) > 10_000
    clean = " ".join(LONG.split())
    page = f"<article><div class=ad {value}>{LONG}</div><div {value} class={quote}promo{quote}>{LONG}</div><p {value}>{LONG}</p></article>"
    assert main_text(body(page)) == clean
    assert main_text(body(f"<article><p>{LONG}</p><div data-x={quote}open <b>{LINE}</div></article>")).startswith(clean)
    assert main_text(f"<article><p title=Tom's>{LONG}</p><p>{LINE}</p><p>It's</p></article>").split("\n") == [clean, LINE, "It's"]


def test_far_quotes_take_linear_time():
    for source in ('<p a=">" ' * 40_000, '<p a=">" ' * 40_000 + "b='", "<p a='<" * 40_000, '<p a="' + "<p b='>" * 40_001, "<p " + "= " * 200_000):
        main_text(source)


WRAPPERS = ["with-left-sidebar", "right-sidebar layout", "page-search", "header-top", "content-widget", "social-page"]
ARTICLES = ["post", "post category-notices", "post tag-related", "post-12 category-social", "search-friendly", "ad-free"]
PARAGRAPHS = f"<p>{LONG}</p><p>{LINE}</p><p>{LONG}</p>"
CLEAN = "\n".join([" ".join(LONG.split()), LINE, " ".join(LONG.split())])
AROUND = '<nav><ul><li><a href="/a">One</a></li></ul></nav>{}<div class="cookie-notice"><p>We use cookies here.</p></div><footer>&copy; us</footer>'


@pytest.mark.parametrize("words", ARTICLES)
def test_hints_say_nothing_of_an_article(words):
    assert main_text(body(AROUND.format(f'<article class="{words}">{PARAGRAPHS}</article>'))) == CLEAN
    assert main_text(body(AROUND.format(f'<main id="{words}">{PARAGRAPHS}</main>'))) == CLEAN


@pytest.mark.parametrize("words", WRAPPERS)
def test_a_wrapper_of_the_page_is_let_off(words):
    assert main_text(body(f'<div class="{words}">{AROUND.format(f"<div>{PARAGRAPHS}</div>")}</div>')) == CLEAN
    inner = f"<article><h1>Heading</h1>{PARAGRAPHS}<div class='ad'><p>{LONG}</p></div></article><div class='comments'><p>{LONG}</p></div>"
    assert main_text(body(f'<div class="{words}">{AROUND.format(inner)}</div>')) == f"Heading\n{CLEAN}"


def test_adverts_and_comments_still_go():
    article = f"<article><p>{LONG}</p></article>"
    for words in ("ad", "related", "newsletter-signup", "comments", "sidebar"):
        assert main_text(body(f'{article}<div class="{words}"><p>{LONG}</p></div>')) == " ".join(LONG.split())
    many = "".join(f'<article class="comment"><p>{LONG}</p></article>' for _ in range(30))
    assert main_text(body(f'{article}<section id="comments">{many}</section>')) == " ".join(LONG.split())
    assert main_text(body(f'<article><p>{LONG}</p><div class="replies">{many}</div></article>')) == " ".join(LONG.split())


def test_links_are_measured_as_they_are_read():
    spaced = f'<article><p>{LONG} <a href="/x">a      {" " * 400}&nbsp;&nbsp; link</a></p></article>'
    assert main_text(body(spaced)).endswith("a link")
