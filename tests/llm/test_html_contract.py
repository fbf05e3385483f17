"""Main text of pages: linked headings and paragraphs, unseen and furniture blocks, short pages."""

import pytest

from orderlake.llm.html import main_text

LONG = "A sentence of the article that is long enough to stand as text by itself, whatever else the page has. "


@pytest.mark.parametrize("page, text", [
    ("<article><h1><a href=x>Title</a></h1><p>Some text.</p></article>", "Title\nSome text."),
    ("<article><p>Some text.</p><p><a href=x>A linked last paragraph</a></p></article>", "Some text.\nA linked last paragraph"),
    (f"<ul><li><a>Home</a><li><a>About</a></ul><h1><a>Title</a></h1><p>{LONG * 2}</p><p>{LONG}</p>",
     f"Title\n{(LONG * 2).strip()}\n{LONG.strip()}"),
    ("<article><figure><img><figcaption>A caption</figcaption></figure><p>x <math><mi>y</mi></math> z</p></article>",
     "A caption\nx y z"),
])
def test_text_that_stays(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("block", [
    "<div class='cookie-bar'>b</div>", "<div class='ad-slot'>b</div>", "<div class='x advert-box'>b</div>",
    "<div class=comment>b</div>", "<ol class='commentlist'><li>b</ol>", "<div id=respond>b</div>", "<p hidden=hidden>b</p>",
    "<p hidden>b</p>", "<p style='color: red; display:none'>b</p>", "<ul><li><a>b</a></ul>", "<form>b</form>", "<aside>b</aside>"])
def test_blocks_that_go(block):
    assert main_text(f"<article><p>The text.</p>{block}</article>") == "The text."


def test_words_like_marks_hide_nothing():
    for page in ("<article class='post comments-open'><p>The text.</p></article>",
                 "<div class='with-sidebar'><article><p>The text.</p></article></div>",
                 "<article><pre><span class='comment'># code</span></pre><p>The text.</p></article>",
                 "<article><p hidden=until-found>Folded.</p><p>The text.</p></article>",
                 "<article><h2 id='comments'>On comments</h2><p>The text.</p></article>"):
        assert main_text(page).endswith("The text.") and len(main_text(page)) >= 9


def test_pages_where_nothing_surges():
    assert main_text("<div>Home</div><div>About</div><p>Short main text.</p><div>(c) us</div>") == "Short main text."
    assert main_text("<div>Home</div><div>The heaviest line</div><div>us</div>") == "The heaviest line"
    assert main_text("<ul><li><a>Home</a><li><a>About</a></ul>") == ""
    assert main_text("") == main_text(None) == ""
