"""Written pages whose wanted text is known, compared whole."""

import pytest

from terracat.llm.html_text import main_text

P = [f"Paragraph {k} of the story, with commas, and enough words to be read as running text by any rule of scoring." for k in range(8)]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = " ".join(P)
SAID = "I disagree, with all of this, and here is a long comment of a reader that goes on, and on, to score as well as text."
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>More</a></li></ul></nav>"
PAGES = {
    "plain": (f"{NAV}<article>{BODY}</article><footer>Imprint</footer>", TEXT),
    "comment article beside": (f"<main><article>{BODY}</article><article class='comment'><p>{SAID}</p></article></main>", TEXT),
    "comment articles in a list": (f"<article>{BODY}</article><section><article class='comment-body'><p>{SAID}</p></article><article id='comment-12'><p>{SAID}</p></article></section>", TEXT),
    "comment article within": (f"<article>{BODY}<article class='comment-body'><p>{SAID}</p></article></article>", TEXT),
    "many comment articles": (f"<article>{BODY}</article>" + f"<article class='reader-comment'><p>{SAID}</p></article>" * 30, TEXT),
    "advert article": (f"<article>{BODY}</article><article class='sidebar-ad'><p>{SAID}</p></article>", TEXT),
    "advert paragraph": (f"<article>{P[0]}<p class='advert'>Buy now, and save.</p>{BODY}</article>", f"{P[0]} {TEXT}"),
    "cookie paragraph": (f"<article><p class='cookie-notice'>We use cookies, as all do.</p>{BODY}</article>", TEXT),
    "notice paragraph": (f"<article>{BODY}<p id='notice'>Site notice, please read.</p></article>", TEXT),
    "advert span": (f"<article><p>{P[0]}<span class='advert'> Click here</span></p><p>{P[1]}</p></article>", f"{P[0]} {P[1]}"),
    "sponsored link": (f"<article><p>{P[0]} <a class='sponsored' href='x'>offer</a></p><p>{P[1]}</p></article>", f"{P[0]} {P[1]}"),
    "comment paragraph": (f"<article>{BODY}<p class='user-comment'>{SAID}</p></article>", TEXT),
    "names that only tell": (f"<article class='post has-sidebar no-ads category-promo comments-open'>{BODY}</article>", TEXT),
    "code with comments": (f"<article>{BODY}<pre><code><span class='comment'># note</span> x = 1</code></pre></article>", f"{TEXT} # note x = 1"),
    "header of the article": (f"<header>Site</header><article><header><h1>Title</h1></header>{BODY}</article>", f"Title {TEXT}"),
    "header div of the article": (f"<article><div class='entry-header'><h1>Title</h1></div>{BODY}</article>", f"Title {TEXT}"),
    "header div of the page": (f"<div class='page-header'>Site name</div><article>{BODY}</article>", TEXT),
    "heading before the article": (f"<h1>Site</h1><article>{BODY}</article>", TEXT),
    "no marked element": (f"{NAV}<div class='sidebar'><p>{SAID}</p></div><div><h1>Title</h1>{BODY}</div><div class='footer'>Imprint</div>", f"Title {TEXT}"),
    "form and dialog": (f"<article>{BODY}<form><p>{SAID}</p></form><dialog>Accept?</dialog></article>", TEXT),
    "hidden": (f"<article><p hidden>secret</p><p style='display: none'>secret</p><p aria-hidden='true'>x</p>{BODY}</article>", TEXT),
    "references and blanks": ("<article><p>A &amp; B &#233; &lt;tag&gt;\n\t and&nbsp;more</p><p>x<br>y</p></article>", "A & B é <tag> and more x y"),
    "related articles": (f"<main><article>{BODY}</article><article class='related'><p>{SAID}</p></article></main>", TEXT),
    "newsletter": (f"<article>{BODY}<div class='newsletter-signup'><p>{SAID}</p></div></article>", TEXT),
}


@pytest.mark.parametrize("name", PAGES)
def test_whole_text(name):
    html, want = PAGES[name]
    assert main_text(f"<!DOCTYPE html><html><head><title>T</title><script>var a = '</p>';</script></head><body>{html}</body></html>") == want
