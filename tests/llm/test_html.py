"""Main text of pages of great depth, and of pages whose marked element is not the article."""

import time

from terracat.llm.html_text import main_text

P = [f"This is paragraph {k} of the story, with commas, and enough words to be read as running text by the scoring rules." for k in range(12)]
BODY = "".join(f"<p>{p}</p>" for p in P)


def test_depth():
    deep = "<div>" * 600 + "<p>" + P[0] + "</p><script>var hidden = 1;</script><nav>menu</nav><p>" + P[1] + "</p>" + "</div>" * 600
    assert main_text(f"<article>{BODY}{deep}<p>the last one</p></article><p>outside</p>") == " ".join([*P, P[0], P[1], "the last one"])
    unclosed = "<font><span>" * 500
    assert main_text(f"<article>{unclosed}<p>{P[0]}</p><style>p {{}}</style><p>{P[1]}</p></article>") == f"{P[0]} {P[1]}"


def test_depth_is_cheap():
    began = time.time()
    page = "".join(f"<div><span><p>{P[0]}" for _ in range(20_000))
    assert main_text(f"<article>{page}</article>").count("paragraph 0") == 20_000
    page = "<button><p>" + "<span>" * 20_000 + "<p>x</p></b></i>" * 20_000
    main_text(page)
    assert time.time() - began < 20


def test_teaser():
    teaser = f"<article><h2>Read next</h2><p>{P[3]}</p></article>"
    assert main_text(f"<div>{BODY}</div><section>{teaser}</section>") == " ".join(P)
    assert main_text(f"<section>{teaser}</section><article>{BODY}</article>") == " ".join(P)
    related = "".join(f"<article><p>Teaser {k}</p></article>" for k in range(60))
    assert main_text(f"<main><article><h1>T</h1><section>{BODY}</section></article>{related}</main>") == " ".join(["T", *P])
    assert main_text("<article><div>" + " ".join(P) + "</div></article><div><p>Terms, rules, more</p></div>") == " ".join(P)
