"""Tag-path ratios: values against plain sums, pages that lose or keep text by them, and broken pages."""

import math

from roadloom.llm import html_text
from roadloom.llm.html_text import main_text, path_values, read

LONG, MORE = "A sentence, with words; and some more of them. " * 13, "Other text, of the second part. And so on. " * 8
A, B = LONG.strip(), MORE.strip()
PAGE = f"""<html><body><div class=top><a href=/>Home</a> | <a href=/b>B</a></div><div class=c1><h2>Head</h2><p>{LONG}</p><p>{MORE}</p><p>Short.</p></div>
<div class=c2><p>Teaser one</p><p>Teaser two</p></div><form><p>Your name, please; and more.</p></form><div class='comments'><p>{MORE}</p></div></body></html>"""


def test_values_against_plain_sums():
    page = read(PAGE)
    blocks = [b for b in page.blocks if b.weight]
    names = [page.steps(b.path) for b in blocks]
    assert len(set(names)) < len(names) and ("html", "body", "div.c", "h2") in names  # no numbers in paths
    fused, weight = {}, {}
    for name in set(names):
        mine = [b for b, n in zip(blocks, names, strict=True) if n == name]
        length = sum(len(b.text) - b.linked for b in mine) / len(mine)
        marks = sum(sum(b.text.count(c) for c in ".,;:!?") for b in mine) / len(mine)
        fused[name] = math.log1p(length) * (1 + math.log1p(marks)) if length else 0.0
        weight[name] = sum(b.weight for b in mine) / len(mine)
    kernel = [math.exp(-(r * r) / 2) for r in range(-3, 4)]
    line = []
    for k in range(len(names)):
        near = [names[min(max(k + r, 0), len(names) - 1)] for r in range(-3, 4)]
        line.append(sum(w * fused[n] * weight[n] for w, n in zip(kernel, near, strict=True)) / sum(kernel))
    paths, value = path_values(page)
    for p, v in zip(paths.tolist(), value.tolist(), strict=True):
        name = page.steps(p)
        mine = [x for x, n in zip(line, names, strict=True) if n == name]
        want = weight[name] * math.sqrt(fused[name] * max(sum(mine) / len(mine), fused[name] * weight[name]))
        assert math.isclose(v, want, rel_tol=1e-9, abs_tol=1e-9)


def test_ratios_decide_where_no_name_does():
    """The same page with names that tell nothing: only length, punctuation and links part article from the rest."""
    rest = "<div class=x><a href=/1>One</a> <a href=/2>Two</a></div>", "<div class=y><p>Buy it</p></div>", "<div class=z><ul><li><a href=/3>Three</a><li><a href=/4>Four</a></ul></div>"
    assert main_text(f"<body>{rest[0]}{rest[1]}<div class=w><h1>Title</h1><p>{LONG}</p><p>{MORE}</p></div>{rest[2]}</body>") == f"Title\n{A}\n{B}"
    assert main_text(f"<body><div class=w><p>{LONG}</p></div><div class=y><p>Buy it</p><p>Now</p></div></body>") == A
    # with the ratios' threshold at nothing, names alone would keep all of it
    before, html_text.SHARE = html_text.SHARE, 0.0
    try:
        assert "Buy it" in main_text(f"<body><div class=w><p>{LONG}</p></div><div class=y><p>Buy it</p><p>Now</p></div></body>")
    finally:
        html_text.SHARE = before


def test_text_that_must_not_be_lost():
    assert main_text(f"<article><section><h1>One</h1><p>{LONG}</p></section><section><h1>Two</h1><p>Short, it is.</p></section></article>") == f"One\n{A}\nTwo\nShort, it is."
    assert main_text(f"<body><div><p>{LONG}</p></div><div><p>{MORE}</p></div></body>") == f"{A}\n{B}"
    for name in ("class='side-by-side'", "class='related-work'", "class='has-sidebar'", "id='comment-on-x'", "class='legalese'"):
        assert main_text(f"<article><p>{LONG}</p><div {name}><p>{MORE}</p></div></article>") == f"{A}\n{B}", name
    assert main_text(f"<article><p>{LONG}</p><section id='legal'><p>{MORE}</p></section></article>") == f"{A}\n{B}"
    assert main_text(f"<article><p>{LONG}</p><ul><li><a href=/1>Only a link</a></ul></article>") == f"{A}\nOnly a link"
    assert main_text(f"<div class=post><header><h1>Title</h1></header><p>{LONG}</p></div>") == f"Title\n{A}"
    assert main_text(f"<form id=aspnet><div class=text><p>{LONG}</p><p>Short.</p></div></form>") == f"{A}\nShort."


def test_broken_pages():
    assert main_text(f"<html><head><title>T</title><meta x><body><p>{LONG}</p></html>") == A
    assert main_text(f"<article><p>{LONG}</p><audio src=x><p>{MORE}</p></article>") == f"{A}\n{B}"
    assert main_text(f'<article><p class="a>{LONG}</p></article>') == A
    assert main_text(f"<article><p title='x>{LONG}</p><p>{MORE}</p></article>").startswith(A)
    assert main_text("<p><a href='" + "<" * 5000) == "" and main_text("<div>" * 30_000 + "text, here.") == "text, here."


def test_boilerplate_goes():
    for bad in (f"<nav><p>{MORE}</p></nav>", f"<aside><p>{MORE}</p></aside>", f"<footer><p>{MORE}</p></footer>", f"<div class=comments><p>{MORE}</p></div>", f"<div id=sidebar><p>{MORE}</p></div>", f"<div class='cookie-notice'><p>{MORE}</p></div>", f"<section id=comments><p>{MORE}</p></section>", f"<form><p>{MORE}</p></form>", f"<div class='ad-slot'><p>{MORE}</p></div>", f"<div role=complementary><p>{MORE}</p></div>", f"<div hidden><p>{MORE}</p></div>", f"<script>{MORE}</script>", f"<header><p>{MORE}</p></header>"):
        assert main_text(f"<body>{bad}<article><h1>T</h1><p>{LONG}</p></article></body>") == f"T\n{A}", bad
        assert main_text(f"<body><div class=post><p>{LONG}</p></div>{bad}</body>") == A, bad
