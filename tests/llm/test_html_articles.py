"""Articles that are nested, split over sections, or marked by look-alikes of boilerplate words."""

from roadloom.llm.html_text import main_text

LONG, MORE = "A sentence, with words; and some more of them. " * 13, "Other text, of the second part. And so on. " * 8
A, B = LONG.strip(), MORE.strip()


def page(body):
    return f"<html><body><nav><a href=/>Home</a></nav>{body}<footer>All rights, reserved.</footer></body></html>"


def test_no_part_of_an_article_is_lost():
    assert main_text(page(f"<article><section><p>{LONG}</p></section><section><p>{MORE}</p></section></article>")) == f"{A}\n{B}"
    blog = f"<h1>Title</h1><p>A lead, in short.</p><div class='entry-content'><p>{LONG}</p><p>{MORE}</p></div><p>The end, at last.</p>"
    want = f"Title\nA lead, in short.\n{A}\n{B}\nThe end, at last."
    assert main_text(page(f"<article>{blog}</article>")) == want
    assert main_text(page(f"<div class='post'>{blog}</div>")) == want


def test_links_in_an_article_stay():
    refs = "".join(f"<li><a href=/{k}>Reference {k}</a></li>" for k in range(4))
    assert main_text(page(f"<article><h1><a href=/x>Linked title</a></h1><p>{LONG}</p><ul>{refs}</ul></article>")) == f"Linked title\n{A}\n" + "\n".join(f"Reference {k}" for k in range(4))
    assert main_text(page(f"<div><a href=/1>One</a></div><div><a href=/2>Two</a></div><div><a href=/3>Three</a></div><div><p>{LONG}</p></div>")) == A


def test_look_alikes_are_no_boilerplate():
    assert main_text(page(f"<div class='content has-sidebar'><p>{LONG}</p></div>")) == A
    assert main_text(page(f"<div class='search-wrap'><h1>Title</h1><p>{LONG}</p></div><p>Stray.</p>")).startswith(f"Title\n{A}")
    assert main_text(page(f"<article><p>{LONG}</p><h2 id='related-work'>Related</h2><section id='legal-news'><p>{MORE}</p></section></article>")) == f"{A}\nRelated\n{B}"
    assert main_text(page(f"<article><p>{LONG}</p><section id='comments'><p>{MORE}</p></section></article>")) == A
