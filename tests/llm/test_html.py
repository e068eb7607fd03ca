"""Main text of planted pages: what was put into the article comes out, and nothing else."""

import random
import time

import pytest

from tallybook.llm.html_text import main_text

WORDS = "river stone, morning light. quiet harbour; the old mill and its wheel, a field of barley.".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def furniture(rng):
    links = "".join(f"<li><a href='/{k}'>{prose(rng, 2)}</a></li>" for k in range(rng.randint(2, 6)))
    return rng.choice([
        f"<nav><ul>{links}</ul></nav>", f"<div class='sidebar'><ul>{links}</ul></div>", f"<aside>{prose(rng, 12)}</aside>",
        f"<div class=ad>{prose(rng, 6)}</div>", f"<form><label>{prose(rng, 2)}</label><input name=x></form>",
        f"<script>var a = '<p>{prose(rng, 9)}</p>';</script>", f"<style>p {{ color: red }}</style>",
        f"<div class='reader-comments'><p>{prose(rng, 40)}</p></div>", f"<!-- {prose(rng, 5)} -->",
        f"<div id=cookie-consent>{prose(rng, 4)} <a href=x>{prose(rng, 8)}</a></div>"])


def planted(rng, marked):
    """A page and the text of its article."""
    blocks, body = [], []
    for k in range(rng.randint(4, 12)):
        text = prose(rng, rng.randint(25, 60))
        blocks.append(text)
        shown = text.replace(" ", "\n  ", 1).replace("and", "<b>and</b>").replace(";", "&#59;")
        body.append(rng.choice([f"<p>{shown}</p>", f"<p title=don't>{shown}</p>", f"<p class='search-engine'>{shown}",
                                f'<P CLASS="lead" data-x="a > b">{shown}</P>', f"<div class='notice-board'><p>{shown}</p></div>"]))
        if rng.random() < 0.3:
            body.append(furniture(rng))
    inner = "".join(body)
    article = f"<article>{inner}</article>" if marked else f"<div><div>{inner}</div></div>"
    around = [furniture(rng) for _ in range(rng.randint(2, 5))]
    page = (f"<!DOCTYPE html><html><head><title>T</title></head><body><header>{prose(rng, 3)}</header>{''.join(around)}{article}"
            f"{furniture(rng)}<footer>&copy; {prose(rng, 4)}</footer></body></html>")
    return page, "\n\n".join(blocks)


@pytest.mark.parametrize("marked", [True, False])
def test_planted_pages(marked):
    rng = random.Random(11)
    for _ in range(150):
        page, text = planted(rng, marked)
        assert main_text(page) == text


def test_quotes_end_no_text():
    assert main_text("<p title=don't>Text isn't here, really.</p>") == "Text isn't here, really."
    assert main_text("<article><p title=\"open>One.</p><p>Two, more.</p></article>") == "One.\n\nTwo, more."
    assert main_text("a < b and c > d, 1 <2") == "a < b and c > d, 1 <2"
    assert main_text("<p>unfinished <b") == "unfinished <b"


def test_the_fullest_element_wins_over_the_markup():
    """A marked teaser does not hide an unmarked article."""
    rng = random.Random(3)
    text = [prose(rng, 50) for _ in range(8)]
    page = f"<body><article><p>Teaser.</p></article><div>{''.join(f'<p>{t}</p>' for t in text)}</div></body>"
    assert main_text(page) == "\n\n".join(text)


@pytest.mark.parametrize("page,holds", [
    ("".join(f"<div>block {k}, here." for k in range(20_000)), None),
    ("<p>" + "<a href='x " * 8000 + ">end", None), ("<a " * 50_000, None), ("<p title='" * 4000 + "x", None),
    ("<b>" * 20_000 + "<p>text, here</p>" * 2000, "text, here"), ("<b><div>" + "<i>" * 20_000 + "x</b>" * 20_000, "x"),
    ("</p>" * 50_000 + "done.", "done."), ("<table>" + "<tr><td>cell, one" * 20_000, "cell, one"),
    ("<p x=\">" + "<p y=\">\" <q" * 9000 + "last.", None), ("<![CDATA[" * 20_000, None), ("<!--" * 30_000, ""),
    ("<div class='" + "ad-x " * 20_000 + "'>text, kept.</div>", None),
])
def test_deep_and_broken_pages_take_linear_time(page, holds):
    start = time.perf_counter()
    text = main_text(page)
    assert time.perf_counter() - start < 2.0
    assert holds is None or (holds in text if holds else text == "")
