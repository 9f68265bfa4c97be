from __future__ import annotations

import time

import cases
import pytest
from pyspark.sql import functions as F

from siltgate.llm import html

STOPS = frozenset(w for words in html.STOP_WORDS.values() for w in words.split())
LONG = "The cat is in the house and it was on the mat with the dog. " * 5
LONG_TEXT = " ".join(LONG.split())


def text(page):
    return html.main_text(page, STOPS)


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
      <header><p>{LONG}</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="ad">{LONG}</div>
      <script>var a="</p>"</script><!-- {LONG} --><article><h1>A&amp;B &#233;</h1><p>{LONG}<p>Short.
      <div class="comments"><p>{LONG}</p></div><p>See <b>th</b>is  and\n that.<br>Next</article>
      <aside>{LONG}</aside><form><p>{LONG}</p></form><div id="cookie-notice">{LONG}</div><footer>&copy; {LONG}</footer>"""
    assert text(page) == f"A&B é\n\n{LONG_TEXT}\n\nShort.\n\nSee this and that. Next"


def test_second_pass_gives_short_blocks_the_label_of_their_neighbours():
    page = f"<div><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><div>{'<a href=x>link text here</a> ' * 9}</div><div>Short two.</div><div>{'<a href=y>more of these</a> ' * 9}</div>"
    assert text(page) == f"{LONG_TEXT}\n\nShort one.\n\n{LONG_TEXT}"


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>Just text &amp; more &lt;b&gt; &#233;", "Just text & more <b> é"), ("<script>x", ""),
        ("a < b and c", "a < b and c"), ("<article><p>One<p>One<p>One</article>", "One\n\nOne\n\nOne"), ("<p>a&nbsp;b</p", "a b"),
        ("<article></div></p><p>x</article>", "x"), ("<!-- never closed <p>text", ""), ("<article>a <a href=\"x>b</a> and more</article>", "a b and more"), ("<p>a</p><div class='ad", "a"),
    ],
)
def test_broken_and_small_pages(page, expected):
    assert text(page) == expected


def test_every_page_keeps_its_row(spark):
    big = "<article>" + "<p>The word is in the text.</p>" * 20_000 + "</article>"
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (None, None, None), (2, "u", ""), (3, "v", big)]
    pages = cases.clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "text", "n_blocks")
    made = html.extract(pages).select("page_id", "text", F.length("_main.text"), "_main.n_blocks")
    expected = [(1, "mine", 1, 1), (1, "mine", 1, 1), (None, "mine", 0, 0), (2, "mine", 0, 0), (3, "mine", 20_000 * 26 - 2, 20_000)]
    assert sorted([tuple(r) for r in made.collect()], key=repr) == sorted(expected, key=repr)
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("made", [
    lambda n: "<b>" * n + "</i>" * n, lambda n: "<iframe>" * n, lambda n: "<b><div>" + "<i>" * n + "</b>" * n, lambda n: "<b>" * n + "<p></p>" * n,
    lambda n: "<!--" * n, lambda n: '<a "' * n, lambda n: "<div>" * n + "</div>" * n,
])
def test_hostile_pages_take_time_in_proportion(made):
    page = made(60_000)
    start = time.process_time()
    html.main_text(page, frozenset(["the"]))
    assert time.process_time() - start < 10
