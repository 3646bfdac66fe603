"""HTML extraction: the tag scanner against a backtracking pattern, broken pages, layout names."""

import random
import re
import time

import pytest

from streamtab.llm import html_extract

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>\"']*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*)([^>]*)>")


def slow_tags(page):
    at, out = 0, []
    while at < len(page):
        m = TAG.search(page, at) or LOOSE.search(page, at)
        if m is None:
            break
        tag = m.lastindex is not None and m[2] is not None
        out.append((m.start(), m.end(), bool(tag and m[1]), m[2].lower() if tag else None, m[3] if tag else ""))
        at = m.end()
    return out


def fast_tags(page):
    at, out, tags = 0, [], html_extract.Scanner(page)
    while at < len(page) and (t := tags.next(at)):
        out.append(t)
        at = t[1]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scanner_equals_the_backtracking_pattern(seed):
    rng = random.Random(seed)
    bits = ["<", ">", "\"", "'", "a", " ", "/", "<p", "<a href=\"x\">", "</p>", "<!--", "-->", "<!x", "<?y", "<b c='", "=", "t e", "<img alt=\"a>b\"/>", "\n", "<1"]
    for _ in range(1_500):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert fast_tags(page) == slow_tags(page), page


@pytest.mark.parametrize("bit", ["<a href=\"x ", "<a", "<span class=ad>", "<div></x>", "<a b='", "<p title=\"a>b\" ", "<", "<!-", "</div>", "<div>", "<style"])
def test_a_broken_page_takes_linear_time(bit):
    page = bit * (1_000_000 // len(bit))
    t = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - t < 8            # square time would be minutes


TEXT = "The article is about the things that we have in the town and it is long enough to be read by all of them. " * 3


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article><p>%s</p></article></div>", "<main class='main with-header'><p>%s</p></main>",
    "<article class='post tags-river'><p>%s</p></article>", "<div class='sidebar layout'><main><p>%s</p></main></div>",
    "<body class='no-menu'><div class=\"nav\"><a href=x>Home</a></div><article><p>%s</p></article></body>"])
def test_layout_names_do_not_hide_the_article(page):
    assert html_extract.main_text(page % TEXT) == TEXT.strip()


def test_named_boilerplate_is_still_left_out():
    page = "<div class='site-header'><p>%s</p></div><div class='related'><article><p>%s</p></article></div><article><p>%s</p></article>"
    assert html_extract.main_text(page % (TEXT.replace("town", "menu"), TEXT.replace("town", "teaser"), TEXT)) == TEXT.strip()
    assert html_extract.main_text("<article hidden><p>%s</p></article><div class=comments><p>%s</p></div>" % (TEXT, TEXT)) == ""


def test_a_page_of_one_short_paragraph_is_kept():
    assert html_extract.main_text("<p>One short line.</p>") == "One short line."
    assert html_extract.main_text("<p><a href=x>Only a link</a></p>") == ""


def test_empty_pages_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
