"""The block rules on pages of many makes, and against the pages' own articles."""

import html
import random
import re
import time

import pandas as pd
import pytest

from plumbline.llm import html_text as H

PROSE = "The quick brown fox was in the garden and it is a good day for all of us, as they said to him at the end of the road when it was over. "
LONG = (PROSE * 2).strip()


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single has-sidebar"><p>%s</p></body>',
        '<html class="js no-footer"><body id="menu"><p>%s</p></body></html>',
        '<div class="overflow-hidden"><p>%s</p></div>',
        '<div class="main-content with-sidebar"><p>%s</p></div>',
        '<article class="post has-comments"><p>%s</p></article>',
        '<div class="page sidebar-layout"><div><p>%s</p></div></div>',
        '<form action="/x"><div><p>%s</p></div></form>',
        '<nav><a href="/">home</a></nav><td>%s</td><footer>(c) 2020 us and the others of the world</footer>',
        '<div class="comments"><p>I like this and it is the best of all.</p></div><p>%s</p><div class="comment-list"><p>' + PROSE * 9 + "</p></div>",
        '<div class="cookie-notice"><p>' + PROSE + "</p></div><p>%s</p>",
        '<p style="display:none">' + LONG + '</p><p>%s</p><div hidden><p>' + LONG + "</p></div>",
        "<ul>" + "".join(f"<li><a href=/{k}>Item of the menu {k}</a></li>" for k in range(9)) + "</ul><p>%s</p>",
        "<p>%s",
    ],
)
def test_text_is_found_wherever_it_stands(page):
    assert H.main_text(page % LONG) == LONG


def test_a_story_element_is_no_switch():
    assert H.main_text(f'<p>{LONG}</p><div class="story">Read on</div>').startswith(LONG)


@pytest.mark.parametrize("text", ["今天天气很好，我们去公园散步。" * 5, "ذهب الولد إلى المدرسة في الصباح الباكر. " * 6, "Zażółć gęślą jaźń oraz pójdź kińże tę chmurność w głąb flaszy. " * 5, "Сегодня хорошая погода, и мы идём гулять в парк. " * 5])
def test_languages_without_stop_words(text):
    assert H.main_text(f"<nav><a href=/>x</a></nav><div><p>{text}</p></div><footer>y</footer>") == text.strip()


def test_short_blocks_inherit_from_the_nearest_decided_ones():
    links = "<p>" + "".join(f'<a href="/{k}">one of the links {k}</a> ' for k in range(9)) + "</p>"
    page = f"{links}<p>Up here.</p>{links}<p>{LONG}</p><p>Between.</p><p>{LONG}</p>{links}<p>Down there.</p>{links}"
    assert H.main_text(page) == f"{LONG}\n\nBetween.\n\n{LONG}"


def test_first_pass_by_the_rules():
    block = lambda text, **more: H.Block(text=text, **more)
    assert H.first_pass(block(LONG), False, True) == H.GOOD
    assert H.first_pass(block(LONG), True, True) == H.BAD
    assert H.first_pass(block(LONG, linked=len(LONG)), False, True) == H.BAD
    assert H.first_pass(block("xylophone qwerty zxcvb " * 9), False, True) == H.BAD
    assert H.first_pass(block(PROSE[:100]), False, True) == H.NEAR
    assert H.first_pass(block("Short."), False, True) == H.OPEN
    assert H.first_pass(block(LONG, heading=True), False, True) == H.OPEN


def test_broken_and_odd_markup():
    assert H.main_text("") == "" and H.main_text("<") == "<" and H.main_text("<p") == "" and H.main_text("</p></div>") == ""
    assert H.main_text("<p>a &lt;b&gt; &amp;amp; &#x41;&nbsp;c</p><!-- <p>no</p>") == "a <b> &amp; A c"
    assert H.main_text("<script>var a = '<p>no</p>';</script><style>p{}</style><p>yes<noscript>no</noscript></p>") == "yes"


def paragraphs(page):
    """The article's own blocks, for pages whose article holds nothing but headings and paragraphs."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    if re.search(r"<(?!/?(h1|p|b|br|i|em|a)\b)", re.sub(r"<script.*?</script>|<!--.*?-->", "", inner, flags=re.S)):
        return None
    inner = re.sub(r"<script.*?</script>|<!--.*?-->", "", inner, flags=re.S)
    parts = re.split(r"<(?:/?h1|/?p)\b[^>]*>", inner)
    return [t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", x)).split()) for x in parts) if t]


def test_articles_of_the_tables_are_whole():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html.dropna()
    checked = 0
    for page in pages:
        want = paragraphs(page) if "<article>" in page else None
        if want is not None:
            assert H.main_text(page).split("\n\n") == want
            checked += 1
    assert checked > 50


def test_without_article_elements_most_of_the_text_stays():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html.dropna()
    kept = every = extra = 0
    for page in pages:
        whole = H.main_text(page).split("\n\n")
        bare = H.main_text(re.sub(r"</?(article|main)[^>]*>", "", page)).split("\n\n")
        every += sum(map(len, whole))
        kept += sum(len(t) for t in whole if t in bare)
        extra += sum(len(t) for t in bare if t not in whole)
    assert kept > 0.9 * every and extra < 0.02 * every


def test_random_markup_never_fails():
    r = random.Random(2)
    bits = ["<p>", "</p>", "<div class='ad x'>", "</div>", "<a href=x>", "</a>", "text of the page ", "<!--", "-->", "<script>", "</script>", "&amp;", "<br/>", "<li>", "<", ">", "<h1>", "</h1>", "<nav>", "</nav>", '"', "<article>", "</article>", "<td hidden>"]
    for _ in range(500):
        H.main_text("".join(r.choice(bits) for _ in range(r.randint(0, 60))))


ARTICLE = "<p>" + "The river is as old as the hills, and it was there before any of the people who live on it came to the valley. " * 3 + "</p>"


@pytest.mark.parametrize(
    "wrap",
    ['<div class="page type-page comments-closed">{}</div>', '<div id="discussion">{}</div>', '<div class="reply-to-critics">{}</div>', '<div class="discussion"><h1>A river</h1>{}</div><p>' + "All of this is the view of those who wrote it and not that of the town, as it was said before. " * 3 + "</p>", "<aside>{}</aside>"],
)
def test_no_name_takes_a_whole_article(wrap):
    page = f"<html><body><ul><li><a href=/>Home</a></ul>{wrap.format(ARTICLE * 4)}<footer>Imprint</footer></body></html>"
    assert H.main_text(page).count("The river is as old") == 12


def test_comments_longer_than_the_article_go():
    talk = "".join(f"<li class=comment><p>{'I think that it is not so, and all of us who were there know it. ' * 4}</p>" for _ in range(20))
    page = f"<body><h1>A river</h1>{ARTICLE}<div id=comments><ol class=commentlist>{talk}</ol></div></body>"
    assert "The river" in H.main_text(page) and "I think" not in H.main_text(page)


@pytest.mark.parametrize("page", ["<nav>the " * 100_000, "<div class=sidebar><b>" * 50_000 + "</i>" * 50_000, "<a \"" * 60_001, "<p><span hidden>a</x>" * 50_000, "<!--" * 60_000, "<script>" * 50_000, "</p>" * 100_000 + "<li>x" * 50_000])
def test_hostile_markup_takes_seconds(page):
    began = time.time()
    H.main_text(page)
    assert time.time() - began < 20
