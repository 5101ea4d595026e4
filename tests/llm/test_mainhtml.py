import html
import random
import re
import time

import pytest

from netaudit.llm.mainhtml import Weights, best_region, extracted, main_text

PAGE = """<html><body><header class=top><h1>Site</h1><ul><li>Home<li>News</ul></header><div class="cookie-notice">We use cookies <button>OK</button></div>
<div id=sidebar><p>Popular posts one two three four five six</p></div>
<{tag} class="content"><h2>Title &eacute;</h2><p>First paragraph with <b>bold</b> words &amp; more words to make it longer than others.<p>Second  para<br>graph with <a href=x>a link</a> inside it.
<div class="ad">Buy now! Best offers here</div><form><label>Mail</label><input></form><ul><li>item one of list<li>item two of list</ul><script>var a="<p>no</p>";</script><!-- <p>no</p> -->
<p>Last one of the story, which also has some words.</p><div class=comments><p>Reader one agrees with all of it</p></div></{tag}>
<section id="comments"><h3>3 comments</h3><p>Reader says this is a really great article and I liked it a lot thanks very much</p></section><footer>&copy; 2020 Site about contact imprint</footer></body></html>"""
TEXT = """Title é
First paragraph with bold words & more words to make it longer than others.
Second para graph with a link inside it.
item one of list
item two of list
Last one of the story, which also has some words."""


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_furniture_goes_and_blocks_stay(tag):
    assert main_text(PAGE.replace("{tag}", tag), Weights()) == TEXT


@pytest.mark.parametrize("page", [None, "", "   ", "<p>", "<!-- x", "<script>a", "<a href='x", "</p></div>", "<" * 50, "<nav>only a menu</nav>"])
def test_pages_without_text(page):
    assert main_text(page, Weights()) in ("", "<" * 50)


def test_region_is_the_best_of_all():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-2, -1, -0.5, 1, 2]) for _ in range(rng.randrange(1, 12))]
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        a, b = best_region(scores)
        assert sum(scores[a:b]) == pytest.approx(max(0, *sums)) if len(sums) > 1 else True


def test_against_marked_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")

    def marked(source):
        article = source[source.index("<article>") + 9 : source.index("</article>")]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split("</?(?:p|h1)>", article))
        return "\n".join(b for b in blocks if b)

    want = {r.page_id: (r.url, marked(r.html), len(marked(r.html))) for r in pages.collect()}
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in extracted(pages).collect()} == want
    # Without their marks, most words are still found by the weights learnt elsewhere.
    bare = pages.selectExpr("page_id", "url", "replace(replace(html, '<article>', '<div>'), '</article>', '</div>') as html")
    rows = extracted(pages.unionByName(bare.selectExpr("page_id + 1000000 as page_id", "url", "html"))).filter("page_id >= 1000000").collect()
    assert sum(r.text == want[r.page_id - 1000000][1] for r in rows) / len(rows) >= 0.95


def test_edge_pages(spark):
    rows = [(1, "u", None, 5), (None, None, "<p>some words here</p>", 5), (2, "u", "<p>a b c</p>", 5), (2, "u", "<p>a b c</p>", 5), (3, "u", "<p>" + "word " * 100_000, 5)]
    got = sorted((r.page_id or -1, r.n_chars) for r in extracted(spark.createDataFrame(rows, "page_id long, url string, html string, kind int")).collect())
    assert got == [(-1, 15), (1, 0), (2, 5), (2, 5), (3, 499_999)]
    assert extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("furniture", ["<aside>{}</aside>", "<div class=ad>{}</div>", "<form><p>{}</p></form>", "<div id=related><ul><li><a href=x>{}</a></ul></div>", "<section class=comments><article><p>{}</p></article></section>"])
@pytest.mark.parametrize("parts", [(60, 300), (300, 60), (60, 60)])
@pytest.mark.parametrize("weights", [Weights(), Weights({"article": 2.0, "outside": -2.0, "furniture": -2.0}, {"aside": -2.0, "form": -2.0})])
def test_long_furniture_does_not_cut_an_article(furniture, parts, weights):
    first, last = ("one " * parts[0]).strip(), ("two " * parts[1]).strip()
    page = f"<body><nav>{'menu ' * 50}</nav><article><p>{first}</p>{furniture.format('buy ' * 500)}<p>{last}</p></article><footer>{'foot ' * 50}</footer></body>"
    assert main_text(page, weights) == f"{first}\n{last}"


@pytest.mark.parametrize("head", [
    "<html><head><title>t</title><body>", "<head><meta charset=utf-8><style>p {}</style><script>x()</script><body class=a>", "<html><head><title>t</title></head><body>",
    "<head><title>t</title><link rel=x>", "<HEAD><TITLE>t</TITLE><noscript><p>no</p></noscript><div>",
])
def test_head_without_its_end(head):
    assert main_text(f"{head}<article><p>Words of the story</p></article>", Weights()) == "Words of the story"


def test_words_end_a_head():
    assert main_text("<head><title>t</title> Words of the story", Weights()) == "Words of the story"


STORY = " ".join(f"word{i}" for i in range(200))


@pytest.mark.parametrize("wrapper", [
    '<form id="aspnetForm"><div>{}</div></form>', '<div class="content has-sidebar">{}</div>', '<div id="page" class="site header-fixed">{}</div>',
    '<div class="post no-comments">{}</div>', '<div class="share">{}</div>', '<div class="with_nav sidebar-right">{}</div>', '<header>{}</header>', '<div class="widget-area">{}</div>',
])
@pytest.mark.parametrize("body", ["<p>{}</p>", "<article><p>{}</p></article>", "<div><p>{}</p></div>"])
def test_wrappers_with_furniture_names_keep_their_article(wrapper, body):
    menu = "<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><footer>About the site</footer>"
    assert main_text(f"<html><body>{wrapper.format(menu + body.format(STORY))}</body></html>", Weights()) == STORY


def test_long_comments_stay_furniture():
    comments = f"<div class=comments><p>{'reader ' * 600}</p></div>"
    for body in ("<article><p>{}</p></article>{}", "<div><p>{}</p></div>{}", "<main><p>{}</p>{}</main>", "<article><p>{}</p></article><section id=comments><article>{}</article></section>"):
        assert main_text(f"<body>{body.format(STORY, comments)}</body>", Weights()) == STORY


def test_all_marked_articles_and_their_titles():
    page = f"<body><article><header class=entry-header><h1>One</h1></header><p>{STORY}</p></article><div>{'teaser ' * 80}</div><article><h2>Two</h2><p>Short text.</p></article></body>"
    assert main_text(page, Weights()) == f"One\n{STORY}\nTwo\nShort text."


@pytest.mark.parametrize("source", [
    "<span>" * 100_000 + "</b>" * 100_000, "<p>" + "<span>" * 100_000 + "<div></div>" * 100_000, "<table><tr><td>" + "<i>" * 100_000 + "</td>" * 5 + "<b></p>" * 100_000,
    "<article>" * 50_000 + "</div>" * 50_000, "<nav>" * 50_000 + "</nav>" * 50_000, "<li>a" * 100_000,
])
def test_broken_pages_take_linear_time(source):
    start = time.perf_counter()
    main_text(source, Weights())
    assert time.perf_counter() - start < 6
