from html import unescape

import numpy as np
import pytest

from lakeloom.llm import html_extract as h
from lakeloom.llm.boosting import Trees
from lakeloom.llm.html_pages import Page

LONG = "Plain words make up this long paragraph, which goes on for a while. It has several sentences, and commas. "


def text_of(html):
    return h.extract_pages([html], h.trained())[0]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Trees(n_trees=60, depth=3).fit(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) > 0) == (y[3000:] > 0.5)).mean() > 0.97


def test_held_out_pages():
    pages = [Page(50_000 + i) for i in range(150)]
    got = h.extract_pages([p.html for p in pages], h.trained())
    want = ["\n\n".join(" ".join(unescape(b).split()) for b in p.blocks) for p in pages]
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.95 * len(pages)


def test_tables_pages_are_their_articles(spark, sf_dir):
    import re

    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in df.collect()}
    for r in h.extract_text(df).collect():
        article = re.search("<article>(.*?)</article>", html[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("where", ['<div class="cookie-notice"><p>{}</p></div>', '<section id="comments"><div class="comment"><p>{}</p></div></section>', '<aside class="sidebar"><p>{}</p></aside>', '<div class="ad">{}</div>', "<form><p>{}</p><input></form>", "<footer><p>{}</p></footer>", "<script>{}</script>", "<style>{}</style>", "<!-- {} -->"])
def test_other_parts_are_left_out(where):
    page = f"<html><body><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><article><h1>The title here</h1><p>{LONG * 3}</p><p>{LONG}</p></article>{where.format('Something else entirely, said by others.')}</body></html>"
    assert text_of(page) == "\n\n".join(["The title here", (LONG * 3).strip(), LONG.strip()])


def test_references_white_space_and_inline_markup():
    page = f"<article><h1>A &amp; B&nbsp;&eacute; &#x41;&lt;b&gt;</h1><p>{LONG}one <b>bo</b>ld\n\t two<br>three <a href='x>y'>link</a>.<p>{LONG}"
    assert text_of(page).split("\n\n") == ["A & B é A<b>", LONG + "one bold two three link.", LONG.strip()]


@pytest.mark.parametrize("page", ["", " ", "<", "<a", "<p", "<!--", "<!-- x", "<script>", "</p></div>", "&", "<div " + "a=\"" * 2000, "<" * 5000, "<b>" * 3000, "<div>" * 3000 + "x", "<p>" + "word " * 200_000, "<title>x", "<a href=\"x" * 500])
def test_broken_pages_do_not_fail(page):
    assert isinstance(text_of(page), str)


def test_nulls_repeats_clashes_and_empty(spark):
    page = f"<article><p>{LONG * 2}</p></article>"
    df = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None), (2, "v", "", "y")], "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in h.extract_text(df).collect())
    want = (LONG * 2).strip()
    assert got == [("1", want, len(want)), ("1", want, len(want)), ("2", "", 0), ("None", "", 0)]
    assert h.extract_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("icon", ['<svg class="i" viewBox="0 0 1 1"/>', "<svg/>", "<MATH a=b />", "<script src=/x /><script>var x = 1;</script>", "<svg><svg x='1'><path d='M0'/></svg>icon<svg/></svg>", "<svg><use href=/a/></svg>", "<svg a=/b/>icon</svg>", "<iframe src=/x />", "<textarea/>", "<svg><foreignObject><p>in it</p></foreignObject><title>t</title></svg>"])
def test_icons_take_no_text_with_them(icon):
    page = "<html><body><nav><a href='/'>{0}Home</a></nav><article><p>%s</p><p>Second. {0}%s</p><p>Third. %s</p></article>{0}<footer>x<svg>icon</svg></footer></body></html>" % (LONG, LONG, LONG)
    runs = lambda i: [t for t in h.parse(page.format(i)).text if t]
    assert runs(icon) == runs("")
    assert text_of(page.format(icon)) == text_of(page.format(""))
    assert text_of(page.format(icon)).count("Plain words") == 3


def runs(html):
    return [t for t in h.parse(html).text if t]


def test_unclosed_parts_take_no_text_with_them():
    for part in ("<svg><path d='M0'>", "<iframe src=/x>", "<noscript>", "<select>", "<template>"):
        assert runs(f"<p>one</p>{part}<p>two</p><div>three</div>") == ["one", "two", "three"], part


def test_formulas_keep_their_text():
    page = "<p>So <math><mi>a</mi><mo>=</mo><mn>1</mn><annotation encoding='x'>a eq 1</annotation></math> &amp; <math/>more</p>"
    assert runs(page) == ["So a=1 & more"]


@pytest.mark.parametrize("page", ["<b>" * 50_000 + "</i>" * 200_000, "<i><div>" + "<b>" * 50_000 + "</i>" * 100_000, "<li><div>" + "<h2>" * 20_000 + "<li>" * 100_000, "<td><div>" + "<b>" * 50_000 + "<td>" * 100_000, "<iframe>" * 100_000, "<div>" * 100_000 + "</p>" * 100_000, "<b>" * 50_000 + "<h2>" * 50_000, "<dd>" * 100_000 + "<dt>" * 100_000, "<svg>" * 100_000, "<a \">" * 100_000, "<p><b>" * 100_000])
def test_unbalanced_tags_parse_in_linear_time(page):
    import time

    began = time.time()
    h.parse(page)
    assert time.time() - began < 5


#: Pages made by hand, not by the generator of training pages, with their main text.
HAND_MADE = [
    ("<h1>The plain title</h1>" + f"<p>{LONG}</p>" * 3 + "<p>The end.</p>", ["The plain title", *[LONG.strip()] * 3, "The end."]),
    (f"<body><main><h1>Ten places to see</h1><p>{LONG * 2}</p><ul><li><a href=/a>The old harbour and its cranes</a></li><li><a href=/b>A museum of clocks, open daily</a></li><li><a href=/c>The market hall on the square</a></li></ul><p>{LONG}</p></main><footer><p>Imprint</p></footer>", ["Ten places to see", (LONG * 2).strip(), "The old harbour and its cranes", "A museum of clocks, open daily", "The market hall on the square", LONG.strip()]),
    (f'<body><nav><a href=/>Home</a><a href=/n>News</a></nav><div class="news-comment-piece"><h1>An opinion</h1><p>{LONG * 2}</p><p>{LONG}</p></div><div class="sidebar"><h3>More</h3><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></div>', ["An opinion", (LONG * 2).strip(), LONG.strip()]),
    (f'<body><header><a href=/>Site</a><nav><a href=/x>X</a> <a href=/y>Y</a></nav></header><div id="wrap"><div class="left"><h1>Report</h1><p>{LONG}</p><table><tr><td>Year</td><td>Sales</td></tr><tr><td>2020</td><td>17</td></tr></table><p>{LONG * 2}</p></div><div class="sidebar-content"><p>Read also this text about something else.</p></div></div><div id="comments"><h2>Replies</h2><div class="comment-text"><p>I do not agree with any of it, sorry.</p></div></div>', ["Report", LONG.strip(), "Year", "Sales", "2020", "17", (LONG * 2).strip()]),
    (f"<html><body><div><div><h1>Untitled</h1><div>{LONG}</div><div>{LONG * 2}</div></div></div><form action=/s><input name=q><button>Search</button></form></body></html>", ["Untitled", LONG.strip(), (LONG * 2).strip()]),
    (f"<article class='post'><h1>Recipe</h1><p>{LONG}</p><ol><li>Cut the onions into small cubes.</li><li>Fry them in butter until they are soft.</li></ol><blockquote>It is the best I ever had.</blockquote><pre>salt 5 g\nwater 1 l</pre><div class='share-buttons'><a href=#>Tweet</a> <a href=#>Mail</a></div></article>", ["Recipe", LONG.strip(), "Cut the onions into small cubes.", "Fry them in butter until they are soft.", "It is the best I ever had.", "salt 5 g water 1 l"]),
]


@pytest.mark.parametrize("n", range(len(HAND_MADE)))
def test_hand_made_pages(n):
    page, want = HAND_MADE[n]
    assert text_of(page).split("\n\n") == want
