import html
import random
import re
from itertools import product

import pytest

from textloom.llm import mincut
from textloom.llm.queries import op1_min_cut_text

PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body>
<header><a href=/>Site name</a><form action=/s><input name=q><button>Search</button></form></header>
<div class="cookie-notice">We use cookies to give you the best experience on our web site, and so on.</div>
<ul id="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul>
<div class="main"><div class="content"><h2>A heading</h2>
<p>The first paragraph of the <b>article</b> is long enough to look like one, with a comma &amp; all; <a href=x>a link</a>.
<p>The&nbsp;second   paragraph follows<br>after a break and tells more about what the first one said, at length.
<script>var a = "<p>not this</p>";</script><!-- <p>nor this</p> -->
<blockquote>Quoted words stand between paragraphs and belong to the text as much as they do.</blockquote>
<table><tr><td>Cell one<td>Cell two</table>
<p>The last paragraph, which is about as long as the others were, ends the article here.</p></div>
<div class="sidebar"><h3>Related</h3><p>Something else that you may want to read, it says here in the sidebar.</p></div>
<div id="comments"><p>First! I think that this article is wrong, and here is a long comment that says so in many words.</p></div></div>
<div class="advert">Buy this now, it is the best that there is, and it is cheap as well.</div>
<footer>&copy; 2020 Somebody. All rights reserved.</footer></body></html>"""


def test_page_without_article_element():
    assert mincut.main_text(PAGE).split("\n") == [
        "A heading",
        "The first paragraph of the article is long enough to look like one, with a comma & all; a link.",
        "The second paragraph follows after a break and tells more about what the first one said, at length.",
        "Quoted words stand between paragraphs and belong to the text as much as they do.",
        "Cell one",
        "Cell two",
        "The last paragraph, which is about as long as the others were, ends the article here.",
    ]


def test_min_cut_against_enumeration():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 8)
        content, boiler = ([rng.randrange(6) for _ in range(n)] for _ in range(2))
        edges = [(i, j, rng.randrange(4)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return sum(boiler[i] if keep else content[i] for i, keep in enumerate(label)) + sum(w for i, j, w in edges if label[i] != label[j])

        assert cost(mincut.min_cut(content, boiler, edges)) == min(map(cost, product([False, True], repeat=n)))


def test_smoothness_carries_a_short_block():
    words = "Several words make a sentence, and it has an end. " * 4
    source = f"<body><div><p>{words}</p><div>Short</div><p>{words}</p></div><nav><p>{words}</p></nav>"
    assert mincut.main_text(source).split("\n")[1] == "Short" and mincut.main_text(source).count("\n") == 2


def test_damaged_and_odd_pages():
    assert mincut.main_text(None) == mincut.main_text("") == mincut.main_text("<nav><a>x</a></nav>") == ""
    for source in ("<", "<p", "a < b & c &amp d", "<p>x<!-- y", "<script>p", "</p></div>", "<p title='", "<b><i></b></i>text", "\0", "<a " * 3000, "<div>" * 50_000 + "x" + "</p>" * 5000, "<p>a" * 20_000, "<li>" * 20_000, "&" * 50_000, "<!" * 20_000, "<p a='" * 3000):
        mincut.main_text(source)
    assert mincut.main_text("<article><p>A &lt;b&gt; &#65;&#x42; &copy &unknown; 5 < 6 and so on and so forth.</p></article>") == "A <b> AB © &unknown; 5 < 6 and so on and so forth."


def test_long_page_is_whole():
    words = "Several words make a sentence, and it has an end."
    assert mincut.main_text("<article>" + f"<p>{words}</p>" * 3000 + "</article>") == "\n".join([words] * 3000)


def _article(source):
    """The pages of the test tables hold their text in an article element, simply built."""
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1])
    parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


TWO = "<p>The first paragraph of the article is long enough to look like one, and it ends here.</p><p>The second paragraph says more about it, at some length, and then it ends as well.</p>"
TEXTS = "\n".join(re.findall("<p>(.*?)</p>", TWO))
OTHER = "<p>Another paragraph of many words stands here, which is no part of the article at all, as a reader can tell.</p>"


def test_wrappers_and_names_of_the_page_do_not_empty_it():
    for page in (f"<form id=aspnet>{TWO}</form>", f"<form id=aspnet><nav><a href=/>Home</a></nav><article>{TWO}</article><footer>{OTHER}</footer></form>", f"<body class='has-sidebar'>{TWO}</body>",
                 f"<div class='widget article'>{TWO}</div>", f"<div class='page-header more'>{TWO}</div>", f"<div class='sidebar-layout'><div>{TWO}</div></div>", f"<body id=comments class='search nav'><article>{TWO}</article></body>"):
        assert mincut.main_text(page) == TEXTS, page


def test_what_is_no_part_of_an_article_goes_even_inside_it():
    for part in ("section class=comments", "aside", "div class='article-comments'", "div class=werbung", "div id=kommentare", "ul class=publicite", "div class='post-related'", "div class=mainSidebar", "div role=complementary", "div class=commentaires", "form"):
        tag = part.split()[0]
        cards = f"<article class=entry>{OTHER}</article>"
        for inner in (OTHER, cards, f"<div>{OTHER}</div>" * 5):
            page = f"<article>{TWO}<{part}>{inner}</{tag}></article><{part}>{inner}</{tag}>"
            if part != "form" or inner is not cards:
                assert mincut.main_text(page) == TEXTS, page


def test_evidence_late_in_a_block_counts():
    odd = "\u4e00" * 5000
    late, early = (mincut.costs(mincut.blocks_of(f"<div>{x}</div>")[0]) for x in (odd + " word" * 70, "word " * 70 + odd))
    assert late == early != mincut.costs(mincut.blocks_of(f"<div>{odd}</div>")[0])
    notice, none = (mincut.costs(mincut.blocks_of(f"<div>{'word ' * 100}{x}</div>")[0]) for x in ("\u00a9", "x"))
    assert notice[1] > none[1]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op1_min_cut_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, _article(pages[r.page_id].html), len(r.text))


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (None, "<article><p>é🔥 is text, and quite so, one would say.</p></article>", "t")], "page_id long, html string, text string")
    rows = {(r.page_id, r.text, r.n_chars) for r in mincut.extract(df, carry=["page_id"]).collect()}
    assert rows == {(1, "", 0), (None, "é🔥 is text, and quite so, one would say.", 40)}
    assert mincut.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "inside",
    [
        "<aside>Related stories you may like to read today about this.</aside>",
        "<div class=newsletter-signup><p>Sign up to our newsletter to get the latest news in your inbox every morning.</p></div>",
        "<div class=disclaimer><p>This site is provided as is without any warranty of any kind, express or implied.</p></div>",
    ],
)
def test_boilerplate_between_paragraphs_is_not_tied_to_them(inside):
    text = ["The committee met on Tuesday to discuss the new budget for the coming year.", "After a long debate the proposal was accepted by a narrow majority."]
    whole = "".join(f"<p>{t}</p>" for t in text)
    assert mincut.main_text(f"<article>{whole}{inside}{whole}</article>").split("\n") == text * 2


def test_headers_of_page_and_of_article():
    text = "The committee met on Tuesday to discuss the new budget for the coming year."
    assert mincut.main_text(f"<header><h1>My Site</h1><p>The best site for news</p></header><div><p>{text}</p><p>{text}</p></div>") == f"{text}\n{text}"
    assert mincut.main_text(f"<article><header><h1>Title</h1></header><p>{text}</p><p>{text}</p></article>") == f"Title\n{text}\n{text}"


def test_copyright_line_neither_stays_nor_takes_a_short_text_along():
    page = "<div><div><a href=a>Home</a> | <a href=b>About</a></div><div>The committee met on Tuesday to discuss the new budget.<br>It was long.</div><div>© 2020 All rights reserved</div></div>"
    assert mincut.main_text(page) == "The committee met on Tuesday to discuss the new budget. It was long."
