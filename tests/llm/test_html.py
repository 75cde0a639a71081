"""Page trees, exact marginals against enumeration, and main texts of pages that no layout list wrote."""

import html as entities
import itertools
import re

import numpy as np
import pytest

from corpusmill.llm import html_extraction as E
from corpusmill.llm.html_tree import Page, blocks


def texts(source):
    page = Page(source)
    return blocks(page, [True] * len(page.tags))


@pytest.mark.parametrize(
    "source,want",
    [
        ("<p>a<p>b", "a\nb"),
        ("<p><b>a<br><p>b</p>c", "a\nb\nc"),
        ("<ul><li>a<li>b <ul><li>c</ul></ul>d", "a\nb\nc\nd"),
        ("<p>x &amp; y&nbsp;&lt;z&#233; &am &copy</p>", "x & y <zé &am ©"),
        ("<p>one <i>t</i>wo\n\n three<br>four</p>", "one two three four"),
        ("a<script>var x='<p>no</p>'</script>b<style>c</style><!-- <p>d</p> -->e", "abe"),
        ("<script>never closed <p>x", ""),
        ("<p>cut <a href='x", "cut"),
        ("1 < 2 and <3", "1 < 2 and <3"),
        ("<div title='a>b'>in</div title='x'>out</p></b></div>", "in\nout"),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"),
        ("<p><span>a</div></span> b</p>", "a\nb"),
        ("<select><option>a</select><textarea>b</textarea><noscript>c</noscript>d", "d"),
        ("", ""),
        ("<>&#0;</><!x><?y?>z", "�z"),
    ],
)
def test_tolerant_reading(source, want):
    assert texts(source).replace("<>", "") == want


def test_deep_pages_are_read():
    page = Page("<div>" * 5_000 + "x")
    assert len(page.tags) == 5_001 and E.train().probabilities([page])[0].shape == (5_001,)


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(3)
    for parents in ([-1], [-1, 0, 0, 1, 1, 2], [-1, 0, 1, -1, 3, 3, 3]):
        parents = np.array(parents)
        kinds = rng.integers(0, E.KINDS, len(parents))
        unary, pairs = rng.normal(size=(len(parents), 3)), E.potentials(rng.normal(size=(E.KINDS, 3, 3)))
        found, both = E.marginals(E.forest(parents, kinds), unary, pairs)
        want, want_both = np.zeros_like(found), np.zeros_like(both)
        for labels in itertools.product(range(3), repeat=len(parents)):
            weight = np.exp(sum(unary[i, label] for i, label in enumerate(labels)))
            for i, p in enumerate(parents):
                weight *= pairs[kinds[i], labels[p], labels[i]] if p >= 0 else 1
            for i, p in enumerate(parents):
                want[i, labels[i]] += weight
                if p >= 0:
                    want_both[i, labels[p], labels[i]] += weight
        total = want[0].sum()
        np.testing.assert_allclose(found, want / total, atol=1e-9)
        np.testing.assert_allclose(both, want_both / total, atol=1e-9)


# Pages in layouts of their own, with what should come out.
PAGES = [
    (
        '<html><body><div id="topmenu"><a href=/>Home</a> <a href=/a>News</a></div><div class="mainContent"><h1>Rain at last</h1>'
        "<p>It rained for three days, and the river rose.</p><p>Farmers were glad.</p><div class='advertBox'>Buy two boots now!</div>"
        "<p>Schools stayed open.</p></div><div id='footerBottom'>&copy; 2020 The Paper. All rights reserved.</div></body></html>",
        "Rain at last\nIt rained for three days, and the river rose.\nFarmers were glad.\nSchools stayed open.",
    ),
    (
        "<body><header><h1>My Site</h1><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav></header><main><article><h1>Bread</h1>"
        "<p>Take flour. <a href=x>Warm water</a> helps.</p><ul><li>Salt.</li><li>Yeast.</li></ul></article>"
        '<section class="commentlist"><h2>Comments</h2><p>Great recipe, thanks!</p><p>I burnt mine.</p></section></main>'
        '<aside class="sideBar"><h3>Popular</h3><ul><li><a href=3>Cake</a></ul></aside><footer>Contact us. Imprint.</footer></body>',
        "Bread\nTake flour. Warm water helps.\nSalt.\nYeast.",
    ),
    (
        '<body><div class="cookieConsent"><p>We use cookies to improve this site. <a href=p>More</a></p><button>Accept</button></div>'
        '<nav class="breadcrumbs"><a href=/>Start</a> &gt; <a href=/b>Blog</a></nav><article class="post"><h1>On walking</h1><p>Walk.</p>'
        "<p>Then walk on, further than before, until the lamps are lit.</p></article>"
        '<form class="newsletterSignup"><p>Get our letter every week.</p><input type=email></form></body>',
        "On walking\nWalk.\nThen walk on, further than before, until the lamps are lit.",
    ),
    (
        '<body><div class="notice">Site down for maintenance on Sunday.</div><div class="menu"><a href=1>m1</a><a href=2>m2</a></div>'
        '<div class="post"><h2>Post title</h2><div>Text in a div, not a p.</div><div>More text in a div.</div><ul class="share"><li>'
        '<a href=f>Share</a></li></ul></div><div class="sidebar">Popular posts <a href=p>p1</a></div></body>',
        "Post title\nText in a div, not a p.\nMore text in a div.",
    ),
    (
        '<body><article><h1>T</h1><p>Text a.</p><form class="newsletter"><p>Sign up for our newsletter.</p><input></form><p>Text b.</p>'
        '<section id="comments"><h3>3 comments</h3><ol><li><p>Great!</p></li><li><p>So so.</p></li></ol></section></article></body>',
        "T\nText a.\nText b.",
    ),
    ("<body><h1>Plain page</h1><p>Only paragraphs here.</p><p>And one more.</p></body>", "Plain page\nOnly paragraphs here.\nAnd one more."),
    (
        '<body><div class="wrapper"><header><a href="/">Home</a></header><main><h1>Story</h1><p>One.</p><p>Two.</p><div class="comments">'
        '<div class="comment"><p>user says hi</p></div></div></main><aside><p>Sidebar blurb text here.</p></aside></div></body>',
        "Story\nOne.\nTwo.",
    ),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_texts(page, want):
    parsed = Page(page)
    assert E.main_text(parsed, E.train().probabilities([parsed])[0]) == want


def article(source):
    """What stands in the only article of a plain page, by its paragraphs."""
    lines = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", source, re.S)[1])
    lines = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", line)).split()) for line in lines]
    return "\n".join(line for line in lines if line)


def test_registered_query_on_every_page(spark):
    from corpusmill.llm import suite

    folder = "/root/testdata/sf0.001"
    want = {r["page_id"]: article(r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = suite.op13_html_extraction(spark, folder).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and len(got) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_odd_rows(spark):
    rows = [(1, None, "t"), (2, "", "t"), (3, PAGES[0][0], "t"), (3, PAGES[0][0], "t"), (None, "<p>", None), (4, "<main><p>" + "word " * 400_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = E.extract(pages, E.train())
    found = [(r["page"]["page_id"], r["page"]["text"], r["text"]) for r in got.collect()]
    long = ("word " * 400_000).strip()
    want = [(1, "t", ""), (2, "t", ""), (3, "t", PAGES[0][1]), (3, "t", PAGES[0][1]), (None, None, ""), (4, "t", long)]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert E.extract(pages.where("false"), E.train()).collect() == []


def test_training_on_given_labelled_pages():
    labelled = [f'<body><div class="zz"><p>{"menu " * n}</p></div><div class="qq" data-main="1"><p>{"prose " * n}</p></div></body>' for n in range(2, 30)]
    page = Page('<body><div class="zz"><p>some words here</p></div><div class="qq"><p>other words here</p></div></body>')
    assert E.main_text(page, E.train(labelled).probabilities([page])[0]) == "other words here"
