"""Operator 13: the registered query against a plain reading of the
article element, other layouts against their known texts."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import html_text as ht
from tallyhouse.llm import queries

SF = "/root/testdata/sf0.01"


class Article(HTMLParser):
    """Blocks of the article element: headings and paragraphs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.on |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br" and self.on:
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.on &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.on:
            self.blocks[-1] += data


def plain(html):
    p = Article()
    p.feed(html)
    p.close()
    return "\n\n".join(b for b in (" ".join(x.split()) for x in p.blocks) if b)


def test_query_equals_a_plain_reading_of_the_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = queries.op13_html_text(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = sorted((r["page_id"], r["url"], plain(r["html"]), len(plain(r["html"]))) for r in pages)
    assert sorted(map(tuple, got.collect())) == want and all(n for *_, n in want)


@pytest.fixture(scope="module")
def weights(spark):
    return ht.fit(spark.read.parquet(f"{SF}/pages.parquet"))


HAND = ht.weights_of([(k, i, n) for (k, i), n in ht.hand_marked().items()])
LONG = "Words of the text go on for a while here, as they do in a paragraph that somebody wrote with care. " * 3
SAID = " ".join(LONG.split())

LAYOUTS = {
    "no article element": (f"""<body><header><a href=/>Site</a></header><nav><a href=/a>A</a></nav><div id=content><h1>Title</h1>
        <p>{LONG}</p><p>Short.</p></div><aside><p>{LONG}</p></aside><footer>End of page</footer></body>""", f"Title\n\n{SAID}\n\nShort."),
    "parts inside the article": (f"""<main><article class="post has-sidebar"><header><h1>Title</h1></header><p>{LONG}</p><div class="ad">
        <p>Buy it</p></div><div class="share-buttons"><a href=x>Share</a></div><p>{LONG}</p><form><input name=q>Send it</form>
        <ul><li>One thing</li><li><a href=y>Other thing</a></li></ul><footer>Tags</footer><section id="comments"><h3>Comments</h3>
        <article class="comment"><p>{LONG}{LONG}</p></article></section></article></main>""",
                                 f"Title\n\n{SAID}\n\n{SAID}\n\nOne thing\n\nOther thing"),
    "cookie notice, hidden parts": (f"""<div class="cookie-notice"><p>{LONG}</p></div><div class="main-content"><h2>Title</h2><p>{LONG}</p>
        <p hidden>Not seen</p><p style="display: none">Nor this</p><p>Seen &amp; read&nbsp;&#8212; &lt;b&gt;</p></div>
        <div class="newsletter-signup"><p>Join us now</p></div>""", f"Title\n\n{SAID}\n\nSeen & read — <b>"),
    "a table as layout": (f"""<table><tr><td><a href=1>Home</a><a href=2>News</a></td><td><h2>Title</h2><p>{LONG}<p>{LONG}</td>
        <td><a href=3>More</a></td></tr></table>""", f"Title\n\n{SAID}\n\n{SAID}"),
    "text beside the article": (f"<p>Sign in first</p><article><p>{LONG}</p></article><p>Other news</p>", SAID),
    "several articles": (f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>", f"{SAID}\n\n{SAID}"),
    "a teaser as article": (f"<div><article>Read it</article></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{SAID}\n\n{SAID}"),
    "inline markup": ("<article><p>un<b>bro</b>ken w<i>or</i>d, a<br>line\n\t and <a href='#'>a link</a>!</p></article>",
                      "unbroken word, a line and a link!"),
    "raw elements": (f"""<article><p>{LONG}<script>if (a < b) "</p>"</script><style>p > b {{}}</style><!-- no <p>text --> on</p>
        <noscript>none</noscript><textarea>no</textarea><svg><text>no</text></svg><![CDATA[and data]]></article>""", f"{SAID} on\n\nand data"),
    "broken markup": (f"""<article><p class="x>y" title='a>b'>{LONG}<p>one <b>two <i>three</b> four</div> a < b and 3<4
        <ul><li>five<li>six</ul><p class=">seven""", f"{SAID}\n\none two three four a < b and 3<4\n\nfive\n\nsix\n\nseven"),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(weights, name):
    page, want = LAYOUTS[name]
    for w in (weights, HAND):
        assert ht.extract(page, w) == want


def test_hand_marked_pages_give_their_marked_text():
    for page in ht.LABELLED:
        got = ht.extract(page, HAND)
        assert got.startswith(("A title", "Words", "A heading", "The first")) and "Rights" not in got and "Latest" not in got
        marked = ht.extract("<article>" + page.split("<!--text-->")[1].split("<!--/text-->")[0] + "</article>", HAND)
        assert got == marked


def test_weights_have_the_signs_of_the_method(weights):
    for w in (weights, HAND):
        assert all((v >= 0) if k.startswith("word") else (v < 0) for k, v in w.items())
        assert w["word:p:long"] > w["word:div:short"] and w["word@footer"] == w["word@boiler"] == 0
    assert weights["word@nav"] == 0 and weights["word:in"] > HAND["word:in"] > 0


def test_stretch_is_the_maximum(weights):
    """The scan against all stretches."""
    rng = random.Random(4)
    parts = ["<p>", "</p>", "<div>", "</div>", "<td>", "word ", "some words ", "<a href=x>link</a> ", "<b>", "</b>", "<nav>menu</nav>", "<br>"]
    for _ in range(300):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        sequence, _ = ht.read(page)
        scores = [ht.score(k, weights) * (n if k.startswith("word") else 1) for _, k, n in sequence]
        best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
        got = ht.extract(page, weights)
        assert (got == "") == (best == 0)
        # and the text is that of one of the best stretches
        stretches = [sequence[i:j] for i in range(len(scores)) for j in range(i + 1, len(scores) + 1) if sum(scores[i:j]) == best]
        texts = {"".join("".join(t.text.split()) for t, k, _ in x if t.text and ("@" not in k or ht.score(k, weights) > 0)) for x in stretches}
        assert "".join(got.split()) in texts or not got


def test_odd_rows(spark, weights):
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, None), (2, ""), (3, "   "), (4, "only text"), (5, page), (5, page), (None, page), (6, "<nav>menu</nav>"),
            (7, "<p>" * 3 + "&am &amp &copy &#0; &#xD800;"), (8, "<"), (9, "</"), (10, "<!--"), (11, "<script>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("kind", F.lit("clash")).withColumn("text", F.lit("clash"))
    got = ht.main_text(df, weights)
    assert got.columns == ["page_id", "html", "kind", "text", "n_chars"]
    texts = [r["text"] for r in got.collect()]
    assert texts == ["", "", "", "only text", SAID, SAID, SAID, "", "&am & © � �", "<", "", "", ""]
    assert [r["n_chars"] for r in got.collect()] == [len(t) for t in texts]
    assert ht.main_text(df.limit(0), weights).count() == 0
    assert ht.fit(df.limit(0)) == HAND == ht.fit(df.where("page_id < 5"))


def test_long_and_deep_pages_take_linear_time(weights):
    for page in ("<article><p>" + "word " * 400_000 + "</p></article>", "<div>" * 50_000 + "text" + "</div>" * 50_000,
                 "<p><b>text<br>" * 40_000, "<a href=x>" * 40_000 + "text", "<" * 200_000, "<p title='" * 20_000, "<!--" * 50_000):
        start = time.time()
        ht.extract(page, weights)
        assert time.time() - start < 8
    long = ht.extract("<article>" + "<p>one two</p>" * 100_000 + "</article>", weights)
    assert long == "\n\n".join(["one two"] * 100_000)
