import html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from signalloom.functions.pages import page_texts, unescaped


class Page(HTMLParser):
    """Brute force: the same rules over an event parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.og, self.title, self.seen, self.all, self.inside, self.open, self.now, self.quiet, self.in_title, self.found = None, "", False, [], [], [], None, False, False, False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and a.get("property") == "og:title" and self.og is None:
            self.og = a.get("content") or ""
        if tag == "title":
            self.in_title, self.seen = not self.seen, True
        if tag in ("script", "style"):
            self.quiet = True
        elif tag == "p":
            self.stop()
            self.now = [[]]
        elif tag not in "area base br col embed hr img input link meta source track wbr".split():
            article = tag == "article" or "article" in (a.get("class") or "").lower()
            self.found |= article
            self.open.append((tag, article))
        if tag != "p" and self.now is not None:
            self.now.append([])

    def handle_startendtag(self, tag, attrs):
        if self.now is not None:
            self.now.append([])

    def handle_comment(self, data):
        self.handle_startendtag("", [])

    def stop(self):
        if self.now is not None:
            text = " ".join(t for t in ("".join(x).strip() for x in self.now) if t)
            self.all.append(text)
            if any(x for _, x in self.open):
                self.inside.append(text)
            self.now = None

    def handle_endtag(self, tag):
        self.quiet = self.in_title = False
        if tag in ("p", "article", "div", "section", "body", "html"):
            self.stop()
        elif self.now is not None:
            self.now.append([])
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif self.now is not None and not self.quiet:
            self.now[-1].append(data)


def brute(text, most=30):
    if text is None:
        return None
    page = Page()
    page.feed(text)
    page.close()
    page.stop()
    title = page.title if page.og is None else page.og
    return title.strip(), " ".join((page.inside if page.found else page.all)[:most])


def run(spark, pages, **given):
    rows = spark.createDataFrame([(p,) for p in pages], "h string").select("h", page_texts(F.col("h"), **given).alias("t")).collect()
    return {r.h: None if r.t is None else tuple(r.t) for r in rows}


PAGES = {
    "": ("", ""),
    "<title> T &amp; &lt;x&gt; </title><p>a</p><p>b</p>": ("T & <x>", "a b"),
    '<meta property="og:title" content="Best &quot;one&quot;"><title>No</title><article><p>One <b>bold</b>, two<p>Three</article><p>out</p>': ('Best "one"', "One bold , two Three"),
    "<meta content='x y' property=og:title /><p>q": ("x y", "q"),
    '<div class="Main-Article x"><div><p>in</p></div><p>still</p></div><p>out</p>': ("", "in still"),
    "<article></article><p>outside</p>": ("", ""),
    "<p>a < b &#38; c &nbsp;</p><!-- <p>no</p> --><script>var x = '<p>no</p>';</script><style>p{}</style><p>d</p><p></p><p>e": ("", "a < b & c d  e"),
    '<p title="a > b">quoted</p><p>unfinished <a href="x': ("", "quoted unfinished"),
    "<ul><li>x<li>y</ul><section><article><p>deep</section><p>left": ("", "deep"),
    "<P>UPPER</P><TITLE>Big</TITLE><title>second</title>": ("Big", "UPPER"),
    "<p>one\n two\t three </p>": ("", "one\n two\t three"),
    "<script>never closed <p>x</p>": ("", ""),
}


@pytest.mark.parametrize("most", [30, 2])
def test_pages(spark, most):
    got = run(spark, [*PAGES, None], most=most)
    assert got[None] is None
    if most == 30:
        assert {h: got[h] for h in PAGES} == PAGES
    else:
        assert got["<title> T &amp; &lt;x&gt; </title><p>a</p><p>b</p>"][1] == "a b" and got["<p>a < b &#38; c &nbsp;</p><!-- <p>no</p> --><script>var x = '<p>no</p>';</script><style>p{}</style><p>d</p><p></p><p>e"][1] == "a < b & c d"


def test_random_pages_equal_an_event_parser(spark):
    draw = random.Random(4)
    bits = ["<p>", "</p>", "<p class='x'>", "<div>", "</div>", "<article>", "</article>", '<div class="article-body">', "<section>", "</section>", "<b>", "</b>", "<br>", "<br/>", "<li>", "text ", "more &amp; more", " &copy;&eacute; ", "ü ", "\n", "<!-- c <p> -->", "<script>if (a<b) '<p>'</script>", "<span class=ARTICLE>", "</span>", "<h1>", "</h1>", "</body>"]
    pages = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(600)]
    got = run(spark, pages)
    assert [(h, got[h], brute(h)) for h in pages if got[h] != brute(h)][:2] == []


def test_references(spark):
    draw = random.Random(5)
    texts = ["&amp;", "&ampx", "&notit;", "&notin;", "&nope;", "&", "&&", "&#", "&#x", "&#65;", "&#65", "&#x41;&#X42", "&#0;", "&#128;&#x9f;&#13;&#x81;", "&#xD800;&#x110000;&#99999999999;", "&#x1F600;", "&#1;&#xFFFE;", "&NotEqualTilde;", "&lt&gt", "a & b", "&frac12", "&CounterClockwiseContourIntegral;", "&#38;amp;", "& amp;", "&eacute&Eacute;x"]
    texts += ["".join(draw.choice(["&", "amp", ";", "#", "x", "12", "lt", "no", "t", " ", "é"]) for _ in range(12)) for _ in range(600)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescaped(F.col("t")).alias("u")).collect()
    assert [(r.t, r.u, html.unescape(r.t)) for r in rows if r.u != html.unescape(r.t)][:3] == []


def test_large_and_deep_pages(spark):
    deep = "<div>" * 400 + "<p>x" + "</div>" * 400 + "<p>y"
    long = "<p>" + "word <i>more</i> &amp; " * 20_000 + "</p>" + "<" * 2000
    quotes = '<p a="' + "x" * 300_000 + '">z</p>'
    got = run(spark, [deep, long, quotes])
    assert got[deep] == brute(deep) and got[quotes] == ("", "z") and got[long][1].startswith("word more & word more &") and len(got[long][1]) > 200_000
