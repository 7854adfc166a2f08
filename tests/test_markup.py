"""Visible text, against a small parser walk and on awkward pages."""

from __future__ import annotations

from html.parser import HTMLParser

from gleanery.functions.markup import visible_text

HIDDEN = {"script", "style", "noscript", "header", "footer", "nav", "template"}


class Walk(HTMLParser):
    """Text nodes outside hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in HIDDEN

    def handle_endtag(self, tag):
        self.depth -= tag in HIDDEN and self.depth > 0

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def walked(html: str) -> str:
    walk = Walk()
    walk.feed(html)
    walk.close()
    return " ".join(" ".join(walk.parts).split())


def test_pages_like_a_parser_walk(spark):
    from pyspark.sql import functions as F

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    whole = pages.filter("html LIKE '%</html>'")
    rows = whole.select("html", visible_text(F.col("html")).alias("text")).collect()
    assert len(rows) > 200
    for row in rows:
        assert row.text == walked(row.html)


def test_nested_hidden_elements(evaluate):
    pages = [
        "a<nav>1<nav>2</nav>3</nav>b",
        "a<NAV class='x'><header>1</header><nav>2<nav>3</nav></nav>4</nav >b<footer>5</footer>c",
        "<header><nav>x</nav></header>shown",
        "a<nav><!-- </nav> <nav> -->hidden</nav>b",
        "<nav>" * 12 + "x" + "</nav>" * 12 + "y",
    ]
    assert evaluate(visible_text, pages) == ["a b", "a b c", "shown", "a b", "y"]


def test_tags_comments_and_raw_text(evaluate):
    pages = [
        "a<br/>b<img alt='1 > 0' src=x>c",
        "a <!-- <b>no</b> --> b <!DOCTYPE html> c",
        "<script>if (a < b) { '</p>' }</script>x<style>p{}</style>y",
        "<script src='x'/>kept",
        "a<nav-bar>kept</nav-bar><headers>too</headers>",
        "1 < 2 and 3 > 2",
        "cut <p class='x",
        "open <script>var x = 1;",
        "<title>T</title><body>B",
        "<template>t</template><ruby>x<rt>y</rt></ruby>",
    ]
    assert evaluate(visible_text, pages) == [
        "a b c",
        "a b c",
        "x y",
        "kept",
        "a kept too",
        "1 < 2 and 3 > 2",
        "cut",
        "open",
        "T B",
        "x",
    ]


def test_malformed_pages(evaluate):
    pages = [
        "<p title=don't>Hello</p><p>it's fine</p><p>end</p>",
        "<p data-x=5' >A</p><p>B's</p>C",
        "<a href='x>y' title=\"1 > 0\">t</a> <b c = 'd>e'>u</b>",
        "<div><nav><a>m</a></div><p>body text</p>",
        "<div><header>h<footer>f</div>shown</header> too",
        "<nav>rest of the page is hidden<p>all of it",
        "x<nav><br><img src=a>m</nav>y<nav/>z",
        "</nav>a</div>b",
        "<nav><!-- </nav> --><script>'</nav>'</script>m</nav>kept<header><header>1</header>2</header>",
    ]
    assert evaluate(visible_text, pages) == [
        "Hello it's fine end",
        "A B's C",
        "t u",
        "body text",
        "shown too",
        "",
        "x y z",
        "a b",
        "kept",
    ]


def test_many_nested_elements_take_linear_time(evaluate):
    import time

    def page(n):
        return "<header>a<header>b</header>c</header>x " * n

    evaluate(visible_text, [page(50)])
    seconds = []
    for n in (1000, 4000):
        start = time.monotonic()
        assert evaluate(visible_text, [page(n)]) == [" ".join(["x"] * n)]
        seconds.append(time.monotonic() - start)
    assert seconds[1] < 8 * seconds[0] + 1


def test_entities(evaluate):
    pages = [
        "&lt;b&gt; &amp;lt; &quot;x&quot;",
        "&#8364; &#x20AC; &euro; &eacute; &apos;",
        "&unknown; &amp &am &#xD800; AT&T &#38;amp;",
        "a&nbsp;&nbsp;b",
        "&amp;euro; &rarr;",
        "&#00000000000065; &#x0000000000000041; &#99999999999999;",
    ]
    assert evaluate(visible_text, pages) == [
        '<b> &lt; "x"',
        "€ € € é '",
        "&unknown; &amp &am &#xD800; AT&T &amp;",
        "a b",
        "&euro; →",
        "A A &#99999999999999;",
    ]


def test_null_and_long_pages(evaluate):
    long = "<p>" + "<b title=\"q\">word</b> " * 60_000 + "</p>"
    assert evaluate(visible_text, [None, "", long]) == ["", "", " ".join(["word"] * 60_000)]
