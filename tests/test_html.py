"""Links, attributes, title and text of pages as column expressions."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tessera.functions import html as H

PAGES = [
    "<title>A &amp; B</title><p>one<b>two</b></p>",
    "<html><head><TITLE lang='x'> T &#233;&#xE9; </TITLE><style>p{}</style></head><body>\n <p>5 &lt; 6 &amp;amp; 7 &unknown; a&b</p> x<br/>y</body>",
    "<body><script>document.write('<p>no</p>')</script><!-- <p>no --> yes <a title='a > b' href=x>link</a></body>",
    "plain text only, 3 < 4 and 5 > 2",
    "<p title=don't>it's</p><p data='\"'>q</p>",
    "",
    None,
]


def col(spark, fn, values=PAGES):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, html string")
    return [r.x for r in df.select("k", fn("html").alias("x")).orderBy("k").collect()]


def test_title(spark):
    assert col(spark, H.title) == ["A & B", "T éé", "", "", "", "", None]


def test_visible_text(spark):
    got = col(spark, H.visible_text)
    assert got == ["A & B one two", "5 < 6 &amp; 7 &unknown; a&b x y", "yes link", "plain text only, 3 < 4 and 5 > 2", "it's q", "", None]


def test_unescape(spark):
    texts = ["&eacute;&Eacute;&copy;", "&#0;&#1114112;&#xD800;", "&apos;&quot;&nbsp;|", "no reference & so on;", "&amp;lt;"]
    assert col(spark, H.unescape, texts) == ["éÉ©", "&#0;&#1114112;&#xD800;", "'\" |", "no reference & so on;", "&lt;"]


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found.append([(k, v or "") for k, v in attrs])


LINKS = [
    '<a href="/x">1</a><A CLASS="b c" HREF=\'/y?a=1&amp;b=2\'>2</A><a\nid=k href = /z >3</a>',
    "<a title='href=\"/no\"' href=/yes class=\"\">4</a><abbr href='/no'>5</abbr><a>6</a><a href>7</a>",
    "<a data-x='>' target=\"_blank\" href=\"/q\" href=\"/second\">8</a>",
]


def test_attributes_equal_a_parser(spark):
    got = col(spark, H.anchors, LINKS)
    for page, found in zip(LINKS, got, strict=True):
        parser = Anchors()
        parser.feed(page)
        assert [[tuple(a) for a in attrs] for attrs in found if attrs] == [a for a in parser.found if a]


@pytest.mark.parametrize(
    "kw,want",
    [
        ({"pattern": "^/"}, ["/q", "/x", "/y?a=1&b=2", "/yes", "/z"]),
        ({"pattern": "^/", "css_class": "c"}, ["/y?a=1&b=2"]),
        ({"pattern": "^/", "target": "_blank"}, ["/q"]),
        ({"pattern": "y", "css_class": "b"}, ["/y?a=1&b=2"]),
    ],
)
def test_links(spark, kw, want):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*LINKS, None, ""])], "k int, html string")
    assert sorted(r.link for r in H.extract_links(df, "html", **kw).collect()) == want


def test_a_long_tag_needs_no_stack(spark):
    page = "<a " + "data-x='1' " * 50_000 + "href='/far'>x</a>" + "<!-- " + "y " * 100_000
    df = spark.createDataFrame([(page,)], "html string")
    assert [r.link for r in H.extract_links(df, "html", "far").collect()] == ["/far"]
    assert df.select(F.length(H.visible_text("html")).alias("n")).first().n == 1
