import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from citeloom.functions.metadata import author_names, journal_name, year_from_text
from citeloom.functions.text import html_to_text, record_slug


class _Shown(HTMLParser):
    """Text nodes of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")
        self.parts.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template")
        self.parts.append("\n")

    def handle_comment(self, data):
        self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def shown(page):
    parser = _Shown()
    parser.feed(page)
    parser.close()
    lines = [line.strip() for line in "".join(parser.parts).splitlines()]
    return "\n".join(line for line in lines if line) or None


PAGES = [
    "<p>a <b>b</b> c</p>",
    "plain",
    "<p>  </p>\n<br/>",
    "<!-- c <p>x</p> --><p>y</p><!---->z",
    "<script>if (a < b) { '</p>' } <!-- x </script>after<style>p{}</style>",
    "<!-- <script> -->kept<!-- </script> -->",
    '<a title="x > y" href=z>link</a>',
    "a < b and c > d",
    "&lt;b&gt; &amp;lt; &eacute; &#233; &#xe9; &nope; &copy; &middot; &quot;",
    "<p>one\x0btwo three\x85four</p>",
    "<template><p>hidden</p></template>seen",
    "<p\nclass='k'>x</p >y",
    "<P>UPPER</P><SCRIPT>no</SCRIPT>",
    "x&nbsp;y&nbsp;",
    "",
]


@pytest.mark.parametrize("page", PAGES)
def test_html_matches_a_real_parser(spark, page):
    df = spark.createDataFrame([(page,)], "html string")
    assert html_to_text(df).first()[0] == shown(page)


def test_large_pages_are_read_whole_without_deep_recursion(spark):
    big = "<p>" + "word &amp; " * 200_000 + "</p>" + "<i a='1' b=\"2\" c=3>x</i>" * 20_000 + "<!--" + "y" * 500_000 + "-->end"
    many = "<a " + " ".join(f'k{i}="v>"' for i in range(5_000)) + ">z</a>"
    df = spark.createDataFrame([(big,), (many,)], "html string")
    got = [r[0] for r in html_to_text(df).collect()]
    assert got[0].endswith("x\nend") and got[0].count("&") == 200_000 and got[1] == "z"


def test_hidden_ruby_text_and_unclosed_elements(spark):
    df = spark.createDataFrame(
        [("<ruby>base<rp>(</rp><rt>over</rt><rp>)</rp></ruby>tail",), ("seen<script>x",), ("seen<!-- x",)],
        "html string",
    )
    assert [r[0] for r in html_to_text(df).collect()] == ["base\ntail", "seen", "seen"]


def test_every_named_entity_is_decoded(spark):
    names = [n for n in html.entities.html5 if n.endswith(";")]
    df = spark.createDataFrame([(f"[&{n}]",) for n in names], "html string")
    got = [r[0] for r in html_to_text(df).collect()]
    assert got == [shown(f"[&{n}]") for n in names]


def test_slug(spark):
    rows = [
        ("123", None, None, 0, "0000_123"),
        (None, None, "10.1000/X(1)", 12, "0012_10_1000_x_1"),
        ("", "PMC5", None, 12345, "12345_pmc5"),
        (None, None, None, 3, "0003_record-3"),
        ("///", None, None, 4, "0004_record"),
    ]
    df = spark.createDataFrame(rows, "pmid string, pmcid string, doi string, i long, want string")
    got = df.select(record_slug(F.col("pmid"), F.col("pmcid"), F.col("doi"), F.col("i")), "want")
    assert all(a == b for a, b in got.collect())


def test_year_authors_and_journal(spark):
    years = spark.createDataFrame([("2020 Mar",), ("c. 1875",), ("x1999y2001",), ("",), (None,)], "y string")
    assert [r[0] for r in years.select(year_from_text(F.col("y"))).collect()] == [2020, None, 1999, None, None]
    raw = ['["A",{"name":"B"},{"name":""},5,null]', '{"x":{"name":"C"},"y":"D"}', "7", None]
    df = spark.createDataFrame([(r,) for r in raw], "a string")
    assert [r[0] for r in df.select(author_names(F.col("a"))).collect()] == [
        ["A", "B", '{"name":""}', "5", "None"], ["C", "D"], [], [],
    ]
    j = spark.createDataFrame([('{"name":"J"}', "V"), ("", "V"), (None, "V"), ("P", "V"), ('{"x":1}', "V")], "j string, v string")
    assert [r[0] for r in j.select(journal_name(F.col("j"), F.col("v"))).collect()] == ["J", "V", "V", "P", "V"]
