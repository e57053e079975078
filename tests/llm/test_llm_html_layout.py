from __future__ import annotations

import time

import pytest

from tillgrain.llm import html_layout
from tillgrain.llm.html_layout import visible_text

CASES = [
    ("plain text", "plain text"),
    ("<p>One <b>two</b>\n three<p>Next", "One two three\n\nNext"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<h1>T</h1>x", "T\n\nx"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1</table>", "Name       N\nlong name  1"),
    ("<table><tr><td rowspan=2>r<td>a<tr><td>b</table>", "r  a\n   b"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>", "ab     c\n1   2  3"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<pre>  a\n   b</pre>", "  a\n   b"),
    ("<blockquote>q</blockquote>", "  q"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("<head><title>no</title><style>p{}</style></head><body>yes", "yes"),
    ("<script>var t='</p>';</script>a<!-- b -->c<!doctype html>", "ac"),
    ("<div hidden>a</div><p style='display : none'>b</p>c", "c"),
    ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span></div>", "b"),
    ("<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>", "s\ns\nyes"),
    ("&lt;b&gt; &amp;&nbsp;x &copy; &#233;", "<b> &\xa0x © é"),
    ("1 < 2 <3 a</b></p>b", "1 < 2 <3 a\n\nb"),
    ("<a title='x > y' href=\"z\">t</a>", "t"),
    ("<p>a<textarea> b\n c</textarea>", "a b\n c"),
    ("<noscript>n</noscript><template>t</template><dialog>d</dialog>v", "v"),
    ("<P>Upper<P>Case", "Upper\n\nCase"),
    ("", ""),
]


@pytest.mark.parametrize(("source", "want"), CASES)
def test_layout(source, want):
    assert visible_text(source) == want


FOREIGN = [
    ("a<svg><title>t</title><desc>d</desc><text>North</text><text x=1>So<tspan>uth</tspan></text></svg>b", "a\nNorth\nSouth\nb"),
    ("<svg><defs/><path d='M0'/><text>seen</text></svg>", "seen"),
    ("<svg><title/><text>seen</text></svg>", "seen"),
    ("<svg><defs><text>no</text></defs><metadata>m</metadata><text display=none>n</text></svg>v", "v"),
    ("<svg><foreignObject><p>html</p></foreignObject><style>s{}</style></svg>", "html"),
    ("<p>is <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2 tex</annotation></math> so", "is x=2 so"),
    ("<xmp><b>a</b> &amp;\n  c</xmp>d", "<b>a</b> &amp;\n  c\n\nd"),
    ("<desc>own</desc> <text>t</text>", "own t"),
]


@pytest.mark.parametrize(("source", "want"), FOREIGN)
def test_text_of_drawings_formulas_and_xmp(source, want):
    assert visible_text(source) == want


@pytest.mark.parametrize(
    "piece",
    ["<p", "<a b='", '<a href="x>', "<div>", "<table><tr><td>", "<", "<li>", "</b>", "<p>a", "<!--", "<ul><li>"],
)
def test_long_broken_pages_take_linear_time(piece):
    began = time.process_time()
    visible_text(piece * 10_000)
    assert time.process_time() - began < 20


def test_pages_of_the_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = html_layout.extract(pages).join(pages, "page_id").collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert "<script" not in r["text"] and "track(" not in r["text"] and r["text"].strip()


def test_edge_rows(spark):
    schema = "page_id bigint, html string"
    rows = [(1, None), (2, ""), (None, "<p>x"), (3, "<b>y"), (3, "<b>y")]
    pages = spark.createDataFrame(rows, schema).selectExpr("*", "1 as text")
    got = sorted((str(r["page_id"]), r["text"]) for r in html_layout.extract(pages).collect() if r["text"] is not None)
    assert got == [("2", ""), ("3", "y"), ("3", "y"), ("None", "x")]
    assert html_layout.extract(pages).where("text is null").count() == 1
    assert html_layout.extract(spark.createDataFrame([], schema)).count() == 0
