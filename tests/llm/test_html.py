import time

import pytest

from feedloom.llm import html


def text(page):
    return html.render(html.parse(page))


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("a<b>b</b>c <i> d </i>e", "abc d e"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"),
    ("<title>T</title><style>x{}</style><script>if (a<b) '</p>'</script>seen", "seen"),
    ("x<br>y<br><br>z", "x\ny\n\nz"), ("a\n   b\t c", "a b c"),
    ("<p hidden>no</p><p style='DISPLAY : none'>no</p>yes", "yes"),
    ("<p style='visibility:hidden'>no<b style='visibility:visible'>yes</b></p>", "yes"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b<li value=20>c<li>d</ol>", "9. a\n10. b\n20. c\n21. d"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>12</table>", "Name   Qty\napple  3\nfig    12"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>dddd<td>e<td>f</table>", "ab       c\ndddd  e  f"),
    ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x  1\n   2"),
    ("<table><caption>C</caption><tr><td>a<br>b<td>c</table>", "C\na  c\nb"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    ("<table>stray<tr><td>a</table>", "stray\na"), ("<td>loose<td>cells", "loose\ncells"),
    ("<pre>\n a\n   b\n</pre>c", " a\n   b\n\nc"), ("<textarea> a\n b</textarea>", " a\n b"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("a<!-- <p>no</p> -->b<!-->c", "abc"), ("a < b <3 <> </> x", "a < b <3 <> x"),
    ("<a title='x>y' href=\"p>q\">z</a>", "z"), ("<a title='never closed>z", "z"), ("<p", ""), ("x<!-- open", "x"),
    ("</p>a</div>b</br>c", "ab\nc"), ("<b>a<p>b</b>c</p>d", "a\n\nbc\n\nd"), ("<script>never closed", ""),
    ("<html><body>a</body></html>b", "ab"), ("<noscript>no</noscript><template>no</template>y", "y"),
    ("<button>Go</button><input type=submit value=Send><input value=no>", "GoSend"),
    ("<select><option>a<option>b</select>", "a\nb"), ("&copy; &#x41;&nbsp;B", "© A B"),
])
def test_layout(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<table><tr><td style='visibility:hidden'>no<td>yes<tr><td>a<td>b</table>", "   yes\na  b"),
    ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>", "  yes"),
    ("<table><tr style='visibility:hidden'><td>no<td><b style='visibility: visible'>yes</b><tr><td>a<td>b</table>",
     "   yes\na  b"),
    ("<table><tbody style='visibility:hidden'>no<tr><td>no<tbody><tr><td>a</table>", "a"),
    ("<table style='visibility:hidden'><caption>no</caption><tbody style='visibility:visible'>yes<tr><td>a</table>", "yes\na"),
    ("<table><tr><td rowspan=2>x<td>1<tr style='visibility:collapse'><td>no<tr><td>y<td>2</table>", "x  1\ny  2"),
    ("<table><tbody style='visibility:collapse'><tr><td style='visibility:visible'>no</table>a", "a"),
    ("<table><tr><td><table style='visibility:hidden'><tr><td>no</table><td>yes</table>", "  yes"),
    ("<p style='backface-visibility:hidden'>yes</p>", "yes"), ("<p style='display:none;display:block'>yes</p>", "yes"),
    ("<p style='visibility:visible; visibility:hidden'>no</p>y", "y"),
])
def test_visibility(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<svg><text>a</text><text x=1>b<tspan>c</tspan></text></svg>d", "a bc d"),
    ("<svg>no<g>no<rect/><text>a</text></g></svg>", "a"), ("<svg><title>no</title><desc/><text>a</text></svg>", "a"),
    ("<svg><defs><text>no</text></defs><linearGradient id=g /><text>a</text></svg>", "a"),
    ("<svg><title/><text>a</text></svg>b", "a b"), ("<svg><style>no</style><script>no</script></svg>a", "a"),
    ("<svg><g visibility=hidden><text>no</text><text visibility=visible>a</text></g></svg>", "a"),
    ("<svg><g display=none><text>no</text></g><text style='visibility:hidden'>no</text></svg>a", "a"),
    ("<svg><foreignObject><p>a<p>b</foreignObject></svg>c", "a\n\nb\n\nc"), ("<svg style='display:none'><text>no</text></svg>a", "a"),
    ("<svg><circle r=1><p>a</p>b", "a\n\nb"), ("<svg/>a", "a"),
    ("x<math><mi>a</mi><mo>+</mo><mn>1</mn></math>y", "xa+1y"),
    ("<math><semantics><mi>a</mi><annotation encoding=t>no</annotation><annotation-xml><p>no</p></annotation-xml>"
     "</semantics></math>b", "ab"),
    ("<math><mtext>a <b>b</b></mtext><mspace/><mi>c</mi></math>", "a bc"),
])
def test_drawings_and_formulas(page, want):
    assert text(page) == want


def test_cells_begin_at_their_columns():
    long = "w" * 100
    page = f"<table><tr><td>a<td>{long}<td>c<tr><td>{long} {long}<td>b<td>cc<tr><td>aa<td>bb<td>ccc</table>"
    lines = text(page).split("\n")
    begins = {w: x.index(w) for x in lines for w in x.split() if len(w) < 9}
    assert begins["a"] == begins["aa"] == 0 and begins["b"] == begins["bb"] == html.COLUMN + 2
    assert begins["c"] == begins["cc"] == begins["ccc"] == 2 * (html.COLUMN + 2)
    assert lines[0] == "a".ljust(html.COLUMN + 2) + long and lines[2] == f"{long} {long}"


def test_nested_tables_keep_their_columns():
    page = "a<td>b</table>"
    for _ in range(12):
        page = f"<table><tr><td>{page}<td>x</table>" if page.startswith("<table>") else f"<table><tr><td>{page}"
    assert text(page) == "a  b" + "  x" * 11


@pytest.mark.parametrize("page", [
    "<svg>" * 20_000 + "<p>x", "<svg>" + "<g>" * 20_000 + "<text>x", "<svg>" + "<text>x</text>" * 20_000,
    "<math>" + "<mi>" * 20_000 + "x", "<svg><foreignObject>" * 5000 + "x", "<table><tr><td>x<td>" * 300 + "x",
    "<div>" * 20_000 + "x", "<ul><li>" * 3000 + "x", "<table><tr><td>" * 300 + "x", "<a b=\"" * 20_000, "<" * 50_000,
    "<b><p>" * 5000 + "x", "<!--" * 20_000, "&" * 50_000, "<p>" * 20_000 + "x", "<td>" * 20_000,
    "<table>" + "<tr><td colspan=1000>a" * 2000 + "</table>", "<table>" + "<tr><td rowspan=65534>a" * 500 + "</table>",
    "<table><tr><td>" + "w" * 100_000 + "<td>b" + "<tr><td>a<td>b" * 2000 + "</table>",
])
def test_odd_pages_take_linear_time_and_space(page):
    t = time.process_time()
    out = text(page)
    assert time.process_time() - t < 8 and len(out) < 60 * len(page) + 100


def test_no_visible_text_is_lost():
    words = [f"w{i}" for i in range(300)]
    tags = ["p", "div", "li", "td", "tr", "table", "ul", "b", "span", "h2", "blockquote", "pre", "dd", "ol", "a", "section"]
    import random
    for seed in range(60):
        rng = random.Random(seed)
        page = "".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", " ", ""]) + f" {w} " for w in words)
        got = text(page).split()
        assert sorted(x for x in got if x.startswith("w")) == sorted(words), seed


def test_rows(spark):
    rows = [(1, "<title>A  B</title><p>x"), (2, None), (3, ""), (None, "<p>y<p>z"), (1, "<title>A  B</title><p>x")]
    df = spark.createDataFrame([(i, h, "t", 5) for i, h in rows], "page_id long, html string, title string, id int")
    got = [tuple(r) for r in html.extract_text(df.repartition(2), "page_id", "html").collect()]
    assert sorted(got, key=str) == sorted([(1, "A B", "x", 1), (2, "", "", 0), (3, "", "", 0), (None, "", "y\n\nz", 3),
                                           (1, "A B", "x", 1)], key=str)
    assert html.extract_text(df.limit(0), "page_id", "html").count() == 0
