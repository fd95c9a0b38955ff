"""HTML to text: implied tags, visibility, spacing, lists, tables, broken markup, odd rows."""
import time

import pytest

from cdmspark.llm import html_render as H

CASES = [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<h1>H</h1>t<h2>I<p>x", "H\n\nt\n\nI\n\nx"),
    ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d<li>e</ol><li>f</ul>", "- a\n- b\n  3. c\n  9. d\n  10. e\n- f"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<p>r</blockquote>s", "> q\n\n> r\n\ns"),
    ("<pre>\n a  b\n\n  c</pre>", " a  b\n\n  c"),
    ("x<script>var t='</p>';</script><style>p{}</style><!-- no --><template>n</template>y", "xy"),
    ("<head><title>T</title></head><body>b", "b"),
    ("<p hidden>n</p><p style='color:red; DISPLAY : none'>n</p><p style='display:nonesuch'>y</p>", "y"),
    ("<div style=\"visibility:hidden\">n<p>n</div>y<dialog>n</dialog><dialog open>z</dialog>", "y\nz"),
    ("<details>n<summary>s</summary>n</details><details open>o<summary>t</summary></details>", "s\no\nt"),
    ("&lt;b&gt; &copy; caf&eacute; &#x41;&#66; &amp;amp; a&nbsp;b", "<b> © café AB &amp; a b"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td>Fig</table>z", "Name   Qty\nApple  3\nFig\n\nz"),
    ("<table><tr><td colspan=2>wide cell here<td>c<tr><td>a<td>b<td>d</table>", "wide cell here  c\na  b  d"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td>s<td>3</table>", "r  1\n   2\ns  3"),
    ("<table><caption>C</caption><tbody><tr><td><p>a<p>b<td>c</table>", "C\na  c\nb"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<td>stray</td><tr>row", "strayrow"),
    ("</p>a</div></b>b<b>c<i>d</b>e", "abcde"),
    ("<p>x <b>bold</b> , <i>it</i>alic <a href='a>b'>link</a>", "x bold , italic link"),
    ("<textarea>\n a  b</textarea><input type=hidden value=v><img alt=n>", " a  b"),
    ("a<wbr>b <q>c</q> <select><option>n</select>d", "ab \"c\" n d"),
    ("<!doctype html><html><body><nav><ul><li><a href=x>n</a></ul></nav><p>t<footer>f", "- n\n\nt\n\nf"),
    ("a <", "a <"), ("a < b & c", "a < b & c"), ("x<!-- open", "x"), ("x<b", "x"), ("x<![CDATA[y<z]]>", "xy<z"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_cases(page, want):
    assert H.page_text(page) == want


QUOTES = [
    ("<p class=\"a\"\">one</p><p class=\"b\">two</p>", "one\n\ntwo"),
    ("<p title=it's>one</p><p title='x'>two</p>", "one\n\ntwo"),
    ("<p title=5\">one</p>two", "one\n\ntwo"),
    ("<p 'a>one</p><p \">two</p>", "one\n\ntwo"),
    ("<p>one</p '><p>two</p \">three", "one\n\ntwo\n\nthree"),
    ("<a href=\"x\"'>one</a> <b title='y''>two</b>", "one two"),
    ("<a title = \"1 > 0\" alt= '2 > 1'>one</a>", "one"),
    ("<p title=>one</p><p title= >two</p><p title==\">three</p>", "one\n\ntwo\n\nthree"),
    ("<p \"\"hidden=''>one</p><p a=\"b\"hidden>n</p>", "one"),
]


@pytest.mark.parametrize(("page", "want"), QUOTES)
def test_quotes_open_a_value_only_after_an_equals_sign(page, want):
    assert H.page_text(page) == want


SHOWN = [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"),
    ("<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>y", "xy"),
    ("a<svg><title>n</title><defs><text>n</text></defs><g>n<text x=1>one <tspan>two</tspan></text></g><path/></svg>b", "a one two b"),
    ("<p>a<svg width=1 />b</p>c", "ab\n\nc"),
    ("<p>a<math/>b</p>c", "ab\n\nc"),
    ("<svg><script/><text/><text>one</text></svg>two", "one two"),
    ("<svg><foreignObject><p>one</p></foreignObject></svg>two", "one\n\ntwo"),
    ("<svg><g><p>one</p>two", "one\n\ntwo"),
    ("<svg><desc><p>n</p></desc><text>one</text></svg>two", "one two"),
    ("<head><svg><text>one</text></svg><p>two", "one\n\ntwo"),
]


@pytest.mark.parametrize(("page", "want"), SHOWN)
def test_formulas_and_drawn_text_are_shown(page, want):
    assert H.page_text(page) == want


CONTROLS = [
    ("a<select><option>one<option selected>two<option>n</select>b", "a two b"),
    ("<select><option disabled>n<optgroup label=n disabled><option>n<optgroup label=m><option>one<option>n</select>", "one"),
    ("<select><option selected hidden>pick <b>one</b><option>n</select>.", "pick one ."),
    ("<select><option selected>n<option selected label=L>n</select>", "L"),
    ("<select><option disabled>n</select>a", "a"), ("<select></select>a", "a"), ("<select hidden><option>n</select>a", "a"),
    ("a<select multiple><optgroup label=G><option>one<option hidden>n</optgroup><option>two</select>b", "a\nG\none\ntwo\nb"),
    ("<select size=3><option>one<option>two</select>", "one\ntwo"),
    ("<select><option>one<option>n<input value=v>b", "one v b"),
    ("<select><option>one<select><option>n</select>b", "one nb"),
    ("<datalist><option>n</datalist>a", "a"),
    ("a<input type=submit value='Go  on'><input type=reset><INPUT TYPE=Button value=B><input type=submit>", "a Go on Reset B Submit"),
    ("<input type=submit value=''>a<input type=checkbox value=n><input type=password value=n>b", "a b"),
    ("<input value=v placeholder=n> <input type=search placeholder='find &amp; go'>", "v find & go"),
    ("<textarea placeholder=hint></textarea><textarea placeholder=n>t</textarea>", "hint\n\nt"),
    ("<button>one <i>two</i></button>", "one two"), ("<input type=submit value=n hidden>a", "a"),
    ("<table><tr><td><select><option>x</select><td>y</table>", "x  y"),
]


@pytest.mark.parametrize(("page", "want"), CONTROLS)
def test_labels_of_controls_are_shown(page, want):
    assert H.page_text(page) == want


def test_wide_cells_lose_no_text():
    long = "w" * 500
    text = H.page_text(f"<table><tr><td>{long}<td>a<tr><td>b<td>c</table>")
    assert text == f"{long}  a\nb" + " " * (H.ALIGN + 1) + "c"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<p><b>" * 30_000 + "x" + "</i></p>" * 30_000, "<a 'x" * 30_000,
                                  "<" * 200_000, "<table><tr><td rowspan=9999 colspan=9999>a" * 200, "&" * 200_000,
                                  "<ul><li>" * 3000 + "x", "word " * 300_000, "<!--" * 100_000,
                                  "<select>" * 50_000 + "<option>x" * 50_000, "<select><optgroup>" * 30_000, "<select><div>" * 50_000])
def test_hostile_pages_end_in_time(page):
    start = time.time()
    H.page_text(page)
    assert time.time() - start < 20


def test_text_of_real_pages_is_whole(spark):
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r.page_id: r.text for r in H.page_texts(pages).collect()}
    for r in pages.collect():
        body = r.html[r.html.index("<body>"):]
        seen = re.sub(r"<!--.*?-->|<[^>]*>", " ", body)
        import html
        assert re.findall(r"\S+", html.unescape(seen)) == [w for w in out[r.page_id].split() if w != "-"] or "- " in seen


def test_odd_rows(spark):
    rows = [(1, "u", None, 5), (1, "u", None, 5), (None, None, "<p>a", 6), (2, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    assert sorted(((r.page_id, r.text, r.n_lines) for r in H.page_texts(df).collect()), key=str) == sorted(
        [(1, "", 0), (1, "", 0), (None, "a", 1), (2, "", 0)], key=str)
    assert H.page_texts(df.filter("false")).count() == 0
