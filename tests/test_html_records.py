"""H1-H5 and F1-F5 hand cases."""

from pyspark.sql import functions as F

from trawl.functions.html import extract_page
from trawl.operators.pages import page_rows
from trawl.operators.records import html_records, rejected_records


def test_nested_and_autoclose_paragraphs():
    html = "<p><b>One<br><p>Two</p><p>Three</p>"
    assert extract_page(html, "nested")[2] == ["OneTwoThree", "Two", "Three"]
    assert extract_page(html, "autoclose")[2] == ["One", "Two", "Three"]


def test_headers_first_and_header_inside_p():
    title, heads, paras = extract_page("<p>x<h2>in</h2>y</p><h1>top</h1>")
    assert heads == ["in", "top"] and paras == ["xiny"]


def test_escaped_tag_becomes_tag_and_entities():
    _, _, paras = extract_page("<p>a &lt;p&gt; b</p>", "nested")
    assert paras == ["a  b", " b"]
    _, _, paras = extract_page("<p>x&nbsp;y &amp;amp; ＡＢ</p>")
    assert paras == ["x y & AB"]  # NFKC: nbsp -> space, full-width -> ASCII; one unescape before parsing


def test_blank_text_nodes_and_cdata():
    page = "<h1> \t\t<a>Foo</a> \t<a>Bar baz</a></h1><p>a<b> \n\t </b>c<pre>\t\t</pre></p><p>x<![CDATA[ y < z]]></p>"
    _, heads, paras = extract_page(page)
    assert heads == [" Foo Bar baz"] and paras == ["a\nc\t\t", "x y < z"]


def test_title_rules():
    assert extract_page("<title>Plain</title>")[0] == "Plain"
    assert extract_page("<title><b>Bold</b></title>")[0] == "Bold"
    assert extract_page("<title>a<b>c</b></title>")[0] == ""
    assert extract_page("<p>no title</p>")[0] == ""


def test_script_style_comment_excluded():
    _, _, paras = extract_page('<p>a<script>var t="</p>";</script>b<!-- c --><style>p{}</style></p>')
    assert paras == ["ab"]


def test_page_rows_text(spark):
    df = spark.createDataFrame(
        [("k1", "<title>My Page</title><h1>Head line</h1><p>First para. (skip) ok</p>"),
         ("k2", "<p>!!</p>")], "key string, body string")
    got = {r.key: (r.title, r.headers, r.text) for r in page_rows(df).collect()}
    assert got == {"k1": ("My Page.", "Head line.", "My Page. Head line. First para. ok.")}


def _payload(lines):
    return "\n".join(lines)


def test_records_hand_cases(spark):
    good = ["WARC-Type: response", "x", "WARC-TREC-ID: key-1", *(["h"] * 6), "", "HTTP/1.1 200 OK",
            "CONTENT-TYPE: TEXT/HTML", "", "<p>body</p>", "line two"]
    cases = {
        "good": _payload(good),
        "empty": "",
        "two_lines": "a\nb",
        "no_colon": _payload(good[:2] + ["WARC-TREC-ID-without-sep"] + good[3:]),
        "no_blank": _payload(good[:11] + ["Content-Type: text/html", "<p>x</p>"]),
        "blank_at_10": _payload(good[:10] + ["", "Content-Type: text/html", "", "<p>y</p>"]),
        "not_html": _payload(good[:11] + ["Content-Type: image/png", "", "x"]),
    }
    df = spark.createDataFrame(list(cases.items()), "name string, payload string")
    kept = {r.name: (r.key, r.body) for r in html_records(df, keep=["name"]).collect()}
    assert kept["good"] == ("key-1", "<p>body</p> line two")
    assert kept["no_blank"] == ("key-1", "")          # no blank line: empty body, still HTML
    assert "blank_at_10" not in kept                   # header part ends at once: no content type
    assert set(kept) == {"good", "no_blank"}
    rej = {r.name: r.reason for r in rejected_records(df).collect()}
    assert rej["empty"] == "empty" and rej["two_lines"] == "no_key" and rej["not_html"] == "not_html"
    assert rej["no_colon"] == "no_key"
