"""Main texts, archives and address templates of web pages."""

import pytest

from gridweave.llm.html_extract import Page, main_texts
from gridweave.llm.url_templates import templates, url_verdicts
from gridweave.llm.warc import archive_digest, pages_of, records_of, write_archive

SCHEMA = "page_id long, url string, html string"

ARTICLE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>x</a></nav>"
    '<div class="cookie-notice"><p>We use cookies, many of them.</p></div>'
    "<article class=post-12><h1>Title</h1><p>One &amp; two<br>three &lt;b&gt;<p>Four\n\t five&nbsp;six"
    "<script>var x='</p><p>no';</script><form><input><p>form</p></form></article>"
    '<section id="comments"><p>' + "A reader says much more than the article does. " * 20 + "</p></section>"
    "<aside>side</aside><footer>foot</footer></body></html>"
)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (ARTICLE, "Title\nOne & two three <b>\nFour five six"),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b</div>c", "a\nb\nc"),
        ("<div>a<ul><li>b<li>c</ul>d</div>", "a\nb\nc\nd"),
        ("<p>cut &am<foo", "cut &am"),
        ("<!-- <p>no</p> --><p>yes", "yes"),
        ("<p title='a > b'>x</p>", "x"),
        ("a < b", "a < b"),
        ("<script>never ends", ""),
    ],
)
def test_main_text(source, text):
    page = Page(source)
    assert page.main_text(page.best()) == text


def test_hostile_markup_takes_linear_time():
    for part in ("<a", "<a b='", "<p>", "</p", "<div>", "<!--", "&amp"):
        Page(part * 20_000).main_text(None)


@pytest.mark.parametrize("quote", ['"', "'"])
def test_long_attribute_values_are_no_text(quote):
    """Markup inside a quoted value is neither text nor a tag nor an attribute of its own."""
    inner = ("<p>prop</p> a > b, class=ad <div id=ads>" * 300)[:10_000]
    source = f"<body><div data-props={quote}{inner}{quote} class=post><p>yes</p></div><div title={quote}"
    source += f"{inner}{quote} class=ad><p>no no no no</p></div></body>"
    page = Page(source)
    assert page.main_text(page.best()) == "yes"
    assert page.paths[2].endswith("/div.post")


TEXT = "<p>" + "long text of the page " * 9 + "</p>"


@pytest.mark.parametrize(
    "wrapper", ["id=content-sidebar-wrap", "class='page header-fixed'", "class=layout-right-sidebar"]
)
@pytest.mark.parametrize("inner", ["<div class=post>{}</div>", "<article>{}</article>"])
def test_wrappers_whose_name_says_sidebar_are_kept(wrapper, inner):
    own = inner.format("<div class=entry-header><h1>Title</h1></div>" + TEXT)
    extra = "<div class=sidebar><p>side</p></div><div id=comments><article><p>" + "me too " * 99
    page = Page(f"<body><div {wrapper}>{own}{extra}</p></article></div></div><div class=ad><p>buy</p></div></body>")
    assert page.main_text(page.best()).split("\n") == ["Title", TEXT[3:-4].strip()]


def test_title_and_lead_beside_the_body():
    source = "<body><div class=post><h1>Title</h1><p>Lead.</p><div class=body>" + TEXT * 9 + "</div>"
    source += "<div class=tags><a href=x>tag</a></div></div><div class=other><h2>More</h2><p>other</p></div></body>"
    page = Page(source)
    assert page.best().endswith("/div.body")
    assert page.main_text(page.best()).split("\n") == ["Title", "Lead."] + [TEXT[3:-4].strip()] * 9


def test_nested_marks_and_bodies_are_read_in_reasonable_time():
    for part in ("<div class=sidebar><p>x", "<div><p>text of it", "<article class=ad><div class=ad><p>x</p>"):
        page = Page(part * 1500)
        page.main_text(page.best())


def test_unclosed_values_take_linear_time():
    for part in ("<a b=\"<a b='", "<a b=\"<a\" c='<b' ", "<a b=\"<a b=\" ", "<a =\"'", "<a b=' "):
        Page("<p>x</p>" + part * 20_000).main_text(None)
    page = Page("<p title=\"x>yes</p><p>it's</p>")
    assert page.main_text(None) == "yes\nit's"


def test_the_host_decides(spark):
    """A page whose own best container is another one follows the pages of its host."""
    usual = "<body><div class=a><p>{}</p></div><div class=b><p>{}</p></div></body>"
    rows = [(i, "http://h.x/1", usual.format("long text of the page " * 9, "short")) for i in range(5)]
    rows.append((9, "http://H.x/2", usual.format("short", "long text of the page " * 9)))
    rows += [(10, "http://other/", usual.format("short", "long " * 99)), (11, None, None), (12, "x", "")]
    rows.append((10, "http://other/", usual.format("short", "long " * 99)))
    got = main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and texts[9] == "short" and texts[10].startswith("long")
    assert texts[11] == "" and all(r.n_chars == len(r.text) for r in got)
    assert main_texts(spark.createDataFrame([], SCHEMA)).collect() == []


ROWS = [
    (1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://b/\nx", ""),
    (5, "http://c/", "other"), (5, "http://c/", "other"), (None, "http://d/", "alone"),
]


def test_archive(spark):
    got = sorted((tuple(r) for r in archive_digest(spark.createDataFrame(ROWS, SCHEMA)).collect()), key=str)
    kinds = sorted(((r[0], r[1], r[3], r[4]) for r in got), key=str)
    assert kinds == [
        (1, 9, "revisit", 2), (2, 9, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None),
        (5, 5, "response", None), (5, 5, "response", None), (None, 5, "response", None),
    ]
    assert {r[2] for r in got if r[1] == 0} == {"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}
    assert archive_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_records_and_round_trip(spark, tmp_path):
    write_archive(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"), least=1)
    back = sorted(((r.page_id, r.url, r.html) for r in pages_of(spark, str(tmp_path / "w")).collect()), key=str)
    want = [(i, u.replace("\n", " ") if u else u, h or "") for i, u, h in ROWS]
    assert back == sorted(want, key=str)
    records = {r.page_id: bytes(r.record) for r in records_of(spark, str(tmp_path / "w")).collect()}
    head, _, rest = records[2].partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest == "<p>é</p>\r\n\r\n".encode()
    assert b"Content-Length: 9" in head and records[1].endswith(b"\r\n\r\n\r\n\r\n")
    # below the least size all are responses
    assert b"WARC-Type: response" in records[3] and b"WARC-Type: response" in records[4]


def test_damaged_payload_is_an_error(spark, tmp_path):
    write_archive(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"))
    bad = spark.read.parquet(str(tmp_path / "w" / "payloads")).selectExpr("sha256", "cast('x' as binary) payload")
    bad.write.parquet(str(tmp_path / "v" / "payloads"))
    spark.read.parquet(str(tmp_path / "w" / "records")).write.parquet(str(tmp_path / "v" / "records"))
    with pytest.raises(Exception, match="damaged payload"):
        pages_of(spark, str(tmp_path / "v")).collect()


def test_rules(spark):
    urls = [
        (1, "http://NET/x"), (2, "https://a.example.net/en/1?q#f"), (3, "http://a.net/de/"), (4, "http://notnet/x"),
        (5, "http://x.example.com/de/5"), (6, "http://b.org/fr/1"), (7, None), (8, "no scheme"), (9, "x://a.net"),
        (9, "x://a.net"),
    ]
    frame = spark.createDataFrame([(i, u, "") for i, u in urls], SCHEMA)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(frame).collect()}
    assert got[1] == ("net", "/x", "net/", "block")
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("net/", "block") and got[4][2:] == (None, "allow")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == ("org/fr/", "allow")
    assert got[7] == ("", "", None, "allow") and got[8] == ("", "", None, "allow")
    assert got[9] == ("a.net", "", None, "allow")
    assert url_verdicts(frame.limit(0)).collect() == []


def test_learned_templates(spark):
    """Variable segments become wildcards; what is like blocked addresses is rejected."""
    rules = (("block", "h", "/bad/1"), ("allow", "h", "/good/1"))
    rows = [(i, f"http://h/{kind}/{n}", "") for i, (kind, n) in enumerate(
        [("bad", 100 + j) for j in range(60)] + [("bad", 200 + j) for j in range(5)]
        + [("good", 100 + j) for j in range(60)] + [("good", 200 + j) for j in range(5)]
    )]
    got = {r.path: (r.rule is None, r.verdict, r.template) for r in url_verdicts(
        spark.createDataFrame(rows, SCHEMA), rules
    ).collect()}
    assert got["/bad/200"] == (True, "block", "h/bad/*") and got["/good/200"] == (True, "allow", "h/good/*")
    deep = spark.createDataFrame([("h", "/a/b/c/d/e")], "host string, path string")
    assert templates(deep).first().template == "h/*/*/*/**"


def test_templates_go_as_deep_as_the_paths(spark):
    """Branches below the third level, and small shares of large hosts, have verdicts of their own."""
    rules = (
        ("block", "h", "/en/2024/05/casino/1"), ("allow", "h", "/en/2024/05/news/1"),
        ("block", "big", "/pills/1"), ("allow", "big", "/p1"),
    )
    urls = [f"http://h/en/2024/05/{kind}/{n}/x" for kind in ("casino", "news") for n in [*range(100, 140), 200]]
    urls += [f"http://big/pills/{n}" for n in [*range(100, 159), 200]]
    urls += [f"http://big/p{n}/{n}" for n in range(1000, 7000)]
    frame = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], SCHEMA)
    got = {r.host + r.path: (r.rule is None, r.verdict, r.template) for r in url_verdicts(frame, rules).collect()}
    assert len(got) == len(urls)
    assert got["h/en/2024/05/casino/200/x"] == (True, "block", "h/en/2024/05/casino/*/x")
    assert got["h/en/2024/05/news/200/x"] == (True, "allow", "h/en/2024/05/news/*/x")
    assert got["big/pills/200"] == (True, "block", "big/pills/*")
    assert got["big/p6000/6000"] == (True, "allow", "big/*/*")
