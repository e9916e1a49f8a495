"""Wrappers and main text on hand-made pages and on the given ones."""

from __future__ import annotations

import html as entities
import re

import pytest

from meterlake.llm import wrappers as w


def _page(body, extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>T &am</title><style>p{{}}</style><script>var t='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href='/a'>A</a><li>B</ul></nav>"
        f"<!-- x --><div class=\"ad\">Buy</div><article><h1>Head &amp; line</h1>{body}<div class='comments'><p>First!</p></div></article><aside>More</aside>"
        f"<form><p>Mail <input name=x></p></form>{extra}<footer>&copy; 2</footer></body></html>"
    )


CASES = [
    ("<p>One  two\n three</p><p>Four</p>", ["Head & line", "One two three", "Four"]),
    ("<p><b>Bold<br><p>Next &lt;x&gt; &#233;&eacute; &nbsp;z</p>", ["Head & line", "Bold", "Next <x> éé z"]),
    ("<ul><li>a<li>b <i>c</i></ul><table><tr><td>1<td>2</table>", ["Head & line", "a", "b c", "1", "2"]),
    ("text outside<p>in</p>tail<script>x<p>y</script>", ["Head & line", "text outside", "in", "tail"]),
    ("<pre>a\n  b</pre><blockquote>q</blockquote><style>.</style>", ["Head & line", "a b", "q"]),
    ("", ["Head & line"]),
]


@pytest.mark.parametrize("body,want", CASES)
def test_one_page(body, want):
    page = _page(body)
    assert w.main_text(page, None) == "\n\n".join(want)
    assert w.main_text(page, w.region(w.wrapper_of(page))) == "\n\n".join(want)


@pytest.mark.parametrize(
    "before",
    [
        "<script>for(i=0;i<n;i++){t(i);}</script>", "<SCRIPT>var a='<!--';</Script >", "<script>if(a<b&&c>d){e='<p>\\'';}</script>", "<style>a:before{content:'<!--'}</style>",
        "<div><button>Send</div>", "<div><video src=x></div>", "<video src=x>", "<svg><path d=x>", "<p><noscript>off", "<div><button>A<button>B</button></div>", "<textarea><n;></textarea>",
        "<button><div>Share</div></button>", "<svg><title>t</title><g><text>z</text></g></svg>",
    ],
)
def test_article_after_scripts_and_unclosed_elements(before):
    page = f"<html><body>{before}<article><p>One<p>Two</article><script>x</script></body></html>"
    assert w.main_text(page, None) == "One\n\nTwo"
    page = f"<html><body><article><h1>Zero</h1>{before}<p>One<p>Two</article></body></html>"
    assert w.main_text(page, None) == "Zero\n\nOne\n\nTwo"


def test_alignment_makes_options_and_groups():
    whole = None
    for body in ("<p>a</p><p>b</p>", "<h2>s</h2><p>c</p>", "<p>d</p><h2>t</h2><p>e</p><h2>u</h2>"):
        whole = w.merge(whole, w.wrapper_of(_page(body)))
    text = w.expression(whole)
    assert "(<li> #text </>)+" in text and '"Site"' in text
    assert re.search(r"<article> \(.*\(<p> #text </>\)[*+?].*\(<h2> #text </>\)\?.*\)\+ </>", text)
    again = w.load(w.dump(whole))
    assert w.expression(again) == text and w.region(again) == ["html", "body", "article"]


def test_without_an_article_element():
    page = "<html><body><div class=nav><a href=x>menu menu menu</a></div><div class=wrap><div class=inner><p>" + "long text " * 30 + "</p><p>end</p></div><div class='sidebar x'><p>side</p></div></div></body></html>"
    assert w.main_text(page, None) == " ".join(["long text"] * 30) + "\n\nend"
    page = "<div id=top>hello</div><div id=content><p>body &amp; soul<p>two</div>"
    assert w.main_text(page, None) == "body & soul\n\ntwo"


@pytest.mark.parametrize("page", ["", "<", "<p", "<article>", "</p></div>", "plain", "<!-- open", "<script>never ends <p>x", "<a href='x>y'>z</a>", "<p>" * 3000, "<div>" * 500 + "x", "é🙂<b>x</i>"])
def test_malformed_pages_end(page):
    text = w.main_text(page, None)
    assert "<p>" not in text
    assert w.main_text(page, ["html", "body"]) is not None


def test_pages_of_a_host(llm_spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", _page(CASES[i % len(CASES)][0]), "old") for i in range(60)]
    rows += [(100, None, None, None), (101, "http://h0.example/x", "", "x"), (102, "no address", "<p>lone", "x"), (103, "http://h1.example/", "<p>other shape</p>", "x"), (1, rows[1][1], rows[1][2], "again")]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    got = w.extract_main_text(pages, keep=["page_id", "url"]).collect()
    want = {i: "\n\n".join(CASES[i % len(CASES)][1]) for i in range(60)} | {100: "", 101: "", 102: "lone", 103: "other shape"}
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert w.extract_main_text(pages.where("false")).count() == 0
    assert {r.host: r.pages for r in w.infer_wrappers(pages).collect()} == {"h0.example": 20, "h1.example": 22, "h2.example": 20, "": 1}


def _host_pages(llm_spark, bodies, host="h"):
    rows = [(i, f"http://{host}.example/{i}", b) for i, b in enumerate(bodies)]
    return llm_spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


def test_what_pages_share_is_left_out_and_what_varies_stays(llm_spark):
    def page(i):
        return (
            f"<html><body class='page has-sidebar'><div class='q1'><div class=bx7>Read our guide first</div><div class='story-comment'><h2>Summary</h2><p>Fact {i} is long and new {i * 7}</p>"
            f"<p>More of fact {i} follows here</p></div><div class=related><p>See {i}</p></div><h3>About us</h3><p>We are the site</p></div></body></html>"
        )

    got = {r.page_id: r.text for r in w.extract_main_text(_host_pages(llm_spark, map(page, range(40)))).collect()}
    assert got == {i: f"Summary\n\nFact {i} is long and new {i * 7}\n\nMore of fact {i} follows here" for i in range(40)}
    assert w.main_text("<html><body class='page has-sidebar'><article>Text</article></body></html>", None) == "Text"
    same = {r.text for r in w.extract_main_text(_host_pages(llm_spark, ["<article><p>a</p><p>b</p></article>"] * 9)).collect()}
    assert same == {"a\n\nb"}


def test_names_of_single_pages_do_not_make_the_wrapper_grow(llm_spark):
    def page(i):
        return f"<html><body class='postid-{i} single'><div id='wrap-{i}' class='wrap x{i}'><article id='post-{i}' class='slug-{chr(97 + i % 26) * (i + 1)} hentry'><p>Text {i}</p></article></div></body></html>"

    few, many = (w.infer_wrappers(_host_pages(llm_spark, map(page, range(n)))).first() for n in (10, 60))
    assert few.expression == many.expression and many.pages == 60
    assert many.path == ["html", "body", "div wrap", "article hentry post"]
    assert all(w.blocks(page(i), many.path, w._known(many.known)) == [f"Text {i}"] for i in range(60))


def test_large_tables_of_hosts_are_joined_alike(llm_spark, monkeypatch):
    pages = _host_pages(llm_spark, [_page(f"<p>Text {i}</p>") for i in range(12)])
    sent = sorted(w.extract_main_text(pages).collect())
    monkeypatch.setattr(w, "SENT", -1)
    assert sorted(w.extract_main_text(pages).collect()) == sent


def test_given_pages(llm_spark):
    """The given pages' articles, by a plain rule for their one template."""
    pages = llm_spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in w.extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|pre|li|ul|ol|div)(?:\s[^>]*)?>", re.sub(r"<br\s*/?>", " ", article))
        plain = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert got[r.page_id] == "\n\n".join(p for p in plain if p)
