"""Operator 12: pages of known text, and wrappers of made-up hosts."""

import html as entities
import re

from pyspark.sql import functions as F

from plumbline.llm import html_text
from plumbline.llm.html_text import Page, align, decide, flat, text_by, unflat, wrapper_of

SF = "/root/testdata/sf0.01"


def plain(source):
    """The text of the driver's pages, which have one article each."""
    out = []
    for block in re.split("<p>|</p>|<h1>|</h1>", re.search("<article>(.*?)</article>", source, re.S).group(1)):
        block = " ".join(entities.unescape(re.sub("<[^>]*>", "", block)).split())
        if block:
            out.append(block)
    return "\n".join(out)


def together(pages):
    merged = None
    for p in pages:
        w = wrapper_of(Page(p))
        assert flat(unflat(*flat(w)))[0] == flat(w)[0]
        merged = w if merged is None else align(merged, w)
    return merged


def extracted(pages):
    decided = decide(together(pages))
    return [text_by(Page(p), decided) for p in pages]


def test_driver_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.op12(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_wrappers_are_regular_expressions():
    w = together(["<body><h1>a</h1><ul><li>x<li>y<li>z</ul><p>t</p></body>", "<body><h1>b</h1><p>u</p><div class=box>v</div></body>"])
    keys = lambda items: [(x[0], x[2], x[3]) for x in items]
    body = w[0][1]
    assert keys(body) == [("h1", False, False), ("ul", False, True), ("p", False, False), ("div.box", False, True)]
    assert keys(body[1][1]) == [("li", True, False)]
    pairs = together(["<dl><dt>a<dd>1<dt>b<dd>2<dt>c<dd>3</dl>", "<dl><dt>a<dd>1</dl>"])
    assert keys(pairs[0][1]) == [("(dt dd)", True, False)]
    order = [f"<body><h1>{i}</h1>{'<p>x</p>' * (i % 3)}{'<hr><div>y</div>' * (i % 2)}</body>" for i in range(12)]
    shape = flat(together(order))
    assert [sorted(c[:2] for c in shape[1])] == [sorted(c[:2] for c in flat(together(order[::-1]))[1])]


def test_host_without_article_element():
    pages = [f"<html><body><div class=top><a href=/>Home</a> <a href=/a>About us</a></div><div class=cols><div class=text><h2>Title {i}</h2><p>Some longer words of page {i}, told at length. {'More. ' * (20 + i)}</p><p>Second part {i}.</p><p>Read our other stories every day of the week!</p></div><div class=more><a href=1>Other {i}</a><a href=2>Another {i}</a></div></div><div class=base>All rights are ours</div></body></html>" for i in range(10)]
    for i, t in enumerate(extracted(pages)):
        lines = t.split("\n")
        assert lines[0] == f"Title {i}" and lines[1].startswith("Some longer words") and lines[2] == f"Second part {i}."
        assert "Home" not in t and "Another" not in t and "All rights" not in t


def test_template_text_inside_articles():
    pages = [f"<body><article><h1>News {i}</h1><div class=tag>Our daily letter</div><p>Text {i}</p></article></body>" for i in range(9)]
    assert extracted(pages) == [f"News {i}\nText {i}" for i in range(9)]
    same = ["<body><article><h1>One</h1><p>Text</p></article></body>"] * 20
    assert extracted(same) == ["One\nText"] * 20


def test_what_is_left_out():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div><main><article class="post"><header><h1>The&nbsp;title &amp; more</h1></header>
<p>First <b>bold</b> and&#32;<i>soft</i>
 line.<br>Same block<p>Unclosed <a href=x>link</a> &lt;b&gt; &eacute;&#233;
<div class="ad">Buy</div><aside>Beside</aside><form><label>Mail</label><input><button>Go</button></form><p hidden>hidden<p style="display: none">none
<ul><li>one<li>two<ul><li>inner</ul></ul><table><tr><td>c1<td>c2</table><p>Say <span class="share"><span>tweet</span> it</span>now</p><blockquote>quoted</blockquote><pre>a
  b</pre><!-- <p>comment</p> --><footer>by me</footer></article><section id="comments"><article class="comment"><p>Reader</p></article></section></main>
<div class="sidebar">Side</div><footer>&copy;</footer><script>document.write("<p>x</p>")"""
    want = "The title & more\nFirst bold and soft line. Same block\nUnclosed link <b> éé\none\ntwo\ninner\nc1\nc2\nSay now\nquoted\na b"
    assert extracted([page]) == [want]


def test_broken_pages():
    cases = {"": "", "plain words": "plain words", "<p>a<p>b": "a\nb", "a < b and c > d": "a < b and c > d", "<article><p>x": "x", "<p>x</div></div>y": "xy", "<div>" * 3000 + "deep": "deep", "<p title='>'>q": "q", "<p title=\"a>b": "b", "text <b": "text", "<script>never closed": "", "<![CDATA[raw]]>": "raw", "<form><p>all in a form": "all in a form", "<ARTICLE>Up</ARTICLE><P>out": "Up", "&am &amp &quo;": "&am & &quo;"}
    for source, want in cases.items():
        got = extracted([source])[0]
        assert got == want, (source, got)


def test_rows(spark):
    """Nulls, empty and very long pages, repeated rows, no rows, other columns."""
    long = "<article>" + "".join(f"<p>part {i} {'w ' * 50}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "http://u@A.example.org:80/x", "<article><p>One</p></article>"), (1, "http://u@A.example.org:80/x", "<article><p>One</p></article>"), (2, None, "<p>none</p>"), (3, "https://b.example.org", None), (4, "no host", ""), (None, "//c/", "<p>five"), (6, "http://b.example.org/2", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"a.b": F.lit(1), "host": F.lit("z"), "w": F.lit(1), "HTML2": F.lit("x")})
    got = html_text.op12(df).collect()
    assert sorted(((r.page_id or 0), r.text[:20], r.n_chars) for r in got)[:6] == [(0, "five", 4), (1, "One", 3), (1, "One", 3), (2, "none", 4), (3, "", 0), (4, "", 0)]
    assert next(r.text.count("\n") for r in got if r.page_id == 6) == 19_999
    assert html_text.op12(df.limit(0)).count() == 0
    hosts = [r[0] for r in df.select(html_text.host(F.col("url"))).collect()]
    assert hosts == ["a.example.org", "a.example.org", "", "b.example.org", "", "c", "b.example.org"]


def test_many_wrappers_of_one_host(spark, monkeypatch):
    """Distinct wrappers meet in rounds of small groups; the joined way gives the same texts as the sent one."""
    rows = [(i, f"http://{'big' if i % 3 else 'small'}.example/", f"<body><div class=a>{'<p>t' + str(i) + '</p>' if i & 1 else ''}{'<h2>u</h2>' if i & 2 else ''}{'<ul><li>v' + str(i) + '</ul>' if i & 4 else ''}{'<h3>w</h3><p>x</p>' if i & 8 else ''}</div></body>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(html_text.op12(df).collect())
    monkeypatch.setattr(html_text, "MERGED", 2)
    found = html_text.wrappers(df.select(html_text.host(F.col("url")).alias("host"), "html")).collect()
    assert sorted(r.host for r in found) == ["big.example", "small.example"]
    monkeypatch.setattr(html_text, "SENT", 0)
    got = html_text.op12(df)
    assert "host" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r.page_id for r in sorted(got.collect())] == [r.page_id for r in want]
