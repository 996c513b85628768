import html
import re

import pytest

from bazaarmill.llm import wrappers as w

PAGE = """<html><body><header class=top><h1>Site</h1></header><nav><a href=x>Home</a></nav><main><article><header><h1>T &lt;x&gt;</h1></header>
<p>One <b>bo</b>ld &amp; two<p>three<br>four <span class="ad">BUY</span>five <span class=x>six</span></p><ul><li>a<li>b</ul><div class="share">Share</div>
<form>f<input></form><section id="comments"><article class="comment"><p>nice</p></article></section><table><tr><td>c1<td>c2</table></article></main>
<aside>side</aside><div id="cookie-notice">ok</div><footer>f</footer><script>var t="</p>";</script>"""


def test_page_alone():
    found = w.shape(PAGE)
    assert w.main_text(PAGE, set(w.main_paths(found, {}, 1))) == "T <x> One bold & two three four five six a b c1 c2"
    assert "(<li>#</>)+" in w.expression(found)


def test_alignment():
    a, b = w.shape("<div><p>x</p><p>y</p></div>"), w.shape("<div><h2>t</h2><p>x</p></div>")
    assert w.expression(w.infer([a, b])) == "<div>(<h2>#</>)?(<p>#</>)+</>"
    assert w.infer([a, b]) == w.infer([b, a])
    assert w.align(a, a) == a


def test_template_text_is_left_out(spark):
    pages = [(i, f"http://h.org/{i}", f"<div><h1>Title {i}</h1><p>Brought to you</p><div><p>Text number {i} of the page, rather long</p></div></div>", "x") for i in range(8)]
    got = w.extract(spark.createDataFrame(pages, "page_id long, url string, html string, _host string")).collect()
    assert {r["text"] for r in got} == {f"Text number {i} of the page, rather long" for i in range(8)} or {r["text"] for r in got} == {f"Title {i} Text number {i} of the page, rather long" for i in range(8)}


def test_cases(spark):
    pages = [(1, None, None), (2, "http://a.org", ""), (3, "::", "only text &amp; more"), (4, "http://a.org/x", PAGE), (4, "http://a.org/x", PAGE), (5, "http://b.org", "<p>" + "long " * 50_000), (6, "http://c.org", "a < b <p>c")]
    got = {r["page_id"]: r["text"] for r in w.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == "" and got[2] == ""
    assert got[3] == "only text & more"
    assert got[4].startswith("T <x> One bold")
    assert got[5] == ("long " * 50_000).strip()
    assert got[6] == "a < b c"
    assert w.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query(spark):
    from conftest import DATA

    def plain(page):
        article = re.search(r"<article>(.*?)</article>", page or "", re.S)
        return " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", re.sub(r"</?b>", "", article[1]))).split()) if article else ""

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in w.op7_main_text(spark, DATA).collect():
        assert r["text"] == plain(pages[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("deep", [1_200, 10_000])
def test_deep_nesting(spark, deep):
    body = "<div>" * deep + "<p>the deep text</p><nav>menu</nav>"
    pages = [(i, f"http://h.example/{i}", f"<html><body><p>first {i}</p>{body}</body></html>") for i in range(3)]
    pages.append((3, None, "<div><p>" * deep + "alone"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in w.extract(df).collect()}
    assert all(got[i].endswith("the deep text") for i in range(3))
    assert got[3] == "alone"


BODY = "<h1>Title</h1><p>The main body of this page is here.</p><p>And it goes on for a while, longer than all the rest.</p>"
SMALL = "<nav>Home</nav><div class='side-box'>small print</div>"


@pytest.mark.parametrize("page", [
    f"<body>{SMALL}<div class='search-results-study'>{BODY}</div></body>",
    f"<body>{SMALL}<table class='menu-layout'><tr><td>{BODY}</td></tr></table></body>",
    f"<body>{SMALL}<div class='tags-page'><div class='social-science'>{BODY}</div></div></body>",
])
def test_words_within_classes_do_not_bar_the_main_text(spark, page):
    want = "Title The main body of this page is here. And it goes on for a while, longer than all the rest."
    assert w.alone(page) == want
    pages = [(i, f"http://h.example/{i}", page.replace("main body", f"main body {i} {'x' * i}")) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in w.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert f"The main body {i} {'x' * i} of" .replace("  ", " ") in got[i] and "Home" not in got[i] and "small print" not in got[i]


def test_comments_stay_out_however_long():
    page = f"<body><article>{BODY}<div class='comment-thread'>{'<p>I have much to say about that.</p>' * 50}</div></article></body>"
    assert "much to say" not in w.alone(page) and "main body" in w.alone(page)


def page_of(n, extra="", lead=""):
    blocks = "".join(f"<h2>Part {i}</h2><p>Text {i} of it.</p>" + "<p>More.</p>" * (i % 3) for i in range(n))
    return f"<html><body><nav>menu</nav><main>{lead}{blocks}{extra}</main></body></html>"


def test_sequences_of_siblings_become_one_group():
    assert list(w.periods(["a", "b", "a", "b", "c"])) == [(0, 2, 2), (4, 1, 1)]
    assert list(w.periods(["c", "a", "b", "d", "a", "b", "d", "a", "b"])) == [(0, 1, 1), (1, 3, 2), (7, 1, 1), (8, 1, 1)]
    assert list(w.periods(["a", "b", "a"])) == [(0, 1, 1), (1, 1, 1), (2, 1, 1)]
    few, many = w.shape(page_of(5)), w.shape(page_of(900))
    assert len(w.expression(many)) < 3 * len(w.expression(few))
    assert "<+h2 p>" in w.expression(few)


def test_long_pages_of_short_blocks_take_linear_time(spark):
    import time

    def took(n):
        start = time.time()
        pair = [w.shape(page_of(n)), w.shape(page_of(n, "<ul><li>x</li></ul>" * 2, "<p>lead</p>"))]
        known = w.Slots(w.infer(pair))
        found = list(known.match(w.tree(page_of(n))))
        assert len(found) >= 2 * n and all(s >= 0 for s, *_ in found)
        return time.time() - start

    took(100)
    assert took(8000) < 25 * max(took(1000), 0.05)


def test_irregular_long_pages_keep_their_text(spark):
    import random

    rng = random.Random(5)

    def page(k):
        return "<html><body><nav>menu</nav><main>" + "".join(f"<{t}>{t} {i} {k}</{t}>" for i, t in enumerate(rng.choices(["h2", "p", "blockquote", "pre"], k=1500))) + "</main></body></html>"

    pages = [(k, f"http://h.example/{k}", page(k)) for k in range(6)]
    got = {r["page_id"]: r["text"] for r in w.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for k, _, p in pages:
        want = " ".join(re.sub("<[^>]+>", " ", p.split("<main>")[1]).split())
        assert got[k] == want


def test_sequences_do_not_change_the_text(spark):
    pages = [(i, f"http://h.example/{i}", page_of(n, x, y)) for i, (n, x, y) in enumerate([(1, "", ""), (2, "", ""), (7, "<ul><li>u</li></ul>", ""), (30, "", "<p>lead</p>"), (8, "<h2>end</h2>", "<h2>start</h2>")])]
    got = {r["page_id"]: r["text"] for r in w.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, _, p in pages:
        want = " ".join(html.unescape(re.sub("<[^>]+>", " ", p.split("<main>")[1])).split())
        assert got[i] == want
