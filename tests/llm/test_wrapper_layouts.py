"""Layouts of one host, slots by position, and what counts as template."""

from bazaarmill.llm import wrappers as w


def texts_of(spark, pages):
    return {r["page_id"]: r["text"] for r in w.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_layouts_of_a_host_do_not_empty_each_other(spark):
    url = "http://h.org/"
    pages = [(i, url, f"<body><nav>n</nav><article><p>article {i} {'long ' * 50}</p></article></body>") for i in range(20)]
    pages += [(100, url, "<main><p>in main</p></main>"), (101, url, "<div class=content><p>in content</p></div>"), (102, url, "<body><p>plain body</p></body>"), (103, url, "no tags")]
    pages += [(104, url, "<div><div><p>in a div</p></div></div>")]
    pages += [(200, None, "<article>one</article>"), (201, "::", "<p>two</p>"), (202, "odd", "three"), *[(210 + i, None, "<p>equal</p>") for i in range(9)]]
    got = texts_of(spark, pages)
    assert all(got[i] == f"article {i} {'long ' * 50}".strip() for i in range(20))
    assert [got[i] for i in range(100, 105)] == ["in main", "in content", "plain body", "no tags", "in a div"]
    assert [got[i] for i in (200, 201, 202, 210, 218)] == ["one", "two", "three", "equal", "equal"]


def test_boilerplate_under_the_same_tags(spark):
    pages = [(i, "http://h.org/", f"<article><p>Brought to you</p><p>Body {i} of the page, rather long</p></article>") for i in range(8)]
    assert texts_of(spark, pages) == {i: f"Body {i} of the page, rather long" for i in range(8)}


def test_template_needs_most_distinct_pages(spark):
    page = lambda i, x: f"<article><h2>{x}</h2><p>Body {i} of the page, rather long</p></article>"
    pages = [(i, "http://h.org/", page(i, "Same" if i < 6 else f"Own {i}")) for i in range(20)]
    pages += [(100 + i, "http://copies.org/", page(0, "Same")) for i in range(9)] + [(110 + i, "http://copies.org/", page(i, f"Own {i}")) for i in range(2)]
    got = texts_of(spark, pages)
    assert got[0] == "Same Body 0 of the page, rather long"
    assert got[100] == "Same Body 0 of the page, rather long"


def test_slots_by_position():
    a = w.tree("<div><div><p>x</p></div><h2>t</h2><div><p>y</p></div></div>")
    b = w.tree("<div><h2>t</h2><div><p>y</p></div></div>")
    known = w.Slots(w.infer([w.collapse(w.blank(a)), w.collapse(w.blank(b))]))
    assert [s for s, _ in known.match(a)] == [0, 1, 2]
    assert [s for s, _ in known.match(b)] == [1, 2]
    assert known.path[0] == known.path[2]
