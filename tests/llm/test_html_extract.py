import pytest

from specmerge.llm import html_extract as h


@pytest.mark.parametrize(
    "source,want",
    [
        ("<body><header><h1>Site</h1></header><article><header><h1>Ti&amp;tle</h1></header><p>a <b>b</b><br>c<p>d<script>x</p></script><form>f</form><aside>no</aside><div class='comments'><p>com</div><footer>x</footer></article><article class=comment>c2</article></body>", "Ti&tle\na b c\nd"),
        ("<nav>m<article><p>in</p></article>out", "in"),
        ("<div class='cookie-notice'>x</div><div>main text</div>tail", "main text\ntail"),
        (None, ""),
        ("", ""),
        ("<p>a&nbsp;b &eacute; &#65;&lt;i&gt; <!-- c --> d", "a b é A<i> d"),
        ("<main><p>x</p><div id=sidebar>y</div></main>z", "x"),
        ('a < b and <3 > c <a href="x>y">t</a>', "a < b and <3 > c t"),
        ("<ul><li>one<li>two<ul><li>three</ul><li>four</ul>", "one\ntwo\nthree\nfour"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
        ("<p>cut <b", "cut <b"),
        ("</div></p>x</article><article>", "x"),
        ("<style>p{}</style><title>t</title><noscript>n</noscript><p>y", "y"),
        ("<div class='layout has-sidebar'><p>a</p><div class='page-sidebar'>b</div></div>", "a"),
        ("<article><div class='article-header'><h1>T</h1></div><p>x<ol class='commentlist'><li>c</ol></article><div id='siteHeader'>no</div>", "T\nx"),
        ("<div class='header'>site</div><p>x<span class='ad'>buy</span> y", "x y"),
        ("<div class='ad'>buy<article><p>kept</p></article></div>", "kept"),
    ],
)
def test_page(source, want):
    assert h.Page(source).text(()) == want


def pages():
    rows = []
    for i in range(12):
        rows.append((i, f"https://A.example.com/{i}", f"<body><div><p>Follow us on everything</p><ul><li>Home</li><li>About</li></ul></div><div><p>Story number {i} of its own.</p></div></body>"))
    rows += [(100 + i, "https://b.example.com/x", "<div><p>Copied page text</p></div>") for i in range(9)]  # copies are one page
    rows += [(200 + i, "https://c.example.com/x", f"<article><p>Same first words</p><p>{i}</p></article>") for i in range(9)]
    rows += [(300, None, "<p>Follow us on everything</p>"), (None, "not a url", None), (300, None, "<p>Follow us on everything</p>")]
    return rows


@pytest.mark.parametrize("bound", [8 << 20, 0])
def test_templates_go_by_host(spark, monkeypatch, bound):
    monkeypatch.setattr(h, "BROADCAST_BYTES", bound)
    df = spark.createDataFrame([(*r, "host", "gone") for r in pages()], "page_id long, url string, html string, host string, gone string").repartition(4)
    got = {(r.page_id if r.page_id is not None else -1): r for r in h.extract(df).collect()}
    assert [got[i].text for i in range(12)] == [f"Story number {i} of its own." for i in range(12)]
    assert got[100].text == "Copied page text" and got[200].text == "Same first words\n0"
    assert got[300].text == "Follow us on everything" and got[-1].text == "" and got[-1].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_long_and_hostile_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert h.Page(deep).text(()) == "x"
    assert len(h.Page("<p>" + "word " * 300_000).text(())) == 5 * 300_000 - 1
    assert h.Page('<a "' * 2000).text(()) is not None


def test_empty(spark):
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_templates_inside_articles(spark):
    """A notice without a telling name in most articles of a host goes; a rarer one, copies' and near copies' text stay."""
    own = lambda i: f"<p>Story number {i} has a long text of its own, told in many words.</p>"
    rows = [(i, "https://a.example.com/", f"<article>{own(i)}<div><p>Tell a friend</p></div>{'<p>Now and then</p>' if i < 4 else ''}</article>") for i in range(12)]
    rows += [(100 + i, "https://b.example.com/", f"<p>{i}</p><article>{own(0)}<p>Copied</p></article>") for i in range(9)]
    rows += [(200 + i, "https://c.example.com/", f"<article>{own(0)}<p>{i}</p></article>") for i in range(9)]
    got = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    story = "Story number {} has a long text of its own, told in many words."
    assert [got[i] for i in range(12)] == [story.format(i) + ("\nNow and then" if i < 4 else "") for i in range(12)]
    assert got[103] == story.format(0) + "\nCopied" and got[203] == story.format(0) + "\n3"


def test_templates_of_a_section_of_a_large_host(spark):
    rows = [(i, "https://a.example.com/", f"<div><p>Story number {i}.</p>{'<div><p>Only in this section</p></div>' if i < 110 else '<div><p>Rare</p></div>' if i < 150 else ''}</div>") for i in range(700)]
    got = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[0] == "Story number 0." and got[120] == "Story number 120.\nRare" and got[500] == "Story number 500."
