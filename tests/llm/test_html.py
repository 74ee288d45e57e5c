import html
import re

import pytest

from kindling.llm import html_main as H


@pytest.mark.parametrize("source,want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>a &amp; b&nbsp; c &lt;i&gt; &#233; &copy</p>", "a & b c <i> é ©"),
    ("<body><nav>m</nav><p>x <b>y</b>\n\t z<br>w</p><footer>f</footer>", "x y z w"),
    ("<article><h1>T</h1><p><b>one<br><p>two</article><aside>s</aside>", "T\none\ntwo"),
    ("<div>out</div><article><p>in</p><div class='ad-slot x'>buy</div><form>f<input></form>tail</article><p>after", "in\ntail"),
    ("<main><p>in</p><section id=comments><article class=comment><p>c</p></article></section></main>", "in"),
    ("<script>var a='</p><p>no';</script><style>p{}</style><title>t</title><p>yes", "yes"), ("<p>a<script>never ends", "a"),
    ("<!-- c --><p>a<!-- <p>no --> b</p><!-- open <p>x", "a b"), ("<div class=\"cookie-notice\">n</div><div class='content'>y</div>", "y"),
    ("a < b and 3 > 2 <", "a < b and 3 > 2 <"), ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c", "a b\nc"), ("<a title='x>y'>l</a>", "l"), ("<p>x</p></article></div>y", "x\ny"),
    ("<div role=navigation>m</div><div role=main>c</div><div>d</div>", "c"), ("<header>h</header><article><header>h</header>t</article>", "t"),
    ("<P>U<BR/>V</P>", "U V"), ("<body class='with-sidebar'><p>k</p></body>", "k")])
def test_main_text(source, want):
    assert H.main_text(source) == want


def test_very_long_and_deep_pages():
    assert len(H.main_text("<p>" + "word " * 400_000)) == 5 * 400_000 - 1
    assert H.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert H.main_text("<b>" * 20_000 + "x") == "x"
    assert H.main_text("<p>a</p>" * 3000).count("\n") == 2999


def article_of(source):
    inner = re.sub("<br>", " ", re.search(r"<article>(.*?)</article>", source, re.S)[1])
    parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_driver_pages_give_their_articles(spark, small):
    got = H.op9_html_extraction(spark, "/root/testdata/sf0.001").collect()
    want = {r.page_id: article_of(r.html) for r in small("pages").collect()}
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def page(k, extra=""):
    return (f"<html><body><div class=top><p>Site name</p><p>All about it</p></div><div><p>Story {k} begins</p>{extra}<p>and goes on {k * 7}</p></div>"
            f"<div><p>Follow us</p><span>today</span></div></body></html>")


def test_constant_text_is_template(spark):
    rows = [(k, f"http://a.org/{k}", page(k, "<p>more</p>" * (k % 3))) for k in range(30)]
    rows += [(100 + k, f"http://b.org/{k}", page(k)) for k in range(3)] + [(200, None, page(1)), (201, "http://a.org/x", None), (202, "http://a.org/y", "")]
    rows += [(300 + k, "http://c.org/same", page(5)) for k in range(20)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, template string")
    got = {r.page_id: r.text for r in H.extract(df, bundle_pages=8).collect()}
    assert got[7].split("\n")[0] == "Story 7 begins" and got[7].split("\n")[-1] == "and goes on 49"
    assert "Site name" not in got[7] and "Follow us" not in got[7]
    assert got[100].startswith("Site name")      # three pages of a host prove nothing
    assert got[310].startswith("Site name")      # nor do copies of one page
    assert got[201] == got[202] == "" and len(got) == len(rows)
    want = dict(got)
    H.BROADCAST_BYTES, kept = -1, H.BROADCAST_BYTES
    try:
        assert {r.page_id: r.text for r in H.extract(df, bundle_pages=8).collect()} == want
    finally:
        H.BROADCAST_BYTES = kept


def tree(source):
    p = H.Page(source)
    texts = [0] * len(p.labels)
    for node, text, _, _ in p.leaves:
        texts[node] = H._hash(text)
    return p, H.Tree(p.parents, [H._hash(x) for x in p.labels], texts)


def brute_align(a, b):
    """Simple tree matching, plainly, with the same weights."""
    def pair(i, j):
        if a.labels[i] != b.labels[j]:
            return 0
        return (1 + (a.texts[i] == b.texts[j])) if a.texts[i] else 1 + lists(tuple(a.kids[i]), tuple(b.kids[j]))

    def lists(x, y):
        if not x or not y:
            return 0
        return max(lists(x[1:], y), lists(x, y[1:]), pair(x[0], y[0]) + lists(x[1:], y[1:]))

    return lists(tuple(a.roots), tuple(b.roots))


def test_alignment_finds_the_constant_leaves():
    pa, a = tree("<div><p>m</p><p>x1</p><p>k</p><ul><li>t</li></ul></div><p>end</p>")
    _, b = tree("<div><p>m</p><p>y1</p><p>y2</p><p>k</p><ul><li>u</li><li>t</li></ul></div><p>end</p>")
    found = H.align(a, b)
    text = {n: t for n, t, _, _ in pa.leaves}
    assert sorted(text[k] for k in found) == ["end", "k", "m", "t"]
    assert brute_align(a, b) == 16


def test_empty(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def shop(k, extra=""):
    return (f"<html><body><section class=bar><p>Shop name</p></section><section class=goods><p>Ware {k}</p>{extra}</section>"
            f"<section class=end><p>Terms apply</p></section></body></html>")


def board(k):
    return f"<html><body><table><tr><td><div><p>Board rules</p></div><div><p>Post {k}</p></div></td></tr></table></body></html>"


def host_texts(spark, sources):
    rows = [(k, f"http://h.org/{k}", s) for k, s in enumerate(sources)]
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_text_on_60_percent_of_pages_is_template(spark):
    got = host_texts(spark, [page(k, "<p>Subscribe now</p>" if k % 5 < 3 else "") for k in range(60)])
    assert all(t == f"Story {k} begins\nand goes on {k * 7}" for k, t in got.items())


def test_outlier_page_is_no_reference():
    # whichever page comes first
    sources = ["<html><body><center>error 500</center></body></html>", *[page(k) for k in range(9)]]
    for k in range(len(sources)):
        pages = [H.Page(s) for s in sources[k:] + sources[:k]]
        rows = []
        for p in pages:
            texts = [0] * len(p.labels)
            for node, text, _, _ in p.leaves:
                texts[node] = H._hash(text)
            rows.append((p.parents, p.paths(), texts))
        found = {text: len(seen) for (_, text), seen in H.constant(rows).items()}
        assert found == {H._hash(t): 9 for t in ("Site name", "All about it", "Follow us", "today")}


def test_every_layout_has_its_template(spark):
    sources = [page(k) for k in range(40)] + [shop(k) for k in range(30)] + [board(k) for k in range(8)] + ["<html><body><p>odd"]
    got = host_texts(spark, sources)
    assert all(got[k] == f"Story {k} begins\nand goes on {k * 7}" for k in range(40))
    assert all(got[40 + k] == f"Ware {k}" for k in range(30)) and all(got[70 + k] == f"Post {k}" for k in range(8))
    assert got[78] == "odd"


def test_deep_pages_are_merged():
    deep = [H.Page("<div>" * 3000 + f"<p>same</p><p>{k}</p>") for k in range(3)]
    rows = [(p.parents, p.paths(), [H._hash(t) if (t := dict((n, t) for n, t, _, _ in p.leaves).get(k)) else 0 for k in range(len(p.labels))]) for p in deep]
    assert [len(seen) for seen in H.constant(rows).values()] == [3]


@pytest.mark.parametrize("source,want", [
    ("<div id=page class='site has-sidebar'><nav>m</nav><article><p>a</p></article><div class=sidebar><p>long long side</p></div></div>", "a"),
    ("<div class='elementor-widget'><p>not</p><main><p>the text</p></main></div><p>x", "the text"),
    ("<div class=no-banner><div class='post comments-open'><p>the whole text</p></div></div><div class=cookie-notice>n</div>", "the whole text"),
    ("<article class='post comments-open'><p>a</p></article><section id=comments><article class=comment>c</article></section>", "a"),
    ("<div class=has-sidebar><div class=related><article>b</article></div><article><p>a a</p></article></div>", "a a"),
    ("<div class=content><p>the content itself</p></div><div class=related><article>teaser</article></div>", "the content itself"),
    ("<article><p>a</p></article><div class=comments><p>a very long comment on it</p></div>", "a"),
    ("<div role=main class=no-sidebar><p>t</p></div><p>x", "t"), ("<header class=site-header><article>h</article></header><p>x", "x"),
    ("<div class=widget>" * 3000 + "<p>in" + "</div>" * 3000, "in")])
def test_a_name_alone_does_not_reject_the_article(source, want):
    assert H.main_text(source) == want


def test_template_decides_where_a_name_does_not(spark):
    got = host_texts(spark, [f"<body><div class='site no-banner'><p>Site name, and all about it in many words</p><p>Story {k}</p></div>"
                             f"<div class=sidebar><p>Most read</p><p>{k}</p></div>" for k in range(12)])
    assert got == {k: f"Story {k}" for k in range(12)}
