import time
import html
import itertools
import math
import random
import re

import pytest

from tessera.llm import html_extract as H


def page(body, before="", after="", head=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script>{head}</head><body><nav><ul>"
            f"<li><a href='/a'>Home</a></li><li><a href='/b'>World</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy it now.</div>{before}"
            f"<article>{body}</article>{after}<footer>&copy; someone &middot; All of it.</footer></body></html>")


def prose(rng, n):
    return " ".join(rng.choice("the and of onre blehe thander stion".split()) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(120):
        parts = [prose(rng, rng.randrange(2, 60)) for _ in range(rng.randrange(1, 8))]
        out.append((i, f"http://h/{i}", page(f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts)), "\n".join([parts[0], *parts])))
    return out


@pytest.fixture(scope="module")
def model(spark, rows):
    return H.trained(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string"))


def test_held_out_pages(rows):
    counts = {}
    for r in rows[:60]:
        for k, n in H.counted(r[2]).items():
            counts[k] = counts.get(k, 0) + n
    m = H.fitted(counts)
    assert [m.text(r[2]) for r in rows[60:]] == [r[3] for r in rows[60:]]


P = "<p>Some words that tell a story of the town and of its people, who live there.</p>"
T = "Some words that tell a story of the town and of its people, who live there."


@pytest.mark.parametrize("before,after", [
    ('<aside><h3>Related</h3><p>Another long story that you may like to read about the town.</p></aside>', ""),
    ("", '<div class="sidebar"><h4>Most read</h4><p>Another long story that people are reading today here.</p></div>'),
    ("", '<section id="comments"><h2>Comments</h2><div class="comment"><p>I agree with all that has been said here and more.</p></div></section>'),
    ('<div class="cookie-notice"><p>We use cookies to make this site better. Accept them all now.</p></div>', ""),
    ('<header><h1>Site name</h1><p>The tag line of the site, which is long enough to look like prose.</p></header>', ""),
    ('<noscript><p>Enable scripts to read this page now please, all of you.</p></noscript>', '<form><p>Subscribe</p><input name="q"></form>'),
])
def test_other_parts_of_a_page(model, before, after):
    assert model.text(page(f"<h1>Head</h1>{P}{P}", before, after)) == f"Head\n{T}\n{T}"


def test_parts_within_the_article(model):
    body = (f'<h1>Head</h1><div class="ad">Buy this thing now.</div>{P}<form><label>Name</label><textarea>x</textarea><button>Go</button>'
            f'<p>Get our letter.</p></form><ul><li>One point</li><li>Two points</ul>{P}<div class="comments"><p>I do agree with it.</p></div>')
    assert model.text(page(body)) == f"Head\n{T}\nOne point\nTwo points\n{T}"


@pytest.mark.parametrize("body,text", [
    ("<h1>a&amp;b  c</h1>" + P, f"a&b c\n{T}"),
    (f"<p><b>Bold and\n\t unclosed<br>{P}{P}", f"Bold and unclosed\n{T}\n{T}"),
    (f"{P}<p>one<br/>two <i>three</i>four&nbsp;five&#33; &lt;tag&gt;</p>", f"{T}\none two threefour five! <tag>"),
    (f"{P}<p title='a>b'>x</p><!-- <p>no</p> --><p>y", f"{T}\nx\ny"),
    (f"{P}<script>if (a < b) '</p>'</script><style>p</style>{P}", f"{T}\n{T}"),
    (f"{P}<div>loose text<p>inner</p>tail text</div>{P}", f"{T}\nloose text\ninner\ntail text\n{T}"),
])
def test_markup(model, body, text):
    assert model.text(page(body)) == text


def test_odd_input(model):
    assert model.text(None) == model.text("") == model.text("<p>") == ""
    for bad in ("<", "<<<", "</", "&", "<!--", "<p", "<script>x", "<a href='", "</p></p>", "<![CDATA[x", "<table><tr><td>a<td>b"):
        model.text(bad)
    cut = page(P + P)
    for n in range(0, len(cut), 7):
        model.text(cut[:n])
    assert model.text(cut[:cut.index("</article>") + 4]).startswith(f"{T}\n{T}")
    deep = model.text("<article>" + "<div>" * 3000 + P + "</div>" * 3000 + "</article>")
    assert isinstance(deep, str)


def test_marginals_match_enumeration(model):
    rng = random.Random(2)
    for _ in range(25):
        source = "".join(rng.choice(["<div>", "</div>", "<p>word text", "<ul><li>x", "</ul>", "<h2>t</h2>", "<nav>a</nav>", "<article>"])
                         for _ in range(7))
        pg = H.Page(source)
        n = len(pg.tags)
        if n > 10:
            continue
        feats = pg.features()
        score = [model.bias + sum(model.weights.get(f, 0.0) for f in x) for x in feats]
        total, one = 0.0, [0.0] * n
        for y in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(s for s, v in zip(score, y) if v) + sum(
                model.edges[feats[i][0]][y[pg.parents[i]]][y[i]] for i in range(1, n)))
            total += w
            for i in range(n):
                one[i] += w * y[i]
        assert all(abs(a - b / total) < 1e-9 for a, b in zip(model.marginals(pg), one))


def test_query(spark, rows):
    extra = [(500, None, None, ""), (None, "u", "", ""), (501, "u", "plain text without a tag", None)]
    data = [r[:3] for r in [*rows, *rows[:3], *extra]]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'own' AS text", "1 AS n_chars")
    got = H.extracted(df).collect()
    assert len(got) == len(data)
    text = {r[0]: r[3] for r in [*rows, *extra] if r[3] is not None}
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id in text:
            assert r.text == text[r.page_id]


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extracted(df).collect() == []


def test_labels():
    pg = H.Page(page("<h1>a</h1><p>b</p>", after="<aside>x</aside>"))
    assert {t for t, y in zip(pg.tags, pg.labels()) if y} == {"article", "h1", "p"}
    assert H.Page("<div><p>x</p></div>").labels() is None
    assert html.unescape("&amp;") == "&" and re.match("a", "a")


@pytest.mark.parametrize("source", [
    lambda n: "<a x " * n + '"', lambda n: "<a<" * n + ' "', lambda n: '<a "" ' * n + '"', lambda n: "<a <a " * n + ">",
    lambda n: "<div>" * n + "</zzz>" * n, lambda n: "<zzz><td>" + "<div>" * n + "</zzz>" * n, lambda n: "<div>" * n + "<li>" * n,
    lambda n: "<div>" * n + "<body>" * n, lambda n: "<div " + "x" * 8 * n + "=1>", lambda n: '<div a="' + "a=' " * n + '">'])
def test_hostile_pages_take_linear_time(source):
    """Ten megabytes would take hours in quadratic time."""
    def took(n):
        at = time.process_time()
        H.Page(source(n)).features()
        return time.process_time() - at

    took(1000)
    assert took(120_000) < 24 * max(took(10_000), 0.02)


def test_unclosed_quotes_are_text_and_later_tags_are_not():
    assert H.Page('<p>a <b x="1>bold</b> c</p><p>d</p>').blocks[0][1].startswith('a <b x="1>bold')
    assert [t for _, t in H.Page("<p>it's <i title=\"x>y\">so</i></p>").blocks] == ["it's so"]


def test_end_tags_stay_in_their_block():
    assert [t for _, t in H.Page("<b>a<div>x</b>y</div>z").blocks] == ["a", "xy", "z"]
    assert H.Page("<div><table><tr><td>x</div>y</td></tr></table></div>").blocks[0][1] == "xy"
    assert H.Page("<ul><li>a<ul><li>b</ul><li>c</ul>").tags.count("li") == 3


def test_labels_in_crawled_pages_are_not_trusted():
    """A responsive table's data-label says nothing about content."""
    table = '<article><table><tr><td data-label="Price">3</td><td data-label="0">4</td></tr></table></article>'
    page = H.Page(table)
    assert page.labels() == [0] + [1] * (len(page.tags) - 1) and 0 in page.labels(trusted=True)[1:]
