from __future__ import annotations

import pytest

from ledgerline.llm import html

PAGE = ("<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><div class=brand>Brand line</div>"
        "<nav><a href=/>Home</a></nav><article><h1>Head {0}</h1><p>Body&nbsp;{0} &lt;x&gt;<p>second<br>line <b>bold {0}</article>"
        "<div id=comments><p>first!</p></div><footer>end</footer><script>if (a < b) x('</p>')</script></body></html>")


@pytest.mark.parametrize(("source", "text"), [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<p>a <i>b</i>\n c</p>", "a b c"), ("a &amp; b &am", "a & b &am"),
    ("<p>x<!-- <p>no</p> --></p>", "x"), ("<div class='ad-box'>no</div><p>yes", "yes"), ("<form>no</form>yes", "yes"),
    ("<p>cut <b", "cut"), ("1 < 2", "1 < 2"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<script>no", ""), ("</p></div>x", "x"),
    ("<main><p>a</p></main><p>b</p>", "a"), ("<article><header><h1>t</h1></header><p>a</p></article>", "t\na"),
    ("<article><p>a</p></article><article class=comment><p>b</p></article>", "a"), ("<a title='x > y'>k</a>", "k"),
])
def test_single_pages(source, text):
    assert html.main_text(source, frozenset()) == text


def test_deep_and_odd_markup_ends():
    assert html.main_text("<div>" * 20_000 + "x", frozenset()) == "x"
    assert html.main_text("<p>" * 20_000 + "x", frozenset()) == "x"
    html.main_text("<a b='" * 500, frozenset())
    html.template_candidates(html.parse("<div>" * 2000 + "x"))


def test_templates_are_counted_per_host(spark):
    rows = [(i, "http://a.org/p", PAGE.format(i)) for i in range(12)]
    # without article or main: a subtree on every page of the host goes, what one page has stays
    rows += [(100 + i, "https://b.org/q", f"<div>Our site slogan</div><div><p>text {i}</p></div>") for i in range(12)]
    rows += [(200, "http://c.org", "<div>Our site slogan</div><div>c</div>"), (300, None, None), (301, "", "<p>x"), (302, "odd", "<p>x"), (302, "odd", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as hash", "2 as host", "3 as pages")
    got = html.extract(df.repartition(4)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[3] == "Head 3\nBody 3 <x>\nsecond line bold 3"
    assert text[105] == "text 5"
    assert text[200] == "Our site slogan\nc"
    assert (text[300], text[301], text[302]) == ("", "x", "x")
    assert all(r.n_chars == len(r.text) for r in got)
    assert html.extract(df.filter("false")).collect() == []


def test_copied_articles_are_no_templates(spark):
    rows = [(i, "http://a.org/", PAGE.format("same")) for i in range(20)]
    texts = {r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert texts == {"Head same\nBody same <x>\nsecond line bold same"}


@pytest.mark.parametrize(("source", "text"), [
    ("<main><h1>T</h1><p>long body</p><article>teaser</article></main>", "T\nlong body\nteaser"),
    ("<body><nav>n</nav><div><p>long body</p></div><article>card</article><footer>f</footer>", "long body\ncard"),
    ("<main><p>a</p></main><article><p>b</p></article><p>c</p>", "a\nb"),
    ("<div class=brand>x</div><article><p class=brand>a</p></article>", "a"),
])
def test_text_outside_articles_stays(source, text):
    assert html.main_text(source, frozenset()) == text


def test_copies_of_a_page_count_once(spark):
    boxed = ("<article><h1>Head</h1><div><p>body</p></div><ul><li>item</li></ul><table><tr><td>cell</td></tr></table></article>"
             "<div>Posted {0} minutes ago</div>")
    plain = "<div><p>plain body</p></div><section>more</section>"
    rows = [(i, "http://a.org/", boxed.format(i)) for i in range(6)] + [(10 + i, "http://a.org/", plain) for i in range(6)]
    rows += [(20 + i, "http://a.org/", f"<article><p>text {i}</p><div>Share this</div></article>") for i in range(6)]
    text = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"Head\nbody\nitem\ncell\nPosted {i} minutes ago" for i in range(6))
    assert all(text[10 + i] == "plain body\nmore" and text[20 + i] == f"text {i}" for i in range(6))


def test_what_recurs_on_many_pages_goes_on_large_hosts_too(spark):
    rows = []
    for i in range(400):
        notice = "<div><span>Winter notice</span></div>" if i % 5 == 0 else ""
        quoted = "<p>quoted line</p>" if i % 4 == 0 else ""
        rows.append((i, "http://a.org/", f"{notice}<article><h1>head {i}</h1><p>text {i}</p>{quoted}<p>Subscribe now</p></article>"))
    # near copies of one article: no passage is a template
    rows += [(1000 + i, "http://b.org/", "<article><h1>h</h1>" + "".join(f"<p>part {k}</p>" for k in range(20) if k != i) + "</article>") for i in range(8)]
    text = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"head {i}\ntext {i}" + "\nquoted line" * (i % 4 == 0) for i in range(400))
    assert all(text[1000 + i].count("\n") == 19 for i in range(8))
