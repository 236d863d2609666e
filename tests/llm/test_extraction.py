import html
import re

from tidelake.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>Nope</title><style>p{}</style><script>var t="<p>no</p>";</script></head>
<body class="home page"><header><h1>Site name</h1></header>
<nav><ul><li><a href="/">Home</a></li><li><a href=x>News</a></li></ul></nav><div class="cookie-notice">We use the cookies that are of use to us and you.</div>
<div id="sidebar"><p>The best of the web and what to read in the evening with a cup of tea.</p></div>
<main><article><h1>A   title
 here</h1><p>The first <b>paragraph</b> of the text is about a man who was in the house &amp; on the roof.</p>
<p>Short one.</p><form><p>Name: <input name=a> of the user who is in the list</p></form><aside class="promo">Buy the thing of the year now and be happy.</aside>
<p>And the l&eacute;gume is on the table &#8212; it was there for all of the day, and that is how it was.<br>Second line.</p>
<section class="comments"><p>I was the first to see that this is a comment of a reader.</p></section></article></main>
<footer>&copy; the owners of the site and all that is in it</footer></body></html>"""


def test_article_without_its_frame():
    assert html_extract.main_text(PAGE).split("\n") == [
        "A title here",
        "The first paragraph of the text is about a man who was in the house & on the roof.",
        "Short one.",
        "And the légume is on the table — it was there for all of the day, and that is how it was. Second line.",
    ]


def test_page_without_article_uses_densities():
    page = """<div><a href=a>One link</a> <a href=b>Another link</a></div>
    <div>The man of the house was in the garden for most of the day and it was good to be there.</div><div>Yes.</div><div>Sure.</div>
    <div>Kjhgf lkjhg poiuy trewq asdfg zxcvb mnbvc lkjhg fdsaq wertz uiopl kjhgf dsayx cvbnm qwert zuiop.</div><div>No.</div>"""
    assert html_extract.main_text(page).split("\n") == [
        "The man of the house was in the garden for most of the day and it was good to be there.",
        "Yes.",
    ]


def test_neighbours_decide():
    assert html_extract.second_pass([1, 0, 0, 0, -1], [False] * 5) == [1, 1, -1, -1, -1]
    assert html_extract.second_pass([1, 0, 0, 0, -1], [True] * 5) == [1, 1, 1, -1, -1]
    assert html_extract.second_pass([-1, 0, 1, 0], [False] * 4) == [-1, -1, 1, 1]
    assert html_extract.second_pass([0, 0], [True, False]) == [1, 1]


def test_broken_markup():
    assert html_extract.main_text("") == ""
    assert html_extract.main_text("<p>text of a page <!-- open") == "text of a page"
    assert html_extract.main_text("<p>text <b of a page") == "text"
    assert html_extract.main_text("a < b and c > d") == "a < b and c > d"
    assert html_extract.main_text("<script>x") == ""
    assert html_extract.main_text("<div " * 2000) == ""


GOOD = "The man of the house was in the garden for most of the day and it was good to be there."


def test_elements_that_end_without_a_closing_tag():
    for page in (
        f"<html><head><title>no</title><meta charset=x><body><p>{GOOD}", f"<head><title>no</title><div><p>{GOOD}</div>", f"<head><title>no</title>{GOOD}",
        f'<article><svg viewBox="0 0 1 1"/><p>{GOOD}</article>', f"<article><math /><p>{GOOD}</article>", f"<article><svg><style/><path/></svg><p>{GOOD}</article>",
        f"<table><tr><td><aside>no<td>{GOOD}<tr><td><nav>no</table>", f"<ul><li><div><form>no</form><li>{GOOD}</ul>", f"<dl><dt><button>no</button><dd>{GOOD}</dl>",
    ):
        assert html_extract.main_text(page) == GOOD, page
    cells = html_extract.blocks_of('<table><tr><td class="ad">one<td>two<tr><th class="ad">three<tr><td>four</table>after')
    assert [b.text for b in cells if not b.framed and not getattr(b, "named", 0)] == ["two", "four", "after"]
    items = html_extract.blocks_of('<ul><li class="promo">one<li>two<ul><li class="ad">in</ul>of two<li>three</ul><dl><dt class="ad">four<dd>five</dl>')
    assert [b.text for b in items if not b.framed and not getattr(b, "named", 0)] == ["two", "of two", "three", "five"]


def test_names_are_a_feature_and_no_override():
    for page in (
        f'<div class="content has-sidebar"><p>{GOOD}</div>', f'<div class="no-sidebar with-comments"><p>{GOOD}</div>', f'<article class="post share-open"><p>{GOOD}</article>',
        f'<article class="promo"><p>{GOOD}</article>', f'<div data-id="ad" data-role="menu" title="x class=ad"><p>{GOOD}</div>',
        f'<nav>a menu</nav><div class="widget"><p>{GOOD}</p></div><footer>an end</footer>', f'<div class="related"><article>Short</article></div><div><p>{GOOD}</p></div>',
    ):
        assert html_extract.main_text(page) == GOOD, page
    page = f"""<article><h1>Title</h1><p>{GOOD}</p><h2 id="discussion">Talk</h2><p class="form-validation">{GOOD}</p><section id="search"><h2>Search</h2><p>{GOOD}</p></section>
    <div class="ad">Buy now</div><div class="comments-list"><p>I was the first.</p></div><p>{GOOD}</p></article>"""
    assert html_extract.main_text(page).split("\n") == ["Title", GOOD, "Talk", GOOD, "Search", GOOD, GOOD]
    assert [html_extract.speaks_against(x) for x in (' class="mainAdBox"', " id=AD", ' role="navigation"', ' class="cookie_notice"', ' class="adapt"', ' id="sharing-data"')] == [True] * 4 + [False] * 2


def test_links_inside_an_article():
    page = f"""<nav><a href=/>Home</a></nav><article><h1><a href=x>A linked title</a></h1><p>{GOOD}</p>
    <p>See <a href=y>the full report of the committee on the state of the garden</a>.</p><p>{GOOD}</p></article><div><a href=z>Next page of the list</a></div>"""
    assert html_extract.main_text(page).split("\n") == ["A linked title", GOOD, "See the full report of the committee on the state of the garden.", GOOD]
    page = f'<ul><li><a href=a>One</a><li><a href=b>Two</a></ul><div><h2><a href=x>Title</a></h2><p>{GOOD}</p></div><ul><li><a href=c>Three</a></ul>'
    assert html_extract.main_text(page).split("\n") == ["Title", GOOD]


RUSSIAN = "Старый дом стоял на краю деревни, и никто уже не помнил, кто построил его и когда это было на самом деле."
JAPANESE = "古い家は村のはずれに立っていて、誰がいつそれを建てたのか、もう誰も覚えていなかった。" * 3


def test_languages_without_known_stop_words():
    for text in (RUSSIAN, JAPANESE):
        page = f"<ul><li><a href=a>{text[:9]}</a></ul><div><p>{text}</p><p>{text}</p><p>{text[:20]}</p><p>{text}</p></div><footer>{text}</footer>"
        assert html_extract.main_text(page).split("\n") == [text, text, text[:20].strip(), text]


def test_a_teaser_beside_the_body():
    body = "".join(f"<p>{GOOD} It was the day number {i} of the year.</p>" for i in range(10))
    page = f'<div id="content">{body}</div><article class="card"><h3><a href=x>More</a></h3><p>{GOOD}</p></article>'
    got = html_extract.main_text(page).split("\n")
    assert [t for t in got if "day number" in t] == [f"{GOOD} It was the day number {i} of the year." for i in range(10)]
    page = f"<article><h1>Title</h1>{body}</article><div><p>{GOOD}</p></div>"
    assert html_extract.main_text(page).split("\n") == ["Title", *(f"{GOOD} It was the day number {i} of the year." for i in range(10))]


def test_every_page_against_its_article_element(spark):
    """In these pages everything outside the article element is frame."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_extract.query(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == pages.count()
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert (got[row.page_id].text, got[row.page_id].n_chars) == (text, len(text))


def test_null_and_empty_pages(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2)], "page_id long, url string, html string, text int")
    want = [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)]
    assert sorted(map(str, (tuple(r) for r in html_extract.extract(pages).collect()))) == sorted(map(str, want))
    assert html_extract.extract(pages.limit(0)).collect() == []
