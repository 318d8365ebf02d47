import html
import re

from millrace.llm import pages
from millrace.llm.queries import QUERIES

PLAIN = """<html><head><title>No</title><script>var t="</p><p>no</p>";</script><style>p{}</style></head><body>
<header><a href=/>Site</a><h2>Site name</h2></header><div id=menu><ul><li><a href=x>one</a></li></ul></div>
<div class="content"><h1>Title of it</h1><p>First   paragraph&nbsp;of text &amp; more.<p>Second <b>bold
&eacute;</b> with <a href=x>a link</a>.</p><aside><p>Side text</p></aside><div class="ad">Buy this now</div>
<ul><li>item one</li><li>item two</li></ul><p>To.</p></div>
<div class="side-bar"><p>Related stories of many words are here for you to read</p></div>
<div class="cookie-notice">We use cookies</div><section id="comments"><p>A reader says hello to all of you here</p></section>
<form><p>Subscribe</p></form><footer>&copy; 2020</footer></body></html>"""


def test_containers_and_blocks():
    want = "Title of it\nFirst paragraph of text & more.\nSecond bold é with a link.\nitem one\nitem two\nTo."
    assert pages.main_text(PLAIN) == want
    assert pages.main_text("<article><header><h1>H</h1></header><p>x &lt;b&gt; y<div class=comments>no</div></article>tail") == "H\nx <b> y"
    assert pages.main_text("<main><p>short</p></main><div><p>" + "long " * 50 + "</p></div>").startswith("long")
    assert pages.main_text("<p>a<br>b<p>c") == "a b\nc"


def test_odd_pages():
    for page in (None, "", "   ", "<", "<div", "<!-- open", "<script>x", "<nav>all menu</nav>"):
        assert pages.main_text(page) in ("", "<")
    assert pages.main_text("plain text only") == "plain text only"
    deep = "<div>" * 3_000 + "<p>deep</p>"
    assert pages.main_text(deep) == "deep"


def test_operator_rows(spark):
    rows = [(1, "u", PLAIN, "old"), (1, "u", PLAIN, "old"), (2, None, None, "old"), (3, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((r["page_id"], r["text"]) for r in pages.extract(df).collect())
    assert found == [(1, pages.main_text(PLAIN))] * 2 + [(2, ""), (3, "")]
    assert pages.extract(df.limit(0)).collect() == []


def test_registered_query(spark):
    """The articles of the test pages, by their markers."""
    raw = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r["page_id"]: r for r in QUERIES["op10_pages"](spark, "/root/testdata/sf0.001").collect()}
    for row in raw:
        article = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (found[row["page_id"]]["text"], found[row["page_id"]]["n_chars"]) == (want, len(want))


def _paragraphs(n, size=300, word="text"):
    return [f"{word} {i} " + "of it " * (size // 6) + "ends." for i in range(n)]


def _html(paragraphs):
    return "".join(f"<p>{p}</p>" for p in paragraphs)


def test_long_div_pages_keep_all_between_adverts():
    first, last = _paragraphs(20), _paragraphs(3, word="last")
    ad, share = "<div class=ad>Buy this</div>", "<div class=share><a href=x>Share</a></div>"
    page = f"<body><div id=menu>Menu</div><div><h1>Title</h1>{share}{_html(first)}{ad}{_html(last)}</div></body>"
    assert pages.main_text(page).split("\n") == ["Title", *first, *last]
    page = f"<body><div class=content><h1>Title</h1><div>{_html(first)}</div>{ad}<div>{_html(last)}<p>To.</p></div></div></body>"
    assert pages.main_text(page).split("\n") == ["Title", *first, *last, "To."]
    # Sections of their own containers, one of them with nearly all of the text.
    page = f"<body><div>Site</div><div class=content><div><h1>Title</h1></div><div>{_html(first)}</div><div>{_html(last[:1])}</div></div></body>"
    assert pages.main_text(page).split("\n") == ["Title", *first, last[0]]


def test_sibling_articles_and_the_heading_of_main():
    first, last = _paragraphs(6), _paragraphs(2, word="last")
    want = ["Title", *first, *last]
    page = f"<main><h1>Title</h1><article>{_html(first)}</article><article>{_html(last)}</article></main><div>Site</div>"
    assert pages.main_text(page).split("\n") == want
    comment = "<article class='comment even'><p>A reader says hello.</p></article>"
    page = f"<article><h1>Title</h1>{_html(first)}</article><article>{_html(last)}</article>{comment}<div>Site</div>"
    assert pages.main_text(page).split("\n") == want
    # Many short articles, none with a large share.
    many = _paragraphs(10)
    page = "".join(f"<div><article><p>{p}</p></article></div>" for p in many)
    assert pages.main_text(page).split("\n") == many


def test_names_that_are_subjects_count_with_a_second_sign():
    body = _paragraphs(3)
    sections = (
        "<section id=discussion><h2>Discussion</h2><p>We discuss it.</p></section><section id=results-and-discussion><p>Results are here.</p></section>"
        "<h2 id=related-work>Related work</h2><p>Others did it.</p><h2 id=search>Search</h2><h3 id=feedback-loops>Loops</h3>"
        "<section id=copyright><p>Of copyright.</p></section><section id=comments-on-the-proof><p>We comment.</p></section>"
        "<div class=alert><p>Take care.</p></div><div class=tags><p>Tags are words.</p></div>"
    )
    want = [
        *body, "Discussion", "We discuss it.", "Results are here.", "Related work", "Others did it.", "Search", "Loops",
        "Of copyright.", "We comment.", "Take care.", "Tags are words.",
    ]
    apart = (
        "<div class=related><a href=x>Another story</a> <a href=y>One more</a></div><div class=share><a href=x>Share</a></div>"
        "<div class=comments><p>A reader says hello.</p></div><div class=ad>Buy this.</div><div role=search>Find it.</div>"
    )
    for tag in ("article", "main"):
        assert pages.main_text(f"<{tag}>{_html(body)}{sections}{apart}</{tag}>").split("\n") == want
    # Without article or main, a section's own heading speaks for it.
    page = f"<div>{_html(body)}<section id=discussion><h2>Discussion</h2><p>We discuss it.</p></section><div class=copyright>Of 2020.</div>{apart}</div>"
    assert pages.main_text(page).split("\n") == [*body, "Discussion", "We discuss it."]


def test_a_name_around_most_of_the_article_says_nothing():
    body = _paragraphs(3)
    for name in ("menu-closed", "no-sidebar", "elementor-widget"):
        assert pages.main_text(f"<div class={name}><h1>Title</h1>{_html(body)}</div>").split("\n") == ["Title", *body]
        assert pages.main_text(f"<div class={name}><article>{_html(body)}</article></div>").split("\n") == body


def test_layout_of_pages_without_article():
    body = _paragraphs(4)
    parts = (
        '<div id="header"><h1>Site</h1><p>All about the site is here.</p></div>',
        '<div id="menu"><h3>Menu</h3><p>Where to go from this page.</p></div>',
        '<div id="login"><h3>Log in</h3><p>Enter your name and word.</p></div>',
        '<div id="footer"><h3>About us</h3><p>We are a site of many pages.</p></div>',
    )
    page = f"<body>{parts[0]}{parts[1]}<div class=content><h1>Title</h1>{_html(body)}</div>{parts[2]}{parts[3]}</body>"
    assert pages.main_text(page).split("\n") == ["Title", *body]


def test_notices_and_footers_inside_an_article():
    body = _paragraphs(2)
    parts = '<div class="notice">This site is moving soon.</div><div class="footer">Printed by the site.</div>'
    section = '<div class="notice"><h2>Of notices</h2><p>A notice is a text.</p></div>'
    assert pages.main_text(f"<article>{_html(body)}{parts}{section}</article>").split("\n") == [*body, "Of notices", "A notice is a text."]


def test_unnamed_parts_beside_the_article_never_surge():
    body, last = _paragraphs(4), _paragraphs(2, word="last")
    side = "<div><h3>Popular posts</h3><p>Ten things to see.</p><p>Five to forget.</p></div>"
    want = ["Title", *body, *last]
    article = f"<div><h1>Title</h1>{_html(body)}<div class=ad>Buy.</div>{_html(last)}</div>"
    for page in (f"{article}{side}", f"{side}{article}", f"<div>{side}<div>{article}</div></div>{side}", f"{article}{side}{side}"):
        assert pages.main_text(f"<body>{page}</body>").split("\n") == want
    # A short division between surges is the article's, as are short blocks of its own element.
    short = "<div><h2>Aside</h2><p>Of little.</p></div>"
    page = f"<body><div><h1>Title</h1>{_html(body)}{short}{_html(last)}<ul><li>To.</li></ul></div>{side}</body>"
    assert pages.main_text(page).split("\n") == ["Title", *body, "Aside", "Of little.", *last, "To."]


def test_formulas_and_linked_paragraphs_stay():
    body = _paragraphs(2)
    math = "<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds.</p>"
    linked = "<p><a href=x>This whole paragraph leads elsewhere.</a></p>"
    links = "<p><a href=x>Home of the site</a> <a href=y>All that we sell</a></p>"
    page = f"<div><h1>Title</h1>{_html(body[:1])}{math}{linked}{links}{_html(body[1:])}</div>"
    assert pages.main_text(page).split("\n") == ["Title", body[0], "So x=1 holds.", "This whole paragraph leads elsewhere.", body[1]]


def test_a_very_long_page():
    body = _paragraphs(20_000)
    assert pages.main_text(f"<div><h1>Title</h1>{_html(body)}</div>").split("\n") == ["Title", *body]
