import pytest

from riskflow.llm.html_text import blocks, classify, extract, main_text

LONG = ("The report says that the work on the bridge was done in the summer and that it is now open for all who want "
        "to cross the river, which was not the case for a long time before. ")


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_without_what_stands_around_it():
    body = f"""<header>Site name</header><div class="page-header"><p>{LONG}</p></div><nav><ul><li><a href="/a">Home</a></li></ul></nav>
      <div class="ad">Buy the best of the things that are for you.</div><aside>About the site</aside>
      <article><h1>A&nbsp;title</h1><p>{LONG}<p>Short.<br>Next &amp; last <b>bo</b>ld</p>
      <script>var t = "</p><p>the code";</script><!-- <p>comment</p> -->
      <form><input name="q"><button>Send the form</button></form>
      <div id="comments"><p>{LONG}</p></div></article>
      <div class="cookie-notice">We use cookies to make the site better for all.</div>
      <footer>&copy; the owner</footer>"""
    assert main_text(page(body)) == f"A title {LONG.strip()} Short. Next & last bold"


def test_two_passes_without_an_article():
    short, links = "A short line", '<a href="/1">One thing to read</a> <a href="/2">Another thing</a>'
    html = page(f"<div><p>{links}</p><p>{short} a</p><p>{links}</p><div>{LONG}</div><p>{short} b</p><div>{LONG}</div>"
                f"<p>{short} c</p></div><p>{links}</p>")
    assert main_text(html) == f"{LONG.strip()} {short} b {LONG.strip()} {short} c"


def test_first_pass_leaves_short_blocks_open():
    found = blocks(page(f"<p>{LONG}</p><p>Few words</p><p><a>only a link in here</a></p>"))
    classify(found)
    assert [b.label for b in found] == ["text", "text", "boilerplate"]


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("<article>", ""), ("<article>x", "x"),
    ("<article><p>a<p>b</article>", "a b"), ("<article>a < b and b > c &lt;</article>", "a < b and b > c <"),
    ("<article>x<span title='a>b'>y</span>z</article>", "xyz"), ("<article>a<!-- b", "a"),
    ("<article>a<script>b", "a"), ("<article><p hidden>a</p><p style='display: none'>b</p><p style='overflow:hidden'>c", "c"),
    ("<article><header><h1>a</h1></header><div class='header'>b</div>c</article>", "a b c"), ("<article><ul><li>a<li>b</ul>c</article>", "a b c"),
    ("<article><div>a</b></div><p>b</i></article>d", "a b"), ("<main>&#228;&eacute;&#x41;\t\n b</main>", "äéA b"),
    ("<article><p class='intro'>a</p><p class='ad'>b</p>c</article>", "a c"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"), ("</div></p><article>a</div>b</article>", "a b"),
])
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_very_long_page():
    assert main_text("<article>" + "<p>" + LONG * 20_000) == " ".join((LONG * 20_000).split())
    assert main_text("<div>" * 3000 + LONG) == LONG.strip()


def test_query_shape(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (1, "u", f"<article>{LONG}</article>"), (None, None, None), (2, None, "")]
    pages = spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out) == [
        (0, "", 0), (1, LONG.strip(), len(LONG.strip())), (1, LONG.strip(), len(LONG.strip())), (2, "", 0)]
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("html,text", [
    (f"<div class='layout has-sidebar'><article><p>{LONG}</article></div>", LONG.strip()),
    (f"<div class='has-sidebar content'><p>{LONG}</p></div>", LONG.strip()),
    ("<main class='no-sidebar'><p>a</p></main>", "a"), ("<main class='search'><p>a</p></main>", "a"),
    ("<article class='post hentry category-legal tag-search comment-open'>a</article>", "a"),
    ("<article class='notice' id='comment'>a</article>", "a"), ("<article hidden>a</article>", ""),
    ("<div class='sidebar'>b<div><article>a</article></div>c</div>", "a"),
    ("<article>a <span class='alert'>b</span> c</article>", "a b c"),
    ("<article>a<span class='ad'>b</span>c</article>", "a c"),
    ("<article>a <i hidden>b</i> c</article>", "a c"),
    ("<article><p class='sidebar-left'>b</p><div id='mainMenu'>c</div><div class='share_buttons'>d</div>a</article>", "a"),
    ("<main><article>a</article><div id='comments'><article class='comment-body'>b</article></div></main>", "a"),
    ("<article>a</article><div class='related-posts'><article>b</article></div>", "a"),
])
def test_marks_are_whole_names_and_spare_articles(html, text):
    assert main_text(page(html)) == text


@pytest.mark.parametrize("html,text", [
    ("<article><h1><a href='/t'>Title</a></h1><p>a</p><p><a href='/s'>A linked sentence.</a></p></article>",
     "Title a A linked sentence."),
    ("<article>a<ul><li><a href='/r'>Reference one of the work</a></li></ul></article>", "a Reference one of the work"),
    ("<article>a<ol>" + f"<li><a href='/r'>{LONG}</a></li>" * 4 + "</ol></article>", " ".join(["a", *[LONG.strip()] * 4])),
    ("<article>a<ul>" + "<li><a href='/m'>Menu</a></li>" * 3 + "</ul>b</article>", "a b"),
    (f"<a name='top'><p>{LONG}</p><div>{LONG}</div>", f"{LONG.strip()} {LONG.strip()}"),
    (f"<div><p><a href='/x'>not closed</p><p>{LONG}</p></div><div>{LONG}</div>", f"{LONG.strip()} {LONG.strip()}"),
    (f"<a href='/x'>not closed<p>{LONG}</p><p>{LONG}</p>", f"{LONG.strip()} {LONG.strip()}"),
    (f"<div><a href=http://x/>not closed <a id=y>{LONG}</a></div>", "not closed " + LONG.strip()),
    (f"<div>{LONG}</div><a href='/x'><div>{LONG}</div><div>{LONG}</div></a>", LONG.strip()),
])
def test_links_end_and_count_less_in_articles(html, text):
    assert main_text(page(html)) == text
