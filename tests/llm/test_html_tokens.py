"""Tags of odd pages, in linear time."""

import time
from html.parser import HTMLParser

import pytest

from riskflow.llm.html_text import main_text
from riskflow.llm.html_tokens import tags

LONG = "It is the story of a town that was lost in the hills, and of the people who have lived in it for many years since."


def test_attribute_states():
    page = "<a b=c d='e>f' g=\"h'i\" j=it's k  =  l m n/><P q>x</p\n><br/>"
    got = [(t.name, t.closing, t.attributes, t.empty) for t in tags(page)]
    assert got == [("a", False, (("b", "c"), ("d", "e>f"), ("g", "h'i"), ("j", "it's"), ("k", "l"), ("m", ""), ("n", "")), True),
                   ("p", False, (("q", ""),), False), ("p", True, (), False), ("br", False, (), True)]


@pytest.mark.parametrize("page, text", [
    (f"<article><p data-x=it's>{LONG}</p><p>{LONG} it's the third</p></article>", f"{LONG} {LONG} it's the third"),
    (f'<article><p title="oops>{LONG}</p></article>', LONG),
    (f"<article><video><p>{LONG}</p><select><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p><video>no player</video><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p></article><script>var a = '<p>", LONG),
    (f"<article><p>1 < 2 and 3 <4. {LONG}</p></article><a href='cut", f"1 < 2 and 3 <4. {LONG}"),
    (f"<body><div id='kommentare'><p>{LONG}</p></div><article><p>{LONG}</p></article></body>", LONG),
    ("<body><nav><a href='/'>Главная</a></nav><div><p>" + "Город стоит на берегу широкой реки, где зимой всегда тихо. " * 4 + "</p></div></body>",
     ("Город стоит на берегу широкой реки, где зимой всегда тихо. " * 4).strip()),
    ("<body><div><p>" + "町は広い川の岸にあり、冬はいつも静かで、人々は長い夜を火のそばで過ごしている。" * 3 + "</p></div></body>",
     "町は広い川の岸にあり、冬はいつも静かで、人々は長い夜を火のそばで過ごしている。" * 3),
])
def test_nothing_is_lost(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ["<a ", "<a b=\"x ", "<a b='", "<video>", "<svg>", "<b>", "</i>", "<p>", "<div><i>", "<!--", "<![CDATA[", "<!x", "< a",
                                   "<a b='>'", "<li>", "<a>", "&amp", "<head>", "<script>", "<i><b></i>", "<x=\">", "</"])
def test_linear_in_the_page(piece):
    n = 1_000_000 // len(piece)
    begin = time.process_time()
    main_text(piece * n)
    main_text("<b>" * 100_000 + piece * (n // 10) + "</i>" * 100_000)
    assert time.process_time() - begin < 25


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, False, tuple((k, v or "") for k, v in attrs)))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        self.found.append((tag, True, ()))


def test_pages_of_the_table_against_a_second_parser(spark):
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        page = row["html"] or ""
        plain = Plain()
        plain.feed(page)
        raw = ("script", "style")
        inside, got = None, []
        import html
        for t in tags(page):
            if inside and not (t.closing and t.name == inside):
                continue
            inside = t.name if t.name in raw and not t.closing else None
            if t.name:
                got.append((t.name, t.closing, () if t.closing else tuple((k, html.unescape(v)) for k, v in t.attributes)))
        assert got == plain.found
