"""Main text of web pages by two-pass block rules (operator 6).

A page is cut into blocks at its block-level tags.  The first pass decides each
block by stop-word density, length and link density: blocks inside menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments (by tag or by a class, id or role that names one as a whole) or mostly
made of links are boilerplate;
long blocks with enough stop words are text; the rest, short or poor in stop
words, stay ambiguous.  The second pass gives an ambiguous block the label of
its nearest decided neighbours: one inside an article takes the article's, any
other takes the label both neighbours share or, if they differ, the nearer
one's.  Classes mark block elements only, adverts inline ones too, and never an
article or main element that is not inside another; a wrapper's mark ends where
such an element begins, unless it names comments, related pages or adverts.
Inside an article or main element blocks of links are left to the second pass
unless ``MENU`` short list items of links or more follow each other.

Defined results: null, empty and wordless pages have the empty text; a page of
which no block is decided keeps its ambiguous blocks only inside an article or
main element; on a page without any known stop word length and link density decide;
unclosed and misnested tags are closed as browsers close them, and an element that never
ends takes nothing with it unless it is a script or style; work is linear in the page;
rows alike give the same text; a null id or url is kept; other columns are not
read.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.html_tokens import Tags

#: Frequent function words of the four languages, fixed values.
STOP_WORDS = frozenset("""
    the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
    de la le les et des en un une du que est pour qui dans par sur au pas plus ne se ce il sont avec
    el los las y del que un una por con no su para es al lo como más o pero sus
""".split())
SHORT, LONG = 40, 140
#: Marks that an article inside lifts, and others.
SOFT, FIRM = 1, 2
#: So many short list items of links in a row are a menu.
MENU = 3
ENOUGH_STOP_WORDS, MANY_LINKS = 0.15, 0.5
#: Mean letters of a word from which on a block's writing puts no spaces between words.
WIDE_WORDS = 12

_RAW = frozenset(["script", "style", "noscript", "template", "textarea", "select", "title", "svg", "iframe", "object",
                  "math", "canvas", "audio", "video", "head"])
_CODE = frozenset(["script", "style"])
_BAD_TAGS = frozenset(["nav", "footer", "aside", "form", "menu", "button", "dialog", "fieldset", "label", "option"])
_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
#: What a sibling's end tag need not name, and what ends the search for one.
_SCOPES = frozenset("ul ol dl table tbody thead tfoot tr article main section div body select".split())
#: Words of a class, id or role that mark what is no main text.
_MARKS = frozenset("""ad ads advert adverts advertisement adbox adslot sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice alert popup modal overlay sidebar side aside widget menu nav navbar navigation
    breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments commentlist respond reply
    replies disqus share sharing social related recommended newsletter subscribe subscription signup login search
    skip complementary contentinfo copyright legal disclaimer
    kommentar kommentare leserkommentare commentaire commentaires comentario comentarios werbung anzeige publicite
    publicidad""".split())
#: Marks of what holds articles of its own, and of adverts, which may stand inside a line.
_ADS = frozenset("""ad ads advert adverts advertisement adbox adslot sponsor sponsored promo promotion werbung anzeige publicite
    publicidad""".split())
_LISTS = _ADS | frozenset("""comment comments commentlist respond reply replies disqus related recommended kommentar kommentare
    leserkommentare commentaire commentaires comentario comentarios""".split())
#: What may stand before and after a mark in one name: ``main-menu``, ``sidebar-left``, not ``has-sidebar``.
_BEFORE = frozenset("page site main top bottom left right primary secondary global post entry article".split())
_SITE = frozenset("page site main top global".split())
_AFTER = frozenset("left right links buttons form bar box list area section posts top bottom".split())
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


_NOWHERE = ("", 0, False, False)


@dataclass
class Block:
    text: str
    linked: int       # characters inside links
    article: bool     # inside an article or main element
    bad: bool         # inside boilerplate
    item: bool = False   # inside a list item
    label: str = ""   # text, boilerplate or, undecided, empty


def _names_mark(name: str, article: bool) -> frozenset | set:
    """The marks that a class or id consists of, apart from words of place."""
    parts = [p.lower() for p in _PART.findall(name)]
    if "header" in parts:
        own = not article and parts[-1] == "header" and all(p in _SITE for p in parts[:-1])
        return {"header"} if own else frozenset()
    start, end = 0, len(parts)
    while start < end and parts[start] in _BEFORE:
        start += 1
    while end > start and parts[end - 1] in _AFTER:
        end -= 1
    marks = set(parts[start:end])
    return marks if marks <= _MARKS else frozenset()


def _hidden(attributes: tuple) -> bool:
    return any(k == "hidden" or k == "style" and _UNSEEN.search(v) for k, v in attributes)


def _has(attributes: tuple, *keys: str) -> bool:
    return any(k in keys for k, _ in attributes)


def _marked(attributes: tuple, article: bool, block: bool) -> int:
    """How class, id or role mark an element as boilerplate: 0 not, ``SOFT`` or ``FIRM``,
    as it is when hidden.  A header inside an article is the article's own."""
    if not attributes:
        return 0
    if _hidden(attributes):
        return FIRM
    marks = {m for key, value in attributes if key in ("class", "id", "role") for name in html.unescape(value).split()
             for m in _names_mark(name, article)}
    if not block:
        marks &= _ADS
    return FIRM if marks & _LISTS or marks and article else SOFT if marks else 0


def blocks(page: str) -> list[Block]:
    """The page's blocks with white space turned into single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []       # tag, bad, article, item: of it and all around it
    depths: dict[str, list[int]] = {}                   # where each tag stands in the stack
    ends: dict[str, list[tuple[int, int]]] = {}         # (start, end) of what ends a raw element, by its name
    reader = Tags(page)
    held: list[str] = []
    linked = at = 0
    link = -1          # depth of the open link
    loose = False      # whether it has no end tag of its own
    coming = (0, "")   # place and slash of the next anchor tag

    def flush() -> None:
        nonlocal linked, link
        if loose:
            link = -1
        if held:
            text = " ".join("".join(held).split())
            if text:
                _, bad, article, item = stack[-1] if stack else _NOWHERE
                out.append(Block(text, min(linked, len(text)), article, bool(bad), item))
            held.clear()
        linked = 0

    def read(upto: int) -> None:
        nonlocal linked
        if upto > at:
            text = page[at:upto]
            if "&" in text:
                text = html.unescape(text)
            held.append(text)
            if link >= 0:
                linked += len("".join(text.split()))

    def push(name: str, bad: int, article: bool, item: bool) -> None:
        depths.setdefault(name, []).append(len(stack))
        stack.append((name, bad, article, item))

    def innermost(names: Iterable) -> int:
        return max((depths[n][-1] for n in names if depths.get(n)), default=-1)

    def pop(names: tuple[str, ...], limit: frozenset = frozenset()) -> None:
        """Close the innermost of ``names`` unless one of ``limit`` stands inside it."""
        nonlocal link
        depth = innermost(names)
        if depth < 0 or depth < innermost(limit.difference(names)):
            return
        if bool(stack[-1][1]) != bool(depth and stack[depth - 1][1]):
            flush()
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()
        if depth <= link:
            link = -1

    def raw_end(name: str) -> tuple[int, int] | None:
        """Where the raw element that was just opened ends, if it does."""
        if name not in ends:
            pattern = r"</head\s*>|<body\b" if name == "head" else rf"</{name}(?=[\s/>])[^>]*>"
            ends[name] = [(m.start(), m.start() if m[0][1] != "/" else m.end()) for m in re.finditer(pattern, page, re.I)]
        k = bisect.bisect_left(ends[name], (at, -1))
        return ends[name][k] if k < len(ends[name]) else None

    tag = reader.after(0)
    while tag:
        read(tag.start)
        at, name = tag.end, tag.name
        if not name:
            held.append(tag.text)
        elif tag.closing:
            if name in _BLOCKS:
                flush()
            if name == "a":
                link = -1
            elif name == "br":
                held.append(" ")
            pop((name,), frozenset() if name in _BLOCKS else _SCOPES)
        elif name in _RAW and not tag.empty:
            # Of an element that never ends only code takes the rest of the page with it.
            end = raw_end(name)
            at = end[1] if end else len(page) if name in _CODE else at
        elif name == "br" or name in _VOID:
            if name in _BLOCKS:
                flush()
            held.append(" ")
        else:
            if name in _BLOCKS:
                flush()
                pop(("p",), _SCOPES)
                if name in _CLOSES:
                    pop(_CLOSES[name], frozenset(["ul", "ol", "dl", "table", "select"])
                        if name != "tr" else frozenset(["table"]))
            if name == "a":
                link = len(stack) if _has(tag.attributes, "href") or not _has(tag.attributes, "name", "id") else -1
                if coming[0] < at:
                    found = _ANCHOR.search(page, at)
                    coming = (found.start(), found[1]) if found else (len(page), "")
                loose = coming[1] != "/"
            _, bad, article, item = stack[-1] if stack else _NOWHERE
            if name in ("html", "body"):
                push(name, 0, article, item)
            else:
                if name in ("article", "main"):
                    if bad == SOFT and not article:
                        bad = 0
                    article = True
                    if _hidden(tag.attributes):
                        bad = FIRM
                else:
                    bad = max(bad, FIRM if name in _BAD_TAGS or name == "header" and not article
                              else _marked(tag.attributes, article, name in _BLOCKS))
                item = item or name == "li"
                # A slash does not close an anchor, and may belong to its address.
                if name == "a" or not tag.empty:
                    was = stack[-1] if stack else _NOWHERE
                    if name not in _BLOCKS and bool(bad) != bool(was[1]):
                        flush()
                    push(name, bad, article, item)
        tag = reader.after(at)
    read(len(page))
    flush()
    return out


def _menus(found: list[Block]) -> set[int]:
    """Places of the blocks in an article that are a menu by their shape."""
    out, run = set(), []
    for i, b in enumerate(found):
        if b.item and b.article and len(b.text) < SHORT and b.linked / len(b.text) > MANY_LINKS:
            run.append(i)
            continue
        if len(run) >= MENU:
            out.update(run)
        run = []
    return out | set(run) if len(run) >= MENU else out


def classify(found: list[Block]) -> None:
    """Label every block: first by its own words, then by its neighbours.

    On a page without any stop word the list does not know the language; there
    length and link density decide alone, and letters without spaces between
    words count for more."""
    menu = _menus(found)
    words_of = [_WORD.findall(b.text.lower()) for b in found]
    foreign = not any(w in STOP_WORDS for b, words in zip(found, words_of, strict=True) if not b.bad for w in words)
    for i, (b, words) in enumerate(zip(found, words_of, strict=True)):
        dense = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if foreign and not b.bad and words and b.linked / len(b.text) <= MANY_LINKS:
            wide = sum(map(len, words)) / len(words) >= WIDE_WORDS
            if len(b.text) >= (SHORT if wide else LONG):
                b.label = "text"
                continue
        if b.bad or b.linked / len(b.text) > MANY_LINKS and (not b.article or i in menu):
            b.label = "boilerplate"
        elif len(b.text) >= LONG and dense >= ENOUGH_STOP_WORDS or b.article and len(b.text) >= SHORT and dense > 0:
            b.label = "text"
        elif len(b.text) >= LONG and dense == 0 and not b.article and len(words) >= 20:
            b.label = "boilerplate"
    decided = [i for i, b in enumerate(found) if b.label]
    labels = [b.label for b in found]
    k = 0
    for i, b in enumerate(found):
        if b.label:
            continue
        if b.article:
            labels[i] = "text"
            continue
        while k < len(decided) and decided[k] < i:
            k += 1
        before = decided[k - 1] if k else None
        after = decided[k] if k < len(decided) else None
        if before is None and after is None:
            labels[i] = "boilerplate"
        elif before is None or after is None:
            labels[i] = found[after if before is None else before].label
        else:
            labels[i] = found[before if i - before <= after - i else after].label
    for b, label in zip(found, labels, strict=True):
        b.label = label


def main_text(page: str | None) -> str:
    """The page's text blocks in order, joined by one space."""
    found = blocks(page or "")
    classify(found)
    return " ".join(b.text for b in found if b.label == "text")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [main_text(x.as_py()) for x in some.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()),
                     pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[:2]]
    return narrow.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))
