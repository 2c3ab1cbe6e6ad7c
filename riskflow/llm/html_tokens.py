"""Tags of a web page by the attribute states of the HTML standard's tokenizer.

A quote opens a quoted value only right after ``=``; a value without quotes ends
at white space or ``>``, so an apostrophe inside it is a letter like any other.
Every character is looked at a bounded number of times, whatever the page holds:
the places of the last ``>`` and of the last quotes tell at once that a tag or a
value has no end.  A page that ends inside a tag is read again from that tag on
with every tag ending at its first ``>``, which the standard would drop.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[^\s/>]+")
_GAP = re.compile(r"[\s/]*")
_KEY = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")


class Tag(NamedTuple):
    """A tag, or a comment or declaration (empty name); ``text`` is character data that stands for itself."""
    start: int
    end: int
    name: str
    closing: bool
    attributes: tuple
    empty: bool          # ends with a slash
    text: str = ""


class Tags:
    """The tags of one page, asked for from a place on."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.quotes = {q: page.rfind(q) for q in "\"'"}
        self.quoted = True            # until a tag has run to the end of the page

    def after(self, at: int) -> Tag | None:
        """The next tag that starts at or behind ``at``."""
        page = self.page
        found = _OPEN.search(page, at)
        while found:
            start = found.start()
            mark = page[start + 1]
            if mark == "!" or mark == "?" or mark == "/" and not page[start + 2:start + 3].isalpha():
                return self._declaration(start)
            if self.last < start:
                return Tag(start, len(page), "", False, (), False)      # cut off: no tag ends any more
            closing = mark == "/"
            name = _NAME.match(page, start + 1 + closing)
            if not name[0].isascii() and not name[0][0].isascii():
                found = _OPEN.search(page, start + 1)
                continue
            return self._tag(start, name, closing)
        return None

    def _declaration(self, start: int) -> Tag:
        page = self.page
        for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>")):
            if page.startswith(opening, start):
                end = page.find(closing, start + len(opening))
                inside = page[start + len(opening):end if end >= 0 else len(page)] if opening != "<!--" else ""
                return Tag(start, end + len(closing) if end >= 0 else len(page), "", False, (), False, inside)
        end = page.find(">", start)
        return Tag(start, end + 1 if end >= 0 else len(page), "", False, (), False)

    def _tag(self, start: int, name: re.Match, closing: bool) -> Tag:
        page, at, attributes = self.page, name.end(), []
        while self.quoted:
            gap = _GAP.match(page, at)
            at = gap.end()
            if at >= len(page):
                self.quoted = False
                break
            if page[at] == ">":
                return Tag(start, at + 1, name[0].lower(), closing, tuple(attributes), page[at - 1] == "/")
            key = _KEY.match(page, at)
            at = key.end()
            equals = _EQUALS.match(page, at)
            value = ""
            if equals:
                at = equals.end()
                quote = page[at:at + 1]
                if quote in ("\"", "'") and self.quotes[quote] > at:
                    end = page.index(quote, at + 1)
                    value, at = page[at + 1:end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0], bare.end()
            attributes.append((key[0].lower(), value))
        end = page.find(">", name.end())
        inside = page[name.end():end]
        pairs = tuple((k.lower(), v.strip("\"'")) for k, _, v in (part.partition("=") for part in inside.split()))
        return Tag(start, end + 1, name[0].lower(), closing, pairs, inside.endswith("/"))


def tags(page: str) -> Iterator[Tag]:
    """All tags of a page in order."""
    reader = Tags(page)
    tag = reader.after(0)
    while tag:
        yield tag
        tag = reader.after(tag.end)
