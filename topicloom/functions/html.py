"""Text and references of wiki pages, as Arrow UDFs over a small tree."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.text import CITATION, NOTICES

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi big code em font i kbd mark q s samp small span strike strong sub sup tt u var".split())
#: Elements without article text, and sections whose headings go.
DROPPED = frozenset(("math", "ref", "nowiki", "cite"))
CLOSING = frozenset(("See_also", "Bibliography", "External_links"))
_CITATION, _NOTICE = re.compile(CITATION), re.compile("|".join(NOTICES), re.IGNORECASE)


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: "Node | None" = None
    parts: list = field(default_factory=list)  # nodes and strings

    def walk(self):
        for p in self.parts:
            if isinstance(p, Node):
                yield p
                yield from p.walk()

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            p = todo.pop()
            if isinstance(p, Node):
                todo.extend(reversed(p.parts))
            else:
                out.append(p)
        return "".join(out)

    def drop(self, which) -> None:
        self.parts = [p for p in self.parts if not (isinstance(p, Node) and which(p))]
        for p in self.parts:
            if isinstance(p, Node):
                p.drop(which)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        if tag == "p":  # a paragraph ends where another begins, whatever inline elements are still open in it
            up = self.at
            while up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                self.at = up.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.parts.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def tree(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def _clean(text: str) -> str:
    return _NOTICE.sub("", _CITATION.sub("", text))


def page_text(page: str | None, section: str | None = None) -> tuple[str, list[int]]:
    """(text, cited note numbers): the paragraphs of a page, or one section with the notes it cites."""
    root = tree(page or "")
    if section:
        found = None
        if section == "(Top)":
            found = next((n for n in root.walk() if n.tag == "section" and n.attrs.get("data-mw-section-id") == "0"), None)
        else:
            for tag in ("h2", "h3"):
                head = next((n for n in root.walk() if n.tag == tag and n.attrs.get("id") == section), None)
                if head is not None:
                    found = head.parent
                    break
        if found is not None:
            found.drop(lambda n: n.tag in ("script", "style"))
            text = found.text()
            notes = sorted({int(c.strip("[]")) for c in _CITATION.findall(text)})
            return _clean(text.strip()), notes
    root.drop(
        lambda n: n.tag in DROPPED
        or (n.tag == "span" and "mw-reflink-text" in n.attrs.get("class", ""))
        or (n.tag == "h2" and n.attrs.get("id") in CLOSING)
    )
    return _clean("\n".join(n.text() for n in root.walk() if n.tag == "p").strip()), []


def _note(node: Node | None) -> int | None:
    """The number of the note around a link: the end of the nearest span or li with an id."""
    while node is not None:
        if node.tag in ("span", "li") and "id" in node.attrs:
            tail = node.attrs["id"].rpartition("-")[2]
            return int(tail) if tail.isdigit() else None
        node = node.parent
    return None


def reference_urls(page: str | None, notes: list[int] | None = None) -> list[str]:
    """Outside links of a page's references, each once, in order of letters; with `notes` those of these notes."""
    found = set()
    for n in tree(page or "").walk():
        if n.tag != "a" or "href" not in n.attrs or n.attrs["href"].startswith("./"):
            continue
        up = n.parent
        while up is not None and not (up.tag == "span" and "reference-text" in up.attrs.get("class", "")):
            up = up.parent
        if up is not None and (not notes or _note(up) in notes):
            found.add(n.attrs["href"])
    return sorted(found)


def links(page: str | None) -> list[str]:
    """Every link of a page, each once, in order of letters."""
    return sorted({n.attrs["href"] for n in tree(page or "").walk() if n.tag == "a" and "href" in n.attrs})


def _text(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: page_text(p)[0])


def _sections(pages: pd.Series, sections: pd.Series) -> pd.DataFrame:
    rows = [page_text(p, s) for p, s in zip(pages, sections, strict=True)]
    return pd.DataFrame({"text": [r[0] for r in rows], "notes": [r[1] for r in rows]})


def _urls(pages: pd.Series) -> pd.Series:
    return pages.map(reference_urls)


def _noted_urls(pages: pd.Series, notes: pd.Series) -> pd.Series:
    return pd.Series([reference_urls(p, None if n is None else list(n)) for p, n in zip(pages, notes, strict=True)])


def _links(pages: pd.Series) -> pd.Series:
    return pages.map(links)


def html_text(html: Column) -> Column:
    return F.pandas_udf(_text, "string")(html)


def html_section(html: Column, section: Column) -> Column:
    return F.pandas_udf(_sections, "text string, notes array<int>")(html, section)


def html_reference_urls(html: Column, notes: Column | None = None) -> Column:
    if notes is None:
        return F.pandas_udf(_urls, "array<string>")(html)
    return F.pandas_udf(_noted_urls, "array<string>")(html, notes)


def html_links(html: Column) -> Column:
    return F.pandas_udf(_links, "array<string>")(html)
