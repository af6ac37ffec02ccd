"""A small element tree of an HTML page, and selectors over it.

Selectors are compounds of a tag, ``#id``, ``.class``, ``[attr]`` or ``[class$=suffix]``, joined by blanks
(somewhere below) or `` > `` (directly below).  End tags without a start are ignored; nothing is closed
implicitly except by the end of an element around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
HEADING = re.compile("h[1-6]")


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    @property
    def is_heading(self) -> bool:
        return HEADING.fullmatch(self.tag) is not None

    def elements(self) -> Iterator[Element]:
        """Elements directly below."""
        return (x for x in self.children if isinstance(x, Element))

    def below(self) -> Iterator[Element]:
        """All elements below, in document order."""
        stack = [self.elements()]
        while stack:
            for x in stack[-1]:
                yield x
                stack.append(x.elements())
                break
            else:
                stack.pop()

    def above(self) -> Iterator[Element]:
        x = self.parent
        while x is not None:
            yield x
            x = x.parent

    def after(self) -> Iterator[Element]:
        """Elements that follow under the same parent."""
        rows = list(self.parent.elements()) if self.parent else []
        return iter(rows[rows.index(self) + 1 :] if rows else [])

    def strings(self, without: Element | None = None, breaks: bool = False) -> Iterator[str]:
        """Texts inside, without those of scripts and of ``without``; with ``breaks``, br is a line's end."""
        stack: list = [iter(self.children)]
        while stack:
            for x in stack[-1]:
                if isinstance(x, str):
                    yield x
                elif breaks and x.tag == "br":
                    yield "\n"
                elif x is not without and x.tag not in SILENT:
                    stack.append(iter(x.children))
                    break
            else:
                stack.pop()

    def select(self, selector: str) -> list[Element]:
        steps = _steps(selector)
        return [x for x in self.below() if _fits(x, steps, len(steps) - 1)]

    def first(self, selector: str) -> Element | None:
        steps = _steps(selector)
        return next((x for x in self.below() if _fits(x, steps, len(steps) - 1)), None)

    def closest(self, selector: str) -> Element | None:
        steps = _steps(selector)
        return next((x for x in self.above() if _fits(x, steps, len(steps) - 1)), None)


@lru_cache(1024)
def _steps(selector: str) -> tuple:
    """(directly below?, tag, id, classes, attributes, suffix of a class) of each compound."""
    out, direct = [], False
    for part in selector.split():
        if part == ">":
            direct = True
            continue
        names = re.findall(r"\.([\w-]+)", part.partition("[")[0])
        own = re.search(r"#([^.\[]+)", part)
        attrs = tuple((k, v) for k, v in re.findall(r"\[([\w:-]+)(?:=([^\]]+))?\]", part))
        suffix = re.search(r"\[class\$=([^\]]+)\]", part)
        out.append((direct, re.match(r"[\w]*", part)[0], own and own[1], names, attrs, suffix and suffix[1]))
        direct = False
    return tuple(out)


def _fits(x: Element, steps: tuple, at: int) -> bool:
    direct, tag, own, names, attrs, suffix = steps[at]
    if (tag and x.tag != tag) or (own and x.attrs.get("id") != own) or any(n not in x.classes for n in names):
        return False
    if any(k not in x.attrs or (v and x.attrs[k] != v) for k, v in attrs) or (suffix and not any(c.endswith(suffix) for c in x.classes)):
        return False
    if at == 0:
        return True
    above = [x.parent] if direct else x.above()
    return any(y is not None and _fits(y, steps, at - 1) for y in above)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)
        self.open: list[Element] = [self.root]

    def handle_starttag(self, tag, attrs):
        x = Element(tag, {}, self.open[-1])
        for k, v in attrs:
            x.attrs[k] = v or ""
        self.open[-1].children.append(x)
        if tag not in VOID:
            self.open.append(x)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parsed(page: str | None) -> Element:
    """The root above all elements of a page; null is an empty page."""
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.root


def line(x: Element | None) -> str | None:
    """Text in one line, a blank between its parts; null where there is none."""
    return " ".join(" ".join(x.strings()).split()) or None if x is not None else None


def lines(x: Element | None, without: Element | None = None) -> str | None:
    """Text with the line ends that br and the source have, other blanks collapsed; null where there is none."""
    if x is None:
        return None
    whole = "".join(x.strings(without, True)).replace("\xa0", " ")
    rows = (re.sub(r"[ \t\r\f\v]+", " ", r).strip(" ") for r in whole.split("\n"))
    return "\n".join(r for r in rows if r).strip() or None
