"""An element tree over the standard parser, selectors compiled once, and microdata scopes.

Broken markup does not lose text: a stray end tag is ignored, an end tag closes what is still open inside it, void
elements never open, and list items, cells and paragraphs close one another as browsers do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks, what a new element closes if it is still open, and elements within a line, which part no words.
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {b: ("p",) for b in BLOCKS} | {"li": ("li", "p"), "option": ("option",), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr")}
INLINE = frozenset("a abbr b bdi bdo cite code dfn em font i kbd mark q s small span strong sub sup u var wbr".split())


class Element:
    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order, without recursion: markup may nest deeply."""
        rest = [p for p in reversed(self.parts) if isinstance(p, Element)]
        while rest:
            e = rest.pop()
            yield e
            rest += [p for p in reversed(e.parts) if isinstance(p, Element)]

    def text(self) -> str:
        """Everything written below, white space collapsed; block elements and line breaks part words, scripts are left out."""
        out, rest = [], [self]
        while rest:
            e = rest.pop()
            if isinstance(e, str):
                out.append(e)
            elif e.tag not in ("script", "style"):
                gap = [] if e.tag in INLINE else [" "]
                rest += gap + e.parts[::-1] + gap
        return " ".join("".join(out).split())

    def lines(self) -> list[str]:
        """The text nodes below that are not blank, each with its white space collapsed."""
        out, rest = [], [self]
        while rest:
            e = rest.pop()
            if isinstance(e, str):
                out += [" ".join(e.split())] if e.strip() else []
            elif e.tag not in ("script", "style"):
                rest += e.parts[::-1]
        return out


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.at.tag in CLOSES.get(tag, ()):
            self.at = self.at.parent
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.parts.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        e = self.at
        within = tag in INLINE or tag == "p"  # these do not end what a block around them is part of
        while e.parent is not None and e.tag != tag and not (within and e.tag in BLOCKS):
            e = e.parent
        if e.parent is not None and e.tag == tag:
            self.at = e.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def parse(html: str | None) -> Element:
    """The root of a page, whole."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_STEP = re.compile(r"""\s*(>)?\s*([\w-]+|\*)?((?:[.#][\w-]+|\[[^\]]*\])*)""")
_TEST = re.compile(r"""([.#])([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$]?=)\s*["']?([^"'\]]*)["']?)?\s*\]""")
_COMPARE = {"=": str.__eq__, "*=": str.__contains__, "^=": str.startswith, "$=": str.endswith}


@lru_cache(1000)
def compiled(selector: str) -> tuple:
    """Alternatives of a selector: steps from the last to the first, each (tag, tests, whether it must be a direct child).

    Tags, classes, ids, attributes with = *= ^= $=, descendants, children and commas are known; anything else is an error."""
    out = []
    for one in re.split(r",(?![^\[]*\])", selector):
        steps, at, one = [], 0, one.strip()
        while at < len(one):
            m = _STEP.match(one, at)
            if m.end() == at or not (m[2] or m[3]):
                raise ValueError(f"selector {selector!r} is not understood at {one[at:]!r}")
            tests = [("class" if t[1] == "." else "id" if t[1] else t[3].lower(), "~=" if t[1] == "." else "=" if t[1] else t[4], t[2] or t[5]) for t in _TEST.finditer(m[3])]
            steps.append((m[2] if m[2] != "*" else None, tuple(tests), m[1] == ">"))
            at = m.end()
        out.append(tuple(reversed(steps)))
    return tuple(out)


def _fits(e: Element, tag: str | None, tests: tuple) -> bool:
    if tag and e.tag != tag:
        return False
    for name, how, value in tests:
        held = e.attrs.get(name)
        if held is None or how and not (value in held.split() if how == "~=" else _COMPARE[how](held, value)):
            return False
    return True


def matches(e: Element, steps: tuple, within: Element) -> bool:
    """Whether an element below ``within`` fits a compiled alternative; ancestors are looked for up to the root."""
    tag, tests, direct = steps[0]
    if not _fits(e, tag, tests):
        return False
    above = e.parent
    if len(steps) == 1:
        return not direct or above is within
    while above is not None and above.parent is not None:
        if matches(above, steps[1:], within):
            return True
        above = None if direct else above.parent
    return False


def found(within: Element, selectors: dict[str, str]) -> dict[str, list[Element]]:
    """The elements below that fit each named selector, in document order, from one walk."""
    plans = {name: compiled(s) for name, s in selectors.items()}
    out: dict[str, list[Element]] = {name: [] for name in selectors}
    for e in within.walk():
        for name, plan in plans.items():
            if any(matches(e, steps, within) for steps in plan):
                out[name].append(e)
    return out


def scopes(root: Element) -> list[dict]:
    """Microdata items in document order: kind, the number of the item they are part of (or None) and as which property,
    and the values of their own properties.  An itemprop belongs to the innermost itemscope around it; one that opens a
    scope itself names it in the scope outside."""
    out: list[dict] = []
    rest: list[tuple[Element, int | None]] = [(root, None)]
    while rest:
        e, inside = rest.pop()
        opens, names = "itemscope" in e.attrs, e.attrs.get("itemprop", "").split()
        if names and inside is not None and not opens:
            value = e.attrs.get("content", e.attrs.get("href", e.attrs.get("src", ""))) if e.tag in VOID | {"a"} or "content" in e.attrs else e.text()
            for name in names:
                out[inside]["values"].setdefault(name, []).append(value.strip())
        if opens:
            out.append({"kind": e.attrs.get("itemtype", ""), "parent": inside, "prop": " ".join(names), "values": {}})
            inside = len(out) - 1
        rest += [(p, inside) for p in reversed(e.parts) if isinstance(p, Element)]
    return out
