"""A page as a flat table of elements in document order, read by one forgiving scan."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title object svg math canvas audio video noframes".split())
CODE = frozenset(["script", "style"])  # of the raw ones those that take all the rest of a page if nothing closes them
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split())
# An element that opens closes an open one of these, unless one of the second set is in between.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
_TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|/?[a-zA-Z][^>]*+>|[!?][^>]*+(?:>|\Z))", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>|</{tag}\s[^>]*>", re.I) for tag in RAW}


@dataclass
class Page:
    """Elements (all but inline, void and raw ones) in document order, and the text blocks they own."""

    tag: list[str] = field(default_factory=lambda: [""])
    attrs: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [-1])
    end: list[int] = field(default_factory=lambda: [0])  # index after the last descendant
    links: list[int] = field(default_factory=lambda: [0])  # characters of own text that are in links
    n_links: list[int] = field(default_factory=lambda: [0])
    owner: list[int] = field(default_factory=list)  # of each block
    block: list[str] = field(default_factory=list)


def parse(source: str) -> Page:
    """Element 0 is the document itself. Never fails: what is no tag is text, what is never closed ends with its parent. Raw elements (pictures, players, code and the
    like, with whatever they say to browsers that don't know them) are left out up to their end tag; without one only script and style take the rest of the page.

    Every tag costs a fixed number of steps, whatever is open: the open elements are a stack, with the places of each name, of
    those that shape the page and of those that end a search in stacks of their own; an inline element that ends stays in its place without a name.
    """
    page = Page()
    tag, attrs, parent, end, links, n_links = page.tag, page.attrs, page.parent, page.end, page.links, page.n_links
    names, nodes = [""], [0]  # open elements, inline ones included: name, and element they belong to
    places: dict[str, list[int]] = {}  # of open elements, by name
    shaping, strong = [0], [0]  # places of open elements that aren't inline; and of those that are neither p nor div
    pieces: list[str] = []
    in_link = 0
    endless: set[str] = set()  # raw elements that nothing closes any more
    at = 0
    tags_end = source.rfind(">") + 1

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                page.owner.append(nodes[-1])
                page.block.append(text)

    def say(text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                links[nodes[-1]] += len(text.strip())

    def pop(to: int) -> None:
        nonlocal in_link
        flush()
        for k in range(len(names) - 1, to - 1, -1):
            name = names[k]
            if name == "a":
                in_link -= 1
            elif name not in INLINE and name is not None:
                end[nodes[k]] = len(tag)
            if name and name in places:
                places[name].pop()
        del names[to:], nodes[to:]
        for stack in (shaping, strong):
            while stack and stack[-1] >= to:
                stack.pop()

    while at < tags_end and (m := _TOKEN.search(source, at, tags_end)):
        if m.start() > at:
            say(source[at : m.start()])
        at = m.end()
        if at == tags_end and source.startswith("<!--", m.start()) and not m[0].endswith("-->"):
            at = len(source)  # a comment that never ends
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            held = places.get(name)
            if name in INLINE:
                if held and held[-1] > shaping[-1]:
                    names[held.pop()] = None
                    if name == "a":
                        in_link -= 1
            elif name not in ("body", "html"):
                if held:
                    pop(held[-1])
                else:
                    flush()
            continue
        if name in RAW and name not in endless:
            if m[3].endswith("/"):
                continue
            close = _RAW_END[name].search(source, at)
            if close or name in CODE:
                at = close.end() if close else len(source)
                continue
            endless.add(name)  # from here on an element like any other
        if name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name not in INLINE:
                flush()
            continue
        if name in INLINE:
            if name == "a":
                in_link += 1
                n_links[nodes[-1]] += 1
            places.setdefault(name, []).append(len(names))
            names.append(name)
            nodes.append(nodes[-1])
            continue
        if name in CLOSES_P and names[shaping[-1]] == "p":
            pop(shaping[-1])
        if name in IMPLIED:
            closes, fence = IMPLIED[name]
            last = 0
            for k in reversed(strong):
                if k == 0 or names[k] in fence or names[k] not in closes:
                    break
                last = k
            if last:
                pop(last)
        flush()
        parent.append(nodes[-1])
        places.setdefault(name, []).append(len(names))
        shaping.append(len(names))
        if name not in ("p", "div"):
            strong.append(len(names))
        names.append(name)
        nodes.append(len(tag))
        tag.append(name)
        attrs.append(m[3])
        end.append(0)
        links.append(0)
        n_links.append(0)
    if at < len(source):  # no tag ends here any more; a comment or a declaration that begins takes all the rest
        say(re.split(r"<[!?]", source[at:], maxsplit=1)[0])
    pop(0)
    end[0] = len(tag)
    return page
