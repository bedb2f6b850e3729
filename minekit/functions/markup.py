"""A page as a light tree, with tag, class, id, attribute and descendant selectors."""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = ("script", "style", "template")
_STEP = re.compile(r"([a-zA-Z][\w-]*|\*)|\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\]")


_SPACE = re.compile(r"\s+(?![^\[]*\])")


class Node:
    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    def walk(self):
        """Elements below this one in page order."""
        stack = [p for p in reversed(self.parts) if isinstance(p, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))

    def strings(self):
        stack = list(reversed(self.parts))
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                yield part
            elif part.tag not in HIDDEN:
                stack.extend(reversed(part.parts))

    def text(self, joiner: str, strip: bool) -> str:
        parts = (s.strip() for s in self.strings()) if strip else self.strings()
        return joiner.join(p for p in parts if p)

    def select(self, selector: str) -> list[Node]:
        steps = selector_steps(selector)
        return [n for n in self.walk() if _fits(n, steps[-1]) and _inside(n, steps[:-1])]

    def release(self) -> None:
        """Forget the parents below this node, so that the tree goes as soon as nobody holds it."""
        for node in self.walk():
            node.parent = None


_STEPS: dict[str, list[list[tuple[str, ...]]]] = {}


def selector_steps(selector: str) -> list[list[tuple[str, ...]]]:
    """The descendant steps of a selector; anything else than tag, class, id and attribute tests is an error."""
    if selector in _STEPS:
        return _STEPS[selector]
    parts = _SPACE.split(selector.strip())
    for part in parts:
        if not part or _STEP.sub("", part):
            raise ValueError(f"selector not supported: {selector!r}")
    if len(_STEPS) >= 256:
        _STEPS.clear()
    _STEPS[selector] = [_STEP.findall(part) for part in parts]
    return _STEPS[selector]


def _fits(node: Node, step) -> bool:
    for tag, cls, name, attr, value in step:
        if tag and tag != "*" and node.tag != tag.lower():
            return False
        if cls and cls not in (node.attrs.get("class") or "").split():
            return False
        if name and node.attrs.get("id") != name:
            return False
        if attr and (attr not in node.attrs or (value and node.attrs[attr] != value)):
            return False
    return bool(step)


def _inside(node: Node, steps) -> bool:
    above = node.parent
    for step in reversed(steps):
        while above is not None and not _fits(above, step):
            above = above.parent
        if above is None:
            return False
        above = above.parent
    return True


#: Start tags that mean the same wherever they stand: names, and values in double quotes without references.
_PLAIN_TAG = re.compile(r"""<[a-zA-Z][a-zA-Z0-9]*(?:[ \n][a-zA-Z][a-zA-Z-]*="[^"<>&]*")*>""")
_PLAIN_PART = re.compile(r"""<([a-zA-Z0-9]+)|[ \n]([a-zA-Z-]+)="([^"]*)\"""")
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
_TAGS: dict[str, tuple[str, list[tuple[str, str]]]] = {}


class TolerantParser(HTMLParser):
    """The standard parser, with marked sections that it does not know (`<![x[`) read as comments up to the next `>`.
    It keeps no line numbers, and remembers what plainly written start tags say."""

    def updatepos(self, i, j):
        return j

    def parse_starttag(self, i):
        end = self.rawdata.find(">", i) + 1
        written = self.rawdata[i:end]
        known = _TAGS.get(written)
        if known is None:
            if not _PLAIN_TAG.fullmatch(written):
                return super().parse_starttag(i)
            name, *attrs = _PLAIN_PART.findall(written)
            known = name[0].lower(), [(key.lower(), value) for _, key, value in attrs]
            if known[0] in self.CDATA_CONTENT_ELEMENTS:
                return super().parse_starttag(i)
            if len(_TAGS) >= 4096:
                _TAGS.clear()
            _TAGS[written] = known
        self.lasttag = known[0]
        self.handle_starttag(known[0], list(known[1]))
        return end

    def parse_endtag(self, i):
        plain = _PLAIN_END.match(self.rawdata, i)
        if plain is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1].lower())
        return plain.end()

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)


class _Builder(TolerantParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.parts.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        above = self.at
        while above.parent is not None and above.tag != tag:
            above = above.parent
        if above.parent is not None:  # an end tag without its start is ignored
            self.at = above.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def pick(block: Node, spec: dict):
    """The value a field describes inside a block."""
    found = block.select(spec["selector"])
    if not found:
        return spec.get("default")
    attr = spec.get("attr", "text")
    if attr == "text":
        return found[0].text(" ", spec.get("strip", True))
    return found[0].attrs.get(attr, spec.get("default"))
