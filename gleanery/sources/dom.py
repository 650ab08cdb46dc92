"""A small element tree over the standard HTML parser, with the selectors that reads need."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))
_WS = re.compile(r"\s+")


class Node:
    """An element. Elements are numbered in document order, so that those below one are a slice."""

    __slots__ = ("tag", "attrs", "children", "parent", "order", "at", "end")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.order: list[Node] = []
        self.at = self.end = 0

    def elements(self) -> list[Node]:
        """All elements below, in document order."""
        return self.order[self.at + 1 : self.end]

    def strings(self) -> Iterator[str]:
        """Stripped, non-empty texts below, in document order; not those of scripts and styles."""
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                if x := _WS.sub(" ", x).strip():
                    yield x
            elif x.tag not in _HIDDEN:
                stack.extend(reversed(x.children))

    def text(self) -> str | None:
        return " ".join(self.strings()) or None

    def raw(self) -> str:
        return "".join(x for x in self.children if isinstance(x, str))

    def named(self, tag: str) -> list[Node]:
        return [x for x in self.elements() if x.tag == tag]

    def _fitting(self, group) -> Iterator[Node]:
        """The elements below that a chain selects, in order; only those are tried that have what its last step asks for."""
        names, key, tests, chain = group
        found = self.elements() if key is None else self.order.having(names, key)
        at, end = self.at, self.end
        for x in found:
            if at < x.at < end and all(test(x) for test in tests) and (len(chain) == 1 or _matches(x, chain)):
                yield x

    def select(self, selector: str) -> list[Node]:
        groups = compiled(selector)
        if len(groups) == 1:
            return list(self._fitting(groups[0]))
        found = {x.at: x for g in groups for x in self._fitting(g)}
        return [found[at] for at in sorted(found)]

    def first(self, selector: str) -> Node | None:
        found = (next(self._fitting(g), None) for g in compiled(selector))
        return min((x for x in found if x is not None), key=lambda x: x.at, default=None)

    def is_last_child(self) -> bool:
        return self.parent is not None and next(x for x in reversed(self.parent.children) if isinstance(x, Node)) is self


class _Order(list):
    """A tree's elements in document order, and by tag and attribute once these are asked for."""

    __slots__ = ("tags", "attributes")

    def having(self, names: str, key: str) -> list[Node]:
        if not hasattr(self, "tags"):
            self.tags, self.attributes = {}, {}
            for x in self:
                self.tags.setdefault(x.tag, []).append(x)
                for name in x.attrs:
                    self.attributes.setdefault(name, []).append(x)
        return getattr(self, names).get(key, ())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        x = self.at
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None and x.parent is not None:
            self.at = x.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; malformed input gives what could be read of it."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    _number(builder.root)
    return builder.root


def _number(root: Node) -> None:
    order = _Order()
    stack = [root]
    while stack:
        x = stack.pop()
        x.at, x.order = len(order), order
        order.append(x)
        stack.extend(c for c in reversed(x.children) if isinstance(c, Node))
    for x in reversed(order):  # children have their ends before their parent
        last = next((c for c in reversed(x.children) if isinstance(c, Node)), None)
        x.end = x.at + 1 if last is None else last.end


_STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*|\*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$~]?=)['\"]?(?P<val>[^'\"\]]*)['\"]?)?\]|(?P<last>:last-child)")
_TESTS = {
    None: lambda have, want: True, "=": lambda have, want: have == want, "*=": lambda have, want: want != "" and want in have,
    "^=": lambda have, want: want != "" and have.startswith(want), "$=": lambda have, want: want != "" and have.endswith(want),
    "~=": lambda have, want: want in have.split(),
}


def _compound(text: str):
    """(index, key, tests): what an element must have to be tried, an attribute or else a tag, and the tests."""
    tests, at, names, key = [], 0, None, None
    while at < len(text):
        m = _STEP.match(text, at)
        if not m:
            raise ValueError(f"unsupported selector: {text!r}")
        at = m.end()
        if m["tag"]:
            tests.append(lambda n, t=m["tag"].lower(): t == "*" or n.tag == t)
            if m["tag"] != "*" and key is None:
                names, key = "tags", m["tag"].lower()
        elif m["cls"]:
            tests.append(lambda n, c=m["cls"]: c in n.attrs.get("class", "").split())
            names, key = "attributes", "class"
        elif m["id"]:
            tests.append(lambda n, i=m["id"]: n.attrs.get("id") == i)
            names, key = "attributes", "id"
        elif m["last"]:
            tests.append(Node.is_last_child)
        else:
            tests.append(lambda n, a=m["attr"].lower(), f=_TESTS[m["op"]], v=m["val"]: a in n.attrs and f(n.attrs[a], v))
            names, key = "attributes", m["attr"].lower()
    return names, key, tests


def _split_outside(text: str, sep: str) -> list[str]:
    return [x for x in re.split(sep + r"(?![^\[]*\])", text.strip()) if x]


@lru_cache(maxsize=256)
def compiled(selector: str):
    """Comma groups: what is tried, the tests of the last step, and the descendant chain of all steps' tests."""
    groups = [[_compound(step) for step in _split_outside(group, r"\s+")] for group in _split_outside(selector, r"\s*,\s*")]
    return [(*steps[-1], [tests for _, _, tests in steps]) for steps in groups]


def _matches(node: Node, chain) -> bool:
    """Whether a node that fits the last step stands below nodes that fit the others."""
    at, wanted = node.parent, len(chain) - 2
    while wanted >= 0 and at is not None:
        if all(test(at) for test in chain[wanted]):
            wanted -= 1
        at = at.parent
    return wanted < 0
