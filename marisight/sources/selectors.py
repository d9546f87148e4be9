"""Selectors over the nodes of a page: names, ids, classes, attributes, places among siblings, and the combinators
descendant, ``>``, ``+`` and ``~``; commas give alternatives.

A selector compiles to chains of steps, and every step of every selector to one bit.  Nodes are met in document
order, and a node's bits follow from those of its parent, its ancestors together, its previous sibling and its
earlier siblings together, so all selectors are matched in one pass, whose cost doesn't depend on depth.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""\s*(?P<comma>,)\s*|\s*(?P<joint>[>+~])\s*|(?P<space>\s+)|\#(?P<id>[\w-]+)|\.(?P<css>[\w-]+)
    |\[\s*(?P<attribute>[\w-]+)\s*(?:(?P<how>[*^$~|]?)=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\]\s]*))\s*)?\]
    |:(?P<place>first-child|last-child|first-of-type|nth-child|nth-of-type)(?:\((?P<n>\d+)\))?|(?P<tag>[\w-]+|\*)""",
    re.VERBOSE,
)
_TESTS = {
    "": lambda have, want: have == want,
    "*": lambda have, want: bool(want) and want in have,
    "^": lambda have, want: bool(want) and have.startswith(want),
    "$": lambda have, want: bool(want) and have.endswith(want),
    "~": lambda have, want: want in have.split(),
    "|": lambda have, want: have == want or have.startswith(want + "-"),
}


@dataclass
class Step:
    """What one node has to be, and how it is joined to the step before ('' for the first)."""

    joint: str = ""
    tag: str = "*"
    ids: list[str] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    attributes: list[tuple[str, str | None, str]] = field(default_factory=list)
    places: list[tuple[str, int]] = field(default_factory=list)
    empty: bool = True

    def test(self, node) -> bool:
        return self.fits(node) and (not self.places or self.placed(node))

    def fits(self, node) -> bool:
        """Whether the node's classes and attributes are those asked for."""
        for css in self.classes:
            if css not in node.classes:
                return False
        for i in self.ids:
            if node.attrs.get("id") != i:
                return False
        for name, how, want in self.attributes:
            have = node.attrs.get(name)
            if have is None or how is not None and not _TESTS[how](have, want):
                return False
        return True

    def placed(self, node) -> bool:
        return all(node.last_child if place == "last-child" else (node.nth_of_type if place.endswith("of-type") else node.nth) == n for place, n in self.places)


def compiled(selector: str) -> list[list[Step]]:
    """The chains of a selector's alternatives."""
    chains, at, text = [[Step()]], 0, selector.strip()

    def follow(joint: str) -> None:
        if chains[-1][-1].empty:
            raise ValueError(f"nothing stands before a combinator in {selector!r}")
        chains[-1].append(Step(joint))

    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"{selector!r} isn't understood at {text[at:]!r}")
        at, kind = m.end(), m.lastgroup
        step = chains[-1][-1]
        if m["comma"]:
            chains.append([Step()])
        elif m["joint"]:
            follow(m["joint"])
        elif m["space"]:
            follow(" ")
        elif m["id"]:
            step.ids.append(m["id"])
        elif m["css"]:
            step.classes.append(m["css"])
        elif m["attribute"]:
            step.attributes.append((m["attribute"].lower(), m["how"], next((x for x in (m["a"], m["b"], m["c"]) if x is not None), "")))
        elif m["place"]:
            step.places.append((m["place"], int(m["n"] or 1)))
        elif kind == "tag":
            step.tag = m["tag"].lower()
        if not (m["comma"] or m["joint"] or m["space"]):
            step.empty = False
    if any(chain[-1].empty for chain in chains):
        raise ValueError(f"a part of {selector!r} is empty")
    return chains


class Matcher:
    """Matches several named selectors at once."""

    def __init__(self, selectors: dict[str, str]):
        self.by_tag: dict[str, list[tuple[int, int, Step]]] = {}
        self.ends: list[tuple[int, str]] = []  # the bits that end a selector
        self._known: dict[str, tuple[tuple[int, int, str, Step], ...]] = {}
        self._looks: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {}
        self._named: dict[int, list[str]] = {}
        self._fits: dict[tuple, tuple[tuple[int, int, str, Step], ...]] = {}
        bit = 1
        for name, selector in selectors.items():
            for chain in compiled(selector):
                before = 0
                for step in chain:
                    self.by_tag.setdefault(step.tag, []).append((bit, before, step))
                    before, bit = bit, bit << 1
                self.ends.append((before, name))
        places = {place for steps in self.by_tag.values() for _, _, step in steps for place, _ in step.places}
        self.looks_ahead = "last-child" in places  # a start tag alone doesn't tell
        self.counts_kinds = any(place.endswith("of-type") for place in places)
        self.last_bits = 0
        for end, _ in self.ends:
            self.last_bits |= end

    def steps(self, tag: str) -> tuple[tuple[int, int, str, Step], ...]:
        """The steps that an element of this name may match: (bit, bit before it, joint, step)."""
        if (known := self._known.get(tag)) is None:
            known = tuple((bit, before, step.joint, step) for bit, before, step in (*self.by_tag.get(tag, ()), *self.by_tag.get("*", ())))
            if len(self._known) < 1000:  # pages may make names up
                self._known[tag] = known
        return known

    def fitting(self, tag: str, node) -> tuple[tuple[int, int, str, Step], ...]:
        """Those of the steps that the element's classes and attributes fit; elements that are alike in what the steps
        look at are tested once."""
        if (looks := self._looks.get(tag)) is None:
            steps = [step for _, _, _, step in self.steps(tag)]
            values = {name for step in steps for name, how, _ in step.attributes if how is not None} | {"class" for step in steps if step.classes} | {"id" for step in steps if step.ids}
            looks = tuple(sorted(values)), tuple(sorted({name for step in steps for name, how, _ in step.attributes if how is None} - values))
            if len(self._looks) < 1000:
                self._looks[tag] = looks
        have = node.attrs
        key = (tag, *map(have.get, looks[0]), *[name in have for name in looks[1]]) if have else tag
        if (found := self._fits.get(key)) is None:
            found = tuple(entry for entry in self.steps(tag) if entry[3].fits(node))
            if len(self._fits) < 4096 and (not have or sum(len(have.get(name) or "") for name in looks[0]) <= 256):
                self._fits[key] = found
        return found

    def named(self, bits: int) -> list[str]:
        """The names whose selectors end in one of these bits."""
        if not (bits := bits & self.last_bits):
            return []
        if (known := self._named.get(bits)) is None:
            known = list(dict.fromkeys(name for bit, name in self.ends if bits & bit))
            if len(self._named) < 4096:
                self._named[bits] = known
        return known

    def names(self, nodes: list) -> list[list[str]]:
        """Per node, the names whose selectors match it; nodes are in document order."""
        own, above, left = [], [], []  # bits of each node; of it and its ancestors; of it and its earlier siblings
        out = []
        every = self.by_tag.get("*", [])
        for node in nodes:
            up, back = node.parent, node.previous
            bits = 0
            for bit, before, step in (*self.by_tag.get(node.tag, ()), *every):
                if before:
                    if step.joint == " ":
                        known = above[up.pos] if up else 0
                    elif step.joint == ">":
                        known = own[up.pos] if up else 0
                    elif step.joint == "+":
                        known = own[back.pos] if back else 0
                    else:
                        known = left[back.pos] if back else 0
                    if not known & before:
                        continue
                if step.test(node):
                    bits |= bit
            own.append(bits)
            above.append(bits | (above[up.pos] if up else 0))
            left.append(bits | (left[back.pos] if back else 0))
            out.append(self.named(bits))
        return out
