"""Pages as node tables, so that extractors are filters and joins.

A node is (pos, last, depth, tag, classes, attrs, text): positions number the start tags of a page, and a
node's descendants are the nodes with ``pos`` in (pos, last].  ``text`` is the text of its subtree.  Elements
end as in HTML where their end tags are left out (paragraphs, list items, rows, cells).

``nodes`` gives every node.  ``selected`` gives only those that selectors ask for, each with the positions of the
named elements that enclose it, so that "the first link of an item" is a grouping by the item's position and no
join by ranges; a page is parsed once, whatever the number of selectors.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from marisight.sources.selectors import Matcher

NODE = "struct<pos:int,last:int,depth:int,tag:string,classes:array<string>,attrs:map<string,string>,text:string>"
FOUND = "struct<name:string,pos:int,last:int,owners:map<string,int>,tag:string,classes:array<string>,attrs:map<string,string>,text:string>"
_STRINGS = pa.map_(pa.string(), pa.string())
_ARROW = pa.struct([("pos", pa.int32()), ("last", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("classes", pa.list_(pa.string())), ("attrs", _STRINGS), ("text", pa.string())])
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = ("script", "style")
_BLOCK = "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul"
_CELLS, _ROWS = frozenset(("td", "th")), frozenset(("td", "th", "tr"))
#: a start tag ends open elements of these names, as far as the nearest one of the others
_ENDS = {
    **{tag: (frozenset(("p",)), frozenset(("table", "td", "th", "button", "caption", "object"))) for tag in _BLOCK.split()},
    "li": (frozenset(("li",)), frozenset(("ul", "ol"))),
    **{tag: (frozenset(("dt", "dd")), frozenset(("dl",))) for tag in ("dt", "dd")},
    **{tag: (_CELLS, frozenset(("tr", "table"))) for tag in ("td", "th")},
    "tr": (_ROWS, frozenset(("table",))),
    **{tag: (_ROWS | {"thead", "tbody", "tfoot"}, frozenset(("table",))) for tag in ("thead", "tbody", "tfoot")},
    "option": (frozenset(("option",)), frozenset(("select",))),
}


#: what stands between one tag and the next in plain markup; everything else is read by the library's parser
_NAME = r"[a-zA-Z][a-zA-Z0-9:_-]*+"
_GAP = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"""{_GAP}++([a-zA-Z_][a-zA-Z0-9_:.-]*+)(?:{_GAP}*+={_GAP}*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'`=<>]++)))?"""
_TAG = re.compile(rf"<(?:/({_NAME}){_GAP}*+>|({_NAME})((?:{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*+){_GAP}*+(/?)>)")
_ATTRIBUTES = re.compile(_ATTRIBUTE)
#: elements whose content isn't markup
_OPAQUE = frozenset("script style title textarea iframe noembed noframes noscript plaintext xmp".split())

#: those of them whose content is read here if it has no references and no tags
_SIMPLE = frozenset(("script", "style", "title", "textarea"))
_CONTENT = re.compile(rf"([^<&]*+)</({_NAME}){_GAP}*+>")


#: characters of a tag up to which it is kept in mind; tags repeat within and over the pages of a site
_SHORT = 256


@lru_cache(maxsize=1 << 13)
def _plain(tag: str) -> tuple[bool, str, dict[str, str], bool] | None:
    """What a tag that stands by itself says: whether it ends an element, its name, attributes and whether it closes
    itself; None where it isn't plain.  Quotes of a plain tag are balanced, so it ends at its first angle bracket."""
    m = _TAG.fullmatch(tag)
    if m and m[1]:
        return True, m[1].lower(), {}, False
    if m and (name := m[2].lower()) not in _OPAQUE and "&" not in m[3]:
        return False, name, {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTES.findall(m[3])}, bool(m[4])
    return None


class Scanner(HTMLParser):
    """Reads a page's tags and texts as ``HTMLParser`` does: plain tags by one expression, others by its methods, and all
    that is left by itself where a page is odd (stray angle brackets, unended comments)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        """An element begins; equal tags may share ``attrs``, so nothing changes them."""
        raise NotImplementedError

    def handle_starttag(self, tag: str, attrs) -> None:
        self.start(tag, {k: v or "" for k, v in attrs})

    def read(self, page: str) -> Iterator[None]:
        """Reads the page, stopping after every tag."""
        at, find, match = 0, page.find, _TAG.match
        while at < len(page):
            to = find("<", at)
            if to != at:
                said = page[at:] if to < 0 else page[at:to]
                self.handle_data(unescape(said) if "&" in said else said)
                if to < 0:
                    return
                at = to
            end = find(">", at) + 1
            if 0 < end - at <= _SHORT and (plain := _plain(page[at:end])):
                ends, tag, attrs, closed = plain
                if ends:
                    self.handle_endtag(tag)
                else:
                    self.start(tag, attrs)
                    if closed:
                        self.handle_endtag(tag)
                at = end
                yield
                continue
            m = match(page, at)
            if m and m[1]:
                self.handle_endtag(m[1].lower())
                at = m.end()
            elif m and (tag := m[2].lower()) not in _OPAQUE and "&" not in m[3]:
                self.start(tag, {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTES.findall(m[3])} if m[3] else {})
                if m[4]:
                    self.handle_endtag(tag)
                at = m.end()
            elif m and tag in _SIMPLE and not m[4] and "&" not in m[3] and (inner := _CONTENT.match(page, m.end())) and inner[2].lower() == tag:
                self.start(tag, {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTES.findall(m[3])})
                if inner[1]:
                    self.handle_data(inner[1])
                self.handle_endtag(tag)
                at = inner.end()
            elif (end := self._whole(page, at, m)) is None or not self._by_library(page[at:end]):
                self.feed(page[at if end is None else end :])
                self.close()
                return
            else:
                at = end
            yield

    def _whole(self, page: str, at: int, m: re.Match | None) -> int | None:
        """Where the construct at this place surely ends, if that is plain."""
        if m:  # an attribute with references, or an element whose content isn't markup
            if (tag := m[2].lower()) not in _OPAQUE:
                return m.end()
            end = re.compile(rf"</{re.escape(tag)}{_GAP}*+>", re.IGNORECASE).search(page, m.end()) if not m[4] else None
            return end and end.end()
        end = page.find(">", at) + 1
        ends = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ">" if page.startswith(("<?", "<!d", "<!D"), at) else None
        return end if ends and end and page.startswith(ends, end - len(ends)) and end - len(ends) - at >= 4 else None

    def _by_library(self, part: str) -> bool:
        """Feeds a part of the page to the library; whether nothing of it is left open."""
        self.feed(part)
        return not self.rawdata and self.cdata_elem is None


class Node:
    __slots__ = ("attrs", "classes", "depth", "last", "last_child", "nth", "nth_of_type", "parent", "pos", "previous", "said", "tag")

    def __init__(self, pos: int, tag: str, attrs: dict[str, str], parent: Node | None, previous: Node | None):
        self.pos = self.last = pos
        self.tag, self.attrs, self.classes = tag, attrs, attrs.get("class", "").split()
        self.parent, self.previous, self.depth = parent, previous, parent.depth + 1 if parent else 0
        self.nth, self.nth_of_type, self.last_child = (previous.nth + 1 if previous else 1), 1, True
        self.said = (0, 0)


class _Nested(Scanner):
    """A scanner that knows which elements are open and ends them as HTML does."""

    def __init__(self) -> None:
        super().__init__()
        self._open: list = []
        self._names: dict[str, int] = {}  # how many are open by name
        self.texts: list[str] = []

    def _end(self, keep: int) -> None:
        """Ends all open nodes but the first ``keep``."""
        raise NotImplementedError

    def _highest(self, names: frozenset[str], until: frozenset[str]) -> int | None:
        """The place of the outermost open node of these names above the nearest one of the others."""
        found = None
        left = 0
        for n in names:
            left += self._names.get(n, 0)
        if not left:
            return None
        for k in range(len(self._open) - 1, -1, -1):
            if not left or self._open[k].tag in until:
                break
            if self._open[k].tag in names:
                found, left = k, left - 1
        return found

    def _ended_by(self, tag: str) -> None:
        if (ends := _ENDS.get(tag)) and (k := self._highest(*ends)) is not None:
            self._end(k)

    def handle_endtag(self, tag: str) -> None:
        if self._names.get(tag):
            k = len(self._open) - 1
            while self._open[k].tag != tag:
                k -= 1
            self._end(k)

    def handle_data(self, data: str) -> None:
        said = data.strip()
        if said and not (self._open and self._open[-1].tag in _RAW):
            self.texts.append(said)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):  # as XML has it
            self.handle_data(data[6:])


class Tree(_Nested):
    """The nodes of a page and its texts; a node's text is a span of them."""

    def __init__(self, page: str) -> None:
        super().__init__()
        self.nodes: list[Node] = []
        self._newest: dict[int, Node] = {}  # the newest child of each open node (-1: of the page)
        self._kinds: dict[tuple[int, str], int] = {}
        for _ in self.read(page):
            pass
        self._end(0)

    def _end(self, keep: int) -> None:
        """Ends all open nodes but the first ``keep``."""
        for node in self._open[keep:]:
            node.last, node.said = len(self.nodes) - 1, (node.said[0], len(self.texts))
            self._names[node.tag] -= 1
        del self._open[keep:]

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        self._ended_by(tag)
        parent = self._open[-1] if self._open else None
        at = parent.pos if parent else -1
        previous = self._newest.get(at)
        if previous:
            previous.last_child = False
        node = Node(len(self.nodes), tag, attrs, parent, previous)
        node.nth_of_type = self._kinds[at, tag] = self._kinds.get((at, tag), 0) + 1
        node.said = (len(self.texts), len(self.texts))
        self._newest[at] = node
        self.nodes.append(node)
        if tag not in _VOID:
            self._open.append(node)
            self._names[tag] = self._names.get(tag, 0) + 1

    def text(self, node: Node) -> str:
        return " ".join(self.texts[slice(*node.said)])

    def row(self, node: Node) -> dict:
        return {"pos": node.pos, "last": node.last, "depth": node.depth, "tag": node.tag, "classes": node.classes, "attrs": list(node.attrs.items()), "text": self.text(node)}


def page_nodes(page: str, tags: frozenset[str] | None = None) -> list[dict]:
    tree = Tree(page)
    return [tree.row(n) for n in tree.nodes if tags is None or n.tag in tags]


class _Open:
    """An element that is open: what it matched, what its children have matched so far, and the found node it is."""

    __slots__ = ("above", "found", "kinds", "near", "newest", "nth", "own", "pos", "siblings", "tag")

    def __init__(self, tag: str, pos: int, own: int, above: int, near: dict[str, int], found: list | None) -> None:
        self.tag, self.pos, self.own, self.above, self.near, self.found = tag, pos, own, above, near, found
        self.newest = self.siblings = self.nth = 0  # bits of the newest child, of all children, and how many there are
        self.kinds: dict[str, int] | None = None


class _Met:
    """An element at its start tag, as steps look at it."""

    __slots__ = ("attrs", "classes", "nth", "nth_of_type")


class Selection(_Nested):
    """Finds the nodes that selectors ask for while a page is read.  A node is known at its start tag and given to
    ``found`` when it ends: (pos, last, tag, classes, attrs, text, names, the nearest owners).  Only open elements and
    the texts of open found nodes are held, whatever the size of the page."""

    def __init__(self, matcher: Matcher, owning: frozenset[str]) -> None:
        super().__init__()
        self._matcher, self._owning = matcher, owning
        self._root, self._count, self._held, self._met = _Open("", -1, 0, 0, {}, None), 0, 0, _Met()
        self.found: list[tuple] = []

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        self._ended_by(tag)
        up, met, matcher = self._open[-1] if self._open else self._root, self._met, self._matcher
        pos, bits = self._count, 0
        self._count += 1
        up.nth += 1
        met.attrs, met.nth, met.classes = attrs, up.nth, attrs["class"].split() if "class" in attrs else ()
        if matcher.counts_kinds:
            kinds = up.kinds = {} if up.kinds is None else up.kinds
            met.nth_of_type = kinds[tag] = kinds.get(tag, 0) + 1
        for bit, before, joint, step in matcher.fitting(tag, met):
            if before and not before & (up.above if joint == " " else up.own if joint == ">" else up.newest if joint == "+" else up.siblings):
                continue
            if not step.places or step.placed(met):
                bits |= bit
        up.newest, up.siblings = bits, up.siblings | bits
        found, near = None, up.near
        if bits and (names := matcher.named(bits)):
            if own := self._owning.intersection(names):
                near = {**near, **dict.fromkeys(own, pos)}
            if tag in _VOID:
                self.found.append((pos, pos, tag, met.classes, attrs, "", names, near))
                return
            found = [pos, tag, met.classes, attrs, names, near, len(self.texts)]
            self._held += 1
        if tag not in _VOID:
            self._open.append(_Open(tag, pos, bits, bits | up.above, near, found))
            self._names[tag] = self._names.get(tag, 0) + 1

    def handle_data(self, data: str) -> None:
        if self._held and (said := data.strip()) and not (self._open and self._open[-1].tag in _RAW):
            self.texts.append(said)

    def _end(self, keep: int) -> None:
        last = self._count - 1
        for node in reversed(self._open[keep:]):
            self._names[node.tag] -= 1
            if node.found:
                pos, tag, classes, attrs, names, near, said = node.found
                self.found.append((pos, last, tag, classes, attrs, " ".join(self.texts[said:]), names, near))
                self._held -= 1
        del self._open[keep:]
        if not self._held:
            self.texts.clear()

    def taken(self, page: str, most: int) -> Iterator[list[tuple]]:
        """The found nodes of the page, ``most`` or a few more at a time."""
        for _ in self.read(page):
            if len(self.found) >= most:
                yield self.found
                self.found = []
        self._end(0)
        yield self.found


def _whole_tree(page: str, matcher: Matcher, owning: frozenset[str]) -> Iterator[list[tuple]]:
    """The found nodes of a page by selectors that look at what follows a node."""
    tree, near = Tree(page), []
    out = []
    for node, names in zip(tree.nodes, matcher.names(tree.nodes)):
        around = near[node.parent.pos] if node.parent else {}
        if own := owning.intersection(names):
            around = {**around, **dict.fromkeys(own, node.pos)}
        near.append(around)
        if names:
            out.append((node.pos, node.last, node.tag, node.classes, node.attrs, tree.text(node), names, around))
    yield out


def _dealt(pages: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """The pages' ``columns`` (as _0, _1, …) and the kept ones.

    Parsing costs far more than a page's bytes tell, by which files are split and shuffled rows are put together; so pages
    are dealt over a number of partitions of their own."""
    session = pages.sparkSession
    many = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    return pages.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)], *keep).repartition(many, "_0", *keep[:1])


def _per_page(pages: DataFrame, columns: list[str], keep: list[str], kind: str, arrow: pa.DataType, made) -> DataFrame:
    """(kept columns, the fields of ``kind``) of the rows that ``made`` gives for each page's ``columns``."""
    rows = _dealt(pages, columns, keep)
    schema = StructType([*rows.schema[len(columns) :], StructField("nodes", StructType.fromDDL(f"n array<{kind}>")[0].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                lists = [made(*x) for x in zip(*[c.to_pylist() for c in part.columns[: len(columns)]])]
                yield pa.RecordBatch.from_arrays([*part.columns[len(columns) :], pa.array(lists, pa.list_(arrow))], names=[*keep, "nodes"])

    return rows.mapInArrow(run, schema).select(*keep, F.explode("nodes").alias("n")).select(*keep, "n.*")


def nodes(pages: DataFrame, key: str = "page_id", html: str = "html", tags: tuple[str, ...] | None = None) -> DataFrame:
    """(key, pos, last, depth, tag, classes, attrs, text) of every node, or of the given tags only."""
    wanted = frozenset(tags) if tags else None
    return _per_page(pages, [html], [key], NODE, _ARROW, lambda page: page_nodes(page or "", wanted))


Wanted = tuple[tuple[str, str, tuple[str, ...]], ...]


@cache
def _matcher(wanted: Wanted) -> tuple[Matcher, frozenset[str], dict[str, tuple[str, ...]]]:
    """What finds the nodes, the names that own others, and the owners of each name."""
    return Matcher({name: selector for name, selector, _ in wanted}), frozenset(o for _, _, owners in wanted for o in owners), {name: owners for name, _, owners in wanted}


def _found(page: str, wanted: Wanted, most: int) -> Iterator[list[tuple]]:
    matcher, owning, _ = _matcher(wanted)
    return _whole_tree(page, matcher, owning) if matcher.looks_ahead else Selection(matcher, owning).taken(page, most)


def page_selected(page: str, wanted: Wanted) -> list[dict]:
    """The nodes of a page that each (name, selector, owners) asks for; ``owners`` name other entries, and a node has the
    position of the nearest node of each that encloses it (or is it)."""
    asked = _matcher(wanted)[2]
    nodes = sorted((node for part in _found(page, wanted, AT_ONCE) for node in part), key=lambda node: node[0])
    return [
        {"pos": pos, "last": last, "tag": tag, "classes": list(classes), "attrs": list(attrs.items()), "text": text, "name": name, "owners": [(o, near[o]) for o in asked[name] if o in near]}
        for pos, last, tag, classes, attrs, text, names, near in nodes
        for name in names
    ]


def page_values(pages: DataFrame, of: Callable[[str], tuple | None], fields: str, keep: tuple[str, ...] = ("page_id",), html: str = "html") -> DataFrame:
    """(kept columns, fields): one row for each page for which ``of``, given its markup, has values."""
    names = list(keep)
    rows = _dealt(pages, [html], names)
    own = StructType.fromDDL(fields)
    schema = StructType([*rows.schema[1:], *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(own)
        for batch in batches:
            said = [of(page.as_py() or "") for page in batch.column(0)]
            at = pa.array([i for i, x in enumerate(said) if x is not None], pa.int64())
            values = list(zip(*[x for x in said if x is not None])) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[1:]], *[pa.array(v, f.type) for v, f in zip(values, arrow)]], names=[*names, *arrow.names])

    return rows.mapInArrow(run, schema)


#: found nodes, and characters of their texts, that are sent together
AT_ONCE, CHARS_AT_ONCE = 8192, 4_000_000


def _lists(lists: list) -> tuple[pa.Array, list]:
    """Where each of the lists begins in all of them, and these."""
    offsets = [0]
    for one in lists:
        offsets.append(offsets[-1] + len(one))
    return pa.array(offsets, pa.int32()), [x for one in lists for x in one]


def _as_batch(rows: list[tuple], kept: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """Rows (place of the page in the kept columns, name, pos, last, owners, tag, classes, attrs, text) as Arrow columns."""
    at, name, pos, last, owners, tag, classes, attrs, text = zip(*rows)
    owned, pairs = _lists(owners)
    css, classes = _lists(classes)
    have, keys = _lists(attrs)
    values = [v for one in attrs for v in one.values()]
    of = pa.array(at, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            *[c.take(of) for c in kept],
            pa.array(name, pa.string()), pa.array(pos, pa.int32()), pa.array(last, pa.int32()), pa.MapArray.from_arrays(owned, pa.array([o for o, _ in pairs], pa.string()), pa.array([p for _, p in pairs], pa.int32())),
            pa.array(tag, pa.string()), pa.ListArray.from_arrays(css, pa.array(classes, pa.string())), pa.MapArray.from_arrays(have, pa.array(keys, pa.string()), pa.array(values, pa.string())), pa.array(text, pa.string()),
        ],
        names=[*names, "name", "pos", "last", "owners", "tag", "classes", "attrs", "text"],
    )


Selectors = dict[str, tuple[str, tuple[str, ...]]]


def selected(pages: DataFrame, wanted: Selectors | dict[str, Selectors], keep: tuple[str, ...] = ("page_id",), html: str = "html", by: str | None = None) -> DataFrame:
    """(kept columns, name, pos, last, owners, tag, classes, attrs, text): nodes that selectors find, by the selector's name.
    ``wanted`` gives each name its selector and the names whose enclosing nodes are its owners; with ``by`` it gives
    such a set for each value of that column, and pages of other values have no nodes."""
    flat = lambda names: tuple((n, s, tuple(o)) for n, (s, o) in names.items())
    sets = {None: flat(wanted)} if by is None else {kind: flat(names) for kind, names in wanted.items()}
    columns, names = [html] if by is None else [html, by], list(keep)
    rows = _dealt(pages if by is None else pages.where(F.col(by).isin(*sets)), columns, names)
    schema = StructType([*rows.schema[len(columns) :], *StructType.fromDDL(f"n {FOUND}")[0].dataType])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, made, chars = batch.columns[len(columns) :], [], 0
            for i in range(batch.num_rows):
                kind = None if by is None else batch.column(1)[i].as_py()
                asked = _matcher(sets[kind])[2]
                for part in _found(batch.column(0)[i].as_py() or "", sets[kind], AT_ONCE):
                    for pos, last, tag, classes, attrs, text, found, near in part:
                        for name in found:
                            made.append((i, name, pos, last, [(o, near[o]) for o in asked[name] if o in near] if near else (), tag, classes, attrs, text))
                            chars += len(text)
                    if len(made) >= AT_ONCE or chars >= CHARS_AT_ONCE:
                        yield _as_batch(made, kept, names)
                        made, chars = [], 0
            if made:
                yield _as_batch(made, kept, names)

    return rows.mapInArrow(run, schema)
