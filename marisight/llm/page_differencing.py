"""HTML extraction by nearest-URL page differencing.

Pages of one host come from few templates, and the closer two URL paths are, the likelier they share
one.  So each page is paired with the page of its host whose path has the longest prefix in common
among its two neighbours in path order; the text lines (blocks) of the two are aligned by longest
common subsequence, and the lines they share are template and go.

The alignment sees every line of a page, menus and footers included.  What it can't decide is told by
the page's own marks:

* Where a page has an ``<article>`` or main element, its lines are the main text, shared or not: an article
  may rightly be equal to its neighbour's (mirrors, copies).  Articles that no frame encloses come first; where
  there are none, those inside forms and named elements count, so a form or a sidebar layout around a whole
  page takes nothing away.
* Where a page has none, all lines are main text that the neighbour doesn't share.
* Template slots may hold text that no other page has (adverts, footers with a page's own text).  Such
  lines go where an element around them is boilerplate by tag or by name.  A name counts outside an article by
  its last part (``user-comments``, ``ad-slot``), inside one only if it is the whole name (``share``, not
  ``article-header``); names of headings, heads of posts (``post-header``) and names that say what a layout
  has (``page-with-sidebar``) don't count.  A form goes unless it holds a heading of the first rank or a line
  of ``PROSE`` words or more.

Alignment is exact and bounded: rows of the table of common lengths are bits of one number each, and only the
rows of a part of the lines are held at a time, whatever repeats.

Neighbours are found without collecting a host anywhere: (host, path) is range partitioned, each
partition looks at its own order, and only its first and last entries are passed on.

Defined results: null or empty HTML gives an empty text; pages alone on their host have no partner and
lose only boilerplate elements, as do pages whose lines all stand in their partner; null URLs form a
host of their own; of equal rows one stands for all in the pairing, and all get its result; elements
whose ends are left out end as HTML ends them, unclosed ones with the page.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from marisight.llm._batches import slices
from marisight.llm._shared import written

_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:svg|iframe)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|template|noscript|title|textarea|svg|iframe)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_MAIN = frozenset(("article", "main"))
#: an element that one of these opens first ends: what it is, and what it never looks beyond
_ENDED_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
_ENDED_BY = {name: (frozenset(ends.split()), frozenset(walls)) for name, (ends, walls) in _ENDED_BY.items()}
#: an end tag looks for its element no further than these
_WALLS = frozenset("table td th caption".split())
_LIST_WALLS = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("table",)), "th": frozenset(("table",)), "table": frozenset()}
#: elements that never hold an article's own text
_FRAME = frozenset("nav footer aside button select dialog menu".split())
#: names of menus, headers, footers, sidebars, notices, adverts, forms and comments in class, id or role
_FRAME_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer contentinfo sidebar complementary aside notice notices cookie cookies consent alert popup modal "
    "ad ads advert adverts advertisement sponsor sponsored promo form search newsletter subscribe login share social comment comments disqus reply replies related".split()
)
#: parts of names that say where or how something stands, not what it is
_LAYOUT_WORDS = frozenset("container wrapper wrap box bar slot unit block area section list left right inner outer top bottom buttons links content".split())
_PART = re.compile(r"[a-z0-9]+")
#: names with such a part say what a layout has; names that start like this and end in ``header`` are heads of texts
_SAYS_LAYOUT = frozenset(("with", "without", "has", "no"))
_TEXTS = frozenset(("post", "entry", "article", "story", "page"))
#: words of a line that forms for input don't have
PROSE = 20
#: where a line stands: inside an article, in a boilerplate element, in neither, or in an article that a frame encloses
_ARTICLE, _BOILERPLATE, _OPEN, _FRAMED = 0, 1, 2, 3
#: bits of the table of common lengths that are held at a time
_BITS = 1 << 26


def _named_frame(name: str, attributes: str, in_article: bool) -> bool:
    if name in _HEADINGS:
        return False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id", "role"):
            continue
        for whole in (a or b or c).lower().split():
            if whole in _FRAME_WORDS:
                return True
            parts = [] if in_article else _PART.findall(whole)
            if _SAYS_LAYOUT.intersection(parts) or parts[-1:] == ["header"] and parts[0] in _TEXTS:
                continue
            while len(parts) > 1 and parts[-1] in _LAYOUT_WORDS:
                parts.pop()
            if parts and parts[-1] in _FRAME_WORDS:
                return True
    return False


def blocks(page: str) -> tuple[list[str], list[int]]:
    """Text blocks of a page in order, and where each stands."""
    texts: list[str] = []
    places: list[int] = []
    open_: list[tuple[str, bool, bool]] = []  # block elements: name, is boilerplate, is an article
    named: dict[str, int] = {}  # how many are open by name
    frames = mains = forms = at = 0
    enclosed = 0  # frames around the outermost open article
    in_form: list[int] = []  # lines of the outermost open form (inside the article, if one is open)
    prose = False
    outside = (0, in_form, False)  # the form around the outermost open article
    held: list[str] = []

    def flush() -> None:
        nonlocal prose
        if held:
            said = " ".join(_html.unescape("".join(held)).split())
            held.clear()
            if said:
                place = _BOILERPLATE if frames else (_FRAMED if enclosed else _ARTICLE) if mains else _OPEN
                if forms and place != _BOILERPLATE:
                    in_form.append(len(texts))
                    prose = prose or said.count(" ") >= PROSE - 1 or bool(named.get("h1"))
                texts.append(said)
                places.append(place)

    def close(to: int) -> None:
        nonlocal frames, mains, enclosed, forms, prose, in_form
        for name, frame, main in reversed(open_[to:]):
            named[name] -= 1
            frames -= frame
            mains -= main
            if main and not mains:
                frames, enclosed = enclosed, 0
                forms, in_form, prose = outside
            if name == "form":
                forms -= 1
                if not forms:
                    if not prose:
                        for i in in_form:
                            places[i] = _BOILERPLATE
                    in_form, prose = [], False
        del open_[to:]

    for m in _TOKENS.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in _INLINE:
            continue
        if name == "br":
            held.append(" ")
            continue
        flush()
        if name in _VOID:
            continue
        if m[2]:
            walls = _LIST_WALLS.get(name, _WALLS)
            for k in range(len(open_) - 1, -1, -1) if named.get(name) else ():
                if open_[k][0] == name:
                    close(k)
                    break
                if open_[k][0] in walls:
                    break
            continue
        if open_ and open_[-1][0] == "p":  # a paragraph ends where the next block begins
            close(len(open_) - 1)
        if name in _ENDED_BY:
            ends, walls = _ENDED_BY[name]
            for k in range(len(open_) - 1, -1, -1) if any(named.get(e) for e in ends) else ():
                if open_[k][0] in walls:
                    break
                if open_[k][0] in ends:
                    close(k)
                    if name != "tr":
                        break
        main = name in _MAIN
        if main and not mains:
            frames, enclosed = 0, frames
            outside, forms, in_form, prose = (forms, in_form, prose), 0, [], False
        frame = name in _FRAME or (name == "header" and not mains) or bool(m[4] and not main and name not in ("html", "body", "form") and _named_frame(name, m[4], mains > 0))
        frames += frame
        mains += main
        forms += name == "form"
        named[name] = named.get(name, 0) + 1
        open_.append((name, frame, main))
    if at < len(page):
        held.append(page[at:])
    flush()
    close(0)
    return texts, places


def kept_lines(texts: list[str], places: list[int], shared: list[bool]) -> list[bool]:
    """Which lines are main text: the article's, else those of articles inside frames, else all that are neither shared
    nor boilerplate."""
    for wanted in (_ARTICLE, _FRAMED):
        if wanted in places:
            return [place == wanted for place in places]
    return [place == _OPEN and not common for place, common in zip(places, shared)]


def shared_lines(a: list[int], b: list[int]) -> list[bool]:
    """Which entries of a are in a longest common subsequence of a and b."""
    out = [False] * len(a)
    both = set(a) & set(b)
    _align([(i, x) for i, x in enumerate(a) if x in both], [x for x in b if x in both], out)
    return out


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """After each entry of a (or after all): a bit for each entry of b, 0 where the longest common length grows."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    row, rows = every, []
    for x in a:
        met = row & where.get(x, 0)
        row = ((row + met) | (row - met)) & every
        if keep:
            rows.append(row)
    return rows or [row]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The longest common length of a with the first 0, 1, … entries of b."""
    grows = _rows(a, b, False)[0].to_bytes(len(b) // 8 + 1, "little")
    return np.r_[0, np.cumsum(1 - np.unpackbits(np.frombuffer(grows, np.uint8), bitorder="little")[: len(b)].astype(np.int64))]


def _align(a: list[tuple[int, int]], b: list[int], out: list[bool]) -> None:
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < min(end_a, end_b) and a[lo][1] == b[lo]:
        out[a[lo][0]] = True
        lo += 1
    while end_a > lo and end_b > lo and a[end_a - 1][1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
        out[a[end_a][0]] = True
    a, b = a[lo:end_a], b[lo:end_b]
    if not a or not b:
        return
    said = [x for _, x in a]
    if len(a) > 1 and len(a) * len(b) > _BITS:  # in halves of a, where b is cut best
        half = len(a) // 2
        cut = int((_lengths(said[:half], b) + _lengths(said[half:][::-1], b[::-1])[::-1]).argmax())
        _align(a[:half], b[:cut], out)
        _align(a[half:], b[cut:], out)
        return
    rows = _rows(said, b, True)
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> j - 1 & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> j - 1 & 1:
            out[a[i][0]] = True
            j -= 1


def _line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = [[_line_hash(t) for t in blocks(x or "")[0]] for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["rk", "lines"])


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, partners = [], []
        for host, path, rk, before, after in zip(*(batch.column(i).to_pylist() for i in range(5))):
            best = None
            for other in (before, after):
                if other and other["host"] == host:
                    near = _common(path, other["path"])
                    if best is None or near > best[0]:
                        best = (near, other["rk"])
            keys.append(rk)
            partners.append(best and best[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(2).type), pa.array(partners, batch.column(2).type)], names=["rk", "partner"])


def nearest_pages(keys: DataFrame) -> DataFrame:
    """(rk, partner): for each (rk, host, path) the page of its host with the nearest path, null if it is alone."""
    dealt = keys.repartitionByRange("host", "path", "rk").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "paths")  # the same ranges for all readers
    me = F.struct("host", "path", "rk")
    order = Window.partitionBy("part").orderBy("host", "path", "rk")
    ends = dealt.groupBy("part").agg(F.min(me).alias("first"), F.max(me).alias("last"))  # a row per partition
    parts = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(parts).alias("came"), F.lead("first").over(parts).alias("comes"))
    rows = dealt.select("part", "host", "path", "rk", F.lag(me).over(order).alias("before"), F.lead(me).over(order).alias("after")).join(ends, "part")
    rows = rows.select("host", "path", "rk", F.coalesce("before", "came").alias("before"), F.coalesce("after", "comes").alias("after"))
    return rows.mapInArrow(_nearest, StructType([StructField(c, keys.schema["rk"].dataType) for c in ("rk", "partner")]))


def _extract(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts, dropped = [], []
            for page, partner in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                said, places = blocks(page or "")
                common = shared_lines([_line_hash(t) for t in said], partner) if partner else [False] * len(said)
                if all(common):  # a copy tells nothing about the template
                    common = [False] * len(said)
                keep = kept_lines(said, places, common)
                texts.append(" ".join(t for t, k in zip(said, keep) if k))
                dropped.append(sum(1 for k, gone in zip(keep, common) if gone and not k))
            yield pa.RecordBatch.from_arrays([*[batch.column("__" + c) for c in names], pa.array(texts, pa.string()), pa.array(dropped, pa.int64())], names=[*names, "text", "n_shared"])

    return run


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """pages' columns (or ``keep``) with ``text``, the main text, and ``n_shared``, the lines that
    differencing removed."""
    names = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_shared")]
    nothing = F.lit("")
    whole = F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(F.col(url), nothing), F.coalesce(F.col(html), nothing))))
    keyed = pages.select(F.col(html).alias("page"), whole.alias("rk"), F.col(url).alias("address"), *[F.col(c).alias("__" + c) for c in names])
    host = F.lower(F.coalesce(F.regexp_extract("address", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), nothing))
    path = F.coalesce(F.regexp_extract("address", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), nothing)
    paths = keyed.select("rk", host.alias("host"), path.alias("path")).dropDuplicates(["rk"])
    lines = keyed.select("rk", "page").mapInArrow(_line_hashes, StructType([StructField("rk", BinaryType()), StructField("lines", ArrayType(LongType()))]))
    lines = lines.groupBy("rk").agg(F.first("lines").alias("lines"))  # equal rows have equal lines
    pairs = nearest_pages(paths).where(F.col("partner").isNotNull())
    beside = pairs.join(lines.withColumnRenamed("rk", "partner"), "partner").select("rk", "lines")
    rows = keyed.join(beside, "rk", "left").select("page", "lines", *["__" + c for c in names])
    return rows.mapInArrow(_extract(names), StructType([*pages.select(*names).schema.fields, StructField("text", StringType()), *StructType.fromDDL("n_shared long").fields]))


def op6_page_differencing(spark, sf_dir: str) -> DataFrame:
    """The main text of every whole page; see the module."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = extract(pages, keep=["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")
