"""Documents to blocks: HTML, CSV, DOCX and XLSX payloads, one Arrow pass each, stdlib only.

A block is (text, block_type, page_number, section_heading, sheet_name, row_number, row_label).
Payloads that can't be parsed give no blocks and a reason, never a failed task.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BLOCK = "struct<text:string,block_type:string,page_number:int,section_heading:string,sheet_name:string,row_number:int,row_label:string>"
_ARROW_BLOCK = pa.struct([("text", pa.string()), ("block_type", pa.string()), ("page_number", pa.int32()), ("section_heading", pa.string()), ("sheet_name", pa.string()), ("row_number", pa.int32()), ("row_label", pa.string())])
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = ("h1", "h2", "h3", "h4")
_KINDS = {"p": "paragraph", "li": "list_item", "table": "table"}


def _block(text: str, kind: str, **more) -> dict:
    return {"text": text, "block_type": kind, "page_number": None, "section_heading": None, "sheet_name": None, "row_number": None, "row_label": None, **more}


class _Nodes(HTMLParser):
    """Headings, paragraphs, items and tables of the body in document order, nested ones each on their own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None]] = []
        self.nodes: list[tuple[str, list[str]]] = []
        self.title: list[str] | None = None
        self.skip = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "body":
            self.nodes, self.open = [], []
        if tag in _VOID:
            return
        held: list[str] | None = None
        if tag in _HEADINGS or tag in _KINDS:
            held = []
            self.nodes.append((tag, held))
        elif tag == "title" and self.title is None:
            held = self.title = []
        self.skip += tag in ("script", "style", "template")
        self.open.append((tag, held))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.skip -= sum(t in ("script", "style", "template") for t, _ in self.open[k:])
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        said = data.strip()
        if said and not self.skip:
            for _, held in self.open:
                if held is not None:
                    held.append(said)


def html_blocks(page: str) -> list[dict]:
    """Blocks under the heading that stands before them; headings themselves are context only."""
    parser = _Nodes()
    parser.feed(page)
    parser.close()
    out, heading = [], None
    for tag, parts in parser.nodes:
        text = " ".join(parts)
        if not text:
            continue
        if tag in _HEADINGS:
            heading = text
        else:
            out.append(_block(text, _KINDS[tag], section_heading=heading))
    return out


def html_title(page: str) -> str | None:
    parser = _Nodes()
    parser.feed(page)
    return " ".join(parser.title or []) or None


def _row_block(headers: list[str], cells: list[str], number: int, sheet: str | None) -> dict | None:
    pairs = []
    for i, cell in enumerate(cells):
        if cell:
            name = headers[i] if i < len(headers) and headers[i] else f"Column {len(pairs) + 1}"
            pairs.append(f"{name}: {cell}")
    if not pairs:
        return None
    label = (cells[0] if cells else "") or (headers[0] if headers else "") or f"Row {number}"
    return _block(" | ".join(pairs), "row", sheet_name=sheet, row_number=number, row_label=label)


def _table_blocks(rows: list[list[str]], sheet: str | None) -> list[dict]:
    rows = [[(c or "").strip() for c in r] for r in rows]
    if not rows:
        return []
    made = (_row_block(rows[0], r, n, sheet) for n, r in enumerate(rows[1:], start=2))
    return [b for b in made if b]


def csv_blocks(payload: bytes) -> list[dict]:
    """Rows as ``header: value`` pairs; byte order mark dropped, UTF-8 before Latin-1, dialect sniffed."""
    try:
        text = payload.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = payload.decode("latin-1")
    try:
        dialect: type[csv.Dialect] | csv.Dialect = csv.Sniffer().sniff(text[:4096])
    except csv.Error:
        dialect = csv.excel
    return _table_blocks(list(csv.reader(io.StringIO(text), dialect)), None)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def docx_blocks(payload: bytes, headings: bool = False) -> list[dict]:
    """Paragraphs; heading styles set the section (and with ``headings`` stand as blocks too), list styles make items."""
    with zipfile.ZipFile(io.BytesIO(payload)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    out, heading = [], None
    for p in root.iter(_W + "p"):
        text = "".join(t.text or "" for t in p.iter(_W + "t")).strip()
        style = p.find(f"{_W}pPr/{_W}pStyle")
        name = (style.get(_W + "val") or "").lower() if style is not None else ""
        if not text:
            continue
        if name.startswith("heading"):
            heading = text
        if headings or not name.startswith("heading"):
            out.append(_block(text, "list_item" if "list" in name else "paragraph", section_heading=heading))
    return out


def xlsx_rows(payload: bytes) -> list[tuple[str, list[list[str]]]]:
    """(name, rows of cell texts) of every sheet."""
    out: list[tuple[str, list[list[str]]]] = []
    with zipfile.ZipFile(io.BytesIO(payload)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(_S + "t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_S + "si")]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_S + "sheet"):
            target = (links.get(sheet.get(_R + "id")) or "").lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            rows = []
            for row in root.iter(_S + "row"):
                cells: list[str] = []
                for c in row.iter(_S + "c"):
                    letters = re.match("[A-Z]*", c.get("r") or "")[0]
                    at = 0
                    for ch in letters:
                        at = at * 26 + ord(ch) - 64
                    while at > len(cells) + 1:
                        cells.append("")
                    v, kind = c.find(_S + "v"), c.get("t")
                    value = "".join(t.text or "" for t in c.iter(_S + "t")) if kind == "inlineStr" else (v.text or "" if v is not None else "")
                    cells.append(shared[int(value)] if kind == "s" and value else value)
                rows.append(cells)
            out.append((sheet.get("name"), rows))
    return out


def xlsx_blocks(payload: bytes) -> list[dict]:
    """One row block per data row of every sheet."""
    return [b for name, rows in xlsx_rows(payload) for b in _table_blocks(rows, name)]


PARSERS: dict[str, Callable[[bytes], list[dict]]] = {
    "html": lambda payload: html_blocks(payload.decode("utf-8", "ignore")),
    "csv": csv_blocks,
    "docx": docx_blocks,
    "xlsx": xlsx_blocks,
}


def register_parser(file_type: str, parser: Callable[[bytes], list[dict]]) -> None:
    """Adds or replaces the parser of a file type (PDF, for one, needs a library of the user's choice)."""
    PARSERS[file_type] = parser


def parsed(files: DataFrame, payload: str = "content", file_type: str = "file_type") -> DataFrame:
    """files (without the payload) with ``blocks`` and ``parse_error``; text payloads count as UTF-8."""
    names = [c for c in files.columns if c not in (payload, "blocks", "parse_error")]
    rows = files.select(F.col(payload).cast("binary").alias("__payload"), F.lower(F.col(file_type)).alias("__type"), *names)
    schema = StructType([*files.select(*names).schema.fields, StructField("blocks", StructType.fromDDL(f"b array<{BLOCK}>")[0].dataType), *StructType.fromDDL("parse_error string").fields])
    parsers = dict(PARSERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, errors = [], []
            for raw, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: list[dict] = []
                error = None
                if kind not in parsers:
                    error = f"no parser for {kind}"
                elif raw is not None:
                    try:
                        found = parsers[kind](raw)
                    except (ValueError, KeyError, IndexError, zipfile.BadZipFile, ElementTree.ParseError, csv.Error) as e:
                        error = f"{type(e).__name__}: {e}"[:200]
                blocks.append(found)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(blocks, pa.list_(_ARROW_BLOCK)), pa.array(errors, pa.string())], names=[*names, "blocks", "parse_error"])

    return rows.mapInArrow(run, schema)


def document_text(blocks: Column) -> Column:
    """Non-blank block texts joined by a blank line."""
    return F.array_join(F.filter(F.transform(blocks, lambda b: b["text"]), lambda t: F.trim(t) != ""), "\n\n")


def is_empty(blocks: Column) -> Column:
    return ~F.exists(blocks, lambda b: F.trim(b["text"]) != "")


def locator(block: Column) -> Column:
    """A block's place, with nothing for what is missing."""
    entries = F.create_map(*[x for name in ("page_number", "section_heading", "sheet_name", "row_number", "row_label") for x in (F.lit(name), block[name].cast("string"))])
    return F.map_filter(entries, lambda k, v: v.isNotNull())


def markdown_table(rows: Column) -> Column:
    """array<array<string>> as a markdown table, rows padded or cut to the header's width; '' when empty."""
    width = F.size(F.element_at(rows, 1))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(1), width), lambda i: F.coalesce(F.try_element_at(r, i), F.lit(""))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    whole = F.concat(F.array(line(F.element_at(rows, 1)), rule), F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line))
    return F.when(F.size(rows) > 0, F.array_join(whole, "\n")).otherwise(F.lit(""))


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags; lines trimmed, split at double blanks, joined by line feeds."""
    s = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->|<[^>]+>", "\n")
    for name, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(mark))
    parts = F.flatten(F.transform(F.split(s, "\n"), lambda x: F.split(F.trim(x), "  ")))
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), "\n")
