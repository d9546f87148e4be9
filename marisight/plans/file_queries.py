"""Files written from the given tables, stored and parsed again, and the SQL of what they say."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.operators.tables import shared_folder
from marisight.plans.retrieval_queries import table
from marisight.sources import attachments, feeds, html_blocks

_WORDS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_SHEETS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def _document(customer: int, rows: list[dict]) -> bytes:
    """A text document: a heading, a paragraph for each even order and a list item for each odd one, in two runs."""
    style = lambda name: f'<w:pPr><w:pStyle w:val="{name}"/></w:pPr>'
    said = [f"<w:p>{style('Heading1')}<w:r><w:t>Orders of {customer}</w:t></w:r></w:p><w:p/>"]
    said += [f"<w:p>{style('ListBullet') if r['key'] % 2 else ''}<w:r><w:t>Order </w:t></w:r><w:r><w:t>{r['key']} &amp; {escape(r['priority'])}</w:t></w:r></w:p>" for r in rows]
    return _zipped({"word/document.xml": f'<w:document xmlns:w="{_WORDS}"><w:body>{"".join(said)}</w:body></w:document>'})


def _page(customer: int, rows: list[dict]) -> bytes:
    """A page: the same under its heading, after a head and before an empty table."""
    said = "".join(f"<{tag}>Order <b>{r['key']}</b> &amp; {escape(r['priority'])}</{tag}>" for r in rows for tag in ("li" if r["key"] % 2 else "p",))
    return f"<html><head><title>T</title><p>head</p></head><body><script>var p = '<p>no</p>';</script><h2>Orders of {customer}</h2>{said}<table><tr><td></td></tr></table></body></html>".encode()


def _workbook(rows: list[dict]) -> bytes:
    """A workbook: a sheet of all orders, with numbers, shared and inline texts and an empty column, and an empty one."""
    shared = sorted({r["priority"] for r in rows})
    cells = lambda n, r: f'<row r="{n}"><c r="A{n}"><v>{r["key"]}</v></c><c r="B{n}" t="s"><v>{shared.index(r["priority"])}</v></c><c r="D{n}" t="inlineStr"><is><t>{r["status"]}</t></is></c></row>'
    head = '<row r="1"><c r="A1" t="inlineStr"><is><t>Key</t></is></c><c r="B1" t="inlineStr"><is><t>Priority</t></is></c></row>'
    sheet = f'<worksheet xmlns="{_SHEETS}"><sheetData>{head}{"".join(cells(n, r) for n, r in enumerate(rows, 2))}</sheetData></worksheet>'
    return _zipped(
        {
            "xl/workbook.xml": f'<workbook xmlns="{_SHEETS}" xmlns:r="{_LINKS}"><sheets><sheet name="All" sheetId="1" r:id="r1"/><sheet name="None" sheetId="2" r:id="r2"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/one.xml"/><Relationship Id="r2" Target="/xl/worksheets/two.xml"/></Relationships>',
            "xl/worksheets/one.xml": sheet,
            "xl/worksheets/two.xml": f'<worksheet xmlns="{_SHEETS}"><sheetData/></worksheet>',
            "xl/sharedStrings.xml": f'<sst xmlns="{_SHEETS}">{"".join(f"<si><t>{escape(p)}</t></si>" for p in shared)}</sst>',
        }
    )


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, file_type, content): each customer's orders as a document, a workbook, a table or a page."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")))).alias("rows"))
    kinds = ("docx", "xlsx", "csv", "html")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            table_of = lambda rows: ("\ufeffKey,Priority,Status\r\n" + "".join(f'{r["key"]},"{r["priority"]}",{r["status"]}\r\n' for r in rows)).encode()
            content = [(_document(k, rows), _workbook(rows), table_of(rows), _page(k, rows))[k % 4] for k, rows in zip(keys, lists)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([kinds[k % 4] for k in keys]), pa.array(content, pa.binary())], names=["o_custkey", "file_type", "content"])

    return rows.mapInArrow(made, "o_custkey long, file_type string, content binary")


def parsed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of documents, workbooks, tables and pages, with their places."""
    rows = html_blocks.parsed(_files(spark, sf_dir)).select("o_custkey", F.posexplode("blocks").alias("pos", "b"))
    return rows.select("o_custkey", "pos", "b.text", "b.block_type", F.to_json(html_blocks.locator(F.col("b"))).alias("locator"))


def parsed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the same files, half of the tables with nothing in them."""
    files = _files(spark, sf_dir).withColumn("content", F.when(F.col("o_custkey") % 8 == 2, F.encode(F.lit("Key,Priority"), "UTF-8")).otherwise(F.col("content")))
    rows = html_blocks.parsed(files)
    return rows.select("o_custkey", html_blocks.is_empty(F.col("blocks")).alias("empty"), F.md5(html_blocks.document_text(F.col("blocks")).cast("binary")).alias("md5"), "parse_error")


def office_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as uploads for a prompt."""
    media = F.create_map(*[F.lit(x) for kind in ("docx", "xlsx", "csv") for x in (kind, attachments.KINDS[kind][0])])
    files = _files(spark, sf_dir).select("o_custkey", F.concat(F.lit("f."), "file_type").alias("filename"), F.try_element_at(media, F.col("file_type")).alias("content_type"), "content").where("o_custkey % 4 < 2")
    return attachments.attachment_texts(files).select("o_custkey", "kind", "text")


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder: one for each source, with size and digest."""
    folder = f"{shared_folder(spark)}/objects-{uuid.uuid4().hex}"
    lines = table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda d: d.cast("string")), ",").alias("value"))
    lines.repartition("source").write.partitionBy("source").text(folder)
    found = feeds.stored_files(spark, folder, "*.txt")
    return found.select(F.try_url_decode(F.regexp_extract("path", "source=([^/]+)/", 1)).alias("source"), F.col("length").cast("long").alias("length"), "sha256")


QUERIES = {f.__name__: f for f in (parsed_files, parsed_texts, office_attachments, stored_objects)}

_BLOCKS = """
o AS (SELECT o_custkey, o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS s, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS n FROM orders),
b AS (SELECT o_custkey, n - 1 AS pos, k,
  CASE WHEN o_custkey % 4 IN (0, 3) THEN 'Order ' || k || ' & ' || p WHEN o_custkey % 4 = 1 THEN 'Key: ' || k || ' | Priority: ' || p || ' | Column 3: ' || s ELSE 'Key: ' || k || ' | Priority: ' || p || ' | Status: ' || s END AS text,
  CASE WHEN o_custkey % 4 IN (1, 2) THEN 'row' WHEN k % 2 = 1 THEN 'list_item' ELSE 'paragraph' END AS block_type,
  CASE WHEN o_custkey % 4 IN (0, 3) THEN '{"section_heading":"Orders of ' || o_custkey || '"}' WHEN o_custkey % 4 = 1 THEN '{"sheet_name":"All","row_number":"' || (n + 1) || '","row_label":"' || k || '"}' ELSE '{"row_number":"' || (n + 1) || '","row_label":"' || k || '"}' END AS locator FROM o)
"""
ORACLE_SQL = {
    "parsed_files": f"WITH {_BLOCKS} SELECT o_custkey, CAST(pos AS INTEGER) AS pos, text, block_type, locator FROM b",
    "parsed_texts": f"WITH {_BLOCKS} SELECT o_custkey, o_custkey % 8 = 2 AS empty, md5(CASE WHEN o_custkey % 8 = 2 THEN '' ELSE string_agg(text, chr(10) || chr(10) ORDER BY pos) END) AS md5, CAST(NULL AS VARCHAR) AS parse_error FROM b GROUP BY o_custkey",
    "office_attachments": """
WITH o AS (SELECT o_custkey AS c, string_agg('Order ' || o_orderkey || ' & ' || o_orderpriority, chr(10) || chr(10) ORDER BY o_orderkey) AS words, string_agg('| ' || o_orderkey || ' | ' || o_orderpriority || ' |', chr(10) ORDER BY o_orderkey) AS sheet FROM orders GROUP BY 1)
SELECT c AS o_custkey, CASE c % 4 WHEN 0 THEN 'docx' ELSE 'xlsx' END AS kind, CASE c % 4 WHEN 0 THEN '[DOCX: f.docx]' || chr(10) || 'Orders of ' || c || chr(10) || chr(10) || words ELSE '[XLSX: f.xlsx]' || chr(10) || '### Sheet: All' || chr(10) || '| Key | Priority |' || chr(10) || '| --- | --- |' || chr(10) || sheet END AS text FROM o WHERE c % 4 < 2""",
    "stored_objects": "WITH s AS (SELECT source, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) || chr(10) AS t FROM documents GROUP BY 1) SELECT source, strlen(t) AS length, sha256(t) AS sha256 FROM s",
}
