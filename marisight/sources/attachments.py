"""Uploaded files as text for a prompt: by media type first, then by name."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marisight.sources.html_blocks import docx_blocks, xlsx_rows

#: fixed values: media types of each kind of file
KINDS = {
    "image": ("image/png", "image/jpeg", "image/gif", "image/webp"),
    "pdf": ("application/pdf",),
    "docx": ("application/vnd.openxmlformats-officedocument.wordprocessingml.document",),
    "xlsx": ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.ms-excel"),
    "csv": ("text/csv", "application/csv"),
    "text": ("text/plain", "text/markdown"),
}


def attachment_kind(content_type: Column, name: Column) -> Column:
    """image, pdf, docx, xlsx, csv or text (whatever else there is counts as text)."""
    media = F.trim(F.split_part(F.lower(F.coalesce(content_type, F.lit(""))), F.lit(";"), F.lit(1)))
    out = F.lit("text")
    for kind in reversed(KINDS):
        out = F.when(media.isin(*KINDS[kind]), kind).otherwise(out)
    # a plain-text type doesn't hide a table: names ending in .csv are looked at before it
    return F.when((out == "text") & F.endswith(F.lower(name), F.lit(".csv")), "csv").otherwise(out)


def _markdown(rows: list[list[str]]) -> str:
    width = len(rows[0])
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([line(rows[0]), line(["---"] * width), *[line((r + [""] * width)[:width]) for r in rows[1:]]])


def _docx(payload: bytes) -> str:
    return "\n\n".join(b["text"] for b in docx_blocks(payload, headings=True))


def _xlsx(payload: bytes) -> str:
    return "\n\n".join(f"### Sheet: {name}\n{_markdown(rows)}" for name, rows in xlsx_rows(payload) if rows)


def _csv(payload: bytes) -> str:
    rows = list(csv.reader(io.StringIO(payload.decode("utf-8", "replace"))))
    return _markdown(rows) if rows else ""


#: fixed values: labels of files, and what is said of those that can't be read
_FORMS = {"docx": (_docx, "DOCX", "[DOCX file uploaded: {} — text extraction unavailable]"), "xlsx": (_xlsx, "XLSX", "[XLSX file uploaded: {} — spreadsheet parsing unavailable]"), "csv": (_csv, "CSV", "[CSV file uploaded: {} — could not parse]")}


def attachment_texts(files: DataFrame, name: str = "filename", content_type: str = "content_type", content: str = "content") -> DataFrame:
    """files (without the payload) with ``kind`` and ``text``: ``[CSV: name]`` and the like over a markdown table or the
    text; images and PDFs have no text, they go to a model as they are.  Files that can't be read say so."""
    kept = [c for c in files.columns if c not in (content, "kind", "text")]
    rows = files.select(F.col(content).cast("binary").alias("__payload"), F.col(name).alias("__name"), attachment_kind(F.col(content_type), F.col(name)).alias("kind"), *kept)
    schema = StructType([*files.select(*kept).schema.fields, StructField("kind", StringType()), StructField("text", StringType())])

    def said(payload: bytes, name: str, kind: str) -> str | None:
        if kind in ("image", "pdf"):
            return None
        if kind == "text":
            return f"[File: {name}]\n{payload.decode('utf-8', 'replace')}"
        read, label, failed = _FORMS[kind]
        try:
            text = read(payload)
        except (ValueError, KeyError, IndexError, zipfile.BadZipFile, ElementTree.ParseError, csv.Error):
            text = ""
        return f"[{label}: {name}]\n{text}" if text else failed.format(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [said(p or b"", n or "", k) for p, n, k in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], batch.column(2), pa.array(texts, pa.string())], names=[*kept, "kind", "text"])

    return rows.mapInArrow(run, schema)
