"""Media columns: interleaved document sequences whose payloads are resolved by digest.

A page's HTML becomes an ordered array of structs, text and media references in the order in which
they stand: ``(position, kind, text, digest, caption)``.  Payloads live once each in a media table
keyed by the SHA-256 digest of their bytes; a join on the digest resolves the references, and as each
reference carries its position and caption, those stay aligned whatever order the join returns.

The stored form is a binary grey map (PGM, ``P5``): one 8-bit sample per payload byte in rows of 64,
lossless by construction.  ``stored_media`` writes (digest, stored bytes) to a table, without moving
payloads between tasks: a payload is stored once by each task that meets it.  Features are computed
from the bytes read back from that table, and only those small rows are dealt out by digest.

A digest that very many references share is no hot key: references whose digest has more than
``HOT_SHARE`` of them (so there are at most that many such digests, and their list can be broadcast)
are dealt over parts, and the payload's row is repeated for each part.

Defined results: null texts are empty, an empty payload is one row of zero samples; pages without
media have an empty reference list; references without a stored payload keep null payload columns;
equal payloads give one row of media; null HTML gives an empty sequence.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marisight.llm._batches import slices
from marisight.llm._shared import written

ROW = 64
#: a digest is hot with more than one in so many references (and ``HOT_LEAST``); there are at most so many hot ones
HOT_SHARE, HOT_LEAST = 10_000, 1000
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.S | re.I)
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
#: elements that end an unclosed caption where they begin
_BLOCKS = frozenset("address article aside blockquote div dl figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"


def interleaved(page: str) -> list[dict]:
    """Text runs and media references of one page, in page order.  ``<img>``, ``<audio>``, ``<video>`` and
    ``<source>`` are references when their address is ``sha256:…``; a ``<figcaption>`` belongs to the
    references of its figure, otherwise the ``alt`` text is the caption.  A caption whose end is left out ends with
    its figure, or where the next block begins, or with the page; scripts and styles are no text."""
    out: list[dict] = []
    at, caption, figure = 0, None, []

    def text(raw: str) -> None:
        nonlocal caption
        said = " ".join(html.unescape(raw).split())
        if not said:
            return
        if caption is not None:
            caption.append(said)
        elif out and out[-1]["kind"] == "text":
            out[-1]["text"] += " " + said
        else:
            out.append({"kind": "text", "text": said, "digest": None, "caption": None})

    def end_caption() -> None:
        nonlocal caption
        if caption is not None:
            for ref in figure:
                ref["caption"] = " ".join(caption)
            caption = None

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = _NAME.match(m[0])
        if not tag or m[1]:
            continue
        closing, name = tag[1], tag[2].lower()
        if name in ("figure", "figcaption") or (name in _BLOCKS and not closing):
            end_caption()
        if name == "figure":
            figure = []
        elif name == "figcaption":
            if not closing:
                caption = []
        elif name in ("img", "audio", "video", "source") and not closing:
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(m[0])}
            src = found.get("src", "")
            if src.startswith("sha256:"):
                out.append({"kind": "media", "text": None, "digest": src[7:].lower(), "caption": found.get("alt")})
                figure.append(out[-1])
    text(page[at:])
    end_caption()
    return [{"position": i, **x} for i, x in enumerate(out)]


def sequences(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """pages with ``sequence``, the interleaved structs of its HTML."""
    kept = pages.select(*[c for c in pages.columns if c != "sequence"])
    at, names = kept.columns.index(html_column), [*kept.columns, "sequence"]
    schema = StructType([*kept.schema.fields, StructField("sequence", StructType.fromDDL(f"s {SEQUENCE}")[0].dataType)])
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            made = pa.array([interleaved(x or "") for x in batch.column(at).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=names)

    return kept.mapInArrow(run, schema)


def padded(text: Column) -> Column:
    """UTF-8 bytes of a text with zero bytes up to a positive multiple of ROW; null is empty."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    n = F.octet_length(raw)
    pad = F.when(n == 0, F.lit(ROW)).otherwise((F.lit(ROW) - n % ROW) % ROW)
    return F.concat(raw, F.substr(F.lit(bytes(ROW)), F.lit(1), pad))


def store(payload: Column) -> Column:
    """The stored form: a PGM header and one sample per byte."""
    rows = (F.octet_length(payload) / ROW).cast("int")
    return F.concat(F.encode(F.concat(F.lit(f"P5\n{ROW} "), rows.cast("string"), F.lit("\n255\n")), "UTF-8"), payload)


def samples(stored: bytes) -> memoryview:
    """The samples of a stored form, checked against its header."""
    magic, size, depth = stored.split(b"\n", 3)[:3]
    width, height = map(int, size.split())
    start = len(magic) + len(size) + len(depth) + 3
    body = memoryview(stored)[start:]
    if magic != b"P5" or depth != b"255" or len(body) != width * height:
        raise ValueError("not a complete 8-bit grey map")
    return body


def feature(body: memoryview) -> str:
    """Mean, deviation, entropy, distinct levels and row-to-row change of the samples."""
    x = np.frombuffer(body, np.uint8)
    counts = np.bincount(x, minlength=256)
    p = counts[counts > 0] / len(x)
    mean = float(x.mean())
    grid = x.reshape(-1, ROW).astype(np.int16)
    change = float(np.abs(np.diff(grid, axis=0)).mean()) if len(grid) > 1 else 0.0
    return f"mean={mean:.4f};dev={float(x.std()):.4f};bits={float(-(p * np.log2(p)).sum()):.4f};levels={len(p)};change={change:.4f}"


def features(media: DataFrame, stored: str = "stored") -> DataFrame:
    """media without its stored bytes, with what reading them back gives."""
    names = [c for c in media.columns if c != stored]
    kept = media.select(stored, *names)
    schema = StructType([*kept.schema.fields[1:], *StructType.fromDDL("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            rows: list[list] = [[] for _ in range(6)]
            for cell in batch.column(0):
                whole = cell.as_py()
                body = samples(whole)
                for column, value in zip(rows, (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-ROW:]), len(whole), hashlib.sha256(whole).hexdigest(), feature(body))):
                    column.append(value)
            made = [pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*names, *schema.names[len(names) :]])

    return kept.mapInArrow(run, schema)


def references(pages: DataFrame, sequence: str = "sequence") -> DataFrame:
    """One row per media reference: the page's columns, position, digest and caption."""
    names = [c for c in pages.columns if c != sequence]
    return pages.select(*names, F.explode(F.filter(sequence, lambda s: s["kind"] == "media")).alias("_ref")).select(*names, "_ref.position", "_ref.digest", "_ref.caption")


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest this task hasn't met yet."""
    met: set[bytes] = set()
    for batch in batches:
        new = []
        for d in batch.column(0).to_pylist():
            key = bytes.fromhex(d)
            new.append(key not in met)
            met.add(key)
        yield batch.filter(pa.array(new, pa.bool_()))


def stored_media(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """(digest, stored) of all payloads, written to the shared folder and read back."""
    rows = payloads.select(F.sha2(payload, 256).alias("digest"), store(F.col(payload)).alias("stored"))
    return written(rows.mapInArrow(_once, rows.schema), "media")


def described(media: DataFrame) -> DataFrame:
    """One row per digest: the features of its stored bytes."""
    found = features(media)
    return found.groupBy("digest").agg(*[F.first(c).alias(c) for c in found.columns if c != "digest"])


def resolve(refs: DataFrame, media: DataFrame, hot_least: int = HOT_LEAST, prefix: str = "media_") -> DataFrame:
    """References with the columns of their payload; ``media`` holds one row per digest.  Payload columns whose names
    references have too get the prefix."""
    taken = {c.lower() for c in refs.columns} - {"digest"}
    media = media.withColumnsRenamed({c: prefix + c for c in media.columns if c.lower() in taken})
    counts = refs.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.count(F.lit(1)).alias("__n"))
    most = max(hot_least, refs.count() // HOT_SHARE)
    hot = F.broadcast(counts.where(F.col("__n") > most).select("digest", F.ceil(F.col("__n") / most).cast("int").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1))
    spread = refs.join(hot, "digest", "left").withColumn("__part", F.floor(F.rand(7) * parts).cast("int")).drop("__parts")
    copies = media.join(hot, "digest", "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return spread.join(copies, ["digest", "__part"], "left").drop("__part")


def op7_media_columns(spark, sf_dir: str) -> DataFrame:
    """Every whole document as a payload behind an interleaved page that refers to it by digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = docs.select("doc_id", padded(F.col("text")).alias("payload"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    media = written(described(stored_media(held)), "features")
    page = F.concat(F.lit("<p>payload</p><figure><img src=\"sha256:"), F.sha2("payload", 256), F.lit("\"><figcaption>"), F.col("n_bytes").cast("string"), F.lit(" bytes</figcaption></figure>"))
    refs = written(references(sequences(held.select("doc_id", "n_bytes", page.alias("html"))).drop("html")), "references")
    return resolve(refs, media).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
