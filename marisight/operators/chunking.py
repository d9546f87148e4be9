"""Section-aware chunks of parsed documents.

Islands of blocks under one heading come from a window over each document; packing is a fold over a
section's blocks, done in Arrow over arrays that a document bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

TARGET, TABLE_MOST, PARENT_MOST = 1400, 3000, 3000
#: characters of chunks and their sections that are sent together
CHARS_AT_ONCE = 2_000_000


def sections(blocks: DataFrame, document: str = "doc_id") -> DataFrame:
    """Block rows (document, block_idx, section_heading, …) with ``section_no``: consecutive blocks of one heading."""
    w = Window.partitionBy(document).orderBy("block_idx")
    turn = ~F.col("section_heading").eqNullSafe(F.lag("section_heading").over(w)) | (F.row_number().over(w) == 1)
    return blocks.withColumn("section_no", F.sum(turn.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def section_texts(blocks: DataFrame, document: str = "doc_id") -> DataFrame:
    """(document, section_no, section_heading, section_text, parent_text, n_blocks)."""
    parts = F.array_sort(F.collect_list(F.struct("block_idx", F.trim("text").alias("text"))))
    said = F.array_join(F.filter(F.transform(parts, lambda p: p["text"]), lambda t: t != ""), "\n\n")
    out = sections(blocks, document).groupBy(document, "section_no").agg(F.first("section_heading").alias("section_heading"), said.alias("section_text"), F.count(F.lit(1)).alias("n_blocks"))
    return out.withColumn("parent_text", F.nullif(F.substring("section_text", 1, PARENT_MOST), F.lit("")))


def hard_split(text: Column, most: int = TARGET) -> Column:
    """Pieces of at most ``most`` characters."""
    n = F.greatest(F.ceil(F.length(text) / most).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * most + 1, F.lit(most)))


def split_table(text: str, most: int) -> list[str]:
    """A table by rows, each part under the header (and its rule)."""
    lines = text.split("\n")
    head = 2 if len(lines) > 1 and lines[1].strip().startswith(("|--", "---")) else 1
    if len(lines) <= head:
        return [text]
    header = "\n".join(lines[:head])
    parts: list[list[str]] = [[]]
    size = len(header)
    for row in lines[head:]:
        if parts[-1] and size + len(row) + 1 > most:
            parts.append([])
            size = len(header)
        parts[-1].append(row)
        size += len(row) + 1
    return [header + "\n" + "\n".join(p) for p in parts]


def pack(blocks: list[dict], target: int = TARGET, table_most: int = TABLE_MOST) -> list[dict]:
    """Chunks of one section's blocks (text, block_type, section_heading): prose packed up to ``target``
    characters with blank lines between, tables on their own."""
    out: list[dict] = []
    held: list[str] = []
    length = n = 0

    def flush() -> None:
        nonlocal length, n
        if held:
            out.append({"text": "\n\n".join(held), "is_table": False, "block_count": n})
            held.clear()
            length = n = 0

    for b in blocks:
        text = (b["text"] or "").strip()
        if not text:
            continue
        if b["block_type"] == "table":
            flush()
            prefix = f"Table from section: {b['section_heading']}\n\n" if b["section_heading"] else ""
            whole = len(prefix) + len(text) <= table_most
            for part in [text] if whole else split_table(text, table_most - len(prefix)):
                out.append({"text": prefix + part, "is_table": True, "block_count": 1})
            continue
        for at in range(0, len(text), target):
            piece = text[at : at + target]
            if held and length + 2 + len(piece) > target:
                flush()
            length += len(piece) + (2 if held else 0)
            held.append(piece)
            n += 1
    flush()
    return out


def chunks(blocks: DataFrame, document: str = "doc_id", target: int = TARGET, table_most: int = TABLE_MOST) -> DataFrame:
    """(document, chunk_index, chunk_text, is_table, block_count, section_heading, parent_text) of block rows."""
    part = F.array_sort(F.collect_list(F.struct("section_no", "block_idx", "text", "block_type", "section_heading")))
    docs = sections(blocks, document).groupBy(document).agg(part.alias("blocks"))
    kind = docs.schema[document].dataType.simpleString()

    types = (pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.string())
    names = [document, "chunk_index", "chunk_text", "is_table", "block_count", "section_heading", "parent_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, rows, owner, chars = batch.column(0), [], [], 0

            def made() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([who.take(pa.array(owner, pa.int64())), *[pa.array(list(c), t) for c, t in zip(zip(*rows), types)]], names=names)

            for i in range(batch.num_rows):  # one document at a time, whatever the batch
                doc = batch.column(1)[i].as_py()
                index, lo = 0, 0
                while lo < len(doc):
                    hi = lo
                    while hi < len(doc) and doc[hi]["section_no"] == doc[lo]["section_no"]:
                        hi += 1
                    section = doc[lo:hi]
                    parent = "\n\n".join(t for b in section if (t := (b["text"] or "").strip()))[:PARENT_MOST] or None
                    for c in pack(section, target, table_most):
                        rows.append((index, c["text"], c["is_table"], c["block_count"], section[0]["section_heading"], parent))
                        owner.append(i)
                        chars += len(c["text"]) + len(parent or "")
                        index += 1
                    lo = hi
                    if chars >= CHARS_AT_ONCE:
                        yield made()
                        rows, owner, chars = [], [], 0
            if rows:
                yield made()

    return docs.mapInArrow(run, f"{document} {kind}, chunk_index int, chunk_text string, is_table boolean, block_count int, section_heading string, parent_text string")


def neighbour_context(chunk_rows: DataFrame, document: str = "doc_id", around: int = 2, most: int = PARENT_MOST) -> DataFrame:
    """chunk rows with ``context``: the texts of up to ``around`` chunks on both sides."""
    w = Window.partitionBy(document).orderBy("chunk_index").rowsBetween(-around, around)
    return chunk_rows.withColumn("context", F.substring(F.array_join(F.collect_list("chunk_text").over(w), "\n\n"), 1, most))


def chunk_metadata(metadata: Column, file_type: Column, title: Column, locators: Column, block_count: Column, is_table: Column) -> Column:
    """A chunk's metadata as JSON with keys in order: the document's, its type and title (if it has one), where the
    chunk's blocks stand (array<map<string,string>>), their number, and whether they are a table."""
    own = F.map_filter(F.create_map(F.lit("block_count"), block_count.cast("string"), F.lit("file_type"), file_type, F.lit("is_table"), F.when(is_table, F.lit("true")), F.lit("locators"), F.to_json(locators), F.lit("title"), F.nullif(title, F.lit(""))), lambda k, v: v.isNotNull())
    base = F.coalesce(metadata, F.create_map().cast("map<string,string>"))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(own), k)), own)))))


#: characters of a document that a generator of contexts sees
CONTEXT_MOST = 6000


def context_request(document_text: Column) -> Column:
    """The part of a document that goes to a generator of contexts."""
    return F.substring(document_text, 1, CONTEXT_MOST)


def contextual(prefix: Column, text: Column) -> Column:
    """A generated context before the text, when there is one."""
    return F.when(F.coalesce(F.trim(prefix), F.lit("")) != "", F.concat(prefix, F.lit("\n\n"), text)).otherwise(text)


def embed_batches(chunk_rows: DataFrame, document: str = "doc_id", most_chars: int = 800_000) -> DataFrame:
    """chunk rows with ``embed_batch``: the batches of each document, filled in order.  A chunk that would take its batch
    over ``most_chars`` begins the next one, so only a chunk that is longer itself makes a batch longer.  A fold over
    rows in order, whose state is a document's batch and its characters.  ``indexable`` drops empty chunks and cuts
    what no embedding takes."""
    names = chunk_rows.columns
    rows = chunk_rows.select("*", F.coalesce(F.length("chunk_text"), F.lit(0)).cast("long").alias("_chars"), F.coalesce(F.col(document).cast("string"), F.lit("\0")).alias("_of"))
    rows = rows.repartition("_of").sortWithinPartitions("_of", "chunk_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, chars = None, 0, 0
        for part in batches:
            out = []
            for of, size in zip(part.column("_of").to_pylist(), part.column("_chars").to_pylist()):
                if of != now:
                    now, number, chars = of, 0, 0
                elif chars + size > most_chars:
                    number, chars = number + 1, 0
                chars += size
                out.append(number)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(out, pa.int32())], names=[*names, "embed_batch"])

    return rows.mapInArrow(run, StructType([*chunk_rows.schema.fields, StructField("embed_batch", IntegerType())]))


def indexable(chunk_rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Chunks with text, none longer than an embedding call takes."""
    return chunk_rows.where(F.trim(F.coalesce("chunk_text", F.lit(""))) != "").withColumn("chunk_text", F.substring("chunk_text", 1, most))
