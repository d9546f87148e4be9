"""Small helpers shared by the Arrow passes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: null ids take part as the smallest id
NULL_ID = -(1 << 63)


def key_of(doc_id: str = "doc_id") -> Column:
    """A non-null key of a document: its id, null ids first."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID).cast("long"))


def text_key(text: str = "text") -> Column:
    """A 31-bit checksum of the text: tells apart rows that share an id but not a text."""
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).bitwiseAND(0x7FFFFFFF)


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 4 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``most`` bytes of column ``text`` and at most ``rows`` rows
    (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        total, lo = np.cumsum(sizes), 0
        while lo < n:
            base = total[lo - 1] if lo else 0
            hi = min(lo + rows, max(lo + 1, int(np.searchsorted(total, base + most, side="right"))))
            yield batch.slice(lo, hi - lo)
            lo = hi
    give_back()


def give_back() -> None:
    """Returns what a finished pass has freed to the system: workers live on, and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def longs(column: pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()), dtype=np.int64)
