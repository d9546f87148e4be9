"""Packing documents into fixed-length training sequences along a space-filling curve.

1. Each document is encoded and gets a hashed vector: its words fall into ``BUCKETS`` buckets, and every
   bucket has a pseudorandom direction of ``DIMS`` signs.  The mean direction of its words is the random
   projection of the vector; similar documents come out near each other.  Encoded documents are written
   once as Parquet.
2. A document's first ids go as whole sequences of its own, as many as it fills; they move nowhere.
3. The projection's cell is numbered by the Hilbert curve, and what is left of the documents, less than a sequence
   of each, is range-sorted by that number: rows are small, so ranges of equal numbers of rows are equally large.
4. Each range is one stream of ids that is cut every ``length`` ids: neighbours on the curve share
   sequences.  What is left at a range's end goes into sequences whose lengths are the powers of two that
   add up to it.  A sequence of a power of two needs no padding, so there is none at all.

How ids are found: a text is cut at each single space between two characters that aren't white space.
The vocabulary's pattern always starts a new piece there, so cuts are encoded apart, and each *distinct*
cut of a slice of documents once.  Cuts of ASCII and Latin letters go through the rank form of the same
vocabulary where one is given, as one text; all others, and all if none is given, through the tokenizers
library.

A third of all documents may be equal: equal documents share a curve number, and the range sort tells them
apart by id and by row, so a range never holds one key whole.  A task holds a few MB of ids at a time.

Defined results: a null or empty text is its end id alone; ids that are null stay so; repeated rows are
separate documents; equal documents follow one another; an empty table gives no pieces.  Extra columns are
not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisight.llm import _words as W
from marisight.llm._batches import longs, slices
from marisight.llm._shared import written

LENGTH = 2048
END_ID = 1
BUCKETS = 4096
DIMS = 4
BITS = 12
_SLICE = 8 << 20

#: bytes beside which a single space may be cut: printable ASCII, and the leading bytes of U+00C0 to U+024F
_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True
_LATIN = np.zeros(256, bool)
_LATIN[0xC3:0xCA] = True
#: bytes that send a cut to the tokenizers library: what isn't ASCII or a Latin letter, and control characters
_OTHER = np.zeros(256, bool)
_OTHER[[*range(9), *range(0x0E, 0x20), 0x7F, 0xC2, *range(0xCA, 0x100)]] = True


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The Hilbert curve's number of each cell (rows of ``bits``-bit coordinates), after Skilling's transposed form."""
    x = [np.ascontiguousarray(c, dtype=np.uint64) for c in cells.T]
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(dims):
            hit = (x[i] & high) != 0
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(hit, low, swap) if i else np.where(hit, x[0] ^ low, x[0])
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(x[0]), np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    number = np.zeros(len(flip), np.uint64)
    for b in range(bits - 1, -1, -1):
        for c in x:
            number = (number << np.uint64(1)) | (((c ^ flip) >> np.uint64(b)) & np.uint64(1))
    return number


@cache
def _directions() -> np.ndarray:
    """Each bucket's ``DIMS`` signs, 1 for plus: in row r the signs 2r (low half of the number) and 2r + 1 (high half)."""
    bits = W.mix(np.arange(BUCKETS, dtype=np.uint64) + np.uint64(0x51ED))
    sign = lambda i: (bits >> np.uint64(i)) & np.uint64(1)
    return np.stack([sign(i) | sign(i + 1) << np.uint64(32) for i in range(0, DIMS, 2)])


def curve_numbers(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hilbert numbers of the mean directions ``total / n``: square roots spread the crowded middle of each axis."""
    mean = total / np.maximum(n, 1)[:, None]
    spread = np.sign(mean) * np.sqrt(np.abs(mean))
    cell = np.clip(np.floor((spread + 1) * (1 << BITS - 1)), 0, (1 << BITS) - 1)
    return W.signed(hilbert(cell.astype(np.uint64), BITS))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in data where a text or a cut of it starts, and the end."""
    n = len(data)
    is_cut = np.zeros(n + 1, bool)
    if n > 3:
        before = _PLAIN[data]
        before[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & _LATIN[data[:-1]]
        after = _PLAIN[data] | _LATIN[data]
        is_cut[1 : n - 1] = (data[1 : n - 1] == 0x20) & before[: n - 2] & after[2:n]
    is_cut[offsets] = True
    is_cut[n] = True
    return np.flatnonzero(is_cut)


class Encoder:
    """Ids of whole texts by a tokenizers file; ``ranks`` may name the same vocabulary in its rank form."""

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.specials = [x.content.encode() for x in self.library.get_added_tokens_decoder().values()]
        self.fast = None
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
            self.bytes_of = np.zeros(max(known.values()) + 1, np.int64)
            for piece, i in known.items():
                self.bytes_of[i] = len(piece)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a string column: all ids, where each row's begin (and the end), and each row's direction sums and words."""
        data, offsets = W.utf8(column)
        data = np.ascontiguousarray(data)
        at = _cuts(data, offsets)
        first = np.searchsorted(at, offsets)
        cuts = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = cuts.dictionary_encode()
        distinct, which = coded.dictionary.cast(pa.large_binary()), np.asarray(coded.indices, dtype=np.int64)
        ids, ends = self._distinct(distinct)
        per_cut = np.diff(ends)[which]
        starts = np.r_[0, np.cumsum(per_cut)]
        place = np.int32 if max(len(ids), starts[-1]) < 1 << 31 else np.int64
        flat = ids[np.arange(starts[-1], dtype=place) + np.repeat((ends[which] - starts[:-1]).astype(place), per_cut)]
        words = np.diff(first)
        sums = np.empty((len(words), DIMS), np.int64)
        running = np.zeros(len(which) + 1, np.uint64)
        for lane, pair in enumerate(_directions()[:, self._buckets(distinct)]):
            np.cumsum(pair[which], out=running[1:])
            plus = running[first[1:]] - running[first[:-1]]  # two counts in 32 bits each
            sums[:, 2 * lane], sums[:, 2 * lane + 1] = 2 * (plus & np.uint64(0xFFFFFFFF)).astype(np.int64) - words, 2 * (plus >> np.uint64(32)).astype(np.int64) - words
        return flat, starts[first], sums, words

    @staticmethod
    def _buckets(distinct: pa.Array) -> np.ndarray:
        """The bucket of each distinct cut: of its bytes without the leading space."""
        data, offsets = W.utf8(distinct)
        if not len(distinct):
            return np.zeros(0, np.int64)
        start = offsets[:-1] + (data[offsets[:-1]] == 0x20)
        return (W.word_hashes(W.Words(data, start, offsets[1:], offsets)) % np.uint64(BUCKETS)).astype(np.int64)

    def _distinct(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct cuts, end to end, and where each one's begin (and the end)."""
        n = len(distinct)
        if not n:
            return np.zeros(0, self.kind), np.zeros(1, np.int64)
        data, offsets = W.utf8(distinct)
        joined = np.zeros(n, bool)
        if self.fast is not None:  # cuts that start with their space and end in no white space can stand in one text
            joined = (data[offsets[:-1]] == 0x20) & (data[offsets[1:] - 1] > 0x20) & ~np.maximum.reduceat(_OTHER[data], offsets[:-1])
            text = data.tobytes()
            for special in self.specials:
                found = text.find(special)
                while found >= 0:
                    joined[np.searchsorted(offsets, found, side="right") - 1] = False
                    found = text.find(special, found + 1)
        at, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
        count = np.zeros(n, np.int64)
        size = np.diff(offsets)
        fast = slow = np.zeros(0, np.int64)
        if len(at):
            keep = np.repeat(joined, size)
            fast = np.array(self.fast.encode_ordinary(data[keep].tobytes().decode()), dtype=np.int32)
            edges = np.searchsorted(np.cumsum(self.bytes_of[fast]), np.cumsum(size[at])) + 1
            count[at] = np.diff(edges, prepend=0)
        if len(alone):
            texts = [x.decode() for x in distinct.take(pa.array(alone)).to_pylist()]
            found = [x.ids for x in self.library.encode_batch(texts, add_special_tokens=False)]
            count[alone] = [len(x) for x in found]
            slow = np.array([i for x in found for i in x], dtype=np.int64)
        ends = np.r_[0, np.cumsum(count)]
        ids = np.empty(ends[-1], self.kind)
        to_fast = np.repeat(joined, count)
        ids[to_fast], ids[~to_fast] = fast, slow
        return ids, ends


@cache
def _encoder(*what: str | None) -> Encoder:
    return Encoder(*what)


def encoded(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, curve, doc_tokens, ids), written to the shared folder: ids of the whole text and the end id,
    as little-endian integers of ``Encoder.kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode = _encoder(tokenizer, ranks, pattern)
        for batch in slices(batches, 1, _SLICE):
            flat, first, sums, words = encode(batch.column(1))
            ids = np.insert(flat, first[1:], end_id)
            first = first + np.arange(len(first))
            width = np.dtype(encode.kind).itemsize
            blob = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer((first * width).astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(curve_numbers(sums, words)), pa.array(np.diff(first)), blob], names=["doc_id", "curve", "doc_tokens", "ids"])

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = plain.mapInArrow(run, "doc_id long, curve long, doc_tokens long, ids binary")
    return written(made.withColumn("row", F.monotonically_increasing_id()), "encoded")


def _powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _whole(length: int, kind: str):
    """Documents in: the sequences that each of them fills alone out."""
    size = np.dtype(kind).itemsize * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 1 << 62 | TaskContext.get().partitionId() << 40
        for batch in slices(batches, 2, _SLICE):
            tokens = longs(batch.column(1))
            full = tokens // length
            of = np.repeat(np.arange(len(full)), full)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(full) - full, full)) * length
            data = b"".join(ids.as_buffer().to_pybytes()[: n * size] for ids, n in zip(batch.column(2), full.tolist()))
            blob = pa.Array.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(np.arange(len(of) + 1) * (4 * length)), pa.py_buffer(np.frombuffer(data, kind).astype("<u4"))]).cast(pa.binary())
            columns = [batch.column(0).take(pa.array(of)), pa.array(start), pa.array(np.full(len(of), length)), blob, pa.array(tokens[of]), pa.array(number + np.arange(len(of))), pa.array(np.zeros(len(of), np.int64))]
            number += len(of)
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def _packed(length: int, kind: str):
    """What is left of documents, in the order of one range, in: its pieces out."""
    width = np.dtype(kind).itemsize

    def pieces(ids: np.ndarray, doc_id: pa.Array, start: np.ndarray, doc_tokens: np.ndarray, first: np.ndarray, edges: np.ndarray, sequence: np.ndarray) -> pa.RecordBatch:
        """Spans ``first`` of ids, each of a document from its id ``start`` on, cut at ``edges``, where ``sequence`` begin."""
        at = np.union1d(first[:-1], edges[(edges > 0) & (edges < first[-1])])
        of = np.searchsorted(first[:-1], at, side="right") - 1
        lies = np.searchsorted(edges, at, side="right") - 1
        ends = np.r_[at, first[-1]]
        blob = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
        columns = [doc_id.take(pa.array(of)), pa.array(start[of] + at - first[of]), pa.array(np.diff(ends)), blob, pa.array(doc_tokens[of]), pa.array(sequence[lies]), pa.array(at - edges[lies])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held = None  # spans of the sequence begun: (ids, doc_id, start, doc_tokens, sizes)
        for batch in slices(batches, 2, _SLICE):
            data, offsets = W.utf8(batch.column(2))
            now = (np.frombuffer(data.tobytes(), kind), batch.column(0), longs(batch.column(3)), longs(batch.column(1)), np.diff(offsets) // width)
            if held:
                now = tuple(pa.concat_arrays([a, b]) if isinstance(a, pa.Array) else np.concatenate([a, b]) for a, b in zip(held, now))
            ids, doc_id, start, doc_tokens, sizes = now
            first = np.r_[0, np.cumsum(sizes)]
            full = len(ids) // length
            done = full * length
            if full:
                spans = int(np.searchsorted(first, done))  # spans that begin before
                yield pieces(ids[:done], doc_id, start, doc_tokens, np.r_[first[:spans], done], np.arange(full) * length, number + np.arange(full))
                number += full
            rest = max(0, int(np.searchsorted(first, done, side="right")) - 1)
            inside = done - first[rest] if rest < len(sizes) else 0
            left, begun = sizes[rest:].copy(), start[rest:].copy()
            if inside:
                left[0] -= inside
                begun[0] += inside
            held = (ids[done:].copy(), doc_id.slice(rest), begun, doc_tokens[rest:].copy(), left)
        if held and len(held[0]):
            ids, doc_id, start, doc_tokens, sizes = held
            edges = np.cumsum([0, *_powers(len(ids))[:-1]])
            yield pieces(ids, doc_id, start, doc_tokens, np.r_[0, np.cumsum(sizes)], edges, number + np.arange(len(edges)))

    return run


def pack(coded: DataFrame, length: int = LENGTH, kind: str = "<u2") -> DataFrame:
    """Pieces of the frame that ``encoded`` gives: (doc_id, start, length, ids, doc_tokens, sequence_id, offset);
    ids are little-endian unsigned 32-bit, and ``length`` has to be a power of two."""
    if length < 1 or length & length - 1:
        raise ValueError(f"the length of sequences has to be a power of two, not {length}")
    schema, width = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long", np.dtype(kind).itemsize
    begun = F.floor(F.col("doc_tokens") / length) * length
    left = F.expr(f"substring(ids, cast(start * {width} + 1 as int), cast((doc_tokens - start) * {width} as int))")
    whole = coded.where(F.col("doc_tokens") >= length).select("doc_id", "doc_tokens", "ids").mapInArrow(_whole(length, kind), schema)
    rest = coded.withColumn("start", begun).where("doc_tokens > start").withColumn("ids", left)
    rest = rest.repartitionByRange("curve", "doc_id", "row").sortWithinPartitions("curve", "doc_id", "row")
    return whole.unionByName(rest.select("doc_id", "doc_tokens", "ids", "start").mapInArrow(_packed(length, kind), schema))


def sequences(pieces: DataFrame, pad_id: int = 0, length: int = LENGTH) -> DataFrame:
    """The packed sequences themselves: (sequence_id, n_ids, ids array<int>, spans), padded to ``length`` unless they
    come to a power of two; spans name the documents in order."""
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, out = [], []
            for parts in batch.column(1).to_pylist():
                ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in parts])
                n.append(len(ids))
                out.append(ids if len(ids) & len(ids) - 1 == 0 else np.pad(ids, (0, length - len(ids)), constant_values=pad_id))
            spans = [[{k: p[k] for k in ("offset", "doc_id", "start", "length")} for p in parts] for parts in batch.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("offset", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([x.astype(np.int32) for x in out], pa.list_(pa.int32())), pa.array(spans, kind)], names=["sequence_id", "n_ids", "ids", "spans"])

    return parts.mapInArrow(run, "sequence_id long, n_ids long, ids array<int>, spans array<struct<offset: long, doc_id: long, start: long, length: long>>")


def op11_curve_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids; see the module."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    coded = encoded(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    pieces = pack(coded)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
