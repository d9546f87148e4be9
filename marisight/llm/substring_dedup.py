"""Substring deduplication by Relative Lempel-Ziv parsing over all documents.

Every document is factored against *all* earlier text: a factor is a stretch of words that also
starts earlier (in a document of smaller id, or earlier in the same one) together with the place it
copies.  Factors of ``window`` words or more are duplicate spans.

How the reference is indexed and probed without comparing documents pairwise:

* Each run of ``window`` words has one *anchor*, its smallest ``ANCHOR``-word hash (leftmost of
  ties).  Equal windows have equal anchors, so consecutive windows of one anchor make a *block*
  (7 words apart on average), and all copies of a block meet under (anchor hash, block hash).
* Blocks are the reference index.  The first copy of a block is its reference; every later copy is
  a factor with that reference, whole.
* Where one anchor stands in different blocks, a copied stretch begins or ends: a factor boundary.
  Only there are windows checked one by one, again by meeting under the window's 128-bit hash.
* In each document the factors found are put together greedily while their references run on.

Hot passages: inside one Arrow slice only the first copy of a block or window is sent on; later
copies already know an earlier place, and anchors with several blocks in a slice send one marker.
So a passage in a third of all documents puts at most one row per slice under its key.

Defined results: null texts have no words; null ids count as the smallest id; rows that repeat both
id and text are one document and get equal results; rows that share an id but not a text are
ordered by the text's checksum; documents shorter than a window lose nothing; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from marisight.llm import _words as W
from marisight.llm._batches import key_of, longs, slices, text_key

ANCHOR = 8
WINDOW = 20
#: bytes of text that a task works on at a time
_SLICE = 4 << 20

_CANDIDATE, _KNOWN, _EXPAND, _MARKER = 0, 1, 2, 3
_ROW = "anchor long, block long, doc long, loc long, n int, state int, ref long"
_ROW_NAMES = ["anchor", "block", "doc", "loc", "n", "state", "ref"]
_MADE = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("kept_text", StringType()),
        StructField("factors", ArrayType(StructType([StructField("start", IntegerType()), StructField("words", IntegerType()), StructField("ref_doc", LongType()), StructField("ref_start", IntegerType())]))),
    ]
)
_NP = [np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int64]


def _emit(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Rows of _ROW from column groups."""
    columns = [np.concatenate([np.asarray(p[i]).astype(t, copy=False) for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate(_NP)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_ROW_NAMES)


def _spread(doc: np.ndarray, loc: np.ndarray) -> np.ndarray:
    """A key under which rows that need no meeting are dealt out evenly."""
    return W.signed(W.mix(doc.view(np.uint64) * np.uint64(3) + W.mix(loc.view(np.uint64))))


def _firsts(a: np.ndarray, b: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal (a, b): for each entry the entry of its group that is first by ``order``, whether
    it is that first one itself or level with it, and the sorted permutation."""
    by = np.lexsort((order, b, a))
    new = np.r_[True, (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])]
    head = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    first = np.empty(len(a), np.int64)
    first[by] = head
    return first, order[first] == order, by


def _known(owner: np.ndarray, d: np.ndarray, loc: np.ndarray, n: np.ndarray, ref_doc: np.ndarray, ref_loc: np.ndarray) -> list[np.ndarray]:
    """Known factors, each run of marks that goes on both here and in its reference as one row."""
    by = np.lexsort((loc, owner))
    owner, d, loc, n, ref_doc, ref_loc = (x[by] for x in (owner, d, loc, n, ref_doc, ref_loc))
    head, total = _run_on(owner, loc, n, ref_doc, ref_loc)
    d, loc = d[head], loc[head]
    return [_spread(d, loc), ref_doc[head], d, loc, total, np.full(len(head), _KNOWN), ref_loc[head]]


def _run_on(owner: np.ndarray, pos: np.ndarray, n: np.ndarray, ref_doc: np.ndarray, ref_pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of marks in text order: where a factor starts, and how many windows it runs on for."""
    go = np.zeros(len(pos), bool)
    if len(pos):
        go[1:] = (owner[1:] == owner[:-1]) & (pos[1:] == pos[:-1] + n[:-1]) & (ref_doc[1:] == ref_doc[:-1]) & (ref_pos[1:] == ref_pos[:-1] + n[:-1])
    head = np.flatnonzero(~go)
    return head, np.add.reduceat(n, head) if len(head) else n[:0]


def _places(batch: pa.RecordBatch, at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: document key, checksum, rank in document order (equal for repeated rows)."""
    doc, check = longs(batch.column(at)), longs(batch.column(at + 1))
    by = np.lexsort((check, doc))
    new = np.r_[False, (doc[by][1:] != doc[by][:-1]) | (check[by][1:] != check[by][:-1])]
    rank = np.empty(len(doc), np.int64)
    rank[by] = np.cumsum(new)
    return doc, check, rank


def _blocks(window: int):
    """Pass 1: blocks of each document; later copies inside a slice become known factors at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, _SLICE):
            doc, check, rank = _places(batch)
            w = W.words(batch.column(2))
            h, row = W.word_hashes(w), w.row_of()
            m = len(h) - window + 1
            if m <= 0:
                continue
            grams = W.runs(h, ANCHOR)
            width = window - ANCHOR + 1
            whole = np.flatnonzero(row[:m] == row[window - 1 :])
            if not len(whole):
                continue
            at = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)[whole] + whole
            head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (row[whole][1:] != row[whole][:-1])])
            tail = np.r_[head[1:], len(whole)] - 1
            start, n = whole[head], whole[tail] - whole[head] + 1
            a = W.signed(grams[at[head]])
            b = W.signed(W.spans(h, start, whole[tail] + window))
            r = row[start]
            pos = start - w.first[r]
            d, loc = doc[r], (check[r] << 32) | pos
            first, is_first, _ = _firsts(a, b, (rank[r] << 32) | pos)
            later = np.flatnonzero(~is_first)
            parts = [_known(r[later], d[later], loc[later], n[later], d[first[later]], loc[first[later]])]
            keep = np.flatnonzero(is_first)
            # anchors that stand in several blocks of this slice: their windows are checked anyway
            by = keep[np.lexsort((b[keep], a[keep]))]
            same = a[by][1:] == a[by][:-1]
            turn = same & (b[by][1:] != b[by][:-1])
            group = np.cumsum(np.r_[True, ~same]) - 1
            several = np.zeros(group[-1] + 1, bool)
            several[group[1:][turn]] = True
            mine = several[group]
            one, many = by[~mine], by[mine]
            zero = np.zeros(len(by), np.int64)
            parts.append([a[one], b[one], d[one], loc[one], n[one], np.full(len(one), _CANDIDATE), zero[: len(one)]])
            parts.append([_spread(d[many], loc[many]), d[many], d[many], loc[many], n[many], np.full(len(many), _EXPAND), zero[: len(many)]])
            tell = np.unique(a[many])
            parts.append([tell, zero[: len(tell)], zero[: len(tell)], zero[: len(tell)], zero[: len(tell)], np.full(len(tell), _MARKER), zero[: len(tell)]])
            yield _emit(parts)

    return run


def _windows(window: int):
    """Pass 2: at factor boundaries each window stands for itself; known factors pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, _SLICE):
            doc, check, rank = _places(batch, 1)
            w = W.words(batch.column(3))
            h = W.word_hashes(w)
            marks = batch.column(0)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(marks.offsets)))
            flat = marks.flatten()
            pos, n, state = (longs(flat.field(i)) for i in range(3))
            ref_doc, ref_loc = (longs(flat.field(i)) for i in (3, 4))
            d, base = doc[owner], check[owner] << 32
            known = np.flatnonzero(state == _KNOWN)
            loc = base | pos
            parts = [_known(owner[known], d[known], loc[known], n[known], ref_doc[known], ref_loc[known])]
            check_here = np.flatnonzero(state == _EXPAND)
            if len(check_here) and len(h) >= window:
                count = n[check_here]
                each = np.repeat(check_here, count)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                p = pos[each] + step
                where = w.first[owner[each]] + p
                half = W.runs(h, window // 2)
                rest = W.runs(h, window - window // 2)
                a, b = W.signed(half[where]), W.signed(rest[where + window // 2])
                dd, ll = d[each], base[each] | p
                first, is_first, _ = _firsts(a, b, (rank[owner[each]] << 32) | p)
                later, keep = np.flatnonzero(~is_first), np.flatnonzero(is_first)
                zero = np.zeros(len(keep), np.int64)
                parts.append(_known(owner[each][later], dd[later], ll[later], np.ones(len(later), np.int64), dd[first[later]], ll[first[later]]))
                parts.append([a[keep], b[keep], dd[keep], ll[keep], np.ones(len(keep)), np.full(len(keep), _CANDIDATE), zero])
            yield _emit(parts)

    return run


def _marks(rows: DataFrame) -> DataFrame:
    """Rows of one key meet: the first copy is the reference of the others.  Returns the marks of each
    document: (position, windows, state, reference document, reference place)."""
    copies = Window.partitionBy("anchor", "block", "state").orderBy("doc", "loc")
    anchor = Window.partitionBy("anchor").orderBy("block", "state", "doc", "loc").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # the same sort serves both
    of = lambda x: F.when(F.col("state") == _CANDIDATE, x)
    met = rows.select(
        "doc",
        "loc",
        "n",
        "state",
        "block",
        "ref",
        F.rank().over(copies).alias("turn"),
        F.first("doc").over(copies).alias("first_doc"),
        F.first("loc").over(copies).alias("first_loc"),
        (F.min(of(F.col("block"))).over(anchor) != F.max(of(F.col("block"))).over(anchor)).alias("varied"),
        (F.max("state").over(anchor) == _MARKER).alias("marked"),
    )
    later = (F.col("state") == _CANDIDATE) & (F.col("turn") > 1)
    state = F.when(later, F.lit(_KNOWN)).otherwise(F.when(F.col("state") == _CANDIDATE, F.lit(_EXPAND)).otherwise(F.col("state")))
    kept = met.where((F.col("state") == _KNOWN) | (F.col("state") == _EXPAND) | later | ((F.col("state") == _CANDIDATE) & (F.col("varied") | F.col("marked"))))
    return kept.select(
        "doc",
        F.shiftright("loc", 32).alias("check"),
        F.struct(
            F.col("loc").bitwiseAND(0x7FFFFFFF).cast("int").alias("pos"),
            "n",
            state.cast("int").alias("state"),
            F.when(later, F.col("first_doc")).otherwise(F.col("block")).alias("ref_doc"),
            F.when(later, F.col("first_loc")).otherwise(F.col("ref")).alias("ref_loc"),
        ).alias("mark"),
    )


def _by_document(marks: DataFrame) -> DataFrame:
    """A document's marks are bounded by its own words."""
    return marks.groupBy("doc", "check").agg(F.collect_list("mark").alias("marks"))


def _cut(window: int, names: list[str], text: str, made: list[str]):
    """Pass 3: factors of each document, put together greedily, and what is left of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, _SLICE):
            w = W.words(batch.column(3))
            marks = batch.column(0)
            covered = np.zeros(len(w.start) + 1, np.int64)
            counts = np.diff(np.asarray(marks.offsets)) if len(marks) else np.zeros(0, np.int64)
            counts = np.where(np.asarray(marks.is_valid()), counts, 0)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            flat = marks.flatten()
            pos, n, state, ref_doc, ref_loc = (longs(flat.field(i)) for i in range(5))
            use = np.flatnonzero(state == _KNOWN)
            by = use[np.lexsort((pos[use], owner[use]))]
            owner, pos, n, ref_doc, ref_loc = owner[by], pos[by], n[by], ref_doc[by], ref_loc[by]
            # greedily: a factor runs on while the next block's reference goes on where this one's ended
            head, total = _run_on(owner, pos, n, ref_doc, ref_loc)
            words = total - 1 + window
            begin = w.first[owner[head]] + pos[head]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + words, -1)
            gone = np.cumsum(covered[:-1]) > 0  # factors are duplicate spans
            factors = pa.StructArray.from_arrays(
                [pa.array(pos[head].astype(np.int32)), pa.array(words.astype(np.int32)), pa.array(ref_doc[head]), pa.array((ref_loc[head] & 0x7FFFFFFF).astype(np.int32))], names=["start", "words", "ref_doc", "ref_start"]
            )
            offsets = np.searchsorted(owner[head], np.arange(batch.num_rows + 1)).astype(np.int32)
            removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), w.first[:-1]) if batch.num_rows else np.zeros(0, np.int64)
            removed = np.where(w.counts > 0, removed, 0)
            kept = []
            raw = w.data.tobytes()
            for i in range(batch.num_rows):
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                if removed[i] == hi - lo:
                    kept.append("")
                elif not removed[i]:
                    kept.append(b" ".join(raw[w.start[lo] : w.end[hi - 1]].split()).decode())
                else:
                    left = np.flatnonzero(~gone[lo:hi]) + lo
                    kept.append(b" ".join([raw[a:b] for a, b in zip(w.start[left].tolist(), w.end[left].tolist())]).decode())
            new = [pa.array(w.counts.astype(np.int64)), pa.array(removed), pa.array(kept, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), factors)]
            yield pa.RecordBatch.from_arrays([*[batch.column("__text" if c == text else c) for c in names], *new], names=[*names, *made])

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """docs with ``n_words``, ``n_removed``, ``kept_text`` and ``factors`` (start, words, ref_doc, ref_start).

    ``kept_text`` holds the words that no repeated window covers, joined by one space.  ``keep`` names
    the columns of docs to return (all of them unless given).  The made columns stand for columns of docs
    of these names; with a ``prefix`` before them those stay.
    """
    if window < 2 * ANCHOR:
        raise ValueError(f"a window has at least {2 * ANCHOR} words")
    made = [prefix + c for c in _MADE.names]
    names = [c for c in (docs.columns if keep is None else keep) if c not in made]
    keyed = docs.select(key_of(doc_id).alias("__doc"), text_key(text).alias("__check"), F.col(text).alias("__text"), *[F.col(c) for c in names if c != text])
    blocks = keyed.select("__doc", "__check", "__text").mapInArrow(_blocks(window), _ROW)
    inner = _by_document(_marks(blocks))
    on = lambda right: [keyed["__doc"] == right["doc"], keyed["__check"] == right["check"]]
    # all columns go along, so that both joins read the one shuffle of the documents
    asked = keyed.join(inner, on(inner), "inner").select("marks", *keyed.columns)
    final = _by_document(_marks(asked.mapInArrow(_windows(window), _ROW)))
    joined = keyed.join(final, on(final), "left").select("marks", *keyed.columns)
    schema = StructType([*docs.select(*names).schema.fields, *[StructField(m, f.dataType) for m, f in zip(made, _MADE.fields)]])
    return joined.mapInArrow(_cut(window, names, text, made), schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every whole document without repeated 20-word windows; see the module."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeats(docs, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
