"""N-gram Jaccard join: an exact metric-space join with pivots, windows and recursive regions.

A document's set holds the distinct hashes of its ``shingle``-word runs.  Jaccard distance is a metric;
two documents link when it is at most 1 - ``percent``/100.  Regions become smaller in three exact steps:

1. *Voronoi regions of singleton pivots.*  Between whole documents distances crowd at 1, so pivots
   that are documents separate nothing.  The pivots of the first level are therefore the one-shingle
   sets {s}: a document is nearer to those it holds (1 - 1/n) than to all others (1).  Ties are broken
   by one global order, frequent shingles last, and the document's own region is that of its first
   shingle.  The window that the triangle inequality asks for - all pivots whose region may hold a
   document within the radius - is its first n - ceil(percent * n / 100) + 1 shingles: linked
   documents share one of these.  Regions with one document end here; of regions with the same
   documents one is kept.
2. *Regions in sketch space.*  A document's parity sketch (2048 bits, and 8192 for long ones; each
   element flips one) has a
   Hamming distance that never exceeds the symmetric difference, and linked sets differ by at most
   (100 - percent)(|A| + |B|) / (100 + percent) elements.  Within a region pairs beyond that are
   excluded; what remains connected makes the smaller regions of step 3.
3. *Pivot documents.*  In each of these regions a pivot is compared exactly with all members; members
   x, y whose distances to some pivot differ by more than the radius can't link (triangle inequality)
   and members already connected need no comparison; the region recurses with the next pivot until
   no open pair is left.

Regions of more than ``REGION`` members are first joined recursively, round by round, in parts dealt over
tasks (steps 2 and 3 alike).  A pivot of each region is compared with all its members, which takes one
comparison a member.  Members that link with it are its Voronoi region and are connected by that.  What is
left to join is the members beyond the radius, with the pivot's own members that stand in their window: by
the triangle inequality a member x beyond and a member y inside can only link if d(y, pivot) >= d(x, pivot)
less the radius.  These boundary documents go along into the next round, all others are done.  A region
that a round hardly makes smaller is split into blocks that meet pairwise.  So no task grows with a hot
group, a group of near copies takes time in proportion to its size, and no pair of one group is ever
written out: regions return a spanning forest of their links.  Equal sets inside an Arrow slice are
represented by one of them from the start.

Defined results: null and empty texts have an empty set, linked with nothing; fewer words than a
shingle form one shingle; null ids count as the smallest id; rows sharing an id are one node and get
the same component, each with its own set size; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisight.llm import _words as W
from marisight.llm._batches import NULL_ID, key_of, longs, slices
from marisight.llm._components import components
from marisight.llm._shared import written

SHINGLE = 4
PERCENT = 85
BITS = 2048
#: sets over this size also have a sketch of WIDE bits; the short one would be full of their differences
LONG, WIDE = 4096, 8192
#: members of a region, or documents of a sketch region, that one task compares
REGION = 4096
#: a shingle in one of so many documents (and in MIN_FREQUENT) goes to the end of the order
FREQUENT_ONE_IN, MIN_FREQUENT = 1000, 50
#: so many of them at most, the most frequent ones; as they only affect the order, others cost time and no link
MOST_FREQUENT = 1 << 20


def _shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of every row, repeats included, in text order."""
    w = W.words(column, lower=True)
    h, row = W.word_hashes(w), w.row_of()
    n = w.counts
    s = W.runs(h, k)
    whole = np.flatnonzero(row[: len(s)] == row[k - 1 :]) if len(s) else np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    rows = np.r_[row[whole], short]
    values = np.r_[s[whole], W.spans(h, w.first[short], w.first[short + 1])]
    return rows, values >> np.uint64(1)


def _sets(column: pa.Array, k: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row in the global order: (values, row of each, first value of each row)."""
    row, v = _shingles(column, k)
    if len(frequent) and len(v):
        at = np.minimum(np.searchsorted(frequent, v), len(frequent) - 1)
        v = v | ((frequent[at] == v).astype(np.uint64) << np.uint64(63))
    by = np.lexsort((v, row))
    v, row = v[by], row[by]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (row[1:] != row[:-1])
    v, row = v[new], row[new]
    return v, row, np.searchsorted(row, np.arange(len(column) + 1))


def frequent_shingles(docs: DataFrame, k: int, n_docs: int) -> np.ndarray:
    """Shingles in over one of FREQUENT_ONE_IN documents, by counts over all documents; at most MOST_FREQUENT, as
    whole steps of a histogram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            _, v = _shingles(batch.column(0), k)
            bins = (v & np.uint64((1 << 22) - 1)).astype(np.int64)
            often = v[np.bincount(bins, minlength=1 << 22)[bins] > 2]
            value, count = np.unique(often, return_counts=True)
            keep = count > 2
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(value[keep])), pa.array(count[keep])], names=["v", "n"])

    counts = docs.select("__text").mapInArrow(run, "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    often = written(counts.where(F.col("n") >= max(MIN_FREQUENT, n_docs // FREQUENT_ONE_IN)).withColumn("step", F.floor(F.log2("n") * 16)), "frequent")
    least, so_far = 0, 0
    for r in sorted(often.groupBy("step").agg(F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: -r["step"]):
        so_far += r["rows"]
        if so_far > MOST_FREQUENT:
            least = r["step"] + 1
            break
    held = often.where(F.col("step") >= least).select("v").toArrow().column(0).combine_chunks()
    return np.sort(longs(held).view(np.uint64))


def _sketches(v: np.ndarray, row: np.ndarray, m: int, bits: int = BITS) -> np.ndarray:
    """Parity sketch of each of m sets."""
    odd = np.bincount(row * bits + (v % np.uint64(bits)).astype(np.int64), minlength=m * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(m, bits), axis=1)


def _wide_sketches(v: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """Wide sketches of the long sets, none of the others."""
    out: list[bytes | None] = [None] * len(n)
    for i in np.flatnonzero(n > LONG):
        values = v[first[i] : first[i + 1]]
        out[i] = _sketches(values, np.zeros(len(values), np.int64), 1, WIDE).tobytes()
    return out


def _profile(k: int, percent: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 2 << 20):
            doc, m = longs(batch.column(0)), batch.num_rows
            v, row, first = _sets(batch.column(1), k, frequent)
            n = np.diff(first)
            sketch = _sketches(v, row, m)
            one, two = W.signed(W.spans(v, first[:-1], first[1:])), W.signed(W.spans(W.mix(v), first[:-1], first[1:]))
            # of equal sets in this slice only the one of the smallest id stands in regions
            by = np.lexsort((doc, two, one, n))
            lead = np.ones(m, bool)
            lead[1:] = (n[by][1:] != n[by][:-1]) | (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
            stands, rep = np.zeros(m, bool), np.empty(m, np.int64)
            stands[by[lead]] = True
            rep[by] = doc[by[lead]][np.cumsum(lead) - 1]
            size = np.where(stands & (n > 0), n - (percent * n + 99) // 100 + 1, 0)
            at = np.repeat(first[:-1], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(offsets), pa.array(W.signed(v[at])))
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), m, [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary())
            wide = pa.array(_wide_sketches(v, first, n), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(n), pa.array(rep), pa.array(stands), pa.array(one), pa.array(two), raw, wide, cells], names=["doc", "n", "rep", "stands", "one", "two", "sketch", "wide", "cells"])

    return run


def _near(sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int, wide: np.ndarray | None = None) -> np.ndarray:
    """Whether the sketches of pairs (a, b) leave a link possible."""
    out = np.empty(len(a), bool)
    for lo in range(0, len(a), 1 << 15):
        i, j = a[lo : lo + (1 << 15)], b[lo : lo + (1 << 15)]
        apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1, dtype=np.int64)
        out[lo : lo + (1 << 15)] = (100 + percent) * np.maximum(apart, np.abs(n[i] - n[j])) <= (100 - percent) * (n[i] + n[j])
    if wide is not None:
        for at in np.flatnonzero(out & (n[a] > LONG) & (n[b] > LONG)):
            i, j = a[at], b[at]
            apart = int(np.bitwise_count(wide[i] ^ wide[j]).sum())
            out[at] = (100 + percent) * apart <= (100 - percent) * int(n[i] + n[j])
    return out


def _forest(sketch: np.ndarray, n: np.ndarray, percent: int, sets: list[np.ndarray] | None = None, wide: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links of one region: pairs that sketches leave possible or, with sets, exact links.

    Each member in turn is the pivot, in order of size.  It meets the later members that its size
    window, the triangle inequality over earlier pivots and the sketches leave, and that aren't
    connected with it yet.
    """
    m = len(n)
    radius = 1 - percent / 100 + 1e-9
    order = np.argsort(n, kind="stable")
    sketch, n = sketch[order], n[order]
    wide = None if wide is None else wide[order]
    far = np.searchsorted(n, (100 * n) // percent, side="right")
    label = np.arange(m)
    pivots: list[np.ndarray] = []
    out: list[tuple[int, int]] = []
    for i in range(m - 1):
        other = np.flatnonzero(label[i + 1 : far[i]] != label[i]) + i + 1
        for away in pivots:  # unknown distances (nan) exclude nothing
            if len(other):
                other = other[~(np.abs(away[other] - away[i]) > radius)]
        if len(other):
            other = other[_near(sketch, n, np.full(len(other), i), other, percent, wide)]
        if sets is not None and len(other):
            pivot, met = sets[order[i]], [sets[j] for j in order[other]]
            flat = np.concatenate(met)
            at = np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)
            size = n[other]
            common = np.add.reduceat((pivot[at] == flat).astype(np.int64), np.cumsum(size) - size)
            union = size + n[i] - common
            if len(pivots) < 16 and len(other) > 32:
                away = np.full(m, np.nan)
                away[i], away[other] = 0.0, 1 - common / union
                pivots.append(away)
            other = other[100 * common >= percent * union]
        for j in other:
            if label[j] != label[i]:
                out.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return out


def _regions(percent: int):
    """Sorted rows (cell, left, right, doc, n, sketch, wide) in, possible links (a, b) out."""

    def flush(doc: np.ndarray, n: np.ndarray, sketch: np.ndarray, wide: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.r_[starts[1:], len(doc)]
        size = ends - starts
        found: list[np.ndarray] = []
        for width in range(2, 9):  # regions of few members, all of one width at a time
            s = starts[size == width]
            if len(s):
                i, j = np.triu_indices(width, 1)
                a, b = (s[:, None] + i).ravel(), (s[:, None] + j).ravel()
                ok = _near(sketch, n, a, b, percent, wide)
                found.append(np.stack([a[ok], b[ok]]))
        for s, e in zip(starts[size > 8].tolist(), ends[size > 8].tolist()):
            links = _forest(sketch[s:e], n[s:e], percent, None, wide[s:e])
            if links:
                found.append(np.array(links).T + s)
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return doc[pairs[0]], doc[pairs[1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def emit(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            cols = [np.concatenate(x) for x in zip(*parts)]
            key, doc, n, sketch, wide = cols
            new = np.r_[True, (key[1:] != key[:-1]).any(1)]
            a, b = flush(doc, n, sketch, wide, np.flatnonzero(new))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([longs(batch.column(i)) for i in range(3)], 1)
            raw = batch.column(5).cast(pa.large_binary())
            bits = np.frombuffer(raw.buffers()[2], np.uint64)[raw.offset * (BITS // 64) : (raw.offset + len(raw)) * (BITS // 64)].reshape(-1, BITS // 64)
            wide = np.empty(batch.num_rows, object)
            wide[:] = [None if x is None else np.frombuffer(x, np.uint64) for x in batch.column(6).to_pylist()]
            part = (key, longs(batch.column(3)), longs(batch.column(4)), bits, wide)
            turn = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if held and not len(turn) and (held[-1][0][-1] == key[0]).all():
                held.append(part)
                continue
            cut = int(turn[-1]) + 1 if len(turn) else 0
            parts = [*held, tuple(x[:cut] for x in part)] if cut else held
            if parts:
                yield emit(parts)
            held = [tuple(x[cut:] for x in part)]
        if held:
            yield emit(held)

    return run


def _exact(k: int, percent: int):
    """Sorted rows (root, left, right, doc, text) in, exact links (a, b) out."""
    none = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, sets, bits = None, [], [], []

        def links() -> pa.RecordBatch:
            pairs = _forest(np.stack(bits), np.array([len(x) for x in sets]), percent, sets) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([docs[i] for i, _ in pairs], pa.int64()), pa.array([docs[j] for _, j in pairs], pa.int64())], names=["a", "b"])

        for batch in slices(batches, 4, 4 << 20):
            v, row, first = _sets(batch.column(4), k, none)
            sketch = _sketches(v, row, batch.num_rows).view(np.uint64)
            keys = list(zip(*(longs(batch.column(i)).tolist() for i in range(3))))
            doc = longs(batch.column(3)).tolist()
            for i, key in enumerate(keys):
                if key != now:
                    if sets:
                        yield links()
                    now, docs, sets, bits = key, [], [], []
                docs.append(doc[i])
                sets.append(v[first[i] : first[i + 1]].copy())
                bits.append(sketch[i])
        if sets:
            yield links()

    return run


def _to_pivots(measure):
    """Sorted rows (key, part, is_member, doc, members, …) in, each part led by its region's pivot; per member what
    ``measure`` tells of it and the pivot: (key, doc, pivot, near, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = None
        for batch in slices(batches, 5, 4 << 20):
            lead = np.flatnonzero(longs(batch.column(2)) == 0)
            cuts = np.r_[0, lead, batch.num_rows]
            told, docs = measure(batch), longs(batch.column(3))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi == lo:
                    continue
                own = lo in lead
                if own:
                    pivot = (docs[lo], told(lo))
                rows = np.arange(lo + own, hi)
                if len(rows):
                    near, low, high = told(pivot[1], rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo + own, len(rows)), pa.array(docs[rows]), pa.array(np.full(len(rows), pivot[0])), pa.array(near), pa.array(low), pa.array(high)], names=["key", "doc", "pivot", "near", "low", "high"])

    return run


def _sketch_measure(percent: int):
    """Rows (…, sketch, n, wide): whether sketches leave a link possible; the Hamming distance, less and more by what
    the two sets may differ in for their sizes."""

    def measure(batch: pa.RecordBatch):
        raw = np.stack([np.frombuffer(x, np.uint64) for x in batch.column(5).to_pylist()])
        n = longs(batch.column(6)).astype(np.int64)
        wide = np.empty(batch.num_rows, object)
        wide[:] = [None if x is None else np.frombuffer(x, np.uint64) for x in batch.column(7).to_pylist()]

        def told(pivot, rows=None):
            if rows is None:
                return raw[pivot], n[pivot], wide[pivot]
            bits, sizes = np.vstack([pivot[0][None], raw[rows]]), np.r_[pivot[1], n[rows]]
            held = np.empty(len(sizes), object)
            held[0], held[1:] = pivot[2], wide[rows]
            here = np.arange(1, len(sizes))
            near = _near(bits, sizes, np.zeros(len(here), np.int64), here, percent, held)
            apart = np.bitwise_count(bits[1:] ^ bits[:1]).sum(1, dtype=np.int64).astype(float)
            slack = n[rows] * ((100 - percent) / (100 + percent)) + 1e-6
            return near, apart - slack, apart + slack

        return told

    return measure


def _text_measure(k: int, percent: int):
    """Rows (…, text): whether the sets link; their Jaccard distance, less and more by half the radius."""
    none, half = np.zeros(0, np.uint64), (1 - percent / 100) / 2 + 1e-9

    def measure(batch: pa.RecordBatch):
        v, row, first = _sets(batch.column(5), k, none)
        size = np.diff(first)

        def told(pivot, rows=None):
            if rows is None:
                return v[first[pivot] : first[pivot + 1]].copy()
            lo, hi = first[rows[0]], first[rows[-1] + 1]
            at = np.minimum(np.searchsorted(pivot, v[lo:hi]), len(pivot) - 1)
            common = np.bincount(row[lo:hi] - rows[0], weights=pivot[at] == v[lo:hi], minlength=len(rows)).astype(np.int64)
            union = size[rows] + len(pivot) - common
            away = 1 - common / union
            return 100 * common >= percent * union, away - half, away + half

        return told

    return measure


def _joined(rows: DataFrame, key: str, measure, carried: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """Recursive join of the regions of more than REGION members: (links found (a, b), what is left to compare).
    rows: (key, members, doc, and the ``carried`` columns that the measure reads)."""
    links: DataFrame | None = None
    done = rows.where(F.col("members") <= REGION)
    large = rows.where(F.col("members") > REGION)
    while not large.isEmpty():
        large = written(large.select(F.col(key).alias("key"), "members", "doc", *carried), "large")
        parts = F.ceil(F.col("members") / REGION).cast("int")
        leads = large.join(large.groupBy("key").agg(F.min("doc").alias("doc")), ["key", "doc"])
        member = large.withColumn("part", F.pmod(F.xxhash64("doc"), parts).cast("int")).withColumn("is_member", F.lit(1))
        lead = leads.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("is_member", F.lit(0))
        both = member.unionByName(lead).select("key", "part", "is_member", "doc", "members", *carried).repartition("key", "part").sortWithinPartitions("key", "part", "is_member")
        met = written(both.mapInArrow(_to_pivots(measure), "key long, doc long, pivot long, near boolean, low double, high double"), "pivots").where(F.col("doc") != F.col("pivot"))
        found = met.where("near").select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
        links = found if links is None else links.unionByName(found)
        beyond = met.where(~F.col("near")).groupBy("key").agg(F.min("low").alias("reach"))
        left = met.join(beyond, "key").where(~F.col("near") | (F.col("high") >= F.col("reach"))).select("key", "doc")
        left = written(left, "boundary")
        counts = left.groupBy("key").agg(F.count(F.lit(1)).alias("left"))
        again = large.join(left, ["key", "doc"]).join(counts, "key")
        goes_on = (F.col("left") > REGION) & (F.col("left") * 4 <= F.col("members") * 3)
        here = lambda part: part.select(F.col("key").alias(key), F.col("left").alias("members"), "doc", *carried)
        done = done.unionByName(here(again.where(~goes_on)))
        large = here(again.where(goes_on))
    return links, done


def _blocks(rows: DataFrame, key: str, size: str) -> DataFrame:
    """Rows with the pair of blocks (left, right) in which they are compared; (0, 0) up to REGION rows of a key."""
    b = F.ceil(F.col(size) / F.lit(REGION / 2)).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.greatest(b, F.lit(1))).cast("int")
    meets = F.when(F.col(size) <= REGION, F.array(F.struct(F.lit(0).alias("left"), F.lit(0).alias("right")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(b, F.lit(1)) - 1), lambda o: F.struct(F.least(own, o).alias("left"), F.greatest(own, o).alias("right")))
    )
    return rows.withColumn("_meets", F.explode(meets)).withColumn("left", F.col("_meets.left")).withColumn("right", F.col("_meets.right")).drop("_meets")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs."""
    base = docs.select(key_of(doc_id).alias("__doc"), F.col(text).alias("__text"))
    frequent = frequent_shingles(base, shingle, docs.count())
    profile = written(base.mapInArrow(_profile(shingle, percent, frequent), "doc long, n long, rep long, stands boolean, one long, two long, sketch binary, wide binary, cells array<long>"), "profile")

    # equal sets: with their slice's representative, and representatives with the smallest one of all slices
    leads = profile.where("n > 0 AND stands").select("doc", "n", "one", "two")
    same = leads.groupBy("n", "one", "two").agg(F.min("doc").alias("lead"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    apart = leads.join(same, ["n", "one", "two"]).where(F.col("doc") != F.col("lead")).select(F.col("doc").alias("a"), F.col("lead").alias("b"))
    equal = written(profile.where("n > 0 AND doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")).unionByName(apart), "equal")

    # step 1: regions with two documents or more, one of each membership
    cells = profile.select("doc", F.explode("cells").alias("cell"))
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = written(cells.join(shared, "cell"), "cells")
    part = lambda i: F.sum(F.shiftrightunsigned(F.xxhash64("doc", F.lit(i)), 32)).alias(f"m{i}")
    prints = shared.groupBy("cell", "members").agg(*[part(i) for i in range(3)])
    kept = prints.groupBy("members", "m0", "m1", "m2").agg(F.min("cell").alias("cell")).select("cell")
    members = shared.join(kept, "cell").distinct().join(equal.select(F.col("a").alias("doc")).distinct(), "doc", "left_anti")

    # step 2: what sketches leave possible
    rows = members.join(profile.where(F.size("cells") > 0).select("doc", "n", "sketch", "wide"), "doc")
    found, rows = _joined(rows.select("cell", "members", "doc", "sketch", "n", "wide"), "cell", _sketch_measure(percent), ["sketch", "n", "wide"])
    rows = _blocks(rows, "cell", "members").select("cell", "left", "right", "doc", "n", "sketch", "wide")
    possible = rows.repartition("cell", "left", "right").sortWithinPartitions("cell", "left", "right", "n", "doc").mapInArrow(_regions(percent), "a long, b long")
    if found is not None:
        possible = possible.unionByName(found)
    regions = written(components(possible.where("a <> b")), "regions")

    # step 3: exact links inside the regions that remain
    sizes = regions.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    placed = regions.join(sizes, "root").select(F.col("node").alias("doc"), "root", "members")
    whole = base.join(placed, base["__doc"] == placed["doc"]).select("root", "members", "doc", "__text")
    found, whole = _joined(whole, "root", _text_measure(shingle, percent), ["__text"])
    whole = _blocks(whole, "root", "members").select("root", "left", "right", "doc", "__text")
    exact = whole.repartition("root", "left", "right").sortWithinPartitions("root", "left", "right", "doc").mapInArrow(_exact(shingle, percent), "a long, b long")

    if found is not None:
        exact = exact.unionByName(found)
    classes = components(exact.where("a <> b").unionByName(equal))
    out = profile.select("doc", "n").join(classes, profile["doc"] == classes["node"], "left")
    real = lambda c: F.when(c == F.lit(NULL_ID), F.lit(None).cast("long")).otherwise(c)
    return out.select(real(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), real(F.coalesce("root", "doc")).alias("component_id"))


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all whole documents at Jaccard 0.85 of 4-word shingles; see the module."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
