"""Exact top-k search by MaxScore over integer vectors.

A *term* is a dimension.  A shard of rows keeps two posting lists per term, one for queries with a
positive and one for those with a negative weight there: the rows that score more than the shard's
least contribution, with how much more per unit of weight.  So contributions are never negative, and
each term has an upper bound per query and shard: its weight times the list's largest entry.

Each query searches each shard as MaxScore does:

1. Terms are ranked by bound.  The postings of the leading few are traversed, and the k best rows so
   far are scored in full: their least score is the *threshold* that a row has to reach.
2. The threshold splits the query's terms.  *Non-essential* are the lowest bounds that together stay
   under it: a row in none of the other lists can't be among the best.  The postings of all the
   *essential* terms are traversed.
3. Non-essential terms are probed in order of bound, only in rows that are still *competitive*, whose
   score so far and the bounds left reach the threshold, which rises as probed rows are completed.

Lists that hold most rows are kept as columns, and the queries of an Arrow batch traverse them together,
each with weight 0 for the terms that aren't its own; so one matrix product serves all of them.

Shards answer independently and their answers are merged.  Each row goes to one shard per
``QUERY_LANE`` queries; a task holds one shard and lets its queries stream through, so memory is that
of a shard whatever the number of queries, and nothing is broadcast.

Defined results: rows whose vector is null, or holds null or non-finite components, take no part; so
do queries and rows without an id; vectors are compared with those of their own length only; ties go
to the smaller id; repeated rows of one id are separate candidates; fewer than k rows give fewer
results; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.llm._batches import longs

K = 20
SHARD_ROWS = 8192
QUERY_LANE = 1 << 16
#: queries that traverse columns together
_TOGETHER = 64
#: terms traversed before the first threshold
_FIRST_TERMS = 4


def quantised(vector: Column, levels: int = 64) -> Column:
    """floor(levels * x) per component, as array<long>."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(levels)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """True where a vector and all its components are present and finite."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(whole(x.cast("double")), F.lit(False))), F.lit(False))


class Shard:
    """Posting lists of a shard's rows, which are ordered by id."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.rows, self.ids = rows[by], ids[by]
        self.low, self.high = self.rows.min(0), self.rows.max(0)
        self.width = self.high - self.low
        dense = lambda gain: 2 * np.count_nonzero(gain, axis=0) > len(gain)
        #: per sign, which terms' lists are columns; the others are (row numbers, entries)
        self.dense = np.stack([dense(self.rows - self.low), dense(self.high - self.rows)])
        self.sparse = [{t: self._list(c) for t, c in enumerate(gain.T) if not self.dense[sign, t]} for sign, gain in enumerate((self.rows - self.low, self.high - self.rows))]
        self.most = int(np.maximum(np.abs(self.low), np.abs(self.high)).max(initial=0))
        self._columns: dict[type, np.ndarray] = {}

    @staticmethod
    def _list(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(gain)
        return at, gain[at]

    def columns(self, largest: int) -> np.ndarray:
        """Rows as columns, in the smallest type whose products with weights up to ``largest`` add up exactly."""
        total = 2 * self.most * largest * max(1, self.rows.shape[1])
        kind = np.float32 if total < 1 << 24 else np.float64 if total < 1 << 53 else np.int64
        if kind not in self._columns:
            self._columns[kind] = np.ascontiguousarray(self.rows.T, dtype=kind)
        return self._columns[kind]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """Per query (row numbers, scores) of the k best rows but the query's own, and the postings touched for all."""
        found, touched = [], 0
        for lo in range(0, len(queries), _TOGETHER):
            some, met = self._together(queries[lo : lo + _TOGETHER], own[lo : lo + _TOGETHER], k)
            found += some
            touched += met
        return found, touched

    def _together(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        m, n = len(queries), len(self.ids)
        columns = self.columns(int(np.abs(queries).max(initial=0)))
        sign = (queries < 0).astype(int)
        least = queries * np.where(sign, self.high, self.low)
        bound = np.abs(queries) * self.width
        order = np.argsort(-bound, axis=1, kind="stable")
        ranked = np.take_along_axis(bound, order, 1)
        left = np.c_[np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1], np.zeros(m, ranked.dtype)]  # what the terms from each on can add
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
        some = (ranked > 0).sum(1)  # terms that can add anything
        dense = np.take_along_axis(self.dense, sign, 0)
        score = np.zeros((m, n), columns.dtype)
        touched = 0

        def traverse(first: np.ndarray, last: np.ndarray, live: list[np.ndarray] | None = None) -> None:
            """Adds each query's terms of the ranks from first to last: all their postings, or those of its live rows."""
            nonlocal touched
            mine = (rank >= first[:, None]) & (rank < last[:, None])
            cols = mine & dense
            if cols.any():
                used = np.flatnonzero(cols.any(0))
                weights = np.where(cols, queries, 0)[:, used].astype(columns.dtype)
                score[:] += weights @ columns[used] - np.where(cols, least, 0).sum(1).astype(columns.dtype)[:, None]
                touched += int((cols.sum(1) * ([n] * m if live is None else [len(x) for x in live])).sum())
            for i, t in zip(*np.nonzero(mine & ~dense)):
                at, gain = self.sparse[sign[i, t]][t]
                score[i, at] += (abs(int(queries[i, t])) * gain).astype(columns.dtype)
                touched += len(at)

        def best(rows: np.ndarray, value: np.ndarray) -> np.ndarray:
            """The k best of rows in order: rows ascend by id, so equals keep their order."""
            if len(rows) > k:
                near = value >= np.partition(value, len(rows) - k)[len(rows) - k]
                rows, value = rows[near], value[near]
            return rows[np.argsort(-value, kind="stable")][:k]

        spans = np.searchsorted(self.ids, own, side="left"), np.searchsorted(self.ids, own, side="right")
        live = [np.r_[np.arange(a), np.arange(b, n)] for a, b in zip(*spans)]
        done = np.minimum(_FIRST_TERMS, some)
        traverse(np.zeros(m, int), done)
        essential, threshold = done.copy(), np.zeros(m, np.int64)
        for i in range(m):
            if len(live[i]) > k:
                first = best(live[i], score[i, live[i]])
                threshold[i] = (self.rows[first] @ queries[i]).min() - least[i].sum()
                touched += len(first) * int(some[i] - done[i])
                essential[i] = max(done[i], min(int(np.searchsorted(-left[i], -threshold[i], side="right")), some[i]))  # the terms from there on stay under it
        traverse(done, essential)
        done = essential
        for i in range(m):
            live[i] = live[i][score[i, live[i]] + left[i, done[i]] >= threshold[i]]
        while (todo := (done < some) & np.array([len(x) > 0 for x in live], bool)).any():
            to = np.where(todo, np.minimum(some, done + np.maximum(1, (some - done + 2) // 3)), done)
            if sum(map(len, live)) * 8 > m * n:  # most rows are competitive: probed as columns
                traverse(done, to, live)
            else:
                for i in np.flatnonzero(todo):
                    terms = order[i, done[i] : to[i]]
                    score[i, live[i]] += (self.rows[live[i]][:, terms] @ queries[i, terms] - least[i, terms].sum()).astype(columns.dtype)
                    touched += len(live[i]) * len(terms)
            done = to
            for i in np.flatnonzero(todo):
                if len(live[i]) > k:
                    value = score[i, live[i]]
                    threshold[i] = max(threshold[i], int(np.partition(value, len(value) - k)[len(value) - k]))  # k rows have so much already
                    live[i] = live[i][value + left[i, done[i]] >= threshold[i]]
        out = []
        for i in range(m):
            rows = best(live[i], score[i, live[i]])
            out.append((rows, score[i, rows].astype(np.int64) + least[i].sum()))
        return out, touched


def _searched(k: int):
    """Rows sorted by (width, shard, lane, is_query) in: each shard's rows are followed by its queries."""

    def vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
        return longs(batch.column(5).flatten()).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([longs(batch.column(i)) for i in range(4)], 1)
            cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                width, number, lane, is_query = key[lo].tolist()
                part = batch.slice(lo, hi - lo)
                if (width, number, lane) != now:
                    now, held, shard = (width, number, lane), [], None
                if not is_query:
                    held.append((vectors(part, width), longs(part.column(4))))
                    continue
                if shard is None and held:
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held))), []
                if shard is None:  # no rows of this length
                    continue
                who = longs(part.column(4))
                found = [(np.full(len(rows), own), shard.ids[rows], score) for own, (rows, score) in zip(who.tolist(), shard.search(vectors(part, width), who, k)[0])]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["query_id", "vec_id", "score"])

    return run


def search(queries: DataFrame, rows: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_lane: int = QUERY_LANE) -> DataFrame:
    """The k best rows of each query by integer inner product: (query_id, rank, vec_id, score).

    Both frames have (vec_id, vector array<long>); a row with the query's own id is no candidate.
    """
    shards, lanes = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // query_lane))
    dealt = lambda many: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(many)).cast("int")  # noqa: E731  rows of one id spread too
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    made = lambda frame, shard, lane, kind: frame.select(F.size("vector").alias("width"), shard.alias("shard"), lane.alias("lane"), F.lit(kind).alias("is_query"), F.col("vec_id").cast("long").alias("id"), "vector")
    left = made(rows.withColumn("_s", dealt(shards)), F.col("_s"), every(lanes), 0)
    right = made(queries.withColumn("_l", dealt(lanes)), every(shards), F.col("_l"), 1)
    met = left.unionByName(right).repartition(min(shards * lanes, 1 << 15), "width", "shard", "lane").sortWithinPartitions("width", "shard", "lane", "is_query")
    found = met.mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op5_maxscore(spark, sf_dir: str) -> DataFrame:
    """Each vector whose id is divisible by 20 against all others; see the module."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = table.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return search(rows.where(F.col("vec_id") % 20 == 0), rows)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
