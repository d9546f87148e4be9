"""Ranked lexical search over posting lists in geometric blocks.

Terms are maximal runs of ASCII letters, digits and code points beyond ASCII, A-Z lower-cased.  An entry of
a posting list has a whole-number *impact*; a document's score is the sum, over the query's terms, of the
term's weight times the impact, so a bound on impacts is a bound on scores.

1. One pass over the documents counts all terms and keeps those that a query may hold: the queries' terms are
   hashed into a bitmap of ``FILTER`` bits, whose size doesn't grow.  Kept terms and counts are written once.
2. Documents are dealt into shards by row.  In a shard each term's posting list is clustered by similarity of
   documents: every document has a short random projection of its impacts, some of the list's documents,
   spread over it, are the first centres, and after a second pass over the means each cluster is a *block*.
   A block's *summary* has, for each term of its documents, their largest impact.
3. A query takes its lists in order of the most that they can add.  The best k documents so far give a
   threshold; lists that together stay under it are left out, and a block is skipped only when its summary's
   exact bound is under the threshold.  Documents of all other blocks are scored in full, once.
4. A few shards are searched first: the k-th best score there is where every query's threshold starts.

Lists are clustered when a query first asks for them.  Each document goes to one shard per ``QUERY_LANE``
queries and queries stream through, so memory is that of a shard, whatever the number of documents or
queries; equal documents, however many, are dealt over all shards.

Defined results: null and empty texts have no term, and are neither counted nor found; documents with a null
id are found, and come first among equals; repeated rows are documents, or queries, of their own (the ranks
of each start at 1); equal scores go to the smaller id; fewer documents with a score above 0 give fewer
rows; an empty table gives none.  Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marisight.llm import _words as W
from marisight.llm._batches import NULL_ID, key_of, longs, slices
from marisight.llm._shared import written

K = 20
SHARD_ROWS = 8192
QUERY_LANE = 1 << 16
FILTER = 1 << 20
#: entries that a block has on average
BLOCK = 48
#: numbers in the projection of a document
SKETCH = 16
#: of so many shards one is searched first
FIRST = 64
#: numbers of the table that summaries are made in
_DENSE = 1 << 20
#: documents scored before the threshold is looked at again
_STEP = 96

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, which of them each term is, first term of each row and the end)."""
    data, offsets = W.utf8(column)
    inside = _TERM[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    opens[bounds] = inside[bounds]
    closes[bounds - 1] = inside[bounds - 1]
    start = np.flatnonzero(opens)
    ends = np.r_[0, np.cumsum(np.flatnonzero(closes) + 1 - start)]
    kept = W._LOWER[data[inside]]
    every = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)])
    coded = every.dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices, dtype=np.int64), np.searchsorted(start, offsets)


def buckets(distinct: pa.Array) -> np.ndarray:
    data, offsets = W.utf8(distinct)
    return (W.word_hashes(W.Words(data, offsets[:-1], offsets[1:], offsets)) % np.uint64(FILTER)).astype(np.int64)


def counted(docs: DataFrame, bits: bytes | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, terms, counts): all terms of each text counted, its distinct ones joined by a space with their
    counts; of these only terms whose bucket is in the bitmap, where one is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for batch in slices(batches, 1):
            distinct, which, first = terms_of(batch.column(1))
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            if asked is not None and len(distinct):
                keep = asked[buckets(distinct)][which]
                row, which = row[keep], which[keep]
            pairs, count = np.unique(row * max(1, len(distinct)) + which, return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * max(1, len(distinct))).astype(np.int32))
            words = pa.ListArray.from_arrays(offsets, distinct.take(pa.array(pairs % max(1, len(distinct)))).cast(pa.string()))
            columns = [batch.column(0), pa.array(np.diff(first)), pc.binary_join(words, " "), pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "counts"])

    plain = docs.select(key_of(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, "id long, n long, terms string, counts array<int>")


def bitmap(counted_items: DataFrame) -> bytes:
    """The buckets of all queries' terms, as FILTER bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.unique(pc.split_pattern(batch.column(0), " ").flatten()).cast(pa.large_binary())
            if len(words):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(buckets(words)))], names=["bucket"])

    found = counted_items.where("n > 0").select("terms").mapInArrow(run, "bucket long").distinct().toArrow()
    bits = np.zeros(FILTER, bool)
    bits[longs(found.column(0).combine_chunks())] = True
    return np.packbits(bits).tobytes()


class Shard:
    """Posting lists of a shard's documents, clustered on demand; documents are in order of (id, row)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray, terms: pa.Array, counts: np.ndarray, total: tuple[int, int]):
        order = np.lexsort((rows, ids))
        documents, length = total
        lists = pc.split_pattern(terms.take(pa.array(order)), " ")  # every document of a shard has terms
        coded = lists.flatten().dictionary_encode()
        self.ids, self.rows = ids[order], rows[order]
        self.words, self.code = coded.dictionary, np.asarray(coded.indices, dtype=np.int32)
        per = longs(pc.list_value_length(lists))
        self.first = np.r_[0, np.cumsum(per)]
        given = per[np.argsort(order)]
        start = (np.cumsum(given) - given)[order]  # where each document's counts begin
        tf = counts[_spans(start, per)].astype(np.int64)
        m = 100 - 25 + (25 * lengths[order].astype(np.int64) * documents) // max(1, length)
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, per))).astype(np.int32)  # a million at most
        by_term = np.argsort(self.code, kind="stable")
        self.list_doc = np.repeat(np.arange(len(per)), per)[by_term]
        self.list_first = np.searchsorted(self.code[by_term], np.arange(len(self.words) + 1))
        self.most = np.maximum.reduceat(self.impact[by_term], self.list_first[:-1]) if len(by_term) else np.zeros(0, np.int64)
        self._sketch: np.ndarray | None = None
        self._lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self.weight = np.zeros(len(self.words), np.int64)
        self.skipped = self.scored = 0

    def sketch(self) -> np.ndarray:
        """A random projection of each document's impacts, rare terms weighing more, of length 1."""
        if self._sketch is None:
            signs = np.random.default_rng(1).choice(np.float32([-1, 1]), (len(self.words), SKETCH))
            rare = 1 / np.sqrt(np.diff(self.list_first)).astype(np.float32)
            each = (self.impact * rare[self.code]).astype(np.float32)[:, None] * signs[self.code]
            made = np.add.reduceat(each, self.first[:-1])
            self._sketch = made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
        return self._sketch

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A list's documents block by block, where blocks begin, and their summaries: terms, largest impacts, where each begins."""
        if term not in self._lists:
            docs = self.list_doc[self.list_first[term] : self.list_first[term + 1]]
            block = np.zeros(len(docs), np.int64)
            if len(docs) > BLOCK:
                at = self.sketch()[docs]
                centre = at[np.linspace(0, len(docs) - 1, -(-len(docs) // BLOCK)).astype(int)]
                block = (at @ centre.T).argmax(1)
                centre = np.zeros_like(centre)
                np.add.at(centre, block, at)
                block = np.unique((at @ centre.T).argmax(1), return_inverse=True)[1]
                order = np.argsort(block, kind="stable")
                docs, block = docs[order], block[order]
            begins = np.searchsorted(block, np.arange(block[-1] + 2))
            self._lists[term] = (docs, begins, *self._summaries(docs, block))
        return self._lists[term]

    def _summaries(self, docs: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per block, in order, its documents' terms and their largest impacts, and where each block's begin."""
        words, some = len(self.words), max(1, _DENSE // max(1, len(self.words)))
        terms, highs, first = [], [], []
        for lo in range(0, int(block[-1]) + 1, some):
            now = slice(*np.searchsorted(block, [lo, lo + some]))
            start = self.first[docs[now]]
            per = self.first[docs[now] + 1] - start
            at = _spans(start, per)
            high = np.zeros((int(block[now][-1]) + 1 - lo) * words, np.int32)
            np.maximum.at(high, np.repeat((block[now] - lo) * words, per) + self.code[at], self.impact[at])
            found = np.flatnonzero(high)
            terms.append((found % words).astype(np.int32))
            highs.append(high[found])
            first.append(np.searchsorted(found, np.arange(0, len(high), words)) + sum(map(len, terms[:-1])))
        return np.concatenate(terms), np.concatenate(highs), np.concatenate(first)

    def score(self, docs: np.ndarray) -> np.ndarray:
        per = self.first[docs + 1] - self.first[docs]
        at = _spans(self.first[docs], per)
        return np.add.reduceat(self.impact[at] * self.weight[self.code[at]], np.r_[0, np.cumsum(per)[:-1]])

    def search(self, words: pa.Array, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best with a score above 0 that can be among the k best of all, best first;
        ``floor`` is a score that k documents reach."""
        code = pc.index_in(words, self.words)
        known = np.asarray(pc.is_valid(code))
        code, weights = longs(code.drop_null()), weights[known]
        bound = weights * self.most[code]
        order = np.argsort(-bound, kind="stable")
        left = np.cumsum(bound[order][::-1])[::-1]  # what the lists from each on can add
        self.weight[code] = weights
        threshold, seen = max(1, floor), np.zeros(len(self.ids), bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for term, rest in zip(code[order].tolist(), left.tolist()):
            if rest < threshold:
                break
            listed, begins, high_term, high, high_first = self.blocks(term)
            most = np.add.reduceat(high * self.weight[high_term], high_first)
            todo = np.argsort(-most, kind="stable")
            while len(todo):
                live = int(np.searchsorted(-most[todo], -threshold, side="right"))
                self.skipped += len(todo) - live
                todo = todo[:live]
                size = begins[todo + 1] - begins[todo]
                some = max(1, int(np.searchsorted(np.cumsum(size), _STEP, side="right")))
                now = listed[_spans(begins[todo[:some]], size[:some])]
                todo = todo[some:]
                now = now[~seen[now]]
                if not len(now):
                    continue
                seen[now] = True
                self.scored += len(now)
                value = self.score(now)
                docs, scores = np.r_[docs, now[value >= threshold]], np.r_[scores, value[value >= threshold]]
                best = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[best], scores[best]
                if len(docs) == k:
                    threshold = max(threshold, int(scores[-1]))
        self.weight[code] = 0
        return docs, scores


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, … of each span, end to end."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


def _searched(k: int, total: tuple[int, int]):
    """Rows sorted by (shard, lane, is_query) in: each shard's documents are followed by its queries."""

    def made(parts: list[pa.RecordBatch]) -> Shard:
        column = lambda i: pa.concat_arrays([p.column(i) for p in parts])
        return Shard(longs(column(3)), longs(column(4)), longs(column(5)), column(6), np.concatenate([np.asarray(p.column(7).flatten()) for p in parts]), total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([longs(batch.column(i)) for i in range(3)], 1)
            cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(lo, hi - lo)
                if tuple(key[lo][:2]) != now:
                    now, held, shard = tuple(key[lo][:2]), [], None
                if not key[lo][2]:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = made(held), []
                if shard is None:
                    continue
                words = pc.split_pattern(part.column(6), " ")
                found = []
                for i, (item, row, floor) in enumerate(zip(part.column(3).to_pylist(), part.column(4).to_pylist(), part.column(9).to_pylist())):
                    docs, scores = shard.search(words[i].values, longs(part.column(8)[i].values), k, floor)
                    found.append((np.full(len(docs), row), np.full(len(docs), item), shard.ids[docs], shard.rows[docs], scores))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["item_row", "item_id", "doc_id", "row", "score"])

    return run


def search(items: DataFrame, docs: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_lane: int = QUERY_LANE, item_id: str = "item_id", doc_id: str = "doc_id", text: str = "text", first: int = FIRST) -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score)."""
    asked = written(counted(items, None, item_id, text).withColumn("row", F.monotonically_increasing_id()), "items")
    kept = written(counted(docs, bitmap(asked), doc_id, text).where("n > 0").withColumn("row", F.monotonically_increasing_id()), "terms")
    found = kept.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length"), F.coalesce(F.sum(F.when(F.col("terms") != "", 1)), F.lit(0)).alias("rows")).first()
    total = (found["documents"], found["length"])
    holders = kept.select(F.explode(F.split("terms", " ")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    each = asked.select("id", "row", F.explode(F.arrays_zip(F.split("terms", " ").alias("term"), F.col("counts").alias("times"))).alias("x")).select("id", "row", "x.*")
    weight = F.floor(1000 * F.log(F.lit(2.0 * total[0] + 2) / (2 * F.col("df") + 1)))
    each = each.join(holders, "term").select("id", "row", "term", (weight * F.col("times")).alias("weight"))
    pairs = F.collect_list(F.struct("term", "weight"))
    asked = written(each.groupBy("id", "row").agg(pairs.alias("x")).select("id", "row", F.array_join("x.term", " ").alias("terms"), F.col("x.weight").alias("weights")), "weighted")
    shards, lanes = max(1, -(-found["rows"] // shard_rows)), max(1, -(-asked.count() // query_lane))
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    none = lambda kind: F.lit(None).cast(kind)
    dealt = lambda many: F.pmod(F.xxhash64("row"), F.lit(many)).cast("int")
    best = Window.partitionBy("item_row").orderBy(F.desc("score"), "doc_id", "row")

    def met(some: int, floors: DataFrame) -> DataFrame:
        """The search of the first ``some`` shards."""
        left = kept.where(F.col("terms") != "").select(dealt(shards).alias("shard"), "id", "row", "n", "terms", "counts", none("array<bigint>").alias("weights"), F.lit(0).cast("long").alias("floor")).where(F.col("shard") < some)
        left = left.select("shard", every(lanes).alias("lane"), F.lit(0).alias("is_query"), "id", "row", "n", "terms", "counts", "weights", "floor")
        right = floors.select(every(some).alias("shard"), "id", "row", "terms", "weights", "floor")
        right = right.select("shard", dealt(lanes).alias("lane"), F.lit(1).alias("is_query"), "id", "row", none("bigint").alias("n"), "terms", none("array<int>").alias("counts"), "weights", "floor")
        rows = left.unionByName(right).repartition(min(some * lanes, 1 << 15), "shard", "lane").sortWithinPartitions("shard", "lane", "is_query")
        out = rows.mapInArrow(_searched(k, total), "item_row long, item_id long, doc_id long, row long, score long")
        return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    floors = asked.withColumn("floor", F.lit(0).cast("long"))
    if shards > 1:
        reached = met(-(-shards // first), floors).where(F.col("rank") == k).select(F.col("item_row").alias("row"), F.col("score").alias("reached"))
        floors = written(asked.join(reached, "row", "left").withColumn("floor", F.coalesce("reached", F.lit(0).cast("long"))), "floors")
    shown = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return met(shards, floors).select(shown("item_id"), "rank", shown("doc_id"), "score")


def op13_geometric_blocks(spark, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item; see the module."""
    return search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), i AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark
), q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL
), l AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL
), g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l
), t AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM t, g GROUP BY term, docs
), s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN l USING (doc_id), g GROUP BY ALL
), r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
