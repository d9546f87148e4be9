"""Language-model scoring by prediction by partial matching (PPM).

A byte-context trie of order ``ORDER`` is counted over all training documents.  A byte is coded in the
longest context seen in training; if the context has not seen it, an escape is coded and the next
shorter context tries, down to the uniform order.  Escapes are estimated by method C (as often as the
context has distinct followers) and symbols that a longer context would have coded are excluded from
the shorter ones.  As a context's followers are followers of every suffix of it, exclusion only needs
two sums per context, computed once; so the pretrained trie is one table with a row per order and
context.  The code length of a document adds up to its log10 probability.

A document's bytes are its lower-cased words joined by one space, then one line feed as the end; it
starts in the context of line feeds.

The trie holds all strings.  What most bytes cost travels to the tasks: that of the most frequent strings
of ORDER + 1 bytes, those that occur ``HOT_COUNT`` times or more and of these at most ``MAX_LEAVES``, read
off a histogram over all of them.  All other strings of a document, rare or unseen, are counted inside
each slice; each distinct one is joined with its contexts in the trie (a context has at most 256
followers; the 257 contexts of the two shortest orders are broadcast), so scores don't depend on what
travels.  Word counts for the base score are exact at any vocabulary in the same way: the
``COMMON_WORDS`` most frequent go to the tasks, all others are joined by word hash.

Defined results: null and empty texts are the end alone; null ids count as training rows; without
training rows every byte costs the uniform order and N is 0; repeated rows count and score each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisight.llm import _words as W
from marisight.llm._batches import longs, slices
from marisight.llm._shared import written

ORDER = 5
MAX_LEAVES = 1 << 20
HOT_COUNT = 4
COMMON_WORDS = 1 << 18
_END = 10
_GRAM, _WORD = 0, 1
_U = np.uint64


def held_out(doc_id: Column, folds: int = 7, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves the remainder; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == remainder, F.lit(False))


def _stream(w: W.Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each row): words joined by one space, each row led by ``order`` ends and closed by one."""
    count = w.counts
    keep, data = ~W.is_space(w.data), w.data.copy()
    inner = np.ones(len(w.start), bool)
    inner[w.first[1:][count > 0] - 1] = False
    after = w.end[inner]  # the first of the separators behind each word but a row's last
    keep[after], data[after] = True, 0x20
    size = np.r_[0, np.cumsum(w.end - w.start)]
    size = size[w.first[1:]] - size[w.first[:-1]] + np.maximum(count - 1, 0) + order + 1
    starts = np.cumsum(size) - size
    out = np.full(int(size.sum()), _END, np.uint8)
    body = np.ones(len(out), bool)
    body[(starts[:, None] + np.arange(order)).ravel()] = False
    body[starts + size - 1] = False
    out[body] = data[keep]
    return out, starts


def _grams(stream: np.ndarray, k: int) -> np.ndarray:
    """The k bytes from each position as one number: len(stream) - k + 1 values."""
    n = len(stream) - k + 1
    out = np.zeros(max(n, 0), _U)
    for j in range(k):
        out <<= _U(8)
        out |= stream[j : j + n]
    return out


def _coded(stream: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte of every coded byte as one number, the coded bytes before each row)."""
    whole = np.ones(max(len(stream) - order, 0), bool)
    if len(starts) > 1:  # no context reaches into the row before
        whole[(starts[1:, None] - 1 - np.arange(order)).ravel()] = False
    count = np.r_[starts[1:], len(stream)] - starts - order
    return _grams(stream, order + 1)[whole], np.r_[0, np.cumsum(count)]


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 2 << 20):
            w = W.words(batch.column(0), lower=True)
            for kind, keys in ((_GRAM, _coded(*_stream(w, order), order)[0]), (_WORD, W.word_hashes(w))):
                key, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(W.signed(key)), pa.array(n)], names=["kind", "key", "n"])

    return run


class _Hash:
    """Open addressing from 64-bit keys to their index, probed for whole arrays."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        self.mask, self.slots = _U(size - 1), np.full(size, -1, np.int32)
        self.keys = keys
        todo, at = np.arange(len(keys), dtype=np.int32), W.mix(keys) & self.mask
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of those that want one slot, one gets it
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + _U(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        at = W.mix(keys) & self.mask
        slot = self.slots[at]
        hit = (slot >= 0) & (self.keys[slot] == keys)
        out[hit] = slot[hit]
        todo = np.flatnonzero((slot >= 0) & ~hit)
        at = at[todo]
        while len(todo):
            at = (at + _U(1)) & self.mask
            slot = self.slots[at]
            hit = (slot >= 0) & (self.keys[slot] == keys[todo])
            out[todo[hit]] = slot[hit]
            more = (slot >= 0) & ~hit
            todo, at = todo[more], at[more]
        return out


def _lists(keys: np.ndarray, row: np.ndarray, rows: int, name: str) -> pa.Array:
    """Of each row the distinct keys and how often each occurs."""
    by = np.lexsort((keys, row))
    keys, row = keys[by], row[by]
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])]) if len(by) else np.zeros(0, np.int64)
    times = np.diff(np.r_[new, len(by)])
    offsets = np.searchsorted(row[new], np.arange(rows + 1)).astype(np.int32)
    listed = pa.StructArray.from_arrays([pa.array(W.signed(keys[new])), pa.array(times.astype(np.int32))], names=[name, "times"])
    return pa.ListArray.from_arrays(pa.array(offsets), listed)


def _score(order: int, hot: np.ndarray, costs: np.ndarray, common: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves, words = _Hash(hot), _Hash(common)
        for batch in slices(batches, 0, 1 << 20):
            m = batch.num_rows
            w = W.words(batch.column(0), lower=True)
            grams, first = _coded(*_stream(w, order), order)
            found = leaves.find(grams)
            cost = np.zeros(len(grams))
            cost[found >= 0] = costs[found[found >= 0]]
            total = np.r_[0.0, np.cumsum(cost)]
            left = np.flatnonzero(found < 0)
            asked = _lists(grams[left], np.searchsorted(first, left, side="right") - 1, m, "gram")
            h, row = W.word_hashes(w), w.row_of()
            found = words.find(h)
            known = found >= 0
            base = np.bincount(row[known], weights=np.log10(counts[found[known]] + 1.0), minlength=m).astype(np.float64)
            rare = _lists(h[~known], row[~known], m, "word")
            made = [w.counts.astype(np.int64) + 1, np.bincount(row[known], minlength=m), base, total[first[1:]] - total[first[:-1]]]
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(x) for x in made], rare, asked], names=["doc_id", "n_tokens", "n_common", "common_score", "hot_score", "rare", "asked"])

    return run


def _suffix(gram: str, k: Column) -> Column:
    """The last k + 1 bytes of a string, as a number; none for k = -1."""
    return F.col(gram).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (8 * (k + 1)).cast("int")) - 1)


def _orders(rows: DataFrame, first: int, order: int) -> DataFrame:
    """rows once for each order k, with the string cut to it."""
    out = rows.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(first, order + 1)])))
    return out.withColumn("cut", _suffix("gram", F.col("k")))


def trie_of(leaves: DataFrame, order: int) -> DataFrame:
    """(k, context, total, kinds, lost, followers) for all contexts of orders 0 … order: the bytes counted in it, its
    distinct followers, what the next shorter context loses by excluding these, and the count of each follower."""
    levels = _orders(leaves, 0, order).groupBy("k", "cut").agg(F.sum("n").alias("n"))
    shorter = levels.select((F.col("k") + 1).alias("k"), F.col("cut").alias("suffix"), F.col("n").alias("below"))
    met = levels.withColumn("suffix", _suffix("cut", F.col("k") - 1)).join(shorter, ["k", "suffix"], "left")
    follower = F.struct(F.col("cut").bitwiseAND(F.lit(255).cast("long")).cast("int").alias("byte"), "n")
    per = met.groupBy("k", F.shiftrightunsigned("cut", 8).alias("context"))
    return per.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("below"), F.lit(0)).alias("lost"), F.map_from_entries(F.collect_list(follower)).alias("followers"))


def _costs(asked: DataFrame, trie: DataFrame, order: int) -> DataFrame:
    """(gram, cost): log10 probability of the last byte of each asked string after the others."""
    byte = F.col("gram").bitwiseAND(F.lit(255).cast("long")).cast("int")
    answer = F.when(F.col("total").isNotNull(), F.struct(F.coalesce(F.try_element_at("followers", byte), F.lit(0)).alias("n"), "total", "kinds", "lost"))
    short = min(order, 1)
    known = asked
    for k in range(short + 1):  # at most 256 contexts
        here = trie.where(F.col("k") == k).drop("k")
        known = known.withColumn("context", F.shiftrightunsigned(_suffix("gram", F.lit(k)), 8)).join(F.broadcast(here), "context", "left")
        known = known.withColumn(f"a{k}", answer).drop(*here.columns)
    if order > short:
        long_ = _orders(asked, short + 1, order).withColumn("context", F.shiftrightunsigned("cut", 8)).join(trie, ["k", "context"], "left")
        long_ = long_.groupBy("gram").agg(*[F.max(F.when(F.col("k") == k, answer)).alias(f"a{k}") for k in range(short + 1, order + 1)])
        known = known.join(long_, "gram")
    of = lambda k, c: F.coalesce(F.col(f"a{k}.{c}"), F.lit(0)).cast("double")
    cost = F.lit(0.0)
    for k in range(order, -1, -1):
        lost, gone = (of(k + 1, c) if k < order else F.lit(0.0) for c in ("lost", "kinds"))
        kinds = of(k, "kinds") - gone
        whole = of(k, "total") - lost + kinds
        here = F.when(of(k, "n") > 0, F.log10(of(k, "n") / whole)).when((of(k, "kinds") > 0) & (whole > 0), F.log10(kinds / whole)).otherwise(0.0)
        # a string seen in training has all its suffixes seen: one order longer tells whether the byte is coded yet
        cost = cost + (here if k == order else F.when(of(k + 1, "n") > 0, 0.0).otherwise(here))
    uniform = F.when(of(0, "n") > 0, 0.0).otherwise(-F.log10(F.greatest(256 - of(0, "kinds"), F.lit(1.0))))
    return known.select("gram", (cost + uniform).alias("cost"))


def _least_count(table: DataFrame, most: int) -> Column:
    """Which rows (by ``n``) are among the ``most`` of the highest counts: the steps of a histogram that are whole in them."""
    step = F.floor(F.log2("n") * 16)  # some thousand steps at most
    sizes = table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    least, so_far = 0, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        so_far += r["rows"]
        if so_far > most:
            least = r["step"] + 1
            break
    return step >= least


def _arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys and values of a bounded table of two columns."""
    got = table.toArrow()
    key, value = longs(got.column(0).combine_chunks()).view(_U), np.asarray(got.column(1).combine_chunks())
    by = np.argsort(key)
    return key[by].copy(), value[by].copy()


def language_scores(docs: DataFrame, training: Column, text: str = "text", order: int = ORDER, max_leaves: int = MAX_LEAVES, common_words: int = COMMON_WORDS, hot_count: int = HOT_COUNT) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row, learnt from the rows where ``training``."""
    counts = docs.where(training).select(F.col(text).alias("t")).mapInArrow(_count(order), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = written(counts, "counts")
    totals = counts.where(F.col("kind") == _WORD).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_training = docs.where(training).count()
    vocabulary, tokens = totals[0] + (n_training > 0), totals[1] + n_training
    leaves = counts.where(F.col("kind") == _GRAM).select(F.col("key").alias("gram"), "n")
    trie = written(trie_of(leaves, order), "trie")
    hot = trie.where(F.col("k") == order).select("context", "total", "kinds", F.explode("followers").alias("byte", "n"))
    hot = hot.where((F.col("n") >= hot_count) & _least_count(leaves, max_leaves))
    gram = F.call_function("shiftleft", F.col("context"), F.lit(8)).bitwiseOR(F.col("byte").cast("long"))
    hot, costs = _arrays(hot.select(gram.alias("gram"), F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost")))
    words = counts.where(F.col("kind") == _WORD)
    key, n = _arrays(words.where(_least_count(words, common_words)).select("key", "n"))
    schema = "doc_id long, n_tokens long, n_common long, common_score double, hot_score double, rare array<struct<word:long,times:int>>, asked array<struct<gram:long,times:int>>"
    rows = docs.select(F.col(text).alias("t"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(_score(order, hot, costs, key, n), schema)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    met = asked.join(words.select(F.col("key").alias("word"), F.col("n")), "word")
    more = met.groupBy("row").agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_score"))
    open_ = rows.select("row", F.explode("asked").alias("r")).select("row", "r.gram", "r.times")
    costly = _costs(written(open_.select("gram").distinct(), "asked"), trie, order)
    coded = open_.join(costly, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("open_score"))
    out = rows.drop("rare", "asked").join(more, "row", "left").join(coded, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    end_known = F.lit(1 if n_training else 0)
    base = F.col("common_score") + F.coalesce("rare_score", F.lit(0.0)) + F.lit(float(np.log10(n_training + 1.0))) - F.col("n_tokens") * F.lit(float(np.log10(tokens + vocabulary + 1.0)))
    return out.select("doc_id", "n_tokens", (F.col("n_common") + zero("n_rare") + end_known).cast("long").alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("hot_score") + F.coalesce("open_score", F.lit(0.0))).alias("score"))


def op10_ppm_scoring(spark, sf_dir: str) -> DataFrame:
    """Base and PPM log10 probabilities of every whole document; see the module."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = language_scores(docs, ~held_out(F.col("doc_id")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
