"""Mixing sources to target weights.

Sources in code-point order (null last) get the given weights in turn and share the size of the whole
corpus by weight; no target exceeds ``most`` times its source's size, and what a full source can't
take is shared again among the others by weight until none is above (water filling, in one pass over
the sources ordered by the share at which they fill up).

Each source's words, its documents in a fixed hash order, are packed end to end into blocks of
``block`` words.  The mix is a sequence of output shards of ``shard_slots`` slots (the last may be
shorter):

1. Each shard's source counts are a multinomial draw: each of its slots draws a source with the
   sources' shares of all slots as probabilities.
2. Over all shards a source then has some slots too many or too few.  Of its drawn slots those too many
   are given up, evenly spread over all that it drew, and sources with too few take the slots given up,
   dealt out by a pseudorandom permutation.  So shards stay full and every source's slots come to its
   rounded target; a shard's counts differ from its draw by about the relative error of the draw.
3. The slots of a source, in shard order, run through pseudorandom permutations of its block indices,
   another one on each round, and are joined with the blocks by index.  A source's last slot is cut to
   the words still wanted.

Nothing is drawn twice: draws and permutations are functions of indices and seed, so reruns and
recomputed tasks agree.  Sources may be few and huge: documents and slots are dealt out by hash and by
index range, never by source alone, and running numbers over shards are taken in two levels.

Defined results: a null text has size 0; documents of size 0 are never taken; a null source is a
source of its own, last in order; repeated rows are separate documents; the sources' table (a row
per source) is the only thing ordered as a whole; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marisight.llm import _words as W
from marisight.llm._batches import longs, slices
from marisight.llm._permute import permute
from marisight.llm._shared import written

BLOCK = 64
SHARD_SLOTS = 1024
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20_240_229
#: documents of a source are ordered inside so many hash buckets; only bucket sums are ordered as a whole
BUCKETS = 4096
#: running numbers are taken inside groups of so many shards, and over the sums of such groups
_GROUP = 4096
#: draws are looked up in so many equal parts of the sources' shares
_PARTS = 1 << 16
#: slots that one task unfolds
_UNFOLD = 1 << 18


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``size``, the words of the whole text, instead of the text."""
    names = [c for c in docs.columns if c not in (text, "size")]
    kept = docs.select(text, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            count = W.words(batch.column(0)).counts.astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(count)], names=[*names, "size"])

    return kept.mapInArrow(run, StructType([*kept.schema.fields[1:], StructField("size", LongType())]))


def targets(sized: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(skey, source, number, source_size, weight, target), one row per source."""
    per = sized.groupBy("skey").agg(F.first(source).alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    turn = F.array(*[F.lit(w) for w in weights])[n % len(weights)]
    per = per.select("skey", "source", "source_size", n.cast("long").alias("number"), turn.cast("double").alias("weight"))
    cap = (F.col("source_size") * most).cast("double")
    filling = Window.orderBy(cap / F.col("weight"), "number")
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    share = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.select("*", share.alias("share"), F.row_number().over(filling).alias("turn"))
    full = F.col("source_size") * most <= F.col("share") * F.col("weight")
    level = F.min_by(F.when(~full, F.col("share")), F.when(~full, F.col("turn"))).over(everything)
    return per.select("skey", "source", "number", "source_size", "weight", F.least(cap, F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def plan(per: DataFrame, block: int, seed: int) -> DataFrame:
    """Per source: blocks, whole rounds and the slots and last cut of the round begun."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = longs(batch.column(1)), longs(batch.column(2))
            want = np.rint(np.asarray(batch.column(3), dtype=np.float64)).astype(np.int64)
            safe = np.maximum(size, 1)
            blocks = -(-size // block)
            rounds = np.where(size > 0, want // safe, 0)
            rest = np.where(size > 0, want - rounds * safe, 0)
            short = size - (blocks - 1) * block
            # where the short last block stands in the round begun decides how many slots the rest takes
            stands = permute(np.maximum(blocks - 1, 0), np.maximum(blocks, 1), seeds(seed, number, rounds), backward=True)
            plain = -(-rest // block)
            early = stands < plain
            slots = np.where(early, -(-(rest + block - short) // block), plain)
            slots = np.where(rest > 0, slots, 0)
            done = (slots - 1) * block - np.where(stands < slots - 1, block - short, 0)
            cut = np.where(slots > 0, rest - done, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in (number, blocks, rounds, slots, cut)]], names=["skey", "number", "blocks", "rounds", "slots", "cut"])

    return per.select("skey", "source_size", "number", "target").mapInArrow(run, "skey string, number long, blocks long, rounds long, slots long, cut long")


def seeds(seed: int, number: np.ndarray, round_: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(number.astype(np.uint64) + np.uint64(seed)) + round_.astype(np.uint64))


def packed(sized: DataFrame, block: int = BLOCK) -> DataFrame:
    """Documents with the span of their source's word stream that they fill: ``start`` and ``turn``."""
    bucketed = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))
    sums = bucketed.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("skey", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("skey", "bucket").orderBy("doc_id", "size", "row")
    rows = bucketed.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("inner"),
        F.row_number().over(inside).alias("turn"),
    )
    return rows.join(sums, ["skey", "bucket"]).withColumn("start", F.col("ahead") + F.col("inner")).drop("inner", "ahead")


def _running(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """rows, one per ``keys`` and ``shard``, with ``name``: the sum of ``value`` over the shards before."""
    grouped = rows.withColumn("_g", F.floor(F.col("shard") / _GROUP))
    before = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = grouped.groupBy(*keys, "_g").agg(F.sum(value).alias(value))
    sums = sums.select(*keys, "_g", before(Window.partitionBy(*keys or [F.lit(0)]).orderBy("_g")).alias("_ahead"))
    inside = grouped.withColumn("_in", before(Window.partitionBy(*keys, "_g").orderBy("shard")))
    return inside.join(sums, [*keys, "_g"]).withColumn(name, (F.col("_ahead") + F.col("_in")).cast("long")).drop("_g", "_in", "_ahead")


def shard_counts(made: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, number, count): the slots of each source in each shard, drawn and brought to the sources' totals.
    ``made`` has a row per source: number, its slots ``all``, and ``ahead``, those of the sources before."""
    spark = made.sparkSession
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(total))
    part = lambda u: F.floor(u * (_PARTS / total)).cast("int")
    draws = spark.range(total).select(F.floor(F.col("id") / shard_slots).alias("shard"), draw.alias("u")).withColumn("part", part(F.col("u")))
    shares = made.select("number", F.col("ahead").alias("lo"), (F.col("ahead") + F.col("all")).alias("hi"))
    shares = shares.select("*", F.explode(F.sequence(part(F.col("lo")), part(F.col("hi") - 1))).alias("part"))
    met = draws.join(shares, (draws["part"] == shares["part"]) & (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
    drawn = written(met.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("count")), "drawn")
    # of the slots too many those go at which the kept ones' running share makes no step
    had = made.select("number", "all").join(drawn.groupBy("number").agg(F.sum("count").alias("had")), "number", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    rows = _running(drawn, ["number"], "count", "at").join(had, "number")
    kept = lambda x: (x.cast("decimal(38,0)") * F.col("all") / F.col("had")).cast("decimal(38,10)")
    some = (F.floor(kept(F.col("at") + F.col("count"))) - F.floor(kept(F.col("at")))).cast("long")
    rows = written(rows.select("shard", "number", "count", F.when(F.col("had") > F.col("all"), some).otherwise(F.col("count")).alias("kept")), "kept")
    free = rows.groupBy("shard").agg(F.sum(F.col("count") - F.col("kept")).alias("free")).where("free > 0")
    free = _running(free, [], "free", "first").select("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("free") - 1)).alias("turn"))
    short = had.where(F.col("had") < F.col("all")).withColumn("lacks", F.col("all") - F.col("had"))
    order = Window.orderBy("number")  # a row per source
    short = short.select("number", "lacks", F.coalesce(F.sum("lacks").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("lacks").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("every"))
    short = short.select("number", "every", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("lacks") - 1)).alias("place"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, place = longs(batch.column(1)), longs(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(permute(place, every, W.mix(np.full(len(place), seed + 1, np.uint64))))], names=["number", "turn"])

    gained = short.mapInArrow(dealt, "number long, turn long").join(free, "turn").groupBy("shard", "number").agg(F.count(F.lit(1)).alias("kept"))
    return rows.select("shard", "number", "kept").unionByName(gained).groupBy("shard", "number").agg(F.sum("kept").alias("count")).where(F.col("count") > 0)


def slots(per: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: (skey, block, shard, place, cut) per slot; ``cut`` is the words taken, null for the whole block."""
    made = plan(per, block, seed).withColumn("all", F.col("blocks") * F.col("rounds") + F.col("slots")).where(F.col("all") > 0)
    in_order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    made = written(made.withColumn("ahead", F.coalesce(F.sum("all").over(in_order), F.lit(0))), "plan")  # a row per source
    total = made.agg(F.coalesce(F.sum("all"), F.lit(0))).first()[0]
    names = ["skey", "number", "blocks", "rounds", "slots", "cut", "all", "shard", "count", "begin", "ordinal"]
    if not total:
        return made.select("skey", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("place"), "cut").where("false")
    counts = _running(shard_counts(made, total, shard_slots, seed), ["number"], "count", "begin").repartition(max(1, -(-total // _UNFOLD)), "shard")
    before = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ordinal", F.coalesce(F.sum("count").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                number, blocks, _, begun, cut, every, shard, count, begin, ordinal = (longs(part.column(i)) for i in range(1, 11))
                row = np.repeat(np.arange(part.num_rows), count)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                k = begin[row] + step
                index = permute(k % blocks[row], blocks[row], seeds(seed, number[row], k // blocks[row]))
                size = np.minimum(total - shard[row] * shard_slots, shard_slots)
                place = permute(ordinal[row] + step, size, seeds(seed, shard[row], np.zeros(len(row), np.int64)))
                last = (k == every[row] - 1) & (begun[row] > 0)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(index), pa.array(shard[row]), pa.array(place), pa.array(cut[row], mask=~last)], names=["skey", "block", "shard", "place", "cut"])

    return counts.join(F.broadcast(made) if made.count() <= _PARTS else made, "number").select(*names).mapInArrow(run, "skey string, block long, shard long, place long, cut long")


def _drawn(docs: DataFrame, text: str, source: str, weights: tuple[int, ...], most: int, block: int, shard_slots: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(spans, targets, slots).  Spans: the part of each block that each row of docs (by ``row``) fills, ``from`` its
    first word to ``to``, with the ``times`` that the whole block is taken and the words of it last taken, ``cut``."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sized = sizes(docs.select("row", "doc_id", F.col(source).cast("string").alias("source"), F.col(text).alias("text")))
    sized = written(sized.withColumn("skey", key), "sizes")
    per = written(targets(sized, "source", weights, most), "targets")
    chosen = written(slots(per, block, shard_slots, seed), "slots")
    taken = chosen.groupBy("skey", "block").agg(F.count(F.when(F.col("cut").isNull(), 1)).alias("times"), F.max("cut").alias("cut"))
    rows = packed(sized, block)
    ends = F.col("start") + F.col("size")
    spans = rows.select("*", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((ends - 1) / block)))).alias("block"))
    spans = spans.withColumn("from", F.greatest(F.col("start") - F.col("block") * block, F.lit(0))).withColumn("to", F.least(ends - F.col("block") * block, F.lit(block)))
    # the planner takes the mix for as small as the table of sources that it unfolds from; it grows with the corpus
    return spans.join(taken.hint("merge"), ["skey", "block"], "left"), per, chosen


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, slots).  Documents: doc_id, size, source_size, target and taken; slots: see ``slots``."""
    met, per, chosen = _drawn(docs.withColumn("row", F.monotonically_increasing_id()), text, source, weights, most, block, shard_slots, seed)
    part = F.greatest(F.least(F.col("to"), F.col("cut")) - F.col("from"), F.lit(0))
    words = F.coalesce(F.col("times") * (F.col("to") - F.col("from")), F.lit(0)) + F.coalesce(F.when(F.col("cut").isNotNull(), part), F.lit(0))
    out = met.groupBy("row", "doc_id", "skey", "size").agg(F.sum(words).cast("long").alias("taken"))
    out = out.join(per.select("skey", "source_size", "target"), "skey").select("doc_id", "size", "source_size", "target", "taken")
    return out, chosen


def _copies(text: int):
    """Rows as often as their spans are taken, each with the words of its spans in the text's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            w, names = W.words(batch.column(text)), batch.schema.names[:-1]
            data, rows, texts = w.data.tobytes(), [], []
            listed = batch.column(len(names))
            fields, ends = listed.flatten().flatten(), np.cumsum(np.asarray(listed.value_lengths(), dtype=np.int64))
            lo, hi, times, cut = (longs(f) for f in fields)
            for row in range(batch.num_rows):
                mine = slice(ends[row - 1] if row else 0, ends[row])
                by, base = np.argsort(lo[mine]), int(w.first[row])
                a, b, t, c = (x[mine][by] for x in (lo, hi, times, cut))
                for copy in range(1, int((t + (c > 0)).max()) + 1):
                    here = (t >= copy) | ((t + 1 == copy) & (c > 0))
                    first, last = a[here], np.where(t >= copy, b, a + c)[here]
                    rows.append(row)
                    if (last - first).sum() == w.counts[row]:
                        texts.append(batch.column(text)[row].as_py())
                        continue
                    new = np.r_[True, first[1:] != last[:-1]]  # spans that meet are one run, with the separators that the text has
                    opens, closes = first[new] + base, last[np.r_[new[1:], True]] + base - 1
                    texts.append(b"\n".join(data[x:y] for x, y in zip(w.start[opens].tolist(), w.end[closes].tolist(), strict=True)).decode())
            index = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(i).type) if i == text else batch.column(i).take(index) for i in range(len(names))], names=names)

    return run


def mixed_texts(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The words that the mix takes of docs, in docs' columns.

    The n-th row of a document holds its spans that are taken n times or more: all of it is the text as it is, of
    others the runs of adjacent spans, a line feed between them.  Rows are told apart by a key of their own, so ids
    may be null or repeat."""
    keyed = written(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    met, _, _ = _drawn(keyed.select(F.col("__row").alias("row"), "doc_id", source, text), text, source, weights, most, block, shard_slots, seed)
    lo = F.col("block") * block + F.col("from") - F.col("start")
    cut = F.coalesce(F.greatest(F.least(F.col("to"), F.col("cut")) - F.col("from"), F.lit(0)), F.lit(0))
    cut = F.when(F.col("cut").isNull(), 0).otherwise(cut)
    spans = met.where("times is not null").select("row", lo.cast("long").alias("lo"), (lo + F.col("to") - F.col("from")).cast("long").alias("hi"), F.col("times").cast("long").alias("times"), cut.cast("long").alias("cut"))
    spans = spans.where("times + cut > 0").groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("lo", "hi", "times", "cut")).alias("__spans"))
    rows = keyed.join(spans, "__row").select(*docs.columns, "__spans")
    return rows.mapInArrow(_copies(docs.columns.index(text)), docs.schema)


def _pieces(block: int):
    """Each document's words as the pieces of its source's blocks that they fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            w, start = W.words(batch.column(0)), longs(batch.column(2))
            data, rows, index, at, said = w.data.tobytes(), [], [], [], []
            for row in range(batch.num_rows):
                first, n = int(w.first[row]), int(w.counts[row])
                spelt = [data[a:b].decode() for a, b in zip(w.start[first : first + n].tolist(), w.end[first : first + n].tolist(), strict=True)]
                lo = 0
                while lo < n:
                    here = int(start[row]) + lo
                    hi = min(n, lo + block - here % block)
                    rows.append(row)
                    index.append(here // block)
                    at.append(here % block)
                    said.append(" ".join(spelt[lo:hi]))
                    lo = hi
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(rows, pa.int64())), pa.array(index, pa.int64()), pa.array(at, pa.int64()), pa.array(said, pa.string())], names=["skey", "block", "at", "said"])

    return run


def mixture(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix itself, slot by slot: (shard, place, skey, block, text), the words of each drawn block joined by spaces."""
    keyed = written(docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", source, text), "keyed")
    spans, _, chosen = _drawn(keyed, text, source, weights, most, block, shard_slots, seed)
    starts = spans.where(F.col("size") > 0).groupBy("row").agg(F.first("skey").alias("skey"), F.first("start").cast("long").alias("start"))
    rows = keyed.join(starts, "row").select(F.col(text).alias("text"), "skey", "start")
    pieces = rows.mapInArrow(_pieces(block), "skey string, block long, at long, said string")
    blocks = pieces.groupBy("skey", "block").agg(F.array_sort(F.collect_list(F.struct("at", "said"))).alias("parts"))  # at most a block's words
    words = F.array_join(F.col("parts.said"), " ")
    met = chosen.join(blocks.select("skey", "block", words.alias("text")), ["skey", "block"])
    return met.select("shard", "place", "skey", "block", F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("cut").cast("int")), " ")).alias("text"))


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source; see the module."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs)[0]
