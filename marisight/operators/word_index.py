"""Posting lists of words: made on the fly for one search, or kept in a folder and brought up to date.

A posting is (term, id, n, gaps): the places of a term in a row, each as its distance from the one before.  Rows are
tokenised once.  A kept index has, for each update, a *segment* of new and changed rows:

    postings/bucket=B/segment=S   postings, by a hash of the term, sorted by term
    counts/bucket=B/segment=S     rows that hold each term
    rows/segment=S                the segment's rows and removed ones, written last

The newest segment that has a row is the one that counts, so an update replaces rows (and an update that is run
again, its own segment) without touching older files, and half-written segments aren't seen.  ``compacted`` writes
one segment out of all.  A search reads the buckets of its questions' terms and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.functions.vectors import lexemes
from marisight.operators.tables import settled, spread

BUCKETS = 64
#: terms of all questions up to which they are broadcast
BROADCAST_TERMS = 200_000
#: gaps are bytes, four a number: they are only read as a whole, and Spark copies bytes at once
_POSTING = "id long, term string, n int, gaps binary"


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def postings(rows: DataFrame) -> DataFrame:
    """(id, term, n, gaps) of rows (id, words array<string>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                lists = part.column(1)
                size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
                coded = lists.flatten().dictionary_encode()
                code = np.asarray(coded.indices, dtype=np.int64)
                row = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
                key = row * max(1, len(coded.dictionary)) + code
                order = np.argsort(key, kind="stable")
                key, place = key[order], place[order]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                gaps = np.diff(place, prepend=0)
                gaps[first] = place[first]
                n = np.diff(np.r_[first, len(key)])
                term = coded.dictionary.take(pa.array(key[first] % max(1, len(coded.dictionary))))
                listed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((4 * np.r_[first, len(key)]).astype("<i4")), pa.py_buffer(gaps.astype("<i4"))])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row[order][first])), term, pa.array(n.astype(np.int32)), listed], names=["id", "term", "n", "gaps"])

    return rows.select(F.col("id").cast("long").alias("id"), "words").mapInArrow(run, _POSTING)


def tokenised(index: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return spread(index.select("id", *columns)).select("id", lexemes(F.concat_ws(" ", *columns)).alias("words"))


def asked(queries: DataFrame) -> DataFrame:
    """(query_id, n_terms, term, number): the distinct words of each question; those without any drop out."""
    rows = queries.select("query_id", F.array_distinct(lexemes(F.col("query_text"))).alias("terms"))
    return rows.select("query_id", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("number", "term"))


def _met(rows: DataFrame, few: DataFrame, on: list[str], bounded: bool) -> DataFrame:
    return rows.join(F.broadcast(few) if bounded else few, on)


def matches(found: DataFrame, counts: DataFrame, wanted: DataFrame, bounded: bool) -> DataFrame:
    """(query_id, id, n_terms, places): the rows that hold every word of a question, with all places of its words as
    (pos, term number).  ``found`` has the postings of all words that are asked for.  A question's rarest word gives
    the rows to look at; their postings of its other words are met by (id, term), so no row's text travels."""
    known = wanted.join(counts, "term").withColumn("_all", F.count(F.lit(1)).over(_by_query())).where(F.col("_all") == F.col("n_terms"))
    known = settled(known.withColumn("_turn", F.row_number().over(_by_query().orderBy("n", "term"))).select("query_id", "n_terms", "number", "term", "_turn"))
    first = _met(found, known.where("_turn = 1").select("term", "query_id"), ["term"], bounded).select("query_id", "id", *_segment(found))
    each = first.join(F.broadcast(known) if bounded else known, "query_id").select("query_id", "id", *_segment(found), "n_terms", "number", "term")
    met = each.join(found.select("id", *_segment(found), "term", "gaps"), ["id", *_segment(found), "term"])
    keys = ["query_id", "id", *_segment(found), "n_terms"]
    whole = met.groupBy(*keys).agg(F.collect_list(F.struct("number", "gaps")).alias("lists")).where(F.size("lists") == F.col("n_terms"))
    return _decoded(whole.select("query_id", "id", *_segment(found), "n_terms", "lists"))


def _segment(found: DataFrame) -> list[str]:
    return ["segment"] if "segment" in found.columns else []


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id")


def _decoded(whole: DataFrame) -> DataFrame:
    """``lists`` of gaps as ``places`` (pos, term), terms numbered from 1."""
    names = [c for c in whole.columns if c != "lists"]
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields if f.name != "lists"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            terms = lists.flatten()
            gaps = terms.field("gaps")
            size = np.asarray(pc.binary_length(gaps), dtype=np.int64) // 4
            total = np.cumsum(np.frombuffer(b"".join(gaps.to_pylist()), "<i4"), dtype=np.int64)
            before = np.r_[0, total][np.cumsum(size) - size]
            pos = total - np.repeat(before, size)
            number = np.repeat(np.asarray(terms.field("number"), dtype=np.int64) + 1, size)
            per = np.add.reduceat(size, np.r_[0, np.cumsum(np.asarray(pc.list_value_length(lists)))[:-1]]) if batch.num_rows else size
            places = pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), pa.array(number)], names=["pos", "term"])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), places)], names=[*names, "places"])

    return whole.select(*names, "lists").mapInArrow(run, ", ".join([*fields, "places array<struct<pos:int,term:bigint>>"]))


def on_the_fly(index: DataFrame, queries: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Matches over an index that isn't kept: its words' postings, as far as they are asked for, are made once."""
    wanted = settled(asked(queries))
    terms = wanted.select("term").distinct()
    bounded = wanted.count() <= BROADCAST_TERMS
    found = settled(_met(postings(tokenised(index, columns)), terms, ["term"], bounded))
    return matches(found, found.groupBy("term").agg(F.count(F.lit(1)).alias("n")), wanted, bounded)


# --- kept ------------------------------------------------------------------------------------------


def by_bucket(rows: DataFrame, path: str) -> None:
    """Writes the rows of a segment, each bucket sorted by term, over what an earlier run of the segment wrote."""
    rows.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "segment").parquet(path)


def update(folder: str, changed: DataFrame, segment: int, removed: DataFrame | None = None, columns: tuple[str, ...] = ("chunk_text",)) -> None:
    """Writes segment number ``segment`` with the changed rows (id, columns) and the ids of removed ones.  Rows of an id
    in an earlier segment no longer count.  The same segment written again replaces itself."""
    rows = changed.select("id", *columns)
    found = postings(tokenised(rows, columns)).withColumn("bucket", bucket_of(F.col("term"))).withColumn("segment", F.lit(segment))
    by_bucket(found, f"{folder}/postings")
    session = changed.sparkSession
    counts = session.read.schema(found.schema).parquet(f"{folder}/postings").where(F.col("segment") == segment).groupBy("bucket", "segment", "term").agg(F.count(F.lit(1)).alias("n"))
    by_bucket(counts, f"{folder}/counts")
    gone = rows.select("id").where("false") if removed is None else removed.select("id")
    state = rows.select("id", F.lit(True).alias("held")).unionByName(gone.select("id", F.lit(False).alias("held"))).groupBy("id").agg(F.max("held").alias("held"))
    state.write.mode("overwrite").parquet(f"{folder}/rows/segment={segment}")


def live(spark: SparkSession, folder: str) -> DataFrame:
    """(id, segment) of the rows that count."""
    rows = spark.read.parquet(f"{folder}/rows")
    newest = rows.groupBy("id").agg(F.max_by("held", "segment").alias("held"), F.max("segment").alias("segment"))
    return newest.where("held").select("id", "segment")


def kept_matches(spark: SparkSession, folder: str, queries: DataFrame) -> DataFrame:
    """Matches over a kept index."""
    wanted = settled(asked(queries).withColumn("bucket", bucket_of(F.col("term"))))
    buckets = [r.bucket for r in wanted.select("bucket").distinct().collect()]  # BUCKETS numbers at most
    if not buckets:
        return spark.createDataFrame([], "query_id long, id long, n_terms int, places array<struct<pos:int,term:bigint>>")
    bounded = wanted.count() <= BROADCAST_TERMS
    terms = wanted.select("bucket", "term").distinct()
    read = lambda name: _met(spark.read.parquet(f"{folder}/{name}").where(F.col("bucket").isin(*buckets)), terms, ["bucket", "term"], bounded)
    counts = read("counts").groupBy("term").agg(F.sum("n").alias("n"))
    met = matches(read("postings").select("id", "segment", "term", "gaps"), counts, wanted.drop("bucket"), bounded)
    return met.join(live(spark, folder), ["id", "segment"], "left_semi").drop("segment")


def compacted(spark: SparkSession, folder: str, into: str) -> None:
    """Writes the rows that count as segment 0 of another folder, from the postings alone."""
    now = settled(live(spark, folder))
    found = spark.read.parquet(f"{folder}/postings").join(now, ["id", "segment"], "left_semi").withColumn("segment", F.lit(0))
    for name, frame in (("postings", found), ("counts", found.groupBy("bucket", "segment", "term").agg(F.count(F.lit(1)).alias("n")))):
        frame.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket", "segment").parquet(f"{into}/{name}")
    now.select("id", F.lit(True).alias("held")).write.parquet(f"{into}/rows/segment=0")
