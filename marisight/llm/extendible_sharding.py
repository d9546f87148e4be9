"""Sharding by extendible hashing.

Documents fall into buckets by the leading bits of a hash of their id.  A bucket over the byte limit
splits on its next bit, and only that one; the directory maps every hash prefix to the bucket that
holds it.  Spark does this ``STEP`` bits at a time: bytes are summed per STEP-bit prefix (at most
2**STEP sums), sums of shorter prefixes follow from them, and a bucket is a prefix that fits while the
one before it does not.  Documents find their shard by a join with that directory, whose size is
bounded by 2**STEP; only buckets still too large go on to the next STEP bits.

Bytes with the very same hash can't be told apart by more bits.  A bucket over the limit that holds one
hash alone leaves the rounds at once: its rows are dealt over lanes of about ``LANE_ROWS`` rows, however many
they are, and each lane is cut into parts by a running sum, so that repeated rows of one id split too.

Defined results: a shard exceeds the limit only if it is one document that does so alone; null texts
have 0 bytes; null ids hash as the empty string; an empty table has no shards; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.llm._shared import written

STEP = 16
HASH_BITS = 128
LIMIT = 256 << 10
#: rows of one hash that a lane has on average
LANE_ROWS = 4096


def _digits(first_bit: int) -> Column:
    """STEP hash bits from the given one, as a number."""
    return F.conv(F.substring("hash", first_bit // 4 + 1, STEP // 4), 16, 10).cast("long")


def directory(rows: DataFrame, first_bit: int, limit: int) -> DataFrame:
    """(stem, slot, depth, prefix, fits, bytes, docs, one): the bucket of each STEP-bit slot under each longer stem, and
    whether it holds one hash alone."""
    fine = rows.groupBy("stem", _digits(first_bit).alias("slot")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    above = F.explode(F.sequence(F.lit(0), F.lit(STEP))).alias("depth")
    paths = fine.select("*", above).withColumn("prefix", F.expr(f"shiftright(slot, {STEP} - depth)"))
    nodes = paths.groupBy("stem", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), (F.min("low") == F.max("high")).alias("one"))
    nodes = nodes.withColumn("fits", (F.col("bytes") <= limit) | (F.col("docs") == 1))
    # along each slot's path from the root: the first bucket that fits, or the deepest one
    path = paths.select("stem", "slot", "depth", "prefix").join(nodes, ["stem", "depth", "prefix"])
    first = F.min_by(F.struct("depth", "prefix", "fits", "bytes", "docs", "one"), F.when(F.col("fits"), F.col("depth")).otherwise(3 * STEP - F.col("depth")))
    return path.groupBy("stem", "slot").agg(first.alias("b")).select("stem", "slot", "b.*")


def shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, part) and the columns to ``keep``: the shard of each row is its hash prefix in
    bits, and its part."""
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), key.alias("hash"), F.lit("").alias("stem"), *keep)
    rows = written(rows, "hashed")
    done = same = None
    for bit in range(0, HASH_BITS, STEP):
        split = rows.withColumn("slot", _digits(bit)).join(directory(rows, bit, limit), ["stem", "slot"])
        label = F.concat("stem", F.expr(f"case when depth = 0 then '' else substring(lpad(bin(slot), {STEP}, '0'), 1, depth) end"))
        split = written(split.select("doc_id", "n_bytes", "hash", label.alias("stem"), (F.lit(bit) + F.col("depth")).cast("int").alias("depth"), "fits", "one", "docs", *keep), "split")
        fitting = split.where("fits").select("doc_id", "n_bytes", F.col("stem").alias("shard"), "depth", F.lit(0).cast("long").alias("part"), *keep)
        alone = split.where("NOT fits AND one").select("doc_id", "n_bytes", "hash", "docs", *keep)
        done, same = (fitting, alone) if done is None else (done.unionByName(fitting), same.unionByName(alone))
        rows = split.where("NOT fits AND NOT one").select("doc_id", "n_bytes", "hash", "stem", *keep)
        if rows.isEmpty():
            break
    if same.isEmpty():
        return done
    # one hash, several rows: rows over half the limit alone, others by a running sum of half the limit
    bits = F.concat(*[F.lpad(F.bin(F.conv(F.substring("hash", at + 1, 8), 16, 10).cast("long")), 32, "0") for at in range(0, HASH_BITS // 4, 8)])
    lanes = same.withColumn("stem", bits).withColumn("lane", F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("docs") / LANE_ROWS)))
    lanes = written(lanes, "lanes")
    small = F.col("n_bytes") * 2 <= limit
    run = Window.partitionBy("stem", "lane").orderBy("n_bytes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = Window.partitionBy("stem", "lane").orderBy("n_bytes")
    part = F.when(small, F.floor(F.greatest(F.sum("n_bytes").over(run) - 1, F.lit(0)) * 2 / limit)).otherwise(-F.row_number().over(order))
    cut = lanes.select("doc_id", "n_bytes", F.col("stem").alias("shard"), F.lit(HASH_BITS).alias("depth"), ((F.col("lane") + 1) * F.lit(1 << 40) + part).cast("long").alias("part"), *keep)
    return done.unionByName(cut)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Writes docs, each row once, as one folder per shard under path; returns what was written.  Rows are told
    apart by a key of their own, so ids may be null or repeat."""
    keyed = written(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    placed = keyed.join(shards(keyed, limit=limit, keep=("__row",)).select("__row", "shard", "part"), "__row").drop("__row")
    placed.repartition("shard", "part").write.partitionBy("shard", "part").parquet(path)
    return docs.sparkSession.read.parquet(path)


def op4_extendible_sharding(spark, sf_dir: str) -> DataFrame:
    """The shard of every document, with the shard's bytes and documents."""
    placed = shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    per = placed.groupBy("shard", "part").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return placed.join(per, ["shard", "part"]).select("doc_id", "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs")


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 4) AS BIGINT) AS slot
  FROM documents
), p AS (
  SELECT d.*, k AS depth, slot >> (16 - k) AS prefix FROM d CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(0, 17))
), n AS (
  SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL
), f AS (
  SELECT p.*, n.shard_bytes, n.shard_docs, row_number() OVER (PARTITION BY doc_id ORDER BY p.depth) AS r
  FROM p JOIN n USING (depth, prefix) WHERE n.shard_bytes <= {LIMIT} OR n.shard_docs = 1
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE substr(lpad(bin(slot), 16, '0'), 1, depth) END AS shard,
       depth, CAST(0 AS BIGINT) AS part, shard_bytes, shard_docs
FROM f WHERE r = 1
"""
