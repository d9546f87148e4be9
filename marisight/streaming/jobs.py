"""Structured Streaming forms of what is incremental."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import LongType, StructField, StructType, TimestampType


def event_stream(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def usage_stream(requests: DataFrame, late: str = "2 days") -> DataFrame:
    """Requests and tokens per user and day, final once the watermark has passed the day."""
    day = F.window("ts", "1 day")
    return requests.withWatermark("ts", late).groupBy(day.alias("day"), "user_id").agg(F.count(F.lit(1)).alias("request_count"), F.sum("tokens").alias("tokens_budgeted")).select(F.to_date("day.start").alias("usage_date"), "user_id", "request_count", "tokens_budgeted")


def quota_stream(requests: DataFrame, max_requests: int = 25, max_tokens: int = 15_000, late: str = "1 day", shares: int = 256) -> DataFrame:
    """Decisions on requests (request_id, user_id, ts, tokens) by the running totals of the user's day, in the order of
    time: (request_id, running_requests, running_tokens, allowed), to be kept by request_id (output mode update).

    A request is decided as it comes.  One that comes with an earlier time changes the decisions after it, which are
    given out again, so what is kept equals the decisions over all requests however these are cut into batches.
    The users of a day are dealt over ``shares``, each of which is decided in one pass.  The state of a share is its
    users' totals up to the watermark and the requests since; it goes once the watermark has passed the day, and
    requests later than that are dropped."""
    kind = "request_id long, running_requests long, running_tokens long, allowed boolean"
    columns = ("who", "at", "request_id", "tokens", "count", "total")

    def decide(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        users, requests, tokens, *held = map(list, state.get) if state.exists else [[]] * (3 + len(columns))
        known, new = dict(zip(columns, held)), pd.concat(list(parts))
        row = lambda c, given: np.concatenate([np.asarray(known[c], np.int64), given])
        arrived = np.full(len(new), -1)
        number, names = pd.factorize(np.array([*users, *known["who"], *new["who"]], object), use_na_sentinel=False)
        names = np.where(pd.isna(names), None, names)
        who, at, ids = number[len(users) :], row("at", new["at"].to_numpy(np.int64)), row("request_id", new["request_id"].to_numpy(np.int64))
        cost, count, total = row("tokens", new["tokens"].fillna(0).to_numpy(np.int64)), row("count", arrived), row("total", arrived)
        order = np.lexsort((ids, at, who))
        who, at, ids, cost, count, total = (x[order] for x in (who, at, ids, cost, count, total))
        first = np.searchsorted(who, np.arange(len(names)))  # each user's first row, the end for those without any
        base = np.zeros((2, len(names)), np.int64)
        base[:, : len(users)] = requests, tokens
        before = np.concatenate([[0], np.cumsum(cost)])
        running, spent = base[0, who] + np.arange(len(who)) - first[who] + 1, base[1, who] + before[1:] - before[first[who]]
        changed = (running != count) | (spent != total)
        done = at < state.getCurrentWatermarkMs() * 1000
        np.add.at(base, (slice(None), who[done]), np.stack([np.ones(done.sum(), np.int64), cost[done]]))
        kept = [x[~done].tolist() for x in (names[who], at, ids, cost, running, spent)]
        some = base[0] > 0
        state.update((names[some].tolist(), *base[:, some].tolist(), *kept))
        state.setTimeoutTimestamp(max(int(at.max()) // 86_400_000_000 * 86_400_000 + 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"request_id": ids, "running_requests": running, "running_tokens": spent, "allowed": (running <= max_requests) & (spent <= max_tokens)})[changed]

    day = F.floor(F.unix_micros("ts") / 86_400_000_000)
    share = F.pmod(F.xxhash64("user_id"), F.lit(shares))
    rows = requests.withWatermark("ts", late).select("request_id", F.col("user_id").cast("string").alias("who"), "ts", day.alias("day"), share.alias("share"), F.unix_micros("ts").alias("at"), "tokens")
    held = "users array<string>, requests array<long>, spent array<long>, who array<string>, at array<long>, ids array<long>, each array<long>, count array<long>, total array<long>"
    return rows.groupBy("share", "day").applyInPandasWithState(decide, kind, held, "update", "EventTimeTimeout")


def feedback_stream(feedback: DataFrame, citations: DataFrame) -> DataFrame:
    """Net ratings per document as ratings stream in, against a static table of citations.  The state is the result, a
    row for each document that was ever rated, and never ends."""
    met = feedback.join(citations, "message_id")
    return met.groupBy("document_id").agg(F.count_if(F.col("rating") == 1).alias("positive_count"), F.count_if(F.col("rating") == -1).alias("negative_count"), F.coalesce(F.sum("rating"), F.lit(0)).alias("net_score"))


def session_stream(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user (an extension: incremental jobs elsewhere have none)."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("events")).select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "events")


def fingerprints(files: DataFrame, late: str | None = None) -> DataFrame:
    """Each (storage_path, version_token) once: what an incremental indexer has to parse.  With ``late``, repeats
    are recognised for that long behind column ``modified`` and older ones leave the state; without it every version
    that was ever seen is remembered."""
    key = ["storage_path", "version_token"]
    return files.dropDuplicates(key) if late is None else files.withWatermark("modified", late).dropDuplicatesWithinWatermark(key)


class KeyedSink:
    """Batches of a stream kept by key, for ``foreachBatch``: each batch writes the rows of the keys that it changed,
    then a line in the manifest.  A batch that is run again replaces its own rows; one that was killed before its line
    isn't seen.  ``table`` has the newest row of each key."""

    def __init__(self, folder: str, keys: tuple[str, ...]):
        self.folder, self.keys = folder.rstrip("/"), keys

    def __call__(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/data/batch={batch}")
        rows.sparkSession.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/batch={batch}")

    def rows(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """All rows of finished batches, with ``batch``."""
        read = lambda name, kind: spark.read.schema(kind).option("basePath", f"{self.folder}/{name}").parquet(f"{self.folder}/{name}")
        batch = StructField("batch", LongType())
        whole = read("data", StructType([*schema.fields, batch]))
        return whole.join(read("manifest", StructType([StructField("at", TimestampType()), batch])).select("batch"), "batch", "left_semi")

    def table(self, spark: SparkSession, schema: StructType) -> DataFrame:
        values = [c for c in schema.names if c not in self.keys]
        last = self.rows(spark, schema).groupBy(*self.keys).agg(F.max_by(F.struct("batch", *values), "batch").alias("last"))
        return last.select(*self.keys, *[f"last.{c}" for c in values])

    def compacted(self, spark: SparkSession, schema: StructType, into: str) -> KeyedSink:
        """The newest rows as the first batch of another folder."""
        other = KeyedSink(into, self.keys)
        other(self.table(spark, schema), 0)
        return other


def index_stream(files: DataFrame, cut: Callable[[DataFrame], DataFrame], sink: KeyedSink, checkpoint: str, late: str | None = None) -> StreamingQuery:
    """Indexes what is there now: each version of a file once, cut into rows by ``cut``, kept by the sink's keys."""
    return run_available(fingerprints(files, late), checkpoint, lambda batch, number: sink(cut(batch), number))


def run_available(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Everything that is there now, in bounded batches, then stop; resumes from its checkpoint."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start()
