"""Streams give what the tables give, however their input is cut into files."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from marisight.operators import state
from marisight.streaming import jobs

SCHEMA = "request_id long, user_id long, ts timestamp, tokens long"
DAY = datetime.datetime(2024, 3, 1)


def cut_into_files(spark, rows, folder, files):
    for i, part in enumerate(files):
        spark.createDataFrame([rows[k] for k in part], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        import time

        time.sleep(0.05 if i else 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_quota_does_not_depend_on_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), DAY + datetime.timedelta(minutes=rng.randrange(3 * 24 * 60)), rng.choice([100, 900, None])) for i in range(120)]
    rows.sort(key=lambda r: r[2] + datetime.timedelta(hours=rng.randrange(10)))  # late by ten hours at most
    cuts = sorted({0, 120, *rng.sample(range(120), 5)})
    folder = f"file://{tmp_path}/in"
    cut_into_files(spark, rows, folder, [range(a, b) for a, b in zip(cuts, cuts[1:])])
    made = jobs.quota_stream(jobs.event_stream(spark, folder, spark.createDataFrame(rows, SCHEMA), 1), 4, 3000)
    sink = jobs.KeyedSink(f"file://{tmp_path}/out", ("request_id",))
    query = jobs.run_available(made, f"file://{tmp_path}/state", sink, "update")
    query.awaitTermination()
    columns = ("request_id", "running_requests", "running_tokens", "allowed")
    got = sorted(tuple(r[c] for c in columns) for r in sink.table(spark, made.schema).collect())
    table = spark.createDataFrame([(a, b, c, d or 0) for a, b, c, d in rows], SCHEMA)
    want = sorted(tuple(r[c] for c in columns) for r in state.quota_decisions(table, 4, 3000).collect())
    assert got == want


def test_quota_state_ends(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    rows = [(i, i % 5, DAY + datetime.timedelta(days=i // 10), 10) for i in range(60)]
    cut_into_files(spark, rows, folder, [range(a, a + 10) for a in range(0, 60, 10)])
    made = jobs.quota_stream(jobs.event_stream(spark, folder, spark.createDataFrame(rows, SCHEMA), 1), late="1 hour")
    query = jobs.run_available(made, f"file://{tmp_path}/state", jobs.KeyedSink(f"file://{tmp_path}/out", ("request_id",)), "update")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 15 and held[-1] <= 10  # five users' days, not all thirty


def test_sink_of_killed_and_repeated_batches(spark, tmp_path):
    sink = jobs.KeyedSink(f"file://{tmp_path}/sink", ("k",))
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    sink(frame([(1, "a"), (2, "a")]), 0)
    sink(frame([(2, "b"), (3, "b")]), 1)
    frame([(1, "never"), (9, "never")]).write.parquet(f"file://{tmp_path}/sink/data/batch=2")  # killed before its line
    schema = frame([]).schema
    read = lambda s: sorted((r.k, r.v) for r in s.table(spark, schema).collect())
    assert read(sink) == [(1, "a"), (2, "b"), (3, "b")]
    for _ in range(2):
        sink(frame([(1, "c")]), 2)
    assert read(sink) == [(1, "c"), (2, "b"), (3, "b")]
    assert read(sink.compacted(spark, schema, f"file://{tmp_path}/one")) == read(sink)


def test_index_takes_each_version_once(spark, tmp_path):
    folder, at = f"file://{tmp_path}/in", f"file://{tmp_path}/at"
    kind = "storage_path string, version_token string, text string"
    sink = jobs.KeyedSink(f"{at}/index", ("storage_path",))
    seen = []

    def cut(rows):
        seen.append(rows.count())
        return rows.select("storage_path", "version_token", F.upper("text").alias("text"))

    for rows in ([("a", "1", "x"), ("b", "1", "y")], [("a", "1", "x"), ("b", "2", "z")], []):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
        files = jobs.event_stream(spark, folder, spark.createDataFrame([], kind))
        jobs.index_stream(files, cut, sink, f"{at}/state").awaitTermination()
    got = sorted((r.storage_path, r.version_token, r.text) for r in sink.table(spark, spark.createDataFrame([], kind).schema).collect())
    assert got == [("a", "1", "X"), ("b", "2", "Z")] and sum(seen) == 3


def test_quota_decides_many_users_in_one_pass(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    rows = [(i, None if i % 50 == 0 else i % 3000, DAY + datetime.timedelta(minutes=(i * 37) % 2880), 500) for i in range(9000)]
    cut_into_files(spark, rows, folder, [range(0, 4000), range(4000, 9000)])
    made = jobs.quota_stream(jobs.event_stream(spark, folder, spark.createDataFrame(rows, SCHEMA), 1), 2, 900, "3 days", shares=8)
    sink = jobs.KeyedSink(f"file://{tmp_path}/out", ("request_id",))
    query = jobs.run_available(made, f"file://{tmp_path}/state", sink, "update")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(held) <= 2 * 8  # a row for each share of a day, not for each user's day
    columns = ("request_id", "running_requests", "running_tokens", "allowed")
    got = sorted(tuple(r[c] for c in columns) for r in sink.table(spark, made.schema).collect())
    want = sorted(tuple(r[c] for c in columns) for r in state.quota_decisions(spark.createDataFrame(rows, SCHEMA), 2, 900).collect())
    assert got == want
