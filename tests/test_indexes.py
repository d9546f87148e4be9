"""Kept word index and inverted file of vectors against searches over everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marisight.operators import retrieval, vector_index, word_index

TEXTS = {1: "a rose is a rose", 2: "a lily", 3: "rose and lily and rose", 4: "", 5: None, 6: "Rose É 9", 7: "lily rose a"}
ASKED = [(10, "rose a"), (11, "lily"), (12, "é ROSE"), (13, ""), (14, "unknown rose"), (15, "rose rose and")]


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), "id long, chunk_text string")


def asked(spark):
    return spark.createDataFrame([(q, t, None) for q, t in ASKED], "query_id long, query_text string, embedding array<float>")


def rows_of(df):
    return sorted((r.query_id, r.id, round(r.fts_rank, 9), r.frank) for r in df.collect())


def test_kept_words_follow_updates(spark, tmp_path):
    folder = f"file://{tmp_path}/words"
    questions = asked(spark)
    word_index.update(folder, frame(spark, {**TEXTS, 2: "a rose once", 8: "rose lily a", 9: "lily"}), 1)
    word_index.update(folder, frame(spark, {2: TEXTS[2], 8: "gone"}), 2, removed=frame(spark, {9: ""}))
    for _ in range(2):  # a batch that is run again
        word_index.update(folder, frame(spark, {9: "nothing"}), 3, removed=frame(spark, {8: ""}))
    want = rows_of(retrieval.fts_pool(frame(spark, {**TEXTS, 9: "nothing"}), questions, 5))
    assert rows_of(retrieval.kept_fts_pool(folder, questions, 5)) == want and len(want) == 7
    word_index.compacted(spark, folder, f"{folder}-one")
    assert rows_of(retrieval.kept_fts_pool(f"{folder}-one", questions, 5)) == want
    assert spark.read.parquet(f"{folder}-one/postings").select("segment").distinct().count() == 1


def test_kept_words_read_their_buckets_alone(spark, tmp_path):
    folder = f"file://{tmp_path}/words"
    word_index.update(folder, frame(spark, {i: f"w{i} w{i % 7} common" for i in range(200)}), 1)
    one = spark.createDataFrame([(1, "w3 common")], "query_id long, query_text string")
    met = word_index.kept_matches(spark, folder, one)
    plan = met._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert met.count() == len([i for i in range(200) if i == 3 or i % 7 == 3])
    assert word_index.kept_matches(spark, folder, one.where("query_id = 2")).count() == 0


def test_places_come_back_from_gaps(spark):
    found = word_index.on_the_fly(frame(spark, TEXTS), asked(spark), ("chunk_text",))
    got = {(r.query_id, r.id): sorted((p.pos, p.term) for p in r.places) for r in found.collect()}
    assert got[10, 1] == [(0, 2), (1, 1), (3, 2), (4, 1)] and got[15, 3] == [(0, 1), (1, 2), (3, 2), (4, 1)] and got[12, 6] == [(0, 2), (1, 1)]
    assert set(got) == {(10, 1), (10, 7), (11, 2), (11, 3), (11, 7), (12, 6), (15, 3)}
    assert word_index.on_the_fly(frame(spark, TEXTS).where("false"), asked(spark), ("chunk_text",)).count() == 0


def test_shuffled_terms_give_the_same(spark, monkeypatch):
    want = rows_of(retrieval.fts_pool(frame(spark, TEXTS), asked(spark), 5))
    monkeypatch.setattr(word_index, "BROADCAST_TERMS", 0)
    assert rows_of(retrieval.fts_pool(frame(spark, TEXTS), asked(spark), 5)) == want


def vectors(spark, rows, name):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"{name} long, embedding array<double>")


@pytest.mark.parametrize("shard", [8192, 16])
def test_cells_search_exactly(spark, monkeypatch, shard):
    monkeypatch.setattr(vector_index, "VECTOR_ROWS", shard)
    monkeypatch.setattr(vector_index, "QUESTIONS", 8)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((9, 8)) * 4
    rows = [(i, centres[i % 9] + rng.standard_normal(8)) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]  # equal rows
    rows += [(600, np.zeros(8)), (601, [1.0, 2.0]), (602, None), (603, []), (604, [float("nan")] * 8)]
    questions = [(i, rows[i * 7][1] + 0.1) for i in range(30)] + [(90, np.zeros(8)), (91, [3.0, 1.0]), (92, None)]
    index, asking = vectors(spark, rows, "id"), vectors(spark, questions, "query_id")
    want = {(r.query_id, r.vrank): (r.id, round(r.similarity, 9)) for r in retrieval.vector_pool(index, asking, 7).collect()}
    built = vector_index.built(index, lists=12)
    assert sum(built.size.values()) == 463 and built.size[vector_index.OTHERS] == 3
    for probes in (1, 4):
        got = {(r.query_id, r.vrank): (r.id, round(r.similarity, 9)) for r in vector_index.search(built, asking, 7, probes).collect()}
        assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()} and sum(got[k] == want[k] for k in want) > len(want) - 8  # ids of equals may swap by rounding


def test_calibrated_probes_reach_their_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16)) * 2
    index = vectors(spark, [(i, centres[i % 20] + rng.standard_normal(16)) for i in range(1500)], "id")
    asking = index.where("id % 17 = 0").withColumnRenamed("id", "query_id")
    built = vector_index.built(index, lists=20)
    probes = vector_index.calibrated(built, 10)
    assert 1 <= probes < 20
    exact = {(r.query_id, r.id) for r in vector_index.search(built, asking, 10).collect()}
    some = {(r.query_id, r.id) for r in vector_index.search(built, asking, 10, probes, exact=False).collect()}
    assert len(exact & some) / len(exact) >= 0.9


def test_cells_of_nothing(spark):
    empty = vectors(spark, [], "id")
    for index in (vector_index.built(empty), vector_index.built(vectors(spark, [(1, [0.0, 0.0])], "id"))):
        found = vector_index.search(index, vectors(spark, [(5, [1.0, 0.0])], "query_id"), 3).collect()
        assert [(r.id, r.similarity) for r in found] == [(i, 0.0) for i in index.rows.select("id").toPandas()["id"]]


def test_given_vectors_reach_their_recall(spark, sf_dir):
    from marisight.plans.retrieval_queries import cell_recall

    total = cell_recall(spark, sf_dir).agg(F.sum("found"), F.sum("wanted")).first()
    assert total[0] / total[1] >= 0.9


def test_equal_vectors_have_equal_similarities():
    import numpy as np
    import pyarrow as pa

    from marisight.operators.retrieval import _nearest

    rng, table = np.random.default_rng(1), lambda x: pa.table({"id": pa.array(range(len(x))), "embedding": pa.array(x.tolist())})
    one = rng.normal(size=64).astype(np.float32).astype(float)
    for asked, copies in ((200, 1111), (1000, 37), (7, 8191)):
        made = _nearest(5)(table(rng.normal(size=(asked, 64)).astype(np.float32).astype(float)), table(np.tile(one, (copies, 1))))
        assert made["id"].to_pylist() == [0, 1, 2, 3, 4] * asked


def test_density_of_two_words_from_their_places(spark, sf_dir):
    import random

    from marisight.functions import sql
    from marisight.plans import walk_queries

    sql.registered(spark)
    r = random.Random(3)
    rows = [(i, [r.choice("aabbbcd") for _ in range(r.randrange(40))]) for i in range(200)]
    docs = spark.createDataFrame([(i, w, [(p + 1, "ab".index(x) + 1) for p, x in enumerate(w) if x in "ab"][::-1]) for i, w in rows], "id long, words array<string>, places array<struct<pos:int,term:bigint>>")
    got = docs.selectExpr("cover_density(array('a', 'b'), words) AS x", "pair_density(places) AS y").collect()
    assert all(g.x == g.y for g in got) and sum(g.x > 0 for g in got) > 150
    plan = walk_queries.sql_fusion(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # words are taken once, before


def test_an_update_writes_its_postings_once(spark, monkeypatch, tmp_path):
    """Postings go to their files as they are made, and what is counted is read from there."""
    monkeypatch.setattr(word_index, "settled", lambda df: pytest.fail("written elsewhere first"))
    word_index.update(str(tmp_path), frame(spark, TEXTS), 1)
    kept = spark.read.parquet(f"{tmp_path}/postings")
    assert dict(kept.dtypes)["gaps"] == "binary" and kept.where("length(gaps) <> 4 * n").count() == 0
    counts = {r.term: r.n for r in spark.read.parquet(f"{tmp_path}/counts").collect()}
    assert counts == {r.term: r["count"] for r in kept.groupBy("term").count().collect()} and counts


def test_equal_densities_are_ranked_by_id(spark):
    rng = np.random.default_rng(5)
    spaced = lambda q, gaps: " ".join(w for i, gap in enumerate([*gaps, 1]) for w in [f"{'ab'[i % 2]}{q}", *["x"] * (gap - 1)])  # noqa: E731  # a cover for each gap
    gaps = [(g, g[::-1]) for g in ([int(x) for x in rng.integers(1, 30, 2 * int(rng.integers(2, 8)))] for _ in range(40))]
    docs = [(2 * q + i, spaced(q, g)) for q, both in enumerate([*gaps, ((3, 12), (4, 6))]) for i, g in enumerate(both)]
    questions = [(q, f"a{q} b{q}") for q in range(41)]
    got = retrieval.fts_pool(spark.createDataFrame(docs, "id long, chunk_text string"), spark.createDataFrame(questions, "query_id long, query_text string"), 5).collect()
    by = {(r.query_id, r.frank): r for r in got}
    assert len(got) == 82 and all(by[q, 1].id == 2 * q and by[q, 1].fts_rank == by[q, 2].fts_rank for q in range(41))
