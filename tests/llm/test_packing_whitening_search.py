"""Operators 11 to 13 against plain versions, and their edge cases."""

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute

from marisight.llm import curve_packing, geometric_blocks, vector_whitening
from marisight.llm.queries import ORACLE_SQL, QUERIES

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", "a", " a", "a ", "it's  <|endoftext|> x", "x <|endoftext|> y", "日本 語 a b", "a b c d", "é è ñ x", "x\ty z \n", "\x1c a b", "a b\x85 c d", "don 't x 's", "  lead two", "١٢ 3 x ½ y", "a  b c   d e", "ñ a ñ b ª º c", "a ́b c", "😀 a 😀b", "tab \t a", "a b\r\n c"]


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


# --- 11 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims).astype(np.uint64)
    number = curve_packing.hilbert(cells, bits)
    assert sorted(number.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(number)].astype(int), axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("ranks", [RANKS, None])
def test_ids_are_the_librarys(ranks):
    encode = curve_packing.Encoder(JSON, ranks, public_tokenizers.PATTERN)
    rng = random.Random(3)
    mixed = ["".join(rng.choice(["a", "é", " ", "  ", "\n", "'s", "9", "½", "ab ", "語", "!", " "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts = [*ODD, None, *mixed, " ".join(ODD), "x" * 5000, "w " * 5000]
    flat, first, _, _ = encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert flat[first[i] : first[i + 1]].tolist() == encode.library.encode(text or "", add_special_tokens=False).ids, text


def test_op11_whole_documents(spark, sf_dir):
    rows = QUERIES["op11_curve_packing"](spark, sf_dir).collect()
    library = curve_packing.Encoder(JSON).library
    want = {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t in texts_of(spark, sf_dir).items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[d])
            assert r.ids_crc32 == zlib.crc32(np.array(want[d][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & at - 1 == 0  # nothing to pad
    assert len(by_sequence) <= sum(map(len, want.values())) / 2048 + 12 * 4


def test_op11_edges(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x y z"), (3, "x y z"), (3, "x y z"), (4, "w " * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("curve", F.lit(None).cast("long"))
    pieces = curve_packing.pack(curve_packing.encoded(docs, JSON, RANKS, public_tokenizers.PATTERN), 16)
    got = pieces.collect()
    lengths = Counter()
    for r in got:
        lengths[r.doc_id] += r.length
        assert r.length == len(r.ids) // 4 <= 16
    assert lengths[None] == 3 and lengths[1] == lengths[2] == 1 and lengths[3] == 12 and lengths[4] == sum(r.length for r in got if r.doc_id == 4) == next(r.doc_tokens for r in got if r.doc_id == 4)
    packed = curve_packing.sequences(pieces, length=16).collect()
    assert sum(r.n_ids for r in packed) == sum(lengths.values())
    assert all(len(r.ids) == r.n_ids and [s.offset for s in r.spans] == sorted({s.offset for s in r.spans}) for r in packed)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert curve_packing.pack(curve_packing.encoded(empty, JSON)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        curve_packing.pack(curve_packing.encoded(empty, JSON), 100)


def test_op11_padding_of_other_sequences(spark):
    piece = lambda s, o, ids: (1, 0, len(ids), bytearray(np.array(ids, "<u4").tobytes()), len(ids), s, o)
    pieces = spark.createDataFrame([piece(7, 0, [5, 6]), piece(7, 2, [8]), piece(9, 0, [3, 4])], "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    got = {r.sequence_id: r.ids for r in curve_packing.sequences(pieces, pad_id=0, length=8).collect()}
    assert got == {7: [5, 6, 8, 0, 0, 0, 0, 0], 9: [3, 4]}


def test_op11_similar_documents_share_sequences(spark):
    rng = random.Random(1)
    topics = [[f"t{t}w{i}" for i in range(40)] for t in range(8)]
    rows = [(i, " ".join(rng.choice(topics[i % 8]) for _ in range(60))) for i in range(400)]
    coded = curve_packing.encoded(spark.createDataFrame(rows, "doc_id long, text string"), JSON, RANKS, public_tokenizers.PATTERN)
    shared = defaultdict(set)
    for r in curve_packing.pack(coded).collect():
        shared[r.sequence_id].add(r.doc_id)
    pairs = [(a % 8 == b % 8) for docs in shared.values() for a in docs for b in docs if a < b]
    assert sum(pairs) / len(pairs) > 0.3  # an eighth by chance
    equal = [(r.doc_id, r.sequence_id) for r in curve_packing.pack(curve_packing.encoded(spark.createDataFrame([(i, "same text here") for i in range(100)] + [(1000 + i, t) for i, t in rows], "doc_id long, text string"), JSON)).collect() if r.doc_id < 100]
    assert len({s for _, s in equal}) <= 3


# --- 12 --------------------------------------------------------------------------------------------


def plain_whitening(x, k=8):
    n, s = len(x), x.sum(0)
    centred = x - s / n
    value, axes = np.linalg.eigh(centred.T @ centred / n)
    value, axes = value[::-1], axes[:, ::-1]
    return centred @ axes[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum(), [sum(int(d) ** 2 for d in n * row - s) for row in x]


def test_op12_against_full_decomposition(spark, sf_dir):
    got = QUERIES["op12_vector_whitening"](spark, sf_dir).toPandas()
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x = np.floor(1024 * np.stack(e.embedding).astype(float)).astype(np.int64) + 100_000
    white, explained, deviation = plain_whitening(x)
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[e.vec_id].to_numpy()
    table *= np.sign((table * white).sum(0))
    assert np.abs(table - white).max() < 1e-9
    first = got[got.component == 1].set_index("vec_id").loc[e.vec_id]
    assert first.deviation.tolist() == deviation and (got.n == len(x)).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-10
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)


VECTORS = "vec_id long, embedding array<float>, component int, whitened string"


def whitened(spark, rows, **how):
    return vector_whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS), **how).collect()


def test_op12_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.0]), (2, [2.0, 0.5, 1.0]), (2, [2.0, 0.5, 1.0]), (None, [0.0, 1.0, 5.0]), (7, [-3.0, 0.0, 1.0])]
    bad = [(3, None), (4, []), (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]), (8, [None, 1.0, 2.0]), (9, [1.0, 2.0])]
    got = whitened(spark, rows + bad)
    assert Counter(r.vec_id for r in got) == {1: 3, 2: 6, None: 3, 7: 3} and {r.n for r in got} == {5}
    white, _, deviation = plain_whitening(np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000, 3)
    assert {r.deviation for r in got if r.vec_id is None} == {deviation[3]}
    assert sorted(abs(r.whitened) for r in got if r.vec_id == 7) == pytest.approx(sorted(np.abs(white[4])))
    assert whitened(spark, [(1, [1.0, 2.0])]) == whitened(spark, [(i, [1.0, 2.0]) for i in range(9)]) == whitened(spark, []) == whitened(spark, bad[:2]) == []
    huge = whitened(spark, [(i, [3e30 * (i % 2), float(i)]) for i in range(40)])
    assert {r.deviation for r in huge} == {None} and max(r.identity_error for r in huge) < 1e-4


def test_op12_repeated_eigenvalues_and_few_rows(spark):
    cross = [(i, [8.0 * s if j == k else 0.0 for j in range(12)]) for i, (k, s) in enumerate((k, s) for k in range(12) for s in (1, -1))]
    got = whitened(spark, cross)
    assert len(got) == 24 * 8 and max(r.identity_error for r in got) < 1e-9
    rng = np.random.default_rng(2)
    few = whitened(spark, [(i, rng.standard_normal(20).tolist()) for i in range(5)])
    assert max(r.component for r in few) == 4 and max(r.identity_error for r in few) < 1e-9


def test_op12_ends_when_wanted_components_have_converged():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 120)) * 3 * 0.8 ** np.arange(120)
    x -= x.mean(0)
    passes = []

    def product(p):
        passes.append(1)
        u = x @ p
        return u @ x, float(u @ u)

    made = vector_whitening.bidiagonal(product, 120, 4, full=64)
    _, singular, right = made.svd()
    _, want, axes = np.linalg.svd(x)
    assert len(passes) < 110 and np.allclose(singular[:4], want[:4], rtol=1e-13)
    assert np.abs(np.abs((right[:4] @ np.array(made.v) * axes[:4]).sum(1)) - 1).max() < 1e-12
    left = x @ np.array(made.p).T
    assert np.abs(left.T @ left - np.eye(len(made.p))).max() < 1e-10  # both sides stay orthogonal


# --- 13 --------------------------------------------------------------------------------------------


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(brute.LOWER))


def ranked(items, docs, k=20):
    """(item, rank, doc, score) of documents with distinct ids."""
    bags = {d: Counter(terms(t)) for d, t in docs if terms(t)}
    n = {d: sum(b.values()) for d, b in bags.items()}
    total, length = len(bags), sum(n.values())
    df = Counter(t for b in bags.values() for t in b)
    out = []
    for item, text in items:
        score = Counter()
        for t in terms(text):
            if t in df:
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                for d, b in bags.items():
                    if b[t]:
                        score[d] += w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * (75 + (25 * n[d] * total) // length)))
        best = sorted(((-s, d) for d, s in score.items() if s > 0), key=lambda x: (x[0], -math.inf if x[1] is None else x[1]))[:k]
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(best)]
    return out


def test_op13_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = sorted(tuple(r) for r in QUERIES["op13_geometric_blocks"](spark, sf_dir).select("item_id", "rank", "doc_id", "score").collect())
    assert got == sorted(con.execute(ORACLE_SQL["op13_geometric_blocks"]).fetchall()) and len(got) == 800


@pytest.mark.parametrize("shard_rows, lane", [(10_000, 10_000), (60, 7), (1, 10_000)])
def test_op13_brute(spark, shard_rows, lane):
    rng = random.Random(shard_rows)
    words = [f"w{i}" for i in range(60)]
    pick = lambda: words[min(59, int(rng.expovariate(0.08)))]
    docs = [(i, " ".join(pick() for _ in range(rng.randrange(0, 40)))) for i in range(60 if shard_rows == 1 else 400)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # ties
    items = [(i, " ".join(pick() for _ in range(rng.randrange(0, 15)))) for i in range(25)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = geometric_blocks.search(frame(items, "item_id"), frame(docs, "doc_id"), 20, shard_rows, lane, first=3).collect()
    assert sorted(tuple(r) for r in got) == sorted(ranked(items, docs))


def test_op13_blocks_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(4)
    topics = [[f"t{t}w{i}" for i in range(30)] for t in range(12)]
    texts = [" ".join(["common", *rng.choice(topics[i % 12], 12)]) for i in range(1200)]
    bags = [Counter(t.split()) for t in texts]
    counts = np.array([c for b in bags for c in b.values()], np.int32)
    shard = geometric_blocks.Shard(np.arange(1200), np.arange(1200), np.full(1200, 13), pa.array([" ".join(b) for b in bags]), counts, (1200, 15_600))
    listed, begins, term, high, first = shard.blocks(shard.words.to_pylist().index("common"))
    assert sorted(listed.tolist()) == list(range(1200)) and len(first) > 8
    for b in range(len(first)):  # summaries are the largest impacts of just the block's documents
        want = Counter()
        for d in listed[begins[b] : (*begins, 1200)[b + 1]]:
            for w, x in zip(shard.code[shard.first[d] : shard.first[d + 1]], shard.impact[shard.first[d] : shard.first[d + 1]]):
                want[int(w)] = max(want[int(w)], int(x))
        span = slice(first[b], (*first, len(term))[b + 1])
        assert dict(zip(term[span].tolist(), high[span].tolist())) == dict(want)
    asked = pa.array(["common", *topics[5][:6]])
    weights = np.array([9000, *[700] * 6])
    docs, scores = shard.search(asked, weights, 10)
    shard.weight[:] = 0
    shard.weight[np.array([shard.words.to_pylist().index(w) for w in asked.to_pylist()])] = weights
    every = shard.score(np.arange(1200))
    best = np.lexsort((np.arange(1200), -every))[:10]
    assert docs.tolist() == best.tolist() and scores.tolist() == every[best].tolist()
    assert shard.skipped > 0 and shard.scored < 1200


def test_op13_edges(spark):
    docs = [(None, "b c"), (1, None), (2, ""), (3, " .,- "), (4, "A b b"), (5, "Ünï É é x"), (6, "z " * 20_000)]
    items = [(None, "b"), (1, None), (2, "..."), (3, "a B b unseen"), (4, "É"), (4, "z")]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").withColumn("row", F.lit("x")).withColumn("score", F.lit(1)).withColumn("terms", F.lit(None).cast("string"))
    got = [tuple(r) for r in geometric_blocks.search(frame(items, "item_id"), frame(docs, "doc_id")).collect()]
    assert sorted(got, key=str) == sorted(ranked(items, docs), key=str)
    assert {(i, d) for i, _, d, _ in got} == {(None, None), (None, 4), (3, None), (3, 4), (4, 5), (4, 6)}
    twice = geometric_blocks.search(frame([(1, "b"), (1, "b")], "item_id"), frame([(4, "a b"), (4, "a b"), (5, "c")], "doc_id")).collect()
    assert sorted((r.rank, r.doc_id) for r in twice) == [(1, 4), (1, 4), (2, 4), (2, 4)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert geometric_blocks.search(frame(items, "item_id"), none).count() == 0
    assert geometric_blocks.search(none.withColumnRenamed("doc_id", "item_id"), frame(docs, "doc_id")).count() == 0
