"""The pipeline, stage by stage, against plain versions of what each stage decides."""

import hashlib
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute

import corpus_pipeline
from marisight.llm import sentencepiece_codec, source_mixing
from marisight.llm._shared import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), name)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["input"].columns


def test_quality(spark, stages):
    kept = rows(stages["quality"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1]
    assert sum(d in kept for d in clean) >= 0.99 * len(clean)
    assert len(kept) < stages["input"].count()


def test_near_duplicates(stages):
    before = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    classes = brute.classes(before, percent=80, k=5)
    assert set(rows(stages["near_duplicates"])) == {d for d, (_, c) in classes.items() if d == c}


def test_repeated_passages(stages):
    before = [(r.doc_id, r.text) for r in stages["near_duplicates"].collect()]
    after = rows(stages["repeated_passages"])
    for doc, (n, gone, digest) in brute.repeats(before).items():
        text = after[doc].text
        assert hashlib.sha256(" ".join(brute.words(text)).encode()).hexdigest() == digest
        assert len(brute.words(text)) == n - gone and after[doc].n_chars == len(text)


def test_mixing(stages):
    sizes = Counter()
    for r in stages["repeated_passages"].collect():
        sizes[r.source] += len(brute.words(r.text))
    taken, times = Counter(), Counter()
    for r in stages["mixing"].collect():
        taken[r.source] += len(brute.words(r.text))
        times[r.doc_id] += 1
    want = brute.mix_targets({s: sizes[s] for s in sorted(sizes)})
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes) and max(times.values()) <= 4


def test_mixing_takes_the_drawn_blocks(spark):
    """Each drawn block's words arrive as often as the slots say, whatever ids are null or repeat."""
    sizes = {"a": 1000, "b": 333, "c": 77}
    ids = {"a": [None, 7, 7, 7, 1, 2], "b": [None, 7, 3], "c": [4]}
    rows = [(d, " ".join(f"{s}{i}_{j}" for j in range(sizes[s] - i)), 0, s) for s in ids for i, d in enumerate(ids[s])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, source string")
    met, _, _ = source_mixing._drawn(docs.withColumn("row", F.monotonically_increasing_id()), "text", "source", source_mixing.WEIGHTS, source_mixing.MOST, source_mixing.BLOCK, source_mixing.SHARD_SLOTS, source_mixing.SEED)
    texts, want = {r.row: brute.words(r.text) for r in docs.withColumn("row", F.monotonically_increasing_id()).collect()}, Counter()
    for r in met.where("times is not null").collect():
        at = r.block * source_mixing.BLOCK + r["from"] - r.start
        for n, words in ((r.times, r.to - r["from"]), (1, min(r.to, r.cut or 0) - r["from"])):
            for w in texts[r.row][at : at + max(words, 0)]:
                want[w] += n
    got = corpus_pipeline.mixing(spark, docs, SF).collect()
    assert Counter(w for r in got for w in brute.words(r.text)) == want
    assert all(r.n_chars == len(r.text) for r in got)
    tail = {w for t in texts.values() for w in t[len(t) // 2 :]}
    taken = Counter(w[0] for w in want if w in tail)
    assert all(taken[s] > 0.3 * sum(w[0] == s for w in tail) for s in "ab")  # tails take part, also where half is taken
    assert {r.doc_id for r in got} >= {None, 7}


def test_encoding(stages):
    library = sentencepiece_codec.PieceModel(sentencepiece_codec.default_model_path()).library
    want = Counter((r.doc_id, len(library.encode(r.text))) for r in stages["mixing"].collect())
    assert want == Counter((r.doc_id, r.n_tokens) for r in stages["encoding"].collect())


def test_edges(spark):
    """Null, empty and repeated rows and columns of any name go through every stage but the last."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words, "en", "a", 1), (None, None, None, None, None), (1, "", "en", "a", 0), (2, words, "en", None, 1), (2, words, "en", None, 1), (3, "x " * 5000, "en", "b", 1), (4, "one two", "en", "b", 7)]
    docs = spark.createDataFrame(rows, schema)
    clashing = ("score", "predicted", "n_words", "n_removed", "kept_text", "factors", "row", "size", "taken", "bucket", "start", "turn", "_first", "block", "component_id")
    for i, name in enumerate(clashing):
        docs = docs.withColumn(name, F.lit(float(i)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        kept = after.collect()
        assert all(r[c] == float(i) for r in kept for i, c in enumerate(clashing)), name
        none = stage(spark, docs.where("false"), SF)
        assert none.columns == docs.columns and none.count() == 0
        if name == "near_duplicates":  # the null id comes first; rows without words are no copies
            assert Counter(r.doc_id for r in kept) == {None: 2, 1: 1, 3: 1, 4: 1}
        if name == "repeated_passages":
            texts = {r.doc_id: r.text for r in kept if r.text != words}
            assert texts[1] == "" and texts[2] == "" and texts[3] == "x" and texts[4] == "one two"
        if name == "mixing":
            sizes = Counter()
            for r in kept:
                sizes[r.source] += len(brute.words(r.text))
            want = brute.mix_targets({"a": 60, "b": 5002, None: 120})
            assert all(abs(sizes[s] - want[s]) <= 1 for s in want)
    last = corpus_pipeline.encoding(spark, docs, SF).collect()
    assert len(last) == len(rows) and all(r.n_tokens == 0 for r in last if r.doc_id == 1)


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["encoding"].count()
