"""Operator 2 against a plain scorer: features word by word, and every pair of features."""

import math
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import brute

from marisight.llm import quality_fm
from marisight.llm.queries import QUERIES

M = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ x >> 31


BYTE = [mixed(i * 0xA0761D6478BD642F & M) for i in range(1, 257)]


def word_bin(word):
    total, power = 0, 1
    for b in word.encode():
        total, power = (total + BYTE[b] * power) & M, power * 0x9E3779B97F4A7C15 & M
    return mixed((total + len(word.encode())) & M) >> 48


def share_level(x):
    return 0 if x <= 0 else min(max(15 + math.ceil(math.log2(max(x, 1e-9))), 1), 15)


def log_level(x, step=1.0):
    return min(int(math.log2(x + 1) / step), 15)


def plain_features(text):
    """feature -> value of one text."""
    raw, words = (text or "").encode(), brute.words(text)
    n, bins = max(len(raw), 1), Counter(word_bin(w) for w in words)
    some, lines = max(len(words), 1), raw.count(b"\n") + 1
    counts = [sum(65 <= b <= 90 for b in raw), sum(48 <= b <= 57 for b in raw), sum(33 <= b < 127 and not chr(b).isalnum() for b in raw), *[raw.count(b) for b in b"!*#$%&|.,"]]
    levels = [share_level(c / n) for c in counts]
    levels += [log_level(len(raw) / some, 0.25), share_level(len(bins) / some), log_level(len(words) / lines, 0.75), log_level(sum(c * c for c in bins.values()) / some, 0.75), log_level(len(raw)), share_level(sum(b >= 128 for b in raw) / n)]
    norm = math.sqrt(sum((1 + math.log(c)) ** 2 for c in bins.values()))
    out = {b: (1 + math.log(c)) / norm for b, c in bins.items()}
    return out | {quality_fm.WORD_BINS + i * quality_fm.STAT_BINS + level: 1 / math.sqrt(len(levels)) for i, level in enumerate(levels)}


def plain_score(model, text):
    found = plain_features(text)
    at, x = np.array(sorted(found)), np.array([found[k] for k in sorted(found)], dtype=np.float32).astype(float)
    vx = model.factors[at].astype(float) * x[:, None]
    logit = model.bias + float(model.linear[at].astype(float) @ x)
    for i in range(len(at) - 1):  # every pair once
        logit += float((vx[i + 1 :] @ vx[i]).sum())
    return 1 / (1 + math.exp(-min(max(logit, -35), 35)))


def test_op2_equals_plain_scorer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r.doc_id: r for r in QUERIES["op2_quality_fm"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts)
    for d, text in texts.items():
        want = plain_score(model, text)
        assert abs(got[d].score - want) < 1e-4, d
        if abs(want - 0.3) > 1e-4:
            assert got[d].predicted == int(want >= 0.3)
        assert got[d].held_out == (brute.crc(d) % 5 == 0)
