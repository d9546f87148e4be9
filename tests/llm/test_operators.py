"""Each operator against brute force, an exact round trip, SQL or held-out accuracy, and its edge cases."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute

from marisight.llm import extendible_sharding, jaccard_join, maxscore, media_columns, page_differencing, ppm_scoring, quality_fm, sentencepiece_codec, source_mixing, substring_dedup
from marisight.llm._permute import permute
from marisight.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string"
EDGES = [(None, "a " * 30), (1, None), (2, ""), (3, " \n\t "), (4, "b c " * 15), (4, "b c " * 15), (5, "x"), (6, "y " * 20_000)]


def docs_of(spark, rows, schema=DOCS):
    """rows with extra columns whose names clash with what operators make."""
    df = spark.createDataFrame(rows, schema)
    for name in ("score", "kept_text", "piece_ids", "size", "label", "word", "n"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]


# --- 1 ---------------------------------------------------------------------------------------------


def test_op1_brute(spark, sf_dir):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op1_substring_dedup"](spark, sf_dir).collect()}
    assert got == brute.repeats(texts_of(spark, sf_dir))


def test_op1_passages_at_boundaries(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    pieces = [[word() for _ in range(rng.randrange(15, 45))] for _ in range(12)]
    rows = [(i, " ".join(w for _ in range(6) for w in (rng.choice(pieces) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(1, 12))]))) for i in range(80)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out}
    assert got == brute.repeats(rows)
    texts = {d: brute.words(t) for d, t in rows}
    for r in out:  # every factor is a copy of an earlier place
        for f in r.factors:
            assert texts[r.doc_id][f.start : f.start + f.words] == texts[f.ref_doc][f.ref_start : f.ref_start + f.words]
            assert (f.ref_doc, f.ref_start) < (r.doc_id, f.start)


def test_op1_edges(spark):
    out = substring_dedup.remove_repeats(docs_of(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    by = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out}
    assert by[None] == (30, 29, "a") and by[1] == by[2] == by[3] == (0, 0, "") and by[4] == (30, 28, "b c") and by[5] == (1, 0, "x")
    assert by[6][:2] == (20_000, 19_999)
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


# --- 2 ---------------------------------------------------------------------------------------------


def test_op2_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op2_quality_fm"](spark, sf).collect()}
    labels = [(got[r.doc_id], r.quality) for r in table(spark, sf, "labels").collect() if brute.crc(r.doc_id) % 5 == 0]
    assert all(r.held_out for r, _ in labels) and all(0 <= r.score <= 1 for r in got.values())
    good, bad = [r.score for r, y in labels if y == 1], [r.score for r, y in labels if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc >= 0.95
    assert np.mean([r.predicted for r, y in labels if y == 1]) >= 0.98


def test_op2_pairwise_identity():
    rng = np.random.default_rng(0)
    model = quality_fm.Model(0.1, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 3)))
    f, x = np.array([3, 9, 12]), np.array([0.5, 2.0, 1.0])
    plain = model.bias + model.linear[f] @ x + sum(model.factors[f[i]] @ model.factors[f[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert model.sums(np.zeros(3, int), f, x, 1)[0][0] == pytest.approx(plain)


def test_op2_edges(spark):
    model = quality_fm.train(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int"))
    out = quality_fm.score(docs_of(spark, EDGES), model).collect()
    assert len(out) == len(EDGES) and {r.score for r in out} == {0.5}
    assert quality_fm.score(spark.createDataFrame([], DOCS), model).count() == 0


# --- 3 ---------------------------------------------------------------------------------------------


def test_op3_brute(spark, sf_dir):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_jaccard_join"](spark, sf_dir).collect()}
    assert got == brute.classes(texts_of(spark, sf_dir))


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    return rows


def test_op3_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION", 32)
    rows = near_copies(150, 3) + [(900, "A b"), (901, "a  B"), (902, "a b c d")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute.classes(rows)


def test_op3_order_is_bounded(spark, monkeypatch):
    """However few shingles count as frequent, components are the same."""
    monkeypatch.setattr(jaccard_join, "MIN_FREQUENT", 3)
    rows = near_copies(60, 9)
    for most in (0, 5, 1 << 20):
        monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", most)
        base = spark.createDataFrame(rows, DOCS).select(F.col("text").alias("__text"))
        assert len(jaccard_join.frequent_shingles(base, 4, len(rows))) <= most
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
        assert got == brute.classes(rows)


def test_op3_chain_in_rounds(spark, monkeypatch):
    """A chain of copies of copies, where links run beyond a pivot's radius, and two groups that touch."""
    monkeypatch.setattr(jaccard_join, "REGION", 24)
    rng, word = random.Random(8), iter(range(10**6))
    now, rows = [f"v{next(word)}" for _ in range(120)], []
    for i in range(160):
        rows.append((i, " ".join(now)))
        at = rng.randrange(len(now))
        now = [*now]
        if i % 3 == 0:
            now[at] = f"v{next(word)}"
        if i == 80:
            now = [f"u{next(word)}" for _ in range(120)]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute.classes(rows)


def test_op3_forest_is_exact():
    rng = np.random.default_rng(1)
    base = rng.integers(1, 1 << 60, 400, dtype=np.uint64)
    sets = []
    for _ in range(60):
        s = base.copy()
        s[rng.integers(0, 400, rng.integers(0, 40))] = rng.integers(1, 1 << 60, 1, dtype=np.uint64)[0]
        sets.append(np.unique(s))
    n = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(60), n)
    sketch = jaccard_join._sketches(np.concatenate(sets), row, 60).view(np.uint64)
    links = jaccard_join._forest(sketch, n, 85, sets)
    up = list(range(60))
    root = lambda x: x if up[x] == x else root(up[x])
    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = [root(i) for i in range(60)]
    up = list(range(60))
    for a in range(60):
        for b in range(a):
            inter = len(np.intersect1d(sets[a], sets[b]))
            if 100 * inter >= 85 * (n[a] + n[b] - inter):
                up[max(root(a), root(b))] = min(root(a), root(b))
    assert got == [root(i) for i in range(60)]


def test_op3_edges(spark):
    out = jaccard_join.near_duplicates(docs_of(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[5] == (1, 5) and by[4] == (2, 4)
    assert jaccard_join.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


# --- 4, 5 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()))


def test_op4_limits_and_repeats(spark, tmp_path):
    rows = [(1, "x" * 100)] * 50 + [(2, "y" * 400), (None, None), (3, "")] + [(i, "z" * (i % 90)) for i in range(10, 200)]
    out = extendible_sharding.shards(docs_of(spark, rows), limit=300).collect()
    assert len(out) == len(rows)
    size, count = Counter(), Counter()
    for r in out:
        size[r.shard, r.part] += r.n_bytes
        count[r.shard, r.part] += 1
    assert all(size[k] <= 300 or count[k] == 1 for k in size)
    assert extendible_sharding.shards(spark.createDataFrame([], DOCS)).count() == 0
    small = spark.createDataFrame([(i, "t" * i) for i in range(20)], DOCS)
    assert extendible_sharding.write_shards(small, str(tmp_path / "out"), 50).count() == 20


def test_op4_lanes_grow_with_the_rows_of_one_hash(spark, monkeypatch):
    monkeypatch.setattr(extendible_sharding, "LANE_ROWS", 10)
    rows = [(None, "x" * 60)] * 200 + [(5, "y" * 10)] * 40 + [(i, "z" * 20) for i in range(100, 140)]
    out = extendible_sharding.shards(docs_of(spark, rows), limit=300).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    size = Counter()
    for r in out:
        size[r.shard, r.part] += r.n_bytes
    assert max(size.values()) <= 300
    hot = [r for r in out if r.doc_id is None]
    assert len({r.shard for r in hot}) == 1 and {len(r.shard) for r in hot} == {128} and len({r.part >> 40 for r in hot}) >= 15


def test_op4_writes_each_row_once(spark, tmp_path):
    rows = [(None, "n" * 30), (None, "m" * 30), *[(7, f"{i:02}" * 10) for i in range(12)], (8, "x"), (9, None)]
    frame = spark.createDataFrame(rows, DOCS)
    back = extendible_sharding.write_shards(frame, str(tmp_path / "out"), 50)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)


def test_op5_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, -0.5]), (1, [1.0, -0.5]), (1, [1.0, -0.5]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [0.25, 0.0]), (None, [1.0, 1.0]), (20, [float("inf"), 0.0]), (40, [-1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = frame.where(F.col("vec_id").isNotNull() & maxscore.usable(F.col("embedding"))).select("vec_id", maxscore.quantised(F.col("embedding")).alias("vector"))
    out = maxscore.search(good.where("vec_id % 20 = 0"), good, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out] == [(0, 1, 1, 5120), (0, 2, 1, 5120), (0, 3, 5, 1024), (40, 1, 5, -1024), (40, 2, 0, -4288), (40, 3, 1, -4288)]
    empty = good.where("false")
    assert maxscore.search(empty, empty).count() == 0


def test_op5_postings():
    """Sparse, dense, tied and empty shards against full products; sparse ones touch few postings."""
    rng = np.random.default_rng(0)
    sparse = np.where(rng.random((2000, 30)) < 0.1, rng.integers(-5, 50, (2000, 30)), 0)
    for rows, most in ((sparse, 0.5), (rng.integers(-60, 60, (500, 64)), 1.0), (rng.integers(0, 2, (200, 3)), 1.0), (np.zeros((50, 4), int), 0.0), (rng.integers(-3, 3, (15, 4)), 1.0), (rng.integers(-(10**6), 10**6, (300, 40)), 1.0), (rng.integers(-(10**8), 10**8, (90, 4)), 1.0)):
        ids = rng.permutation(len(rows)) // 2
        shard = maxscore.Shard(rows, ids)
        found, touched = shard.search(rows[::7], ids[::7], 20)
        for i, (at, score) in zip(range(0, len(rows), 7), found, strict=True):
            full, others = shard.rows @ rows[i], np.flatnonzero(shard.ids != ids[i])
            want = others[np.lexsort((others, -full[others]))][:20]
            assert at.tolist() == want.tolist() and score.tolist() == full[want].tolist()
        assert touched <= most * len(range(0, len(rows), 7)) * rows.size * 1.05


def test_op5_lengths_and_lanes(spark):
    """Vectors meet those of their own length only, in whatever order they come."""
    rows = [(i, [i % 5 - 2] * (2 + (i % 7 == 3))) for i in range(60)]
    want = {}
    for q, v in rows[::20]:
        same = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))[:3]
        want[q] = [(i, -s) for s, i in same]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "vec_id long, vector array<long>")
        out = maxscore.search(frame.where("vec_id % 20 = 0"), frame, k=3, shard_rows=16, query_lane=1).orderBy("query_id", "rank").collect()
        got = {}
        for r in out:
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == want


# --- 6 ---------------------------------------------------------------------------------------------


def test_op6_articles(spark, sf_dir):
    import html
    import re

    got = {r.page_id: r for r in QUERIES["op6_page_differencing"](spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))).split())
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_op6_differencing_and_edges(spark):
    page = lambda own: f"<div>Menu here</div><div>{own}</div><p>Copy 2024"
    rows = [(1, "http://h/a/1", page("Own text one")), (2, "http://h/a/2", page("Own text two")), (3, None, None), (4, None, ""), (None, "http://i/b", "<p>x &amp; y<br>z<b>b</b>c  d<script>1<2</script><!-- n --><form>f</form><div class='user-comments'>c</div>"), (2, "http://h/a/2", page("Own text two"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("rk", F.lit(1)).withColumn("lines", F.lit(1)).withColumn("page", F.lit(1))
    out = page_differencing.extract(frame).collect()
    assert len(out) == len(rows)
    assert {r.page_id: r.text for r in out} == {1: "Own text one", 2: "Own text two", 3: "", 4: "", None: "x & y zbc d"}
    assert page_differencing.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_op6_marks_of_pages():
    """Implied ends, names of elements and attributes, self-closed elements."""

    def main_text(page, beside=None):
        texts, places = page_differencing.blocks(page)
        shared = page_differencing.shared_lines([hash(t) for t in texts], [hash(t) for t in page_differencing.blocks(beside)[0]]) if beside else [False] * len(texts)
        return [t for t, k in zip(texts, page_differencing.kept_lines(texts, places, shared)) if k]

    assert main_text('<article><h1>T</h1><p class="share">Share<p>Body one.<p>Body two.</article>') == ["T", "Body one.", "Body two."]
    assert main_text('<article><div class="article-header">H</div><section id="cookie-recipes">C</section><div data-id="form">F</div><h2 id="search">S</h2></article>') == ["H", "C", "F", "S"]
    assert main_text('<ul class=menu><li>a<li>b</ul><p>x<svg/>y<iframe/>z<div class="user-comments">c</div><div class=ad-slot>q</div><section id=cookie-recipes>r</section>') == ["xyz", "r"]
    assert main_text("<table><tr><td>1<td class=ad>2<td>3<tr><td>4</table>") == ["1", "3", "4"]
    assert main_text("<li class=menu><ul><li>x</li></ul>y</li>z") == ["z"]
    # an article is the main text, whatever stands beside or around it
    aside = "<article>short</article><div>{0} is a longer text in a box without a mark</div><div>another box</div>"
    assert main_text(aside.format("one"), aside.format("two")) == ["short"]
    for around in ('<form id="f">{}</form>', '<div class="page-with-sidebar">{}</div>', '<section class="search">{}</section>', "<aside><form><nav>{}</nav></form></aside>", '<div class="sidebar"><div class="post">{}</div></div>'):
        assert main_text(around.format("<p>Menu</p><article><p>Body</p><div class=share>s</div></article>")) == ["Body"]
        assert main_text(around.format("<main><p>Body</p></main><aside>x</aside>")) == ["Body"]
    assert main_text("<aside><article>teaser</article></aside><main>text<aside><article>related</article></aside></main>") == ["text"]
    # forms: a page inside one, and a form for input
    long = "word " * 20
    assert main_text(f"<form><div>Head</div><p>{long}</p><nav>n</nav></form>") == ["Head", long.strip()]
    assert main_text(f"<p>{long}</p><form><p>Your name</p><label>Mail</label><select><option>a</select></form>") == [long.strip()]
    assert main_text("<form><h1>Title</h1><div>little</div></form>") == ["Title", "little"]
    assert main_text('<div class="post-header"><h1>My title</h1></div><div class="site-header">S</div><p>x') == ["My title", "x"]


def test_op6_many_equal_lines_and_unclosed_elements():
    import time

    began = time.perf_counter()
    a, b = [1] * 20_000 + [2, 3] * 50, [4] + [1] * 19_000 + [5] + [1] * 500 + [3, 2] * 50 + [6]
    shared = page_differencing.shared_lines(a, b)
    assert sum(shared[:20_000]) == 19_500 and sum(shared[20_000:]) == 99
    texts, places = page_differencing.blocks("<div>" * 12_000 + "</span></section>" * 12_000 + "x" + "<li>y" * 3000)
    assert len(texts) == 3001 and set(places) == {page_differencing._OPEN}
    assert time.perf_counter() - began < 20


def test_op6_alignment_in_parts(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(page_differencing, "_BITS", 40)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        marked = [x for x, here in zip(a, page_differencing.shared_lines(a, b)) if here]
        rest = iter(b)
        assert len(marked) == d[-1][-1] and all(x in rest for x in marked)


def test_op6_second_version_of_marks():
    """Random nested pages against places found by walking the tree of their elements."""
    rng = random.Random(11)
    kinds = ["div", "section", "article", "main", "aside", "form", "nav", "div class=share", "div class=sidebar", "div class=user-comments", "div class=page-with-sidebar", "p"]
    for _ in range(400):
        number = [0]

        def made(depth):
            if depth == 0 or rng.random() < 0.3:
                number[0] += 1
                return f"line {number[0]}" + " w" * rng.choice([0, 3, 25])
            kind = rng.choice(kinds)
            return (kind, [made(0)] if kind == "p" else [made(depth - 1) for _ in range(rng.randrange(1, 4))])

        tree = [made(4) for _ in range(rng.randrange(1, 4))]
        write = lambda n: f"<div>{n}</div>" if isinstance(n, str) else f"<{n[0]}>{''.join(map(write, n[1]))}</{n[0].split()[0]}>"
        texts, places = page_differencing.blocks("".join(map(write, tree)))
        got = [t for t, keep in zip(texts, page_differencing.kept_lines(texts, places, [False] * len(texts))) if keep]
        assert got == brute.main_lines(tree), tree


def test_op6_second_version(spark):
    """Pages without articles against a plain version on the standard library's parser, neighbours by brute force."""
    rng = random.Random(6)
    menus = [[f"item {i} {j}" for j in range(6)] for i in range(3)]
    rows = []
    for n in range(120):
        host, kind = f"h{n % 3}", n % 2
        own = [f"own {n} line {j} " + "w " * rng.randrange(30) for j in range(rng.randrange(1, 8))]
        body = "".join(f"<p>{t}" if rng.random() < 0.5 else f"<div data-id='ad'>{t}</div>" for t in own)
        lists = "".join(f"<li>{t}" for t in menus[n % 3])
        side = f"<div class='{rng.choice(['ad', 'ad-slot', 'user-comments', 'sidebar'])}'>noise {n}</div>" if rng.random() < 0.5 else ""
        rows.append((n, f"http://{host}/{'ab'[kind]}/{n:03}", f"<title>t</title><div id=top>{'Banner ' + host}</div><ul>{lists}</ul>{body}{side}<div>The end of {host}</div>"))
    got = {r.page_id: r.text for r in page_differencing.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == brute.main_texts(rows)


def test_op6_lcs():
    rng = random.Random(0)

    def length(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(10))] for _ in range(2))
        assert sum(page_differencing.shared_lines(a, b)) == length(a, b)


def test_op6_pairs_across_partitions(spark):
    rows = [(f"r{i:03}", "h" if i < 150 else f"g{i % 7}", f"/a/{i:03}") for i in range(200)]
    keys = spark.createDataFrame(rows, "rk string, host string, path string")
    got = {r.rk: r.partner for r in page_differencing.nearest_pages(keys).collect()}
    by_host = {}
    for rk, host, path in sorted(rows, key=lambda r: r[1:]):
        by_host.setdefault(host, []).append((path, rk))
    for held in by_host.values():
        for i, (path, rk) in enumerate(held):
            near = [held[j][1] for j in (i - 1, i + 1) if 0 <= j < len(held)]
            assert got[rk] in near if near else got[rk] is None


# --- 7 ---------------------------------------------------------------------------------------------


def test_op7_round_trip(spark, sf_dir):
    texts = dict(texts_of(spark, sf_dir))
    out = QUERIES["op7_media_columns"](spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.caption == f"{len(raw)} bytes" and r.position == 1
        stored = b"P5\n64 %d\n255\n" % (len(payload) // 64) + payload
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == brute.grey_feature(payload)


def test_op7_hot_digests(spark):
    """A payload that most references share is dealt over parts, and resolves like any other."""
    refs = spark.createDataFrame([(i, None if i % 50 == 0 else "hot" if i % 5 else f"d{i % 7}") for i in range(400)], "k int, digest string")
    media = spark.createDataFrame([("hot", 1), *[(f"d{i}", i + 2) for i in range(6)]], "digest string, value int")
    want = {r.k: None if r.digest is None else 1 if r.digest == "hot" else {f"d{i}": i + 2 for i in range(6)}.get(r.digest) for r in refs.collect()}
    assert {r.k: r.value for r in media_columns.resolve(refs, media, hot_least=20).collect()} == want


def test_op7_stored_media(spark):
    payloads = spark.createDataFrame([(b"a" * 64,), (b"a" * 64,), (b"b" * 128,)], "payload binary").coalesce(1)
    rows = media_columns.stored_media(payloads).collect()
    assert sorted((r.digest, bytes(media_columns.samples(bytes(r.stored)))) for r in rows) == sorted((hashlib.sha256(x).hexdigest(), x) for x in (b"a" * 64, b"b" * 128))


def test_op7_sequences(spark):
    page = '<p>One &amp;</p><figure><img alt="a" src="sha256:AB"><figcaption>Cap <b>x</b></figcaption></figure>two<img src="sha256:cd" alt="alt"><img src="http://x">'
    assert [(s["position"], s["kind"], s["text"] or s["digest"], s["caption"]) for s in media_columns.interleaved(page)] == [(0, "text", "One &", None), (1, "media", "ab", "Cap x"), (2, "text", "two", None), (3, "media", "cd", "alt")]
    frame = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string").withColumn("sequence", F.lit(1)).withColumn("digest", F.lit("q"))
    rows = media_columns.references(media_columns.sequences(frame.drop("digest")))
    media = spark.createDataFrame([("ab", 7)], "digest string, payload int")
    assert {(r.page_id, r.position): r.payload for r in media_columns.resolve(rows, media).collect()} == {(1, 1): 7, (1, 3): None}
    assert media_columns.sequences(frame.where("false")).count() == 0
    with pytest.raises(ValueError):
        media_columns.samples(b"P5\n64 2\n255\n" + bytes(64))


def test_op7_captions_scripts_and_clashing_names(spark):
    def read(page):
        return [(s["kind"], s["text"] or s["digest"], s["caption"]) for s in media_columns.interleaved(page)]

    open_ = '<figure><img src="sha256:a"><figcaption>Cap'
    assert read(open_ + "</figure>after") == [("media", "a", "Cap"), ("text", "after", None)]
    assert read(open_ + "<p>next</p>") == [("media", "a", "Cap"), ("text", "next", None)]
    assert read(open_ + " <b>bold</b> end") == [("media", "a", "Cap bold end")]
    assert read(open_ + "</figcaption></figure><figcaption>lost</figcaption>x") == [("media", "a", "Cap"), ("text", "x", None)]
    assert read("a<script>var x = '<img src=sha256:b>';</script>b<STYLE>p{}</STYLE>c<style>open") == [("text", "a b c", None)]
    refs = spark.createDataFrame([("k", "d", 1)], "key string, digest string, feature int")
    media = spark.createDataFrame([("d", "f", b"x")], "digest string, feature string, stored binary")
    row = media_columns.resolve(refs, media).first()
    assert (row.feature, row.media_feature, bytes(row.stored)) == (1, "f", b"x")


def test_op7_pages(spark, sf_dir):
    """The sequences of whole web pages have all their words, in order."""
    import re

    for r in media_columns.sequences(table(spark, sf_dir, "pages").select("page_id", "html")).collect():
        said = " ".join(s.text for s in r.sequence if s.kind == "text").split()
        bare = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1>", " ", r.html)
        assert said == __import__("html").unescape(re.sub(r"<[^>]*>", " ", bare)).split() and [s.position for s in r.sequence] == list(range(len(r.sequence)))


# --- 8 ---------------------------------------------------------------------------------------------


def test_op8_targets(spark, sf_dir):
    source = {r.doc_id: (r.source, len(brute.words(r.text))) for r in table(spark, sf_dir, "documents").collect()}
    sizes = Counter()
    for s, n in source.values():
        sizes[s] += n
    want = brute.mix_targets({s: sizes[s] for s in sorted(sizes)})
    first, again = (QUERIES["op8_source_mixing"](spark, sf_dir).collect() for _ in range(2))
    assert sorted(first) == sorted(again) and len(first) == len(source)
    taken = Counter()
    for r in first:
        s, n = source[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[s]) and r.target == pytest.approx(want[s]) and r.taken <= 3 * n
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_op8_shards_and_permutation(spark):
    for n in (1, 2, 3, 5, 64, 1000):
        p = permute(np.arange(n), n, 7)
        assert sorted(p) == list(range(n)) and (permute(p, n, 7, True) == np.arange(n)).all()
    rows = [(i, "w " * 100, "ab"[i % 2]) for i in range(60)]
    _, slots = source_mixing.mix_sources(spark.createDataFrame(rows, DOCS + ", source string"), block=10, shard_slots=50)
    places = [(r.shard, r.place) for r in slots.collect()]
    assert len(set(places)) == len(places) and max(Counter(s for s, _ in places).values()) == 50


def test_op8_draws(spark):
    """Counts per shard scatter like a multinomial draw, and sources have exactly their slots."""
    made = spark.createDataFrame([(0, 6000, 0), (1, 3000, 6000), (2, 1000, 9000), (3, 7, 10_000)], "number long, all long, ahead long")
    counts = source_mixing.shard_counts(made, 10_007, 100, 5).collect()
    per, shards = Counter(), Counter()
    for r in counts:
        per[r.number] += r["count"]
        shards[r.shard] += r["count"]
    assert per == {0: 6000, 1: 3000, 2: 1000, 3: 7}
    assert len(shards) == 101 and all(n == (100 if s < 100 else 7) for s, n in shards.items())
    for number, share in ((0, 0.6), (1, 0.3), (2, 0.1)):
        got = np.array([r["count"] for r in counts if r.number == number and r.shard < 100])
        assert 0.6 < got.std() / math.sqrt(100 * share * (1 - share)) < 1.4
    again = source_mixing.shard_counts(made, 10_007, 100, 5).collect()
    assert sorted(again) == sorted(counts)


def test_op8_mixture(spark):
    """Blocks of words in slots, against the blocks of each source's word stream."""
    rows = [(i, " ".join(f"{'abc'[i % 3]}{i}.{j}" for j in range(5 + 37 * (i % 11))), "abc"[i % 3]) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS + ", source string")
    out = source_mixing.mixture(docs, block=10, shard_slots=50).collect()
    assert len({(r.shard, r.place) for r in out}) == len(out)
    texts, taken = dict((d, t.split()) for d, t, _ in rows), Counter()
    first = {}
    for r in out:
        said = r.text.split()
        assert 0 < len(said) <= 10 and {w[0] for w in said} == {r.skey[1]}
        whole = first.setdefault((r.skey, r.block), said)
        assert said[: len(whole)] == whole[: len(said)]
        for w in said:
            taken[int(w[1:].split(".")[0])] += 1
        for x, y in zip(said, said[1:]):  # words of one document stand as in its text
            if x.split(".")[0] == y.split(".")[0]:
                assert int(y.split(".")[1]) == int(x.split(".")[1]) + 1
    got = {r.doc_id: r.taken for r in source_mixing.mix_sources(docs, block=10, shard_slots=50)[0].collect()}
    assert got == {d: taken[d] for d in texts}


def test_op8_edges(spark):
    rows = [(None, "a b c", None), (1, None, "x"), (1, "b c " * 15, "x"), (1, "b c " * 15, "x"), (2, "", "y"), (3, "b", "y")]
    out = source_mixing.mix_sources(docs_of(spark, rows, DOCS + ", source string"))[0].collect()
    assert len(out) == len(rows)
    total = Counter()
    for r in out:
        total[r.source_size] += r.taken
    assert total == {60: 52, 1: 3, 3: 9}
    assert source_mixing.mix_sources(spark.createDataFrame([], DOCS + ", source string"))[0].count() == 0


# --- 9 ---------------------------------------------------------------------------------------------


def test_op9_library(spark, sf_dir):
    library = sentencepiece_codec.PieceModel(sentencepiece_codec.default_model_path()).library
    for r in [x for x in QUERIES["op9_sentencepiece"](spark, sf_dir).collect()]:
        text = dict_of(spark, sf_dir)[r.doc_id] or ""
        ids = library.encode(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


_TEXTS = {}


def dict_of(spark, sf_dir):
    if not _TEXTS:
        _TEXTS.update(texts_of(spark, sf_dir))
    return _TEXTS


def test_op9_strange_texts():
    model = sentencepiece_codec.PieceModel(sentencepiece_codec.default_model_path())
    rng = random.Random(1)
    parts = [" ", "  ", "▁", "\n", "a", "the", "é", "ａ", "\x00", "word", "<s>", "<0x0A>", "<unk>", "\t", "   ", "中", "😀", "́", "z" * 60]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(9)))
        assert model.encode(text) == model.library.encode(text)
    model.check()
    for said, ids in (("word", (1, 2)), ("\nword", (3,)), ("a  b", (4,))):
        model.fresh.append((said, ids))
        with pytest.raises(AssertionError):
            model.check()
    for text in ("ab" * 40, "internationalisation" * 5):
        assert model.merge_short("▁" + text) == model.merge_long("▁" + text)


def test_op9_edges(spark):
    out = sentencepiece_codec.encode_and_decode(docs_of(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    assert {r.doc_id: r.decoded for r in out} == {d: t or "" for d, t in EDGES}
    again = sentencepiece_codec.encode_and_decode(docs_of(spark, EDGES)).select("text", sentencepiece_codec.decode(F.col("piece_ids")).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in again)
    assert sentencepiece_codec.encode_and_decode(spark.createDataFrame([], DOCS)).count() == 0


def test_op9_random_texts_equal_the_library():
    m = sentencepiece_codec.PieceModel(sentencepiece_codec.default_model_path())
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "word", " ", " ", "\n", "é", "語", "▁", "  ", "\t", "x\n"]) for _ in range(rng.randrange(14))) for _ in range(3000)]
    texts += [None, "", " ", "\n", "\n\n", "a", " a", "a ", "a\n b", "a \nb", "a b\nc d\n\ne", "\na", "a\n"]
    for lo in range(0, len(texts), 500):
        got = [m.encode(t or "") for t in texts[lo : lo + 500]]
        m.check()
        assert got == [m.library.encode(t or "") for t in texts[lo : lo + 500]]


def test_op9_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MEMO_ENTRIES", 100)
    m = sentencepiece_codec.PieceModel(sentencepiece_codec.default_model_path())
    text = "\n".join(f"line{i} word{i}" for i in range(2000))
    assert m.encode(text) == m.library.encode(text) and len(m.memo) <= 100
    m.check()


# --- 10 --------------------------------------------------------------------------------------------


def test_op10_brute(spark, sf_dir):
    rows = [(d, brute.words((t or "").translate(brute.LOWER))) for d, t in texts_of(spark, sf_dir)]
    train = [w for d, w in rows if brute.crc(d) % 7 != 2]
    counts = Counter(x for w in train for x in w)
    counts["\n"] = len(train)
    n, v = sum(counts.values()), len(counts)
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in ppm_scoring.language_scores(docs, ~ppm_scoring.held_out(F.col("doc_id")), order=3, common_words=300).collect()}
    for d, w in rows:
        r, tokens = got[d], [*w, "\n"]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(tokens), n, sum(counts[t] > 0 for t in tokens))
        assert r.base_score == pytest.approx(base, rel=1e-9)
    some = rows[:25]
    want = brute.ppm([" ".join(w).encode() for w in train], [" ".join(w).encode() for _, w in some], 3)
    assert [got[d].score for d, _ in some] == pytest.approx(want, rel=1e-9)


def test_op10_rare_strings_count(spark):
    """Scores don't depend on how many strings travel to the tasks: strings beyond them are joined."""
    rng = random.Random(10)
    rows = [(i, " ".join("".join(rng.choice("abcd\u00e9") for _ in range(rng.randrange(1, 7))) for _ in range(40))) for i in range(40)]
    rows += [(40, "zz \U0001f600 unseen"), (41, None)]
    train = [(d, t) for d, t in rows if d < 30]
    want = brute.ppm([" ".join(brute.words(t)).encode() for _, t in train], [" ".join(brute.words(t)).encode() for _, t in rows], 5)
    for most in (0, 20, 4_000_000):
        out = ppm_scoring.language_scores(spark.createDataFrame(rows, DOCS), F.col("doc_id") < 30, max_leaves=most).orderBy("doc_id").collect()
        assert [r.score for r in out] == pytest.approx(want, rel=1e-9)


def test_op10_edges(spark):
    out = ppm_scoring.language_scores(docs_of(spark, EDGES), F.col("doc_id") < 3, order=2).collect()
    assert len(out) == len(EDGES) and all(r.score < 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert ppm_scoring.language_scores(spark.createDataFrame([], DOCS), F.lit(True)).count() == 0
    assert ppm_scoring.language_scores(spark.createDataFrame([(1, "a")], DOCS), F.lit(False)).first().train_tokens == 0
