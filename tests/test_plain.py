"""Queries that SQL can't express, row by row against plain versions."""

import datetime
import html
import re
from collections import defaultdict

from pyspark.sql import functions as F

from marisight.operators import retrieval
from marisight.plans import retrieval_queries, table_queries


def effective(r):
    return r["similarity"] if r["similarity"] > 0 else 0.5 if r["fts_rank"] > 0 else 0.0


def words_of(text):
    return {w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w}


def by_query(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["query_id"]].append(r)
    return {q: sorted(v, key=lambda r: r["rank"]) for q, v in out.items()}


def folded(pool, same):
    """Two nested loops over a list whose losers become None."""
    rows, out = list(pool), []
    for i, a in enumerate(rows):
        if a is None:
            continue
        lost = False
        for j in range(i + 1, len(rows)):
            b = rows[j]
            if b is None or not same(a, b):
                continue
            if effective(b) > effective(a):
                lost = True
                break
            rows[j] = None
        if not lost:
            out.append(a)
    return out


def alike(a, b):
    x, y = words_of(a["chunk_text"]), words_of(b["chunk_text"])
    return bool(x | y) and len(x & y) / len(x | y) > 0.70


def near(a, b):
    return a["id"] is not None and a["id"] == b["id"] and None not in (a["chunk_index"], b["chunk_index"]) and abs(a["chunk_index"] - b["chunk_index"]) <= 1


def without_copies(pool):
    return folded(folded(pool, near), alike)


def test_deduplicated(spark, sf_dir):
    pools = by_query([r.asDict() for r in retrieval_queries._pool(spark, sf_dir, 20).collect()])
    want = {(q, r["rank"], r["id"]) for q, pool in pools.items() for r in without_copies(pool)}
    got = [tuple(r) for r in retrieval_queries.deduplicated(spark, sf_dir).select("query_id", "rank", "id").collect()]
    assert len(got) == len(want) and set(got) == want


def test_deduplicated_on_every_kind_of_conflict(spark):
    import random

    rng, rows = random.Random(3), []
    for q in range(60):
        for rank in range(1, rng.randrange(2, 9)):
            said = " ".join(rng.sample("abcdefghij", 9 if rng.random() < 0.7 else 3)) if rng.random() < 0.9 else None
            rows.append((q, rank, rng.choice([None, 1, 2]), rng.choice([None, 1, 2, 3]), said, rng.choice([0.0, 0.3, 0.6, 0.9]), rng.choice([0.0, 0.2])))
    schema = "query_id long, rank int, id long, chunk_index int, chunk_text string, similarity double, fts_rank double"
    frame = spark.createDataFrame(rows, schema)
    want = {(q, r["rank"]) for q, pool in by_query([r.asDict() for r in frame.collect()]).items() for r in without_copies(pool)}
    got = retrieval.deduplicated(frame)
    assert got.columns == frame.columns
    assert {(r["query_id"], r["rank"]) for r in got.collect()} == want


def test_answer_context(spark, sf_dir):
    pools = by_query([r.asDict() for r in retrieval_queries._pool(spark, sf_dir, 20).collect()])
    asked = {r.query_id: words_of(r.query_text) for r in retrieval_queries.questions(spark, sf_dir).collect()}
    as_of, want = datetime.date.fromisoformat(retrieval_queries.AS_OF), {}
    for q, pool in pools.items():
        if max(r["similarity"] for r in pool) <= 0:
            pool = [r for r in pool if r["fts_rank"] >= 0.1]
        rows = without_copies(pool)
        share = [10.0 * len(asked[q] & words_of(r["chunk_text"])) / max(len(asked[q]), 1) for r in rows]
        rows = [rows[i] for i in sorted(range(len(rows)), key=lambda i: (-share[i], i))][:5]
        boosted = []
        for r in rows:
            years = (as_of - r["published_at"]).days / 365.25 if r["published_at"] else None
            base = r["rrf_score"] if r["rrf_score"] > 0 else effective(r)
            boosted.append(base * (1 + 0.1 * max(0.0, 5 - years) if years is not None else 1.0))
        order = sorted(range(len(rows)), key=lambda i: (-round(boosted[i], 12), i))
        top = effective(rows[order[0]]) if order else 0
        kept = [i for n, i in enumerate(order) if n == 0 or effective(rows[i]) >= 0.6 * top][:5]
        want.update({(q, n + 1): (rows[i]["id"], round(boosted[i], 6)) for n, i in enumerate(kept)})
    got = {(r["query_id"], r["rank"]): (r["id"], r["boosted"]) for r in retrieval_queries.answer_context(spark, sf_dir).collect()}
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def packed(blocks, target=1400, most=3000):
    """Chunks of (text, type, heading) blocks: (text, is table, blocks, heading, parent)."""
    out, sections = [], []
    for b in blocks:
        if not sections or sections[-1][0][2] != b[2]:
            sections.append([])
        sections[-1].append(b)
    for section in sections:
        heading = section[0][2]
        said = [b[0].strip() for b in section]
        parent = "\n\n".join(t for t in said if t)[:3000] or None
        held = []

        def flush():
            if held:
                out.append(("\n\n".join(held), False, len(held), heading, parent))  # noqa: B023
                held.clear()  # noqa: B023

        for text, (_, kind, _) in zip(said, section):
            if not text:
                continue
            if kind == "table":
                flush()
                prefix = f"Table from section: {heading}\n\n" if heading else ""
                lines, parts = text.split("\n"), [text]
                head = lines[: 2 if len(lines) > 1 and lines[1].strip().startswith(("|--", "---")) else 1]
                if len(prefix) + len(text) > most and len(lines) > len(head):
                    parts, now = [], []
                    for row in lines[len(head) :]:
                        if now and len("\n".join(head + now + [row])) > most - len(prefix):
                            parts.append("\n".join(head + now))
                            now = []
                        now.append(row)
                    parts.append("\n".join(head + now))
                out += [(prefix + p, True, 1, heading, parent) for p in parts]
                continue
            for piece in (text[i : i + target] for i in range(0, len(text), target)):
                if held and len("\n\n".join([*held, piece])) > target:
                    flush()
                held.append(piece)
        flush()
    return out


def rows_of(frame, key):
    out = defaultdict(list)
    for r in frame.collect():
        out[r[key]].append((r["chunk_index"], r["chunk_text"], r["is_table"], r["block_count"], r["section_heading"], r["parent_text"]))
    return {k: sorted(v) for k, v in out.items()}


def test_document_chunks(spark, sf_dir):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        heading, blocks = None, []
        for line in (r.text or "").split("\n"):
            if len(line.split(" ")) <= 4:
                heading = line
            blocks.append((line, "table" if " | " in line else "paragraph", heading))
        made = packed(blocks)
        if made:
            want[r.doc_id] = [(i, *c) for i, c in enumerate(made)]
    assert rows_of(table_queries.document_chunks(spark, sf_dir), "doc_id") == want


def blocks_of(page):
    """(text, type, heading) of a page, by one pattern over its tags: text belongs to every element that is open."""
    page = re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<!doctype[^>]*>", "", page)
    kinds = {"p": "paragraph", "li": "list_item", "table": "table"}
    open_, nodes = [], []
    for tag, text in re.findall(r"(?s)(<[^>]+>)|([^<]+)", page[page.index("<body") :]):
        if tag:
            name = re.match(r"</?(\w+)", tag)[1].lower()
            if tag.startswith("</"):
                if name in [n for n, _ in open_]:
                    while open_.pop()[0] != name:
                        pass
            elif name not in ("br", "meta", "img", "hr"):
                node = [] if name in kinds or re.fullmatch("h[1-4]", name) else None
                if node is not None:
                    nodes.append((name, node))
                open_.append((name, node))
        elif text.strip():
            for _, node in open_:
                if node is not None:
                    node.append(html.unescape(text).strip())
    out, heading = [], None
    for name, parts in nodes:
        if parts and name in kinds:
            out.append((" ".join(parts), kinds[name], heading))
        elif parts:
            heading = " ".join(parts)
    return out


def test_page_blocks_and_chunks(spark, sf_dir):
    pages = {r.page_id: blocks_of(r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = defaultdict(list)
    for r in table_queries.page_blocks(spark, sf_dir).orderBy("block_idx").collect():
        got[r.page_id].append((r.text, r.block_type, r.section_heading))
    assert got == pages
    want = {k: [(i, *c) for i, c in enumerate(packed(v))] for k, v in pages.items()}
    assert rows_of(table_queries.page_chunks(spark, sf_dir), "page_id") == {k: v for k, v in want.items() if v}


def test_vector_pool_in_blocks(spark, monkeypatch):
    """Blocks of questions and shards of rows give what all pairs give, ties by id."""
    import random

    monkeypatch.setattr(retrieval, "VECTOR_QUERIES", 3)
    monkeypatch.setattr(retrieval, "VECTOR_ROWS", 7)
    rng = random.Random(1)
    vector = lambda: rng.choice([None, [], [float(rng.randrange(-2, 3)) for _ in range(rng.choice([2, 2, 3]))]])
    rows, asked = [(i, vector()) for i in range(40)], [(100 + i, vector()) for i in range(11)]
    index, queries = spark.createDataFrame(rows, "id long, embedding array<double>"), spark.createDataFrame(asked, "query_id long, embedding array<double>")

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        scale = (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
        return dot / scale if scale else 0.0

    got = {(r.query_id, r.vrank): (r.id, round(r.similarity, 7) + 0.0) for r in retrieval.vector_pool(index, queries, 4).collect()}
    want = {}
    for q, v in asked:
        if v:
            best = sorted(((-round(cosine(v, w), 12), i) for i, w in rows if w))[:4]
            want.update({(q, n + 1): (i, round(-s, 7) + 0.0) for n, (s, i) in enumerate(best)})
    assert got == want
    assert retrieval.vector_pool(index.where("false"), queries, 4).count() == 0


def test_word_search_edges(spark):
    """Every word has to be there; questions without words or with an unknown word find nothing."""
    index = spark.createDataFrame([(1, "The cat sat; the CAT."), (2, "a dog"), (3, None), (4, "")], "id long, chunk_text string")
    asked = spark.createDataFrame([(1, "cat the"), (2, "dog bird"), (3, "  ! "), (4, None), (5, "Dog")], "query_id long, query_text string")
    got = {(r.query_id, r.id): round(r.fts_rank, 9) for r in retrieval.fts_matches(index, asked).collect()}
    assert set(got) == {(1, 1), (5, 2)} and got[5, 2] == 0.1
    assert got[1, 1] == round(0.1 + 0.1 / 2 + 0.1, 9)
    assert retrieval.fts_matches(index.where(F.lit(False)), asked).count() == 0
