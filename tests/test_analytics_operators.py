"""Retrieval, chunking, state, links and sources on small fixtures."""

import datetime
import io
import zipfile

from pyspark.sql import functions as F

from marisight.operators import chunking, links, retrieval, state
from marisight.sources import feeds, html_blocks

POOL = "query_id long, rank int, id long, chunk_index int, chunk_text string, similarity double, fts_rank double, rrf_score double"


def test_effective_and_noise(spark):
    rows = spark.createDataFrame([(1, 1, 1, 0, "", 0.7, 0.0, 0.0), (1, 2, 2, 0, "", 0.0, 0.2, 0.0), (2, 1, 3, 0, "", 0.0, 0.05, 0.0), (2, 2, 4, 0, "", 0.0, 0.1, 0.0)], POOL)
    assert {r.id: r.e for r in rows.select("id", retrieval.effective().alias("e")).collect()} == {1: 0.7, 2: 0.5, 3: 0.5, 4: 0.5}
    assert {r.id for r in retrieval.without_noise(rows).collect()} == {1, 2, 4}


def test_deduplicated(spark):
    rows = [(1, 1, 7, 3, "one two", 0.9, 0.0, 0.0), (1, 2, 7, 4, "three four", 0.7, 0.0, 0.0), (1, 3, 8, 1, "a b c d e f g h", 0.6, 0.0, 0.0), (1, 4, 9, 5, "a b c d e f g i", 0.8, 0.0, 0.0)]
    got = retrieval.deduplicated(spark.createDataFrame(rows, POOL)).collect()
    assert sorted(r["rank"] for r in got) == [1, 4]


def test_recency_cutoff_and_order(spark):
    rows = spark.createDataFrame([(1, 1, 1, 0, "", 0.9, 0.0, 0.05, datetime.date(2015, 1, 1)), (1, 2, 2, 0, "", 0.8, 0.0, 0.05 - 1e-3, datetime.date(2025, 1, 1)), (1, 3, 3, 0, "", 0.3, 0.0, 0.01, None)], POOL + ", published_at date")
    out = retrieval.recency_boosted(rows, F.lit(datetime.date(2025, 6, 1))).orderBy("rank").collect()
    assert [r.id for r in out] == [2, 1, 3]
    assert [r.id for r in retrieval.adaptive_cutoff(rows).orderBy("rank").collect()] == [1, 2]
    places = {n: [r["rank"] for r in retrieval.attention_order(spark.createDataFrame([(1, i, i, 0, "", 0.0, 0.0, 0.0) for i in range(1, n + 1)], POOL)).orderBy("place").collect()] for n in (2, 3, 4, 5)}
    assert places == {2: [1, 2], 3: [1, 3, 2], 4: [1, 4, 3, 2], 5: [1, 5, 4, 3, 2]}


def test_rerank(spark):
    rows = spark.createDataFrame([(q, i, i, 0, "", 0.0, 0.0, 0.0) for q in (1, 2) for i in (1, 2, 3)], POOL)
    answers = spark.createDataFrame([(1, 'Scores: [{"index": 3, "score": 9}, {"index": 1, "score": 2}]'), (2, "no list")], "query_id long, answer string")
    out = retrieval.reranked(rows, retrieval.parsed_scores(answers), 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.id) for r in out] == [(1, 3), (1, 1), (2, 1), (2, 2)]


def test_cover_density(spark):
    rows = spark.createDataFrame([(1, [0, 3, 9], [1, 1, 1], 1), (2, [0, 1, 5], [1, 2, 1], 2), (3, [0, 4], [1, 2], 2)], "k int, pos array<int>, term array<long>, n int")
    got = {r.k: r.v for r in rows.select("k", retrieval.cover_density("pos", "term", "n").alias("v")).collect()}
    assert abs(got[1] - 0.3) < 1e-12
    assert abs(got[2] - (0.1 + 0.1 / 4)) < 1e-12
    assert abs(got[3] - 0.1 / 4) < 1e-12


BLOCKS = "doc_id long, block_idx int, block_type string, section_heading string, text string"


def test_chunks(spark):
    rows = [(1, 0, "paragraph", "A", "x" * 800), (1, 1, "paragraph", "A", "y" * 800), (1, 2, "paragraph", "B", "  "), (1, 3, "table", "B", "| h |\n|---|\n" + "\n".join("| %s |" % ("r" * 50) for _ in range(100))), (2, 0, "list_item", None, "short")]
    out = chunking.chunks(spark.createDataFrame(rows, BLOCKS), target=1000).orderBy("doc_id", "chunk_index").collect()
    first = [r for r in out if r.doc_id == 1]
    assert [r.chunk_index for r in first] == list(range(len(first)))
    assert [len(r.chunk_text) for r in first[:2]] == [800, 800] and all(len(r.parent_text) <= 3000 for r in first)
    tables = [r for r in first if r.is_table]
    assert len(tables) > 1 and all(r.chunk_text.startswith("Table from section: B\n\n| h |\n|---|\n") and len(r.chunk_text) <= 3000 for r in tables)
    assert out[-1].chunk_text == "short" and out[-1].section_heading is None
    assert [r.n for r in spark.createDataFrame([("abcde",)], "t string").select(F.size(chunking.hard_split(F.col("t"), 2)).alias("n")).collect()] == [3]


def test_state(spark):
    old = spark.createDataFrame([("u1", "s1", "p1", 1), ("u2", "s2", "p2", 1)], "canonical_url string, sha256 string, spaces_path string, loaded_at long")
    new = spark.createDataFrame([(1, "u1", "s1"), (2, "u2", "s9"), (3, "u3", "s1"), (4, "u4", "s4"), (5, "u5", "s4")], "seq long, canonical_url string, sha256 string")
    kinds = {r.canonical_url: (r.kind, r.compat) for r in state.classified(new, old).collect()}
    assert kinds == {"u1": ("known_url", "known_url"), "u2": ("changed", "known_url"), "u3": ("duplicate", "duplicate"), "u4": ("new", "new"), "u5": ("duplicate", "duplicate")}
    again = spark.createDataFrame([("u2", "s3", "p3", 2), ("u9", "s9", "p9", 2)], old.schema)
    assert {r.canonical_url: r.sha256 for r in state.upsert(old, again, ["canonical_url"]).collect()} == {"u1": "s1", "u2": "s3", "u9": "s9"}
    assert state.insert_or_ignore(old, again, ["canonical_url"]).count() == 3
    lists = [spark.createDataFrame(x, "u string, pos int") for x in ([("a", 1), ("b", 2)], [("b", 1), ("c", 2)])]
    assert sorted((r.u, r.list_no) for r in state.united("u", *lists).collect()) == [("a", 0), ("b", 0), ("c", 1)]


PAGE = """<html><head><title>T</title></head><body><h1>Akta</h1><p>One &amp; two<p>Three</p><ul><li><p>In item</p></li></ul>
<table><tr><td>a</td><td><a href='/x.pdf'>Muat Turun</a></td></tr></table>
<a href="files/a.PDF">A</a> <a href="/getattachment/1/b">B</a> <a href="javascript:x()">download</a><a href="files/a.PDF">again</a>
<iframe src="/viewer.php?file=%2Fdocs%2Fc.pdf&z=1"></iframe></body></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, "https://h/dir/page", PAGE)], "page_id long, url string, html string")
    found = [(r.link, r.label) for r in links.document_links(pages).orderBy("pos").collect()]
    assert found == [("https://h/x.pdf", "Muat Turun"), ("https://h/dir/files/a.PDF", "A"), ("https://h/getattachment/1/b", "B"), ("https://h/docs/c.pdf", "pdfjs-viewer embed")]
    blocks = html_blocks.html_blocks(PAGE)
    assert [(b["block_type"], b["text"]) for b in blocks[:3]] == [("paragraph", "One & two Three In item a Muat Turun A B download again"), ("paragraph", "Three"), ("list_item", "In item")]
    assert all(b["section_heading"] == "Akta" for b in blocks) and html_blocks.html_title(PAGE) == "T"
    row = links.table_rows(pages).first()
    assert row.cells == ["a", "Muat Turun"] and row.links == ["/x.pdf"]


def test_payloads(spark):
    csv_bytes = "﻿Name,Age\nAna,3\n,\nBo,\n".encode()
    assert [b["text"] for b in html_blocks.csv_blocks(csv_bytes)] == ["Name: Ana | Age: 3", "Name: Bo"]
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        para = lambda style, t: f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{para("Heading1", "H")}{para("ListBullet", "item")}{para("Normal", "text")}</w:body></w:document>')
    docx = html_blocks.docx_blocks(held.getvalue())
    assert [(b["block_type"], b["section_heading"], b["text"]) for b in docx] == [("list_item", "H", "item"), ("paragraph", "H", "text")]
    s, r = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{s}" xmlns:r="{r}"><sheets><sheet name="S1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{s}"><si><t>Name</t></si><si><t>Ana</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{s}"><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>5</v></c></row></sheetData></worksheet>')
    assert [(b["text"], b["sheet_name"], b["row_label"]) for b in html_blocks.xlsx_blocks(book.getvalue())] == [("Name: Ana | Column 2: 5", "S1", "Ana")]
    files = spark.createDataFrame([(1, bytearray(csv_bytes), "csv"), (2, bytearray(b"x"), "pdf"), (3, bytearray(b"x"), "docx")], "k int, content binary, file_type string")
    got = {r.k: (len(r.blocks), r.parse_error) for r in html_blocks.parsed(files).collect()}
    assert got[1] == (2, None) and got[2][1] == "no parser for pdf" and got[3][1].startswith("BadZipFile")


def test_feeds(spark):
    index = "<sitemapindex><sitemap><loc>https://h/b.xml</loc></sitemap></sitemapindex>"
    bodies = spark.createDataFrame([("https://h/a.xml", index), ("https://h/b.xml", "<urlset><url><loc>https://h/1</loc></url></urlset>")], "url string, xml string")
    assert [r.loc for r in feeds.all_sitemap_urls(spark.createDataFrame([("https://h/a.xml",)], "url string"), bodies).collect()] == ["https://h/1"]
    rows = spark.createDataFrame([("User-agent: *\nDisallow: /p\nSitemap: https://h/s.xml",), (None,)], "t string")
    got = [r.s for r in rows.select(feeds.robots_sitemaps(F.col("t"), F.lit("https://h")).alias("s")).collect()]
    assert got[0] == ["https://h/s.xml"] and len(got[1]) == 4
    assert [r.d for r in rows.select(feeds.disallowed(F.lit("/private"), feeds.robots_rules(F.col("t"))).alias("d")).collect()] == [True, False]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], POOL)
    assert retrieval.deduplicated(empty).count() == 0 and retrieval.adaptive_cutoff(empty).count() == 0
    assert chunking.chunks(spark.createDataFrame([], BLOCKS)).count() == 0


LISTING = """<table class="com-content-category__table x"><tbody><tr><td class="list-title"><a href="/a/1">First</a></td><td class="list-date">3 Mac 2024</td></tr>
<tr><td><a href="javascript:x">no</a></td></tr><tr><td><a href="/a/1">again</a></td></tr><tr><td><a href="/a/2">Second</a></td><td class="list-date">bad</td></tr></tbody></table>
<h2>2023</h2><a href="p1">P1</a><h2>2022</h2><a href="p2">P2</a><a rel="next" href="?start=10">more</a>"""


def test_listings(spark):
    from marisight.operators import listings

    pages = spark.createDataFrame([(1, "https://h/list", LISTING), (2, "https://h/x", None)], "page_id long, url string, html string")
    got = [(r.title, r.link, r.published_at) for r in listings.listing(pages, listings.SITES["moh"]).orderBy("pos").collect()]
    assert got == [("First", "https://h/a/1", "2024-03-03"), ("Second", "https://h/a/2", "")]
    under = [(r.header, r.text) for r in listings.carried(pages, "h2", "a").where("header is not null").orderBy("pos").collect()]
    assert under == [("2023", "P1"), ("2022", "P2"), ("2022", "more")]
    assert [r.next_url for r in listings.next_page(pages).collect()] == ["https://h/list?start=10"]
    one = spark.range(1)
    assert one.select(listings.offset_pages(F.lit("https://h/l?x=1"), F.lit(3), 20).alias("u")).first().u == ["https://h/l?x=1", "https://h/l?x=1&start=20", "https://h/l?x=1&start=40"]
    assert one.select(listings.year_pages(F.lit("/{year}/"), F.lit(2020), F.lit(2022)).alias("u")).first().u == ["/2022/", "/2021/", "/2020/"]


def test_crawl(spark):
    links_ = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e")], "url string, link string")
    assert sorted((r.url, r.level) for r in links.crawl(spark.createDataFrame([("a",)], "url string"), links_).collect()) == [("a", 0), ("b", 1), ("c", 2)]


def test_small_sources(spark):
    row = spark.createDataFrame([('{"x":[{"q":1}],"y":[{"id":"7"}]}',)], "j string").select(feeds.first_list_with(F.col("j"), "id", ("x", "y"), "struct<id:string>").alias("l")).first()
    assert [e.id for e in row.l] == ["7"]
    asked = spark.createDataFrame([(1, "q"), (2, "p")], "question_id int, query_text string")
    answers = spark.createDataFrame([(1, "q\n\n a \nb\nc")], "question_id int, answer string")
    assert sorted((r.question_id, r.query_no, r.query_text) for r in retrieval.expanded_queries(asked, answers).collect()) == [(1, 0, "q"), (1, 1, "a"), (1, 2, "b"), (2, 0, "p")]
    marks = retrieval.linked_marks(spark.createDataFrame([(1, "x [2] y [9]")], "message_id int, text string"), spark.createDataFrame([(1, 2, 5)], "message_id int, citation_index int, document_id int"))
    assert {(r.pos, r.citation_index, r.document_id) for r in marks.collect()} == {(0, 2, 5), (1, 9, None)}
