"""Article pages, prompts, series filters and SQL functions at their edges."""

import pytest
from pyspark.sql import functions as F

from marisight.functions import sql, vectors
from marisight.operators import listings, posts, retrieval
from marisight.sources import feeds

PAGES = "page_id long, url string, html string"


def test_places_are_looked_at_in_order(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://h/2024/05/06/x", '<h1 class="sfnewsTitle">One</h1><div class="sfnewsMetaInfo">by</div><time datetime="2020-01-01">'),
            (2, "https://h/x", '<meta property="og:title" content="Two"><div class="sfnewsMetaInfo"><b class="sfnewsDate">3 Mac 2024</b></div>'),
            (3, "https://h/x", "<title>Three - Site | More</title><div class=sfnewsMetaInfo>pada 3 Mac 2024</div>"),
            (4, "https://h/x", None),
            (5, "https://h/x", ""),
        ],
        PAGES,
    )
    got = {r.page_id: (r.title, r.published_at) for r in posts.meta(pages, kind="sitefinity").collect()}
    assert got == {1: ("One", "2024-05-06"), 2: ("Two", "2024-03-03"), 3: ("Three - Site", "2024-03-03"), 4: ("", ""), 5: ("", "")}
    wordpress = spark.createDataFrame([(1, "https://h/x", '<h1>no</h1><title>A – B | C</title><div class="sidang-details"><p class="lead"><small>17 Ogos - 20 Ogos 2015</small></p></div>')], PAGES)
    assert [(r.title, r.published_at) for r in posts.meta(wordpress).collect()] == [("A – B", "2015-08-17")]


def test_attached_files_stand_in_order_once(spark):
    html = """<a href="/out.pdf">out</a><article itemprop="articleBody"><a href="/a.PDF?v=1">A</a><a href="b.docx"></a><a href="/a.PDF?v=1">again</a><a href="mailto:x.pdf">m</a></article>
    <iframe src="/pdf-viewer/?x=1&amp;file=https%3A%2F%2Fo%2Fc.pdf"></iframe><iframe src="/map"></iframe><div class="list-of-attachments"><a href="/d">D</a></div>"""
    pages = spark.createDataFrame([(1, "https://h/p/", html), (2, "https://h/p/", '<a href="/whole.pdf">w</a>'), (3, "https://h/", None)], PAGES)
    got = [(r.page_id, r.link, r.label) for r in posts.attached(pages, kind="joomla").orderBy("page_id", "at").collect()]
    assert got == [(1, "https://o/c.pdf", "pdfjs-viewer embed"), (1, "https://h/a.PDF?v=1", "A"), (1, "https://h/p/b.docx", "b.docx"), (1, "https://h/d", "D"), (2, "https://h/whole.pdf", "w")]


def test_headed_links_of_pages_without_areas(spark):
    pages = spark.createDataFrame([(1, "https://h/", '<h2>A</h2><p><a href="/en/legal/a">x</a></p><h2>A</h2><a href="/f.pdf">f</a><h2></h2><a href="/g.pdf">g</a><div><h2>B</h2></div><a href="/h.pdf">h</a>')], PAGES)
    got = {(r.title, r.detail, tuple(r.documents)) for r in listings.headed_links(pages).collect()}
    assert ("A", "https://h/en/legal/a", ()) in got and all(t != "" for t, _, _ in got)


def test_prompts_have_what_there_is(spark):
    asked = spark.createDataFrame([(1, "q", "ms"), (2, "r", "en"), (3, "s", None)], "query_id long, query_text string, language string")
    rows = spark.createDataFrame([(1, n, f"T{n}", "A", f"c{n}") for n in (1, 2, 3)], "query_id long, rank int, title string, agency string, chunk_text string")
    live = spark.createDataFrame([(1, 2, "two"), (1, 1, "one"), (3, 1, "x")], "query_id long, rank int, text string")
    system = {"en": "E.", "ms": "M."}
    got = {r.query_id: (r.system, r.user, r.support) for r in retrieval.prompts(asked, rows, live, system).collect()}
    assert got[1] == ("M." + retrieval.CITE, f"q\n\n---\n\n[1] T1 | A\nc1\n\n[3] T3 | A\nc3\n\n[2] T2 | A\nc2\n\n{retrieval.LIVE}\none\n\ntwo", "strong")
    assert got[2] == ("E.", "r", "none") and got[3] == ("E.", f"s\n\n{retrieval.LIVE}\nx", "none")
    assert retrieval.prompts(asked, rows).where("query_id = 3").first().user == "s"


@pytest.mark.parametrize(
    "asked, days",
    [
        ({}, [5, 4, 3, 2, 1]),
        ({"date_start": "2024-01-02", "date_end": "2024-01-04@date"}, [4, 3, 2]),
        ({"date_start": "2024-01-02@other"}, [5, 4, 3, 2, 1]),
        ({"filters": ["a@kind"]}, [5, 3, 1]),
        ({"filters": ["a@kind", "3@n"]}, [3]),
        ({"row_limit": 2}, [5, 4]),
        ({"row_limit": 0, "filters": ["zz@nothing"]}, [5, 4, 3, 2, 1]),
    ],
)
def test_series_as_asked(spark, asked, days):
    rows = ",".join(f'{{"date":"2024-01-0{i}","kind":"{"ab"[1 - i % 2]}","n":{i}}}' for i in range(1, 6))
    bodies = spark.createDataFrame([(1, f"[{rows}]"), (2, f'{{"data":[{rows}]}}'), (3, '{"error":1}'), (4, None), (5, "no json")], "k int, json string")
    given = F.struct(F.lit(asked.get("date_start")).cast("string").alias("date_start"), F.lit(asked.get("date_end")).cast("string").alias("date_end"), F.array(*[F.lit(f) for f in asked.get("filters", [])]).cast("array<string>").alias("filters"), F.lit(asked.get("row_limit")).cast("int").alias("row_limit"))
    got = feeds.series_answers(bodies.withColumn("asked", given), "date:string,kind:string,n:int", "asked", ["k"]).orderBy("k", "rank").collect()
    assert [(r.k, r.n) for r in got] == [(k, d) for k in (1, 2) for d in days]


def test_sql_functions_equal_column_functions(spark):
    sql.registered(spark)
    rows = spark.createDataFrame([([1.0, 2.0, 0.0], [2.0, 1.0, 1.0], "A b, É9 b"), ([0.0], [1.0], ""), ([1.0, 1.0], [-1.0, 0.5], "x  x\ty")], "a array<double>, b array<double>, t string")
    rows.createOrReplaceTempView("sql_rows")
    got = spark.sql("SELECT cosine_of(a, b) AS c, lexemes(t) AS l, word_set(t) AS w, jaccard_of(word_set(t), array('x')) AS j FROM sql_rows").collect()
    want = rows.select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.lexemes(F.col("t")).alias("l"), vectors.word_set(F.col("t")).alias("w"), vectors.jaccard(vectors.word_set(F.col("t")), F.array(F.lit("x"))).alias("j")).collect()
    assert [(round(g.c, 12), g.l, g.w, g.j) for g in got] == [(round(w.c, 12), w.l, w.w, w.j) for w in want]
    assert spark.sql("SELECT round(cover_density(array('a', 'b'), array('a', 'x', 'b', 'a')), 9) AS d, reciprocal_rank(CAST(NULL AS INT), 60) AS r").first() == (round(0.1 / 2 + 0.1, 9), 0.0)
    assert [r.href for r in spark.sql("SELECT n.href FROM html_nodes('<p><a href=x>1</a><a>2</a>', 'a') AS n").collect()] == ["x", None]
