"""Walks over trees and archives, and catalogue entries, over the given tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.functions import dates, sql
from marisight.operators import chunking, listings, posts, retrieval, walks, word_index
from marisight.operators.tables import shared_folder, spread, stored
from marisight.plans.retrieval_queries import table
from marisight.sources import feeds

BASE = "https://x.example"
#: orders for which each priority has one feed file
FEED_ORDERS = 1_000_000


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _joined(rows: DataFrame, by: Column, item: Column, order: str) -> DataFrame:
    """(id, xml): the items of each group as one text, in order."""
    per = rows.groupBy(by.alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), item.alias("x")))).alias("list"))
    return per.select("id", F.array_join(F.transform("list", lambda r: r["x"]), "\n").alias("xml"))


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a tree by id: regions, their nations, their customers, and files of these customers' orders."""
    item = lambda id, text, inner: F.concat(F.lit('<item child="1" id="'), id, F.lit('" text="'), text, F.lit('">'), inner, F.lit("</item>"))
    folder = lambda kind, c: item(F.concat(F.lit(kind), _text(c)), F.concat(F.lit(f"{kind} "), _text(c)), F.lit('<userdata name="other">loadResult(\'/no.pdf\')</userdata>'))
    orders = table(spark, sf_dir, "orders")
    k, path = F.col("o_orderkey"), F.concat(F.lit("/files/DR-"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit(".pdf"))
    call = F.concat(F.lit("javascript:loadResult( '"), path, F.lit("', 1)"))
    data = F.when(k % 3 == 0, F.concat(F.lit('<userdata name="myurl"><![CDATA['), call, F.lit("]]></userdata>"))).when(k % 3 == 1, F.concat(F.lit('<userdata name="myurl">'), F.replace(call, F.lit("'"), F.lit("&quot;")), F.lit("</userdata>"))).otherwise(F.lit('<userdata name="myurl">loadResult(\'/x.doc\')</userdata>'))
    levels = [
        _joined(table(spark, sf_dir, "region"), F.lit(""), folder("r", "r_regionkey"), "r_regionkey"),
        _joined(table(spark, sf_dir, "nation"), F.concat(F.lit("r"), _text("n_regionkey")), folder("n", "n_nationkey"), "n_nationkey"),
        _joined(table(spark, sf_dir, "customer"), F.concat(F.lit("n"), _text("c_nationkey")), folder("c", "c_custkey"), "c_custkey"),
        _joined(orders, F.concat(F.lit("c"), _text("o_custkey")), item(F.concat(F.lit("o"), _text("o_orderkey")), F.concat(F.lit("Sitting "), _text("o_orderkey")), data), "o_orderkey"),
    ]
    answers = levels[0].unionByName(levels[1]).unionByName(levels[2]).unionByName(levels[3])
    return answers.select("id", F.concat(F.lit('<?xml version="1.0"?><tree id="'), "id", F.lit('">'), "xml", F.lit("</tree>")).alias("xml"))


def tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of a tree's answers, with the file that an item's own user data name."""
    return feeds.tree_items(_tree(spark, sf_dir)).drop("pos")


def tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files reached from a tree's root over three levels of items."""
    return feeds.tree_walk(_tree(spark, sf_dir), BASE).drop("pos")


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, html): a question archive per region: nations are sessions, customers categories, and orders, three to a page,
    questions.  Pages are marked as sites do: the odd customers' by an item called next, the even ones' by numbers."""
    at = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    region, nation, customer = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    card = lambda head, inner: at('<div class="card"><h3 class="card-header">', head, "</h3>", inner, "</div>")
    index = _joined(nation, at(f"{BASE}/arkib/", _text("n_regionkey")), card(at("Tahun ", _text("n_nationkey")), at('<a href="/about">About</a><a href="/equans/', _text("n_nationkey"), '/">Sesi</a><a href="/equans/', _text("n_nationkey"), '/">again</a>')), "n_nationkey")
    sessions = _joined(customer, at(f"{BASE}/equans/", _text("c_nationkey"), "/"), card("Soalan", at('<a href="/question?c=', _text("c_custkey"), '">open</a><a href="/question?x=1">second</a>')), "c_custkey")
    orders = table(spark, sf_dir, "orders")
    per = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys")).select("o_custkey", "keys", F.ceil(F.size("keys") / 3).cast("int").alias("n"))
    pages = per.select("o_custkey", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.slice("keys", i * 3 + 1, 3))).alias("i", "keys"))
    page_url = lambda i: at("/question?c=", _text("o_custkey"), F.when(i == 0, "").otherwise(at("&page=", (i + 1).cast("string"))))
    question = lambda k: at('<div class="question"><h2 class="h5 card-header"><a href="/question/', k.cast("string"), '/">Soalan ', k.cast("string"), '</a></h2><a href="/other">x</a></div>')
    number = lambda i, css: at('<li class="page-item', css, '"><a href="', page_url(i), '">', (i + 1).cast("string"), "</a></li>")
    i, n = F.col("i"), F.col("n")
    numbers = at("<ul>", F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda j: number(j, F.when(j == i, " active").otherwise(""))), ""), "</ul>")
    marked = at('<ul><li class="page-item disabled"><a href="#">1</a></li><li class="page-item next"><a href="', F.when(i + 1 < n, page_url(i + 1)).otherwise("#"), '">&raquo;</a></li></ul>')
    lists = pages.select(at(BASE, page_url(i)).alias("id"), at(F.array_join(F.transform("keys", question), ""), F.when(F.col("o_custkey") % 2 == 1, marked).otherwise(numbers)).alias("xml"))
    every = index.unionByName(sessions).unionByName(lists)
    return every.select(F.col("id").alias("url"), at("<html><body>", F.col("xml"), "</body></html>").alias("html"))


def question_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of every region's archive within a budget of listing pages: 15 for each, but all of the first, and a
    section that is one listing."""
    sections = table(spark, sf_dir, "region").select(_text("r_regionkey").alias("section"), F.concat(F.lit(f"{BASE}/arkib/"), _text("r_regionkey")).alias("url"), F.when(F.col("r_regionkey") == 0, F.lit(None)).otherwise(15).cast("int").alias("max_pages"))
    direct = spark.createDataFrame([("direct", f"{BASE}/question?c=1", 2)], "section string, url string, max_pages int")
    return walks.question_walk(_archives(spark, sf_dir), sections.unionByName(direct))


def listing_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as listings over pages of three, of three sites with links to the next page of three kinds, each
    customer a section of at most four pages; the last item of a page is the first of the next one again."""
    n, i, last = F.col("o_custkey"), F.col("i"), F.col("last")
    rows = table(spark, sf_dir, "orders")
    per = rows.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))).alias("list"))
    per = per.withColumn("last", F.floor((F.size("list") - 1) / 3).cast("int")).select("o_custkey", "list", "last", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("i"))
    here = F.slice("list", F.greatest(i * 3, F.lit(1)), F.when(i == 0, 3).otherwise(4))
    k = lambda x: x["o_orderkey"].cast("string")
    said = lambda before, between, after: lambda x: F.concat(F.lit(before), k(x), F.lit(between), k(x), F.lit("</a>"), F.lit(after[0]), x["day"], F.lit(after[1]))
    shapes = (
        said('<div class="article-list-box"><h5><a href="/o/', '">Order ', ('</h5><div class="date">', "</div></div>")),
        said('<article><h2><a href="/o/', '">Order ', ('</h2><time datetime="', '">d</time></article>')),
        said('<article class="et_pb_post"><h2 class="entry-title"><a href="/o/', '">Order ', ('</h2><span class="published">', "</span></article>")),
    )
    page = lambda j: F.concat(F.lit("/list/"), n.cast("string"), F.when(j == 0, "").otherwise(F.concat(F.lit("?page="), (j + 1).cast("string"))))
    numbers = F.concat(F.lit('<ul class="pagination">'), F.array_join(F.transform(F.sequence(F.lit(0), last), lambda j: F.concat(F.lit("<li class='page-item"), F.when(j == i, " active").otherwise(""), F.lit("'><a class='page-link' href='"), page(j), F.lit("'>"), (j + 1).cast("string"), F.lit("</a>"))), ""), F.lit("</ul>"))
    to_next = lambda before, after: F.when(i < last, F.concat(F.lit(before), page(i + 1), F.lit(after))).otherwise("")
    pagers = (numbers, to_next('<a class="next page-numbers" href="', '">2</a>'), to_next('<div class="pagination clearfix"><div class="alignleft"><a href="/list/0">old</a></div><div class="alignright"><a href="', '">&raquo; Entri</a></div></div>'))
    html = F.coalesce(*[F.when(n % 3 == m, F.concat(F.array_join(F.transform(here, shape), ""), pager)) for m, (shape, pager) in enumerate(zip(shapes, pagers))])
    pages = stored(per.select(F.concat(F.lit(BASE), page(i)).alias("url"), html.alias("html")), "pages")
    site = F.element_at(F.array(F.lit("mcmc"), F.lit("dewan_selangor"), F.lit("dewan_johor")), (n % 3 + 1).cast("int"))
    sections = rows.select("o_custkey").distinct().select(n.alias("section"), site.alias("site"), F.concat(F.lit(f"{BASE}/list/"), n.cast("string")).alias("url"), F.lit(4).alias("max_pages"))
    return walks.listing_walk(pages, sections, since="1993-01-01").drop("pos", "date_text")


def catalogue_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as entries of a catalogue, ready to be indexed."""
    k = _text("p_partkey")
    entries = table(spark, sf_dir, "part").select(
        F.concat(F.lit("set_"), k).alias("dataset_id"), F.col("p_name").alias("title_en"), F.concat(F.lit("Tajuk "), k).alias("title_ms"), F.col("p_type").alias("description_en"),
        F.concat(F.lit("Keterangan "), k).alias("description_ms"), F.array(F.lit("date"), F.col("p_brand")).alias("columns"), F.when(F.col("p_partkey") % 2 == 0, "daily").otherwise("monthly").alias("frequency"),
        F.lit("prices").alias("category"), F.concat(F.lit("data-catalogue/"), k).alias("endpoint"),
    )
    items = feeds.catalog_items(entries, "gov-my/catalogue/")
    return items.withColumn("metadata", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("metadata")))))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF files that customers' static pages link, untitled ones named by their file."""
    rows = table(spark, sf_dir, "orders")
    k = _text("o_orderkey")
    link = F.concat(F.lit('<a href=" /akta/'), k, F.when(F.col("o_orderkey") % 2 == 0, ".PDF ").otherwise(".pdf"), F.lit('">'), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("<b>Akta</b> "), k)).otherwise(F.lit("<img src=i.png>")), F.lit('</a><a href="/akta/'), k, F.lit('.html">no</a>'))
    pages = _joined(rows, F.col("o_custkey"), link, "o_orderkey").select(F.col("id").alias("o_custkey"), F.lit(f"{BASE}/akta.html").alias("url"), F.concat("xml", "xml").alias("html"))
    return feeds.page_files(pages, "o_custkey").drop("pos")


def _views(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    sql.registered(spark)
    return {name: table(spark, sf_dir, name) for name in names}


def sql_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid search as SQL text: exact cosine and cover density over the documents that have a question's label or all
    its first two words, fused by reciprocal rank.  Where the words stand in the documents comes from posting lists, so
    no document's words are met as a whole."""
    views = _views(spark, sf_dir, "embeddings", "benchmark")
    views["embeddings"] = spread(views["embeddings"])
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    two = views["benchmark"].select(F.col("item_id").alias("query_id"), F.expr("array_join(slice(array_distinct(lexemes(text)), 1, 2), ' ')").alias("query_text"))
    return spark.sql(
        """
WITH e AS (SELECT *, vector_norm(v) AS norm FROM (SELECT vec_id, label, CAST(embedding AS ARRAY<DOUBLE>) AS v FROM {embeddings})),
q AS (SELECT item_id AS query_id, v, norm, label FROM {benchmark} JOIN e ON vec_id = item_id),
cosines AS (SELECT query_id, e.vec_id AS id, CASE WHEN size(q.v) <= 0 OR size(e.v) <= 0 OR q.norm * e.norm = 0 THEN 0.0D ELSE inner_product(q.v, e.v) / (q.norm * e.norm) END AS similarity FROM q JOIN e ON e.label = q.label),
vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS vrank FROM cosines),
densities AS (SELECT query_id, id, pair_density(places) AS density FROM {met} LEFT SEMI JOIN q USING (query_id) WHERE n_terms = 2),
fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(density, 9) DESC, id) AS frank FROM densities WHERE density > 0)
SELECT query_id, id, round(coalesce(similarity, 0), 6) AS similarity, round(coalesce(density, 0), 6) AS density, round(reciprocal_rank(vrank, 60) + reciprocal_rank(frank, 60), 6) AS score
FROM (SELECT * FROM vr WHERE vrank <= 20) FULL JOIN (SELECT * FROM fr WHERE frank <= 20) USING (query_id, id)""",
        met=word_index.on_the_fly(docs, two, ("text",)),
        **views,
    )


def sql_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings and paragraphs of all pages as SQL text over the table function."""
    return spark.sql(
        "SELECT page_id, n.tag, count(*) AS n, count_if(size(word_set(n.text)) > 0) AS worded FROM {pages}, LATERAL html_nodes(html, 'article > h1, article p') AS n GROUP BY page_id, n.tag",
        **_views(spark, sf_dir, "pages"),
    )


def _feed_folder(orders: DataFrame, folder: str, most: int = FEED_ORDERS) -> None:
    """Writes orders as items of feeds, and one that breaks off.  Each priority has a file for every ``most`` orders of all,
    or part of them; a file is written line by line, so none is ever whole in memory."""
    parts = max(1, -(-orders.count() // most))
    file = F.concat_ws("-", F.substring("o_orderpriority", 1, 1), F.pmod(F.xxhash64("o_orderkey"), F.lit(parts)).cast("string"))
    rows = orders.select(file.alias("file"), F.lit(1).alias("place"), "o_orderkey", "o_orderdate")
    edges = rows.select("file").distinct().select("file", F.explode(F.array(F.lit(0), F.lit(2))).alias("place"))
    broken = orders.sparkSession.range(1).select(F.lit("broken").alias("file"), F.lit(3).alias("place"))
    lines = rows.unionByName(edges, allowMissingColumns=True).unionByName(broken, allowMissingColumns=True).repartition("file").sortWithinPartitions("file", "place")
    k = _text("o_orderkey")
    item = F.concat(F.lit("<item><title>Order "), k, F.lit(" &amp; more</title><link>https://x.example/"), k, F.lit("</link>"), F.lit("<pubDate>"), F.date_format("o_orderdate", "EEE, dd MMM yyyy"), F.lit(" 08:00:00 +0000</pubDate>"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('<enclosure url="/f/'), k, F.lit('.pdf"/>'))).otherwise(""), F.lit("</item>"))
    ends = {0: '<?xml version="1.0"?><rss xmlns:x="urn:x"><channel><title>all</title>', 2: "</channel></rss>", 3: "<rss><channel><item><title>cut off</title><link>x"}
    line = F.coalesce(*[F.when(F.col("place") == place, said) for place, said in ends.items()], item)
    lines.select("file", line.alias("value")).write.partitionBy("file").text(folder)


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items of large feeds, files for each priority and a broken one, read item by item."""
    folder = f"{shared_folder(spark)}/feeds-{uuid.uuid4().hex}"
    _feed_folder(table(spark, sf_dir, "orders"), folder)
    return feeds.feed_files(spark, folder).select("title", "link", "enclosure", dates.feed_date(F.col("pub_date")).alias("published_at"))


def series_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a series' answers, filtered as asked: by a day range of a named column and by values, newest first."""
    one = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderstatus").alias("state"), F.col("o_orderkey").alias("n"))
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", one.alias("one")))).alias("list"))
    per = per.select("o_custkey", F.to_json(F.struct(F.col("list.one").alias("data"))).alias("json"))
    k = F.col("o_custkey")
    asked = F.struct(F.when(k % 2 == 0, "1994-01-01").otherwise("1993-06-01@date").alias("date_start"), F.when(k % 3 == 0, "1996-12-31@date").alias("date_end"), F.when(k % 5 == 0, F.array(F.lit("O@state"), F.lit("x@unknown"))).otherwise(F.array()).alias("filters"), F.when(k % 7 > 0, k % 7).cast("int").alias("row_limit"))
    return feeds.series_answers(per.withColumn("asked", asked), "date:string,state:string,n:long", "asked", ["o_custkey"]).drop("asked")


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prompts of questions: two thirds with the first documents of their language, half with live rows."""
    lang = F.element_at(F.array(*[F.lit(x) for x in ("en", "ms")]), (F.col("item_id") % 2 + 1).cast("int"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), lang.alias("language"))
    n = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").where("doc_id < 120").select(F.floor(n / 3).alias("query_id"), (n % 3 + 1).cast("int").alias("rank"), F.concat(F.lit("T"), n.cast("string")).alias("title"), F.col("source").alias("agency"), F.substring(F.coalesce("text", F.lit("")), 1, 200).alias("chunk_text"))
    rows = docs.where("query_id % 3 > 0")
    live = asked.where("query_id % 4 < 2").select("query_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("rank")).withColumn("text", F.concat(F.lit("rows "), F.col("rank").cast("string"), F.lit(" of "), F.col("query_id").cast("string")))
    return retrieval.prompts(asked, rows, live).drop("query_text")


def contextual_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents with a generated context before them, where there is one, that can be indexed."""
    cut = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.hard_split(F.coalesce("text", F.lit("")))).alias("chunk_index", "chunk_text"))
    k = F.col("doc_id") + F.col("chunk_index")
    prefix = F.when(k % 3 == 0, F.concat(F.lit("About "), F.col("doc_id").cast("string"))).when(k % 3 == 1, "  ")
    rows = chunking.indexable(cut.withColumn("chunk_text", chunking.contextual(prefix, F.col("chunk_text"))), 900)
    return rows.select("doc_id", "chunk_index", F.md5(F.col("chunk_text").cast("binary")).alias("md5"))


def post_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, date and attached files of orders' pages, each found in another place of the page."""
    k, n = _text("o_orderkey"), F.col("o_orderkey")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'09:00:00+08:00")
    title = F.element_at(F.array(F.concat(F.lit('<h1 class="x entry-title">Order '), k, F.lit("</h1><title>Site</title>")), F.concat(F.lit('<meta property="og:title" content="Order '), k, F.lit('">')), F.concat(F.lit("<title>Order "), k, F.lit(" - Site</title><h1></h1>"))), (n % 3 + 1).cast("int"))
    date = F.element_at(F.array(F.concat(F.lit('<time class="entry-date published" datetime="'), iso, F.lit('">x</time>')), F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('">')), F.concat(F.lit('<span class="published">'), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("</span>")), F.concat(F.lit('<div class="sidang-details"><p class="lead"><small>'), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit("</small></p></div>"))), (n % 4 + 1).cast("int"))
    files = F.when(n % 2 == 0, F.concat(F.lit('<div class="entry-content"><a href="/f/'), k, F.lit('.pdf">Fail</a><a href="/page">page</a></div><a href="/f/outside.pdf">no</a>'))).otherwise(F.concat(F.lit('<iframe src="/viewer.html?file=%2Ff%2F'), k, F.lit('.pdf"></iframe><div class="list-of-attachments"><a href="/f/'), k, F.lit('.docx">D</a></div>')))
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(f"{BASE}/p").alias("url"), F.concat(F.lit("<html>"), title, date, files).alias("html"))
    met = posts.meta(pages, "o_orderkey").drop("language")
    found = posts.attached(pages, "o_orderkey").groupBy("o_orderkey").agg(F.array_join(F.array_sort(F.collect_list("link")), " ").alias("files"))
    return met.join(found, "o_orderkey", "left")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, date and language of customers' pages with empty headings, prefixed titles and dates in five places."""
    n, k = F.col("c_custkey"), _text("c_custkey")
    title = F.element_at(F.array(F.concat(F.lit("<h2>menu</h2><h1></h1><h1> Page\n "), k, F.lit("</h1>")), F.concat(F.lit("<h1></h1><h3>x</h3><h2>Page "), k, F.lit("</h2>")), F.concat(F.lit("<title>KPM | Page "), k, F.lit("</title><h1> </h1>"))), (n % 3 + 1).cast("int"))
    day = F.element_at(F.array(*[F.lit(x) for x in ('<meta property="article:published_time" content="2024-03-05T10:00:00+08:00">', '<meta name="pubdate" content="5 Mac 2024">', '<meta name="date" content=""><time datetime="2024-03-05">x</time>', '<div class="post-date">Tarikh: 5 March 2024</div>', "<div>5 Mac 2024</div>")]), (n % 5 + 1).cast("int"))
    lang = F.element_at(F.array(F.lit(' lang="my"'), F.lit(' lang="EN"'), F.lit("")), (n % 3 + 1).cast("int"))
    pages = table(spark, sf_dir, "customer").select("c_custkey", F.lit(f"{BASE}/p").alias("url"), F.concat(F.lit("<html"), lang, F.lit(">"), title, day).alias("html"))
    return posts.meta(pages, "c_custkey", "education")


def package_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and files of parts' download packages."""
    n, k = F.col("p_partkey"), _text("p_partkey")
    facts = F.element_at(F.array(F.lit("<li class='list-group-item'>Last Updated <span class='badge'>7 Mei 2024</span></li><li class='list-group-item'>Create Date <span class=badge>5 Mac 2024</span>"), F.lit("<li class='list-group-item'>Version <span class='badge'>1</span><li class='list-group-item'><span class='badge'>7 Mei 2024</span>Tarikh Kemaskini"), F.lit("<li class='list-group-item'>Tarikh Cipta <span class='badge'>soon</span>")), (n % 3 + 1).cast("int"))
    pages = table(spark, sf_dir, "part").select("p_partkey", F.lit(f"{BASE}/download/x/").alias("url"), F.concat(F.when(n % 2 == 0, F.concat(F.lit("<h1 class='entry-title'>Package "), k, F.lit("</h1>"))).otherwise(F.concat(F.lit("<meta property='og:title' content='Package "), k, F.lit(" | Site'>"))), F.lit("<span class='published'>1 Jan 2020</span><div class='w3eden'><ul class='list-group'>"), facts, F.lit("</ul><div class='col-md-12'><p> </p></div><div class='col-md-12'><p>About "), k, F.lit("</p></div><a class='btn inddl' href='/download/x/?wpdmdl="), k, F.lit("'>Get</a><a class='inddl' href='#'>no</a></div>")).alias("html"))
    files = posts.attached(pages, "p_partkey", "divi").select("p_partkey", "link", "label")
    return posts.package_meta(pages, "p_partkey").join(files, "p_partkey", "left")


def act_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' customers under headings: documents and a detail page between one heading and the next."""
    n, k = F.col("c_custkey"), _text("c_custkey")
    part = F.concat(F.lit("<h2>Act "), k, F.lit("</h2><p><a href='#x'>x</a> <a href='/en/legal/"), k, F.lit("'>read</a><a href='/en/legal/other'>o</a></p>"), F.when(n % 2 == 0, F.concat(F.lit("<ul><li><a href='/f/"), k, F.lit(".pdf'>PDF</a><li><a href='/f/"), k, F.lit(".pdf'>again</a></ul><a href='/f/"), k, F.lit(".docx'>D</a>"))).otherwise(""))
    pages = _joined(table(spark, sf_dir, "customer"), F.col("c_nationkey"), part, "c_custkey").select(F.col("id").alias("c_nationkey"), F.lit(f"{BASE}/acts").alias("url"), F.concat(F.lit("<main><h2>Outside</h2><a href='/f/no.pdf'>no</a><div class='row contentZone'><h2>Empty</h2><p>none</p>"), "xml", F.lit("</div></main>")).alias("html"))
    return listings.headed_links(pages, key="c_nationkey").drop("pos").withColumn("documents", F.array_join("documents", " "))


def bilingual_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as feeds in one or two languages, read since 1995."""
    k = _text("o_orderkey")
    item = F.concat(F.lit("<item><title>"), k, F.lit("</title><link>/n/"), k, F.lit("</link><description>d</description><pubDate>"), F.date_format("o_orderdate", "EEE, dd MMM yyyy"), F.lit(" 09:00:00 +0000</pubDate></item>"))
    per = _joined(table(spark, sf_dir, "orders"), F.col("o_custkey"), item, "o_orderkey")
    at = lambda c: F.concat(F.lit(f"{BASE}/{c}/"), F.col("id").cast("string"))
    configs = per.select(F.col("id").cast("string").alias("name"), F.lit("news").alias("doc_type"), at("en").alias("url_en"), F.when(F.col("id") % 2 == 0, at("ms")).alias("url_ms"))
    body = lambda c: per.where("id % 3 > 0").select(at(c).alias("url"), F.concat(F.lit("<rss><channel>"), "xml", F.lit("</channel></rss>")).alias("xml"))
    return feeds.language_feeds(configs, body("en").unionByName(body("ms")), BASE, "1995-01-01").drop("description", "doc_type")


QUERIES = {f.__name__: f for f in (tree_files, tree_walk, question_walk, listing_walk, catalogue_items, page_files, sql_fusion, sql_headings, feed_files, series_answers, prompts, contextual_pieces, post_pages, detail_pages, package_pages, act_hubs, bilingual_feeds)}

_FILE = "'/files/DR-' || strftime(o_orderdate, '%d%m%Y') || '.pdf'"
ORACLE_SQL = {
    "tree_files": f"""
SELECT '' AS id, 'r' || r_regionkey AS item, 'r ' || r_regionkey AS text, '' AS address FROM region
UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, 'n ' || n_nationkey, '' FROM nation
UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, 'c ' || c_custkey, '' FROM customer
UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, 'Sitting ' || o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN {_FILE} ELSE '' END FROM orders""",
    "tree_walk": f"""
WITH RECURSIVE e AS (SELECT '' AS id, 'r' || r_regionkey AS child FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
w(id, level) AS (SELECT '', 0 UNION ALL SELECT e.child, level + 1 FROM w JOIN e ON e.id = w.id WHERE level < 3)
SELECT w.id AS parent, '{BASE}' || {_FILE} AS link, 'Sitting ' || o_orderkey AS title, substr({_FILE}, 8) AS file_name, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM w JOIN orders ON w.id = 'c' || o_custkey WHERE level = 3 AND o_orderkey % 3 < 2""",
    "question_walk": f"""
WITH o AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS page FROM orders),
p AS (SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS section, n_regionkey, n_nationkey, o_custkey, page FROM o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT DISTINCT 'direct', 99, 0, o_custkey, page FROM o WHERE o_custkey = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY n_nationkey, o_custkey, page) AS turn FROM p)
SELECT section, CAST(turn AS INTEGER) AS turn, '{BASE}/question?c=' || o_custkey || CASE WHEN page = 0 THEN '' ELSE '&page=' || (page + 1) END AS url, '{BASE}/question/' || o_orderkey || '/' AS link, 'Soalan ' || o_orderkey AS title
FROM t JOIN o USING (o_custkey, page) WHERE n_regionkey = 0 OR turn <= CASE WHEN section = 'direct' THEN 2 ELSE 15 END""",
    "listing_walk": f"""
WITH o AS (SELECT o_custkey AS section, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS published_at, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS page FROM orders)
SELECT section, CAST(page + 1 AS INTEGER) AS turn, 'Order ' || k AS title, '{BASE}/o/' || k AS link, published_at FROM o WHERE page < 4 AND published_at >= '1993-01-01'""",
    "catalogue_items": f"""
WITH p AS (SELECT *, p_name || ' / Tajuk ' || p_partkey || chr(10) || chr(10) || p_type || chr(10) || chr(10) || 'Keterangan ' || p_partkey || chr(10) || chr(10) || 'Dataset ID: set_' || p_partkey || chr(10) || 'Columns: date, ' || p_brand || chr(10)
  || 'Update frequency: ' || CASE WHEN p_partkey % 2 = 0 THEN 'daily' ELSE 'monthly' END || chr(10) || 'Category: prices' || chr(10) || 'API endpoint: data-catalogue/' || p_partkey AS t FROM part)
SELECT 'gov-my/catalogue/set_' || p_partkey || '.metadata' AS storage_path, 'set_' || p_partkey || '.metadata' AS file_name, 'metadata' AS file_type, 'v1' AS version_token, p_name AS title, '{feeds.CATALOG_PAGES}set_' || p_partkey AS source_url,
  t AS text, sha256(t) AS sha256, CAST(strlen(t) AS INTEGER) AS size_bytes, '{{"category":"prices","columns":"date,' || p_brand || '","datagov_dataset_id":"set_' || p_partkey || '","datagov_endpoint":"data-catalogue/' || p_partkey || '","frequency":"' || CASE WHEN p_partkey % 2 = 0 THEN 'daily' ELSE 'monthly' END || '","source_type":"datagov_metadata"}}' AS metadata FROM p""",
    "page_files": f"""
SELECT o_custkey, '{BASE}/akta/' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '.PDF' ELSE '.pdf' END AS link, CASE WHEN o_orderkey % 3 > 0 THEN 'Akta ' || o_orderkey ELSE o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '.PDF' ELSE '.pdf' END END AS title FROM orders""",
    "sql_fusion": """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS words FROM documents),
q0 AS (SELECT item_id, v, label, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark JOIN e ON vec_id = item_id),
q AS (SELECT item_id AS query_id, v, label, w[1] AS t1, list_filter(w, lambda x: x <> w[1])[1] AS t2 FROM q0),
vr AS (SELECT query_id, e.vec_id AS id, list_cosine_similarity(q.v, e.v) AS similarity FROM q JOIN e ON e.label = q.label),
vp AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS vrank FROM vr QUALIFY vrank <= 20),
m AS (SELECT query_id, id, t1, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM q JOIN d ON list_contains(words, t1) AND list_contains(words, t2)),
h AS (SELECT m.* FROM m JOIN q USING (query_id) WHERE w = q.t1 OR w = q.t2),
n AS (SELECT *, lead(w) OVER x AS nw, lead(pos) OVER x AS np FROM h WINDOW x AS (PARTITION BY query_id, id ORDER BY pos)),
f AS (SELECT query_id, id, sum(0.1 / (np - pos)) AS density FROM n WHERE nw <> w GROUP BY 1, 2),
fp AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(density, 9) DESC, id) AS frank FROM f QUALIFY frank <= 20)
SELECT query_id, id, round(coalesce(similarity, 0), 6) AS similarity, round(coalesce(density, 0), 6) AS density, round(coalesce(1.0::DOUBLE / (60 + vrank), 0) + coalesce(1.0::DOUBLE / (60 + frank), 0), 6) AS score FROM vp FULL JOIN fp USING (query_id, id)""",
    "sql_headings": """
WITH b AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS x FROM pages), t AS (SELECT page_id, x, unnest(['h1', 'p']) AS tag FROM b), c AS (SELECT page_id, tag, len(string_split(x, '<' || tag || '>')) - 1 AS n FROM t)
SELECT page_id, tag, n, n AS worded FROM c WHERE n > 0""",
    "feed_files": """
SELECT 'Order ' || o_orderkey || ' & more' AS title, 'https://x.example/' || o_orderkey AS link, CASE WHEN o_orderkey % 2 = 0 THEN '/f/' || o_orderkey || '.pdf' ELSE '' END AS enclosure, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM orders""",
    "series_answers": """
WITH o AS (SELECT o_custkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS state, o_orderkey AS n FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY date DESC, n) AS rank FROM o WHERE date >= CASE WHEN k % 2 = 0 THEN '1994-01-01' ELSE '1993-06-01' END AND (k % 3 > 0 OR date <= '1996-12-31') AND (k % 5 > 0 OR state = 'O'))
SELECT k AS o_custkey, date, state, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= CASE WHEN k % 7 > 0 THEN k % 7 ELSE 10 END""",
    "prompts": f"""
WITH q AS (SELECT item_id, text, CASE WHEN item_id % 2 = 1 THEN 'ms' ELSE 'en' END AS language FROM benchmark),
d AS (SELECT doc_id // 3 AS q, doc_id % 3 + 1 AS r, '[' || (doc_id % 3 + 1) || '] T' || doc_id || ' | ' || source || chr(10) || substr(coalesce(text, ''), 1, 200) AS s FROM documents WHERE doc_id < 120),
c AS (SELECT q, string_agg(s, chr(10) || chr(10) ORDER BY CASE r WHEN 1 THEN 1 ELSE 5 - r END) AS context FROM d WHERE q % 3 > 0 GROUP BY q)
SELECT item_id AS query_id, language, CASE language WHEN 'ms' THEN '{retrieval.SYSTEM["ms"]}' ELSE '{retrieval.SYSTEM["en"]}' END || CASE WHEN context IS NULL THEN '' ELSE '{retrieval.CITE}' END AS system,
  text || CASE WHEN context IS NULL THEN '' ELSE chr(10) || chr(10) || '---' || chr(10) || chr(10) || context END || CASE WHEN item_id % 4 < 2 THEN chr(10) || chr(10) || '{retrieval.LIVE}' || chr(10) || 'rows 1 of ' || item_id || chr(10) || chr(10) || 'rows 2 of ' || item_id ELSE '' END AS user,
  CASE WHEN context IS NULL THEN 'none' ELSE 'strong' END AS support FROM q LEFT JOIN c ON c.q = item_id""",
    "contextual_pieces": """
WITH p AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(t, i * 1400 + 1, 1400) AS x FROM (SELECT doc_id, coalesce(text, '') AS t, unnest(range(0, greatest(CAST(ceil(length(coalesce(text, '')) / 1400.0) AS BIGINT), 1))) AS i FROM documents)),
c AS (SELECT doc_id, chunk_index, CASE WHEN (doc_id + chunk_index) % 3 = 0 THEN 'About ' || doc_id || chr(10) || chr(10) || x ELSE x END AS x FROM p)
SELECT doc_id, chunk_index, md5(substr(x, 1, 900)) AS md5 FROM c WHERE trim(x, ' ') <> ''""",
    "post_pages": f"""
SELECT o_orderkey, 'Order ' || o_orderkey || CASE o_orderkey % 3 WHEN 2 THEN ' - Site' ELSE '' END AS title, strftime(o_orderdate, '%Y-%m-%d') AS published_at,
  CASE WHEN o_orderkey % 2 = 0 THEN '{BASE}/f/' || o_orderkey || '.pdf' ELSE '{BASE}/f/' || o_orderkey || '.docx {BASE}/f/' || o_orderkey || '.pdf' END AS files FROM orders""",
    "detail_pages": """
SELECT c_custkey, 'Page ' || c_custkey AS title, CASE WHEN c_custkey % 5 = 4 THEN '' ELSE '2024-03-05' END AS published_at, CASE c_custkey % 3 WHEN 0 THEN 'ms' WHEN 1 THEN 'en' END AS language FROM customer""",
    "package_pages": f"""
SELECT p_partkey, 'Package ' || p_partkey AS title, CASE p_partkey % 3 WHEN 0 THEN '2024-03-05' WHEN 1 THEN '2024-05-07' ELSE '2020-01-01' END AS published_at, 'About ' || p_partkey AS description, '{BASE}/download/x/?wpdmdl=' || p_partkey AS link, 'Get' AS label FROM part""",
    "act_hubs": f"""
SELECT c_nationkey, 'Act ' || c_custkey AS title, '{BASE}/en/legal/' || c_custkey AS detail, CASE WHEN c_custkey % 2 = 0 THEN '{BASE}/f/' || c_custkey || '.pdf {BASE}/f/' || c_custkey || '.docx' ELSE '' END AS documents FROM customer""",
    "bilingual_feeds": f"""
WITH l AS (SELECT unnest(['en', 'ms']) AS language)
SELECT CAST(o_custkey AS VARCHAR) AS feed, language, '{BASE}/n/' || o_orderkey AS source_url, CAST(o_orderkey AS VARCHAR) AS title, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM orders, l WHERE o_custkey % 3 > 0 AND (language = 'en' OR o_custkey % 2 = 0) AND o_orderdate >= DATE '1995-01-01'""",
}
