"""Listing shapes, record names, walks and answers over the given tables, and their SQL.

Pages are written from each customer's orders in the shapes that listings have, and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.functions import dates, text, urls, vectors
from marisight.operators import chunking, links, listings, retrieval
from marisight.plans.retrieval_queries import table
from marisight.plans.table_queries import _messages
from marisight.sources import feeds
from marisight.streaming import jobs

BASE = "https://x.example"


def _orders(spark: SparkSession, sf_dir: str, made, order: tuple[str, ...] = ("year", "o_orderkey")) -> DataFrame:
    """(o_custkey, url, html): a page per customer; ``made`` turns its sorted orders into HTML."""
    rows = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = [*order, *[c for c in ("o_orderkey", "year", "day", "o_orderpriority", "o_orderstatus") if c not in order]]
    per = rows.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("list"))
    return per.select("o_custkey", F.concat(F.lit(f"{BASE}/c/"), F.col("o_custkey").cast("string")).alias("url"), F.concat(F.lit("<html><body>"), made(F.col("list")), F.lit("</body></html>")).alias("html"))


def _link(x: Column) -> Column:
    k = x["o_orderkey"].cast("string")
    return F.concat(F.lit('<a href="/o/'), k, F.lit('.pdf">Order '), k, F.lit("</a>"))


def _hub(rows: Column) -> Column:
    year = lambda x, i: F.when((i == 0) | (F.get(rows, i - 1)["year"] != x["year"]), F.concat(F.lit("<h2>"), x["year"].cast("string"), F.lit("</h2>"))).otherwise("")
    session = lambda x: F.when(x["o_orderkey"] % 3 == 0, F.concat(F.lit("<h3>S"), x["o_orderkey"].cast("string"), F.lit("</h3>"))).otherwise("")
    return F.array_join(F.transform(rows, lambda x, i: F.concat(year(x, i), session(x), _link(x))), "\n")


def _grouped(rows: Column, open_: Column | str, close: str) -> Column:
    """Items of each priority between what ``open_`` gives for the first of it and ``close``."""
    first = lambda x, i: (i == 0) | (F.get(rows, i - 1)["o_orderpriority"] != x["o_orderpriority"])
    return F.concat(F.array_join(F.transform(rows, lambda x, i: F.concat(F.when(first(x, i), F.concat(F.when(i > 0, close).otherwise(""), open_(x))).otherwise(""), F.lit("<li>"), _link(x), F.lit("</li>"))), ""), F.lit(close))


def _panels(rows: Column) -> Column:
    return _grouped(rows, lambda x: F.concat(F.lit('<div class="panel"><h4 class="panel-title">'), x["o_orderpriority"], F.lit("</h4><ul>")), "</ul></div>")


def _openers(rows: Column) -> Column:
    number = lambda x: F.substring(x["o_orderpriority"], 1, 1)
    heads = F.array_join(F.transform(F.array_distinct(F.transform(rows, lambda x: x["o_orderpriority"])), lambda p: F.concat(F.lit('<button data-target="#p'), F.substring(p, 1, 1), F.lit('">'), p, F.lit("</button>"))), "")
    return F.concat(heads, _grouped(rows, lambda x: F.concat(F.lit('<div id="p'), number(x), F.lit('"><ul>')), "</ul></div>"))


_HEADERS = {"year": "h2", "session": "h3"}
_BY_PRIORITY = ("o_orderpriority", "o_orderkey")


def hub_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links under two levels of headers, the lower one ended by the higher."""
    return listings.carried_levels(_orders(spark, sf_dir, _hub), _HEADERS, "a", "o_custkey").drop("pos")


def panel_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in the panels of an accordion."""
    return listings.panels(_orders(spark, sf_dir, _panels, _BY_PRIORITY), "div.panel", "h4.panel-title", "a", "o_custkey").drop("pos")


def target_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in elements that buttons open."""
    return listings.targets(_orders(spark, sf_dir, _openers, _BY_PRIORITY), "button", "a", "o_custkey").drop("pos")


def grid_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a four-column table."""
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = lambda x: F.concat(F.lit("<tr>"), cell(x["o_orderkey"].cast("string")), cell(x["day"]), cell(x["o_orderstatus"]), cell(_link(x)), F.lit("</tr>"))
    made = lambda rows: F.concat(F.lit('<table class="grid"><tr><th>Key</th><th>Day</th><th>Status</th><th>File</th></tr><tr><td colspan="4">none</td></tr>'), F.array_join(F.transform(rows, row), ""), F.lit("</table><table><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"))
    rows = listings.table_listing(_orders(spark, sf_dir, made), "table.grid", ("number", "day", "status", "file"), "o_custkey")
    return rows.withColumn("published_at", dates.parse_date(F.col("day"))).drop("pos", "day")


def labelled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads in table rows, in list items and on their own, with the nearest label."""
    key = lambda x: x["o_orderkey"].cast("string")
    row = lambda x: F.concat(F.lit("<table><tr><td></td><td>Row "), key(x), F.lit("</td><td>"), _link(x), F.lit("</td></tr></table>"))
    item = lambda x: F.concat(F.lit("<ul><li>Item "), key(x), F.lit(" "), _link(x), F.lit("</li></ul>"))
    bare = lambda x: F.concat(F.lit('<a href="/o/'), key(x), F.lit('.pdf"><img src="i.png"></a>'))
    one = lambda x: F.when(x["o_orderkey"] % 4 == 0, row(x)).when(x["o_orderkey"] % 4 == 1, item(x)).when(x["o_orderkey"] % 4 == 2, bare(x)).otherwise(_link(x))
    return listings.labelled_files(_orders(spark, sf_dir, lambda rows: F.array_join(F.transform(rows, one), "")), key="o_custkey").drop("pos")


def dispatched_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three kinds, each read by its own rule."""
    hub, boxes, openers = (_orders(spark, sf_dir, made, order) for made, order in ((_hub, ("year", "o_orderkey")), (_panels, _BY_PRIORITY), (_openers, _BY_PRIORITY)))
    of = lambda rows, n, kind: rows.where(F.col("o_custkey") % 3 == n).withColumn("kind", F.lit(kind))
    pages = of(hub, 0, "hub").unionByName(of(boxes, 1, "panels")).unionByName(of(openers, 2, "targets"))
    readers = {
        "hub": lambda p: listings.carried(p, "h2", "a", "o_custkey").withColumnRenamed("header", "title"),
        "panels": lambda p: listings.panels(p, "div.panel", "h4.panel-title", "a", "o_custkey"),
        "targets": lambda p: listings.targets(p, "button", "a", "o_custkey"),
    }
    return listings.dispatched(pages, "kind", readers, ("o_custkey", "title", "href"))


_SHAPES = {  # per site: what opens the list, an item, what closes it; {k} is an order's number, {d} its day, {p} its day as a path
    "moh": ('<table class="x com-content-category__table"><thead><tr><th><a href="/sort">Title</a></thead><tbody>', '<tr><td class="list-title"><a href="/o/{k}">Order {k}</a><td class="list-date small"> {d} ', "</table>"),
    "mohe": ("<table class='k-js-documents-table'><tr><th>Title<th>Date", '<tr><td><a href="/o/{k}/file">Order {k}</a><td>{d}</td></tr><tr><td><a href="/o/{k}/view">no file</a></td></tr>', "</table>"),
    "moe": ("<TABLE ID=example><tbody>", '<TR><td><a href="/o/{k}">Order\n {k}</a></td><td>{d}</td></TR><tr><td><a href="/x/{k}">one cell</a></td></tr>', "</TABLE>"),
    "mof": ("<table>", '<tr class="cat-list-row1"><td><a href="/o/{k}">Order {k}</a></td><td class="list-date">{d}</td></tr>', '</table><div class="item-page"><a href="/berita/no">not asked</a></div>'),
    "mof_links": ('<div id="sp-main-body"><a href="/berita/0">short</a><ul>', '<li><a href="/berita/{k}">Order {k}</a>', '</ul></div><div class="item-page"><a href="/berita/no">elsewhere</a></div>'),
    "rmp": ("<div>", '<div class="sfnewsItem"><h2><a data-sf-field="Title" href="/o/{k}">Order {k}</a></h2><ul class="sfnewsMetaInfo"><li>by<li class="sfnewsDate">{d}</ul></div>', "</div>"),
    "rmp_paths": ("<ul>", '<li><a data-sf-field="Title" href="/o/{p}/{k}">Order {k}</a>', "</ul>"),
    "rmp_publications": ('<table class="RadGrid rgMasterTable"><tr><td>head</td></tr><tbody>', '<tr><td><a class="sfdownloadLink" href="/docs/default-source/{k}.pdf">Muat turun</a></td><td></td><td>Order {k}</td></tr>', "</tbody></table>"),
    "mcmc": ("<main>", '<div class="row article-list-box"><a href="/i/{k}"><img src=x></a><div class="article-list-content"><h5><a href="/o/{k}">Order {k}</a></h5><div class="date">{d}</div><a class="btn" href="/o/{k}.pdf">PDF</a></div></div>', "</main>"),
    "mcmc_media": ("<div>", '<a class="media-box" href="/o/{k}"><div class="media-caption"><h4>Order {k}</h4>more</div></a>', "</div>"),
    "idfr": ('<div itemprop="articleBody"><a href="/no">no</a>', '<div class="sppb-feature-box-title"><a href="/o/{k}">Order {k}</a></div>', "</div>"),
    "idfr_body": ('<a href="/no">no</a><div itemprop="articleBody"><a href="#top">up</a>', '<p><a href="/o/{k}">Order {k}</a>', "</div>"),
    "dewan_selangor": ("<main>", '<article><a href="/t/{k}">thumb</a><h2 class="post entry-title"><a href="/o/{k}">Order {k}</a></h2><time datetime="{d}">some day</time></article>', "</main>"),
    "dewan_selangor_links": ("<ul>", '<li><a class="post-title" href="/o/{k}">Order {k}</a>', "</ul>"),
    "dewan_johor": ("<article><h2><a href='/no'>other</a></h2></article>", '<article class="et_pb_post"><h2 class="entry-title"><a href="/o/{k}">Order {k}</a></h2><p><span class="published">{d}</span></article>', ""),
}
_SHAPE = list(_SHAPES)


def site_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the items of all known sites' listings, each site in the forms its rules know, with unclosed cells and
    items, sort links, thumbnails and a repeated first item."""
    filled = lambda shape, x: F.replace(F.replace(F.replace(F.lit(shape), F.lit("{k}"), x["o_orderkey"].cast("string")), F.lit("{d}"), x["day"]), F.lit("{p}"), F.replace(x["day"], F.lit("-"), F.lit("/")))
    made = lambda shape: lambda rows: F.concat(F.lit(shape[0]), F.array_join(F.transform(F.concat(rows, F.slice(rows, 1, 1)), lambda x: filled(shape[1], x)), "\n"), F.lit(shape[2]))
    number = F.pmod("o_custkey", F.lit(len(_SHAPE)))
    every = lambda rows: F.coalesce(*[F.when(number == i, made(_SHAPES[name])(rows)) for i, name in enumerate(_SHAPE)])
    sites = F.array(*[F.lit(next(site for site in sorted(listings.SITES, key=len, reverse=True) if name.startswith(site))) for name in _SHAPE])
    pages = _orders(spark, sf_dir, every).withColumn("site", F.get(sites, number.cast("int")))
    return listings.listings_by(pages, listings.SITES, "site", "o_custkey").drop("pos")


def attached_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as downloads in attachment boxes, some with encoded addresses, labelled by what is near."""
    k = lambda x: x["o_orderkey"].cast("string")
    encoded = lambda x: F.lower(F.hex(F.base64(F.concat(F.lit(f"{BASE}/d/"), k(x), F.lit(".pdf")).cast("binary"))))
    href = lambda x: F.when(x["o_orderkey"] % 3 == 0, encoded(x)).otherwise(F.concat(F.lit("/d/"), k(x), F.lit(".pdf")))
    one = lambda x: F.concat(F.lit("<tr><td>Order "), k(x), F.lit("<td>&nbsp;<td><a href="), href(x), F.lit(">PDF</a>"))
    made = lambda rows: F.concat(F.lit('<a href="/d/outside.pdf">no</a><div class="container_attachments"><table>'), F.array_join(F.transform(rows, one), ""), F.lit("</table></div>"))
    return listings.labelled_files(_orders(spark, sf_dir, made), "div.container_attachments", key="o_custkey").drop("pos")


def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next page of every customer's listing, marked in three ways."""
    n = F.col("c_custkey")
    mark = F.when(n % 3 == 0, '<link rel="next" href="?page=2">').when(n % 3 == 1, '<a class="page next" href="?page=2">2</a>').otherwise('<a href="/x">1</a><a href="?page=2">Seterusnya</a>')
    pages = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(f"{BASE}/list/"), n.cast("string")).alias("url"), F.concat(F.lit("<body>"), mark, F.lit("</body>")).alias("html"))
    return listings.next_page(pages, key="c_custkey")


def nested_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of nations' indexes of customers' maps of orders, followed from the top."""
    entry = lambda tag, loc: F.concat(F.lit(f"<{tag}><loc>"), loc, F.lit(f"</loc></{tag}>"))
    at = lambda kind, c: F.concat(F.lit(f"{BASE}/{kind}/"), F.col(c).cast("string"))
    joined = lambda tag, x: F.concat(F.lit("<x>"), F.array_join(F.collect_list(entry(tag, x)), ""), F.lit("</x>")).alias("xml")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(joined("url", at("o", "o_orderkey"))).select(at("c", "o_custkey").alias("url"), "xml")
    nations = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(joined("sitemap", at("c", "c_custkey"))).select(at("n", "c_nationkey").alias("url"), "xml")
    top = table(spark, sf_dir, "nation").groupBy().agg(joined("sitemap", at("n", "n_nationkey"))).select(F.lit(f"{BASE}/top").alias("url"), "xml")  # 25 nations
    return feeds.all_sitemap_urls(top.select("url"), top.unionByName(nations).unionByName(orders)).select("loc")


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers reached from the first one over links to twice and three times their number."""
    n = F.col("c_custkey")
    both = table(spark, sf_dir, "customer").select(n.cast("long").alias("url"), F.explode(F.array((n * 2).cast("long"), (n * 3).cast("long"))).alias("link"))
    edges = both.join(table(spark, sf_dir, "customer").select(n.cast("long").alias("link")).hint("merge"), "link", "left_semi")
    return links.crawl(both.where("url = 1").select("url").distinct(), edges.select("url", "link"))


def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a series' answers, bare and wrapped, under a filter for some customers."""
    one = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderstatus").alias("state"), F.col("o_orderkey").alias("n"))
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(one)).alias("list"))
    k = F.col("o_custkey")
    body = F.when(k % 3 == 0, F.col("list")).when(k % 3 == 1, F.concat(F.lit('{"data":'), "list", F.lit("}"))).otherwise('{"error":"none"}')
    rows = feeds.series_rows(per.select("o_custkey", F.when(k % 2 == 0, "O@state").alias("asked"), body.alias("json")), "date:string,state:string,n:long")
    return rows.where(feeds.series_filter(F.col("asked"), "state")).drop("asked")


def linked_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as an answer with marks, with and without a live citation."""
    said = F.concat("role", F.lit(" [3] says [general Knowledge] so [data.gov.my] and data.gov.my."))
    return _messages(spark, sf_dir).select("id", text.linked_answer(said, F.when(F.col("turn") % 2 == 0, F.lit(4))).alias("shown"))


def record_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record ids and archive paths of every document."""
    k, day = F.col("doc_id").cast("string"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int"))
    url, sha = F.concat(F.lit(f"{BASE}/"), k), F.sha2(k.cast("binary"), 256)
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("dir/Laporan ké (1) "), k, F.lit(".pdf"))).when(F.col("doc_id") % 3 == 1, F.lit("")).otherwise(F.concat(F.lit("v1.2."), k))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        urls.language_record_id(url, F.col("lang")).alias("by_language"),
        urls.payload_record_id(sha, F.concat_ws("-", F.md5(k.cast("binary")), F.lit("x"))).alias("by_payload"),
        urls.archive_path_by_type(F.col("source"), day, sha, name).alias("by_type"),
        urls.archive_path_by_month(F.lit("a/gov-my/b"), day, sha, name).alias("by_month"),
    )


def shown_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names as page titles between prefixes and site names, without them."""
    k = F.col("p_partkey")
    given = F.concat(F.when(k % 3 == 0, "KPM | ").when(k % 3 == 1, "Kementerian Pendidikan Malaysia | ").otherwise(""), "p_name", F.when(k % 4 == 0, " - Site | X").when(k % 4 == 1, " – Site").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", text.without_prefix(given).alias("bare"), text.listing_title(text.without_prefix(given)).alias("title"))


def asked_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types asked for as datasets: clamped limits, and what is answered to unknown ones."""
    known = F.array(F.lit("view"), F.lit("click"))
    limit = F.when(F.col("event_id") % 3 == 0, F.col("event_id")).cast("long")
    return table(spark, sf_dir, "events").select("event_id", text.clamped_limit(limit, 10).alias("row_limit"), text.unknown_dataset(F.col("event_type"), known).alias("said"))


def piece_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every document's chunk, its own keys over the document's."""
    k = F.col("doc_id")
    own = F.create_map(F.lit("agency"), F.col("source"), F.lit("title"), F.lit("old"))
    at = F.array(F.create_map(F.lit("row_number"), k.cast("string")))
    made = chunking.chunk_metadata(own, F.lit("pdf"), F.when(k % 2 == 0, F.concat(F.lit("T"), k.cast("string"))), at, F.lit(1), k % 3 == 0)
    return table(spark, sf_dir, "documents").select("doc_id", made.alias("metadata"), F.length(chunking.context_request(F.coalesce("text", F.lit("")))).alias("request_chars"))


def worth_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of the orders that have several, as rows worth a scorer's call."""
    return retrieval.to_score(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("rank")))


def name_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned names, hex links, codes, initials, decoded names and catalogue texts of every customer."""
    k, n = F.col("c_custkey"), F.col("c_custkey").cast("string")
    link = F.concat(F.lit(f"{BASE}/"), n)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        urls.versioned_name(F.concat(F.lit("a.b"), n, F.when(k % 2 == 0, ".pdf").otherwise("")), F.when(k % 3 > 0, F.lit("2024-02-03").cast("date"))).alias("versioned"),
        urls.hex_link(F.when(k % 2 == 0, F.lower(F.hex(F.base64(link.cast("binary"))))).otherwise(link)).alias("link"),
        text.language_code(F.when(k % 3 == 0, "MY").when(k % 3 == 1, "En")).alias("language"),
        text.vector_literal(F.array(k / 4, F.lit(0.1), F.lit(-2.0))).alias("vector"),
        text.percent_decoded(F.concat(F.lit("Laporan 20a 2Fb"), n)).alias("decoded"),
        text.initials(F.concat(F.lit("ana.b"), n, F.lit("_c@h.my"))).alias("initials"),
        text.date_and_title(F.concat(F.lit("3 Mac 2024\n Title "), n, F.lit("\n\nmore"))).alias("d"),
        text.sorted_json(text.merged_map(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), n), F.create_map(F.lit("b"), F.lit("2")))).alias("json"),
        feeds.catalog_summary(F.concat(F.lit("T"), n), F.lit("D"), F.array(F.lit("x"), F.lit("y")), F.lit("daily"), F.lit("prices")).alias("catalogue"),
    ).select("*", F.col("d.date").alias("date"), F.col("d.title").alias("title")).drop("d")


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against the one of the next number: inner product, norm and cosine."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    beside = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    met = rows.join(beside, "vec_id")
    return met.select("vec_id", F.round(vectors.dot(F.col("embedding"), F.col("other")), 6).alias("dot"), F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), F.round(vectors.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def fair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ranked rows of orders: where none has a similarity, those of a fair word rank; downloads of ten
    bytes or more stay."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("rank"), F.when(F.col("l_orderkey") % 2 == 0, F.col("l_discount")).otherwise(0.0).alias("similarity"), (F.col("l_quantity") / 100).alias("fts_rank"), F.concat(F.lit("12345678"), F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") > 2, "x").otherwise("")).alias("content"))
    return feeds.usable_downloads(retrieval.without_noise(rows)).drop("content")


def year_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the years in which each customer ordered, newest first."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    template = F.concat(F.lit("/c"), F.col("o_custkey").cast("string"), F.lit("/{year}/"))
    return per.select("o_custkey", F.posexplode(listings.year_pages(template, F.col("a"), F.col("b"))).alias("pos", "url"))


def expanded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as questions, with up to two other phrasings out of a generator's lines."""
    asked = _messages(spark, sf_dir).select(F.col("id").alias("question_id"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("query_text"))
    n = F.col("question_id")
    answers = asked.where(n % 3 > 0).select("question_id", F.concat("query_text", F.lit("\n\n first "), n.cast("string"), F.lit(" \nsecond\n"), F.when(n % 2 == 0, "second\n").otherwise("third\n")).alias("answer"))
    return retrieval.expanded_queries(asked, answers)


def robots_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as hosts with robots files: whether a path is closed, and how many sitemaps there are to read."""
    n = F.col("s_suppkey")
    said = F.when(n % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("User-agent: *\nDisallow: /private\nDisallow:\n"), F.when(n % 4 == 1, F.concat(F.lit("Sitemap: https://h/"), n.cast("string"), F.lit(".xml\nsitemap: https://h/x.xml\nSitemap: https://h/x.xml"))).otherwise("")))
    path = F.when(n % 3 == 0, "/private/a").otherwise("/open/private")
    return table(spark, sf_dir, "supplier").select("s_suppkey", feeds.disallowed(path, feeds.robots_rules(said)).alias("closed"), F.array_join(feeds.robots_sitemaps(said, F.lit("https://h")), " ").alias("sitemaps"))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events in sessions that half an hour without one ends (the table as a finished stream)."""
    return jobs.session_stream(table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")))


QUERIES = {
    f.__name__: f
    for f in (
        hub_listings, panel_listings, target_listings, grid_listings, labelled_files, dispatched_listings, next_pages, site_listings, attached_files, nested_sitemaps, crawled, series_rows, linked_answers, record_names, shown_titles,
        asked_datasets, piece_metadata, worth_scoring, year_listing_pages, expanded_questions, robots_gates, event_sessions, name_functions, vector_pairs, fair_rows,
    )
}

_O = "'/o/' || o_orderkey || '.pdf'"
ORACLE_SQL = {
    "hub_listings": f"""
SELECT o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS year, 'S' || max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END) OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS session,
  'Order ' || o_orderkey AS text, {_O} AS href FROM orders""",
    "panel_listings": f"SELECT o_custkey, o_orderpriority AS title, 'Order ' || o_orderkey AS text, {_O} AS href FROM orders",
    "target_listings": f"SELECT o_custkey, o_orderpriority AS title, 'Order ' || o_orderkey AS text, {_O} AS href FROM orders",
    "grid_listings": f"SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS number, o_orderstatus AS status, 'Order ' || o_orderkey AS file, '{BASE}' || {_O} AS link, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM orders",
    "labelled_files": f"SELECT o_custkey, '{BASE}' || {_O} AS link, CASE o_orderkey % 4 WHEN 0 THEN 'Row ' || o_orderkey WHEN 1 THEN 'Item ' || o_orderkey || ' Order ' || o_orderkey WHEN 2 THEN {_O} ELSE 'Order ' || o_orderkey END AS label FROM orders",
    "dispatched_listings": f"SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE o_orderpriority END AS title, {_O} AS href, CASE o_custkey % 3 WHEN 0 THEN 'hub' WHEN 1 THEN 'panels' ELSE 'targets' END AS kind FROM orders",
    "next_pages": f"SELECT c_custkey, '{BASE}/list/' || c_custkey || '?page=2' AS next_url FROM customer",
    "site_listings": f"""
WITH o AS (SELECT o_custkey, o_orderkey AS k, o_orderdate AS d, o_custkey % {len(_SHAPE)} AS n FROM orders), s AS (SELECT *, {_SHAPE!r}[n + 1] AS shape FROM o)
SELECT o_custkey, CASE WHEN shape LIKE '%\\_links' ESCAPE '\\' OR shape IN ('rmp_paths', 'idfr_body') THEN regexp_replace(shape, '_(links|paths|body)$', '') ELSE shape END AS site, 'Order ' || k AS title,
  '{BASE}' || CASE shape WHEN 'mohe' THEN '/o/' || k || '/file' WHEN 'mof_links' THEN '/berita/' || k WHEN 'rmp_paths' THEN '/o/' || strftime(d, '%Y/%m/%d') || '/' || k WHEN 'rmp_publications' THEN '/docs/default-source/' || k || '.pdf' ELSE '/o/' || k END AS link,
  CASE WHEN shape IN ('mof_links', 'rmp_publications', 'mcmc_media', 'idfr', 'idfr_body', 'dewan_selangor_links') THEN '' ELSE strftime(d, '%Y-%m-%d') END AS date_text, date_text AS published_at FROM s""",
    "attached_files": f"SELECT o_custkey, '{BASE}/d/' || o_orderkey || '.pdf' AS link, 'Order ' || o_orderkey AS label FROM orders",
    "nested_sitemaps": f"SELECT '{BASE}/o/' || o_orderkey AS loc FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey",
    "crawled": """
WITH RECURSIVE e AS (SELECT c_custkey AS a, unnest([c_custkey * 2, c_custkey * 3]) AS b FROM customer), k AS (SELECT a, b FROM e WHERE b IN (SELECT c_custkey FROM customer)),
t(url, level) AS (SELECT DISTINCT c_custkey, 0 FROM customer WHERE c_custkey = 1 UNION SELECT k.b, t.level + 1 FROM t JOIN k ON k.a = t.url)
SELECT CAST(url AS BIGINT) AS url, CAST(min(level) AS INTEGER) AS level FROM t GROUP BY 1""",
    "series_rows": "SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS state, CAST(o_orderkey AS BIGINT) AS n FROM orders WHERE o_custkey % 3 < 2 AND (o_custkey % 2 = 1 OR o_orderstatus = 'O')",
    "linked_answers": "SELECT conv_id * 1000 + turn AS id, role || ' `cite:3` says  so ' || CASE WHEN turn % 2 = 0 THEN '`cite:4` and `cite:4`.' ELSE ' and data.gov.my.' END AS shown FROM conversations",
    "record_names": f"""
WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, lang, source, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS day, sha256(CAST(doc_id AS VARCHAR)) AS sha FROM documents)
SELECT doc_id, substr(sha256('{BASE}/' || k || '#' || lang), 1, 16) AS by_language, substr(sha, 1, 16) || '-' || substr(md5(k), 1, 8) AS by_payload,
  'gov-docs/' || source || '/raw/' || strftime(day, '%Y/%m/%d') || '/' || sha || CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '' ELSE '.' || k END AS by_type,
  'a/gov-my/b/' || strftime(day, '%Y-%m') || '/' || substr(sha, 1, 16) || '_' || CASE doc_id % 3 WHEN 0 THEN 'Laporan_ké__1__' || k || '.pdf' WHEN 1 THEN 'document.bin' ELSE 'v1.2.' || k END AS by_month FROM d""",
    "shown_titles": "SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN ' - Site | X' WHEN 1 THEN ' – Site' ELSE '' END AS bare, p_name || CASE WHEN p_partkey % 4 = 0 THEN ' - Site' ELSE '' END AS title FROM part",
    "asked_datasets": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN least(event_id, 100) ELSE 10 END AS row_limit, CASE WHEN event_type NOT IN ('view', 'click') THEN 'Unknown dataset: ' || event_type || '. Available: view, click' END AS said FROM events",
    "piece_metadata": """
SELECT doc_id, '{"agency":"' || source || '","block_count":"1","file_type":"pdf",' || CASE WHEN doc_id % 3 = 0 THEN '"is_table":"true",' ELSE '' END || '"locators":"[{\\"row_number\\":\\"' || doc_id || '\\"}]","title":"' || CASE WHEN doc_id % 2 = 0 THEN 'T' || doc_id ELSE 'old' END || '"}' AS metadata,
  CAST(least(length(coalesce(text, '')), 6000) AS INTEGER) AS request_chars FROM documents""",
    "year_listing_pages": "WITH y AS (SELECT o_custkey, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders GROUP BY 1), e AS (SELECT o_custkey, a, b, unnest(range(0, b - a + 1)) AS i FROM y) SELECT o_custkey, CAST(i AS INTEGER) AS pos, '/c' || o_custkey || '/' || (b - i) || '/' AS url FROM e",
    "expanded_questions": """
WITH m AS (SELECT conv_id * 1000 + turn AS id FROM conversations), l AS (SELECT id, CASE WHEN id % 3 = 0 THEN ['q' || id] ELSE ['q' || id, 'first ' || id, 'second'] END AS x FROM m)
SELECT id AS question_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS query_no, unnest(x) AS query_text FROM l""",
    "robots_gates": """
SELECT s_suppkey, s_suppkey % 4 > 0 AND s_suppkey % 3 = 0 AS closed, CASE WHEN s_suppkey % 4 = 1 THEN 'https://h/' || s_suppkey || '.xml https://h/x.xml' ELSE 'https://h/sitemap.xml https://h/sitemap_index.xml https://h/wp-sitemap.xml https://h/sitemap-index.xml' END AS sitemaps FROM supplier""",
    "event_sessions": """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n FROM e)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS events FROM s GROUP BY user_id, n""",
    "name_functions": f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'a.b' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '.pdf' ELSE '' END WHEN c_custkey % 2 = 0 THEN 'a.b' || c_custkey || '_2024-02-03.pdf' ELSE 'a_2024-02-03.b' || c_custkey END AS versioned,
  '{BASE}/' || c_custkey AS link, CASE c_custkey % 3 WHEN 0 THEN 'ms' WHEN 1 THEN 'en' END AS language, '[' || printf('%.12g', c_custkey / 4.0) || ',0.1,-2]' AS vector, 'Laporan a/b' || c_custkey AS decoded, 'AB' AS initials,
  '{{"a":"' || c_custkey || '","b":"2"}}' AS json, 'T' || c_custkey || chr(10) || 'D' || chr(10) || 'Columns: x, y' || chr(10) || 'Frequency: daily' || chr(10) || 'Category: prices' AS catalogue, '3 Mac 2024' AS date, 'Title ' || c_custkey || ' more' AS title FROM customer""",
    "vector_pairs": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id, round(list_inner_product(a.v, b.v), 6) AS dot, round(sqrt(list_inner_product(a.v, a.v)), 6) AS norm, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
    "fair_rows": """
WITH r AS (SELECT l_orderkey AS query_id, l_linenumber AS rank, CASE WHEN l_orderkey % 2 = 0 THEN l_discount ELSE 0.0 END::DOUBLE AS similarity, CAST(l_quantity / 100 AS DOUBLE) AS fts_rank FROM lineitem), b AS (SELECT *, max(similarity) OVER (PARTITION BY query_id) AS best FROM r)
SELECT query_id, rank, similarity, fts_rank FROM b WHERE (best > 0 OR fts_rank >= 0.1) AND rank > 2""",
    "worth_scoring": "SELECT l_orderkey AS query_id, l_linenumber AS rank FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 1",
}
