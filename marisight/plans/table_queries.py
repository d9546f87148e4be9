"""Queries of URLs, dates, texts, pages, states, conversations and quotas over the given tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.functions import dates, text, urls
from marisight.operators import chunking, links, listings, state
from marisight.operators.tables import shared_folder, spread
from marisight.plans.retrieval_queries import table
from marisight.sources import feeds, html_blocks
from marisight.streaming import jobs

AS_OF = "2024-01-31"


def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical forms, identity, host and file name of every page's address."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.canonical(u).alias("canonical"),
        urls.canonical_compact(u).alias("compact"),
        urls.canonical_valid(u).alias("valid"),
        urls.bare_host(u).alias("host"),
        urls.content_type(u, "text/html").alias("content_type"),
        urls.is_document(u).alias("is_document"),
        urls.file_name(u).alias("file_name"),
        urls.record_id(u).alias("record_id"),
    )


def url_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of references resolved against every page's address."""
    base = F.col("url")
    forms = {"root": "/a/b.pdf", "fragment": "#part", "query": "?q=1", "scheme": "//other.example/x", "whole": "https://other.example/y", "up": "/a/../b/./c"}
    return table(spark, sf_dir, "pages").select("page_id", *[urls.absolute(F.lit(href), base).alias(name) for name, href in forms.items()])


def storage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of four key layouts, one per document, as an index manifest."""
    n = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(n, F.lit(365)).cast("int"))
    name = F.concat(F.lit("report_no-"), n.cast("string"), F.element_at(F.array(*[F.lit(x) for x in (".pdf", ".html", ".csv", ".txt", ".docx")]), (F.pmod(n, F.lit(5)) + 1).cast("int")))
    seven = F.concat_ws("/", F.lit("gov-docs"), "source", F.lit("raw"), F.date_format(day, "yyyy/MM/dd"), name)
    five = F.concat_ws("/", F.lit("archive/gov-my"), "source", F.date_format(day, "yyyy-MM"), name)
    four = F.concat_ws("/", F.lit("gov-my"), "source", F.date_format(day, "yyyy-MM"), name)
    key = F.when(n % 4 == 0, seven).when(n % 4 == 1, five).when(n % 4 == 2, four).otherwise(F.concat(F.lit("other/"), name))
    sha = F.when(n % 3 == 0, F.sha2(F.col("text").cast("binary"), 256))
    objects = table(spark, sf_dir, "documents").select(key.alias("key"), F.concat(F.lit('"e'), n.cast("string"), F.lit('"')).alias("etag"), sha.alias("sha256"), F.lit(None).cast("string").alias("version_id"), "n_chars")
    return feeds.manifest(objects.withColumnRenamed("n_chars", "size"))


def _malay(day: Column) -> Column:
    """A date as a Malay listing writes it."""
    names = F.array(*[F.lit(dates.MONTHS[m][0]) for m in range(1, 13)])
    return F.concat(F.dayofmonth(day).cast("string"), F.lit(" "), F.initcap(F.element_at(names, F.month(day))), F.lit(" "), F.year(day).cast("string"))


def date_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's date, written in seven ways and parsed again."""
    n, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    label = (
        F.when(n % 7 == 0, _malay(day))
        .when(n % 7 == 1, F.concat(F.lit("Tarikh: "), F.upper(_malay(day)), F.lit(" (ISNIN), Kuala Lumpur")))
        .when(n % 7 == 2, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(n % 7 == 3, F.date_format(day, "d/M/yyyy"))
        .when(n % 7 == 4, F.date_format(day, "MMMM d, yyyy"))
        .when(n % 7 == 5, F.date_format(day, "'Laporan' MMMM yyyy"))
        .otherwise(F.date_format(day, "'Edisi' yyyy"))
    )
    name = F.concat(F.lit("DR-"), F.date_format(day, "ddMMyyyy"), F.lit(".pdf"))
    until = F.concat(F.lit("Data sehingga "), _malay(day))
    return spread(table(spark, sf_dir, "orders")).select(
        "o_orderkey",
        dates.parse_date(label).alias("parsed"),
        dates.iso_date(F.date_format(day, "yyyy-MM-dd'T'10:00:00+08:00")).alias("iso"),
        dates.year_or_date(F.date_format(day, "yyyy")).alias("of_year"),
        dates.sitting_date(F.concat(_malay(day), F.lit(" (ISNIN)"))).alias("sitting"),
        dates.range_start(F.concat(F.dayofmonth(day).cast("string"), F.lit(" Mac - 31 Mac "), F.year(day).cast("string"))).alias("range_start"),
        dates.name_date(name).alias("of_name"),
        dates.path_date(F.concat(F.lit("/x/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/y"))).alias("of_path"),
        dates.title_date(until).alias("of_title"),
        dates.feed_date(F.date_format(day, "EEE, d MMM yyyy '00:00:00 +0000'")).alias("of_feed"),
        dates.since(F.date_format(day, "yyyy-MM-dd"), F.lit("1995-01-01").cast("date")).alias("is_recent"),
        dates.year_month(F.when(n % 2 == 0, day), F.lit("2020-02-01").cast("date")).alias("year_month"),
    )


def message_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, clarity, title and lengths of every conversation turn."""
    t = F.col("text")
    hinted = F.concat(t, F.when(F.col("turn") % 2 == 0, F.lit(" apakah bantuan?")).otherwise(F.lit("")))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        text.question_language(hinted).alias("language"),
        text.needs_clarification(t).alias("unclear"),
        text.conversation_title(t).alias("title"),
        text.short_title(F.concat(F.md5(t.cast("binary")), F.lit("_"), text.collapsed(t))).alias("short_title"),
        F.size(text.word_chunks(t)).alias("n_chunks"),
        F.array_join(text.citation_marks(F.concat(F.lit("See [1] and ["), F.col("turn").cast("string"), F.lit("]."))), ",").alias("marks"),
        urls.slug(t).alias("slug"),
    )


def document_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at 1400 characters, with the pieces around each piece."""
    cut = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.hard_split(F.coalesce("text", F.lit("")))).alias("chunk_index", "chunk_text"))
    rows = chunking.embed_batches(chunking.neighbour_context(cut, most=1_000_000), most_chars=8000)
    return rows.select("doc_id", "chunk_index", F.length("chunk_text").alias("n_chars"), F.md5(F.col("chunk_text").cast("binary")).alias("md5"), F.length("context").alias("context_chars"), "embed_batch")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document as blocks; lines of up to four words are headings carried down."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("block_idx", "text"))
    heading = F.when(F.size(F.split("text", " ")) <= 4, F.col("text"))
    w = Window.partitionBy("doc_id").orderBy("block_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind = F.when(F.contains("text", F.lit(" | ")), "table").otherwise("paragraph")
    return rows.select("doc_id", "block_idx", "text", F.last(heading, ignorenulls=True).over(w).alias("section_heading"), kind.alias("block_type"))


def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of every document: consecutive lines under one heading."""
    rows = chunking.section_texts(_lines(spark, sf_dir))
    return rows.select("doc_id", "section_no", "section_heading", "n_blocks", F.md5(F.col("section_text").cast("binary")).alias("md5"), F.length("parent_text").alias("parent_chars"))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed chunks of every document's lines."""
    return chunking.chunks(_lines(spark, sf_dir))


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of every page under their headings."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"), F.lit("html").alias("file_type"))
    rows = html_blocks.parsed(pages)
    return rows.select("page_id", F.posexplode("blocks").alias("block_idx", "b")).select("page_id", "block_idx", "b.block_type", "b.section_heading", "b.text")


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of every page's blocks."""
    return chunking.chunks(page_blocks(spark, sf_dir), "page_id")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    said = html_blocks.visible_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(said).alias("n_chars"), F.md5(said.cast("binary")).alias("md5"), links.page_title(F.col("html")).alias("title"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor of every page, resolved."""
    return links.anchors(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "pos", "href", "label", "link")


def _with_files(pages: DataFrame) -> DataFrame:
    return pages.withColumn("html", F.regexp_replace("html", 'href="/([a-z]{4,})"', 'href="/files/$1.pdf"'))


def page_document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads of every page, after longer lower-case links became files."""
    return links.document_links(_with_files(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).select("page_id", "pos", "link", "label")


def crawl_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and their downloads as candidates with content types and canonical addresses."""
    return links.candidates(_with_files(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).select("page_id", "content_type", "canonical_url")


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's navigation read as a listing: items of a list with their links."""
    rule = listings.Rule("nav li")
    return listings.listing(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rule).select("page_id", "title", "link", "published_at")


def footer_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's footer with the heading that stands before it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    under = listings.carried(pages, "h1", "footer")
    return under.select("page_id", "header")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset pages of a listing per customer, as many as it has orders of ten."""
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.ceil(F.count(F.lit(1)) / 10).cast("int").alias("n"))
    base = F.concat(F.lit("https://x.example/list?c="), F.col("o_custkey").cast("string"))
    return n.select("o_custkey", F.explode(listings.offset_pages(base, F.col("n"), 10)).alias("url"))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as RSS feeds per customer segment and read again."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    item = F.concat(F.lit("<item><title>"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))), F.lit("</title><link>https://x.example/"), F.col("o_orderkey").cast("string"), F.lit("</link><pubDate>"), F.date_format("o_orderdate", "d MMM yyyy '00:00:00 +0000'"), F.lit("</pubDate></item>"))
    xml = rows.groupBy("c_custkey").agg(F.concat(F.lit('<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://x.example/dc"><channel>'), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("xml"))
    return feeds.rss_items(xml).select("c_custkey", "title", "link", dates.feed_date(F.col("pub_date")).alias("published_at"))


def sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as sitemaps of a thousand addresses and read again."""
    entry = F.concat(F.lit("<url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>2024-01-0"), (F.pmod("page_id", F.lit(9)) + 1).cast("string"), F.lit("</lastmod></url>"))
    maps = table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 1000).alias("part")).agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    return feeds.sitemap_urls(maps).select("kind", "loc", "lastmod")


def catalog_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as CKAN datasets with resources and read again by format."""
    res = F.struct(F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.lit("https://x.example/f/"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ".csv").otherwise("")).alias("url"), F.when(F.col("p_size") % 3 == 0, "CSV").when(F.col("p_size") % 3 == 1, "PDF").otherwise("ZIP").alias("format"), F.col("p_name").alias("name"))
    sets = table(spark, sf_dir, "part").groupBy("p_brand", F.floor(F.col("p_partkey") / 1000).alias("k")).agg(F.collect_list(res).alias("resources"))
    one = F.struct(F.concat("p_brand", F.lit("-"), F.col("k").cast("string")).alias("id"), F.col("p_brand").alias("title"), F.lit("2024-05-01T00:00:00").alias("metadata_modified"), "resources")
    return feeds.ckan_resources(sets.select(F.to_json(F.struct(F.struct(F.array(one).alias("results")).alias("result"))).alias("json")), ("csv", "pdf"), "2024-01-01")


def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested field of every event's JSON, with fallbacks."""
    wrapped = F.concat(F.lit('{"a":{"b":'), "props", F.lit("}}"))
    return table(spark, sf_dir, "events").select("event_id", feeds.json_field(wrapped, "a.b.k").alias("k"), feeds.json_field(wrapped, "a.c").alias("missing"), feeds.first_of(feeds.json_field(wrapped, "a.c"), feeds.json_field(wrapped, "a.b.k")).alias("first"))


def brand_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each brand, a thousand keys at a time, as markdown tables."""
    rows = F.array_sort(F.collect_list(F.struct("p_partkey", "p_type", "p_size")))
    cells = F.concat(F.array(F.array(F.lit("Key"), F.lit("Type"), F.lit("Size"))), F.transform(rows, lambda r: F.array(r["p_partkey"].cast("string"), r["p_type"], r["p_size"].cast("string"))))
    out = table(spark, sf_dir, "part").groupBy("p_brand", F.floor(F.col("p_partkey") / 1000).alias("part")).agg(cells.alias("cells")).withColumn("table", html_blocks.markdown_table(F.col("cells")))
    return out.select("p_brand", "part", F.md5(F.col("table").cast("binary")).alias("md5"), F.length("table").alias("n_chars"))


def statistics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of events as a statistical series: the newest ten days of views."""
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return feeds.statistics(days, limit=10, end="2024-01-25", equals={"event_type": "view"})


# --- state -----------------------------------------------------------------------------------------


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as fetched files: the address of a file is shared by two documents, the content by its text."""
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        n.alias("seq"), F.col("source").alias("slug"), F.concat(F.lit("https://x.example/"), F.floor(n / 2).cast("string")).alias("canonical_url"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"),
        F.concat(F.lit("gov-docs/"), n.cast("string")).alias("spaces_path"), n.alias("loaded_at"),
    )


def classified_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents against the state that odd ones left."""
    rows = _fetches(spark, sf_dir)
    return state.classified(rows.where("seq % 2 = 0").select("seq", "slug", "canonical_url", "sha256"), rows.where("seq % 2 = 1"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.run_summary(classified_fetches(spark, sf_dir))


def upserted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves' rows by address, the later one standing, the path kept from the first."""
    rows = _fetches(spark, sf_dir)
    return state.upsert(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"), ["canonical_url"], ("spaces_path",))


def pending_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fetches(spark, sf_dir).select(F.col("spaces_path").alias("storage_path"), F.col("sha256").alias("version_token"))
    done = rows.where(F.md5(F.col("storage_path").cast("binary")) < "5")
    return state.pending(rows, done)


def active_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State counts after a run that saw the addresses of long documents."""
    rows = _fetches(spark, sf_dir).select("canonical_url").distinct()
    seen = table(spark, sf_dir, "documents").where("n_chars > 1500").select(F.concat(F.lit("https://x.example/"), F.floor(F.col("doc_id") / 2).cast("string")).alias("canonical_url"))
    return state.state_counts(state.with_activity(rows, seen))


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(_fetches(spark, sf_dir), "canonical_url", "sha256", "loaded_at")


def merged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit as a listing and orders' customers as a feed, by address."""
    address = lambda c: F.concat(F.lit("https://x.example/"), F.col(c).cast("string"))
    listing = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(address("c_custkey").alias("url"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_name")).alias("title"), F.lit("").alias("published_at"))
    feed = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d")).select(address("o_custkey").alias("url"), F.concat(F.lit("Feed "), F.col("o_custkey").cast("string")).alias("title"), F.date_format("d", "yyyy-MM-dd").alias("published_at"))
    return state.merged_listings(listing, feed)


# --- conversations, quotas, constraints ------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("conv_id").alias("conversation_id"), "turn", "role", "text")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation per customer; some have messages."""
    n = F.col("c_custkey")
    at = F.timestamp_add("HOUR", -F.pmod(n * 5, F.lit(400)), F.lit(f"{AS_OF} 12:00:00").cast("timestamp"))
    return table(spark, sf_dir, "customer").select(n.alias("id"), F.pmod(n, F.lit(50)).alias("user_id"), F.col("c_name").alias("title"), at.alias("updated_at"), F.when(n % 7 == 0, F.lit(True)).when(n % 7 == 1, F.lit(False)).alias("pinned"))


def conversation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.conversation_list(_conversations(spark, sf_dir), _messages(spark, sf_dir))
    bucket = state.conversation_bucket(F.col("updated_at"), F.col("pinned"), F.lit(AS_OF).cast("date"))
    return rows.where(state.title_matches(F.col("title"), F.lit("CUSTOMER"))).select("id", "user_id", "position", "message_count", bucket.alias("bucket"), "pinned")


def message_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.history_text(_messages(spark, sf_dir), 4)
    return rows.select("conversation_id", F.md5(F.col("history").cast("binary")).alias("md5"))


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(spark, sf_dir).where("role = 'assistant'")
    return rows.select(F.col("id").alias("message_id"), F.explode(F.array(F.lit(2), F.lit(1))).alias("citation_index"), F.pmod("id", F.lit(97)).alias("document_id"))


def messages_with_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.with_citations(_messages(spark, sf_dir), _citations(spark, sf_dir))
    return rows.select("id", "role", F.array_join(F.transform("citations", lambda c: F.concat_ws(":", c["citation_index"].cast("string"), c["document_id"].cast("string"))), ",").alias("cited"))


def visible_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations that owners of conversations see, through messages; conversations of no customer have no owner."""
    mine = _conversations(spark, sf_dir)
    return state.owned(_citations(spark, sf_dir), state.owned(_messages(spark, sf_dir), mine, "conversation_id"), "message_id")


def after_deletion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and citations left after some users' conversations are deleted."""
    doomed = _conversations(spark, sf_dir).where("user_id < 5")
    messages = state.without(_messages(spark, sf_dir), doomed, "conversation_id")
    cited = state.owned(_citations(spark, sf_dir), messages, "message_id")
    return messages.select("id", F.col("role").alias("what")).unionByName(cited.select(F.col("message_id").alias("id"), F.concat(F.lit("citation "), F.col("citation_index").cast("string")).alias("what")))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cost = state.token_cost(F.when(F.col("event_type") == "view", F.lit(800)), F.when(F.col("event_type") == "purchase", F.lit(1)))
    return events.select(F.col("event_id").alias("request_id"), "user_id", "ts", cost.cast("long").alias("tokens"))


def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.daily_usage(_requests(spark, sf_dir))
    return rows.withColumn("remaining", state.remaining(25, F.col("request_count")))


def quota_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.quota_decisions(_requests(spark, sf_dir), 2, 3000).select("request_id", "running_requests", "running_tokens", "allowed")


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as attachments of orders."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").alias("pos"), F.pmod("l_partkey", F.lit(3)).cast("string").alias("name"), F.floor(F.col("l_extendedprice") * 200).alias("size"))
    return state.accepted_attachments(rows)


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of documents and their labels."""
    rules = {"language": F.col("lang").isin("en", "fr", "de"), "length": F.col("n_chars") == F.length("text"), "size": F.col("n_chars") < 20_000, "source": F.col("source").rlike("^src[0-9]$")}
    return state.violations(table(spark, sf_dir, "documents"), "doc_id", rules)


# --- streams ---------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, make, keys: tuple[str, ...] = ()) -> DataFrame:
    """What a stream over all events has written when nothing is left to read: rows as they were appended, or, with
    ``keys``, the last state of each key."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    made = make(jobs.event_stream(spark, f"{sf_dir}/[e]vents.parquet", table(spark, sf_dir, "events")))
    sink = jobs.KeyedSink(at, keys)
    jobs.run_available(made, f"{at}/state", sink, "update" if keys else "append").awaitTermination()
    return sink.table(spark, made.schema) if keys else sink.rows(spark, made.schema).drop("batch")


def streamed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents indexed as they stream in: cut at 1400 characters, in batches for embedding, kept by piece."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    files = jobs.event_stream(spark, f"{sf_dir}/[d]ocuments.parquet", docs).select(F.col("doc_id").cast("string").alias("storage_path"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("version_token"), "doc_id", "text")

    def cut(rows: DataFrame) -> DataFrame:
        pieces = rows.select("doc_id", F.posexplode(chunking.hard_split(F.coalesce("text", F.lit("")))).alias("chunk_index", "chunk_text"))
        made = chunking.embed_batches(chunking.indexable(pieces, 1000), most_chars=5000)
        return made.select("doc_id", "chunk_index", F.md5(F.col("chunk_text").cast("binary")).alias("md5"), "embed_batch")

    sink = jobs.KeyedSink(f"{at}/index", ("doc_id", "chunk_index"))
    jobs.index_stream(files, cut, sink, f"{at}/state").awaitTermination()
    return sink.table(spark, cut(docs.select("doc_id", "text")).schema)


def streamed_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage per user and day from a stream of all events."""
    cost = F.when(F.col("event_type") == "view", F.lit(800)).otherwise(F.lit(1200)).cast("long")
    return _streamed(spark, sf_dir, lambda e: jobs.usage_stream(e.select("user_id", F.col("ts").cast("timestamp").alias("ts"), cost.alias("tokens"))), ("usage_date", "user_id"))


def streamed_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on all events as requests, taken as they stream in."""
    cost = state.token_cost(F.when(F.col("event_type") == "view", F.lit(800)), F.when(F.col("event_type") == "purchase", F.lit(1))).cast("long")
    return _streamed(spark, sf_dir, lambda e: jobs.quota_stream(e.select(F.col("event_id").alias("request_id"), "user_id", F.col("ts").cast("timestamp").alias("ts"), cost.alias("tokens")), 2, 3000), ("request_id",))


def streamed_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net ratings per document from a stream of all ratings joined with static citations."""
    rating = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1)
    cited = table(spark, sf_dir, "events").select(F.col("event_id").alias("message_id"), F.pmod("event_id", F.lit(197)).alias("document_id"))
    return _streamed(spark, sf_dir, lambda e: jobs.feedback_stream(e.select(F.col("event_id").alias("message_id"), rating.alias("rating")).where("rating is not null"), cited), ("document_id",))


def streamed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's kinds of events once, as versions of one object, from a stream of all events."""
    return _streamed(spark, sf_dir, lambda e: jobs.fingerprints(e.select(F.col("user_id").cast("string").alias("storage_path"), F.col("event_type").alias("version_token"))))


_FETCHES = """
f AS (SELECT doc_id AS seq, source AS slug, 'https://x.example/' || (doc_id // 2) AS canonical_url, sha256(coalesce(text, '')) AS sha256, 'gov-docs/' || doc_id AS spaces_path, doc_id AS loaded_at FROM documents)
"""
_CLASSIFIED = (
    _FETCHES
    + """, st AS (SELECT * FROM f WHERE seq % 2 = 1), kn AS (SELECT canonical_url, sha256 AS o FROM st), sto AS (SELECT sha256, arg_min(spaces_path, canonical_url) AS p FROM st GROUP BY 1),
c AS (SELECT f.seq, f.slug, f.canonical_url, f.sha256, kn.o, sto.p, row_number() OVER (PARTITION BY f.sha256 ORDER BY f.seq) AS turn
      FROM f LEFT JOIN kn USING (canonical_url) LEFT JOIN sto ON sto.sha256 = f.sha256 WHERE f.seq % 2 = 0),
cl AS (SELECT seq, slug, canonical_url, sha256, CASE WHEN o = sha256 THEN 'known_url' WHEN o IS NOT NULL THEN 'changed' WHEN p IS NOT NULL OR turn > 1 THEN 'duplicate' ELSE 'new' END AS kind,
       CASE WHEN o IS NOT NULL THEN 'known_url' WHEN p IS NOT NULL OR turn > 1 THEN 'duplicate' ELSE 'new' END AS compat, p AS reused_path FROM c)
"""
)
_MESSAGES = "m AS (SELECT conv_id * 1000 + turn AS id, conv_id AS conversation_id, turn, role, text FROM conversations)"
_CONV = f"cv AS (SELECT c_custkey AS id, c_custkey % 50 AS user_id, c_name AS title, TIMESTAMP '{AS_OF} 12:00:00' - to_hours(CAST((c_custkey * 5) % 400 AS INTEGER)) AS updated_at, CASE c_custkey % 7 WHEN 0 THEN true WHEN 1 THEN false END AS pinned FROM customer)"
_CITED = "ci AS (SELECT id AS message_id, unnest([2, 1]) AS citation_index, id % 97 AS document_id FROM m WHERE role = 'assistant')"
_REQUESTS = "r AS (SELECT event_id AS request_id, user_id, ts, CAST(CASE WHEN event_type = 'view' THEN 800 ELSE 1200 END + CASE WHEN event_type = 'purchase' THEN 2000 ELSE 0 END AS BIGINT) AS tokens FROM events)"
_LINES = """
l AS (SELECT doc_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS block_idx, unnest(x) AS text FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
h AS (SELECT *, last_value(CASE WHEN len(string_split(text, ' ')) <= 4 THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block_idx ROWS UNBOUNDED PRECEDING) AS section_heading FROM l),
s0 AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR section_heading IS DISTINCT FROM lag(section_heading) OVER w THEN 1 ELSE 0 END AS turn FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY block_idx)),
s AS (SELECT *, CAST(sum(turn) OVER (PARTITION BY doc_id ORDER BY block_idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section_no FROM s0)
"""
_ANCHORS = """
a AS (SELECT page_id, url, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS tag FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS t FROM pages)),
b AS (SELECT page_id, url, pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_extract(tag, '>([^<]*)<', 1), '\\s+', ' ', 'g')) AS label, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root FROM a)
"""

QUERIES = {
    f.__name__: f
    for f in (
        url_functions, url_resolution, storage_manifest, date_labels, message_functions, document_pieces, document_sections, document_chunks, page_blocks, page_chunks, page_text, page_links,
        page_document_links, page_listing, footer_headings, listing_pages, crawl_candidates, feed_items, sitemap_pages, catalog_resources, event_properties, brand_tables, statistics_rows, classified_fetches, run_summary, upserted_state,
        pending_objects, active_state, latest_versions, merged_listings, conversation_list, message_history, messages_with_citations, visible_citations, after_deletion, daily_usage, quota_decisions,
        attachments, violations, streamed_usage, streamed_quota, streamed_feedback, streamed_fingerprints, streamed_index,
    )
}

ORACLE_SQL = {
    "url_functions": """
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS scheme FROM pages),
c AS (SELECT *, regexp_replace(host, '^www\\.', '') AS bare, regexp_replace(path, '/+$', '') AS cut,
  array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS kept FROM p)
SELECT page_id, 'https://' || host || path || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical,
  'https://' || bare || CASE WHEN cut = '' THEN '/' ELSE cut END || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS compact,
  scheme || '://' || host || cut || CASE WHEN q = '' THEN '' ELSE '?' || q END AS valid, bare AS host, 'text/html' AS content_type, false AS is_document,
  coalesce(nullif(list_last(string_split(path, '/')), ''), 'document') AS file_name, substr(sha256(url), 1, 24) AS record_id FROM c""",
    "url_resolution": """
WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) AS root, regexp_extract(url, '^([a-zA-Z]+):', 1) AS scheme, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, root || '/a/b.pdf' AS root, regexp_replace(url, '#.*$', '') || '#part' AS fragment, root || path || '?q=1' AS query, scheme || '://other.example/x' AS scheme, 'https://other.example/y' AS whole, root || '/b/c' AS up FROM p""",
    "storage_manifest": """
WITH d AS (SELECT doc_id AS n, source, text, n_chars, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS day, ['.pdf', '.html', '.csv', '.txt', '.docx'][CAST(doc_id % 5 AS INTEGER) + 1] AS ext FROM documents),
k AS (SELECT *, 'report_no-' || n || ext AS name, CASE n % 4 WHEN 0 THEN 'gov-docs/' || source || '/raw/' || strftime(day, '%Y/%m/%d') || '/' WHEN 1 THEN 'archive/gov-my/' || source || '/' || strftime(day, '%Y-%m') || '/' WHEN 2 THEN 'gov-my/' || source || '/' || strftime(day, '%Y-%m') || '/' END AS folder FROM d)
SELECT folder || name AS storage_path, source AS agency, strftime(day, '%Y-%m') AS year_month, name AS file_name, substr(ext, 2) AS file_type,
  CASE WHEN n % 3 = 0 THEN sha256(text) ELSE 'e' || n END AS version_token, n_chars AS size, 'report no ' || n AS title FROM k WHERE folder IS NOT NULL AND ext <> '.txt'""",
    "date_labels": """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 5 THEN strftime(d, '%Y-%m-01') WHEN 6 THEN strftime(d, '%Y-01-01') ELSE strftime(d, '%Y-%m-%d') END AS parsed,
  strftime(d, '%Y-%m-%d') AS iso, strftime(d, '%Y-01-01') AS of_year, strftime(d, '%Y-%m-%d') AS sitting, strftime(d, '%Y-03-%d') AS range_start, strftime(d, '%Y-%m-%d') AS of_name, strftime(d, '%Y-%m-%d') AS of_path,
  strftime(d, '%Y-%m-%d') AS of_title, strftime(d, '%Y-%m-%d') AS of_feed, d >= DATE '1995-01-01' AS is_recent, CASE WHEN o_orderkey % 2 = 0 THEN strftime(d, '%Y-%m') ELSE '2020-02' END AS year_month FROM o""",
    "message_functions": """
WITH c AS (SELECT conv_id, turn, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s, list_filter(string_split_regex(replace(lower(text || CASE WHEN turn % 2 = 0 THEN ' apakah bantuan?' ELSE '' END), '?', ' '), '\\s+'), lambda w: w <> '') AS w FROM conversations)
SELECT conv_id, turn, CASE WHEN len(list_filter(w, lambda x: x IN ('apa','apakah','bagaimana','bantuan','dasar','kerajaan','pelajar','untuk','boleh','adakah','syarat','permohonan','keluarga','pekerja'))) >= 2 THEN 'ms' ELSE 'en' END AS language,
  len(list_filter(string_split(lower(s), ' '), lambda x: x <> '')) <= 1 OR starts_with(lower(s), 'tell me about') OR starts_with(lower(s), 'overview of') OR starts_with(lower(s), 'explain policy') OR starts_with(lower(s), 'ceritakan tentang') AS unclear,
  substr(s, 1, 80) AS title, CASE WHEN trim(s) = '' THEN md5(text) || '_' || s WHEN length(s) > 50 THEN substr(s, 1, 47) || '...' ELSE s END AS short_title,
  CAST(ceil(len(string_split(text, ' ')) / 8.0) AS INTEGER) AS n_chunks, '1,' || turn AS marks,
  coalesce(nullif(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown-agency') AS slug FROM c""",
    "document_pieces": """
WITH RECURSIVE p AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(t, i * 1400 + 1, 1400) AS x FROM (SELECT doc_id, coalesce(text, '') AS t, unnest(range(0, greatest(CAST(ceil(length(coalesce(text, '')) / 1400.0) AS BIGINT), 1))) AS i FROM documents)
), b(doc_id, chunk_index, chars, batch) AS (
  SELECT doc_id, chunk_index, length(x), 0 FROM p WHERE chunk_index = 0
  UNION ALL SELECT p.doc_id, p.chunk_index, CASE WHEN chars + length(x) > 8000 THEN length(x) ELSE chars + length(x) END, CASE WHEN chars + length(x) > 8000 THEN batch + 1 ELSE batch END
  FROM b JOIN p ON p.doc_id = b.doc_id AND p.chunk_index = b.chunk_index + 1)
SELECT doc_id, chunk_index, CAST(length(x) AS INTEGER) AS n_chars, md5(x) AS md5, CAST(sum(length(x)) OVER w + 2 * (count(*) OVER w - 1) AS INTEGER) AS context_chars,
  b.batch AS embed_batch FROM p JOIN b USING (doc_id, chunk_index) WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
    "streamed_index": """
WITH RECURSIVE p0 AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(substr(t, i * 1400 + 1, 1400), 1, 1000) AS x, trim(substr(t, i * 1400 + 1, 1400), ' ') AS bare
  FROM (SELECT doc_id, coalesce(text, '') AS t, unnest(range(0, greatest(CAST(ceil(length(coalesce(text, '')) / 1400.0) AS BIGINT), 1))) AS i FROM documents)
), p AS (SELECT doc_id, chunk_index, x, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index) AS n FROM p0 WHERE bare <> ''
), b(doc_id, n, chars, batch) AS (
  SELECT doc_id, n, length(x), 0 FROM p WHERE n = 1
  UNION ALL SELECT p.doc_id, p.n, CASE WHEN chars + length(x) > 5000 THEN length(x) ELSE chars + length(x) END, CASE WHEN chars + length(x) > 5000 THEN batch + 1 ELSE batch END FROM b JOIN p ON p.doc_id = b.doc_id AND p.n = b.n + 1)
SELECT doc_id, chunk_index, md5(x) AS md5, batch AS embed_batch FROM p JOIN b USING (doc_id, n)""",
    "document_sections": f"""
WITH {_LINES}, g AS (SELECT doc_id, section_no, any_value(section_heading) AS section_heading, count(*) AS n_blocks, coalesce(string_agg(trim(text), chr(10) || chr(10) ORDER BY block_idx) FILTER (WHERE trim(text) <> ''), '') AS t FROM s GROUP BY 1, 2)
SELECT doc_id, section_no, section_heading, n_blocks, md5(t) AS md5, CAST(nullif(least(length(t), 3000), 0) AS INTEGER) AS parent_chars FROM g""",
    "document_chunks": f"""
WITH RECURSIVE {_LINES}, t AS (SELECT doc_id, block_idx, section_no, section_heading, trim(text) AS x, contains(text, ' | ') AS is_table FROM s WHERE trim(text) <> ''),
p AS (SELECT doc_id, section_no, section_heading, is_table, CASE WHEN is_table THEN x ELSE substr(x, i * 1400 + 1, 1400) END AS x, row_number() OVER (PARTITION BY doc_id ORDER BY block_idx, i) AS n
  FROM (SELECT *, unnest(range(0, CASE WHEN is_table THEN 1 ELSE CAST(ceil(length(x) / 1400.0) AS BIGINT) END)) AS i FROM t)),
f(doc_id, n, section_no, is_table, size, chunk) AS (
  SELECT doc_id, n, section_no, is_table, length(x), 0 FROM p WHERE n = 1
  UNION ALL SELECT doc_id, n, section_no, is_table, CASE WHEN fresh THEN more ELSE size + 2 + more END, CASE WHEN fresh THEN chunk + 1 ELSE chunk END
  FROM (SELECT p.doc_id, p.n, p.section_no, p.is_table, f.size, f.chunk, length(p.x) AS more, p.is_table OR f.is_table OR p.section_no <> f.section_no OR f.size + 2 + length(p.x) > 1400 AS fresh FROM f JOIN p ON p.doc_id = f.doc_id AND p.n = f.n + 1)),
u AS (SELECT doc_id, section_no, substr(string_agg(x, chr(10) || chr(10) ORDER BY block_idx), 1, 3000) AS parent_text FROM t GROUP BY 1, 2),
c AS (SELECT p.doc_id, chunk, any_value(p.section_no) AS section_no, any_value(p.section_heading) AS section_heading, bool_or(p.is_table) AS is_table, count(*) AS block_count, string_agg(x, chr(10) || chr(10) ORDER BY p.n) AS x FROM p JOIN f USING (doc_id, n) GROUP BY 1, 2)
SELECT doc_id, chunk AS chunk_index, CASE WHEN is_table AND section_heading <> '' THEN 'Table from section: ' || section_heading || chr(10) || chr(10) || x ELSE x END AS chunk_text, is_table, CAST(block_count AS INTEGER) AS block_count, section_heading, parent_text FROM c JOIN u USING (doc_id, section_no)""",
    "page_links": f"WITH {_ANCHORS} SELECT page_id, pos, href, label, root || href AS link FROM b",
    "page_document_links": f"WITH {_ANCHORS} SELECT page_id, pos, root || '/files/' || substr(href, 2) || '.pdf' AS link, label FROM b WHERE regexp_full_match(href, '/[a-z]{{4,}}') QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1",
    "page_listing": f"WITH {_ANCHORS} SELECT page_id, label AS title, root || href AS link, '' AS published_at FROM b QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1",
    "listing_pages": "WITH n AS (SELECT o_custkey, CAST(ceil(count(*) / 10.0) AS BIGINT) AS n FROM orders GROUP BY 1), p AS (SELECT o_custkey, unnest(range(0, n)) AS i FROM n) SELECT o_custkey, 'https://x.example/list?c=' || o_custkey || CASE WHEN i = 0 THEN '' ELSE '&start=' || (i * 10) END AS url FROM p",
    "crawl_candidates": f"""
WITH {_ANCHORS}, k AS (SELECT DISTINCT page_id, 'https://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) || '/files/' || substr(href, 2) || '.pdf' AS u FROM b WHERE regexp_full_match(href, '/[a-z]{{4,}}')),
o AS (SELECT page_id, CASE WHEN regexp_matches(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '\\.html$') THEN 'text/html' ELSE 'application/octet-stream' END AS content_type, 'https' || regexp_replace(regexp_replace(url, '#.*$', ''), '^https?', '') AS u FROM pages)
SELECT page_id, content_type, u AS canonical_url FROM o UNION ALL SELECT page_id, 'application/pdf', u FROM k""",
    "feed_items": "SELECT c_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Untitled' ELSE 'Order ' || o_orderkey END AS title, 'https://x.example/' || o_orderkey AS link, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM orders JOIN customer ON o_custkey = c_custkey",
    "sitemap_pages": "SELECT 'url' AS kind, url AS loc, '2024-01-0' || (page_id % 9 + 1) AS lastmod FROM pages",
    "catalog_resources": """
SELECT p_brand || '-' || (p_partkey // 1000) AS dataset_id, p_brand AS title, 'r' || p_partkey AS resource_id, 'https://x.example/f/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.csv' ELSE '' END AS url,
  CASE p_size % 3 WHEN 0 THEN 'csv' ELSE 'pdf' END AS format, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_partkey || '.csv' ELSE 'r' || p_partkey || '.' || CASE p_size % 3 WHEN 0 THEN 'csv' ELSE 'pdf' END END AS file_name FROM part WHERE p_size % 3 < 2""",
    "event_properties": "SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, '' AS missing, coalesce(json_extract_string(props, '$.k'), '') AS first FROM events",
    "brand_tables": """
WITH t AS (SELECT p_brand, p_partkey // 1000 AS part, '| Key | Type | Size |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || p_partkey || ' | ' || p_type || ' | ' || p_size || ' |', chr(10) ORDER BY p_partkey) AS t FROM part GROUP BY 1, 2)
SELECT p_brand, part, md5(t) AS md5, CAST(length(t) AS INTEGER) AS n_chars FROM t""",
    "statistics_rows": "SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1, 2 HAVING date <= '2024-01-25' ORDER BY 1 DESC LIMIT 10",
    "classified_fetches": f"WITH {_CLASSIFIED} SELECT * FROM cl",
    "run_summary": f"WITH {_CLASSIFIED} SELECT slug, count(*) FILTER (WHERE kind = 'new') AS new_count, count(*) FILTER (WHERE kind = 'changed') AS changed_count, count(*) FILTER (WHERE kind = 'duplicate') AS duplicate_count, count(*) FILTER (WHERE kind = 'known_url') AS known_url_count, count(*) AS total FROM cl GROUP BY ROLLUP (slug)",
    "upserted_state": f"WITH {_FETCHES} SELECT arg_max(seq, seq) AS seq, arg_max(slug, seq) AS slug, canonical_url, arg_max(sha256, seq) AS sha256, arg_min(spaces_path, seq) AS spaces_path, max(seq) AS loaded_at FROM f GROUP BY canonical_url",
    "pending_objects": f"WITH {_FETCHES} SELECT spaces_path AS storage_path, sha256 AS version_token FROM f WHERE md5(spaces_path) >= '5'",
    "page_text": """
WITH a AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'), '(?s)<!--.*?-->|<[^>]+>', chr(10), 'g') AS s FROM pages),
b AS (SELECT page_id, html, replace(replace(replace(replace(replace(s, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&') AS s FROM a),
c AS (SELECT page_id, html, array_to_string(list_filter(list_transform(flatten(list_transform(string_split(s, chr(10)), lambda x: string_split(trim(x), '  '))), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS t FROM b)
SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS md5, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1), '(?s)<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS title FROM c""",
    "footer_headings": """
SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1), '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS header FROM pages WHERE contains(html, '<footer')""",
    "active_state": "WITH u AS (SELECT doc_id // 2 AS k, bool_or(n_chars > 1500) AS active FROM documents GROUP BY 1) SELECT count(*) AS total, count(*) FILTER (WHERE active) AS active, count(*) FILTER (WHERE NOT active) AS inactive FROM u",
    "latest_versions": f"WITH {_FETCHES} SELECT canonical_url, arg_max(sha256, seq) AS sha256 FROM f GROUP BY 1",
    "merged_listings": """
WITH l AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS title FROM customer WHERE c_acctbal > 0), f AS (SELECT o_custkey AS k, 'Feed ' || o_custkey AS title, strftime(max(o_orderdate), '%Y-%m-%d') AS d FROM orders GROUP BY 1)
SELECT 'https://x.example/' || coalesce(l.k, f.k) AS url, coalesce(nullif(l.title, ''), f.title, '') AS title, coalesce(f.d, '') AS published_at FROM l FULL JOIN f ON l.k = f.k""",
    "conversation_list": f"""
WITH {_CONV}, {_MESSAGES}, n AS (SELECT conversation_id, count(*) AS c FROM m GROUP BY 1)
SELECT id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY coalesce(pinned, false) DESC, updated_at DESC, id) AS INTEGER) AS position,
  coalesce(c, 0) AS message_count, CASE WHEN coalesce(pinned, false) THEN 'pinned' WHEN d <= 0 THEN 'today' WHEN d = 1 THEN 'yesterday' WHEN d <= 7 THEN 'last_7_days' ELSE 'older' END AS bucket, pinned
FROM (SELECT *, date_diff('day', CAST(updated_at AS DATE), DATE '{AS_OF}') AS d FROM cv) LEFT JOIN n ON n.conversation_id = id WHERE contains(lower(title), 'customer')""",
    "message_history": f"WITH {_MESSAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY turn DESC) AS r FROM m QUALIFY r <= 4) SELECT conversation_id, md5(string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn)) AS md5 FROM r GROUP BY 1",
    "messages_with_citations": f"WITH {_MESSAGES} SELECT id, role, CASE WHEN role = 'assistant' THEN '1:' || (id % 97) || ',2:' || (id % 97) ELSE '' END AS cited FROM m",
    "visible_citations": f"WITH {_CONV}, {_MESSAGES}, {_CITED} SELECT message_id, citation_index, document_id FROM ci WHERE message_id IN (SELECT id FROM m WHERE conversation_id IN (SELECT id FROM cv))",
    "after_deletion": f"WITH {_CONV}, {_MESSAGES}, {_CITED}, k AS (SELECT * FROM m WHERE conversation_id NOT IN (SELECT id FROM cv WHERE user_id < 5)) SELECT id, role AS what FROM k UNION ALL SELECT message_id, 'citation ' || citation_index FROM ci WHERE message_id IN (SELECT id FROM k)",
    "daily_usage": f"WITH {_REQUESTS} SELECT user_id, CAST(ts AS DATE) AS usage_date, count(*) AS request_count, CAST(sum(tokens) AS BIGINT) AS tokens_budgeted, greatest(0, 25 - count(*)) AS remaining FROM r GROUP BY 1, 2",
    "quota_decisions": f"WITH {_REQUESTS}, w AS (SELECT *, count(*) OVER d AS running_requests, CAST(sum(tokens) OVER d AS BIGINT) AS running_tokens FROM r WINDOW d AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING)) SELECT request_id, running_requests, running_tokens, running_requests <= 2 AND running_tokens <= 3000 AS allowed FROM w",
    "attachments": """
WITH a AS (SELECT l_orderkey AS message_id, l_linenumber AS pos, CAST(l_partkey % 3 AS VARCHAR) AS name, CAST(floor(l_extendedprice * 200) AS BIGINT) AS size FROM lineitem),
b AS (SELECT * FROM a WHERE size <= 10485760 QUALIFY row_number() OVER (PARTITION BY message_id, name, size ORDER BY pos) = 1) SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY pos, name, size) <= 5""",
    "violations": """
SELECT doc_id AS key, 'language' AS rule FROM documents WHERE lang NOT IN ('en', 'fr', 'de') UNION ALL SELECT doc_id, 'length' FROM documents WHERE n_chars <> length(text)
UNION ALL SELECT doc_id, 'size' FROM documents WHERE n_chars >= 20000 UNION ALL SELECT doc_id, 'source' FROM documents WHERE NOT regexp_matches(source, '^src[0-9]$')""",
    "streamed_usage": "SELECT CAST(ts AS DATE) AS usage_date, user_id, count(*) AS request_count, CAST(sum(CASE WHEN event_type = 'view' THEN 800 ELSE 1200 END) AS BIGINT) AS tokens_budgeted FROM events GROUP BY 1, 2",
    "streamed_quota": f"WITH {_REQUESTS}, w AS (SELECT *, count(*) OVER d AS running_requests, CAST(sum(tokens) OVER d AS BIGINT) AS running_tokens FROM r WINDOW d AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING)) SELECT request_id, running_requests, running_tokens, running_requests <= 2 AND running_tokens <= 3000 AS allowed FROM w",
    "streamed_fingerprints": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS storage_path, event_type AS version_token FROM events",
    "streamed_feedback": "SELECT event_id % 197 AS document_id, count(*) FILTER (WHERE event_type = 'purchase') AS positive_count, count(*) FILTER (WHERE event_type = 'error') AS negative_count, CAST(sum(CASE event_type WHEN 'purchase' THEN 1 ELSE -1 END) AS BIGINT) AS net_score FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1",
}
