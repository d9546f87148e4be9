"""Queries of records, site settings, catalogues, ratings and index runs over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.functions import dates, text, urls
from marisight.operators import retrieval, state
from marisight.plans.retrieval_queries import table
from marisight.plans.table_queries import _conversations, _messages, storage_manifest
from marisight.sources import attachments as files
from marisight.sources import feeds, records

BASE = "https://x.example"
#: words of publication titles that documents are given in turn
_TITLES = ("Kenyataan Media", "Surat Siaran", "Laporan", "Pekeliling", "Ucapan", "Akta", "Press Release", "Notice")


def document_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of every document under a title of one of eight kinds."""
    given = F.array(*[F.lit(t) for t in _TITLES])[F.pmod("doc_id", F.lit(len(_TITLES))).cast("int")]
    title = F.concat(given, F.lit(" "), F.col("doc_id").cast("string"))
    address = F.concat(F.lit(f"{BASE}/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", text.document_kind(address, title).alias("kind"))


def allowed_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address with tracking and repeated parameters, for hosts allowed on every second page."""
    given = F.regexp_replace("url", "[?#].*$", "")
    url = F.concat(given, F.lit("/a%20b c~/"), F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.lit("?SessionID=9&b=2&a=0&utm_term=x&flag&a=1#part")))
    host = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("www."), urls.bare_host(url))).otherwise(F.lit("other.example"))
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_allowed(url, F.array(host)).alias("canonical"))


def catalogue_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that line items stand for, by order, against parts of the first brands as the catalogue."""
    number = lambda c: F.concat(F.lit("set"), F.col(c).cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("rank"), number("l_partkey").alias("dataset_id"))
    catalogue = table(spark, sf_dir, "part").where("p_brand < 'Brand#3'").select(number("p_partkey").alias("dataset_id"), F.col("p_name").alias("title"))
    return records.catalogue_matches(rows, catalogue)


def live_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest days of each kind of event as prompt text; the kinds are datasets, one more has no rows."""
    days = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset_id"), F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    rows = state.first_seen(days.withColumn("key", F.concat_ws(" ", "dataset_id", "date")), "key", "n").drop("key")
    rows = rows.withColumn("pos", F.datediff(F.lit("2100-01-01").cast("date"), F.to_date("date"))).where("date >= '2024-01-20'")
    entries = days.select("dataset_id").distinct().unionByName(spark.createDataFrame([("none",)], "dataset_id string"))
    entries = entries.select("dataset_id", F.concat(F.lit("Daily "), "dataset_id").alias("title"), F.lit("opendata").alias("endpoint"), F.lit("daily").alias("frequency"))
    out = records.live_texts(entries, rows, ("date", "n"))
    return out.select("dataset_id", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("md5"))


def index_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty objects of a key prefix in the order of their path, as an index run with both limits takes them."""
    return state.cut_to(storage_manifest(spark, sf_dir), "gov-docs/", 50).select("storage_path", "file_type")


def index_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of an index run over one prefix of the manifest, in which spreadsheets of text fail."""
    manifest = storage_manifest(spark, sf_dir)
    chosen = state.cut_to(manifest, "gov-docs/")
    outcomes = manifest.select("storage_path", (F.col("file_type") == "csv").alias("failed"), (F.floor(F.col("size") / 1400) + 1).alias("n_chunks"))
    return state.index_counters(manifest, chosen, outcomes)


def _submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    return table(spark, sf_dir, "events").select(F.pmod("event_id", F.lit(4000)).alias("message_id"), "user_id", rating.alias("rating"), F.struct("ts", "event_id").alias("at"))


def rated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of events submitted on top of ratings that were there."""
    before = table(spark, sf_dir, "events").select(F.pmod("event_id", F.lit(4000)).alias("message_id"), "user_id", F.lit(1).alias("rating")).where("message_id < 1000").distinct()
    return state.rated(before, _submitted(spark, sf_dir))


def conversation_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of the messages of each conversation with them, by user."""
    rows = state.rated(_submitted(spark, sf_dir).select("message_id", "user_id", "rating").where("false"), _submitted(spark, sf_dir))
    return state.conversation_feedback(_messages(spark, sf_dir), rows, F.lit(True))


def updated_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations after messages, renames and pins; changes of other users' conversations have no effect."""
    n = F.col("id")
    before = _conversations(spark, sf_dir).withColumn("language", F.when(n % 3 == 0, "en"))
    at = F.timestamp_add("MINUTE", F.col("turn"), F.lit("2024-03-01 00:00:00").cast("timestamp"))
    said = _messages(spark, sf_dir).select("conversation_id", F.when(F.col("turn") % 2 == 1, F.when(F.col("conversation_id") % 2 == 0, "ms").otherwise("en")).alias("language"), at.alias("at"))
    changes = before.select("id", F.when(n % 5 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")).alias("user_id"), F.when(n % 4 == 0, F.concat(F.lit("Renamed "), n.cast("string"))).alias("title"), F.when(n % 6 == 0, F.lit(True)).alias("pinned"))
    return state.changed(state.with_messages(before, said), changes).select("id", "user_id", "title", "pinned", "language", "updated_at")


def record_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of a collection, with fields in several places, read as items."""
    n, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00.000'Z'")
    title = F.concat(F.lit("Order "), n.cast("string"))
    record = F.struct(
        F.struct(F.when(n % 3 == 0, title).alias("name")).alias("head"), F.when(n % 3 == 1, title).alias("titleBM"), F.when(n % 2 == 0, day).alias("publishDate"), F.when(n % 4 == 1, F.date_format("o_orderdate", "yyyy")).alias("startDate"),
        F.struct(F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, F.concat(F.lit(f"{BASE}/f/"), n.cast("string"), F.lit(".pdf"))).otherwise(F.concat(F.lit(" /f/"), n.cast("string"), F.lit(".docx"))).alias("url")).alias("file"),
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(record).alias("json"))
    return records.record_items(rows, "head.name", None, "file.url", BASE, "1995-01-01")


def dataset_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as open-data search pages, a thousand keys at a time, read as candidates."""
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    res = F.struct(s.alias("id"), F.concat(F.lit(f"{BASE}/f/"), s, F.when(k % 2 == 0, ".pdf").otherwise("")).alias("url"), F.element_at(F.array(*[F.lit(x) for x in (" CSV", "pdf", "zip", "xlsx")]), (k % 4 + 1).cast("int")).alias("format"), F.when(k % 3 == 0, F.col("p_name")).otherwise("").alias("name"), F.lit(None).cast("string").alias("description"), F.when(k % 5 == 0, F.lit("2024-02-03T04:05:06")).alias("last_modified"))
    sets = table(spark, sf_dir, "part").groupBy("p_brand", F.floor(k / 1000).alias("part")).agg(F.collect_list(res).alias("resources"))
    one = F.struct(F.concat("p_brand", F.lit("-"), F.col("part").cast("string")).alias("id"), F.lower("p_brand").alias("name"), F.col("p_brand").alias("title"), F.lit("2024-01-01T00:00:00").alias("metadata_modified"), F.struct(F.col("p_brand").alias("name")).alias("organization"), "resources")
    pages = sets.select(F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.array(one).alias("results")).alias("result"))).alias("json"))
    return records.dataset_candidates(pages).drop("dataset_name")


def _application(props: Column) -> Column:
    data = F.to_json(F.struct(F.struct(props.alias("pageProps")).alias("props")))
    return F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script></html>"))


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as publication lists of customers' pages, in three places, read as detail pages since 1994."""
    n = F.col("o_orderkey").cast("string")
    pub = F.struct(F.when(F.col("o_orderkey") % 9 == 0, "").otherwise(F.concat(F.lit("p"), n)).alias("publication_id"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Title "), n)).alias("title"), F.concat(F.lit("Other "), n).alias("publication_title"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00").alias("release_date"), F.col("o_orderpriority").alias("frequency"))
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(pub).alias("list"))
    place = lambda k, name: F.when(F.col("o_custkey") % 3 == k, F.col("list")).alias(name)
    pages = per.select("o_custkey", _application(F.struct(place(0, "publications"), place(1, "data"), place(2, "items"), F.lit("x").alias("locale"))).alias("html"))
    return records.publications(pages, BASE, "1994-01-01").drop("pos", "kind")


def publication_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as downloads of orders' detail pages, in three places."""
    link = F.concat(F.lit(f"{BASE}/d/"), F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, ".xlsx").otherwise(""))
    res = F.struct(F.when(F.col("l_linenumber") % 7 == 0, "").otherwise(link).alias("resource_link"), F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_returnflag")).alias("resource_name"))
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(res).alias("list"))
    place = lambda k: F.when(F.col("l_orderkey") % 3 == k, F.col("list"))
    props = F.struct(place(0).alias("resources"), F.struct(place(1).alias("resources")).alias("publication"), place(2).alias("files"))
    return records.publication_files(per.select("l_orderkey", F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("title"), _application(props).alias("html"))).drop("pos")


def catalogue_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as data-catalogue pages of their brand, a thousand keys at a time."""
    n = F.col("p_partkey").cast("string")
    per = table(spark, sf_dir, "part").groupBy("p_brand", F.floor(F.col("p_partkey") / 1000).alias("part")).agg(F.collect_list(F.struct(F.concat(F.lit("d"), n).alias("dataset_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("name"))).alias("list"))
    pages = per.select("p_brand", _application(F.struct(F.array(F.struct(F.lit("x").alias("label"))).alias("menu"), F.col("list").alias("items"))).alias("html"))
    return records.catalogue_entries(pages, BASE).drop("pos")


def site_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as sites with a section per kind of supplier balance, suppliers as listing pages."""
    k = F.col("s_suppkey")
    page = F.struct(F.concat(F.lit(f"{BASE}/"), k.cast("string")).alias("url"), F.col("s_name").alias("label"))
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey", (F.col("s_acctbal") < 0).alias("owes")).agg(F.array_sort(F.collect_list(page)).alias("listing_pages"))
    section = F.struct(F.when(F.col("owes"), "debtors").otherwise("creditors").alias("name"), F.when(F.col("owes"), "hub").alias("page_type"), F.when(~F.col("owes"), "report").alias("doc_type"), F.lit(None).cast("string").alias("language"), "listing_pages")
    sites = lists.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(section)).alias("sections")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    pages = F.when(F.col("n_nationkey") % 3 == 0, "").otherwise((F.col("n_nationkey") * 10).cast("string"))
    config = F.struct(F.lower("n_name").alias("site_slug"), F.col("n_name").alias("agency"), F.lit(BASE).alias("base_url"), F.when(F.col("n_nationkey") % 2 == 0, "0.5").alias("request_delay"), pages.alias("estimated_pages"), "sections")
    return records.site_sections(sites.select(F.to_json(config).alias("json"))).drop("base_url", "agency")


def site_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites by their number of listing pages, as a crawl takes them (one row a nation)."""
    from pyspark.sql import Window

    sites = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("site_slug")).agg(F.count(F.lit(1)).alias("estimated_pages"))
    return sites.withColumn("turn", F.row_number().over(Window.orderBy(*records.heaviest_first(sites))))


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as records of documents, with the stored payload of the same content that comes first by path."""
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    docs = table(spark, sf_dir, "documents").select("doc_id", sha.alias("sha256"), F.concat(F.lit("gov-docs/"), F.col("doc_id").cast("string")).alias("path"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("length"))
    rows = table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", "sha256"), "doc_id")
    return records.with_payloads(rows, docs.select("sha256", "path", "length"))


def speech_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's date in one of the places in which a speech has it."""
    n, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    title = F.concat(F.lit("Remarks ("), F.when(n % 4 == 0, F.date_format(day, "MMM d, yyyy")).otherwise("opening"), F.lit(")"))
    lines = F.array(F.lit("by the Minister"), F.when(n % 4 == 1, F.date_format(day, "d MMMM yyyy")).otherwise("Hall"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.speech_date(title, lines, F.when(n % 4 == 2, F.date_format(day, "yyyy")).otherwise("")).alias("spoken_on"))


def attachment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as uploaded tables, texts, images and broken workbooks."""
    n = F.col("o_custkey")
    lines = F.array_sort(F.collect_list(F.struct("o_orderkey", F.concat_ws(",", F.col("o_orderkey").cast("string"), F.concat(F.lit('"'), "o_orderpriority", F.lit(', "')), F.lit("x")).alias("line"))))
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.concat(F.array(F.lit("Key,Priority")), F.transform(lines, lambda x: x["line"])), "\n").alias("said"))
    types = F.element_at(F.array(*[F.lit(x) for x in ("text/csv; charset=utf-8", "text/plain", "IMAGE/PNG", "application/vnd.ms-excel", "application/pdf", "x/unknown")]), (n % 6 + 1).cast("int"))
    name = F.concat(F.lit("f"), n.cast("string"), F.when(n % 12 == 5, ".CSV").otherwise(".dat"))
    rows = files.attachment_texts(per.select("o_custkey", name.alias("filename"), types.alias("content_type"), F.encode("said", "UTF-8").alias("content")))
    return rows.select("o_custkey", "kind", F.md5(F.col("text").cast("binary")).alias("md5"))


def atom_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders written as Atom feeds and read again."""
    n = F.col("o_orderkey").cast("string")
    entry = F.concat(F.lit("<entry><title>A &amp; "), n, F.lit('</title><link href="'), F.lit(f"{BASE}/?o="), n, F.lit('&amp;x=1"/><updated>'), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'"), F.lit("</updated></entry>"))
    xml = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.collect_list(entry), "\n"), F.lit("</feed>")).alias("xml"))
    return feeds.atom_entries(xml).select("o_custkey", "title", "link", dates.iso_date(F.col("updated")).alias("updated"))


def united_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders and all customers as two address lists in one order, and the first pages of each nation."""
    one = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderkey").cast("long").alias("pos"))
    two = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").cast("long").alias("pos"))
    united = state.united("key", one, two).join(table(spark, sf_dir, "customer"), F.col("key") == F.col("c_custkey"))
    return state.capped(united, "c_nationkey", 10, "pos").select("key", "pos", "list_no", "c_nationkey")


def revalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as fetches with validators, against those of the item before in the order."""
    e = lambda c: F.when(F.col(c) % 3 == 0, "").otherwise(F.concat(F.lit("e"), (F.col(c) % 5).cast("string")))
    m = lambda c: F.when(F.col(c) % 2 == 0, F.lit(None).cast("string")).otherwise((F.col(c) % 3).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", state.unchanged(e("l_partkey"), e("l_suppkey"), m("l_suppkey"), m("l_partkey")).alias("unchanged"))


def ignored_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that are there, and customers of orders put in where they are new."""
    there = table(spark, sf_dir, "customer").where("c_acctbal < 5000").select(F.col("c_custkey").alias("key"), F.lit("there").alias("origin"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.lit("order").alias("origin"))
    return state.insert_or_ignore(there, new, ["key"])


def judged_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores read from answers of a scorer: line items of each order as a JSON list inside prose."""
    item = F.struct(F.col("l_linenumber").cast("int").alias("index"), F.round(F.col("l_discount") * 100, 0).alias("score"))
    answers = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("query_id")).agg(F.concat(F.lit("Scores:\n"), F.when(F.col("query_id") % 10 == 0, "none").otherwise(F.to_json(F.collect_list(item))), F.lit("\nDone.")).alias("answer"))
    return retrieval.parsed_scores(answers)


def answer_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of conversation turns linked with the citations that messages have."""
    said = _messages(spark, sf_dir).select(F.col("id").alias("message_id"), F.concat("role", F.lit(" [2] and [1], [7]")).alias("text"))
    cited = said.select("message_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("citation_index")).withColumn("document_id", F.pmod(F.col("message_id") + F.col("citation_index"), F.lit(97)))
    return retrieval.linked_marks(said, cited)


def support_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items' discounts as best similarities: how well an answer is supported."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", retrieval.support_tier(F.col("l_discount") * 10).alias("tier"))


QUERIES = {
    f.__name__: f
    for f in (
        document_kinds, allowed_addresses, catalogue_matches, live_texts, index_plan, index_counters, rated_messages, conversation_feedback, updated_conversations, record_items, dataset_candidates, publications,
        publication_files, catalogue_entries, site_sections, site_order, payload_records, speech_dates, attachment_texts, atom_entries, united_addresses, revalidated, ignored_inserts, judged_answers, answer_marks, support_tiers,
    )
}

_RATED = "s AS (SELECT event_id % 4000 AS message_id, user_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS rating, event_id, ts FROM events), r AS (SELECT message_id, user_id, arg_max(rating, (ts, event_id)) AS rating FROM s WHERE rating <> 0 GROUP BY 1, 2)"
_MANIFEST = """
d AS (SELECT doc_id AS n, source, n_chars, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS day, ['.pdf', '.html', '.csv', '.txt', '.docx'][CAST(doc_id % 5 AS INTEGER) + 1] AS ext FROM documents),
k AS (SELECT n_chars AS size, substr(ext, 2) AS file_type, CASE n % 4 WHEN 0 THEN 'gov-docs/' || source || '/raw/' || strftime(day, '%Y/%m/%d') || '/' WHEN 1 THEN 'archive/gov-my/' || source || '/' || strftime(day, '%Y-%m') || '/' WHEN 2 THEN 'gov-my/' || source || '/' || strftime(day, '%Y-%m') || '/' END || 'report_no-' || n || ext AS storage_path FROM d WHERE ext <> '.txt' AND n % 4 < 3)
"""

ORACLE_SQL = {
    "document_kinds": """
WITH d AS (SELECT doc_id, lang, lower(['Kenyataan Media', 'Surat Siaran', 'Laporan', 'Pekeliling', 'Ucapan', 'Akta', 'Press Release', 'Notice'][CAST(doc_id % 8 AS INTEGER) + 1]) AS t FROM documents)
SELECT doc_id, CASE WHEN t IN ('kenyataan media', 'press release') THEN 'press_release' WHEN contains(t, 'siaran') THEN 'statement' WHEN t = 'laporan' THEN 'report' WHEN t IN ('pekeliling', 'notice') THEN 'notice' WHEN t = 'ucapan' THEN 'speech' ELSE 'other' END AS kind FROM d""",
    "allowed_addresses": """
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', '') AS rest FROM pages), h AS (SELECT page_id, replace(lower(regexp_extract(rest, '^([^/]*)', 1)), 'www.', '') AS host, regexp_extract(rest, '^[^/]*(.*)$', 1) AS path FROM p)
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN lower('https://' || host || path || CASE WHEN page_id % 3 = 0 THEN '/a%20b%20c~' ELSE '/a%20b%20c~/?a=1&b=2' END) END AS canonical FROM h""",
    "catalogue_matches": """
WITH f AS (SELECT l_orderkey AS query_id, 'set' || l_partkey AS dataset_id, l_partkey, min(l_linenumber) AS r FROM lineitem GROUP BY ALL)
SELECT query_id, dataset_id, p_name AS title, CAST(row_number() OVER (PARTITION BY query_id ORDER BY r, dataset_id) AS INTEGER) AS place FROM f JOIN part ON p_partkey = l_partkey WHERE p_brand < 'Brand#3'""",
    "live_texts": """
WITH n AS (SELECT event_type AS id, strftime(ts, '%Y-%m-%d') AS d, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT id, string_agg(d || ' | ' || n, chr(10) ORDER BY d DESC) AS lines, count(*) AS c FROM n WHERE d >= '2024-01-20' GROUP BY 1),
e AS (SELECT DISTINCT event_type AS id FROM events UNION ALL SELECT 'none'), t AS (
SELECT e.id, CASE WHEN c > 0 THEN 'Live data from data.gov.my — Daily ' || e.id || ' (most recent ' || c || ' records):' || chr(10) || chr(10) || 'date | n' || chr(10) || '--------' || chr(10) || lines || chr(10) || chr(10) || 'Source: data.gov.my (opendata, id=' || e.id || '). Updated daily.'
ELSE '[No data returned from data.gov.my for Daily ' || e.id || ']' END AS x FROM e LEFT JOIN r USING (id))
SELECT id AS dataset_id, CAST(length(x) AS INTEGER) AS n_chars, md5(x) AS md5 FROM t""",
    "index_plan": f"WITH {_MANIFEST} SELECT storage_path, file_type FROM k WHERE starts_with(storage_path, 'gov-docs/') ORDER BY storage_path LIMIT 50",
    "index_counters": f"""
WITH {_MANIFEST}, c AS (SELECT *, starts_with(storage_path, 'gov-docs/') AS chosen, file_type = 'csv' AS failed FROM k)
SELECT count(*) FILTER (WHERE chosen AND NOT failed) AS processed_documents, count(*) FILTER (WHERE NOT chosen) AS skipped_documents, CAST(sum(size // 1400 + 1) FILTER (WHERE chosen AND NOT failed) AS BIGINT) AS persisted_chunks, count(*) FILTER (WHERE chosen AND failed) AS failed_documents FROM c""",
    "rated_messages": f"WITH {_RATED}, b AS (SELECT DISTINCT message_id, user_id FROM s WHERE message_id < 1000) SELECT message_id, user_id, coalesce(rating, 1) AS rating FROM r FULL JOIN b USING (message_id, user_id)",
    "conversation_feedback": f"WITH {_RATED}, m AS (SELECT conv_id * 1000 + turn AS message_id, conv_id AS conversation_id FROM conversations) SELECT conversation_id, user_id, message_id, rating FROM m JOIN r USING (message_id)",
    "updated_conversations": """
WITH c AS (SELECT c_custkey AS id, c_custkey % 50 AS user_id, c_name AS title, TIMESTAMP '2024-01-31 12:00:00' - to_hours(CAST((c_custkey * 5) % 400 AS INTEGER)) AS updated_at, CASE c_custkey % 7 WHEN 0 THEN true WHEN 1 THEN false END AS pinned, CASE WHEN c_custkey % 3 = 0 THEN 'en' END AS language FROM customer),
m AS (SELECT conv_id AS id, max(turn) AS last, bool_or(turn % 2 = 1) AS odd FROM conversations GROUP BY 1)
SELECT id, user_id, CASE WHEN id % 5 > 0 AND id % 4 = 0 THEN 'Renamed ' || id ELSE title END AS title, CASE WHEN id % 5 > 0 AND id % 6 = 0 THEN true ELSE pinned END AS pinned,
  coalesce(language, CASE WHEN odd THEN CASE WHEN id % 2 = 0 THEN 'ms' ELSE 'en' END END) AS language, CASE WHEN last IS NULL THEN updated_at ELSE TIMESTAMP '2024-03-01 00:00:00' + to_minutes(CAST(last AS INTEGER)) END AS updated_at FROM c LEFT JOIN m USING (id)""",
    "record_items": """
WITH o AS (SELECT o_orderkey AS n, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y-01-01') ELSE '' END AS d FROM orders)
SELECT n AS o_orderkey, 'https://x.example/f/' || n || CASE WHEN n % 5 = 1 THEN '.pdf' ELSE '.docx' END AS source_url, CASE WHEN n % 3 < 2 THEN 'Order ' || n ELSE '' END AS title, d AS published_at,
  CASE WHEN n % 5 = 1 THEN 'application/pdf' ELSE 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' END AS content_type FROM o WHERE n % 5 > 0 AND (d = '' OR d >= '1995-01-01')""",
    "dataset_candidates": """
SELECT 'https://x.example/f/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.pdf' ELSE '' END AS url, p_brand || ' — ' || CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand END AS title, CASE WHEN p_partkey % 5 = 0 THEN '2024-02-03' ELSE '2024-01-01' END AS published_at,
  CASE p_partkey % 4 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'application/octet-stream' ELSE 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' END AS content_type, p_brand AS organization, CAST(p_partkey AS VARCHAR) AS resource_id FROM part WHERE p_partkey % 4 <> 2""",
    "publications": """
SELECT o_custkey, 'https://x.example/publications/p' || o_orderkey AS source_url, CASE WHEN o_orderkey % 2 = 0 THEN 'Title ' ELSE 'Other ' END || o_orderkey AS title, strftime(o_orderdate, '%Y-%m-%d') AS published_at, o_orderpriority AS frequency
FROM orders WHERE o_orderkey % 9 > 0 AND o_orderdate >= DATE '1994-01-01'""",
    "publication_files": """
SELECT l_orderkey, 'https://x.example/d/' || l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '.xlsx' ELSE '' END AS url, 'Order ' || l_orderkey || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE ' - ' || l_returnflag END AS title,
  CASE WHEN l_linenumber % 2 = 0 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' ELSE 'application/pdf' END AS content_type FROM lineitem WHERE l_linenumber % 7 > 0""",
    "catalogue_entries": "SELECT p_brand, 'https://x.example/data-catalogue/d' || p_partkey AS source_url, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'd' || p_partkey END AS title FROM part",
    "site_sections": """
WITH s AS (SELECT lower(n_name) AS site_slug, n_nationkey AS k, s_acctbal < 0 AS owes, 'https://x.example/' || s_suppkey AS url, s_name AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT site_slug, CASE WHEN k % 2 = 0 THEN 0.5 ELSE 1.5 END::DOUBLE AS request_delay, CASE WHEN k % 3 = 0 THEN 0 ELSE k * 10 END::INTEGER AS estimated_pages, CAST(dense_rank() OVER (PARTITION BY site_slug ORDER BY CASE WHEN owes THEN 'debtors' ELSE 'creditors' END) - 1 AS INTEGER) AS section_no,
  CASE WHEN owes THEN 'debtors' ELSE 'creditors' END AS section, CASE WHEN owes THEN 'hub' ELSE 'listing' END AS page_type, CASE WHEN owes THEN 'other' ELSE 'report' END AS doc_type, 'ms' AS language,
  CAST(row_number() OVER (PARTITION BY site_slug, owes ORDER BY url) - 1 AS INTEGER) AS page_no, url, label FROM s""",
    "site_order": "SELECT CAST(s_nationkey AS VARCHAR) AS site_slug, count(*) AS estimated_pages, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(s_nationkey AS VARCHAR)) AS INTEGER) AS turn FROM supplier GROUP BY s_nationkey",
    "payload_records": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS sha256, 'gov-docs/' || doc_id AS path, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length FROM documents), p AS (SELECT sha256, min(path) AS path, any_value(length) AS length FROM d GROUP BY 1)
SELECT l.doc_id, d.sha256, p.path, p.length FROM labels l JOIN d ON d.doc_id = l.doc_id JOIN p ON p.sha256 = d.sha256""",
    "speech_dates": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-01-01') ELSE '' END AS spoken_on FROM orders",
    "attachment_texts": """
WITH o AS (SELECT o_custkey AS n, string_agg(o_orderkey || ',"' || o_orderpriority || ', ",x', chr(10) ORDER BY o_orderkey) AS raw, string_agg('| ' || o_orderkey || ' | ' || o_orderpriority || ',  |', chr(10) ORDER BY o_orderkey) AS md FROM orders GROUP BY 1),
k AS (SELECT *, CASE WHEN n % 6 = 0 OR n % 12 = 5 THEN 'csv' WHEN n % 6 = 2 THEN 'image' WHEN n % 6 = 3 THEN 'xlsx' WHEN n % 6 = 4 THEN 'pdf' ELSE 'text' END AS kind, 'f' || n || CASE WHEN n % 12 = 5 THEN '.CSV' ELSE '.dat' END AS f FROM o)
SELECT n AS o_custkey, kind, md5(CASE kind WHEN 'csv' THEN '[CSV: ' || f || ']' || chr(10) || '| Key | Priority |' || chr(10) || '| --- | --- |' || chr(10) || md WHEN 'text' THEN '[File: ' || f || ']' || chr(10) || 'Key,Priority' || chr(10) || raw WHEN 'xlsx' THEN '[XLSX file uploaded: ' || f || ' — spreadsheet parsing unavailable]' END) AS md5 FROM k""",
    "atom_entries": "SELECT o_custkey, 'A & ' || o_orderkey AS title, 'https://x.example/?o=' || o_orderkey || '&x=1' AS link, strftime(o_orderdate, '%Y-%m-%d') AS updated FROM orders",
    "united_addresses": """
WITH o AS (SELECT o_custkey AS key, CAST(min(o_orderkey) AS BIGINT) AS pos FROM orders GROUP BY 1), u AS (SELECT c_custkey AS key, coalesce(pos, c_custkey) AS pos, CASE WHEN pos IS NULL THEN 1 ELSE 0 END AS list_no, c_nationkey FROM customer LEFT JOIN o ON key = c_custkey)
SELECT key, CAST(pos AS BIGINT) AS pos, list_no, c_nationkey FROM u QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY u.pos) <= 10""",
    "revalidated": """
SELECT l_orderkey, l_linenumber, (l_partkey % 3 > 0 AND l_suppkey % 3 > 0 AND l_partkey % 5 = l_suppkey % 5) OR (l_partkey % 2 = 1 AND l_suppkey % 2 = 1 AND l_partkey % 3 = l_suppkey % 3) AS unchanged FROM lineitem""",
    "ignored_inserts": "WITH t AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal < 5000) SELECT key, 'there' AS origin FROM t UNION ALL SELECT DISTINCT o_custkey, 'order' FROM orders WHERE o_custkey NOT IN (SELECT key FROM t)",
    "judged_answers": "SELECT l_orderkey AS query_id, CAST(l_linenumber AS INTEGER) AS rank, round(l_discount * 100, 0) AS score FROM lineitem WHERE l_orderkey % 10 > 0",
    "answer_marks": """
WITH m AS (SELECT conv_id * 1000 + turn AS message_id FROM conversations)
SELECT message_id, CAST(pos AS INTEGER) AS pos, CAST(i AS INTEGER) AS citation_index, CASE WHEN i < 7 THEN (message_id + i) % 97 END AS document_id FROM m, (VALUES (0, 2), (1, 1), (2, 7)) v(pos, i)""",
    "support_tiers": "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 >= 0.65 THEN 'supported' WHEN l_discount * 10 >= 0.45 THEN 'limited-support' ELSE 'no-information' END AS tier FROM lineitem",
}
