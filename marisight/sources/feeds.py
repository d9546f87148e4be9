"""Feeds, sitemaps, embedded and paged JSON, listings and manifests as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marisight.functions import dates, urls
from marisight.operators.tables import settled
from marisight.sources.html_nodes import selected

#: fixed values: default places of a site's sitemap
SITEMAPS = ("/sitemap.xml", "/sitemap_index.xml", "/wp-sitemap.xml", "/sitemap-index.xml")
#: fixed values: how tree items name their file, labels of a catalogue entry's text, and where entries have their pages
LOADED = r"(?i)loadResult\(\s*['\"]([^'\"]+\.pdf)['\"]"
CATALOG_LABELS = ("Dataset ID", "Columns", "Update frequency", "Category", "API endpoint")
CATALOG_PAGES = "https://data.gov.my/data-catalogue/"
#: fixed values: file types that are indexed
INDEXED = ("html", "pdf", "docx", "xlsx", "xls", "csv", "doc", "ppt", "pptx")


def _bare(xml: Column) -> Column:
    """XML without default namespaces and prolog, so that paths need no prefixes."""
    return F.regexp_replace(F.regexp_replace(xml, r"\sxmlns(:\w+)?=(\"[^\"]*\"|'[^']*')", ""), r"^\s*<\?xml[^>]*\?>", "")


#: an item whose children are all plain texts: no attributes, references, comments or elements in them
_FLAT = r"^<{0}>(?:\s*<([\w.:-]+)>[^<&\r]*</\1>)*\s*</{0}>$"
_FLAT_CHARS = 4000


def _zipped(xml: Column, item: str, **fields: str) -> Column:
    """Structs of an XML's items; every item has every field (an absent one gives '').  A path costs a parse of its item,
    so items of plain texts are read without one."""
    items = F.regexp_extract_all(_bare(xml), F.lit(rf"(?s)(<{item}(?:\s[^>]*)?>.*?</{item}>)"), 1)
    looked = F.transform(items, lambda one: F.struct(one.alias("xml"), ((F.length(one) <= _FLAT_CHARS) & one.rlike(_FLAT.format(item))).alias("flat")))
    plain = lambda one, path: F.lit("") if "@" in path else F.regexp_extract(one, f"<{path}>([^<]*)</", 1)
    said = lambda one, path: F.when(one["flat"], plain(one["xml"], path)).otherwise(F.xpath_string(one["xml"], F.lit(f"{item}/{path}")))
    return F.transform(looked, lambda one: F.struct(*[F.coalesce(F.trim(said(one, path)), F.lit("")).alias(name) for name, path in fields.items()]))


def rss_items(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """RSS 2.0 items: title (or Untitled), link, description, pub_date, enclosure."""
    out = feeds.select(*[c for c in feeds.columns if c != xml], F.explode(_zipped(F.col(xml), "item", title="title", link="link", description="description", pub_date="pubDate", enclosure="enclosure/@url")).alias("i"))
    return out.select("*", "i.*").drop("i").withColumn("title", F.when(F.col("title") == "", "Untitled").otherwise(F.col("title")))


def language_feeds(configs: DataFrame, bodies: DataFrame, base: str, since: str | None = None) -> DataFrame:
    """(feed, doc_type, language, source_url, title, published_at, description): items of feeds that a site has in two
    languages (name, doc_type, url_en, url_ms), from the fetched bodies (url, xml).  Feeds without an address in a
    language or without a body have no items there."""
    each = configs.select("name", "doc_type", F.explode(F.array(*[F.struct(F.lit(c).alias("language"), F.col(f"url_{c}").alias("url")) for c in ("en", "ms")])).alias("f")).select("name", "doc_type", "f.*").where("url <> ''")
    items = rss_items(each.join(bodies, "url").select("name", "doc_type", "language", "xml"))
    day = dates.feed_date(F.col("pub_date"))
    rows = items.select(F.col("name").alias("feed"), "doc_type", "language", urls.absolute(F.col("link"), F.lit(base)).alias("source_url"), "title", day.alias("published_at"), "description")
    return rows if since is None else rows.where(dates.since(F.col("published_at"), F.lit(since).cast("date")))


def feed_files(spark: SparkSession, folder: str, tag: str = "item") -> DataFrame:
    """(file, title, link, description, pub_date, enclosure) of the items in a folder's feed files, each read item by item,
    so a file may have any size (one feed a file).  Items that are cut off or broken drop out; their file's others stay."""
    kind = "title string, link string, description string, pubDate string, enclosure struct<_url: string>, broken string"
    rows = spark.read.format("xml").option("rowTag", tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken").schema(kind).load(folder)
    field = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = rows.select(F.col("_metadata.file_path").alias("file"), "broken", F.coalesce(F.nullif(field("title"), F.lit("")), F.lit("Untitled")).alias("title"), field("link").alias("link"), field("description").alias("description"), field("pubDate").alias("pub_date"), field("enclosure._url").alias("enclosure"))
    return rows.where("broken IS NULL").drop("broken")


def atom_entries(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    out = feeds.select(*[c for c in feeds.columns if c != xml], F.explode(_zipped(F.col(xml), "entry", title="title", link="link/@href", updated="updated")).alias("i"))
    return out.select("*", "i.*").drop("i")


def sitemap_urls(maps: DataFrame, xml: str = "xml") -> DataFrame:
    """Locations of a urlset (kind 'url') or a sitemap index (kind 'sitemap'), with lastmod."""
    keep = [c for c in maps.columns if c != xml]
    one = lambda kind: maps.select(*keep, F.lit(kind).alias("kind"), F.explode(_zipped(F.col(xml), kind, loc="loc", lastmod="lastmod")).alias("i")).select(*keep, "kind", "i.*")
    return one("url").unionByName(one("sitemap"))


def all_sitemap_urls(start: DataFrame, bodies: DataFrame, most_levels: int = 50) -> DataFrame:
    """Page locations below the given sitemap addresses (column url): index levels are followed by joins with bodies
    (url, xml) until no new address turns up; each level is written once, and more than ``most_levels`` of them are an error."""
    level = settled(start.select("url").distinct())
    found, seen = [], [level]
    for _ in range(most_levels):
        here = settled(sitemap_urls(level.join(bodies, "url").select("url", "xml")))
        found.append(here.where("kind = 'url'").select("loc", "lastmod"))
        level = here.where("kind = 'sitemap'").select(F.col("loc").alias("url")).distinct()
        level = settled(level.join(reduce(DataFrame.unionByName, seen), "url", "left_anti"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found).groupBy("loc").agg(F.max("lastmod").alias("lastmod"))
        seen.append(level)
    raise RuntimeError(f"sitemaps nest deeper than {most_levels} levels")


def robots_sitemaps(text: Column, base: Column) -> Column:
    """``Sitemap:`` lines of a robots file, else the default places."""
    named = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)
    return F.when(F.size(named) > 0, F.array_distinct(named)).otherwise(F.array(*[F.concat(base, F.lit(s)) for s in SITEMAPS]))


def disallowed(path: Column, rules: Column) -> Column:
    """Whether a path starts with a disallowed prefix of a robots file."""
    return F.exists(rules, lambda r: (r != "") & path.startswith(r))


def robots_rules(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?im)^\s*disallow:[ \t]*(\S+)"), 1)


def embedded_json(html: Column) -> Column:
    """The JSON text of a page's application data script."""
    return F.regexp_extract(html, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)


def ckan_resources(catalog: DataFrame, formats: tuple[str, ...] = ("csv", "xlsx", "pdf"), since: str | None = None, json: str = "json") -> DataFrame:
    """Resources of wanted formats of the datasets in CKAN search pages."""
    schema = "struct<results:array<struct<id:string,title:string,metadata_modified:string,resources:array<struct<id:string,url:string,format:string,name:string>>>>>"
    page = catalog.select(F.from_json(F.get_json_object(json, "$.result"), schema).alias("p"))
    sets = page.select(F.explode("p.results").alias("d"))
    if since is not None:
        sets = sets.where(F.coalesce(F.substring("d.metadata_modified", 1, 10) >= since, F.lit(True)))
    out = sets.select("d.id", "d.title", F.explode("d.resources").alias("r"))
    out = out.select(F.col("id").alias("dataset_id"), "title", F.col("r.id").alias("resource_id"), "r.url", F.lower("r.format").alias("format"), "r.name")
    name = urls.file_name(F.col("url"), "")
    return out.where(F.col("format").isin(*formats)).withColumn("file_name", F.when(name.contains("."), name).otherwise(F.concat("resource_id", F.lit("."), "format")))


def json_field(json: Column, path: str) -> Column:
    """A field by dotted path, '' when missing."""
    return F.coalesce(F.get_json_object(json, "$." + path), F.lit(""))


def first_of(*columns: Column) -> Column:
    """The first value that isn't empty, else ''."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(""))


def manifest(objects: DataFrame) -> DataFrame:
    """Indexable objects of a listing (key, etag, sha256, version_id, size): agency, year_month, file name, type
    and version by the three layouts of storage keys; other keys and types drop out."""
    p = F.split("key", "/")
    n = F.size(p)
    at = lambda i: F.try_element_at(p, F.lit(i))
    agency = F.when((n == 7) & (at(3) == "raw"), at(2)).when((n == 5) & (at(2) == "gov-my"), at(3)).when((n == 4) & (at(1) == "gov-my"), at(2))
    month = F.when((n == 7) & (at(3) == "raw"), F.concat_ws("-", at(4), at(5))).when((n == 5) & (at(2) == "gov-my"), at(4)).when((n == 4) & (at(1) == "gov-my"), at(3))
    name = F.element_at(p, -1)
    kind = F.lower(F.regexp_extract(name, r"\.([A-Za-z]+)$", 1))
    version = F.coalesce("sha256", "version_id", F.replace("etag", F.lit('"'), F.lit("")), "key")
    out = objects.select(F.col("key").alias("storage_path"), agency.alias("agency"), month.alias("year_month"), name.alias("file_name"), kind.alias("file_type"), version.alias("version_token"), "size", urls.title_of(name).alias("title"))
    return out.where(F.col("agency").isNotNull() & F.col("file_type").isin(*INDEXED))


def stored_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files of a folder in any Hadoop file system, with content and digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", "modificationTime", "content", F.sha2("content", 256).alias("sha256"))


def statistics(rows: DataFrame, sort: str = "date", limit: int = 10, start: str | None = None, end: str | None = None, equals: dict[str, str] | None = None) -> DataFrame:
    """Rows of a statistical series, newest first: date range, value filters and a limit of at most 100."""
    for column, value in (equals or {}).items():
        rows = rows.where(F.col(column) == value)
    if start is not None:
        rows = rows.where(F.col(sort) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(sort) <= F.lit(end))
    return rows.orderBy(F.col(sort).desc(), F.xxhash64(*rows.columns)).limit(min(limit, 100))


def series_rows(bodies: DataFrame, fields: str, json: str = "json") -> DataFrame:
    """Rows of a series' answers: a JSON list, or an object with the list under ``data``; anything else has none."""
    said = F.trim(F.coalesce(F.col(json), F.lit("")))
    listed = F.when(said.startswith("["), said).otherwise(F.get_json_object(said, "$.data"))
    return bodies.select(*[c for c in bodies.columns if c != json], F.explode(F.from_json(listed, f"array<struct<{fields}>>")).alias("r")).select(*[c for c in bodies.columns if c != json], "r.*")


def series_filter(asked: Column, column: str) -> Column:
    """Whether a row passes a filter ``value@column``; null filters and those on other columns pass."""
    value, name = F.split_part(asked, F.lit("@"), F.lit(1)), F.split_part(asked, F.lit("@"), F.lit(2))
    return F.coalesce((name != column) | (F.col(column).cast("string") == value), F.lit(True))


def series_bound(asked: Column, columns: list[str], first: bool) -> Column:
    """Whether a row passes a day bound ``value@column``, or ``value`` of column ``date``: not before it, or not after it.
    Missing bounds pass, as do those on columns that the series doesn't have."""
    value, name = F.split_part(asked, F.lit("@"), F.lit(1)), F.coalesce(F.nullif(F.split_part(asked, F.lit("@"), F.lit(2)), F.lit("")), F.lit("date"))
    tests = [F.when(name == c, F.col(c).cast("string") >= value if first else F.col(c).cast("string") <= value) for c in columns]
    return F.coalesce(*tests, F.lit(True))


def series_answers(bodies: DataFrame, fields: str, asked: str, keys: list[str], sort: str = "date", most: int = 100, default: int = 10) -> DataFrame:
    """Rows of series' answers as they were asked for: column ``asked`` is a struct of date_start, date_end, filters (an
    array of ``value@column``) and row_limit.  Newest first within the keys, with ``rank``; equal days in the order of
    the answer."""
    listed = StructType.fromDDL(fields).names
    said = F.trim(F.coalesce(F.col("json"), F.lit("")))
    kept = [c for c in bodies.columns if c != "json"]
    rows = bodies.select(*kept, F.posexplode(F.from_json(F.when(said.startswith("["), said).otherwise(F.get_json_object(said, "$.data")), f"array<struct<{fields}>>")).alias("_at", "_r")).select(*kept, "_at", "_r.*")
    good = series_bound(F.col(asked)["date_start"], listed, True) & series_bound(F.col(asked)["date_end"], listed, False)
    good = good & F.coalesce(F.forall(F.col(asked)["filters"], lambda f: reduce(lambda a, b: a & b, [series_filter(f, c) for c in listed])), F.lit(True))
    order = Window.partitionBy(*keys).orderBy(F.desc(sort), "_at")
    limit = F.least(F.coalesce(F.nullif(F.col(asked)["row_limit"], F.lit(0)), F.lit(default)), F.lit(most))
    return rows.where(good).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).drop("_at")


def tree_items(trees: DataFrame, id: str = "id", xml: str = "xml") -> DataFrame:
    """(id, pos, item, text, address): the items of tree answers, each with the address that its own ``myurl`` user data
    names ('' without one).  An item inside another is an item of its own, and its user data are not the outer one's."""
    found = selected(trees, {"item": ("item", ()), "data": ("item userdata[name=myurl]", ("item",))}, (id,), xml)
    at = F.when(F.col("name") == "data", F.try_element_at("owners", F.lit("item"))).otherwise(F.col("pos"))
    item, data = F.col("name") == "item", F.col("name") == "data"
    said = F.min_by(F.when(data, F.col("text")), F.when(data, F.col("pos")))
    of_item = lambda c: F.max(F.when(item, F.coalesce(F.try_element_at("attrs", F.lit(c)), F.lit(""))))
    rows = found.groupBy(id, at.alias("pos")).agg(of_item("id").alias("item"), of_item("text").alias("text"), F.coalesce(said, F.lit("")).alias("said"))
    return rows.select(id, "pos", "item", "text", F.regexp_extract("said", LOADED, 1).alias("address"))


def tree_walk(answers: DataFrame, base: str, root: str = "", levels: int = 3) -> DataFrame:
    """(parent, pos, link, title, file_name, published_at): the files of a tree whose answers (id, xml) are fetched by id:
    from the root's answer ``levels`` levels of items down, and there the items that have an address.  An item that
    stands under two others is reached twice."""
    items = settled(tree_items(answers))
    reached = items.where(F.col("id") == root).select(F.col("item").alias("id"))
    for _ in range(levels - 1):
        reached = reached.where("id <> ''").join(items, "id").select(F.col("item").alias("id"))
    leaves = reached.where("id <> ''").join(items.where("address <> ''"), "id")
    name = F.element_at(F.split("address", "/"), -1)
    return leaves.select(F.col("id").alias("parent"), "pos", urls.absolute(F.col("address"), F.lit(base)).alias("link"), F.col("text").alias("title"), name.alias("file_name"), dates.name_date(name).alias("published_at"))


def page_files(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, pos, link, title): PDF files that a page links, first mention of each, titled by the link or the file."""
    found = selected(pages, {"a": ("a[href]", ())}, (key, url), html)
    href = F.trim(F.try_element_at("attrs", F.lit("href")))
    rows = found.where(F.lower(href).endswith(".pdf")).select(key, "pos", urls.absolute(href, F.col(url)).alias("link"), "text")
    rows = rows.groupBy(key, "link").agg(F.min("pos").alias("pos"), F.min_by("text", "pos").alias("text"))
    return rows.select(key, "pos", "link", F.coalesce(F.nullif("text", F.lit("")), F.element_at(F.split("link", "/"), -1)).alias("title"))


def first_list_with(json: Column, key: str, lists: tuple[str, ...], element: str) -> Column:
    """Of the named lists of a JSON object the first whose first element has the key, as array<element>."""
    return F.coalesce(*[F.when(F.get_json_object(json, f"$.{name}[0].{key}").isNotNull(), F.from_json(F.get_json_object(json, f"$.{name}"), f"array<{element}>")) for name in lists])


def catalog_text(entry: Column) -> Column:
    """What is indexed of a catalogue entry (struct of title_en, title_ms, description_en, description_ms, dataset_id,
    columns, frequency, category, endpoint)."""
    field = lambda name: F.coalesce(entry[name], F.lit(""))
    titles = F.concat(field("title_en"), F.lit(" / "), field("title_ms"))
    facts = [F.concat(F.lit(f"{label}: "), value) for label, value in zip(CATALOG_LABELS, (field("dataset_id"), F.array_join(entry["columns"], ", "), field("frequency"), field("category"), field("endpoint")))]
    return F.concat_ws("\n\n", titles, field("description_en"), field("description_ms"), F.concat_ws("\n", *facts))


def catalog_summary(title: Column, description: Column, columns: Column, frequency: Column, category: Column) -> Column:
    """A dataset in short: its title, description, columns, frequency and category, a line each."""
    return F.concat_ws("\n", title, description, F.concat(F.lit("Columns: "), F.array_join(columns, ", ")), F.concat(F.lit("Frequency: "), frequency), F.concat(F.lit("Category: "), category))


def catalog_items(entries: DataFrame, prefix: str) -> DataFrame:
    """Catalogue entries as rows to index: storage path, title, text, its digest and size, source and metadata."""
    text = catalog_text(F.struct(*entries.columns))
    name = F.concat("dataset_id", F.lit(".metadata"))
    own = {"datagov_dataset_id": "dataset_id", "datagov_endpoint": "endpoint", "frequency": "frequency", "category": "category"}
    metadata = F.create_map(F.lit("source_type"), F.lit("datagov_metadata"), F.lit("columns"), F.array_join("columns", ","), *[x for k, c in own.items() for x in (F.lit(k), F.col(c))])
    return entries.select(F.concat(F.lit(prefix), name).alias("storage_path"), name.alias("file_name"), F.lit("metadata").alias("file_type"), F.lit("v1").alias("version_token"), F.col("title_en").alias("title"), F.concat(F.lit(CATALOG_PAGES), "dataset_id").alias("source_url"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha256"), F.octet_length(text).alias("size_bytes"), metadata.alias("metadata"))


def usable_downloads(rows: DataFrame, content: str = "content", least: int = 10) -> DataFrame:
    """Downloads whose payload is no mere error stub."""
    return rows.where(F.octet_length(content) >= least)
