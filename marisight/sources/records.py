"""Records of programming interfaces as items: collections, open-data catalogues, publication lists, site sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.functions import dates, urls
from marisight.sources.feeds import embedded_json, first_of

#: fixed values: where a record's title and date stand if not where its section says
TITLE_FIELDS = ("title", "titleEN", "titleBM", "tenderTitle")
DATE_FIELDS = ("publishDate", "published_at", "startDate", "resultDate", "createdAt")
#: fixed values: media types of open-data formats
FORMAT_TYPES = {
    "csv": "text/csv",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xls": "application/vnd.ms-excel",
    "json": "application/json",
    "xml": "application/xml",
}
#: fixed values: names of the lists of publications and of the fields that tell catalogue entries
PUBLICATION_LISTS = ("publications", "data")
CATALOGUE_IDS = ("id", "dataset_id", "catalog_id")


def file_address(raw: Column, base: str) -> Column:
    """A file's address: whole ones as they are, rooted ones below the base; '' without one."""
    said = F.trim(F.coalesce(raw, F.lit("")))
    return F.when(said.startswith("/"), F.concat(F.lit(base), said)).otherwise(said)


def record_items(records: DataFrame, title: str, date: str | None, file: str | None, base: str, since: str | None = None, json: str = "json") -> DataFrame:
    """Items of a collection's records: source_url (the file's), title, published_at and content_type.  Fields are
    dotted paths; titles and dates fall back to other fields.  Records without a file drop out, as do those dated
    before ``since``."""
    field = lambda path: F.coalesce(F.try_variant_get(F.col("_v"), f"$.{path}", "string"), F.lit(""))
    records = records.withColumn("_v", F.try_parse_json(F.col(json)))
    raw = first_of(*([field(date)] if date else []), *[field(f) for f in DATE_FIELDS])
    rows = records.withColumn("source_url", file_address(field(file) if file else F.lit(""), base)).withColumn("title", first_of(field(title), *[field(f) for f in TITLE_FIELDS]))
    day = F.when(raw.rlike(r"^\d{4}$"), F.concat(raw, F.lit("-01-01"))).otherwise(dates.parse_date(raw))
    rows = rows.withColumn("published_at", F.when(raw == "", F.lit("")).otherwise(day)).where("source_url <> ''")
    if since is not None:
        rows = rows.where(dates.since(F.col("published_at"), F.lit(since).cast("date")))
    return rows.withColumn("content_type", urls.content_type(F.col("source_url"))).drop(json, "_v")


def dataset_candidates(pages: DataFrame, formats: tuple[str, ...] = ("csv", "xlsx", "pdf"), since: str | None = None, json: str = "json") -> DataFrame:
    """Candidates of the wanted resources in open-data search pages: the title is dataset and resource, the date the
    resource's or the dataset's last change, the media type that of the format."""
    resource = "struct<id:string,url:string,format:string,name:string,description:string,last_modified:string>"
    schema = f"struct<results:array<struct<id:string,name:string,title:string,metadata_modified:string,organization:struct<name:string,title:string>,resources:array<{resource}>>>>"
    sets = pages.where(F.get_json_object(json, "$.success") == "true").select(F.explode(F.from_json(F.get_json_object(json, "$.result"), schema)["results"]).alias("d"))
    changed = F.substring(F.coalesce("d.metadata_modified", F.lit("")), 1, 10)
    if since is not None:
        sets = sets.where(dates.since(changed, F.lit(since).cast("date")))
    rows = sets.select(F.coalesce("d.title", "d.name", F.lit("")).alias("dataset"), F.col("d.name").alias("dataset_name"), F.coalesce("d.organization.title", "d.organization.name", F.lit("")).alias("organization"), changed.alias("changed"), F.explode("d.resources").alias("r"))
    rows = rows.withColumn("format", F.trim(F.lower(F.coalesce("r.format", F.lit(""))))).where(F.col("format").isin(*formats) & (F.coalesce("r.url", F.lit("")) != ""))
    name = first_of(F.col("r.name"), F.col("r.description"), F.col("dataset"))
    types = F.create_map(*[F.lit(x) for pair in FORMAT_TYPES.items() for x in pair])
    title = F.regexp_replace(F.concat_ws(" — ", "dataset", name), "^[ —]+|[ —]+$", "")
    return rows.select(
        F.col("r.url").alias("url"), title.alias("title"), F.coalesce(F.nullif(F.substring("r.last_modified", 1, 10), F.lit("")), "changed").alias("published_at"),
        F.coalesce(F.try_element_at(types, F.col("format")), urls.content_type(F.col("r.url"))).alias("content_type"), "organization", "dataset_name", F.col("r.id").alias("resource_id"),
    )


def _props(page: Column) -> Column:
    """The page properties of a page's embedded application data, as a map of variants; the page is parsed once."""
    return F.try_variant_get(F.try_parse_json(embedded_json(page)), "$.props.pageProps", "map<string,variant>")


def _objects(value: Column, path: str = "$") -> Column:
    """A variant's list of objects as array<map<string,string>>; null for anything else."""
    return F.try_variant_get(value, path, "array<map<string,string>>")


def _first_list(props: Column, keys: tuple[str, ...]) -> Column:
    """Of all properties the first list whose first element has one of the keys."""
    lists = F.transform(F.map_values(props), lambda v: _objects(v))
    has = lambda m: F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: F.array_contains(F.map_keys(m), k))
    return F.try_element_at(F.filter(lists, lambda x: x.isNotNull() & (F.size(x) > 0) & F.coalesce(has(F.try_element_at(x, F.lit(1))), F.lit(False))), F.lit(1))


def publications(pages: DataFrame, base: str, since: str | None = None, html: str = "html") -> DataFrame:
    """Publications of listing pages: detail address, title, date, frequency and type."""
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*kept, _props(F.col(html)).alias("props"))
    some = lambda x: F.when(F.size(x) > 0, x)
    found = F.coalesce(*[some(_objects(F.try_element_at("props", F.lit(name)))) for name in PUBLICATION_LISTS], _first_list(F.col("props"), ("publication_id",)))
    rows = rows.select(*kept, F.posexplode(found).alias("pos", "p"))
    of = lambda k: F.try_element_at("p", F.lit(k))
    rows = rows.where(F.coalesce(of("publication_id"), F.lit("")) != "")
    day = F.substring(F.coalesce(of("release_date"), F.lit("")), 1, 10)
    if since is not None:
        rows = rows.where(dates.since(day, F.lit(since).cast("date")))
    title = F.coalesce(of("title"), of("publication_title"), of("publication_id"))
    return rows.select(*kept, "pos", F.concat(F.lit(f"{base}/publications/"), of("publication_id")).alias("source_url"), title.alias("title"), day.alias("published_at"), F.coalesce(of("frequency"), F.lit("")).alias("frequency"), F.coalesce(of("publication_type"), F.lit("")).alias("kind"))


def publication_files(details: DataFrame, html: str = "html", title: str = "title") -> DataFrame:
    """Downloads of publications' detail pages: url, title (publication and resource) and media type."""
    kept = [c for c in details.columns if c not in (html, title)]
    rows = details.select(*kept, F.col(title).alias("_title"), _props(F.col(html)).alias("props"))
    own = _objects(F.try_element_at("props", F.lit("resources")))
    nested = F.filter(F.transform(F.map_values("props"), lambda v: _objects(v, "$.resources")), lambda x: x.isNotNull() & (F.size(x) > 0))
    found = F.coalesce(F.when(F.size(own) > 0, own), F.try_element_at(nested, F.lit(1)), _first_list(F.col("props"), ("resource_link",)))
    rows = rows.select(*kept, "_title", F.posexplode(found).alias("pos", "r"))
    of = lambda k: F.coalesce(F.try_element_at("r", F.lit(k)), F.lit(""))
    name = F.regexp_replace(F.concat_ws(" - ", "_title", of("resource_name")), "^[ -]+|[ -]+$", "")
    return rows.where(of("resource_link") != "").select(*kept, "pos", of("resource_link").alias("url"), name.alias("title"), urls.content_type(of("resource_link"), "application/pdf").alias("content_type"))


def catalogue_entries(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """Datasets of data-catalogue pages: detail address and title."""
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*kept, F.posexplode(_first_list(_props(F.col(html)), CATALOGUE_IDS)).alias("pos", "d"))
    of = lambda *keys: F.coalesce(*[F.try_element_at("d", F.lit(k)) for k in keys], F.lit(""))
    number = of(*CATALOGUE_IDS)
    return rows.where(number != "").select(*kept, "pos", F.concat(F.lit(f"{base}/data-catalogue/"), number).alias("source_url"), of("title", "name", *CATALOGUE_IDS).alias("title"))


SECTION = "struct<name:string,page_type:string,source_type:string,doc_type:string,language:string,listing_pages:array<struct<url:string,label:string>>>"
SITE = f"struct<site_slug:string,agency:string,base_url:string,allowed_hosts:array<string>,request_delay:string,estimated_pages:string,sections:array<{SECTION}>>"


def coerced(value: Column, default: float | int) -> Column:
    """A setting's text as a number: the default for null and '', an error for what is no number."""
    number = "int" if isinstance(default, int) else "double"
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", F.lit(default)).otherwise(F.trim(value).cast(number))


def site_sections(configs: DataFrame, json: str = "json") -> DataFrame:
    """Site configurations (JSON, as any YAML reader gives it) as rows of listing pages: site, its numbers with
    defaults, section, kind, language and address.  Sections without listing pages keep a row."""
    sites = configs.select(F.from_json(json, SITE).alias("s")).select("s.*")
    rows = sites.select("site_slug", "agency", "base_url", coerced(F.col("request_delay"), 1.5).alias("request_delay"), coerced(F.col("estimated_pages"), 0).alias("estimated_pages"), F.posexplode("sections").alias("section_no", "x"))
    kind = F.coalesce("x.page_type", "x.source_type", F.lit("listing"))
    rows = rows.select("*", F.coalesce("x.name", F.lit("unknown")).alias("section"), kind.alias("page_type"), F.coalesce("x.doc_type", F.lit("other")).alias("doc_type"), F.coalesce("x.language", F.lit("ms")).alias("language"), F.posexplode_outer("x.listing_pages").alias("page_no", "p"))
    return rows.select("site_slug", "agency", "base_url", "request_delay", "estimated_pages", "section_no", "section", "page_type", "doc_type", "language", "page_no", F.col("p.url").alias("url"), F.col("p.label").alias("label"))


def heaviest_first(sites: DataFrame, slug: str = "site_slug", pages: str = "estimated_pages") -> list[Column]:
    """The order in which sites are crawled: the most pages first."""
    return [sites[pages].desc(), sites[slug].asc()]


def catalogue_matches(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Datasets that retrieved chunks (query_id, rank, dataset_id) stand for, once per question in order of rank."""
    first = rows.where(F.col("dataset_id").isNotNull()).groupBy("query_id", "dataset_id").agg(F.min("rank").alias("_first"))
    met = first.join(catalogue, "dataset_id")
    return met.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("_first", "dataset_id"))).drop("_first")


def live_texts(entries: DataFrame, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(dataset_id, text): the latest rows of datasets (dataset_id, title, endpoint, frequency) as a prompt has them;
    rows have dataset_id, ``pos`` and the columns, a bounded number per dataset."""
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])
    per = rows.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.array_join(cells, " | ").alias("line")))).alias("lines"))
    met = entries.join(per, "dataset_id", "left")
    n, header = F.size("lines"), " | ".join(columns)
    # fixed values: the sentences around live rows
    lead = F.concat(F.lit("Live data from data.gov.my — "), "title", F.lit(" (most recent "), n.cast("string"), F.lit(" records):"))
    tail = F.concat(F.lit("Source: data.gov.my ("), "endpoint", F.lit(", id="), "dataset_id", F.lit("). Updated "), "frequency", F.lit("."))
    said = F.array_join(F.concat(F.array(lead, F.lit(""), F.lit(header), F.lit("-" * len(header))), F.col("lines.line"), F.array(F.lit(""), tail)), "\n")
    nothing = F.concat(F.lit("[No data returned from data.gov.my for "), "title", F.lit("]"))
    return met.select("dataset_id", F.when(n > 0, said).otherwise(nothing).alias("text"))


def with_payloads(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """Records with the stored payload of their digest: its path and size; of several stored the first by path."""
    one = payloads.groupBy("sha256").agg(F.min(F.struct("path", "length")).alias("_p"))
    return records.join(one, "sha256", "left").withColumn("path", F.col("_p.path")).withColumn("length", F.col("_p.length")).drop("_p")
