"""Link and listing extraction from HTML as tables, and frontier crawls over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisight.operators.tables import settled
from marisight.functions import urls
from marisight.operators.state import first_seen

_ANCHOR = r"(?is)(<a\s[^>]*?href\s*=\s*(?:\"[^\"]*\"|'[^']*')[^>]*>.*?</a>)"
_FRAME = r"(?is)(<iframe\s[^>]*?src\s*=\s*(?:\"[^\"]*\"|'[^']*'))"

#: levels of a crawl that are kept in tables of their own
_TOGETHER = 40


def attribute(tag: Column, name: str) -> Column:
    both = F.coalesce(F.nullif(F.regexp_extract(tag, rf"(?is)^<[^>]*?\s{name}\s*=\s*\"([^\"]*)\"", 1), F.lit("")), F.regexp_extract(tag, rf"(?is)^<[^>]*?\s{name}\s*=\s*'([^']*)'", 1))
    return F.trim(F.replace(both, F.lit("&amp;"), F.lit("&")))


def inner_text(tag: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(tag, r"(?s)<[^>]*>", ""), r"\s+", " "))


def anchors(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(page columns, pos, href, label, link): the anchors of each page, resolved against its address."""
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(_ANCHOR), 1)).alias("pos", "tag"))
    rows = rows.select(*keep, "pos", attribute(F.col("tag"), "href").alias("href"), inner_text(F.col("tag")).alias("label"))
    return rows.withColumn("link", urls.absolute(F.col("href"), F.col(url)))


def document_links(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, pos, link, label): downloadable documents of each page, first mention of each: by suffix, by
    attachment path, by a download word in the label, and files shown in a viewer frame."""
    found = anchors(pages.select(key, url, html), html, url)
    wanted = urls.is_document(F.col("link")) | F.contains("href", F.lit("/getattachment/")) | F.contains(F.lower(urls.path(F.col("link"))), F.lit("/file")) | F.lower("label").rlike(r"muat\s*turun|download|unduh|descargar")
    plain = found.where((F.col("href") != "") & wanted).select(key, "pos", "link", F.coalesce(F.nullif(F.col("label"), F.lit("")), "href").alias("label"))
    frames = pages.select(key, url, F.posexplode(F.regexp_extract_all(html, F.lit(_FRAME), 1)).alias("pos", "tag")).withColumn("src", attribute(F.concat("tag", F.lit(">")), "src"))
    frames = frames.where(F.contains(F.lower("src"), F.lit("viewer")) & F.contains("src", F.lit("file=")))
    shown = F.try_url_decode(F.regexp_extract("src", "file=([^&]+)", 1))
    frames = frames.select(key, (F.col("pos") + 1_000_000).alias("pos"), urls.absolute(shown, F.col(url)).alias("link"), F.lit("pdfjs-viewer embed").alias("label"))
    rows = plain.unionByName(frames).where(F.col("link").startswith("http")).withColumn("_key", F.struct(key, "link"))
    return first_seen(rows, "_key", "pos").drop("_key")


def candidates(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A page itself (pos -1) and its document links, as crawl candidates."""
    own = pages.select(key, F.lit(-1).alias("pos"), F.col("url").alias("link"), F.lit("").alias("label"))
    rows = own.unionByName(document_links(pages, key))
    return rows.withColumn("content_type", urls.content_type(F.col("link"))).withColumn("canonical_url", urls.canonical(F.col("link")))


def meta(html: Column, name: str) -> Column:
    """Content of a meta tag by name or property."""
    tag = F.regexp_extract(html, rf"(?is)(<meta\s[^>]*?(?:name|property)\s*=\s*[\"']{name}[\"'][^>]*>)", 1)
    return attribute(tag, "content")


def element_text(html: Column, element: str) -> Column:
    """Text of the first element of a name."""
    return inner_text(F.regexp_extract(html, rf"(?is)<{element}\b[^>]*>(.*?)</{element}\s*>", 1))


def page_title(html: Column) -> Column:
    """First of h1, h2, h3, og:title and title that isn't empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (element_text(html, "h1"), element_text(html, "h2"), element_text(html, "h3"), meta(html, "og:title"), element_text(html, "title"))], F.lit(""))


def table_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, cells, links): rows of all tables with their cell texts and addresses."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), 1)).alias("pos", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), 1), inner_text)
    return rows.select(key, "pos", cells.alias("cells"), F.regexp_extract_all("row", F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)"), 1).alias("links"))


def crawl(start: DataFrame, links: DataFrame, most_levels: int = 1000, most_pages: int | None = None) -> DataFrame:
    """(url, level): pages reached from start over links (url, link), breadth first, until nothing new is reached or
    the page budget is full.  Each level writes what is new in it alone; more than ``most_levels`` levels are an error."""
    links = settled(links.select("url", "link").repartition("url")).hint("merge")  # not made, nor sent to the driver for a broadcast, at every level
    edge = settled(start.select("url").distinct().withColumn("level", F.lit(0)))
    levels, n = [edge], edge.count() if most_pages is not None else 0
    for level in range(1, most_levels + 1):
        new = edge.join(links, "url").select(F.col("link").alias("url")).distinct()
        seen = reduce(DataFrame.unionByName, levels)
        edge = settled(new.join(seen.hint("merge"), "url", "left_anti").withColumn("level", F.lit(level)))
        if edge.isEmpty():
            break
        levels.append(edge)
        if len(levels) > _TOGETHER:  # few tables to read, each row written a few times at most
            levels = [settled(reduce(DataFrame.unionByName, levels))]
        if most_pages is not None:
            n += edge.count()
            if n >= most_pages:
                break
    else:
        raise RuntimeError(f"pages are more than {most_levels} links away")
    seen = reduce(DataFrame.unionByName, levels)
    return seen if most_pages is None else seen.orderBy("level", "url").limit(most_pages)
