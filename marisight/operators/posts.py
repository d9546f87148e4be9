"""Title, date and attached files of article pages, by chains of places that are looked at in order.

A kind of page is a row of ``POSTS``: selectors for titles and dates, each with the attribute that says it (else the
text), and for the element that holds the article's own links.  Pages of all kinds are parsed once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.functions import dates, urls
from marisight.functions.text import collapsed, language_code, without_prefix
from marisight.sources.html_nodes import selected

Place = tuple[str, str]


@dataclass(frozen=True)
class Post:
    titles: tuple[Place, ...]
    dates: tuple[Place, ...]
    content: tuple[str, ...]
    marks: tuple[str, ...] = (" | ", " - ", " – ")  # the title element is cut at the first of these that it has
    ranges: str = ""  # a place whose text is a range of days
    date_of_url: bool = False
    prefixed: bool = False  # the title element may begin with the site's name
    more: str = ""  # links that are files whatever they look like


_OG, _PUBLISHED = ("meta[property='og:title']", "content"), ("meta[property='article:published_time']", "content")
_ITEM = "[itemprop=articleBody]", "article", "div[class*=item-page]"
#: fixed values: where the known kinds of pages have their titles, dates and content
POSTS = {
    "wordpress": Post(
        ((", ".join(f"h1[class*={c}-title]" for c in ("entry", "post", "page")), ""), _OG),
        (("time.entry-date.published", "datetime"), ("time.published", "datetime"), _PUBLISHED, ("span.published", ""), ("time.updated", "datetime")),
        (", ".join(f"div[class*={c}]" for c in ("entry-content", "post-content", "article-body")),),
        ("|", "–"),
        "div.sidang-details p.lead small",
    ),
    "joomla": Post(
        (("h1[itemprop=headline]", ""), ("article h1, article h2", ""), ("div[class*=item-page] h1, div[class*=item-page] h2", ""), ("div[class*=com-content-article] h1, div[class*=com-content-article] h2", ""), _OG),
        (("time[itemprop=datePublished]", "datetime"), ("time[itemprop=datePublished]", ""), ("time[itemprop=dateModified]", "datetime"), _PUBLISHED),
        _ITEM,
    ),
    "sitefinity": Post(
        (*[(f"h1.{c}", "") for c in ("sfnewsTitle", "sfArticleTitle", "sfContentTitle")], _OG),
        ((".sfnewsMetaInfo .sfnewsDate", ""), (".sfnewsMetaInfo", ""), _PUBLISHED, ("time[datetime]", "datetime")),
        (".sfnewsContent", ".sfContentBlock", ".sfArticleContainer", "article"),
        date_of_url=True,
    ),
    "divi": Post(
        ((", ".join(f"h1[class*={c}-title]" for c in ("entry", "post", "page")), ""), _OG),
        (_PUBLISHED, ("time.entry-date.published, time.published", "datetime"), ("span.published", ""), ("time.updated", "datetime")),
        (", ".join(f"div[class*={c}]" for c in ("entry-content", "post-content", "article-body")),),
        ("|", "–"),
        more="a.inddl[href*=wpdmdl]",
    ),
    "education": Post(
        (("h1", ""), ("h2", ""), ("h3", "")),
        (_PUBLISHED, ("meta[name=pubdate]", "content"), ("meta[name=date]", "content"), ("time[datetime]", "datetime"), (".published, .date, .post-date", "")),
        (),
        (),
        prefixed=True,
    ),
}


def _attribute(name: str) -> Column:
    return F.trim(F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit("")))


def _cut(title: Column, marks: tuple[str, ...]) -> Column:
    """A title up to the first of the marks that it has."""
    out = title
    for mark in reversed(marks):
        out = F.when(F.contains(title, F.lit(mark)), F.trim(F.substring_index(title, mark, 1))).otherwise(out)
    return out


def meta(pages: DataFrame, key: str = "page_id", kind: str = "wordpress", html: str = "html", url: str = "url") -> DataFrame:
    """(key, title, published_at, language) of pages of one kind: for each the first place that gives something, else ''
    (no language: null)."""
    post = POSTS[kind]
    places = {**{f"t{i}": p for i, p in enumerate(post.titles)}, **{f"d{i}": p for i, p in enumerate(post.dates)}, "title": ("title", ""), "html": ("html[lang]", "lang")}
    if post.ranges:
        places["range"] = (post.ranges, "")
    found = selected(pages, {name: (selector, ()) for name, (selector, _) in places.items()}, (key,), html)
    said = F.coalesce(*[F.when(F.col("name") == name, _attribute(attribute)) for name, (_, attribute) in places.items() if attribute], F.col("text"))
    found = found.withColumn("said", said)
    some_of = lambda name: (F.col("name") == name) & (F.col("said") != "")
    first = lambda name: F.min_by(F.when(some_of(name), collapsed(F.col("said"))), F.when(some_of(name), F.col("pos"))).alias(name)
    rows = pages.select(key, F.col(url).alias("_url")).join(found.groupBy(key).agg(*[first(name) for name in places]), key, "left")
    days = [dates.parse_date(F.col(f"d{i}")) for i in range(len(post.dates))]
    days = [*([dates.path_date(F.col("_url"))] if post.date_of_url else []), *days, *([dates.range_start(F.coalesce("range", F.lit("")))] if post.ranges else [])]
    some = lambda columns: F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))
    title = _cut(without_prefix(F.col("title")) if post.prefixed else F.col("title"), post.marks)
    return rows.select(key, some([*[F.col(f"t{i}") for i in range(len(post.titles))], title]).alias("title"), some(days).alias("published_at"), language_code(F.col("html")).alias("language"))


#: fixed values: labels of a package's facts
_CREATED, _UPDATED = ("Create Date", "Tarikh Cipta"), ("Last Updated", "Tarikh Kemaskini")


def package_meta(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, title, published_at, description) of pages of a download manager's packages: the day of creation, else that
    of the last update, from the list of facts, else the page's own; '' for what is missing."""
    fact = "div.w3eden ul.list-group li.list-group-item"
    wanted = {
        "h1": ("h1[class*=entry-title], h1[class*=post-title]", ()), "og": _OG[:1] + ((),), "fact": (fact, ()), "badge": (f"{fact} span.badge", ("fact",)),
        "span": ("span.published", ()), "box": ("div.w3eden div[class*=col-md-12]", ()), "p": ("div.w3eden div[class*=col-md-12] p", ("box",)),
    }
    found = selected(pages, wanted, (key,), html)
    badge = F.col("name") == "badge"
    facts = found.where("name IN ('fact', 'badge')").groupBy(key, F.coalesce(F.try_element_at("owners", F.lit("fact")), F.col("pos")).alias("at")).agg(F.max(F.when(~badge, F.col("text"))).alias("said"), F.min_by(F.when(badge, F.col("text")), F.when(badge, F.col("pos"))).alias("badge"))
    labelled = lambda names: F.coalesce(*[F.when(F.contains("said", F.lit(n)), F.lit(True)) for n in names], F.lit(False))
    days = facts.where("badge IS NOT NULL").withColumn("day", dates.parse_date(F.col("badge"))).withColumn("kind", F.when(labelled(_CREATED), 0).when(labelled(_UPDATED), 1)).where("kind IS NOT NULL AND day <> ''")
    days = days.groupBy(key).agg(F.min_by("day", F.struct("kind", "at")).alias("day"))
    first = lambda name, value, order="pos": F.min_by(F.when((F.col("name") == name) & (value != ""), value), F.when((F.col("name") == name) & (value != ""), F.col(order)))
    said = found.groupBy(key).agg(first("h1", F.col("text")).alias("h1"), first("og", _attribute("content")).alias("og"), first("span", F.col("text")).alias("span"), first("p", F.col("text")).alias("p"))
    rows = pages.select(key).join(said, key, "left").join(days, key, "left")
    nothing = F.lit("")
    title = F.coalesce("h1", _cut(F.col("og"), POSTS["divi"].marks), nothing)
    return rows.select(key, title.alias("title"), F.coalesce("day", dates.parse_date(F.col("span")), nothing).alias("published_at"), F.coalesce("p", nothing).alias("description"))


def attached(pages: DataFrame, key: str = "page_id", kind: str = "wordpress", html: str = "html", url: str = "url") -> DataFrame:
    """(key, rank, link, label): files of article pages, first mention of each: those shown in a viewer frame, documents
    that the content links (of the whole page if it has no content element), and lists of attachments."""
    post = POSTS[kind]
    boxes = {f"c{i}": (s, ()) for i, s in enumerate(post.content)}
    more = {"more": (post.more, ())} if post.more else {}
    wanted = {**boxes, **more, "list": ("div.list-of-attachments", ()), "frame": ("iframe[src]", ()), "a": ("a[href]", (*boxes, "list"))}
    found = selected(pages, wanted, (key, url), html)
    is_box = F.col("name").isin(*boxes) if boxes else F.lit(False)
    rows = found.select(key, url, "name", "pos", "last", "owners", "attrs", F.when(~is_box, F.col("text")).alias("text"))
    rows = rows.withColumn("area", F.min(F.when(is_box, F.struct("name", "pos", "last"))).over(Window.partitionBy(key))).where(~is_box)
    inside = F.col("area").isNull() | ((F.col("pos") > F.col("area.pos")) & (F.col("pos") <= F.col("area.last")))
    href, src = _attribute("href"), _attribute("src")
    viewed = F.when(F.contains(F.lower(src), F.lit("viewer")), F.try_url_decode(F.regexp_extract(src, r"[?&]file=([^&]+)", 1)))
    link = urls.absolute(F.when(F.col("name") == "frame", viewed).otherwise(href), F.col(url))
    turn = F.when(F.col("name") == "frame", F.when(F.coalesce(viewed, F.lit("")) != "", 0)).when(F.try_element_at("owners", F.lit("list")).isNotNull(), 2).when(F.col("name") == "more", 3).when(inside & urls.is_document(link), 1)
    rows = rows.where((F.col("name") == "frame") | (F.col("name").isin("a", "more") & (href != "") & ~urls.skipped_href(href)))
    rows = rows.select(key, turn.alias("turn"), "pos", link.alias("link"), F.when(F.col("name") == "frame", "pdfjs-viewer embed").otherwise(F.coalesce(F.nullif("text", F.lit("")), href)).alias("label"))
    rows = rows.where("turn IS NOT NULL AND link LIKE 'http%'").groupBy(key, "link").agg(F.min(F.struct("turn", "pos")).alias("at"), F.min_by("label", F.struct("turn", "pos")).alias("label"))
    return rows.select(key, "at", "link", "label")
