"""Walks over fetched pages: listings and question archives with a budget of pages for each section.

An archive has an index of sessions, each session's page names categories, and a category is a chain of numbered
listing pages.  Pages are fetched already (url, html), so a walk is joins by address: two levels down, then along
the chains, whose pages at a distance of 1, 2, 4, … are found by joining a table of jumps with itself.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.functions import dates, urls
from marisight.operators.listings import NEXT, SITES, Rule, listings_by
from marisight.operators.tables import settled
from marisight.sources.html_nodes import page_selected, page_values, selected


def _href() -> Column:
    return F.trim(F.coalesce(F.try_element_at("attrs", F.lit("href")), F.lit("")))


def session_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, link, title, year): sessions that an archive's index names, first mention of each."""
    found = selected(pages, {"card": ("div.card", ()), "year": ("div.card [class*=card-header]", ("card",)), "link": ("div.card a[href*='/equans/']", ("card",))}, (url,), html)
    card = F.try_element_at("owners", F.lit("card"))
    is_year = F.col("name") == "year"
    heads = Window.partitionBy(url, "card")
    rows = found.where("name <> 'card'").withColumn("card", card).withColumn("year", F.coalesce(F.min_by(F.when(is_year, F.col("text")), F.when(is_year, F.col("pos"))).over(heads), F.lit("")))
    rows = rows.where("name = 'link'").groupBy(url, _href().alias("href")).agg(F.min("pos").alias("pos"), F.min_by(F.struct("year", "text"), "pos").alias("said"))
    return rows.select(url, "pos", urls.absolute(F.col("href"), F.col(url)).alias("link"), F.trim(F.concat_ws(" ", "said.year", "said.text")).alias("title"), "said.year")


def category_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, link): the listings that a session's page names, one a card, first mention of each."""
    found = selected(pages, {"card": ("div.card", ()), "link": ("div.card a[href]", ("card",))}, (url,), html).where("name = 'link'")
    rows = found.groupBy(url, F.try_element_at("owners", F.lit("card")).alias("card")).agg(F.min_by(F.struct(_href().alias("href"), "pos"), "pos").alias("first"))
    rows = rows.where(F.contains("first.href", F.lit("/question"))).groupBy(url, "first.href").agg(F.min("first.pos").alias("pos"))
    return rows.select(url, "pos", urls.absolute(F.col("href"), F.col(url)).alias("link"))


def numbered_next(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, next_url): the page after the active one: the link of an item marked next, else the one whose number is one
    more than the active item's.  Links to ``#`` lead nowhere."""
    wanted = {"item": ("li.page-item", ()), "next": ("li.page-item.next a[href]", ("item",)), "active": ("li.page-item.active", ()), "off": ("li.page-item.disabled a[href], li.page-item.active a[href]", ()), "link": ("li.page-item a[href]", ())}
    found = selected(pages, wanted, (url,), html).where("name <> 'item'")
    good = (_href() != "#") & (_href() != "")
    is_next, is_active = (F.col("name") == "next") & good, F.col("name") == "active"
    is_number = (F.col("name") == "link") & good & F.col("text").rlike(r"^\d+$")
    per = found.groupBy(url).agg(
        F.min_by(F.when(is_next, _href()), F.when(is_next, F.col("pos"))).alias("marked"), F.min_by(F.when(is_active, F.col("text")), F.when(is_active, F.col("pos"))).alias("active"),
        F.array_sort(F.collect_list(F.when(is_number, F.struct("pos", "text", _href().alias("href"))))).alias("numbers"), F.collect_set(F.when(F.col("name") == "off", F.col("pos"))).alias("off"),
    )
    after = F.when(F.col("active").rlike(r"^\d+$"), (F.col("active").cast("decimal(38,0)") + 1).cast("string"))
    href = F.coalesce("marked", F.get(F.filter("numbers", lambda x: (x["text"] == after) & ~F.array_contains("off", x["pos"])), F.lit(0))["href"])
    return per.where(href.isNotNull()).select(url, urls.absolute(href, F.col(url)).alias("next_url"))


_MARKS = tuple((f"mark{i}", selector, ()) for i, selector in enumerate((*NEXT, "div[class*=pagination] div[class*=alignright] a[href]")))
_NUMBERS = (("next", "li.page-item.next a[href]", ()), ("active", "li.page-item.active", ()), ("off", "li.page-item.disabled a[href], li.page-item.active a[href]", ()), ("number", "li.page-item a[href]", ()))


def next_href(page: str) -> tuple[bool, str] | None:
    """(whether it is by numbers, href) of the link to the page after this one: the first one marked or labelled next, as
    ``next_page`` finds it, else what ``numbered_next`` finds; by one reading of the page."""
    marked = after = active = None
    numbers, off = [], set()
    for node in page_selected(page, (*_MARKS, ("a", "a[href]", ()), *_NUMBERS)):
        name, pos, text, href = node["name"], node["pos"], node["text"], dict(node["attrs"]).get("href")
        if name.startswith("mark") or name == "a":
            if href is not None and (name != "a" or text.lower() in ("next", "seterusnya", "»", "›")):
                return False, href
            continue
        href = (href or "").strip(" ")
        good = href not in ("", "#")
        if name == "off":
            off.add(pos)
        elif name == "active":
            active = text if active is None else active
        elif name == "next" and good and marked is None:
            marked = href
        elif name == "number" and good and re.fullmatch("[0-9]+", text):
            numbers.append((pos, text, href))
    if active and re.fullmatch("[0-9]{1,37}", active):
        number = str(int(active) + 1)
        after = next((href for pos, text, href in numbers if text == number and pos not in off), None)
    href = after if marked is None else marked
    return None if href is None else (True, href)


def chains(starts: DataFrame, nexts: DataFrame, most: int) -> DataFrame:
    """(columns of starts, step): each start's ``url`` and those reached from it by up to ``most`` - 1 steps of nexts
    (url, next_url), one of each url.  A chain that closes goes round until it has ``most`` pages."""
    keep = [c for c in starts.columns if c != "url"]
    reached, jumps, span = starts.withColumn("step", F.lit(0)), nexts.select("url", F.col("next_url").alias("to")), 1
    while span < most:
        on = reached.join(jumps, "url").select(*keep, F.col("to").alias("url"), (F.col("step") + span).alias("step")).where(F.col("step") < most)
        reached = settled(reached.unionByName(on))
        span *= 2
        if span < most:
            jumps = settled(jumps.alias("a").join(jumps.alias("b"), F.col("a.to") == F.col("b.url")).select("a.url", "b.to"))
            if jumps.isEmpty():
                break
    return reached


def question_walk(pages: DataFrame, sections: DataFrame, most: int = 1000) -> DataFrame:
    """(section, turn, url, link, title): questions of archives, from pages (url, html) and sections (section, url,
    max_pages).  A section's listing pages are taken session by session, category by category, page by page, until
    ``max_pages`` of them (null or 0: all) are taken, pages not fetched ending their chain; ``turn`` counts them.  No
    category has more than ``most`` pages.  A section whose url is itself a listing starts there."""
    listing = F.contains("url", F.lit("/question"))
    direct = sections.where(listing).select("section", "url", F.lit(0).alias("session"), F.lit(0).alias("category"))
    inner = sections.where(~listing).select("section", "url")
    bodies = lambda of: pages.join(of.select("url").distinct(), "url", "left_semi")
    sessions = settled(inner.join(session_links(bodies(inner)), "url").select("section", F.col("link").alias("url"), F.col("pos").alias("session")))
    found = sessions.join(category_links(bodies(sessions)), "url").select("section", F.col("link").alias("url"), "session", F.col("pos").alias("category"))
    starts = settled(direct.unionByName(found))
    longest = sections.agg(F.max(F.when(F.coalesce("max_pages", F.lit(0)) > 0, F.col("max_pages")).otherwise(most))).first()[0] or 0
    listings = pages.where(listing)
    nexts = settled(numbered_next(listings).join(listings.select("url"), "url", "left_semi"))
    walked = chains(starts, nexts, min(longest, most)).join(listings.select("url").distinct(), "url", "left_semi")
    order = Window.partitionBy("section").orderBy("session", "category", "step")
    budget = sections.select("section", F.col("max_pages").alias("_most")).distinct()
    walked = walked.withColumn("turn", F.row_number().over(order)).join(budget, "section").where((F.coalesce("_most", F.lit(0)) == 0) | (F.col("turn") <= F.col("_most")))
    walked = settled(walked.select("section", "turn", "url"))
    return walked.join(questions(bodies(walked)), "url").select("section", "turn", "url", "link", "title")


def listing_walk(pages: DataFrame, sections: DataFrame, rules: dict[str, tuple[Rule, ...]] = SITES, since: str | None = None, most: int = 1000) -> DataFrame:
    """(section, turn, pos, title, link, date_text, published_at): items of listings that go on over pages, from pages
    (url, html) and sections (section, site, url, max_pages).  The next page is the one behind a link marked next, else
    the one after the active number; a section takes its first ``max_pages`` pages (null or 0: ``most``), pages that
    aren't fetched end it.  Each page is read after the rules of its section's site; a link counts where it is
    mentioned first, and items dated before ``since`` drop out."""
    nexts = settled(page_values(pages, next_href, "numbered boolean, href string", ("url",)).groupBy("url").agg(F.min_by("href", "numbered").alias("href")).select("url", urls.absolute(F.col("href"), F.col("url")).alias("next_url")))
    limit = F.coalesce(F.nullif("max_pages", F.lit(0)), F.lit(most))
    longest = sections.agg(F.max(limit)).first()[0] or 0
    walked = chains(sections.select("section", "site", "url", limit.alias("_most")), nexts, min(longest, most))
    walked = settled(walked.where(F.col("step") < F.col("_most")).select("section", "site", "url", (F.col("step") + 1).alias("turn")))
    known = {r.site for r in walked.where(F.col("site").isin(*rules)).select("site").distinct().collect()}  # of the rules' names
    asked = pages.join(walked.select("url", "site").distinct(), "url").select(F.col("url").alias("_key"), "url", "site", "html")
    items = listings_by(asked, {site: rule for site, rule in rules.items() if site in known} or rules, "site", key="_key").withColumnRenamed("_key", "url")
    rows = walked.join(items, ["url", "site"])
    if since is not None:
        rows = rows.where(dates.since(F.col("published_at"), F.lit(since).cast("date")))
    first = Window.partitionBy("section", "link").orderBy("turn", "pos")
    rows = rows.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    return rows.select("section", "turn", "pos", "title", "link", "date_text", "published_at")


def questions(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, link, title): the question cards of listing pages, first mention of each."""
    heads = ", ".join(f"div.question {h}[class*=card-header]" for h in ("h2", "h3"))
    wanted = {"card": ("div.question", ()), "head": (heads, ("card",)), "link": (", ".join(f"{h} a[href]" for h in heads.split(", ")), ("card", "head"))}
    found = selected(pages, wanted, (url,), html)
    own = lambda name: F.try_element_at("owners", F.lit(name))
    is_head, is_link = F.col("name") == "head", F.col("name") == "link"
    cards = found.where(is_head | is_link).groupBy(url, own("card").alias("card")).agg(F.min(F.when(is_head, F.col("pos"))).alias("head"), F.array_sort(F.collect_list(F.when(is_link, F.struct("pos", own("head").alias("head"), _href().alias("href"), "text")))).alias("links"))
    one = cards.select(url, F.get(F.filter("links", lambda a: a["head"] == F.col("head")), F.lit(0)).alias("a")).select(url, "a.href", "a.pos", "a.text").where("href <> ''")
    rows = one.groupBy(url, "href").agg(F.min("pos").alias("pos"), F.min_by("text", "pos").alias("title"))
    return rows.select(url, "pos", urls.absolute(F.col("href"), F.col(url)).alias("link"), "title")
