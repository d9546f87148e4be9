"""Crawl and index state, conversations, quotas and constraints as set operations.

Tables of state are snapshots: an operator takes the old one and the new rows and returns the next.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: tuple[str, ...] = ()) -> DataFrame:
    """old with new rows in place of those of the same key; of several new rows the last by ``loaded_at``, of
    equal times the one of the highest content hash.  ``keep_old`` columns keep the earlier value where there is one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys)
    for c in keep_old:
        first = F.min_by(F.when(F.col("_new") == 0, F.col(c)), "loaded_at").over(w)
        both = both.withColumn(c, F.coalesce(first, F.col(c)))
    content = F.xxhash64(*[c for c in both.columns if c not in ("_new", "loaded_at")])
    return both.withColumn("_r", F.row_number().over(w.orderBy(F.desc("_new"), F.desc("loaded_at"), content.desc()))).where("_r = 1").drop("_r", "_new")


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    fresh = new.join(old.select(*keys), keys, "left_anti").dropDuplicates(keys)
    return old.unionByName(fresh, allowMissingColumns=True)


def pending(manifest: DataFrame, indexed: DataFrame, incremental: bool = True) -> DataFrame:
    """Objects whose (storage_path, version_token) isn't indexed yet; all of them in a full run."""
    return manifest.join(indexed.select("storage_path", "version_token"), ["storage_path", "version_token"], "left_anti") if incremental else manifest


def classified(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Candidates (canonical_url, sha256, seq) as known_url, duplicate (content archived before or earlier in
    the batch, with the path it reuses), changed (known URL, other content) or new.

    ``compat`` holds what a run that never looks at known URLs again would say.
    """
    known = state.groupBy("canonical_url").agg(F.max("sha256").alias("old_sha256"))
    stored = state.groupBy("sha256").agg(F.min_by("spaces_path", "canonical_url").alias("old_path"))
    first = candidates.groupBy("sha256").agg(F.min("seq").alias("_first"))  # pre-aggregated, however often a file recurs
    rows = candidates.join(known, "canonical_url", "left").join(stored.join(first, "sha256", "full_outer"), "sha256", "left")
    reused = F.col("old_path").isNotNull() | (F.col("seq") > F.col("_first"))
    kind = F.when(F.col("old_sha256") == F.col("sha256"), "known_url").when(F.col("old_sha256").isNotNull(), "changed").when(reused, "duplicate").otherwise("new")
    compat = F.when(F.col("old_sha256").isNotNull(), "known_url").when(reused, "duplicate").otherwise("new")
    return rows.select(*candidates.columns, kind.alias("kind"), compat.alias("compat"), F.col("old_path").alias("reused_path"))


def unchanged(etag: Column, old_etag: Column, modified: Column, old_modified: Column) -> Column:
    """Whether a validator is present on both sides and equal."""
    same = lambda a, b: F.coalesce((a != "") & (a == b), F.lit(False))
    return same(etag, old_etag) | same(modified, old_modified)


def with_activity(state: DataFrame, seen: DataFrame, key: str = "canonical_url") -> DataFrame:
    """state with ``active``: whether the key was seen."""
    mark = seen.select(key).distinct().withColumn("_seen", F.lit(True))
    return state.drop("active").join(mark, key, "left").withColumn("active", F.col("_seen").isNotNull()).drop("_seen")


def state_counts(state: DataFrame) -> DataFrame:
    return state.agg(F.count(F.lit(1)).alias("total"), F.count_if("active").alias("active"), F.count_if(~F.col("active")).alias("inactive"))


def latest(records: DataFrame, key: str, value: str, at: str) -> DataFrame:
    return records.groupBy(key).agg(F.max_by(value, at).alias(value))


def run_summary(rows: DataFrame, site: str = "slug", kind: str = "kind") -> DataFrame:
    """Counts per site and in total (null site)."""
    return rows.rollup(site).agg(*[F.count_if(F.col(kind) == k).alias(f"{k}_count") for k in ("new", "changed", "duplicate", "known_url")], F.count(F.lit(1)).alias("total"))


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def united(key: str, *lists: DataFrame) -> DataFrame:
    """Ordered union of (key, pos) lists without repeats: earlier lists first."""
    rows = reduce(DataFrame.unionByName, [x.select(key, "pos", F.lit(i).alias("list_no")) for i, x in enumerate(lists)])
    return first_seen(rows, key, "list_no", "pos")


def merged_listings(listing: DataFrame, feed: DataFrame, key: str = "url", fields: tuple[str, ...] = ("title", "published_at")) -> DataFrame:
    """Items of either source; the listing's fields where they aren't empty, else the feed's."""
    both = listing.select(key, *[F.col(f).alias(f"_l_{f}") for f in fields]).join(feed.select(key, *[F.col(f).alias(f"_f_{f}") for f in fields]), key, "full_outer")
    return both.select(key, *[F.coalesce(F.nullif(F.col(f"_l_{f}"), F.lit("")), F.col(f"_f_{f}"), F.lit("")).alias(f) for f in fields])


def cut_to(rows: DataFrame, prefix: str | None = None, most: int | None = None, path: str = "storage_path") -> DataFrame:
    """Rows in the order of their path, of a path prefix and at most so many if given (a top-k by path)."""
    if prefix is not None:
        rows = rows.where(F.startswith(F.col(path), F.lit(prefix)))
    return rows.orderBy(path) if most is None else rows.orderBy(path).limit(most)


def index_counters(manifest: DataFrame, chosen: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row of counts of an index run: outcomes (storage_path, failed, n_chunks) of the chosen objects; objects
    of the manifest that were neither processed nor failed are skipped."""
    met = chosen.join(outcomes, "storage_path", "left").select(F.coalesce("failed", F.lit(False)).alias("failed"), F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n"), F.lit(0).alias("one"))
    rows = met.unionByName(manifest.select(F.lit(None).cast("boolean").alias("failed"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("one")))
    good, bad = F.count_if(~F.col("failed")), F.count_if("failed")
    skipped = F.greatest(F.lit(0), F.coalesce(F.sum("one"), F.lit(0)) - good - bad)
    return rows.agg(good.alias("processed_documents"), skipped.alias("skipped_documents"), F.coalesce(F.sum(F.when(~F.col("failed"), F.col("n"))), F.lit(0)).alias("persisted_chunks"), bad.alias("failed_documents"))


def capped(rows: DataFrame, section: str, per_section: int, order: str) -> DataFrame:
    """The first pages of each section, as a crawl's page budget allows."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(section).orderBy(order))).where(F.col("_r") <= per_section).drop("_r")


# --- conversations -------------------------------------------------------------------------------


def listing_order() -> list[Column]:
    """Pinned first, then the most recent."""
    return [F.coalesce("pinned", F.lit(False)).desc(), F.col("updated_at").desc(), F.col("id").asc()]


def conversation_list(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Conversations with their number of messages, zero included, and their ``position`` in their user's list."""
    n = messages.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("message_count"))
    met = conversations.join(n, conversations["id"] == n["conversation_id"], "left").drop("conversation_id")
    position = F.row_number().over(Window.partitionBy("user_id").orderBy(*listing_order()))
    return met.withColumn("message_count", F.coalesce("message_count", F.lit(0))).withColumn("position", position)


def conversation_bucket(updated_at: Column, pinned: Column, as_of: Column) -> Column:
    """pinned, today, yesterday, last 7 days or older, by midnights before ``as_of``."""
    day = F.datediff(F.to_date(as_of), F.to_date(updated_at))
    return F.when(F.coalesce(pinned, F.lit(False)), "pinned").when(day <= 0, "today").when(day == 1, "yesterday").when(day <= 7, "last_7_days").otherwise("older")


def title_matches(title: Column, wanted: Column) -> Column:
    return F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lower(wanted))


def recent_messages(messages: DataFrame, n: int) -> DataFrame:
    """The last n messages of each conversation."""
    w = Window.partitionBy("conversation_id").orderBy(F.desc("turn"))
    return messages.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def history_text(messages: DataFrame, n: int) -> DataFrame:
    """ROLE: text lines of the last n messages of each conversation, oldest first."""
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.upper("role"), F.lit(": "), F.col("text")).alias("line"))))
    return recent_messages(messages, n).groupBy("conversation_id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("history"))


def with_citations(messages: DataFrame, citations: DataFrame) -> DataFrame:
    """Messages with their citations nested in order; an empty array without any."""
    nested = citations.groupBy("message_id").agg(F.array_sort(F.collect_list(F.struct("citation_index", "document_id"))).alias("citations"))
    met = messages.join(nested, messages["id"] == nested["message_id"], "left").drop("message_id")
    return met.withColumn("citations", F.coalesce("citations", F.array().cast(nested.schema["citations"].dataType)))


def rated(ratings: DataFrame, submitted: DataFrame) -> DataFrame:
    """(message_id, user_id, rating) after ratings were submitted in the order of ``at``: one per message and user,
    the last one standing; a rating of 0 is refused."""
    rows = ratings.select("message_id", "user_id", "rating", F.lit(0).alias("_new"), F.lit(None).cast(submitted.schema["at"].dataType).alias("at"))
    rows = rows.unionByName(submitted.where("rating <> 0").select("message_id", "user_id", "rating", F.lit(1).alias("_new"), "at"))
    return rows.groupBy("message_id", "user_id").agg(F.max_by("rating", F.struct("_new", "at", "rating")).alias("rating"))


def conversation_feedback(messages: DataFrame, ratings: DataFrame, conversation: Column) -> DataFrame:
    """(conversation_id, user_id, message_id, rating) of the wanted conversations, for whoever rated them."""
    wanted = messages.where(conversation).select("conversation_id", F.col("id").alias("message_id"))
    return wanted.join(ratings, "message_id").select("conversation_id", "user_id", "message_id", "rating")


def with_messages(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """conversations after messages (conversation_id, language, at) were added: a language is set only where there was
    none, by the first message that has one, and ``updated_at`` is the last message's time."""
    new = messages.groupBy("conversation_id").agg(F.min_by("language", F.when(F.col("language").isNotNull(), F.col("at"))).alias("_language"), F.max("at").alias("_at"))
    met = conversations.join(new, conversations["id"] == new["conversation_id"], "left")
    changed = met.withColumn("language", F.coalesce("language", "_language")).withColumn("updated_at", F.coalesce("_at", "updated_at"))
    return changed.select(*conversations.columns)


def changed(conversations: DataFrame, changes: DataFrame) -> DataFrame:
    """conversations after changes (id, user_id, title, pinned), one per conversation: what isn't null is set, on
    conversations of that user only."""
    new = changes.select("id", "user_id", F.col("title").alias("_title"), F.col("pinned").alias("_pinned"))
    met = conversations.join(new, ["id", "user_id"], "left").withColumn("title", F.coalesce("_title", "title")).withColumn("pinned", F.coalesce("_pinned", "pinned"))
    return met.select(*conversations.columns)


def owned(rows: DataFrame, parents: DataFrame, child: str, parent: str = "id") -> DataFrame:
    """Rows whose parent row is visible; chains of these give row-level security of grandchildren."""
    return rows.join(parents.select(F.col(parent).alias(child)).distinct(), child, "left_semi")


def without(rows: DataFrame, doomed: DataFrame, child: str, parent: str = "id") -> DataFrame:
    """Rows left after their parents are deleted, as a cascade takes them."""
    return rows.join(doomed.select(F.col(parent).alias(child)).distinct(), child, "left_anti")


# --- quotas and constraints ----------------------------------------------------------------------


def token_cost(max_tokens: Column, attachments: Column, default: int = 1200, each: int = 2000) -> Column:
    return F.coalesce(max_tokens, F.lit(default)) + F.coalesce(attachments, F.lit(0)) * each


def daily_usage(requests: DataFrame) -> DataFrame:
    return requests.groupBy("user_id", F.to_date("ts").alias("usage_date")).agg(F.count(F.lit(1)).alias("request_count"), F.sum("tokens").alias("tokens_budgeted"))


def quota_decisions(requests: DataFrame, max_requests: int = 25, max_tokens: int = 15_000) -> DataFrame:
    """requests (request_id, user_id, ts, tokens) with running totals of the user's day and ``allowed``;
    refused requests count as well."""
    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "request_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = requests.withColumn("running_requests", F.count(F.lit(1)).over(w)).withColumn("running_tokens", F.sum("tokens").over(w))
    return rows.withColumn("allowed", (F.col("running_requests") <= max_requests) & (F.col("running_tokens") <= max_tokens))


def remaining(limit: int, used: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(limit) - used)


def accepted_attachments(files: DataFrame, most: int = 5, most_bytes: int = 10 << 20) -> DataFrame:
    """Attachments of each message in order: too large ones and repeats of (name, size) drop out, then the first five stay."""
    rows = files.where(F.col("size") <= most_bytes).withColumn("_again", F.row_number().over(Window.partitionBy("message_id", "name", "size").orderBy("pos"))).where("_again = 1")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("message_id").orderBy("pos", "name", "size"))).where(F.col("_n") <= most).drop("_again", "_n")


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of every broken rule; a rule that is null holds, as in SQL checks."""
    broken = F.filter(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return rows.select(F.col(key).alias("key"), F.explode(broken).alias("rule"))
