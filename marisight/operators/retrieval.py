"""Hybrid retrieval for many questions at once.

An *index* has a row per chunk (id, title, agency, storage_path, chunk_index, chunk_text,
published_at, embedding); *queries* have (query_id, query_text, embedding).  Every ranking is a window
over one question's own, bounded pool.  The vector search deals questions and rows out in blocks that
meet pairwise; the word search (``word_index``) starts from each question's rarest word, so only chunks with
that word are looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisight.functions.vectors import jaccard, word_set
from marisight.operators import word_index

RRF_K = 60
#: similarity that a chunk found by words alone counts as
FTS_FLOOR = 0.50
#: questions and rows that one task compares at a time
VECTOR_QUERIES, VECTOR_ROWS = 1000, 8192
#: what a product of matrices may be off by; rows so near to the last one are compared again
_ROUNDING = 1e-12


def pool_size(match_count: int) -> int:
    return max(4 * match_count, 20)


def _top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("_r") <= n)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` columns, zero where they are shorter or a component is missing."""
    listed = column.combine_chunks()
    counts = np.diff(np.asarray(listed.offsets))
    flat = np.nan_to_num(np.asarray(listed.flatten(), dtype=np.float64))
    out = np.zeros((len(counts), width))
    out[np.repeat(np.arange(len(counts)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    return out


def _nearest(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a block of questions and a shard of rows: the n most similar rows of each question.

    A product of matrices may give equal vectors unequal similarities, by their place in it.  So it only tells which rows
    are near; these are then summed component by component, and equals come by id."""

    in_turn = lambda rows: np.cumsum(rows, axis=1)[:, -1]

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        who, ids, found = np.asarray(asked["id"]), np.asarray(rows["id"]), []
        if len(who) and len(ids):
            width = int(max(np.max(t["embedding"].combine_chunks().value_lengths()) for t in (asked, rows)))
            by_id = np.argsort(ids, kind="stable")
            ids, dense, matrix = ids[by_id], _matrix(rows["embedding"], width)[by_id], _matrix(asked["embedding"], width)
            scale = np.sqrt(in_turn(matrix**2))[:, None] * np.sqrt(in_turn(dense**2))[None]
            with np.errstate(divide="ignore", invalid="ignore"):
                sim = np.where(scale > 0, (matrix @ dense.T) / scale, 0.0)
            m = min(n, len(ids))
            least = np.partition(sim, len(ids) - m, axis=1)[:, len(ids) - m]
            for i in range(len(who)):
                near = np.flatnonzero(sim[i] >= least[i] - _ROUNDING)  # ids ascend, so equals keep their order
                with np.errstate(divide="ignore", invalid="ignore"):
                    exact = np.where(scale[i, near] > 0, np.clip(in_turn(matrix[i] * dense[near]) / scale[i, near], -1, 1), 0.0)
                best = np.argsort(-exact, kind="stable")[:m]
                found.append((np.full(m, who[i]), ids[near[best]], exact[best]))
        made = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(x) for x in made], names=["query_id", "id", "similarity"])

    return run


def vector_pool(index: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """(query_id, id, similarity, vrank): the n most cosine-similar rows of each question.

    Rows without an embedding take no part; a vector of norm 0 has similarity 0, and vectors of other
    lengths than the question's count as zero where they are shorter.  Blocks of questions and shards of
    rows meet in groups of bounded size, each of which passes on n rows a question.
    """
    whole = lambda t, c: t.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select(F.col(c).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows, asked = whole(index, "id"), whole(queries, "query_id")
    shards, blocks = max(1, -(-rows.count() // VECTOR_ROWS)), max(1, -(-asked.count() // VECTOR_QUERIES))
    number = lambda many: F.pmod(F.xxhash64("id"), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    left = asked.select("id", "embedding", number(blocks).alias("block"), every(shards).alias("shard"))
    right = rows.select("id", "embedding", every(blocks).alias("block"), number(shards).alias("shard"))
    near = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_nearest(n), "query_id long, id long, similarity double")
    return _top(near, n, F.desc("similarity"), F.asc("id")).withColumnRenamed("_r", "vrank")


#: how densities are summed: sums have room for 10^12, and cost no places
_DENSITY = "decimal(36,24)"


def cover_density(positions: Column | str, terms: Column | str, n_terms: Column | str) -> Column:
    """Sum over minimal covers of 0.1 / (1 + words in the cover that are no query term), in decimals of 24 places, so that
    equal densities are equal doubles wherever their covers stand."""
    positions, terms, n_terms = (F.col(c) if isinstance(c, str) else c for c in (positions, terms, n_terms))
    met = F.array_sort(F.transform(F.arrays_zip(positions.alias("pos"), terms.alias("term")), lambda x: F.struct(x["pos"].cast("int").alias("pos"), x["term"].cast("long").alias("term"))))
    zero = F.struct(F.array().cast("array<struct<term:bigint,pos:int,k:int>>").alias("last"), F.lit(0).alias("k"), F.lit(-1).alias("previous"), F.lit(0).cast(_DENSITY).alias("total"))

    def step(state: Column, x: Column) -> Column:
        # the latest place of each term met so far, the longest ago first
        last = F.concat(F.filter(state["last"], lambda y: y["term"] != x["term"]), F.array(F.struct(x["term"].alias("term"), x["pos"].alias("pos"), state["k"].alias("k"))))
        first = F.element_at(last, 1)
        cover = (F.size(last) == n_terms) & (first["pos"] > state["previous"])  # the shortest cover that starts there
        gain = F.lit("0.1").cast("decimal(25,24)") / (1 + x["pos"] - first["pos"] - (state["k"] - first["k"])).cast("decimal(10,0)")
        return F.struct(last.alias("last"), (state["k"] + 1).alias("k"), F.when(cover, first["pos"]).otherwise(state["previous"]).alias("previous"), F.when(cover, (state["total"] + gain.cast(_DENSITY)).cast(_DENSITY)).otherwise(state["total"]).alias("total"))

    return F.aggregate(met, zero, step, lambda state: state["total"].cast("double"))


def fts_matches(index: DataFrame, queries: DataFrame, columns: tuple[str, ...] = ("chunk_text",)) -> DataFrame:
    """(query_id, id, fts_rank) of chunks that hold every lexeme of the question, by cover density.

    Words are taken once; each question meets only the chunks with its rarest word, and places of words are taken of
    full matches alone.  Questions with a word that no chunk has drop out.
    """
    return _density(word_index.on_the_fly(index, queries, columns))


def kept_fts_pool(folder: str, queries: DataFrame, n: int) -> DataFrame:
    """As ``fts_pool``, over a word index that is kept in a folder."""
    return _best_words(_density(word_index.kept_matches(queries.sparkSession, folder, queries)), n)


def _density(met: DataFrame) -> DataFrame:
    return met.select("query_id", "id", cover_density(F.col("places.pos"), F.col("places.term"), F.col("n_terms")).alias("fts_rank"))


def _best_words(met: DataFrame, n: int) -> DataFrame:
    return _top(met, n, F.desc("fts_rank"), F.asc("id")).withColumnRenamed("_r", "frank")


def fts_pool(index: DataFrame, queries: DataFrame, n: int, columns: tuple[str, ...] = ("chunk_text",)) -> DataFrame:
    """(query_id, id, fts_rank, frank): the n best matches by words; empty questions match nothing."""
    return _best_words(fts_matches(index, queries, columns), n)


def filtered(index: DataFrame, agency: str | None = None, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The chunks that pass the given filters; a missing date fails a date filter."""
    for given, test in ((agency, F.col("agency") == agency), (date_from, F.col("published_at") >= F.to_date(F.lit(date_from))), (date_to, F.col("published_at") <= F.to_date(F.lit(date_to)))):
        if given is not None:
            index = index.where(test)
    return index


def fused(vector: DataFrame, words: DataFrame, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of both pools: rows of either, similarity 0 where only words found them."""
    score = F.coalesce(1.0 / (k + F.col("vrank")), F.lit(0.0)) + F.coalesce(1.0 / (k + F.col("frank")), F.lit(0.0))
    both = vector.join(words, ["query_id", "id"], "full_outer")
    return both.select("query_id", "id", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.coalesce("fts_rank", F.lit(0.0)).alias("fts_rank"), score.alias("rrf_score"))


def ranked(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of each question with their ``rank``; by fused score and id unless told otherwise."""
    return _top(rows, n, *(order or (F.desc("rrf_score"), F.asc("id")))).withColumnRenamed("_r", "rank")


def hybrid(index: DataFrame, queries: DataFrame, match_count: int = 5, agency: str | None = None, date_from: str | None = None, date_to: str | None = None, k: int = RRF_K, texts: DataFrame | None = None) -> DataFrame:
    """(query_id, rank, id, similarity, fts_rank, rrf_score): vector and word search, fused.

    ``texts`` may give the words' side of the index by itself, where vectors are kept apart from it."""
    n = pool_size(match_count)
    rows, words = (filtered(x, agency, date_from, date_to) for x in (index, index if texts is None else texts))
    return ranked(fused(vector_pool(rows, queries, n), fts_pool(words, queries, n), k), max(match_count, 1))


def feedback_scores(citations: DataFrame, feedback: DataFrame) -> DataFrame:
    """Positive, negative and net ratings of each cited document; a document cited twice counts twice."""
    met = citations.where(F.col("document_id").isNotNull()).join(feedback, "message_id")
    return met.groupBy("document_id").agg(F.count_if(F.col("rating") == 1).alias("positive_count"), F.count_if(F.col("rating") == -1).alias("negative_count"), F.coalesce(F.sum("rating"), F.lit(0)).alias("net_score"))


def boosted(rows: DataFrame, scores: DataFrame, match_count: int, boost: float = 0.02, k: int = RRF_K) -> DataFrame:
    """Fused rows lifted by positive net feedback, reranked, at most match_count per question."""
    met = rows.drop("rank").join(scores.select(F.col("document_id").alias("id"), "net_score"), "id", "left")
    gain = F.when(F.col("net_score") > 0, boost * F.ln(1.0 + F.col("net_score"))).otherwise(F.lit(0.0))
    lifted = met.withColumn("similarity", F.col("similarity") + F.least(gain, F.lit(0.10))).withColumn("rrf_score", F.col("rrf_score") + F.least(gain / k, F.lit(0.005)))
    return ranked(lifted.drop("net_score"), match_count)


def effective(floor: float = FTS_FLOOR) -> Column:
    """Similarity used for thresholds: the floor where only words matched."""
    return F.when(F.col("similarity") > 0, F.col("similarity")).when(F.col("fts_rank") > 0, F.lit(floor)).otherwise(F.lit(0.0))


def without_noise(rows: DataFrame, least_rank: float = 0.1) -> DataFrame:
    """Where no row of a question has a similarity, only those with a fair word rank."""
    best = F.max("similarity").over(Window.partitionBy("query_id"))
    return rows.withColumn("_best", best).where((F.col("_best") > 0) | (F.col("fts_rank") >= least_rank)).drop("_best")


def merged(lists: DataFrame, limit: int, k: int = RRF_K) -> DataFrame:
    """Fusion of several ranked lists (question_id, list_no, rank, id, chunk_index, similarity, fts_rank):
    per chunk the sum of 1 / (k + rank), represented by its best row (the earliest of equals)."""
    key = ["question_id", "id", "chunk_index"]
    row = F.struct("similarity", "fts_rank")
    best = F.max_by(row, F.struct(effective(), -F.col("list_no"), -F.col("rank")))
    out = lists.groupBy(*key).agg(F.sum(1.0 / (k + F.col("rank"))).alias("rrf_score"), best.alias("b"), F.min(F.struct("list_no", "rank")).alias("seen"))
    order = Window.partitionBy("question_id").orderBy(F.desc(F.round("rrf_score", 12)), "seen")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return out.select(*key, "rank", "rrf_score", "b.similarity", "b.fts_rank")


def _survivors(alive: Column, conflicts: Column, eff: Column) -> Column:
    """Which entries of a list stay: each in turn drops its weaker or equal later conflicts, up to the
    first stronger one, to which it gives way."""

    def step(alive: Column, i: Column) -> Column:
        met = F.filter(conflicts[i], lambda j: alive[j])
        stronger = F.array_min(F.filter(met, lambda j: eff[j] > eff[i]))
        beaten = F.filter(met, lambda j: stronger.isNull() | (j < stronger))
        gone = F.when(stronger.isNull(), beaten).otherwise(F.array_append(beaten, i))
        return F.when(alive[i], F.transform(alive, lambda a, m: a & ~F.array_contains(gone, m))).otherwise(alive)

    return F.aggregate(F.sequence(F.lit(0), F.size(eff) - 1), alive, step)


def deduplicated(rows: DataFrame, document: str = "id", overlap: float = 0.70) -> DataFrame:
    """Ranked rows (query_id, rank, <document>, chunk_index, chunk_text, similarity, fts_rank) of bounded
    pools without near copies: first of adjacent chunks of one document, then of chunks whose word sets
    overlap, the one with the higher effective similarity stays (the earlier of equals), in list order."""
    words = F.coalesce(word_set(F.col("chunk_text")), F.array().cast("array<string>"))
    item = F.struct(F.col("rank").alias("_rank"), effective().alias("_eff"), F.col(document).alias("_doc"), F.col("chunk_index").alias("_at"), words.alias("_words"), F.struct(*[F.col(c).alias(c) for c in rows.columns]).alias("_row"))
    pools = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("pool"))
    later = lambda same: F.transform("pool", lambda x, i: F.filter(F.transform("pool", lambda y, j: F.when((j > i) & same(x, y), j)), lambda j: j.isNotNull()))
    near = later(lambda x, y: F.coalesce((x["_doc"] == y["_doc"]) & (F.abs(x["_at"] - y["_at"]) <= 1), F.lit(False)))
    alike = later(lambda x, y: jaccard(x["_words"], y["_words"]) > overlap)
    pools = pools.select("pool", near.alias("near"), alike.alias("alike"), F.col("pool._eff").alias("eff"))
    first = pools.select("pool", "alike", "eff", _survivors(F.transform("pool", lambda x: F.lit(True)), F.col("near"), F.col("eff")).alias("alive"))
    second = first.select("pool", _survivors(F.col("alive"), F.col("alike"), F.col("eff")).alias("alive"))
    return second.select(F.explode(F.filter("pool", lambda x, i: F.col("alive")[i])).alias("x")).select("x._row.*")


def overlap_pairs(rows: DataFrame, least: float = 0.70) -> DataFrame:
    """Pairs of one question's bounded pool whose word sets overlap by more than ``least``."""
    sets = rows.select("query_id", "rank", word_set(F.col("chunk_text")).alias("words"))
    a, b = sets.alias("a"), sets.alias("b")
    pairs = a.join(b, (F.col("a.query_id") == F.col("b.query_id")) & (F.col("a.rank") < F.col("b.rank")))
    return pairs.select(F.col("a.query_id").alias("query_id"), F.col("a.rank").alias("rank_a"), F.col("b.rank").alias("rank_b"), jaccard(F.col("a.words"), F.col("b.words")).alias("overlap")).where(F.col("overlap") > least)


def recency_boosted(rows: DataFrame, as_of: Column, published: str = "published_at") -> DataFrame:
    """Ranked rows reordered by score times 1 + 0.1 per year under five; undated rows keep their score."""
    years = F.datediff(as_of, F.col(published)) / 365.25
    boost = F.coalesce(1.0 + 0.1 * F.greatest(F.lit(0.0), 5.0 - years), F.lit(1.0))
    base = F.when(F.col("rrf_score") > 0, F.col("rrf_score")).otherwise(effective())
    out = rows.withColumn("boosted", base * boost)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("boosted", 12)), "rank")))


def adaptive_cutoff(rows: DataFrame, ratio: float = 0.60, most: int = 5) -> DataFrame:
    """Rows near enough to the first one's effective similarity, at least the first, at most ``most``."""
    w = Window.partitionBy("query_id").orderBy("rank")
    out = rows.withColumn("_top", F.first(effective()).over(w)).where((effective() >= F.col("_top") * ratio) | (F.col("rank") == 1))
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).drop("_top")


def reranked(rows: DataFrame, scores: DataFrame, top_n: int) -> DataFrame:
    """Rows by a scorer's (query_id, rank, score); missing scores are 0, questions without any keep their order, as do
    those with one row, which need no scorer (``to_score`` leaves them out)."""
    w = Window.partitionBy("query_id")
    met = rows.join(scores, ["query_id", "rank"], "left").withColumn("_any", F.count("score").over(w) > 0)
    order = w.orderBy(F.desc(F.when(F.col("_any"), F.coalesce("score", F.lit(0.0)))), "rank")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n).drop("score", "_any")


def to_score(rows: DataFrame) -> DataFrame:
    """Rows of the questions with more than one, which alone are worth a scorer's call."""
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("query_id"))).where(F.col("_n") > 1).drop("_n")


def parsed_scores(answers: DataFrame, column: str = "answer") -> DataFrame:
    """(query_id, rank, score) from a scorer's answer text that holds a JSON list of {index, score}."""
    found = F.from_json(F.nullif(F.regexp_extract(column, r"(?s)(\[.*\])", 1), F.lit("")), "array<struct<index:int,score:double>>")
    return answers.select("query_id", F.explode(found).alias("s")).select("query_id", F.col("s.index").alias("rank"), F.col("s.score").alias("score")).where("rank is not null")


def lexical_scores(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """A default scorer: ten times the share of a question's words that the chunk holds."""
    asked = queries.select("query_id", word_set(F.col("query_text")).alias("asked"))
    share = F.size(F.array_intersect("asked", word_set(F.col("chunk_text")))) / F.greatest(F.size("asked"), F.lit(1))
    return rows.join(asked, "query_id").select("query_id", "rank", (10.0 * share).alias("score"))


def attention_order(rows: DataFrame) -> DataFrame:
    """``place`` of each row in a prompt: best first, then the rest reversed; up to two rows as they are."""
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    place = F.when((n <= 2) | (F.col("rank") == 1), F.col("rank")).otherwise(n + 2 - F.col("rank"))
    return rows.withColumn("place", place.cast("int"))


def expanded(rows: DataFrame, chunks: DataFrame, most_documents: int = 5, around: int = 10, most_chars: int = 8000) -> DataFrame:
    """The documents of each question's first-ranked chunks with the chunks around the match, joined by a
    blank line and cut to ``most_chars``: (query_id, doc_rank, storage_path, matched_chunk_index, title, text)."""
    first = rows.where(F.coalesce("storage_path", F.lit("")) != "").groupBy("query_id", "storage_path").agg(F.min(F.struct("rank", "chunk_index")).alias("m"))
    first = first.withColumn("doc_rank", F.row_number().over(Window.partitionBy("query_id").orderBy("m.rank"))).where(F.col("doc_rank") <= most_documents)
    centre = F.coalesce(F.col("m.chunk_index"), F.lit(0)).cast("int").alias("matched_chunk_index")
    first = first.select("query_id", "doc_rank", "storage_path", centre)
    window = F.explode(F.sequence(F.greatest(F.col("matched_chunk_index") - around, F.lit(0)), F.col("matched_chunk_index") + around)).alias("chunk_index")
    near = first.select("*", window).join(chunks.select("storage_path", F.col("chunk_index").cast("int").alias("chunk_index"), "chunk_text", "title"), ["storage_path", "chunk_index"])
    part = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text", "title")))
    out = near.groupBy("query_id", "doc_rank", "storage_path", "matched_chunk_index").agg(part.alias("parts"))
    text = F.array_join(F.filter(F.col("parts.chunk_text"), lambda t: F.coalesce(t, F.lit("")) != ""), "\n\n")
    return out.select("query_id", "doc_rank", "storage_path", "matched_chunk_index", F.element_at(F.col("parts.title"), 1).alias("title"), F.substring(text, 1, most_chars).alias("text"))


def context_blocks(rows: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """The prompt context of each question: ``[n] title | agency`` and text, in attention order, then the texts of
    its live datasets (query_id, rank, text); questions may have either alone."""
    said = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col("title"), F.lit(" | "), F.col("agency"), F.lit("\n"), F.col("chunk_text"))
    parts = F.array_sort(F.collect_list(F.struct("place", said.alias("said"))))
    out = attention_order(rows).groupBy("query_id").agg(F.array_join(F.transform(parts, lambda p: p["said"]), "\n\n").alias("context"))
    if live is None:
        return out
    texts = F.array_sort(F.collect_list(F.struct("rank", "text")))
    data = live.groupBy("query_id").agg(F.array_join(F.transform(texts, lambda p: p["text"]), "\n\n").alias("_live"))
    return out.join(data, "query_id", "full_outer").select("query_id", F.concat_ws("\n\n", "context", "_live").alias("context"))


#: fixed values: what a prompt says of sources and before live rows
CITE = " Cite sources inline with [n] when referencing specific document content."
LIVE = "Live government data (fetched from data.gov.my in real time):"
#: what a prompt says first, by language, where nothing else is given
SYSTEM = {"en": "You answer questions about public policy from the documents below.", "ms": "Anda menjawab soalan tentang dasar awam daripada dokumen di bawah."}


def prompts(queries: DataFrame, rows: DataFrame, live: DataFrame | None = None, system: dict[str, str] | None = None) -> DataFrame:
    """Whole prompts (query_id, language, system, user, support) of questions (query_id, query_text, language): the
    question, its chunks between rules in attention order, then the texts of its live datasets (query_id, rank, text).
    Questions without chunks have neither rule nor the advice on sources, and ``support`` none."""
    system = system or SYSTEM
    met = queries.join(context_blocks(rows), "query_id", "left")
    if live is None:
        met = met.withColumn("_live", F.lit(None).cast("string"))
    else:
        texts = F.array_sort(F.collect_list(F.struct("rank", "text")))
        said = live.groupBy("query_id").agg(F.array_join(F.transform(texts, lambda p: p["text"]), "\n\n").alias("_live"))
        met = met.join(said, "query_id", "left")
    has = F.coalesce("context", F.lit("")) != ""
    first = F.when(F.col("language") == "ms", system["ms"]).otherwise(system["en"])
    user = F.concat("query_text", F.when(has, F.concat(F.lit("\n\n---\n\n"), "context")).otherwise(""), F.when(F.col("_live").isNotNull(), F.concat(F.lit(f"\n\n{LIVE}\n"), "_live")).otherwise(""))
    return met.select(*queries.columns, F.concat(first, F.when(has, CITE).otherwise("")).alias("system"), user.alias("user"), F.when(has, "strong").otherwise("none").alias("support"))


def citation_rows(rows: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """Citations of each question's chunks, then of its live datasets, numbered from 1."""
    out = rows.select("query_id", F.lit(0).alias("kind"), F.col("rank").cast("int").alias("rank"), F.col("id").cast("string").alias("ref"), "title")
    if live is not None:
        out = out.unionByName(live.select("query_id", F.lit(1).alias("kind"), F.col("rank").cast("int").alias("rank"), F.col("dataset_id").alias("ref"), "title"))
    return out.select("query_id", F.row_number().over(Window.partitionBy("query_id").orderBy("kind", "rank", "ref")).alias("citation_index"), "kind", "ref", "title")


def support_tier(top: Column, low: float = 0.45, high: float = 0.65) -> Column:
    return F.when(top >= high, "supported").when(top >= low, "limited-support").otherwise("no-information")


def knowledge_gaps(queries: DataFrame, retrieved: DataFrame, cited: DataFrame, live: DataFrame) -> DataFrame:
    """Questions for which nothing was cited and no live data came: ``no_match`` where nothing was retrieved
    either, else ``low_similarity``, with the best similarity retrieved."""
    best = retrieved.groupBy("query_id").agg(F.max(effective()).alias("top_similarity"), F.count(F.lit(1)).alias("_n"))
    open_ = queries.join(cited.select("query_id"), "query_id", "left_anti").join(live.select("query_id"), "query_id", "left_anti")
    kind = F.when(F.col("_n") > 0, "low_similarity").otherwise("no_match")
    return open_.join(best, "query_id", "left").select("query_id", "query_text", kind.alias("gap_type"), "top_similarity")


def answer_context(index: DataFrame, queries: DataFrame, as_of: Column, match_count: int = 5, prefetch: int = 20, texts: DataFrame | None = None) -> DataFrame:
    """The rows that answer each question, in order: hybrid pool, noise filter, deduplication, lexical rerank,
    recency and cut-off; ``context_blocks`` makes the prompt's context of them."""
    pool = hybrid(index, queries, prefetch, texts=texts)
    said = index if texts is None else texts
    rows = without_noise(pool).join(said.select("id", "title", "agency", "chunk_index", "chunk_text", "published_at"), "id")
    rows = deduplicated(rows.select("query_id", "rank", "id", "chunk_index", "chunk_text", "similarity", "fts_rank", "rrf_score", "title", "agency", "published_at"))
    again = Window.partitionBy("query_id").orderBy("rank")
    rows = rows.withColumn("rank", F.row_number().over(again))
    rows = reranked(rows, lexical_scores(rows, queries), match_count)
    return adaptive_cutoff(recency_boosted(rows, as_of), most=match_count)


def expanded_queries(questions: DataFrame, answers: DataFrame, most: int = 2) -> DataFrame:
    """(question_id, query_no, query_text): each question and up to two other phrasings, a line each of a
    generator's answer (question_id, answer); empty lines and repeats of the question drop out."""
    lines = F.filter(F.transform(F.split("answer", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    met = questions.join(answers, "question_id", "left")
    others = F.slice(F.filter(F.array_distinct(F.coalesce(lines, F.array().cast("array<string>"))), lambda x: x != F.col("query_text")), 1, most)
    return met.select("question_id", F.posexplode(F.concat(F.array("query_text"), others)).alias("query_no", "query_text"))


def linked_marks(answers: DataFrame, cited: DataFrame) -> DataFrame:
    """(message_id, pos, citation_index, document_id) of the [n] marks of answers; unknown marks have no document."""
    marks = answers.select("message_id", F.posexplode(F.transform(F.regexp_extract_all("text", F.lit(r"\[(\d+)\]"), 1), lambda x: x.cast("int"))).alias("pos", "citation_index"))
    return marks.join(cited.select("message_id", "citation_index", "document_id"), ["message_id", "citation_index"], "left")
