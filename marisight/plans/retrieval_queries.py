"""Retrieval queries over the given tables, and the SQL that checks them.

The index is every document with the embedding of the same number, the questions are all benchmark
passages with theirs; ratings and citations come from all events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.operators import chunking, retrieval, state, vector_index, word_index
from marisight.operators.tables import shared_folder

AS_OF = "2024-06-30"
PIECE = 1400
#: fixed values: names and abbreviations of agencies in questions, and their codes
AGENCIES = {
    "kpm": "KPM",
    "moe": "KPM",
    "kementerian pendidikan": "KPM",
    "ministry of education": "KPM",
    "kpwkm": "KPWKM",
    "kementerian pembangunan wanita": "KPWKM",
    "ministry of women": "KPWKM",
    "mof": "MOF",
    "kementerian kewangan": "MOF",
    "ministry of finance": "MOF",
    "ksm": "KSM",
    "mohr": "KSM",
    "kementerian sumber manusia": "KSM",
    "ministry of human resources": "KSM",
    "kkm": "KKM",
    "moh": "KKM",
    "kementerian kesihatan": "KKM",
    "ministry of health": "KKM",
    "kdn": "KDN",
    "moha": "KDN",
    "kementerian dalam negeri": "KDN",
    "ministry of home affairs": "KDN",
    "kwsp": "KWSP",
    "epf": "KWSP",
    "perkeso": "PERKESO",
    "socso": "PERKESO",
    "lhdn": "LHDN",
    "irb": "LHDN",
    "inland revenue": "LHDN",
    "jpm": "JPM",
    "jabatan perdana menteri": "JPM",
    "prime minister": "JPM",
    "kementerian ekonomi": "KE",
    "ministry of economy": "KE",
    "data.gov.my": "data.gov.my",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def index(spark: SparkSession, sf_dir: str, vectors: bool = True) -> DataFrame:
    """All documents as one chunk each; their embeddings only where they are wanted."""
    rows = table(spark, sf_dir, "documents")
    if vectors:
        rows = rows.join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left")
    day = F.date_add(F.lit("2018-01-01").cast("date"), F.pmod(F.col("doc_id") * 7, F.lit(2300)).cast("int"))
    path = F.concat(F.lit("gov-docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return rows.select(F.col("doc_id").alias("id"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("agency"), path.alias("storage_path"), F.lit(0).alias("chunk_index"), F.col("text").alias("chunk_text"), day.alias("published_at"), *(["embedding"] if vectors else []))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return table(spark, sf_dir, "benchmark").join(vectors, "item_id", "left").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), "embedding")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rating = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1)
    return events.select(F.col("event_id").alias("message_id"), "user_id", "ts", rating.alias("rating")).where(F.col("rating").isNotNull())


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("message_id"), F.pmod(F.col("event_id"), F.lit(197)).alias("document_id"), F.lit(1).alias("citation_index"))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of PIECE characters, as chunks."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("gov-docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", path.alias("storage_path"), F.posexplode(chunking.hard_split(F.coalesce("text", F.lit("")), PIECE)).alias("chunk_index", "chunk_text"))
    return cut.withColumn("title", F.concat(F.lit("Document "), F.col("doc_id").cast("string")))


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes])


def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(retrieval.vector_pool(index(spark, sf_dir), questions(spark, sf_dir), 5))


def fts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.fts_pool(index(spark, sf_dir, False), questions(spark, sf_dir), 20)
    return _rounded(rows.withColumn("rrf_score", 1.0 / (60 + F.col("frank"))))


def _hundredths(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and those whose id is divisible by 100 as questions."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return rows, rows.where("id % 100 = 0").withColumnRenamed("id", "query_id")


def cell_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most similar vectors of each question by an inverted file, exactly."""
    rows, asked = _hundredths(spark, sf_dir)
    return _rounded(vector_index.search(vector_index.built(rows), asked, 10))


def cell_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the ten most similar vectors of each question the calibrated number of probes finds."""
    rows, asked = _hundredths(spark, sf_dir)
    index = vector_index.built(rows)
    probes = vector_index.calibrated(index, 10)
    some = vector_index.search(index, asked, 10, probes, exact=False).select("query_id", "id", F.lit(1).alias("met"))
    met = vector_index.search(index, asked, 10).join(some, ["query_id", "id"], "left")
    return met.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted"), F.coalesce(F.sum("met"), F.lit(0)).alias("found")).withColumn("probes", F.lit(probes)).withColumn("cells", F.lit(len(index.size)))


def kept_fts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word search over a kept index: even documents indexed first in another form, some rows that aren't documents
    too; then all odd and the changed documents, and the strangers removed."""
    folder = f"{shared_folder(spark)}/words-{uuid.uuid4().hex}"
    rows = index(spark, sf_dir, False).select("id", "chunk_text")
    even = rows.where("id % 2 = 0")
    word_index.update(folder, even.withColumn("chunk_text", F.concat_ws(" ", F.when(F.col("id") % 4 == 0, "old"), "chunk_text", F.when(F.col("id") % 4 == 0, "words"))).unionByName(even.select((-1 - F.col("id")).alias("id"), "chunk_text")), 1)
    word_index.update(folder, rows.where("id % 2 = 1 OR id % 4 = 0"), 2, removed=even.select((-1 - F.col("id")).alias("id")))
    found = retrieval.kept_fts_pool(folder, questions(spark, sf_dir), 20)
    return _rounded(found.withColumn("rrf_score", 1.0 / (60 + F.col("frank"))))


def hybrid(spark: SparkSession, sf_dir: str, n: int, **given) -> DataFrame:
    """Hybrid search with the words' side read without the embeddings."""
    return retrieval.hybrid(index(spark, sf_dir), questions(spark, sf_dir), n, texts=index(spark, sf_dir, False), **given)


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hybrid(spark, sf_dir, 5))


def hybrid_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hybrid(spark, sf_dir, 5, date_from="2020-01-01", date_to="2023-12-31"))


def feedback_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.feedback_scores(citations(spark, sf_dir), ratings(spark, sf_dir))


def feedback_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hybrid(spark, sf_dir, 10)
    return _rounded(retrieval.boosted(rows, feedback_scores(spark, sf_dir), 5))


def multi_query_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = questions(spark, sf_dir)
    vector = retrieval.vector_pool(index(spark, sf_dir), asked, 20).select("query_id", F.lit(0).alias("list_no"), F.col("vrank").alias("rank"), "id", "similarity", F.lit(0.0).alias("fts_rank"))
    words = retrieval.fts_pool(index(spark, sf_dir, False), asked, 20).select("query_id", F.lit(1).alias("list_no"), F.col("frank").alias("rank"), "id", F.lit(0.0).alias("similarity"), "fts_rank")
    lists = vector.unionByName(words).withColumnRenamed("query_id", "question_id").withColumn("chunk_index", F.lit(0))
    return _rounded(retrieval.merged(lists, 5))


def _pool(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    return hybrid(spark, sf_dir, n).join(index(spark, sf_dir, False).select("id", "title", "agency", "storage_path", "chunk_index", "chunk_text", "published_at"), "id")


def recency_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.recency_boosted(_pool(spark, sf_dir), F.lit(AS_OF).cast("date"))
    return _rounded(rows.select("query_id", "id", "rank", "boosted"))


def cutoff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(retrieval.adaptive_cutoff(_pool(spark, sf_dir), 0.60, 5).select("query_id", "rank", "id", retrieval.effective().alias("effective")))


def attention_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.attention_order(hybrid(spark, sf_dir, 5)).select("query_id", "id", "rank", "place")


def context_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.context_blocks(_pool(spark, sf_dir)).select("query_id", F.sha2(F.col("context").cast("binary"), 256).alias("context_sha256"), F.length("context").alias("n_chars"))


def citation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = _pool(spark, sf_dir)
    live = questions(spark, sf_dir).select("query_id", F.lit(1).alias("rank"), F.concat(F.lit("set"), F.col("query_id").cast("string")).alias("dataset_id"), F.lit("Live data").alias("title"))
    return retrieval.citation_rows(pool, live)


def knowledge_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions over the chunks of 2023 on, every second one by words alone: cited are chunks of similarity 0.5 or
    more, live data have those whose number is a document of bad quality."""
    asked = questions(spark, sf_dir).withColumn("embedding", F.when(F.col("query_id") % 2 == 0, F.col("embedding")))
    retrieved = retrieval.hybrid(index(spark, sf_dir), asked, 5, date_from="2023-01-01", texts=index(spark, sf_dir, False))
    live = table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("query_id")).distinct()
    return _rounded(retrieval.knowledge_gaps(asked, retrieved, retrieved.where(retrieval.effective() >= 0.5), live).drop("query_text"))


def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(retrieval.overlap_pairs(_pool(spark, sf_dir, 20), 0.05))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.deduplicated(_pool(spark, sf_dir, 20).select("query_id", "rank", "id", "chunk_index", "chunk_text", "similarity", "fts_rank")).select("query_id", "rank", "id")


def expanded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pool(spark, sf_dir).withColumn("chunk_index", F.pmod("id", F.lit(3)).cast("int"))
    out = retrieval.expanded(rows, pieces(spark, sf_dir), 3, 2, 8000)
    return out.select("query_id", "doc_rank", "storage_path", "matched_chunk_index", "title", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def lexical_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = _pool(spark, sf_dir, 20)
    return retrieval.reranked(pool, retrieval.lexical_scores(pool, questions(spark, sf_dir)), 5).select("query_id", "rank", "id")


def answer_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.answer_context(index(spark, sf_dir), questions(spark, sf_dir), F.lit(AS_OF).cast("date"), texts=index(spark, sf_dir, False))
    return _rounded(rows.select("query_id", "rank", "id", "similarity", "fts_rank", "boosted"))


def agency_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agency named in each question, longest name first (each passage gets one name appended)."""
    names = list(AGENCIES)
    appended = F.array(*[F.lit(n) for n in names])[F.pmod("item_id", F.lit(len(names))).cast("int")]
    asked = table(spark, sf_dir, "benchmark").select("item_id", F.lower(F.concat("text", F.lit(" "), appended)).alias("question"))
    aliases = spark.createDataFrame(list(AGENCIES.items()), "alias string, code string")  # a dimension of fixed size
    met = asked.join(F.broadcast(aliases), F.contains("question", "alias"))
    return met.groupBy("item_id").agg(F.max_by("code", F.struct(F.length("alias"), "alias")).alias("agency"))


_INDEX = f"""
idx AS (
  SELECT d.doc_id AS id, 'Document ' || d.doc_id AS title, d.source AS agency, 'gov-docs/' || d.source || '/' || d.doc_id AS storage_path,
         d.text AS chunk_text, CAST(DATE '2018-01-01' + CAST((d.doc_id * 7) % 2300 AS INTEGER) AS DATE) AS published_at, CAST(e.embedding AS DOUBLE[]) AS embedding
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id
), q AS (
  SELECT b.item_id AS query_id, b.text AS query_text, CAST(e.embedding AS DOUBLE[]) AS embedding
  FROM benchmark b LEFT JOIN embeddings e ON e.vec_id = b.item_id
), src AS (SELECT * FROM idx WHERE {{where}}
), sims AS (
  SELECT q.query_id, s.id, list_cosine_similarity(s.embedding, q.embedding) AS similarity
  FROM src s, q WHERE s.embedding IS NOT NULL AND q.embedding IS NOT NULL
), vr AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS vrank FROM sims QUALIFY vrank <= {{pool}}
), qt AS (
  SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query_text), '[\\p{{{{L}}}}\\p{{{{N}}}}]+')) AS term FROM q
), qn AS (SELECT query_id, count(*) AS n FROM qt GROUP BY 1
), dt AS (
  SELECT id, generate_subscripts(w, 1) AS pos, unnest(w) AS term
  FROM (SELECT id, regexp_extract_all(lower(chunk_text), '[\\p{{{{L}}}}\\p{{{{N}}}}]+') AS w FROM src)
), m AS (
  SELECT qt.query_id, dt.id, dt.pos, dt.term FROM dt JOIN qt USING (term)
), full_m AS (
  SELECT m.*, qn.n, row_number() OVER (PARTITION BY m.query_id, m.id ORDER BY m.pos) AS k FROM m JOIN qn USING (query_id)
  WHERE (m.query_id, m.id) IN (SELECT query_id, id FROM m JOIN qn USING (query_id) GROUP BY query_id, id, n HAVING count(DISTINCT term) = n)
), ends AS (
  SELECT e.query_id, e.id, e.pos, e.k, l.term, max(l.pos) AS lp, max(l.k) AS lk, e.n
  FROM full_m e JOIN full_m l ON l.query_id = e.query_id AND l.id = e.id AND l.pos <= e.pos GROUP BY ALL
), covers AS (
  SELECT query_id, id, k, pos, min(lp) AS start, min(lk) AS start_k FROM ends GROUP BY query_id, id, k, pos, n HAVING count(*) = n
), minimal AS (
  SELECT query_id, id, start, min(pos) AS stop, min(k) - min(start_k) AS inner_terms FROM covers GROUP BY query_id, id, start
), fr0 AS (
  SELECT query_id, id, sum(0.1 / (1 + stop - start - inner_terms)) AS fts_rank FROM minimal GROUP BY 1, 2
), fr AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fts_rank DESC, id) AS frank FROM fr0 QUALIFY frank <= {{pool}}
), fused AS (
  SELECT coalesce(vr.query_id, fr.query_id) AS query_id, coalesce(vr.id, fr.id) AS id, coalesce(vr.similarity, 0.0) AS similarity,
         CAST(coalesce(fr.fts_rank, 0.0) AS DOUBLE) AS fts_rank,
         CAST(coalesce(CAST(1.0 AS DOUBLE) / (60 + vr.vrank), 0.0) AS DOUBLE) + CAST(coalesce(CAST(1.0 AS DOUBLE) / (60 + fr.frank), 0.0) AS DOUBLE) AS rrf_score
  FROM vr FULL JOIN fr ON vr.query_id = fr.query_id AND vr.id = fr.id
), hyb AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, id) AS INTEGER) AS rank FROM fused QUALIFY rank <= {{count}}
), eff AS (
  SELECT *, CASE WHEN similarity > 0 THEN similarity WHEN fts_rank > 0 THEN 0.5 ELSE 0.0 END AS effective FROM hyb
), pl AS (SELECT eff.*, idx.title, idx.agency, idx.storage_path, idx.chunk_text, idx.published_at FROM eff JOIN idx USING (id))
"""


def _sql(select: str, count: int = 5, where: str = "true", more: str = "", pool: int | None = None) -> str:
    head = _INDEX.replace("{{", "{").replace("}}", "}").replace("{where}", where).replace("{pool}", str(pool or max(4 * count, 20))).replace("{count}", str(count)).replace("{{", "{").replace("}}", "}")
    return f"WITH {head}{', ' + more if more else ''} {select}"


_FEEDBACK = """
ratings AS (
  SELECT event_id AS message_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 END AS rating FROM events WHERE event_type IN ('purchase', 'error')
), fs AS (
  SELECT event_id % 197 AS document_id, count(*) FILTER (WHERE rating = 1) AS positive_count, count(*) FILTER (WHERE rating = -1) AS negative_count, CAST(sum(rating) AS BIGINT) AS net_score
  FROM (SELECT event_id, event_id AS message_id FROM events) c JOIN ratings USING (message_id) GROUP BY 1
)
"""
_PIECES = f"""
pcs AS (
  SELECT doc_id, 'gov-docs/' || source || '/' || doc_id AS storage_path, CAST(i AS INTEGER) AS chunk_index, substr(t, i * {PIECE} + 1, {PIECE}) AS chunk_text
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, unnest(range(0, greatest(CAST(ceil(length(coalesce(text, '')) / {PIECE}.0) AS BIGINT), 1))) AS i FROM documents)
)
"""
_WORDS = "list_distinct(list_filter(string_split_regex(lower({0}), '\\s+'), lambda w: w <> ''))"

QUERIES = {
    f.__name__: f
    for f in (
        vector_search, fts_search, kept_fts_search, cell_search, cell_recall, hybrid_search, hybrid_filtered, feedback_scores, feedback_boosted, multi_query_merge, recency_order, cutoff_rows, attention_order,
        context_blocks, citation_rows, knowledge_gaps, overlap_pairs, deduplicated, expanded_documents, lexical_rerank, answer_context, agency_detection,
    )
}

ORACLE_SQL = {
    "vector_search": _sql("SELECT query_id, id, round(similarity, 6) AS similarity, CAST(vrank AS INTEGER) AS vrank FROM vr WHERE vrank <= 5"),
    "fts_search": _sql("SELECT query_id, id, round(fts_rank, 6) AS fts_rank, CAST(frank AS INTEGER) AS frank, round(CAST(1.0 AS DOUBLE) / (60 + frank), 6) AS rrf_score FROM fr"),
    "cell_search": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(a.v, b.v) AS similarity FROM e a JOIN e b ON a.vec_id % 100 = 0)
SELECT query_id, id, round(similarity, 6) AS similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INTEGER) AS vrank FROM s QUALIFY vrank <= 10""",
    "kept_fts_search": _sql("SELECT query_id, id, round(fts_rank, 6) AS fts_rank, CAST(frank AS INTEGER) AS frank, round(CAST(1.0 AS DOUBLE) / (60 + frank), 6) AS rrf_score FROM fr"),
    "hybrid_search": _sql("SELECT query_id, id, round(similarity, 6) AS similarity, round(fts_rank, 6) AS fts_rank, round(rrf_score, 6) AS rrf_score, rank FROM hyb"),
    "hybrid_filtered": _sql("SELECT query_id, id, round(similarity, 6) AS similarity, round(fts_rank, 6) AS fts_rank, round(rrf_score, 6) AS rrf_score, rank FROM hyb", where="published_at BETWEEN DATE '2020-01-01' AND DATE '2023-12-31'"),
    "feedback_scores": f"WITH {_FEEDBACK} SELECT * FROM fs",
    "feedback_boosted": _sql(
        "SELECT query_id, id, round(similarity, 6) AS similarity, round(fts_rank, 6) AS fts_rank, round(rrf_score, 6) AS rrf_score, rank FROM b WHERE rank <= 5",
        10,
        more=_FEEDBACK
        + """, b0 AS (SELECT h.query_id, h.id, h.fts_rank, h.similarity + CASE WHEN net_score > 0 THEN least(0.02 * ln(1 + net_score), 0.10) ELSE 0 END AS similarity,
          h.rrf_score + CASE WHEN net_score > 0 THEN least(0.02 * ln(1 + net_score) / 60, 0.005) ELSE 0 END AS rrf_score FROM hyb h LEFT JOIN fs ON fs.document_id = h.id
        ), b AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, id) AS INTEGER) AS rank FROM b0)""",
    ),
    "multi_query_merge": _sql(
        "SELECT question_id, id, chunk_index, rank, round(rrf_score, 6) AS rrf_score, round(similarity, 6) AS similarity, round(fts_rank, 6) AS fts_rank FROM g WHERE rank <= 5",
        more="""l AS (SELECT query_id, 0 AS list_no, vrank AS r, id, similarity, 0.0 AS fts_rank FROM vr UNION ALL SELECT query_id, 1, frank, id, 0.0, fts_rank FROM fr
        ), e AS (SELECT *, CASE WHEN similarity > 0 THEN similarity WHEN fts_rank > 0 THEN 0.5 ELSE 0.0 END AS effective FROM l
        ), b AS (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY effective DESC, list_no, r) AS best, sum(CAST(1.0 AS DOUBLE) / (60 + r)) OVER (PARTITION BY query_id, id) AS rrf_score,
                 min(list_no * 1000 + r) OVER (PARTITION BY query_id, id) AS seen FROM e
        ), g AS (SELECT query_id AS question_id, id, 0 AS chunk_index, rrf_score, similarity, CAST(fts_rank AS DOUBLE) AS fts_rank, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(rrf_score, 12) DESC, seen) AS INTEGER) AS rank FROM b WHERE best = 1)""",
    ),
    "recency_order": _sql(
        "SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(boosted, 12) DESC, rank) AS INTEGER) AS rank, round(boosted, 6) AS boosted FROM b",
        more=f"b AS (SELECT *, CASE WHEN rrf_score > 0 THEN rrf_score ELSE effective END * (1.0 + 0.1 * greatest(0.0, 5.0 - date_diff('day', published_at, DATE '{AS_OF}') / CAST(365.25 AS DOUBLE))) AS boosted FROM pl)",
    ),
    "cutoff_rows": _sql(
        "SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS rank, id, round(effective, 6) AS effective FROM c WHERE effective >= top * 0.6 OR rank = 1",
        more="c AS (SELECT *, first_value(effective) OVER (PARTITION BY query_id ORDER BY rank) AS top FROM eff)",
    ),
    "attention_order": _sql("SELECT query_id, id, rank, CAST(CASE WHEN count(*) OVER (PARTITION BY query_id) <= 2 OR rank = 1 THEN rank ELSE count(*) OVER (PARTITION BY query_id) + 2 - rank END AS INTEGER) AS place FROM hyb"),
    "context_blocks": _sql(
        "SELECT query_id, sha256(string_agg(said, chr(10) || chr(10) ORDER BY place)) AS context_sha256, CAST(length(string_agg(said, chr(10) || chr(10) ORDER BY place)) AS INTEGER) AS n_chars FROM c GROUP BY query_id",
        more="c AS (SELECT query_id, CASE WHEN count(*) OVER (PARTITION BY query_id) <= 2 OR rank = 1 THEN rank ELSE count(*) OVER (PARTITION BY query_id) + 2 - rank END AS place, '[' || rank || '] ' || title || ' | ' || agency || chr(10) || chunk_text AS said FROM pl)",
    ),
    "citation_rows": _sql(
        "SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY kind, rank, ref) AS INTEGER) AS citation_index, kind, ref, title FROM c",
        more="c AS (SELECT query_id, 0 AS kind, rank, CAST(id AS VARCHAR) AS ref, title FROM pl UNION ALL SELECT query_id, 1, 1, 'set' || query_id, 'Live data' FROM q)",
    ),
    "knowledge_gaps": _sql(
        """SELECT q.query_id, CASE WHEN t IS NULL THEN 'no_match' ELSE 'low_similarity' END AS gap_type, round(t, 6) AS top_similarity
        FROM q LEFT JOIN (SELECT query_id, max(effective) AS t FROM eff GROUP BY 1) b USING (query_id)
        WHERE NOT EXISTS (SELECT 1 FROM eff e WHERE e.query_id = q.query_id AND e.effective >= 0.5) AND q.query_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""",
        where="published_at >= DATE '2023-01-01'",
    ).replace("FROM src s, q WHERE", "FROM src s, q WHERE q.query_id % 2 = 0 AND"),
    "overlap_pairs": _sql(
        "SELECT query_id, rank_a, rank_b, round(o, 6) AS overlap FROM (SELECT a.query_id, a.rank AS rank_a, b.rank AS rank_b, len(list_intersect(a.w, b.w)) / CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE) AS o FROM s a JOIN s b ON a.query_id = b.query_id AND a.rank < b.rank) WHERE o > 0.05",
        20,
        more=f"s AS (SELECT query_id, rank, {_WORDS.format('chunk_text')} AS w FROM pl)",
    ),
    "expanded_documents": _sql(
        "SELECT query_id, doc_rank, storage_path, matched_chunk_index, 'Document ' || any_value(doc_id) AS title, sha256(substr(string_agg(chunk_text, chr(10) || chr(10) ORDER BY chunk_index) FILTER (WHERE chunk_text <> ''), 1, 8000)) AS text_sha256 FROM x GROUP BY 1, 2, 3, 4",
        more=_PIECES
        + """, f AS (SELECT query_id, storage_path, CAST(id % 3 AS INTEGER) AS matched_chunk_index, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS doc_rank FROM pl QUALIFY doc_rank <= 3
        ), x AS (SELECT f.*, p.chunk_index, p.chunk_text, p.doc_id FROM f JOIN pcs p ON p.storage_path = f.storage_path AND p.chunk_index BETWEEN f.matched_chunk_index - 2 AND f.matched_chunk_index + 2)""",
    ),
    "lexical_rerank": _sql(
        "SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, rank) AS INTEGER) AS rank, id FROM r QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, rank) <= 5",
        20,
        more=f"r AS (SELECT pl.query_id, pl.rank, pl.id, CAST(10.0 AS DOUBLE) * (len(list_intersect({_WORDS.format('q.query_text')}, {_WORDS.format('pl.chunk_text')})) / CAST(greatest(len({_WORDS.format('q.query_text')}), 1) AS DOUBLE)) AS s FROM pl JOIN q USING (query_id))",
    ),
    "agency_detection": "WITH a(i, alias, code) AS (VALUES "
    + ", ".join(f"({i}, '{a}', '{c}')" for i, (a, c) in enumerate(AGENCIES.items()))
    + f"), q AS (SELECT item_id, lower(text || ' ' || alias) AS question FROM benchmark JOIN a ON a.i = item_id % {len(AGENCIES)}) SELECT item_id, arg_max(code, (length(alias), alias)) AS agency FROM q JOIN a ON contains(q.question, a.alias) GROUP BY 1",
}
