"""The engine's functions under SQL names: ``registered(spark)`` makes them known to a session.

Column functions are SQL functions, which Catalyst inlines, so queries written as text get the plans of queries
written with DataFrames; ``html_nodes`` is a table function over the page parser.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: name and parameters, what it gives, and how
SQL_FUNCTIONS = (
    ("vector_norm(v ARRAY<DOUBLE>)", "DOUBLE", "sqrt(aggregate(v, 0.0D, (s, x) -> s + x * x))"),
    ("inner_product(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)", "DOUBLE", "aggregate(zip_with(a, b, (x, y) -> coalesce(x * y, 0.0D)), 0.0D, (s, x) -> s + x)"),
    ("cosine_of(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)", "DOUBLE", "CASE WHEN size(a) <= 0 OR size(b) <= 0 OR vector_norm(a) * vector_norm(b) = 0 THEN 0.0D ELSE inner_product(a, b) / (vector_norm(a) * vector_norm(b)) END"),
    ("lexemes(t STRING)", "ARRAY<STRING>", r"regexp_extract_all(lower(t), r'([\p{L}\p{N}]+)', 1)"),
    ("word_set(t STRING)", "ARRAY<STRING>", r"array_distinct(filter(split(lower(t), r'\s+'), w -> w <> ''))"),
    ("jaccard_of(a ARRAY<STRING>, b ARRAY<STRING>)", "DOUBLE", "CASE WHEN size(array_union(a, b)) > 0 THEN size(array_intersect(a, b)) / size(array_union(a, b)) ELSE 0.0D END"),
    ("reciprocal_rank(r INT, k INT)", "DOUBLE", "coalesce(1.0D / (k + r), 0.0D)"),
    (
        "cover_density(terms ARRAY<STRING>, words ARRAY<STRING>)",
        "DOUBLE",
        """aggregate(
          filter(transform(words, (w, i) -> named_struct('pos', i, 'term', CAST(array_position(terms, w) AS INT))), x -> x.term > 0),
          named_struct('last', CAST(array() AS ARRAY<STRUCT<term: INT, pos: INT, k: INT>>), 'k', 0, 'previous', -1, 'total', 0.0D),
          (s, x) -> transform(array(array_append(filter(s.last, y -> y.term <> x.term), named_struct('term', x.term, 'pos', x.pos, 'k', s.k))), seen -> named_struct(
            'last', seen, 'k', s.k + 1,
            'previous', CASE WHEN size(seen) = size(terms) AND seen[0].pos > s.previous THEN seen[0].pos ELSE s.previous END,
            'total', s.total + CASE WHEN size(seen) = size(terms) AND seen[0].pos > s.previous THEN 0.1D / (1 + x.pos - seen[0].pos - (s.k - seen[0].k)) ELSE 0.0D END))[0],
          s -> s.total)""",
    ),
    (  # cover_density of two words from their places: their covers are neighbours of different words
        "pair_density(places ARRAY<STRUCT<pos: INT, term: BIGINT>>)",
        "DOUBLE",
        """aggregate(
          array_sort(places),
          named_struct('pos', 0, 'term', CAST(0 AS BIGINT), 'total', 0.0D),
          (s, x) -> named_struct('pos', x.pos, 'term', x.term, 'total', s.total + CASE WHEN s.term > 0 AND s.term <> x.term THEN 0.1D / (x.pos - s.pos) ELSE 0.0D END),
          s -> s.total)""",
    ),
)


class HtmlNodes:
    """Rows (pos, last, tag, href, text) of the nodes of a page that a selector finds."""

    def eval(self, html: str, selector: str) -> Iterator[tuple[int, int, str, str | None, str]]:
        from marisight.sources.html_nodes import page_selected

        for node in page_selected(html or "", (("q", selector, ()),)):
            yield node["pos"], node["last"], node["tag"], dict(node["attrs"]).get("href"), node["text"]


def registered(spark: SparkSession) -> None:
    """Makes the functions known to the session under their SQL names."""
    for signature, kind, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    spark.udtf.register("html_nodes", udtf(HtmlNodes, returnType="pos: int, last: int, tag: string, href: string, text: string"))
