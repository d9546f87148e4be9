"""Vector and set similarity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product over the shorter length."""
    return F.aggregate(F.arrays_zip(a.alias("a"), b.alias("b")), F.lit(0.0), lambda s, x: s + F.coalesce(x["a"].cast("double") * x["b"].cast("double"), F.lit(0.0)))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 for empty vectors and vectors of norm 0."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) <= 0) | (F.size(b) <= 0) | (n == 0), F.lit(0.0)).otherwise(dot(a, b) / n)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def word_set(text: Column) -> Column:
    """Distinct lower-cased words between white space."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))


def lexemes(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)
