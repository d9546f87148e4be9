"""An inverted file of vectors: cells around centres, searched by distance, exactly or for a wanted recall.

Centres are k-means centres of directions, fitted on a bounded sample of rows (``SAMPLE`` a list).  Every row is
indexed, in the cell of its nearest centre; a cell keeps its number of rows and its radius, the largest angle of a
row to the centre.  Rows without a direction (norm 0, or of another length than most) stand in a cell of their own.

A search ranks cells by the angle between question and centre.  The first ``probes`` of them give a threshold: the
angle of the k-th best row.  A cell can hold a better row only if the angle to its centre less its radius is no
larger, so probing these too makes the search exact; leaving them out makes it approximate, and ``calibrated``
finds the probes that a wanted recall takes on a bounded number of rows asked as questions.

Cells with many rows are dealt over shards, so no task holds more than a shard and a block of questions; what goes
to all tasks are the centres, ``LISTS`` of them at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisight.functions.vectors import norm
from marisight.operators.retrieval import VECTOR_ROWS, _matrix, _nearest, _top
from marisight.operators.tables import settled

#: cells by default and at most, and rows a cell that centres are fitted on
LISTS, MOST_LISTS, SAMPLE = 100, 4096, 64
#: questions of a cell's shard that one task compares at a time
QUESTIONS = 1000
#: slack of angles, for rounding
_SLACK = 1e-7
OTHERS = -1


class Index:
    """Rows (id, embedding, cell) and, per cell, its centre, radius and rows."""

    def __init__(self, rows: DataFrame, centres: np.ndarray, radius: dict[int, float], size: dict[int, int]):
        self.rows, self.centres, self.radius, self.size = rows, centres, radius, size


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    scale = np.sqrt((vectors**2).sum(1))[:, None] * np.sqrt((centres**2).sum(1))[None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.arccos(np.clip(np.where(scale > 0, (vectors @ centres.T) / scale, 0.0), -1, 1))


def _unit(c: str) -> Column:
    n = norm(F.col(c))
    return F.transform(c, lambda x: x / n)


def built(index: DataFrame, lists: int = LISTS, seed: int = 5) -> Index:
    """The inverted file of an index's rows (id, embedding); rows without an embedding take no part."""
    lists = min(lists, MOST_LISTS)
    rows = index.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = lambda c: F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(whole("embedding") & (norm(F.col("embedding")) > 0))
    usual = good.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return Index(settled(rows.withColumn("cell", F.lit(OTHERS)).withColumn("angle", F.lit(0.0))), np.zeros((0, 1)), {OTHERS: np.pi}, {OTHERS: rows.count()})
    width, n = usual["width"], usual["count"]
    sample = good.where(F.size("embedding") == width).orderBy(F.xxhash64("id")).limit(lists * SAMPLE)
    fitted = KMeans(k=max(1, min(lists, n)), seed=seed, maxIter=10, distanceMeasure="cosine", featuresCol="features").fit(sample.select(array_to_vector(_unit("embedding")).alias("features")))
    centres = np.array(fitted.clusterCenters(), dtype=np.float64).reshape(-1, width)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                sizes = np.asarray(part.column(1).value_lengths())
                vectors = _matrix(pa.chunked_array([part.column(1)]), max(width, int(sizes.max())))
                angle = _angles(vectors[:, :width], centres)
                cell = angle.argmin(1)
                near = angle[np.arange(len(cell)), cell]
                finite = np.isfinite(np.asarray(part.column(1).flatten(), dtype=np.float64))
                usable = (sizes == width) & (np.sqrt((vectors**2).sum(1)) > 0) & np.logical_and.reduceat(finite, np.r_[0, np.cumsum(sizes)[:-1]])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.where(usable, cell, OTHERS).astype(np.int32)), pa.array(np.where(usable, near, 0.0))], names=["id", "embedding", "cell", "angle"])

    placed_rows = settled(rows.mapInArrow(placed, "id long, embedding array<double>, cell int, angle double"))
    found = placed_rows.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect()  # a row a cell
    return Index(placed_rows, centres, {r.cell: np.pi if r.cell == OTHERS else r.radius for r in found}, {r.cell: r.n for r in found})


def cell_order(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, embedding, cell, turn, least): for each question all cells that have rows, nearest first, with the least
    angle that a row in it can have to the question; 0 where it is unknown."""
    cells = sorted(index.size)
    known = [c for c in cells if c != OTHERS]
    centres, width = index.centres[known] if known else np.zeros((0, 1)), index.centres.shape[1]
    radius = np.array([index.radius[c] for c in known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n = part.num_rows
                sizes = np.asarray(part.column(1).value_lengths())
                vectors = _matrix(pa.chunked_array([part.column(1)]), max(width, int(sizes.max())))
                angle = _angles(vectors[:, :width], centres)
                clear = ((sizes == width) & (np.sqrt((vectors**2).sum(1)) > 0))[:, None]
                least = np.where(clear, np.maximum(0.0, angle - radius - _SLACK), 0.0)
                if len(known) < len(cells):  # the cell of others comes last
                    angle, least = np.c_[angle, np.full(n, np.pi + 1)], np.c_[least, np.zeros(n)]
                order = np.argsort(angle, axis=1, kind="stable")
                named = np.array([*known, *([OTHERS] if len(known) < len(cells) else [])], dtype=np.int32)
                of = pa.array(np.repeat(np.arange(n), len(cells)))
                yield pa.RecordBatch.from_arrays([*[c.take(of) for c in part.columns], pa.array(named[order].ravel()), pa.array(np.tile(np.arange(len(cells), dtype=np.int32), n)), pa.array(np.take_along_axis(least, order, 1).ravel())], names=["query_id", "embedding", "cell", "turn", "least"])

    asked = queries.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return asked.mapInArrow(run, "query_id long, embedding array<double>, cell int, turn int, least double")


def _probed(index: Index, probes: DataFrame, n: int) -> DataFrame:
    """(query_id, id, similarity): of each question and cell of probes the n most similar rows of each shard."""
    shards = {c: -(-size // VECTOR_ROWS) for c, size in index.size.items()}
    large = F.create_map(*[F.lit(x) for c, k in shards.items() if k > 1 for x in (c, k)]) if any(k > 1 for k in shards.values()) else None
    parts = F.lit(1) if large is None else F.coalesce(F.try_element_at(large, F.col("cell")), F.lit(1))
    rows = index.rows.select("id", "embedding", "cell", F.pmod(F.xxhash64("id"), parts).cast("int").alias("shard"))
    asked = probes.select(F.col("query_id").alias("id"), "embedding", "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("shard"))
    blocks = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-probes.select("query_id").distinct().count() // QUESTIONS)))).cast("int")
    every = asked.withColumn("block", blocks)
    used = every.select(*[F.col(c).alias(f"_{c}") for c in ("cell", "shard", "block")]).distinct()
    keys = ["cell", "shard", "block"]
    met = rows.join(used, (F.col("cell") == F.col("_cell")) & (F.col("shard") == F.col("_shard"))).select("id", "embedding", "cell", "shard", F.col("_block").alias("block"))
    return every.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(_nearest(n), "query_id long, id long, similarity double")


def search(index: Index, queries: DataFrame, n: int, probes: int = 8, exact: bool = True) -> DataFrame:
    """(query_id, id, similarity, vrank): the n most similar rows of each question; of all rows, or of those in the
    ``probes`` nearest cells."""
    order = settled(cell_order(index, queries))
    near = order.where(F.col("turn") < probes)
    found = _probed(index, near, n)
    best = lambda rows: _top(rows, n, F.desc("similarity"), F.asc("id")).withColumnRenamed("_r", "vrank")
    if not exact:
        return best(found)
    found = settled(best(found))
    reached = found.where(F.col("vrank") == n).select("query_id", F.acos(F.least(F.greatest("similarity", F.lit(-1.0)), F.lit(1.0))).alias("reached"))
    rest = order.where(F.col("turn") >= probes).join(reached, "query_id", "left").where(F.col("reached").isNull() | (F.col("least") <= F.col("reached") + _SLACK))
    more = _probed(index, settled(rest.select("query_id", "embedding", "cell")), n)
    return best(found.select("query_id", "id", "similarity").unionByName(more))


def calibrated(index: Index, n: int, recall: float = 0.95, questions: int = 64) -> int:
    """The probes that find a share of ``recall`` of the n most similar rows, over ``questions`` of the index's own rows."""
    asked = index.rows.where(F.col("cell") != OTHERS).orderBy(F.xxhash64("id", F.lit(1))).limit(questions).select(F.col("id").alias("query_id"), "embedding")
    asked = settled(asked)
    found = search(index, asked, n)
    turn = cell_order(index, asked).select("query_id", "cell", "turn")
    met = found.join(index.rows.select("id", "cell"), "id").join(turn, ["query_id", "cell"])
    at = met.agg(F.percentile("turn", F.lit(recall)).alias("at")).first().at
    return len(index.size) if at is None else int(np.ceil(at)) + 1
