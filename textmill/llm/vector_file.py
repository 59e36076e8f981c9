"""Exact search for the highest inner products with a vector-approximation file.

Each block of vectors has a grid of its own: in each dimension marks cut the block's components into
cells, half of the marks at equal shares of the rows and half at equal distances, so that neither a
crowd nor a few long vectors make the cells useless. A vector's approximation is its cell numbers, one
byte each. A query scans the approximations, which bound its inner product with every vector of the
block from both sides; it then reads exact vectors in order of their bounds, best first, until the
kth result is as good as the next bound. The kth result so far goes along from block to block.

Equal vectors are one entry with its smallest ids, so a very common vector is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textmill.llm.vectors import BLOCK_ROWS, best_first, dealt, exact_products, hash_groups, packed, rows_of, unpacked, whole_rows
from textmill.sources.staging import stage

CELL_BITS = 6
GROUP_ROWS = 1024
SCANNED = 256  # queries that scan a block at once: their bounds take 256 x 4,096 x 16 bytes


def cell_marks(matrix: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """For each dimension the rising first values of its cells and, last, one more than the largest value.

    Cells are half open; marks that fall together leave an empty cell between them.
    """
    cells = 1 << bits
    low, high = matrix.min(axis=0).astype(np.int64), matrix.max(axis=0).astype(np.int64) + 1
    even = low + (high - low) * np.arange(1, cells // 2)[:, None] // (cells // 2)
    ordered = np.sort(matrix, axis=0)
    shares = ordered[np.arange(1, cells // 2 + 1) * (len(matrix) - 1) // (cells // 2 + 1)]
    return np.concatenate([low[None], np.sort(np.concatenate([even, shares]), axis=0), high[None]]).T.astype(np.int64)


def approximate(matrix: np.ndarray, bits: int = CELL_BITS) -> bytes:
    """The marks of a block and the cell of every component, as bytes."""
    marks = cell_marks(matrix, bits)
    cells = np.stack([np.searchsorted(m, column, side="right") - 1 for m, column in zip(marks, matrix.T)], axis=1)
    return marks.tobytes() + cells.astype(np.uint8).tobytes()


class VectorFile:
    """A block's approximations, and its exact vectors, which are read by place."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, approximation: bytes, bits: int = CELL_BITS):
        rows, dims = vectors.shape
        self.ids, self.vectors = ids, vectors
        marks = np.frombuffer(approximation, dtype=np.int64, count=dims * ((1 << bits) + 1)).reshape(dims, -1)
        cells = np.frombuffer(approximation, dtype=np.uint8, offset=marks.nbytes).reshape(rows, dims)
        at = np.arange(dims)
        low, high = marks[at, cells], marks[at, cells + 1] - 1
        self.middle, self.half = (low + high) / 2.0, (high - low) / 2.0
        self.largest = np.abs(marks).max(axis=1).astype(np.float64)
        self.read = 0

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner product of each query with each vector."""
        queries = queries.astype(np.float64)
        size = np.abs(queries)
        # Sums of whole and half numbers are exact below 2**52; beyond, rounding is added to the bounds.
        rounding = (size @ self.largest) * queries.shape[1] * 2.0**-50
        middle, half = queries @ self.middle.T, size @ self.half.T + np.where(rounding < 0.25, 0, rounding)[:, None]
        return middle - half, middle + half

    def improve(self, query: np.ndarray, places: np.ndarray, upper: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of ``best`` (scores, ids) and of the vectors at ``places``, read from the highest bound down."""
        order = np.argsort(-upper, kind="stable")
        scores, ids = best
        at, step = 0, 2 * k
        while at < len(order) and (len(scores) < k or upper[order[at]] >= scores[-1]):
            some = places[order[at : at + step]]
            self.read += len(some)
            scores = np.concatenate([scores, exact_products(self.vectors[some], query[None])[:, 0]])
            ids = np.concatenate([ids, self.ids[some]])
            first = best_first(scores, ids, k)
            scores, ids = scores[first], ids[first]
            at, step = at + step, 2 * step
        return scores, ids

    def search(self, queries: np.ndarray, best: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
        """Improve the ``k`` best of every query."""
        for first in range(0, len(queries), SCANNED):
            some = queries[first : first + SCANNED]
            lower, upper = self.bounds(some)
            if len(self.ids) > k:
                least = np.partition(lower, len(self.ids) - k, axis=1)[:, len(self.ids) - k]
            else:
                least = np.full(len(some), -np.inf)
            for i in range(len(some)):
                scores = best[first + i][0]
                needed = max(least[i], scores[-1]) if len(scores) == k else least[i]
                places = np.flatnonzero(upper[i] >= needed)
                if len(places):
                    best[first + i] = self.improve(some[i], places, upper[i, places], best[first + i], k)


FOUND = StructType([StructField(n, LongType()) for n in ("query_id", "id", "score")])


def _search_strips(rows: DataFrame, k: int, bits: int) -> DataFrame:
    """``query_id, id, score``: the ``k`` best of each query in each strip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries, best = np.empty(0, np.int64), np.empty((0, 1), np.int32), []

        def found() -> Iterator[pa.RecordBatch]:
            if any(len(b[0]) for b in best):
                columns = [np.repeat(own, [len(b[0]) for b in best]), np.concatenate([b[1] for b in best]), np.concatenate([b[0] for b in best])]
                yield pa.record_batch([pa.array(c) for c in columns], names=FOUND.names)

        for row in rows_of(batches):
            ids, _, vectors = unpacked(row)
            if row["kind"] == 0:
                yield from found()
                own, queries, best = ids, vectors, [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
            else:
                VectorFile(ids, vectors, row["more"], bits).search(queries, best, k)
        yield from found()

    return rows.mapInArrow(run, FOUND)


def top_products(
    df: DataFrame, queries: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding", scale: int = 256, bits: int = CELL_BITS,
) -> DataFrame:
    """``query_id, rank, <row_id>, score``: the ``k`` highest inner products of every row for which ``queries`` holds.

    Components are ``floor(scale * x)``, whole numbers that saturate at 2**26; scores are exact in 64
    bits up to 2,048 dimensions. Equal scores go to the smaller id; a row is no result of its own id;
    all are returned if there are fewer than ``k``. ``row_id`` must be a whole number and ``queries`` an expression
    of it. Rows with a null id, and vectors that are null, empty or hold null or non-finite components, take
    no part; zero vectors do. Vectors of different lengths are searched apart. Of several rows of one
    id the one with the least vector counts. Other columns are not read.

    Groups of about ``GROUP_ROWS`` queries meet strips of blocks; from a strip come ``k`` rows for each query.
    """
    rows = stage(whole_rows(df, row_id, vector, scale=scale), "rows")
    asks = queries if row_id == "id" else F.col("asks")
    named = rows if row_id == "id" else rows.withColumn(row_id, F.col("id")).withColumn("asks", queries).drop(row_id)
    groups = packed(hash_groups(named, GROUP_ROWS, asks), 2 * GROUP_ROWS, parts=("part",))
    # An entry needs one id more than asked for, as the query may be one of them.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("dims").alias("dims"))
    entries = stage(entries.withColumn("id", F.element_at("ids", 1)).withColumn("label", F.lit(0).cast("long")), "entries")
    ordered = entries.sortWithinPartitions("dims", "id")
    blocks = packed(ordered, BLOCK_ROWS, lambda matrix: approximate(matrix, bits))
    # One more entry, as an entry may hold nothing but the query.
    found = _search_strips(dealt(groups, blocks), k + 1, bits)
    all_ids = found.join(entries.select("id", F.col("ids").alias("_ids")), "id").select("query_id", "score", F.explode("_ids").alias(row_id))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), row_id)
    ranked = all_ids.filter(F.col(row_id) != F.col("query_id")).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", row_id, "score")
