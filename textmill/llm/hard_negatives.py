"""Hard negatives for anchors, with bounds that go down a spanning tree of the anchors.

Anchors of a group are joined into a minimum spanning tree. The score of a candidate at a child is
the score at its parent plus the product of the candidate and the tree's edge, so it differs from
that by at most the edge's length times the candidate's norm. Going down the tree, every candidate
has an interval that holds its score; where an interval reaches into what is asked for, the
candidate is rescored exactly, and its interval at the child's children starts from that.

The first pass finds the best rows of the anchor's own label, the positives. The scores of the positives
set windows, and the second pass finds the best rows of other labels in each window. Groups hold
near anchors: they are laid out by label and by the nearest of a few pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from textmill.llm.vectors import BLOCK_ROWS, best_first, dealt, exact_products, packed, rows_of, unpacked, whole_rows
from textmill.sources.staging import stage

GROUP_ROWS = 256
PIVOTS = 64  # anchors, chosen by a hash of their ids, that decide which anchors stand together


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """``(vertex, parent, length)`` of a minimum spanning tree, each parent before its children; the root's parent is -1.

    Children follow their parent depth first, so that few vertices wait for children at a time.
    """
    points = vectors.astype(np.float64)
    squares = (points * points).sum(axis=1)
    n = len(points)
    parent, near, inside = np.full(n, -1), np.full(n, np.inf), np.zeros(n, dtype=bool)
    children: list[list[int]] = [[] for _ in range(n)]
    lengths, last = np.zeros(n), 0
    for _ in range(n):
        inside[last] = True
        if parent[last] >= 0:
            children[parent[last]].append(last)
            lengths[last] = np.sqrt(((points[last] - points[parent[last]]) ** 2).sum())
        away = squares + squares[last] - 2 * (points @ points[last])
        closer = ~inside & (away < near)
        near[closer], parent[closer] = away[closer], last
        last = int(np.argmin(np.where(inside, np.inf, near)))
    out, waiting = [], [0]
    while waiting:
        vertex = waiting.pop()
        out.append((vertex, int(parent[vertex]), float(lengths[vertex])))
        waiting += children[vertex]
    return out


class AnchorTree:
    """A group of anchors, and the candidates' intervals on the way down its tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.tree = spanning_tree(vectors)
        self.last_child = {parent: place for place, (_, parent, _) in enumerate(self.tree)}
        self.rescored = 0

    def walk(self, matrix: np.ndarray, wanted) -> None:
        """Call ``wanted(anchor, low, high, rescore)`` for each anchor; ``rescore(places)`` makes intervals exact."""
        norms = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for place, (vertex, parent, length) in enumerate(self.tree):
            if parent < 0:
                scores = exact_products(matrix, self.vectors[vertex][None])[:, 0].astype(np.float64)
                slack = np.abs(scores) * 1e-12
                low, high = scores - slack, scores + slack
                self.rescored += len(scores)
            else:
                above = held[parent]
                # Half a unit and a part in a billion stand for the rounding of lengths, norms and sums.
                reach = length * norms * (1 + 1e-9) + np.abs(above[0]) * 1e-12 + 0.5
                low, high = above[0] - reach, above[1] + reach
                if self.last_child[parent] == place:
                    del held[parent]

            def rescore(places: np.ndarray) -> np.ndarray:
                self.rescored += len(places)
                scores = exact_products(matrix[places], self.vectors[vertex][None])[:, 0]
                low[places] = high[places] = scores
                return scores

            wanted(vertex, low, high, rescore)
            if vertex in self.last_child:
                held[vertex] = (low, high)


class Positives:
    """The best ``k`` rows of the anchors' own labels."""

    fields = ["anchor_id", "id", "score"]

    def __init__(self, group: AnchorTree, row: dict, k: int, share: tuple[int, int]):
        self.group, self.k = group, k
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in group.ids]

    def meet(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        group, k = self.group, self.k
        if not np.isin(labels, group.labels).any():
            return
        some = np.isin(labels, group.labels)
        ids, labels, matrix = ids[some], labels[some], matrix[some]

        def wanted(anchor: int, low: np.ndarray, high: np.ndarray, rescore) -> None:
            same = np.flatnonzero((labels == group.labels[anchor]) & (ids != group.ids[anchor]))
            scores, found = self.best[anchor]
            needed = scores[-1] if len(scores) == k else -np.inf
            if len(same) >= k:
                needed = max(needed, np.partition(low[same], len(same) - k)[len(same) - k])
            places = same[high[same] >= needed]
            if len(places):
                scores, found = np.concatenate([scores, rescore(places)]), np.concatenate([found, ids[places]])
                first = best_first(scores, found, k)
                self.best[anchor] = scores[first], found[first]

        group.walk(matrix, wanted)

    def rows(self) -> list[np.ndarray]:
        counts = [len(s) for s, _ in self.best]
        return [np.repeat(self.group.ids, counts), np.concatenate([f for _, f in self.best]), np.concatenate([s for s, _ in self.best])]


class Negatives:
    """For each positive of an anchor the best ``k`` rows of other labels whose score lies in its window."""

    fields = ["anchor_id", "id", "score", "place"]

    def __init__(self, group: AnchorTree, row: dict, k: int, share: tuple[int, int]):
        self.group, self.k = group, k
        scores = row["windows"]
        num, den = share
        # num * positive <= den * score <= den * positive, in whole numbers.
        self.windows = [[(-(-num * s // den), s) for s in scores.get(int(i), [])] for i in group.ids]
        self.best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in w] for w in self.windows]

    def meet(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        group, k = self.group, self.k

        def wanted(anchor: int, low: np.ndarray, high: np.ndarray, rescore) -> None:
            other = labels != group.labels[anchor]
            overlaps = np.zeros(len(ids), dtype=bool)
            for (least, most), (scores, _) in zip(self.windows[anchor], self.best[anchor]):
                if least <= most:
                    overlaps |= (low <= most) & (high >= (scores[-1] if len(scores) == k else least))
            places = np.flatnonzero(overlaps & other)
            if not len(places):
                return
            exact, named = rescore(places), ids[places]
            for at, (least, most) in enumerate(self.windows[anchor]):
                inside = np.flatnonzero((exact >= least) & (exact <= most))
                if len(inside):
                    scores, found = self.best[anchor][at]
                    scores, found = np.concatenate([scores, exact[inside]]), np.concatenate([found, named[inside]])
                    first = best_first(scores, found, k)
                    self.best[anchor][at] = scores[first], found[first]

        group.walk(matrix, wanted)

    def rows(self) -> list[np.ndarray]:
        flat = [(i, at, found, scores) for i, windows in zip(self.group.ids, self.best) for at, (scores, found) in enumerate(windows)]
        counts = [len(f[2]) for f in flat]
        if not flat:
            return [np.empty(0, np.int64) for _ in self.fields]
        columns = [np.repeat(np.array([f[c] for f in flat], dtype=np.int64), counts) for c in (0, 1)]
        return [columns[0], np.concatenate([f[2] for f in flat]), np.concatenate([f[3] for f in flat]), columns[1]]


def _met(rows: DataFrame, work: type, k: int, share: tuple[int, int]) -> DataFrame:
    """What ``work`` finds for each group of anchors in each strip of blocks."""
    schema = StructType([StructField(n, LongType()) for n in work.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for row in rows_of(batches):
            ids, labels, vectors = unpacked(row)
            if row["kind"] == 0:
                if current is not None:
                    yield pa.record_batch([pa.array(c) for c in current.rows()], names=schema.names)
                row["windows"] = {w["anchor"]: w["scores"] for w in row.get("windows") or []}
                current = work(AnchorTree(ids, labels, vectors), row, k, share)
            else:
                current.meet(ids, labels, vectors)
        if current is not None:
            yield pa.record_batch([pa.array(c) for c in current.rows()], names=schema.names)

    return rows.mapInArrow(run, schema)


def _near_groups(anchors: DataFrame) -> DataFrame:
    """Anchors with ``part``, the nearest of ``PIVOTS`` of them, in order of label, part and id."""
    pivots = [(r["dims"], r["vector"]) for r in anchors.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()]
    by_dims = {d: np.array([v for e, v in pivots if e == d], dtype=np.float64) for d, _ in pivots}
    schema = StructType([*anchors.schema.fields, StructField("part", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for dims, vector in zip(batch.column("dims").to_pylist(), batch.column("vector")):
                at = by_dims.get(dims)
                away = None if at is None else (at * at).sum(axis=1) - 2 * (at @ vector.values.to_numpy().astype(np.float64))
                near.append(-1 if away is None else int(np.argmin(away)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], names=schema.names)

    order = ["dims", "label", "part", "id"]
    return anchors.mapInArrow(run, schema).repartitionByRange(*order).sortWithinPartitions(*order)


def mine_negatives(
    df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
    row_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` holds.

    A row's score is its inner product with the anchor, in components ``floor(scale * x)`` that
    saturate at 2**26. An anchor's positives are its ``positives`` best other rows of its label. Negatives of
    a positive are the ``negatives`` best rows of other labels whose score is at least ``share`` of the
    positive's and not above it. Equal scores go to the smaller id; all are taken if there are fewer.

    ``row_id`` and ``label`` must be whole numbers, ``anchors`` an expression of ``row_id``. Rows with a null id or label, and
    vectors that are null, empty or hold null or non-finite components, take no part; vectors meet those
    of their own length only. Of several rows of one id that with the least label and vector counts.
    Other columns are not read. A positive of a score below zero has an empty window.

    Groups of at most ``GROUP_ROWS`` anchors meet strips of blocks, and a strip returns the best rows only.
    """
    rows = stage(whole_rows(df, row_id, vector, label, scale), "rows")
    asking = rows.withColumn("_asks", F.col("id"))
    asking = asking.withColumn(row_id, F.col("id")).filter(anchors).select(rows.columns)
    groups = packed(_near_groups(stage(asking, "anchors")), GROUP_ROWS)
    order = ["dims", "label", "id"]
    blocks = packed(rows.repartitionByRange(*order).sortWithinPartitions(*order), BLOCK_ROWS)

    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = _met(dealt(groups, blocks), Positives, positives, share).withColumn("place", F.row_number().over(best) - 1)
    near = stage(near.filter(F.col("place") < positives), "positives")

    # The positives' scores, in order, go to the groups of their anchors.
    schema = StructType([StructField("group_", LongType()), StructField("anchor", LongType())])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids = np.frombuffer(row["ids"], dtype=np.int64)
            yield pa.record_batch([pa.array(np.full(len(ids), row["block"])), pa.array(ids)], names=schema.names)

    scores = near.groupBy(F.col("anchor_id").alias("anchor")).agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("s"))
    listed = groups.select("ids", "block").mapInArrow(members, schema).join(scores, "anchor")
    window = F.struct("anchor", F.col("s.score").alias("scores"))
    windows = listed.groupBy(F.col("group_").alias("block")).agg(F.collect_list(window).alias("windows"))
    ready = stage(groups.join(windows, "block"), "windows")

    place = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    hard = _met(dealt(ready, blocks), Negatives, negatives, share).withColumn("rank", F.row_number().over(place))
    hard = hard.filter(F.col("rank") <= negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    near = near.withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
    return hard.join(near, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
