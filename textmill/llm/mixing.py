"""Mixing sources to target weights by entropy balancing.

Each document gets a rate ``min(cap, exp(tilt * size))``: among all rates up to the cap, these move
least, in relative entropy, from taking every document once while the source's words sum to its
target. One tilt for each source is the dual variable; it solves a convex problem whose gradient and
curvature are sums over the source's sizes. The documents are first summed to a histogram of sizes,
so a Newton step costs a pass over distinct sizes, whatever the number of documents, and a source
that holds a third of all rows is no larger a group than any other.

Rates become whole copies by systematic rounding along the sizes; what the source's sum then still
misses is taken or returned from the large sizes to the small, until it is below the smallest size
that has room. Where larger sizes stand in the way, one document is swapped for smaller ones. The
same table gives the same copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.sources.staging import stage

WORDS = r"[^\x20\x09-\x0D]+"
NEWTON_STEPS = 16
SALT = 64  # rows of one source and size are dealt to this many cells


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``key, source_size, target`` from one row for each source: shares by weight, none above ``cap`` times its size.

    Sources take ``weights`` in turn, in the order of ``key``. What a capped source leaves goes to the
    others by weight, until none is above its cap: sources are capped in the order of cap to weight.
    The windows order one row for each source.
    """
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.withColumn("weight", weight)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(Window.partitionBy())
    left = total - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0.0))
    shares = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("place", F.row_number().over(by_ratio)).withColumn("level", left / shares)
    open_ = F.col("level") * F.col("weight") < cap * F.col("source_size")
    level = F.min(F.when(open_, F.struct("place", "level"))).over(Window.partitionBy())["level"]
    capped = cap * F.col("source_size")
    target = F.coalesce(F.least(level * F.col("weight"), capped), capped)
    return rows.select("key", "source_size", target.alias("target"))


def tilts(histogram: DataFrame, targets: DataFrame, cap: float, steps: int = NEWTON_STEPS) -> DataFrame:
    """``key, tilt`` (for each mean size of the source) by Newton steps kept within a shrinking bracket."""
    every = Window.partitionBy("key")
    mean = F.sum(F.col("n") * F.col("size")).over(every) / F.sum("n").over(every)
    rows = histogram.join(targets, "key").filter("size > 0").withColumn("unit", F.col("size") / mean)
    rows = rows.select(
        "key", "target", "unit", (F.col("n") * F.col("size")).cast("double").alias("words"),
        F.lit(0.0).alias("tilt"), F.lit(-1e9).alias("low"),
        (F.log(F.lit(cap)) / F.min("unit").over(every)).alias("high"),
    )
    for _ in range(steps):
        power = F.exp(F.least(F.col("tilt") * F.col("unit"), F.lit(700.0)))
        rows = rows.withColumns(
            {
                "found": F.sum(F.col("words") * F.least(power, F.lit(cap))).over(every),
                "slope": F.sum(F.when(power < cap, F.col("words") * F.col("unit") * power).otherwise(0.0)).over(every),
            }
        )
        high = F.when(F.col("found") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        low = F.when(F.col("found") > F.col("target"), F.col("low")).otherwise(F.col("tilt"))
        rows = rows.withColumns({"low": low, "high": high})
        newton = F.col("tilt") - F.when(F.col("slope") > 0, (F.col("found") - F.col("target")) / F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        middle = F.when(F.col("low") < -1e8, 2 * F.col("high") - 1.0).otherwise((F.col("low") + F.col("high")) / 2)
        rows = rows.withColumn("tilt", F.when(inside, newton).otherwise(middle))
    return rows.groupBy("key").agg(F.first("tilt").alias("tilt"))


def _room(cap: int) -> Column:
    """Copies that a cell can still take, or return if its source has too much."""
    return F.when(F.col("missing") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))


def mended(rows: DataFrame, cap: int) -> DataFrame:
    """``rows`` (staged) with ``copies`` and ``missing`` after each source took or returned, from large sizes to small, what fits.

    A round goes down the sizes that fit as far as whole cells fit, and takes what fits of the next one.
    Its first document fits, and what is missing after it is below half of what was missing before, so
    there are as many rounds as the largest miss has binary digits.
    """
    every = Window.partitionBy("key")
    along = every.orderBy(F.desc("size"), "cell").rowsBetween(Window.unboundedPreceding, 0)
    most = rows.agg(F.max(F.abs("missing"))).head()[0] or 0
    for number in range(int(most).bit_length()):
        room = F.when((F.col("size") > 0) & (F.col("size") <= F.abs("missing")), _room(cap)).otherwise(F.lit(0))
        rows = rows.withColumn("room", room).withColumn("upto", F.sum(F.col("room") * F.col("size")).over(along))
        left = F.abs("missing") - (F.col("upto") - F.col("room") * F.col("size"))
        crossing = (F.col("upto") > F.abs("missing")) & (left >= 0)
        change = F.when(F.col("upto") <= F.abs("missing"), F.col("room")).when(crossing, F.floor(left / F.col("size"))).otherwise(F.lit(0))
        change = F.when(F.col("room") > 0, change).otherwise(F.lit(0)) * F.signum("missing")
        rows = rows.withColumn("change", change.cast("long")).withColumn("copies", F.col("copies") + F.col("change"))
        rows = rows.withColumn("missing", F.col("missing") - F.sum(F.col("change") * F.col("size")).over(every)).drop("room", "upto", "change")
        if number % 8 == 7:
            rows = stage(rows, "round")  # plans stay short
    return rows


def cell_copies(cells: DataFrame, histogram: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """``key, size, cell, n, copies``: the copies of all documents of a cell together."""
    every = Window.partitionBy("key")
    along = every.orderBy(F.desc("size"), "cell").rowsBetween(Window.unboundedPreceding, 0)
    rows = cells.join(targets, "key").join(tilts(histogram, targets, float(cap)), "key", "left")
    mean = F.sum(F.col("n") * F.col("size")).over(every) / F.sum("n").over(every)
    full = F.col("target") >= F.col("source_size") * F.lit(float(cap)) * (1 - 1e-12)
    power = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0)))
    rate = F.when(full | F.col("tilt").isNull(), F.lit(float(cap))).otherwise(F.least(power, F.lit(float(cap))))
    rows = rows.withColumn("mean", mean).withColumn("rate", rate)
    rows = rows.withColumn("base", F.floor("rate")).withColumn("part", F.col("n") * (F.col("rate") - F.col("base")))
    rows = rows.withColumn("upto", F.sum("part").over(along))
    extra = F.floor(F.col("upto") + 0.5) - F.floor(F.greatest(F.col("upto") - F.col("part"), F.lit(0.0)) + 0.5)
    copies = F.least(F.greatest(F.col("n") * F.col("base") + extra, F.lit(0)), cap * F.col("n"))
    rows = rows.withColumn("copies", copies.cast("long"))
    rows = rows.withColumn("missing", F.round("target") - F.sum(F.col("copies") * F.col("size")).over(every))
    rows = mended(stage(rows.select("key", "size", "cell", "n", "copies", "missing"), "rounded"), cap)
    # Of a source that no fitting size can mend, one document of the next larger size changes, and smaller ones make up for it.
    change = F.signum("missing").cast("long")
    other = (F.col("size") > F.abs("missing")) & (_room(cap) > 0)
    swap = F.min(F.when(other, F.struct("size", "cell"))).over(every)
    least = F.min(F.when(F.col("size") > 0, F.col("size"))).over(every)
    rows = stage(rows.withColumns({"swap": swap, "open": F.abs("missing") >= least}), "mended")
    if not rows.filter("open AND swap IS NOT NULL").isEmpty():
        chosen = F.col("open") & F.coalesce(F.col("swap") == F.struct("size", "cell"), F.lit(False))
        moved = F.col("open") & F.col("swap").isNotNull()
        rows = rows.withColumns({"first_copies": F.col("copies"), "first_missing": F.col("missing")})
        rows = rows.withColumn("copies", F.col("copies") + F.when(chosen, change).otherwise(F.lit(0)))
        rows = rows.withColumn("missing", F.col("missing") - F.when(moved, change * F.col("swap.size")).otherwise(F.lit(0)))
        rows = mended(stage(rows, "swapped"), cap)
        better = F.abs("missing") < F.abs("first_missing")
        rows = rows.withColumn("copies", F.when(better, F.col("copies")).otherwise(F.col("first_copies")))
    return rows.select("key", "size", "cell", "n", "copies")


def mix_sources(
    df: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: int = 3,
    row_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``df`` with ``size`` (words), ``source_size``, ``target`` and ``copies``, 0 up to ``cap``, for every row.

    The sources' targets sum to the words of the table; a null source is a source of its own, the
    last in order. A null text has size 0; rows of size 0 are never taken. Rows with equal ids and
    sizes are interchangeable. Columns of the four names are replaced; all others stay. Text is
    counted for the histogram and once more where the copies are joined; the documents are shuffled
    once, by source, size and cell.
    """
    names = ["size", "source_size", "target", "copies"]
    key = F.when(F.col(source).isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), F.col(source).cast("string")))
    cell = F.pmod(F.xxhash64(F.col(row_id)), F.lit(SALT))
    rows = df.select(
        F.struct(*[F.col(c) for c in df.columns if c not in names]).alias("row"),
        key.alias("key"), word_count(F.col(text)).alias("size"), cell.alias("cell"), F.xxhash64(F.col(row_id)).alias("turn"),
    )
    cells = stage(rows.groupBy("key", "size", "cell").agg(F.count("*").alias("n")), "cells")
    histogram = cells.groupBy("key", "size").agg(F.sum("n").alias("n"))
    sizes = histogram.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).cast("double").alias("source_size"))
    targets = stage(source_targets(sizes, weights, float(cap)), "targets")
    copies = stage(cell_copies(cells, histogram, targets, cap).join(targets, "key"), "copies")
    joined = rows.join(copies, ["key", "size", "cell"])
    turn = F.row_number().over(Window.partitionBy("key", "size", "cell").orderBy("turn", F.col("row")[row_id]))
    own = F.floor(F.col("copies") / F.col("n")) + (turn <= F.col("copies") % F.col("n")).cast("long")
    return joined.select(
        "row.*", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        F.when(F.col("size") == 0, 0).otherwise(own).cast("int").alias("copies"),
    )


def repeat_rows(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row of a mix as often as its ``copies`` say, with ``columns`` only."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.filter("copies > 0").select(*columns, times.alias("_copy")).drop("_copy")
