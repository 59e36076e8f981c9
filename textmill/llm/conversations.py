"""Repair of the turn structure of conversations by iterative-deepening A*.

A repaired conversation is empty, or an optional system turn and then one or more pairs of a user and an
assistant turn. Edits lead from the given rows to one: a row is kept, deleted or given another role,
and empty turns are inserted. The search goes depth first through the edits in ASCII order of their
initials, within a cost bound that rises until a path is accepted; the cheapest audit, and among
equal ones the ASCII-least, is the first accepted path. A table of failed states holds for each row and
state the largest budget that did not suffice, and stays valid from bound to bound.

Conversations are laid out by range and cut into segments where a partition ends or a segment is
full. A conversation that is one segment is searched from the start to acceptance. A segment of a longer
one is searched from each state to each state, and the segments' costs are then combined from the last to
the first. An insertion belongs to the row after it, so no audit of a segment begins another one, and
the ASCII-least audit of the whole is that of the segments in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from textmill.llm.vectors import rows_of
from textmill.sources.staging import stage

SEGMENT_ROWS = 64
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system turn, after a user turn, after a pair.
STATES = START, SYSTEM, USER, PAIR = 0, 1, 2, 3
KEEPS = {("s", START): SYSTEM, **{("u", s): USER for s in (START, SYSTEM, PAIR)}, ("a", USER): PAIR}
NEXT = {START: USER, SYSTEM: USER, PAIR: USER, USER: PAIR}  # by an inserted or renamed turn
ROLE = {USER: "user", PAIR: "assistant"}
TAILS = {START: "", PAIR: "", USER: "I", SYSTEM: "II"}  # what completes a conversation that ends in the state
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1


@lru_cache(maxsize=100_000)
def cheapest(symbols: str, start: int = START, goal: int | None = None) -> tuple[int, str] | None:
    """Least cost and ASCII-least audit from ``start`` over all rows to ``goal``, or to a complete conversation if None.

    A symbol is a row's role initial, ``x`` for any other, in upper case if the row is truncated, or ``d``
    for a row that must go. With a goal the audit ends with an edit of the last row. None if there is no way.
    """
    n = len(symbols)
    if goal in (START, SYSTEM) and start != goal and not (goal == SYSTEM and start == START and "s" in symbols.lower()):
        return None
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if symbols[i] == "d" else TRUNCATED * symbols[i].isupper())
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def descend(i: int, state: int, budget: int) -> bool:
        if i == n and (state in (START, PAIR) if goal is None else state == goal):
            return True
        if budget < rest[i] or failed.get((i, state), -1) >= budget or (i == n and goal is not None):
            return False
        edits = []
        if i < n:
            edits.append(("D", i + 1, state, DELETE))
        edits.append(("I", i, NEXT[state], INSERT))
        if i < n and symbols[i] != "d":
            extra, kept = TRUNCATED * symbols[i].isupper(), KEEPS.get((symbols[i].lower(), state))
            if kept is not None:
                edits.append(("K", i + 1, kept, KEEP + extra))
            edits.append(("R", i + 1, NEXT[state], RENAME + extra))
        for edit, there, after, cost in edits:
            if cost <= budget:
                path.append(edit)
                if descend(there, after, budget - cost):
                    return True
                path.pop()
        failed[i, state] = budget
        return False

    for bound in range(rest[0], DELETE * n + 2 * INSERT + TRUNCATED + 1):
        if descend(0, start, bound):
            return bound, "".join(path)
    return None


def edited(audit: str, state: int, symbols: str, copies: list[int]) -> tuple[str, list[list[dict]]]:
    """The audit with a deletion for each further copy, and the turns that the edits of each row give.

    A turn is ``role`` (None for the row's own) and ``own``, whether it has the row's text. Insertions
    come with the row after them, those at the end with the last row.
    """
    whole, out, turns = [], [], []
    for edit in audit:
        whole.append(edit)
        if edit == "I":
            state = NEXT[state]
            turns.append({"role": ROLE[state], "own": False})
            continue
        i = len(out)
        if edit == "K":
            state = KEEPS[symbols[i].lower(), state]
            turns.append({"role": None, "own": True})
        elif edit == "R":
            state = NEXT[state]
            turns.append({"role": ROLE[state], "own": True})
        # Further copies are duplicates; deletions come before insertions in an ASCII-least audit.
        whole.append("D" * (copies[i] - 1))
        out.append(turns)
        turns = []
    out[-1] += turns
    return "".join(whole), out


PAIRS = ("su", "ua", "au")
ROW = StructType([StructField("turn", LongType()), StructField("digest", BinaryType()), StructField("n", LongType())])
SEGMENT = StructType(
    [StructField("k", StringType()), StructField("place", LongType()), StructField("whole", BooleanType()), StructField("symbols", StringType())]
    + [StructField("ends", StringType()), StructField("illegal", LongType()), StructField("rows", ArrayType(ROW))]
    + [StructField("costs", ArrayType(LongType())), StructField("audits", ArrayType(StringType()))]
)
CHOICE = StructType([StructField("k", StringType()), StructField("place", LongType()), StructField("entry", IntegerType()), StructField("leave", IntegerType()), StructField("tail", StringType()), StructField("border", LongType())])
TURN = StructType([StructField("role", StringType()), StructField("own", BooleanType())])
EDITED = StructType(
    [StructField("k", StringType()), StructField("place", LongType()), StructField("cost", LongType()), StructField("illegal", LongType()), StructField("audit", StringType())]
    + [StructField("pieces", ArrayType(StructType([StructField("turn", LongType()), StructField("digest", BinaryType()), StructField("seq", IntegerType()), StructField("turns", ArrayType(TURN))])))]
)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batches(rows: Iterator[dict], schema: StructType, size: int = 500) -> Iterator[pa.RecordBatch]:
    held, kind = [], _arrow(schema)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, kind)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, kind)


def segments(marked: DataFrame) -> DataFrame:
    """Segments of the rows, which lie in order in their partitions, with their cheapest audits."""

    def close(k: str, place: int, run: list[dict]) -> dict:
        symbols = "".join(r["symbol"] for r in run)
        initials = [r["initial"] for r in run]
        illegal = sum(r["n"] - 1 for r in run) + sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
        whole = len(run) == run[0]["entries"]
        found = [cheapest(symbols)] if whole else [cheapest(symbols, a, b) for a in STATES for b in STATES]
        more = DELETE * sum(r["n"] - 1 for r in run)
        return {
            "k": k, "place": place, "whole": whole, "symbols": symbols, "ends": initials[0] + initials[-1], "illegal": illegal,
            "rows": [{c: r[c] for c in ROW.names} for r in run],
            "costs": [None if f is None else f[0] + more for f in found], "audits": [None if f is None else f[1] for f in found],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            place, held = TaskContext.get().partitionId() << 32, []
            for row in rows_of(batches):
                if held and (row["k"] != held[0]["k"] or len(held) == SEGMENT_ROWS):
                    yield close(held[0]["k"], place, held)
                    place, held = place + 1, []
                held.append(row)
            if held:
                yield close(held[0]["k"], place, held)

        return _batches(made(), SEGMENT)

    return marked.mapInArrow(run, SEGMENT)


def choices(parts: DataFrame) -> DataFrame:
    """Entry and leaving state of every segment of the conversations that have several.

    A conversation's segments come in order; of each only costs and the order of its audits are held.
    """

    def chosen(k: str, held: list[dict]) -> Iterator[dict]:
        never = 1 << 62
        ahead = [{s: INSERT * len(TAILS[s]) for s in STATES}]
        for part in reversed(held):
            costs = [never if c is None else c for c in part["costs"]]
            ahead.append({s: min(costs[4 * s + t] + ahead[-1][t] for t in STATES) for s in STATES})
        state, before = START, None
        for at, part in enumerate(held):
            least, rest = ahead[len(held) - at][state], ahead[len(held) - at - 1]
            ways = [t for t in STATES if part["costs"][4 * state + t] is not None and part["costs"][4 * state + t] + rest[t] == least]
            leave = min(ways, key=lambda t: part["ranks"][4 * state + t])
            last = at == len(held) - 1
            border = before is not None and before + part["ends"][0] not in PAIRS
            yield {"k": k, "place": part["place"], "entry": state, "leave": leave, "tail": TAILS[leave] if last else "", "border": int(border)}
            state, before = leave, part["ends"][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            held: list[dict] = []
            for row in rows_of(batches):
                if held and row["k"] != held[0]["k"]:
                    yield from chosen(held[0]["k"], held)
                    held = []
                held.append(row)
            if held:
                yield from chosen(held[0]["k"], held)

        return _batches(made(), CHOICE)

    order = F.array_sort(F.filter("audits", lambda a: a.isNotNull()))
    ranks = F.transform("audits", lambda a: F.array_position(order, a).cast("int"))
    light = parts.select("k", "place", "ends", "costs", ranks.alias("ranks"))
    return light.repartition("k").sortWithinPartitions("k", "place").mapInArrow(run, CHOICE)


def edits(chosen: DataFrame) -> DataFrame:
    """The audit of every segment, and the turns that each of its rows gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for row in rows_of(batches):
                entry = row["entry"] or START
                at = 0 if row["whole"] else 4 * entry + row["leave"]
                tail = row["tail"] or ""
                audit, turns = edited(row["audits"][at] + tail, entry, row["symbols"], [r["n"] for r in row["rows"]])
                pieces = [{"turn": r["turn"], "digest": r["digest"], "seq": i, "turns": t} for i, (r, t) in enumerate(zip(row["rows"], turns)) if t]
                cost = row["costs"][at] + INSERT * len(tail)
                yield {"k": row["k"], "place": row["place"], "cost": cost, "illegal": row["illegal"] + (row["border"] or 0), "audit": audit, "pieces": pieces}

        return _batches(made(), EDITED)

    return chosen.mapInArrow(run, EDITED)


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(reports, turns)``: a report of every conversation of ``df``, and the rows of the repaired conversations.

    A report has ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal`` of the rows given, and
    ``cost`` and ``audit`` of the repair. ``turns`` has the conversation's key ``k``, its id, its order ``place, seq, at``, and
    ``role`` and ``text``.

    Rows go by turn, nulls first, then by role and a digest of the text; a null role or text is one
    space, and null ids are one conversation. A row's first fault counts: blank (no character but ASCII
    white space), duplicate (role and text stood earlier), truncated (the last such character is not
    one of ``.!?``). Blank and duplicate rows are deleted. Costs: keep 0, another role 2, deletion 3,
    insertion 2, and 1 for a truncated row that stays. A pair of neighbours is illegal if their roles' initials
    are not su, ua or au. ``gaps`` are numbers missing between the least and the greatest turn. An empty
    table has no reports. Ids may have any simple type, turns are whole numbers; other columns are not read.

    Copies of a row in a turn are counted before they meet. Narrow rows are laid out by range, so a very
    long conversation is searched by many tasks; the texts of kept rows are joined by digest.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = df.select(key.alias("k"), F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), *named)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.withColumns({"digest": digest, "body": F.rtrim("text", F.lit(WHITE))})
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("x")
    counted = rows.groupBy("k", "turn", "role", "digest").agg(
        F.first("conv_id").alias("conv_id"), F.count("*").alias("n"),
        F.first(F.col("body") == "").alias("blank"), F.first(~F.substring("body", -1, 1).isin(".", "!", "?")).alias("cut"),
    ).withColumn("initial", initial)
    counted = stage(counted, "counted")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = counted.groupBy("k", "digest").agg(F.min(when).alias("first"))
    new = F.col("first") == when
    kind = F.when(F.col("blank"), "blank").when(~new, "old").when(F.col("cut"), "cut").otherwise("whole")
    marked = stage(counted.join(firsts, ["k", "digest"]).withColumn("kind", kind).drop("first"), "marked")
    total = lambda condition, n: F.sum(F.when(condition, n).otherwise(0)).cast("long")
    copies = F.when(F.col("kind") == "old", F.col("n")).otherwise(F.col("n") - 1)
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    stats = marked.groupBy("k").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), total(F.col("kind") == "blank", F.col("n")).alias("blank"),
        total(F.col("kind") != "blank", copies).alias("duplicate"), total(F.col("kind") == "cut", F.lit(1)).alias("truncated"),
        F.count("*").alias("entries"),
    )
    stats = stage(stats, "stats")
    symbol = F.when(F.col("kind").isin("blank", "old"), "d").when(F.col("kind") == "cut", F.upper("initial")).otherwise(F.col("initial"))
    order, tasks = ["k", "turn", "role", "digest"], int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = marked.join(stats.select("k", "entries"), "k").withColumn("symbol", symbol).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    parts = stage(segments(laid.select("k", "turn", "digest", "n", "initial", "symbol", "entries")), "segments")
    chosen = parts.join(choices(parts.filter("NOT whole")), ["k", "place"], "left")
    solved = stage(edits(chosen), "edits")

    whole = F.array_sort(F.collect_list(F.struct("place", "audit")))
    audits = solved.groupBy("k").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_join(F.transform(whole, lambda x: x["audit"]), "").alias("audit"))
    reports = df.select(key.alias("k"), F.col(conv_id).alias("conv_id")).distinct().join(stats, "k", "left").join(audits, "k", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    reports = reports.select("k", "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"))

    pieces = solved.select("k", "place", F.inline("pieces")).withColumn("at_turn", F.coalesce(F.col("turn").cast("string"), F.lit(""))).drop("turn")
    texts = rows.withColumn("at_turn", F.coalesce(F.col("turn").cast("string"), F.lit(""))).select("k", "conv_id", "at_turn", "digest", "role", "text")
    texts = texts.dropDuplicates(["k", "at_turn", "digest"]).withColumnRenamed("role", "own_role")
    joined = pieces.join(texts, ["k", "at_turn", "digest"]).select("k", "conv_id", "place", "seq", "own_role", "text", F.posexplode("turns").alias("at", "one"))
    said = F.when(F.col("one.own"), F.col("text")).otherwise("")
    turns = joined.select("k", "conv_id", "place", "seq", "at", F.coalesce("one.role", "own_role").alias("role"), said.alias("text"))
    return reports, turns


def joined_digests(turns: DataFrame) -> DataFrame:
    """``k, repaired_sha256`` of ``role:text``, joined by line feeds; texts stream through, none are gathered."""
    schema = StructType([StructField("k", StringType()), StructField("repaired_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            current, digest = None, None
            for batch in batches:
                for k, role, text in zip(*(batch.column(c).to_pylist() for c in ("k", "role", "text"))):
                    if k != current:
                        if digest is not None:
                            yield {"k": current, "repaired_sha256": digest.hexdigest()}
                        current, digest = k, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(role.encode() + b":" + text.encode())
            if digest is not None:
                yield {"k": current, "repaired_sha256": digest.hexdigest()}

        return _batches(made(), schema)

    laid = turns.repartition("k").sortWithinPartitions("k", "place", "seq", "at").select("k", "role", "text")
    return laid.mapInArrow(run, schema)
