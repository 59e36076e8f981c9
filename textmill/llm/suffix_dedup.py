"""Removal of long byte strings that occur elsewhere in the corpus, by sorting suffixes deep and shallow.

Only suffixes at anchors are sorted. The anchor of a window of ``length`` bytes is the place in it
whose ``gram`` bytes have the least hash, the leftmost of several; equal windows have their anchors
at the same offset. An anchor serves a run of windows, and together with their bytes it is a context.
Anchors whose gram occurs once serve no repeated window. Where all contexts of a gram are equal, every
window repeats. What is left are contexts that agree in part, each sent once however often it occurs.

The suffixes of a gram's contexts, and their prefixes read backwards, are ordered by multikey
quicksort to a shallow depth; groups that are still equal there, most of them with long common
prefixes, are ordered by blind tries, which compare each string with one other. A window repeats if
another context agrees with it far enough on both sides, which the common prefixes of neighbours in
both orders tell. A gram with very many different contexts is a hot key; its contexts are cut in two,
and windows of halves whose common bytes repeat are counted by hash, combined before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, ShortType, StringType, StructField, StructType

from textmill.llm.arrow import free_name, slices, texts_of, with_arrays, with_fields
from textmill.llm.hashing import mix, prefix_sums, span_hashes
from textmill.sources.staging import stage

SHALLOW = 32
HOT_CONTEXTS = 20_000
CHUNK = 1 << 20
WORD = 8
WHITE = b" \t\n\x0b\x0c\r"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings known to agree in their first ``start`` bytes."""
    stop = min(len(a), len(b))
    differ = int.from_bytes(a[start:stop], "big") ^ int.from_bytes(b[start:stop], "big")
    return stop - (differ.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes], group: list[int], depth: int) -> list[int]:
    """Order of strings that agree in their first ``depth`` bytes; equal strings stay in the order given.

    A node has the depth at which its branches part, and a branch for each byte there; bytes between
    are not stored. A new string walks down blindly, is compared with the leaf it reaches, and so
    learns at which depth it parts from the trie. The end of a string comes before every byte.
    """
    root: list | None = None  # a leaf is a list of indices; a node is a pair of depth and branches

    def symbol(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    for index in group:
        text = strings[index]
        if root is None:
            root = [index]
            continue
        node = root
        while isinstance(node, tuple):
            branches = node[1]
            node = branches.get(symbol(text, node[0])) or next(iter(branches.values()))
        other = strings[node[0]]
        parted = shared_prefix(text, other, depth)
        if parted == len(text) == len(other):
            node.append(index)
            continue
        above, node = None, root
        while isinstance(node, tuple) and node[0] < parted:
            above, node = node, node[1][symbol(text, node[0])]
        if isinstance(node, tuple) and node[0] == parted:
            node[1][symbol(text, parted)] = [index]
            continue
        made = (parted, {symbol(other, parted): node, symbol(text, parted): [index]})
        if above is None:
            root = made
        else:
            above[1][symbol(text, above[0])] = made
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, tuple):
            waiting += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            out += node
    return out


def suffix_order(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Order of strings that agree in their first ``depth`` bytes: multikey quicksort, then blind tries."""
    out, waiting = [], [(list(range(len(strings))), depth)]
    while waiting:
        group, at = waiting.pop()
        if len(group) == 1:
            out += group
        elif at >= depth + shallow:
            out += blind_trie_order(strings, group, depth)
        else:
            words = [int.from_bytes(strings[i][at : at + WORD].ljust(WORD, b"\0"), "big") for i in group]
            pivot = sorted(words)[len(words) // 2]
            more = [i for i, w in zip(group, words) if w > pivot]
            same = [i for i, w in zip(group, words) if w == pivot]
            less = [i for i, w in zip(group, words) if w < pivot]
            waiting += [(g, a) for g, a in ((more, at), (same, at + WORD), (less, at)) if g]
    return out


def order_and_prefixes(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and the common prefix of each one in it with the one before it."""
    order = suffix_order(strings, depth)
    shared = [shared_prefix(strings[a], strings[b], depth) for a, b in zip(order, order[1:])]
    return np.array(order), np.array([0, *shared])


def repeated_offsets(
    contexts: list[tuple[bytes, int, list[tuple[int, int]]]], lengths: list[int], gram: int
) -> Iterator[tuple[int, int, int, int]]:
    """``(context, number of the length, first, last)``: offsets of the anchor in windows that another context has too.

    A context is its bytes, the place of the anchor in them, and for each length the least and greatest
    offset of the anchor in its windows. The sorted orders serve all lengths.
    """
    right = [c[at:] for c, at, _ in contexts]
    left = [c[at - 1 :: -1] if at else b"" for c, at, _ in contexts]
    if len(contexts) == 2:
        after, before = shared_prefix(right[0], right[1], gram), shared_prefix(left[0], left[1])
        for size, (length, *ranges) in enumerate(zip(lengths, *(c[2] for c in contexts))):
            first = max(length - after, *(low for low, _ in ranges))
            last = min(before, *(high for _, high in ranges))
            if first <= last:
                yield 0, size, first, last
                yield 1, size, first, last
        return
    orders = [order_and_prefixes(right, gram), order_and_prefixes(left, 0)]
    for size, length in enumerate(lengths):
        lows, highs = (np.array([c[2][size][k] for c in contexts]) for k in (0, 1))
        if (lows <= highs).sum() > 1:
            for i, first, last in _offsets_of_length(orders, lows, highs, length):
                yield i, size, first, last


def _offsets_of_length(
    orders: list[tuple[np.ndarray, np.ndarray]], lows: np.ndarray, highs: np.ndarray, length: int
) -> Iterator[tuple[int, int, int]]:
    n = len(lows)
    # Between these offsets neither the sets of equal windows nor the contexts that have one change.
    turns = np.unique(np.concatenate([length - orders[0][1][1:], orders[1][1][1:] + 1, lows, highs + 1]))
    turns = turns[(turns >= lows.min()) & (turns <= highs.max() + 1)]
    starts, stops = turns[:-1], turns[1:] - 1
    step = max(1, (1 << 20) // n)
    before = np.zeros(n, dtype=bool)
    opened = np.zeros(n, dtype=np.int64)
    for at in range(0, len(starts), step):
        some = starts[at : at + step]
        codes = np.zeros((len(some), n), dtype=np.int64)
        for (order, shared), needed in zip(orders, (length - some, some)):
            kinds = np.cumsum(shared[None, :] < needed[:, None], axis=1)
            codes *= n + 1
            codes[:, order] += kinds
        codes += np.arange(len(some))[:, None] * (n + 1) ** 2
        serves = (lows[None, :] <= some[:, None]) & (some[:, None] <= highs[None, :])
        _, inverse, counts = np.unique(codes[serves], return_inverse=True, return_counts=True)
        marked = np.zeros(codes.shape, dtype=bool)
        marked[serves] = counts[inverse] > 1
        for row, first in zip(marked, some.tolist()):
            for i in np.flatnonzero(before & ~row).tolist():
                yield i, int(opened[i]), first - 1
            opened[row & ~before] = first
            before = row
    for i in np.flatnonzero(before).tolist():
        yield i, int(opened[i]), int(stops[-1])


def anchors(data: np.ndarray, lengths: list[int], gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For parts of a text: hash of each anchor's gram, hash of its context, its place, and for each length its least and greatest offset.

    ``lengths`` ascend. An anchor without windows of a length has that length and -1 as its offsets there.
    """
    place = np.uint64((1 << 24) - 1)
    for at in range(0, len(data) - lengths[0] + 1, CHUNK):
        part = data[at : at + CHUNK + lengths[-1] - 1]
        sums = prefix_sums(part)
        starts = np.arange(len(part) - gram + 1)
        hashes = span_hashes(sums, starts, starts + gram)
        least, span = (hashes & ~place) | starts.astype(np.uint64), 1
        served = []
        for length in lengths:
            width = length - gram + 1
            if len(part) < length:
                break
            while 2 * span <= width:
                least, span = np.minimum(least[:-span], least[span:]), 2 * span
            wide = np.minimum(least[: -(width - span)], least[width - span :]) if span < width else least
            best = (wide[:CHUNK] & place).astype(np.int64)
            turns = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1], [True]]))
            served.append((best[turns[:-1]], turns[:-1], turns[1:] - 1))
        places = served[0][0] if len(lengths) == 1 else np.unique(np.concatenate([anchor for anchor, _, _ in served]))
        sums, context, offsets = prefix_sums(part, 1), np.zeros(len(places), np.uint64), []
        for number, length in enumerate(lengths):
            low, high = np.full(len(places), length), np.full(len(places), -1)
            begin, end = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
            if number < len(served):
                anchor, first, last = served[number]
                rows = np.searchsorted(places, anchor)
                low[rows], high[rows], begin[rows], end[rows] = anchor - last, anchor - first, first, last + length
            context = mix(context + span_hashes(sums, begin, end) + (low * 4099 + high).astype(np.uint64))
            offsets += [low, high]
        yield hashes[places], context, places + at, *offsets


RUN = StructType([StructField("id", LongType()), StructField("mark", LongType()), StructField("size", ShortType()), StructField("first", LongType()), StructField("last", LongType())])
RUN_KINDS = (pa.int64(), pa.int64(), pa.int16(), pa.int64(), pa.int64())


def offset_names(lengths: list[int]) -> list[str]:
    return [f"{end}{number}" for number in range(len(lengths)) for end in ("low", "high")]


def anchor_schema(lengths: list[int]) -> StructType:
    whole = [StructField(name, LongType()) for name in ("gram", "context", "id", "mark", "place")]
    return StructType(whole + [StructField(name, ShortType()) for name in offset_names(lengths)])


def anchor_rows(docs: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    schema = anchor_schema(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns: list[list] = [[] for _ in schema.names]
                for key, mark, text in zip(part.column("id").to_pylist(), part.column("mark").to_pylist(), texts_of(part.column("text"))):
                    for grams, contexts, places, *offsets in anchors(np.frombuffer(text.encode(), np.uint8), lengths, gram):
                        n = len(grams)
                        made = (grams.view(np.int64), contexts.view(np.int64), np.full(n, key, np.int64))
                        made += (np.full(n, mark, np.int64), places, *(o.astype(np.int16) for o in offsets))
                        for column, values in zip(columns, made):
                            column.append(values)
                if columns[0]:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def context_rows(rows: DataFrame, names: tuple[str, str, str, str], lengths: list[int]) -> DataFrame:
    """The bytes of each context that a row lists, with the anchor's place in them; ``names`` are id, mark, text and list."""
    fields = [f for f in anchor_schema(lengths).fields if f.name != "context"]
    schema = StructType([*fields, StructField("at", ShortType()), StructField("bytes", BinaryType())])
    offsets = offset_names(lengths)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), *(pa.int16() for _ in offsets), pa.int16(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1 << 20):
                made = []
                for key, mark, text, wanted in zip(*(part.column(c).to_pylist() for c in names)):
                    data = (text or "").encode()
                    for w in wanted:
                        ranges = [w[o] for o in offsets]
                        at = max(ranges[1::2])
                        stop = w["place"] + max(length - low for length, low in zip(lengths, ranges[::2]))
                        made.append((w["gram"], key, mark, w["place"], *ranges, at, data[w["place"] - at : stop]))
                if made:
                    yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*made), kinds)], names=schema.names)

    return rows.mapInArrow(run, schema)


def sorted_runs(contexts: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Runs of window starts that repeat among the contexts of a gram; a gram's contexts meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, out = None, [], []

        def close() -> None:
            if len(group) > 1:
                for i, size, first, last in repeated_offsets([g[3:] for g in group], lengths, gram):
                    key, mark, place = group[i][:3]
                    out.append((key, mark, size, place - last, place - first))

        for batch in batches:
            for g, key, mark, place, *offsets, at, data in zip(*(c.to_pylist() for c in batch.columns)):
                if g != current:
                    close()
                    current, group = g, []
                    if len(out) > 20_000:
                        yield _runs(out)
                        out = []
                group.append((key, mark, place, data, at, list(zip(offsets[::2], offsets[1::2]))))
        close()
        if out:
            yield _runs(out)

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, RUN)


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), RUN_KINDS)], names=RUN.names)


def context_halves(contexts: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Contexts cut in two for each length, with two hashes of the bytes that all windows of the half hold.

    Windows in which the anchor stands early hold much of what follows it, the others of what precedes it.
    """
    whole = ("h1", "h2", "id", "mark", "place")
    short = ("size", "low", "high")
    fields = [StructField(n, LongType()) for n in whole] + [StructField(n, ShortType()) for n in short]
    schema = StructType([*fields, StructField("bytes", BinaryType())])
    kinds = (*(pa.int64() for _ in whole), *(pa.int16() for _ in short), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1 << 20):
                made = []
                for _, key, mark, place, *offsets, at, data in zip(*(c.to_pylist() for c in part.columns)):
                    sums = [prefix_sums(np.frombuffer(data, np.uint8), seed) for seed in (2, 3)]
                    for size, (length, low, high) in enumerate(zip(lengths, offsets[::2], offsets[1::2])):
                        middle = (length - gram) // 2
                        early = low, min(high, middle), at, at + length - middle
                        late = max(low, middle + 1), high, at - middle - 1, at + gram
                        for first, last, start, stop in (early, late):
                            if first <= last:
                                held = [int(span_hashes(s, np.array([start]), np.array([stop])).view(np.int64)[0]) for s in sums]
                                made.append((*held, key, mark, place, size, first, last, data[at - last : at - first + length]))
                if made:
                    yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*made), kinds)], names=schema.names)

    return contexts.mapInArrow(run, schema)


def counted_runs(contexts: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """The same for grams with very many contexts: windows by two 64-bit hashes, counted before the shuffle.

    Only windows of halves whose common bytes repeat are made.
    """
    schema = StructType([StructField("h1", LongType()), StructField("h2", LongType()), *(f for f in RUN.fields if f.name != "last")])
    columns = ("id", "mark", "place", "size", "low", "high", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, mark, place, size, low, high, data in zip(*(batch.column(c).to_pylist() for c in columns)):
                part = np.frombuffer(data, np.uint8)
                starts = np.arange(high - low + 1)
                n = len(starts)
                made = [span_hashes(prefix_sums(part, seed), starts, starts + lengths[size]).view(np.int64) for seed in (2, 3)]
                made += [np.full(n, key, np.int64), np.full(n, mark, np.int64), np.full(n, size, np.int16), starts + (place - high)]
                yield pa.record_batch([pa.array(c) for c in made], names=schema.names)

    def again(df: DataFrame) -> DataFrame:
        hashes = ["size", "h1", "h2"]
        return df.join(df.groupBy(hashes).count().filter("count > 1").drop("count"), hashes)

    windows = again(context_halves(contexts, lengths, gram)).mapInArrow(run, schema)
    return again(windows).select("id", "mark", "size", "first", F.col("first").alias("last"))


def merged_spans(runs: list[dict], length: int) -> np.ndarray:
    """Maximal byte spans, as rows of start and end, covered by windows that start in the runs."""
    if not runs:
        return np.empty((0, 2), dtype=np.int64)
    spans = np.array(sorted((r["first"], r["last"] + length) for r in runs), dtype=np.int64)
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([spans[first, 0], reach[last]], axis=1)


def whole_words(data: bytes, start: int, stop: int) -> int:
    """Words of which every byte lies in the span; words are runs without ASCII white space."""
    while 0 < start < stop and data[start] not in WHITE and data[start - 1] not in WHITE:
        start += 1
    while start < stop < len(data) and data[stop] not in WHITE and data[stop - 1] not in WHITE:
        stop -= 1
    return len(WORDS.findall(data, start, stop))


def repeated_runs(rows: DataFrame, names: tuple[str, str, str], lengths: list[int], gram: int, hot: int = HOT_CONTEXTS) -> DataFrame:
    """``id, mark, size, first, last``: every start of a repeated window of ``lengths[size]`` bytes lies in a run.

    ``names`` are the columns of ``rows`` with id, mark and text.
    """
    id_, mark, text = names
    docs = rows.select(F.col(id_).alias("id"), F.col(mark).alias("mark"), F.col(text).cast("string").alias("text"))
    found = stage(anchor_rows(docs, lengths, gram), "anchors")
    groups = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("c1"), F.max("context").alias("c2"))
    # Written, so that both sides of the join are dealt for it alone and a skewed gram can be split.
    groups = stage(groups.filter("n > 1").select("gram", (F.col("c1") == F.col("c2")).alias("equal")), "groups")
    repeated = stage(found.join(groups, "gram"), "repeated")
    offsets = offset_names(lengths)

    def runs(anchors: DataFrame) -> DataFrame:
        ends = [(F.col("place") - F.col(f"high{k}"), F.col("place") - F.col(f"low{k}")) for k in range(len(lengths))]
        each = [F.struct(F.lit(k).cast("short").alias("size"), a.alias("first"), b.alias("last")) for k, (a, b) in enumerate(ends)]
        return anchors.select("id", "mark", F.inline(F.array(*each))).filter("first <= last")

    partly = repeated.filter("NOT equal")
    one = F.min(F.struct("id", "mark", "place", *offsets)).alias("one")
    kinds = stage(partly.groupBy("gram", "context").agg(F.count("*").alias("n"), one), "kinds")
    whole = runs(repeated.filter("equal"))
    copies = runs(partly.join(kinds.filter("n > 1").select("gram", "context"), ["gram", "context"]))
    crowds = stage(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > hot).select("gram"), "hot")
    list_ = free_name("_wanted", rows)

    def contexts(chosen: DataFrame) -> DataFrame:
        wanted = chosen.select(F.struct("gram", "one.place", *(f"one.{o}" for o in offsets)).alias("w"), "one.id", "one.mark")
        lists = wanted.groupBy(F.col("id").alias(id_), F.col("mark").alias(mark)).agg(F.collect_list("w").alias(list_))
        # All columns of ``rows`` are kept, so that the caller's join with the runs takes its rows from the same shuffle.
        return context_rows(rows.join(lists, [id_, mark]), (id_, mark, text, list_), lengths)

    marked = whole.unionByName(copies)
    if crowds.isEmpty():
        return marked.unionByName(sorted_runs(contexts(kinds), lengths, gram))
    few, many = (contexts(kinds.join(crowds, "gram", how)) for how in ("left_anti", "left_semi"))
    return marked.unionByName(sorted_runs(few, lengths, gram)).unionByName(counted_runs(many, lengths, gram))


def remove_repeats(
    df: DataFrame, length: int = 400, gram: int = 128, row_id: str = "doc_id", text: str = "text", hot: int = HOT_CONTEXTS,
    least_words: int = 0, passages: tuple[int, int] | None = None,
) -> DataFrame:
    """``df`` with ``kept`` (bytes), ``kept_text``, ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed spans).

    ``kept_text`` is ``kept`` without the bytes of characters of which only a part is left.

    Every byte goes that a ``length``-byte string covers which starts anywhere else too, in the same
    text or another, judged on the texts as given; matches never cross texts. Of the maximal spans of
    such bytes those with fewer than ``least_words`` whole words stay. ``row_id`` must be a whole
    number; rows are told apart by it and a 64-bit hash of the text, a null id as -1. A null text is
    empty; texts shorter than ``length`` stay whole. Repeated rows are copies of each other. Columns
    of these names are replaced; all others stay.

    ``passages``, a length and a least number of words, adds ``cut_text`` and ``n_passages``: what the
    same rule leaves of the whole text by that second length, and how many spans it cuts. Both lengths
    share the anchors, the sorting and the shuffles; neither may be less than ``gram``.

    Anchors, one for about ``(length - gram) / 2`` bytes of the smallest length, are the only rows that
    grow with the whole text; of contexts, only those that agree in part are sent. The text is shuffled
    once, by row id.
    """
    names = ["kept", "kept_text", "n_bytes", "n_removed", "n_spans"]
    kinds = [BinaryType(), StringType(), LongType(), LongType(), LongType()]
    rules = [(length, least_words)]
    if passages:
        names, kinds, rules = [*names, "cut_text", "n_passages"], [*kinds, StringType(), LongType()], [*rules, passages]
    lengths = sorted({n for n, _ in rules})
    sizes = [lengths.index(n) for n, _ in rules]
    key = F.coalesce(F.col(row_id).cast("long"), F.lit(-1))
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    id_, mark, spans_ = (free_name(n, df) for n in ("_id", "_mark", "_runs"))
    rows = df.withColumns({id_: key, mark: F.xxhash64(value)})
    runs = repeated_runs(rows, (id_, mark, text), lengths, gram, hot)
    runs = runs.groupBy(F.col("id").alias(id_), F.col("mark").alias(mark)).agg(F.collect_list(F.struct("size", "first", "last")).alias(spans_))
    joined = rows.join(runs, [id_, mark], "left").drop(id_, mark)
    fields = [StructField(n, k, False) for n, k in zip(names, kinds)]
    schema = with_fields(df.schema, *fields)
    types = [{BinaryType: pa.binary(), StringType: pa.string(), LongType: pa.int64()}[type(k)] for k in kinds]

    def kept_by(rule: tuple[int, int], size: int, data: bytes, found: list[dict]) -> tuple[bytes, int]:
        spans = merged_spans([r for r in found if r["size"] == size], rule[0])
        if rule[1] and len(spans):
            spans = spans[[whole_words(data, a, b) >= rule[1] for a, b in spans.tolist()]]
        edges = [0, *spans.ravel().tolist(), len(data)]
        return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), len(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = []
                for value, found in zip(texts_of(part.column(text)), part.column(spans_).to_pylist()):
                    data = value.encode()
                    (kept, n_spans), *more = (kept_by(rule, size, data, found or []) for rule, size in zip(rules, sizes))
                    row = (kept, kept.decode("utf-8", "ignore"), len(data), len(data) - len(kept), n_spans)
                    made.append(row + tuple(v for cut, n in more for v in (cut.decode("utf-8", "ignore"), n)))
                arrays = [pa.array(v, t) for v, t in zip(zip(*made), types)]
                yield with_arrays(part, names, arrays).select(schema.names)

    return joined.mapInArrow(run, schema)
