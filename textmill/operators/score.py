"""Scoring of predictions against targets."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType

from textmill.functions.workers import runs

BLEU_ORDER = 4
# A run of characters that are not white space to Python's str.split().
VISIBLE = r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

def mt_tokens(text: Column) -> Column:
    """Tokens by the public mteval-v13a rules, which corpus BLEU uses by default."""
    # Fixed rules of that tokenizer, applied in this order.
    for found, replacement in (
        ("<skipped>", ""), ("-\n", ""), ("\n", " "),
        ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
    ):
        text = F.replace(text, F.lit(found), F.lit(replacement))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in (
        (r"([!-&(-+:-@/\[-`{-~])", " $1 "),  # the rule's class has the space too, which changes no token
        (r"([^0-9])([\.,])", "$1 $2 "),
        (r"([\.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    return F.regexp_extract_all(text, F.lit(VISIBLE), F.lit(0))


def _matches(words: list[str], wanted: list[str]) -> list[int]:
    """The clipped matches of one pair, n = 1..4."""
    out = []
    for n in range(1, BLEU_ORDER + 1):
        found = Counter(zip(*(words[k:] for k in range(n))))
        there = Counter(zip(*(wanted[k:] for k in range(n))))
        out.append(sum(min(count, there[gram]) for gram, count in found.items() if gram in there))
    return out


@arrow_udf(ArrayType(LongType()))
def _row_counts(predictions: pa.Array, targets: pa.Array) -> pa.Array:
    """For each row the clipped matches, the possible n-grams and the target's n-grams, n = 1..4 each."""
    out = []
    for first, rows in runs(len(predictions), predictions.nbytes + targets.nbytes):
        pairs = zip(predictions.slice(first, rows).to_pylist(), targets.slice(first, rows).to_pylist())
        for words, wanted in pairs:
            sizes = [max(0, len(side) - n) for side in (words, wanted) for n in range(BLEU_ORDER)]
            out.append([*_matches(words, wanted), *sizes])
    return pa.array(out, pa.list_(pa.int64()))


def bleu_counts(
    df: DataFrame,
    tokenize: Callable[[Column], Column] = mt_tokens,
    *,
    prediction: str = "prediction",
    target: str = "target",
    row_id: str = "_row_id",
) -> DataFrame:
    """``(n, matches, possible, target_grams)`` for n = 1..4 over all rows.

    Texts are spread by row id once; the n-grams of a row are counted inside the row, so no n-gram is a row of a
    table, and a few sums for each partition move. A table without row ids is reduced to its distinct pairs
    with a weight first: equal pairs add equal counts, so the sums are the same, and a very frequent pair stays one row.
    """
    p, t = _texts(F.col(prediction), F.col(target))
    if row_id in df.columns:
        rows = df.select(F.col(row_id).alias("row"), p.alias("p"), t.alias("t"), F.lit(1).alias("weight"))
    else:
        pairs = df.groupBy(p.alias("p"), t.alias("t")).agg(F.count(F.lit(1)).alias("weight"))
        key = F.sha2(F.to_json(F.struct("p", "t")), 256)
        rows = pairs.select(key.alias("row"), "p", "t", "weight")
    # A fixed number of partitions: the n-grams need the parallelism, small as the texts may be.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "row").select(
        "weight", _row_counts(tokenize(F.col("p")), tokenize(F.col("t"))).alias("counts")
    )
    # A pair that stands for several rows counts that often on both sides, so the smaller count does too.
    sums = rows.agg(*(F.sum(F.col("counts")[k] * F.col("weight")).alias(f"s{k}") for k in range(3 * BLEU_ORDER)))
    names = ("matches", "possible", "target_grams")
    by_n = F.array(
        *(
            F.struct(F.lit(n).alias("n"), *(F.col(f"s{k * BLEU_ORDER + n - 1}").alias(name) for k, name in enumerate(names)))
            for n in range(1, BLEU_ORDER + 1)
        )
    )
    # No row for n-grams that no text has.
    return sums.select(F.inline(by_n)).filter("possible + target_grams > 0")


def _bleu_fields(m: dict[int, Column], c: dict[int, Column], ref: Column) -> list[tuple[str, Column]]:
    """The fields of corpus BLEU from matches and possible n-grams by n, and the targets' tokens, as doubles."""
    orders = range(1, BLEU_ORDER + 1)
    precisions = [F.when(c[n] > 0, m[n] / c[n]).otherwise(0.0) for n in orders]
    penalty = F.when(c[1] == 0, 0.0).when(c[1] > ref, 1.0).otherwise(F.exp(1.0 - ref / c[1]))
    geometric = F.exp(sum((F.log(p) for p in precisions), F.lit(0.0)) / BLEU_ORDER)
    return [
        ("bleu", F.when(F.least(*precisions) > 0, geometric * penalty).otherwise(0.0)),
        *((f"precision_{n}", p) for n, p in zip(orders, precisions)),
        ("brevity_penalty", penalty),
        ("length_ratio", F.when(ref > 0, c[1] / ref).otherwise(0.0)),
        ("translation_length", c[1]),
        ("reference_length", ref),
    ]


def bleu(df: DataFrame, tokenize: Callable[[Column], Column] = mt_tokens, **columns: str) -> DataFrame:
    """Corpus BLEU over n = 1..4 with clipped counts and brevity penalty, unsmoothed, as metric rows.

    Fields: ``bleu``, ``precision_1``..``precision_4``, ``brevity_penalty``, ``length_ratio``,
    ``translation_length``, ``reference_length``. An empty prediction side scores 0.
    """
    counts = bleu_counts(df, tokenize, **columns)
    at = lambda value, n: F.coalesce(F.sum(F.when(F.col("n") == n, F.col(value))), F.lit(0)).cast("double")
    orders = range(1, BLEU_ORDER + 1)
    wide = counts.agg(
        *(at("matches", n).alias(f"m{n}") for n in orders),
        *(at("possible", n).alias(f"c{n}") for n in orders),
        at("target_grams", 1).alias("ref"),
    )
    by_order = [{n: F.col(f"{side}{n}") for n in orders} for side in "mc"]
    return _long("bleu", wide, _bleu_fields(*by_order, F.col("ref")))


def _texts(prediction: Column, target: Column) -> tuple[Column, Column]:
    return F.coalesce(prediction, F.lit("")), F.coalesce(target, F.lit(""))


@dataclass(frozen=True)
class Metric:
    """A score with a state that Spark merges.

    ``update`` gives named values of one row, from its prediction and target; ``merge`` names for each
    the aggregate that combines it over rows and over partial states, as ``sum``, ``max`` or ``hll_sketch_agg``;
    ``finish`` turns the merged states into fields. Where a table is empty, ``finish`` sees nulls.
    """

    update: Callable[[Column, Column], dict[str, Column]]
    merge: dict[str, str]
    finish: Callable[[dict[str, Column]], Sequence[tuple[str, Column]]]


def bleu_metric(tokenize: Callable[[Column], Column] = mt_tokens) -> Metric:
    """Corpus BLEU: n-grams are counted inside the row, and nine sums per partition are what moves."""

    def update(prediction: Column, target: Column) -> dict[str, Column]:
        p, t = _texts(prediction, target)
        return {"counts": _row_counts(tokenize(p), tokenize(t))}

    def finish(state: dict[str, Column]) -> Sequence[tuple[str, Column]]:
        at = lambda k: F.coalesce(state[f"counts[{k}]"], F.lit(0)).cast("double")
        matches, possible = ({n: at(first + n) for n in range(1, BLEU_ORDER + 1)} for first in (-1, 3))
        return _bleu_fields(matches, possible, at(8))

    return Metric(update, {f"counts[{k}]": "sum" for k in range(2 * BLEU_ORDER + 1)}, finish)


EXACT_MATCH = Metric(
    lambda prediction, target: {"same": F.when(prediction == target, 1.0).otherwise(0.0)},
    {"same": "avg"},
    lambda state: [("exact_match", F.coalesce(state["same"], F.lit(0.0)))],
)


def exact_match(df: DataFrame, *, prediction: str = "prediction", target: str = "target") -> DataFrame:
    """Share of rows whose prediction equals the target; 0 for an empty table."""
    return _scored(df, {"exact_match": EXACT_MATCH}, prediction, target)


def _long(metric: str, wide: DataFrame, fields: Sequence[tuple[str, Column]]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(f).alias("field"), v.cast("double").alias("value")) for f, v in fields))
    return wide.select(F.lit(metric).alias("metric"), F.inline(rows))


_METRICS: dict[str, Metric | Callable[[DataFrame], DataFrame]] = {"bleu": bleu_metric(), "exact_match": EXACT_MATCH}


def register_metric(name: str, metric: Metric | Callable[[DataFrame], DataFrame]) -> None:
    """Add a named metric: a :class:`Metric`, or a function from the prediction table to ``(metric, field, value)`` rows.

    All metrics of the first kind share one pass over the table; a function reads it by itself.
    """
    _METRICS[name] = metric


def _scored(df: DataFrame, metrics: Mapping[str, Metric], prediction: str, target: str) -> DataFrame:
    """All of ``metrics`` from one scan and one aggregate with partial sums."""
    values, states, fields = [], [], []
    for place, (name, metric) in enumerate(metrics.items()):
        made = metric.update(F.col(prediction), F.col(target))
        values += [value.alias(f"_{place}_{key}") for key, value in made.items()]
        for key, how in metric.merge.items():
            base, _, rest = key.partition("[")
            value = F.col(f"`_{place}_{base}`")
            value = value.getItem(int(rest[:-1])) if rest else value
            states.append(F.call_function(how, value).alias(f"_{place}_{len(states)}"))
            fields.append((place, key, states[-1]))
    wide = df.select(*values).agg(*states)
    columns = iter(wide.columns)
    merged: dict[int, dict[str, Column]] = {}
    for place, key, _ in fields:
        merged.setdefault(place, {})[key] = F.col(f"`{next(columns)}`")
    rows = [
        F.struct(F.lit(name).alias("metric"), F.lit(field).alias("field"), value.cast("double").alias("value"))
        for place, (name, metric) in enumerate(metrics.items())
        for field, value in metric.finish(merged[place])
    ]
    return wide.select(F.inline(F.array(*rows)))


def score(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Compute the named metrics of ``prediction`` against ``target`` as ``(metric, field, value)``."""
    unknown = [m for m in metrics if m not in _METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; there are {sorted(_METRICS)}")
    mergeable = {m: _METRICS[m] for m in metrics if isinstance(_METRICS[m], Metric)}
    results = [_scored(df, mergeable, "prediction", "target")] if mergeable else []
    results += [_METRICS[m](df) for m in metrics if m not in mergeable]
    if not results:
        return df.sparkSession.createDataFrame([], "metric string, field string, value double")
    return reduce(DataFrame.unionByName, results)
