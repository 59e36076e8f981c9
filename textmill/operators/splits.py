"""Split naming and split sizing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from textmill.functions.keys import required
from textmill.operators.ranks import first_rows, rank_cut, sampled_rows

# The names under which a dev split may arrive, in the order they are looked up.
DEV_ALIASES = ("validation", "val", "eval", "development", "evaluation", "validate", "evaluate")

Splits = dict[str, DataFrame]


def alias_dev(splits: Mapping[str, DataFrame]) -> Splits:
    """Call the dev split ``dev``; of several aliases the last in ``DEV_ALIASES`` wins."""
    present = [name for name in DEV_ALIASES if name in splits]
    out = {name: df for name, df in splits.items() if name not in DEV_ALIASES}
    if present:
        out["dev"] = splits[present[-1]]
    return out


def move_to_predict(splits: Mapping[str, DataFrame], source: str) -> Splits:
    """Make split ``source`` the ``predict`` split; ``source`` disappears."""
    if source not in splits:
        raise ValueError(f"predict split {source!r} is missing; there are {list(splits)}")
    out = {name: df for name, df in splits.items() if name not in (source, "predict")}
    out["predict"] = splits[source]
    return out


def rename_splits(splits: Mapping[str, DataFrame], predict_split: str | None = None) -> Splits:
    """Dev aliases first, then the move to ``predict``."""
    renamed = alias_dev(splits)
    return move_to_predict(renamed, predict_split) if predict_split else renamed


def alias_dev_column(df: DataFrame, column: str = "split") -> DataFrame:
    """:func:`alias_dev` on one table with a split column; rows of losing aliases are dropped.

    Which aliases exist is decided by a scalar subquery, so the table is not collected.
    """
    order = {name: i for i, name in enumerate(("dev", *DEV_ALIASES))}
    place = F.coalesce(*(F.when(F.col(column) == name, i) for name, i in order.items()))
    winner = df.agg(F.max(place)).scalar()
    named = F.when(place.isNotNull(), F.lit("dev")).otherwise(F.col(column))
    return df.filter(place.isNull() | (place == winner)).withColumn(column, named)


def move_to_predict_column(df: DataFrame, source: str, column: str = "split") -> DataFrame:
    """:func:`move_to_predict` on one table with a split column; the earlier ``predict`` rows go."""
    if source != "predict":
        df = df.filter(F.col(column) != "predict")
    return df.withColumn(column, F.when(F.col(column) == source, "predict").otherwise(F.col(column)))


def stack_splits(splits: Mapping[str, DataFrame], column: str = "split") -> DataFrame:
    """All splits as one table with the split name in a column."""
    parts = [df.withColumn(column, F.lit(name)) for name, df in splits.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def resolve_dev_size(train: DataFrame, dev_size: int | float | None) -> int | None:
    """Rows in ``dev``: a float up to 1.0 is a share of ``train`` (one count), an int is a number."""
    if isinstance(dev_size, float) and dev_size <= 1.0:
        return int(train.count() * dev_size)
    if dev_size is None or dev_size < 0:
        return None
    return int(dev_size)


def dev_head(dev: DataFrame, n: int, row_id: str = "_row_id") -> DataFrame:
    """The first ``n`` rows of ``dev`` in row order; all of them if there are fewer."""
    return dev.filter(first_rows(dev, n, row_id))


def dev_from_train(train: DataFrame, n: int, row_id: str = "_row_id") -> Splits:
    """The last ``n`` rows of ``train`` as ``dev`` and ``test``, the rest as ``train``.

    Both parts are filters on one row-id bound, so neither moves a row.
    """
    last = rank_cut(train, -required(row_id), [], n)
    tail = train.filter(last)
    return {"train": train.filter(~last), "test": tail, "dev": tail}


def sample_split(df: DataFrame, n: int, seed: str | int = 42, row_id: str = "_row_id") -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer), repeatable by seed."""
    return df.filter(sampled_rows(df, n, seed, row_id))


def tiny_splits(
    splits: Mapping[str, DataFrame], n: int = 1024, seed: str | int = 42, row_id: str = "_row_id"
) -> Splits:
    """Every split becomes a sample of ``train``; after ``train`` itself, of the small one.

    Each split draws with its own seed, ``seed:split``.
    """
    out = dict(splits)
    for name in splits:
        out[name] = sample_split(out["train"], n, f"{seed}:{name}", row_id)
    return out


def make_splits(
    splits: Mapping[str, DataFrame],
    *,
    dev_size: int | float | None = None,
    dev_from_train_rows: bool = False,
    tiny: bool = False,
    tiny_size: int = 1024,
    shots: int | None = None,
    overfit: bool = False,
    predict_size: int | None = None,
    seed: str | int = 42,
    row_id: str = "_row_id",
) -> Splits:
    """Size the splits: predict sample, then dev, then tiny or shots, then overfit.

    Without ``train`` only the predict sample applies. A missing ``dev_size`` keeps ``dev`` whole.
    """
    out = dict(splits)
    if "predict" in out and predict_size is not None and predict_size > 0:
        out["predict"] = sample_split(out["predict"], predict_size, f"{seed}:predict", row_id)
    if "train" not in out:
        return out

    rows = resolve_dev_size(out["train"], dev_size) if "dev" in out or dev_from_train_rows else None
    if dev_from_train_rows:
        if rows is None:
            raise ValueError("taking dev from train needs dev_size")
        out = dev_from_train(out["train"], rows, row_id)
    elif "dev" in out and rows is not None:
        out["dev"] = dev_head(out["dev"], rows, row_id)

    if tiny:
        out = tiny_splits(out, tiny_size, seed, row_id)
    elif shots is not None and shots > 0:
        out["train"] = sample_split(out["train"], shots, seed, row_id)

    if overfit:
        out["dev"] = out["train"]
    return out
