"""From id arrays to fixed-length model rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.functions.arrays import (
    IGNORE,
    empty_ids,
    mask_labels,
    pad_ids,
    pad_mask,
    put_after_pads,
    put_front,
    repeat,
    truncate_ids,
)
from textmill.operators.vocab import BOS, EOS, UNK


@dataclass(frozen=True)
class PackSettings:
    """How rows are packed.

    ``causal`` puts input and target in one row; ``seq2seq`` keeps the target as labels. ``padding`` is
    ``max_length``, ``longest`` (of the batch) or ``none``. ``prefix`` is ``front``, ``after_pad`` or None.
    """

    mode: str = "causal"
    predict: bool = False
    max_input: int = 512
    max_target: int = 30
    padding: str = "max_length"
    truncation: bool = True
    pad: int = UNK
    bos: int = BOS
    eos: int = EOS
    add_bos: bool = True
    add_eos: bool = True
    prefix: str | None = None
    n_prefix: int = 30
    prefix_id: int = 50256
    decoder_prefix: bool = False
    prefix_only: bool = False

    def __post_init__(self) -> None:
        if self.mode not in ("causal", "seq2seq"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.padding not in ("max_length", "longest", "none"):
            raise ValueError(f"unknown padding {self.padding!r}")
        if self.prefix not in (None, "front", "after_pad"):
            raise ValueError(f"unknown prefix {self.prefix!r}")
        if self.prefix == "after_pad" and not (self.mode == "causal" and self.predict):
            raise ValueError("prefix='after_pad' needs left-padded rows: mode='causal', predict=True")

    @classmethod
    def whole_table(cls, **settings) -> PackSettings:
        """Defaults of the whole-table form: no begin token, an end token only in causal rows."""
        causal = settings.get("mode", "causal") == "causal"
        return cls(**{"add_bos": False, "add_eos": causal, **settings})

    @classmethod
    def per_item(cls, **settings) -> PackSettings:
        """Defaults of the per-item form: begin token before the input, end token after the target."""
        return cls(**{"add_bos": True, "add_eos": True, **settings})


def add_special(ids: Column, *, bos: int | None = None, eos: int | None = None) -> Column:
    """Put the begin id before and the end id after an id array."""
    parts = [ids]
    if bos is not None:
        parts.insert(0, repeat(bos, 1))
    if eos is not None:
        parts.append(repeat(eos, 1))
    return F.concat(*parts) if len(parts) > 1 else ids


def _batch_longest(df: DataFrame, columns: Sequence[str], batch: Sequence[str]) -> DataFrame:
    """Add ``<column>_longest``, the longest array of the row's batch.

    A window over the batch, so the rows cross one shuffle and are computed once; a window partition
    is a batch and never large.
    """
    inside = Window.partitionBy(*batch)
    return df.withColumns({f"{c}_longest": F.max(F.size(c)).over(inside) for c in columns})


def pack(
    df: DataFrame,
    settings: PackSettings | None = None,
    *,
    input_ids: str = "input_ids",
    target_ids: str = "target_ids",
    batch: Sequence[str] = ("rank", "batch_id"),
    **changes,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask``, ``labels`` and, on request, ``decoder_input_ids``.

    The encoded columns are replaced. A table without the target column, and every predict table, gets
    no labels. The work is array expressions only, except that ``padding="longest"`` needs the
    batches of :func:`textmill.operators.shard.batch_rows` and a shuffle by batch.
    """
    s = settings or PackSettings()
    s = replace(s, **changes) if changes else s
    labelled = target_ids in df.columns and not s.predict
    left_side = s.mode == "causal"

    source = F.col(input_ids)
    if labelled and left_side and s.prefix_only:
        source = empty_ids()
    else:
        source = add_special(source, bos=s.bos if s.add_bos else None)
        source = truncate_ids(source, s.max_input if s.truncation else None, "left" if left_side else "right")
    work = {"_in": source}
    if labelled:
        target = add_special(F.col(target_ids), eos=s.eos if s.add_eos else None)
        work["_out"] = truncate_ids(target, s.max_target if s.truncation else None, "right")
    df = df.withColumns(work).drop(input_ids, target_ids)

    in_length, out_length = {
        "max_length": (F.lit(s.max_input), F.lit(s.max_target)),
        "longest": (F.col("_in_longest"), F.col("_out_longest")),
        "none": (F.size("_in"), F.size("_out")),
    }[s.padding]
    if s.padding == "longest":
        df = _batch_longest(df, list(work), batch)
    if labelled and left_side and s.prefix_only:
        in_length = F.lit(0)

    if labelled and left_side:
        both = F.concat("_in", "_out")
        room = F.greatest(in_length, F.size("_in")) + F.greatest(out_length, F.size("_out"))
        ids = pad_ids(both, room, s.pad, "right")
        out = {
            "input_ids": ids,
            "attention_mask": pad_mask(both, room, "right"),
            "labels": mask_labels(ids, s.pad, F.size("_in")),
        }
    else:
        side = "left" if left_side else "right"
        out = {
            "input_ids": pad_ids(F.col("_in"), in_length, s.pad, side),
            "attention_mask": pad_mask(F.col("_in"), in_length, side),
        }
        if labelled:
            out["labels"] = mask_labels(pad_ids(F.col("_out"), out_length, s.pad, "right"), s.pad)

    if s.prefix == "front":
        fills = {"input_ids": s.prefix_id, "attention_mask": 1, "labels": IGNORE}
        out = {name: put_front(values, fills[name], s.n_prefix) for name, values in out.items()}
    elif s.prefix == "after_pad":
        mask = out["attention_mask"]
        out = {
            "input_ids": put_after_pads(out["input_ids"], mask, s.prefix_id, s.n_prefix),
            "attention_mask": put_after_pads(mask, mask, 1, s.n_prefix),
        }
    if s.decoder_prefix:
        out["decoder_input_ids"] = repeat(s.prefix_id, s.n_prefix)
    return df.withColumns(out).drop("_in", "_out", "_in_longest", "_out_longest")
