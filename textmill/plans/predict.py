"""Batch prediction to written predictions and metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from textmill.operators.predict import batch_predict, carry_columns, decode_output, merge_ranks, postprocess
from textmill.operators.score import score
from textmill.plans.settings import PrepareSettings
from textmill.sources.sinks import write_metrics, write_predictions


def predictions(
    rows: DataFrame,
    factory: Callable,
    vocab: DataFrame | None = None,
    *,
    decoder: Callable | None = None,
    postprocessor: str = "identity",
    strip_prompt: bool = True,
    settings: PrepareSettings | None = None,
    batch_size: int | None = None,
    regroup: bool = False,
    row_id: str = "_row_id",
) -> DataFrame:
    """Predict, decode, post-process, and keep the carried columns; lazy, and without a shuffle unless ``regroup`` asks for it.

    The model gets lists of ``batch_size`` rows, by default the loader's batch of the ``settings``, or else 8.
    """
    size = batch_size or (settings.batch_size if settings else 8)
    out = batch_predict(rows, factory, batch_size=size, regroup=regroup)
    out = decode_output(out, vocab, decoder=decoder, strip_prompt=strip_prompt, row_id=row_id)
    return carry_columns(postprocess(out, postprocessor))


def predict_and_score(
    rows: DataFrame,
    factory: Callable,
    vocab: DataFrame | None,
    folder: str,
    *,
    metrics: Sequence[str] = (),
    **options,
) -> dict[str, str]:
    """Write predictions by rank, merge them to one table, and score that table.

    The model runs once: merging and scoring read what was written. Returns the written folders.
    """
    spark = rows.sparkSession
    base = folder.rstrip("/")
    predicted = predictions(rows, factory, vocab, **options)
    by_rank = write_predictions(predicted, f"{base}/predictions_by_rank", by_rank=True)
    merged = merge_ranks(spark, by_rank, predicted.schema)
    written = {
        "by_rank": by_rank,
        "merged": write_predictions(merged, f"{base}/predictions"),
    }
    if metrics:
        results = score(spark.read.schema(predicted.schema).json(by_rank), metrics)
        written["metrics"] = write_metrics(results, f"{base}/metrics")
    return written
