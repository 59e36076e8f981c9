"""Queries that write a table, read it back and return what came back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import SQL_PAIRS, pairs, split_frames, SQL_SPLITS, table
from textmill.operators.predict import merge_ranks
from textmill.operators.score import score
from textmill.operators.shard import batch_rows, epoch_order, shard_rows
from textmill.operators.splits import stack_splits
from textmill.sources.readers import read_splits, with_row_id
from textmill.sources.sinks import write_metrics, write_predictions
from textmill.sources.staging import fresh_folder, materialize

TURNS = "SELECT conv_id, turn, role, text FROM conversations"
TURN_SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROWS_PER_OBJECT = 1000


@query("src_csv", TURNS)
def q_src_csv(spark, sf_dir):
    folder = fresh_folder(spark, "csv")
    table(spark, sf_dir, "conversations").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return read_splits(spark, {"train": folder}, schema=TURN_SCHEMA)["train"].drop("_row_id")


@query("src_csv_split", "SELECT conv_id, turn, role, replace(text, ' ', ' \"' || chr(10)) AS text FROM conversations")
def q_src_csv_split(spark, sf_dir):
    folder = fresh_folder(spark, "csv")
    # Every space is followed by a quote and a line break, so blocks begin inside quotes.
    broken = F.replace("text", F.lit(" "), F.lit(' "\n'))
    table(spark, sf_dir, "conversations").withColumn("text", broken).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return read_splits(spark, {"train": folder}, schema=TURN_SCHEMA, split_files=True)["train"].drop("_row_id")


@query("src_json_columns", TURNS)
def q_src_json_columns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    objects = math.ceil(turns.count() / ROWS_PER_OBJECT)
    bucket = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(objects)).alias("bucket")
    grouped = turns.groupBy(bucket).agg(F.collect_list(F.struct(*turns.columns)).alias("rows"))
    columns = F.struct(*(F.col(f"rows.{c}").alias(c) for c in turns.columns))
    folder = fresh_folder(spark, "json")
    grouped.select("bucket", F.to_json(columns).alias("value")).write.partitionBy("bucket").text(folder)
    return read_splits(spark, {"train": folder}, schema=TURN_SCHEMA)["train"].drop("_row_id")


@query("src_json_lines", TURNS)
def q_src_json_lines(spark, sf_dir):
    folder = fresh_folder(spark, "turns.jsonl")
    table(spark, sf_dir, "conversations").write.json(folder)
    return read_splits(spark, {"train": folder}, schema=TURN_SCHEMA)["train"].drop("_row_id")


@query("src_row_ids", "SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS _row_id FROM events")
def q_src_row_ids(spark, sf_dir):
    # The events file is in the order of its ids.
    return with_row_id(table(spark, sf_dir, "events").select("event_id", "event_type"))


def ranked_predictions(spark, sf_dir):
    """Pairs dealt to three ranks; the prediction repeats the question."""
    placed = epoch_order(pairs(spark, sf_dir), shuffle=False)
    dealt = batch_rows(shard_rows(placed, 3), 4)
    return dealt.select(
        F.col("question").alias("prediction"), F.col("answer").alias("target"), "_row_id", "rank", "batch_id", "pos"
    )


SQL_RANKED = f"""{SQL_PAIRS},
placed AS (SELECT *, row_number() OVER (ORDER BY _row_id) - 1 AS idx FROM pairs),
ranked AS (
  SELECT question AS prediction, answer AS target, _row_id, CAST(idx % 3 AS INTEGER) AS rank,
    idx // 3 // 4 AS batch_id, idx // 3 AS pos FROM placed)"""


@query("sink_rank_json", f"WITH {SQL_RANKED} SELECT prediction, target, _row_id, rank, batch_id, pos FROM ranked")
def q_sink_rank_json(spark, sf_dir):
    df = ranked_predictions(spark, sf_dir)
    folder = write_predictions(df, fresh_folder(spark, "by_rank"), by_rank=True)
    return spark.read.schema(df.schema).json(folder).select(df.columns)


@query("merge_ranks", f"WITH {SQL_RANKED} SELECT prediction, target, _row_id, rank, batch_id, pos FROM ranked")
def q_merge_ranks(spark, sf_dir):
    df = ranked_predictions(spark, sf_dir)
    folder = write_predictions(df, fresh_folder(spark, "by_rank"), by_rank=True)
    return merge_ranks(spark, folder, df.schema).select(df.columns)


@query("sink_predictions", f"WITH {SQL_RANKED} SELECT prediction, target, _row_id, rank, batch_id, pos FROM ranked")
def q_sink_predictions(spark, sf_dir):
    df = ranked_predictions(spark, sf_dir)
    folder = write_predictions(df, fresh_folder(spark, "predictions"), format="parquet")
    return spark.read.schema(df.schema).parquet(folder)


@query(
    "sink_metrics",
    f"""WITH {SQL_PAIRS} SELECT 'exact_match' AS metric, 'exact_match' AS field,
  avg(CASE WHEN length(question) < length(answer) THEN 1.0 ELSE 0.0 END) AS value FROM pairs""",
)
def q_sink_metrics(spark, sf_dir):
    shorter = F.when(F.length("question") < F.length("answer"), "yes").otherwise("no")
    df = pairs(spark, sf_dir).select(shorter.alias("prediction"), F.lit("yes").alias("target"))
    folder = write_metrics(score(df, ["exact_match"]), fresh_folder(spark, "metrics"))
    return spark.read.schema("metric string, field string, value double").json(folder)


@query("materialize", f"WITH {SQL_SPLITS} SELECT split, doc_id, lang, text FROM docs")
def q_materialize(spark, sf_dir):
    folder, settings = fresh_folder(spark, "prepared"), {"table": "documents", "splits": 3}
    materialize(split_frames(spark, sf_dir), folder, settings)
    # The second call finds the written splits and computes nothing.
    again = stack_splits(materialize(split_frames(spark, sf_dir), folder, settings))
    return again.select("split", F.col("_row_id").alias("doc_id"), "lang", "text")


@query("materialize_changed", f"WITH {SQL_SPLITS} SELECT split, doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new ' || text ELSE text END AS text FROM docs")
def q_materialize_changed(spark, sf_dir):
    folder, settings = fresh_folder(spark, "prepared"), {"table": "documents", "splits": 3}
    old = {name: df.select("_row_id", "text") for name, df in split_frames(spark, sf_dir).items()}
    materialize(old, folder, settings, sources=old)
    # Other texts under the same schema and the same settings are prepared anew.
    text = F.when(F.col("_row_id") % 3 == 0, F.concat(F.lit("new "), "text")).otherwise(F.col("text"))
    new = {name: df.withColumn("text", text) for name, df in old.items()}
    again = stack_splits(materialize(new, folder, settings, sources=new))
    return again.select("split", F.col("_row_id").alias("doc_id"), "text")
