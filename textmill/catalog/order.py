"""Queries for epoch order, shards and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import documents
from textmill.operators.shard import batch_rows, collate, epoch_order, limit_batches, shard_rows

WORLD, BATCH = 7, 8
# The whole text goes where its row goes; its digest in the result shows that it arrived.
TEXT = "md5(text) AS text_md5"

# Rows in shuffled or row order, dealt to ranks and cut into batches, in SQL.
SHUFFLED = """placed AS (
  SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY md5('42:1:' || doc_id), doc_id) - 1 AS idx, count(*) OVER () AS n_rows
  FROM documents)"""
IN_ORDER = SHUFFLED.replace("md5('42:1:' || doc_id), doc_id", "doc_id")
DEALT = f"""dealt AS (SELECT *, CAST(idx % {WORLD} AS INTEGER) AS rank, idx // {WORLD} AS pos FROM placed),
batched AS (SELECT *, pos // {BATCH} AS batch_id FROM dealt)"""


def _placed(spark, sf_dir, shuffle=True):
    df = documents(spark, sf_dir).withColumnRenamed("_row_id", "doc_id")
    return epoch_order(df, epoch=1, shuffle=shuffle, row_id="doc_id")


def _batched(spark, sf_dir, shuffle=True):
    return batch_rows(shard_rows(_placed(spark, sf_dir, shuffle), WORLD), BATCH)


@query("epoch_order", f"WITH {SHUFFLED} SELECT doc_id, text_md5, idx, n_rows FROM placed")
def q_epoch_order(spark, sf_dir):
    return _placed(spark, sf_dir).selectExpr("doc_id", TEXT, "idx", "n_rows")


@query("epoch_order_rows", f"WITH {IN_ORDER} SELECT doc_id, text_md5, idx, n_rows FROM placed")
def q_epoch_order_rows(spark, sf_dir):
    return _placed(spark, sf_dir, shuffle=False).selectExpr("doc_id", TEXT, "idx", "n_rows")


@query("shard_rows", f"WITH {SHUFFLED}, {DEALT} SELECT doc_id, text_md5, idx, rank, pos FROM dealt")
def q_shard_rows(spark, sf_dir):
    return shard_rows(_placed(spark, sf_dir), WORLD).selectExpr("doc_id", TEXT, "idx", "rank", "pos")


@query(
    "shard_rows_wrap",
    f"""WITH {SHUFFLED},
turns AS (
  SELECT doc_id, text_md5, idx, unnest(range(idx, CAST(ceil(n_rows / {WORLD}) AS BIGINT) * {WORLD}, n_rows)) AS turn FROM placed)
SELECT doc_id, text_md5, idx, CAST(turn % {WORLD} AS INTEGER) AS rank, turn // {WORLD} AS pos FROM turns""",
)
def q_shard_rows_wrap(spark, sf_dir):
    return shard_rows(_placed(spark, sf_dir), WORLD, pad="wrap").selectExpr("doc_id", TEXT, "idx", "rank", "pos")


@query(
    "batch_rows",
    f"""WITH {SHUFFLED}, {DEALT}
SELECT doc_id, text_md5, rank, pos, batch_id, max(batch_id) OVER (PARTITION BY rank) + 1 AS n_batches FROM batched""",
)
def q_batch_rows(spark, sf_dir):
    return _batched(spark, sf_dir).selectExpr("doc_id", TEXT, "rank", "pos", "batch_id", "n_batches")


@query("limit_batches", f"WITH {IN_ORDER}, {DEALT} SELECT doc_id, text_md5, rank, batch_id FROM batched WHERE batch_id < 5")
def q_limit_batches(spark, sf_dir):
    return limit_batches(_batched(spark, sf_dir, shuffle=False), 5).selectExpr("doc_id", TEXT, "rank", "batch_id")


@query(
    "limit_batches_share",
    f"""WITH {SHUFFLED}, {DEALT},
sized AS (SELECT *, max(batch_id) OVER (PARTITION BY rank) + 1 AS n_batches FROM batched)
SELECT doc_id, text_md5, rank, batch_id FROM sized WHERE batch_id < floor(n_batches * 0.4)""",
)
def q_limit_batches_share(spark, sf_dir):
    return limit_batches(_batched(spark, sf_dir), 0.4).selectExpr("doc_id", TEXT, "rank", "batch_id")


@query(
    "collate",
    f"""WITH {SHUFFLED}, {DEALT},
whole AS (SELECT batched.*, lang, n_chars FROM batched JOIN documents USING (doc_id))
SELECT rank, batch_id, CAST(count(*) AS INTEGER) AS n_rows, string_agg(doc_id, ' ' ORDER BY pos) AS doc_ids,
  string_agg(lang, ' ' ORDER BY pos) AS langs, string_agg(n_chars, ' ' ORDER BY pos) AS sizes,
  string_agg(text_md5, ' ' ORDER BY pos) AS texts
FROM whole GROUP BY rank, batch_id""",
)
def q_collate(spark, sf_dir):
    batches = collate(_batched(spark, sf_dir), ["doc_id", "lang", "n_chars", "text"])
    return batches.select(
        "rank",
        "batch_id",
        "n_rows",
        F.array_join(F.col("doc_id").cast("array<string>"), " ").alias("doc_ids"),
        F.array_join("lang", " ").alias("langs"),
        F.array_join(F.col("n_chars").cast("array<string>"), " ").alias("sizes"),
        F.array_join(F.transform("text", F.md5), " ").alias("texts"),
    )
