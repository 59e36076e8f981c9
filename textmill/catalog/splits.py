"""Queries for split sources, split naming and split sizing."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import (
    HELD_OUT,
    SQL_SPLITS,
    documents,
    split_documents,
    split_frames,
    sql_label,
)
from textmill.operators.splits import (
    alias_dev_column,
    make_splits,
    move_to_predict_column,
    rename_splits,
    stack_splits,
)
from textmill.sources.readers import read_splits
from textmill.sources.staging import fresh_folder


def _stacked(splits):
    return stack_splits(splits).select("split", F.col("_row_id").alias("doc_id"))


@query("src_named", f"WITH {SQL_SPLITS} SELECT split, doc_id, lang, n_chars FROM docs")
def q_src_named(spark, sf_dir):
    folder = fresh_folder(spark, "named")
    split_documents(spark, sf_dir).write.partitionBy("split").parquet(folder)
    stacked = stack_splits(read_splits(spark, folder))
    return stacked.select("split", F.col("_row_id").alias("doc_id"), "lang", "n_chars")


@query("src_frame", "SELECT 'train' AS split, doc_id FROM documents")
def q_src_frame(spark, sf_dir):
    return _stacked(read_splits(spark, documents(spark, sf_dir)))


@query("src_splits", f"WITH {SQL_SPLITS} SELECT split, doc_id FROM docs WHERE split IN ('test', 'train')")
def q_src_splits(spark, sf_dir):
    return _stacked(read_splits(spark, split_frames(spark, sf_dir), splits=["test", "train"]))


ALIASES = {"0": "validation", "12": "eval", "3": "dev", "4": "test"}
SQL_ALIASED = f"""docs AS (SELECT doc_id, {sql_label(ALIASES)} AS split FROM documents)
SELECT CASE split WHEN 'eval' THEN 'dev' ELSE split END AS split, doc_id FROM docs
WHERE split NOT IN ('dev', 'validation')"""


@query("split_alias_dev", f"WITH {SQL_ALIASED}")
def q_split_alias_dev(spark, sf_dir):
    return _stacked(rename_splits(split_frames(spark, sf_dir, ALIASES)))


@query("split_alias_dev_column", f"WITH {SQL_ALIASED}")
def q_split_alias_dev_column(spark, sf_dir):
    renamed = alias_dev_column(split_documents(spark, sf_dir, ALIASES))
    return renamed.select("split", F.col("_row_id").alias("doc_id"))


SQL_MOVED = f"""docs AS (SELECT doc_id, {sql_label(HELD_OUT)} AS split FROM documents)
SELECT CASE split WHEN 'validation' THEN 'predict' ELSE split END AS split, doc_id FROM docs"""


@query("split_predict_move", f"WITH {SQL_MOVED}")
def q_split_predict_move(spark, sf_dir):
    return _stacked(rename_splits(split_frames(spark, sf_dir), predict_split="dev"))


@query("split_predict_move_column", f"WITH {SQL_MOVED}")
def q_split_predict_move_column(spark, sf_dir):
    moved = move_to_predict_column(split_documents(spark, sf_dir), "validation")
    return moved.select("split", F.col("_row_id").alias("doc_id"))


SIZED = f"""docs AS (SELECT doc_id, {sql_label({"01": "dev", "23": "test"})} AS split FROM documents)"""


def _frames(spark, sf_dir):
    return split_frames(spark, sf_dir, {"01": "dev", "23": "test"})


@query(
    "dev_head",
    f"""WITH {SIZED},
placed AS (SELECT split, doc_id, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place FROM docs)
SELECT split, doc_id FROM placed WHERE split <> 'dev' OR place <= 50""",
)
def q_dev_head(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), dev_size=50))


@query(
    "dev_fraction",
    f"""WITH {SIZED},
placed AS (SELECT split, doc_id, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place FROM docs)
SELECT split, doc_id FROM placed
WHERE split <> 'dev' OR place <= floor(0.1 * (SELECT count(*) FROM docs WHERE split = 'train'))""",
)
def q_dev_fraction(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), dev_size=0.1))


@query(
    "dev_from_train",
    f"""WITH {SIZED},
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) <= floor(0.25 * count(*) OVER ()) AS held
  FROM docs WHERE split = 'train')
SELECT 'train' AS split, doc_id FROM placed WHERE NOT held
UNION ALL SELECT 'dev', doc_id FROM placed WHERE held
UNION ALL SELECT 'test', doc_id FROM placed WHERE held""",
)
def q_dev_from_train(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), dev_size=0.25, dev_from_train_rows=True))


def _sql_draw(source: str, seed: str, n: int) -> str:
    return f"SELECT doc_id FROM {source} ORDER BY md5('{seed}:' || doc_id), doc_id LIMIT {n}"


@query(
    "tiny",
    f"""WITH {SIZED}, whole AS (SELECT doc_id FROM docs WHERE split = 'train'),
small AS ({_sql_draw("whole", "42:train", 64)}),
dev AS ({_sql_draw("small", "42:dev", 64)}), test AS ({_sql_draw("small", "42:test", 64)})
SELECT 'train' AS split, doc_id FROM small UNION ALL SELECT 'dev', doc_id FROM dev
UNION ALL SELECT 'test', doc_id FROM test""",
)
def q_tiny(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), tiny=True, tiny_size=64))


@query(
    "shots",
    f"""WITH {SIZED}, whole AS (SELECT doc_id FROM docs WHERE split = 'train'), few AS ({_sql_draw("whole", "42", 100)})
SELECT 'train' AS split, doc_id FROM few UNION ALL SELECT split, doc_id FROM docs WHERE split <> 'train'""",
)
def q_shots(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), shots=100))


@query(
    "overfit",
    f"""WITH {SIZED}, whole AS (SELECT doc_id FROM docs WHERE split = 'train'), few AS ({_sql_draw("whole", "42", 100)})
SELECT 'train' AS split, doc_id FROM few UNION ALL SELECT 'dev', doc_id FROM few
UNION ALL SELECT split, doc_id FROM docs WHERE split = 'test'""",
)
def q_overfit(spark, sf_dir):
    return _stacked(make_splits(_frames(spark, sf_dir), shots=100, overfit=True))


@query(
    "predict_size",
    f"""WITH docs AS (SELECT doc_id, {sql_label({"01": "predict", "23": "test"})} AS split FROM documents),
whole AS (SELECT doc_id FROM docs WHERE split = 'predict'), few AS ({_sql_draw("whole", "42:predict", 20)})
SELECT 'predict' AS split, doc_id FROM few UNION ALL SELECT split, doc_id FROM docs WHERE split <> 'predict'""",
)
def q_predict_size(spark, sf_dir):
    frames = split_frames(spark, sf_dir, {"01": "predict", "23": "test"})
    return _stacked(make_splits(frames, predict_size=20))
