"""Repeated and null row ids, labels of other types, JSON lines, and splits that nobody asked for."""

import json

import pytest
from pyspark.sql import functions as F

from textmill.operators import vocab as V
from textmill.operators.clean import label_to_word
from textmill.operators.dedup import dedup_seq
from textmill.operators.predict import batch_predict
from textmill.operators.ranks import first_rows, sampled_rows
from textmill.plans.prepare import load_splits
from textmill.plans.settings import PrepareSettings
from textmill.sources.readers import read_json_columns

ROWS = [(1, "a b a"), (1, "a b a"), (2, ""), (3, None), (4, "zz a"), (4, "zz a")]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([("<unk>", 0, 0), ("<bos>", 1, 0), ("<eos>", 2, 0), ("a", 3, 9), ("b", 4, 5)], "token string, id int, freq long")


def test_repeated_rows_are_encoded_alike_on_both_paths(spark, words):
    df = spark.createDataFrame(ROWS, "_row_id long, text string")
    small = V.encode(df, {"text": "ids"}, words)
    large = V.encode_by_join(df, {"text": "ids"}, words)
    key = lambda d: sorted((r._row_id, r.ids) for r in d.collect())
    assert key(small) == key(large)
    assert key(large)[0] == (1, [3, 4, 3])


def test_repeated_rows_are_decoded_alike_on_both_paths(spark, words):
    rows = [(1, [3, 4, 3]), (1, [3, 4, 3]), (2, []), (3, None), (4, [99, 3])]
    df = spark.createDataFrame(rows, "_row_id long, ids array<int>")
    key = lambda d: sorted((r._row_id, r.ids) for r in d.collect())
    assert key(V.ids_to_tokens(df, "ids", words)) == key(V._tokens_by_join(df, "ids", words, "_row_id"))


def test_a_null_row_id_is_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "_row_id long, text string")
    for cut in (lambda: df.filter(first_rows(df, 2, "_row_id")), lambda: df.filter(sampled_rows(df, 2, "s", "_row_id")), lambda: dedup_seq(df, ["text"])):
        with pytest.raises(Exception, match="null in the row id"):
            cut().collect()


def test_labels_are_compared_in_their_own_type(spark):
    df = spark.createDataFrame([("0",), ("1",)], "label string")
    few, many = {0: "no", 1: "yes"}, {k: ("no", "yes")[k % 2] for k in range(300)}
    for names in (few, many):
        assert sorted(r.word_label for r in label_to_word(df, names).collect()) == ["no", "yes"]
    table = spark.createDataFrame([(0, "no"), (0, "no"), (1, "yes")], "id int, name string")
    assert label_to_word(df, table).count() == 2
    with pytest.raises(Exception, match="two names for label 0"):
        label_to_word(df, table.union(spark.createDataFrame([(0, "other")], table.schema))).collect()


def test_json_lines_are_not_cut_to_the_first_object(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps({"t": [str(k)] * 2, "n": [k, k]}) for k in range(20)))
    with pytest.raises(ValueError, match="20 JSON objects"):
        read_json_columns(spark, str(lines))
    several = tmp_path / "several.json"
    several.write_text("\n".join(json.dumps({"t": [str(k)], "n": [k]}, indent=1) for k in range(3)))
    with pytest.raises(ValueError, match="more than one root"):
        read_json_columns(spark, str(several))
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps({"t": ["a", "b"], "n": [1, 2]}, indent=1))
    assert read_json_columns(spark, str(whole)).count() == 2


def test_a_model_batch_holds_one_loader_batch(spark):
    rows = [(r, b, [1] * (3 + b), [1] * (3 + b)) for r in range(2) for b in range(3) for _ in range(4 if b < 2 else 3)]
    df = spark.createDataFrame(rows, "rank int, batch_id int, input_ids array<int>, attention_mask array<int>").repartition(2)

    def factory():
        def predict(ids, masks):
            import numpy as np

            return np.stack([np.array(i) for i in ids]).tolist()

        return predict

    out = batch_predict(df, factory).collect()
    assert len(out) == len(rows) and all(list(r.output_ids) == list(r.input_ids) for r in out)


def test_a_loader_batch_is_predicted_once_whatever_the_arrow_batches(spark):
    rows = [(k % 2, k // 2 // 4, k // 2, k, f"t{k}") for k in range(45)]
    df = spark.createDataFrame(rows, "rank int, batch_id int, pos int, n int, output_ids string").repartition(3, "n")

    def factory():
        # Every row tells which rows its list had.
        return lambda n: [list(n)] * len(n)

    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = batch_predict(df, factory, columns=["n"], batch_size=4, regroup=True).collect()
        halves = batch_predict(df, factory, columns=["n"], batch_size=3, regroup=True).collect()
        plain = batch_predict(df.drop("rank").coalesce(1), factory, columns=["n"], batch_size=7).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    batches = {}
    for rank, batch, _, n, _ in rows:
        batches.setdefault((rank, batch), []).append(n)
    assert sorted(r.n for r in out) == list(range(45))
    assert all(list(r.output_ids) == batches[r.rank, r.batch_id] for r in out)
    assert all(list(r.output_ids) in (batches[r.rank, r.batch_id][:3], batches[r.rank, r.batch_id][3:]) for r in halves)
    assert sorted({len(r.output_ids) for r in plain}) == [3, 7] and len(plain) == 45


def test_only_the_chosen_splits_are_read(spark, tmp_path):
    (tmp_path / "train.csv").write_text("id,text\n1,a\n2,b\n")
    raw = {"train": str(tmp_path / "train.csv"), "test": str(tmp_path / "missing.csv")}
    splits = load_splits(spark, PrepareSettings.from_kwargs(raw_data=raw, splits=["train"]))
    assert list(splits) == ["train"] and splits["train"].agg(F.count("*")).first()[0] == 2
