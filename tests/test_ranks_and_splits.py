"""Exact cut-offs, samples, row numbers, and the split rules built on them."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textmill.operators import ranks
from textmill.operators.dedup import dedup_seq
from textmill.operators.ranks import IdRanges, first_rows, number_by_hash, number_by_id, number_by_order, rank_cut, sampled_rows
from textmill.operators.splits import make_splits, rename_splits, sample_split


def md5_order(seed, ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.fixture(params=[100_000, 3])
def direct_rows(request, monkeypatch):
    """Once with the one-step search, once narrowed by histograms down to a handful of rows."""
    monkeypatch.setattr(ranks, "DIRECT_ROWS", request.param)
    monkeypatch.setattr(ranks, "HISTOGRAM_BINS", 8)


def ids_of(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 7, 50, 99, 100, 500])
def test_first_rows_and_samples_are_exact(spark, direct_rows, n):
    ids = [i * i * 1_000_003 - 5_000 for i in range(100)]
    df = spark.createDataFrame([(i,) for i in ids], "_row_id long").repartition(5)
    assert ids_of(df.filter(first_rows(df, n, "_row_id"))) == sorted(ids)[:n]
    assert ids_of(df.filter(sampled_rows(df, n, "s", "_row_id"))) == sorted(md5_order("s", ids)[:n])


def test_rank_cut_breaks_ties_by_the_next_column(spark, direct_rows):
    rows = [(i % 3, f"t{i:03d}") for i in range(60)]
    df = spark.createDataFrame(rows, "freq long, token string")
    for n in (1, 19, 20, 21, 45, 60):
        kept = df.filter(rank_cut(df, -F.col("freq"), [F.col("token")], n)).collect()
        assert sorted(map(tuple, kept)) == sorted(sorted(rows, key=lambda r: (-r[0], r[1]))[:n])


def test_one_value_may_fill_a_third_of_the_key(spark, direct_rows):
    rows = [(7 if i % 3 == 0 else i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, i long")
    for n in (5, 50, 105, 200):
        kept = df.filter(rank_cut(df, F.col("k"), [F.col("i")], n)).collect()
        assert sorted(map(tuple, kept)) == sorted(rows)[:n]


def test_a_crowd_of_equal_keys_is_cut_by_the_bytes_of_the_text(spark):
    tokens = ["", "a", "é", "éa", "日本", "日", "zz", "\x00", "\U0001f600"] + [f"same-long-prefix-{i:04d}" for i in range(300)]
    rows = [(1, t) for t in tokens] + [(5, "top"), (2, "mid")]
    df = spark.createDataFrame(rows, "freq long, token string").repartition(3)
    ordered = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
    for n in (1, 3, 150, 310):
        kept = df.filter(rank_cut(df, -F.col("freq"), [F.col("token")], n, 2)).collect()
        assert sorted(map(tuple, kept)) == sorted(ordered[:n])
    equal = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], "freq long, token string")
    assert equal.filter(rank_cut(equal, F.col("freq"), [F.col("token")], 7, 3)).count() == 50  # equal rows go together


@pytest.mark.parametrize("pieces", [1, 2, 7, 64])
def test_numbers_by_id_hold_for_skewed_and_far_ids(spark, pieces):
    crowd = [10**15 + i for i in range(700)]
    ids = crowd + [-(2**63), 2**63 - 1, -1, 0, 5, 10**18] + [10**15 + 10**9 * i for i in range(1, 40)] + [3**k for k in range(39)][2:]
    ids = sorted(set(ids))
    df = spark.createDataFrame([(i, f"x{i}", "kept") for i in ids], "doc long, id string, _range string").repartition(6)
    out = number_by_id(df, "doc", "idx", "n", pieces)
    assert out.columns == ["doc", "id", "_range", "idx", "n"]
    assert sorted((r.idx, r.doc, r.id, r.n) for r in out.collect()) == [(k, i, f"x{i}", len(ids)) for k, i in enumerate(ids)]
    found = IdRanges(df, "doc", pieces)
    sizes = dict(df.select(found.range_of(F.col("doc")).alias("r")).groupBy("r").count().collect())
    assert max(sizes.values()) <= 5 * -(-len(ids) // pieces)  # no range of unbounded size


def test_numbers_by_id_of_small_and_faulty_tables(spark):
    df = spark.createDataFrame([(7,)], "_row_id long")
    assert [tuple(r) for r in number_by_id(df, "_row_id", "idx", "n").collect()] == [(7, 0, 1)]
    assert number_by_id(df.limit(0), "_row_id", "idx", "n").collect() == []
    with pytest.raises(Exception, match="null in the row id"):
        number_by_id(spark.createDataFrame([(7,), (None,)], "_row_id long"), "_row_id", "idx", "n").collect()


def test_row_order_scans_once_and_writes_nothing(spark):
    df = spark.range(30_000).withColumnRenamed("id", "_row_id").withColumn("text", F.lit("x"))
    plan = number_by_id(df, "_row_id", "idx", "n", 16)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange") == 1 and physical.count("Range (") == 1 and "FileScan" not in physical


def test_dev_from_train_refuses_a_null_id(spark):
    df = spark.createDataFrame([(i if i else None,) for i in range(10)], "_row_id long")
    with pytest.raises(Exception, match="null in the row id"):
        make_splits({"train": df}, dev_size=3, dev_from_train_rows=True)["train"].collect()


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_samples_and_numbers_do_not_depend_on_partitions(spark, parts):
    ids = [3 * i for i in range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "_row_id long").repartition(parts)
    assert ids_of(sample_split(df, 20, 1)) == sorted(md5_order(1, ids)[:20])
    numbered = {r._row_id: r.idx for r in number_by_hash(df, "42:0", "_row_id", "idx", "n").collect()}
    assert numbered == {i: place for place, i in enumerate(md5_order("42:0", ids))}
    in_order = number_by_order(df, ["_row_id"], "idx", "n").collect()
    assert {(r._row_id, r.idx, r.n) for r in in_order} == {(i, place, 200) for place, i in enumerate(ids)}


def frames(spark, **sizes):
    start, out = 0, {}
    for name, size in sizes.items():
        out[name] = spark.range(start, start + size).withColumnRenamed("id", "_row_id")
        start += size
    return out


def test_dev_sizes(spark):
    splits = frames(spark, train=40, dev=20, test=5)
    assert ids_of(make_splits(splits, dev_size=3)["dev"]) == [40, 41, 42]
    assert ids_of(make_splits(splits, dev_size=0.25)["dev"]) == list(range(40, 50))
    assert make_splits(splits, dev_size=1000)["dev"].count() == 20
    assert make_splits(splits)["dev"].count() == 20


def test_dev_from_train_is_disjoint_and_complete(spark):
    out = make_splits(frames(spark, train=40, dev=20, extra=5), dev_size=7, dev_from_train_rows=True)
    assert set(out) == {"train", "dev", "test"}
    assert ids_of(out["train"]) == list(range(33))
    assert ids_of(out["dev"]) == ids_of(out["test"]) == list(range(33, 40))


def test_tiny_draws_later_splits_from_the_small_train(spark):
    out = make_splits(frames(spark, dev=5, train=100, test=5), tiny=True, tiny_size=10, seed=9)
    ids = range(5, 105)
    assert ids_of(out["dev"]) == sorted(md5_order("9:dev", ids)[:10])
    small = md5_order("9:train", ids)[:10]
    assert ids_of(out["train"]) == sorted(small) == ids_of(out["test"])


def test_shots_overfit_and_predict(spark):
    out = make_splits(frames(spark, train=100, dev=5, predict=50), shots=10, overfit=True, predict_size=4)
    assert ids_of(out["dev"]) == ids_of(out["train"]) and out["train"].count() == 10
    assert ids_of(out["predict"]) == sorted(md5_order("42:predict", range(105, 155))[:4])
    only = make_splits(frames(spark, predict=9), shots=2, overfit=True, predict_size=3)
    assert set(only) == {"predict"} and only["predict"].count() == 3


def test_renaming(spark):
    splits = frames(spark, train=1, val=2, validation=3, evaluate=4, dev=5)
    renamed = rename_splits(splits)
    assert set(renamed) == {"train", "dev"} and renamed["dev"].count() == 4
    moved = rename_splits(splits, predict_split="dev")
    assert set(moved) == {"train", "predict"} and moved["predict"].count() == 4
    with pytest.raises(ValueError):
        rename_splits(splits, predict_split="nope")


def test_dedup_in_sequence(spark):
    rows = [(0, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, None, "z"), (4, None, "w")]
    df = spark.createDataFrame(rows, "_row_id long, p string, q string")
    assert ids_of(dedup_seq(df, ["p", "q"]).select("_row_id")) == [0, 3]
    assert ids_of(dedup_seq(df, ["p"]).select("_row_id")) == [0, 2, 3]
    assert dedup_seq(df, ["p"]).columns == df.columns
    once = dedup_seq(df, ["q", "p"])
    assert ids_of(dedup_seq(once, ["q", "p"]).select("_row_id")) == ids_of(once.select("_row_id"))


def test_dedup_with_a_hot_value(spark):
    df = spark.range(3000).select(
        F.col("id").alias("_row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t")
    )
    assert ids_of(dedup_seq(df, ["t"]).select("_row_id")) == sorted({0, *(i for i in range(3000) if i % 3)})
