"""Vocabulary paths, encoding paths, and dealing rows to ranks and batches."""

import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.operators import vocab as vocab_module
from textmill.operators.lengths import filter_long
from textmill.operators.predict import decode_output
from textmill.operators.shard import (
    batch_rows,
    collate,
    effective_batch_size,
    epoch_order,
    limit_batches,
    shard_rows,
)
from textmill.operators.vocab import build_vocab, encode, encode_by_join, ids_to_tokens, token_lengths

# The tokenizer below travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = ["the cat the dog", "", "the", None, "a b c the zebra", "the " * 400, "b b a"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "_row_id long, text string")


def expected_vocab(size):
    counts = Counter(w for t in TEXTS if t for w in t.split())
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]
    return {word: (i + 3, n) for i, (word, n) in enumerate(ranked)}


@pytest.mark.parametrize("top_rows", [5_000_000, 0])
def test_vocab_by_top_and_by_cut(spark, monkeypatch, top_rows):
    monkeypatch.setattr(vocab_module, "TOP_ROWS", top_rows)
    for size in (1, 4, 100):
        table = {r.token: (r.id, r.freq) for r in build_vocab(texts(spark), "text", size).collect()}
        reserved = {table.pop(t) for t in ("<unk>", "<bos>", "<eos>")}
        assert reserved == {(0, 0), (1, 0), (2, 0)}
        assert table == expected_vocab(size)


def test_encoding_paths_agree(spark, monkeypatch):
    df = texts(spark).withColumn("other", F.concat(F.lit("zebra "), F.col("text")))
    vocab = build_vocab(df, "text", 3)
    known = {w: i for w, (i, _) in expected_vocab(3).items()}
    wanted = [None if t is None else [known.get(w, 0) for w in t.split()] for t in TEXTS]
    columns = {"text": "ids", "other": "more"}
    shipped = encode(df, columns, vocab).orderBy("_row_id").collect()
    assert [r.ids for r in shipped] == wanted
    for hot_share in (1_000, 2, 1):
        monkeypatch.setattr(vocab_module, "HOT_SHARE", hot_share)
        joined = encode_by_join(df, columns, vocab).orderBy("_row_id").collect()
        assert [(r.ids, r.more) for r in joined] == [(r.ids, r.more) for r in shipped]
    monkeypatch.setattr(vocab_module, "SHIP_ROWS", 2)
    assert [r.ids for r in encode(df, columns, vocab).orderBy("_row_id").collect()] == wanted


def test_decoding_paths_agree(spark, monkeypatch):
    df = texts(spark).filter("text is not null")
    vocab = build_vocab(df, "text", 3)
    ids = encode(df, {"text": "ids"}, vocab).withColumn("ids", F.concat("ids", F.array(F.lit(999)).cast("array<int>")))
    shipped = [r.ids for r in ids_to_tokens(ids, "ids", vocab).orderBy("_row_id").collect()]
    known = expected_vocab(3)
    assert shipped == [[w if w in known else "<unk>" for w in t.split()] for t in TEXTS if t is not None]
    monkeypatch.setattr(vocab_module, "SHIP_BYTES", 1)
    assert [r.ids for r in ids_to_tokens(ids, "ids", vocab).orderBy("_row_id").collect()] == shipped


def length_tokenizer():
    return lambda batch: [[len(word) for word in text.split()] for text in batch]


def test_user_tokenizer(spark):
    rows = encode(texts(spark), {"text": "ids"}, tokenizer=length_tokenizer).orderBy("_row_id").collect()
    assert [r.ids for r in rows] == [None if t is None else [len(w) for w in t.split()] for t in TEXTS]
    df = texts(spark).filter("text is not null").withColumnRenamed("text", "input")
    kept = filter_long(df, 4, n_special=0, length=token_lengths(length_tokenizer))
    assert {r._row_id for r in kept.collect()} == {0, 1, 2, 6}
    with pytest.raises(ValueError):
        encode(texts(spark), {"text": "ids"})


def numbers(spark, n, parts=3):
    return spark.range(n).withColumnRenamed("id", "_row_id").repartition(parts)


@pytest.mark.parametrize("n, world", [(10, 4), (8, 4), (1, 4), (3, 7), (100, 1)])
def test_shards(spark, n, world):
    placed = epoch_order(numbers(spark, n), shuffle=False)
    plain = shard_rows(placed, world).collect()
    assert {(r._row_id, r.rank, r.pos) for r in plain} == {(i, i % world, i // world) for i in range(n)}
    assert {r.rank: r.rank_rows for r in plain} == dict(Counter(i % world for i in range(n)))
    wrapped = shard_rows(placed, world, pad="wrap").collect()
    total = -(-n // world) * world
    assert sorted((r.rank, r.pos, r._row_id, r.rank_rows) for r in wrapped) == sorted(
        (p % world, p // world, p % n, total // world) for p in range(total)
    )


def test_epochs_differ_and_repeat(spark):
    def order(epoch, parts):
        df = epoch_order(numbers(spark, 50, parts), epoch=epoch)
        return [r._row_id for r in df.orderBy("idx").collect()]

    assert order(0, 2) == order(0, 7) != order(1, 2)
    assert sorted(order(1, 2)) == list(range(50))


def test_batches(spark):
    rows = batch_rows(shard_rows(epoch_order(numbers(spark, 23), shuffle=False), 2), 4)
    assert {(r.rank, r.n_batches) for r in rows.collect()} == {(0, 3), (1, 3)}
    assert {r.batch_id for r in limit_batches(rows, 2).collect()} == {0, 1}
    assert {r.batch_id for r in limit_batches(rows, 0.7).collect()} == {0, 1}
    assert limit_batches(rows, 1).count() == 8 and limit_batches(rows, 1.0).count() == 23
    assert limit_batches(rows, 0).count() == 0 and limit_batches(rows, None).count() == 23
    with pytest.raises(ValueError):
        limit_batches(rows, 1.5)
    stacked = {(r.rank, r.batch_id): (r.n_rows, r._row_id) for r in collate(rows, ["_row_id"]).collect()}
    assert stacked[(1, 2)] == (3, [17, 19, 21]) and stacked[(0, 0)] == (4, [0, 2, 4, 6])


def test_effective_batch_size():
    assert effective_batch_size(2, 4, "ddp") == 8
    assert effective_batch_size(2, 0, "ddp") == 2
    assert effective_batch_size(2, 4, "auto") == 2


def test_joined_encoding_reads_texts_once_after_counting(spark, monkeypatch):
    # Hot, rare and very long tokens in one text, null and empty texts, a repeated row, two columns.
    many = [" ".join(f"w{k % 7} r{k}".replace("0", "a") for k in range(i, i + 60)) for i in range(30)]
    rows = [(i, t, None if i % 3 else "zebra " + t) for i, t in enumerate([*many, "x" * 100 + " w" + "x" * 100, "", None])]
    df = spark.createDataFrame([*rows, rows[4]], "_row_id long, text string, other string")
    columns = {"text": "ids", "other": "more"}
    key = lambda d: sorted(((r._row_id, r.ids, r.more) for r in d.collect()), key=str)
    monkeypatch.setattr(vocab_module, "HOT_SHARE", 1)
    for size in (5, 40, 1_000):
        vocab = build_vocab(df, "text", size)
        joined = encode_by_join(df, columns, vocab)
        assert key(joined) == key(encode(df, columns, vocab))
        # The texts are read for the places of rare tokens and for the rows themselves, not once more for hot ones.
        assert "Union" not in joined._jdf.queryExecution().executedPlan().toString()


def counting_tokenizer():
    return lambda batch: [[len(batch)] for _ in batch]


def test_user_code_gets_bounded_runs_of_an_arrow_batch(spark):
    df = spark.range(3000).select(F.col("id").alias("_row_id"), F.repeat(F.lit("x"), 2000).alias("text")).coalesce(1)
    seen = encode(df, {"text": "ids"}, tokenizer=counting_tokenizer).select(F.element_at("ids", 1).alias("n")).collect()
    assert len(seen) == 3000 and max(r.n for r in seen) < 1000
    texts = df.select("_row_id", F.array(F.lit(1)).alias("input_ids"), F.sequence(F.lit(0), F.lit(600)).alias("output_ids"))
    decoded = decode_output(texts, decoder=lambda: lambda ids: [str(len(ids))] * len(ids), tidy=False).collect()
    assert len(decoded) == 3000 and max(int(r.prediction) for r in decoded) < 1000
