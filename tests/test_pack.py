"""Packing against a per-row statement of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.operators.pack import PackSettings, pack

LI, LT, PAD, BOS, EOS = 6, 5, 0, 1, 2


def rows(seed=0, n=150):
    rng = random.Random(seed)
    some = lambda top: [rng.choice([0, 3, 4, 5, 6]) for _ in range(rng.randint(0, top))]
    edge = [([], []), ([], [3]), ([3], []), ([4] * 20, [5] * 20), ([0, 3, 0], [0, 4, 0])]
    return edge + [(some(10), some(9)) for _ in range(n)]


def frame(spark, data, target=True):
    schema = "_row_id long, input_ids array<int>, target_ids array<int>"
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(data)], schema)
    return df if target else df.drop("target_ids")


def collected(df):
    return [r.asDict() for r in df.orderBy("_row_id").collect()]


def causal_row(a, b, bos=True, eos=True, li=LI, lt=LT):
    """Left-pad the input, right-pad the target, then move the input's pads to the end."""
    x = (([BOS] if bos else []) + a)[-LI:]
    t = (b + ([EOS] if eos else []))[:LT]
    out = x + t + [PAD] * (lt - len(t)) + [PAD] * (li - len(x))
    mask = [1] * len(x) + [1] * len(t) + [0] * (lt - len(t)) + [0] * (li - len(x))
    labels = [-100 if i < len(x) or v == PAD else v for i, v in enumerate(out)]
    return {"input_ids": out, "attention_mask": mask, "labels": labels}


SETTINGS = PackSettings.per_item(max_input=LI, max_target=LT)


@pytest.mark.parametrize("form, bos", [(PackSettings.per_item, True), (PackSettings.whole_table, False)])
def test_causal(spark, form, bos):
    data = rows()
    packed = collected(pack(frame(spark, data), form(max_input=LI, max_target=LT)))
    for got, (a, b) in zip(packed, data):
        wanted = causal_row(a, b, bos)
        assert {k: got[k] for k in wanted} == wanted
        assert len(got["input_ids"]) == len(got["labels"]) == LI + LT
        assert sum(got["attention_mask"]) == min(len(a) + bos, LI) + min(len(b) + 1, LT)


def test_seq2seq_keeps_the_first_tokens_and_masks_pads(spark):
    data = rows(1)
    for form, special in ((PackSettings.per_item, 1), (PackSettings.whole_table, 0)):
        for got, (a, b) in zip(collected(pack(frame(spark, data), form(mode="seq2seq", max_input=LI, max_target=LT))), data):
            x, t = (([BOS] * special) + a)[:LI], (b + [EOS] * special)[:LT]
            assert got["input_ids"] == x + [PAD] * (LI - len(x))
            assert got["attention_mask"] == [1] * len(x) + [0] * (LI - len(x))
            assert got["labels"] == [-100 if v == PAD else v for v in t] + [-100] * (LT - len(t))


def test_predict_rows_have_no_labels_and_left_pads(spark):
    data = rows(2)
    packed = collected(pack(frame(spark, data), SETTINGS, predict=True))
    for got, (a, _) in zip(packed, data):
        x = ([BOS] + a)[-LI:]
        assert got["input_ids"] == [PAD] * (LI - len(x)) + x
        assert got["attention_mask"] == [0] * (LI - len(x)) + [1] * len(x)
        assert "labels" not in got and "target_ids" not in got
    assert "labels" not in pack(frame(spark, data, target=False), SETTINGS).columns


def test_prefixes(spark):
    data = rows(3)
    plain = collected(pack(frame(spark, data), SETTINGS))
    front = collected(pack(frame(spark, data), SETTINGS, prefix="front", n_prefix=3, decoder_prefix=True))
    for a, b in zip(plain, front):
        assert b["input_ids"] == [50256] * 3 + a["input_ids"]
        assert b["attention_mask"] == [1] * 3 + a["attention_mask"]
        assert b["labels"] == [-100] * 3 + a["labels"]
        assert b["decoder_input_ids"] == [50256] * 3
    left = collected(pack(frame(spark, data), SETTINGS, predict=True))
    after = collected(pack(frame(spark, data), SETTINGS, predict=True, prefix="after_pad", n_prefix=3, prefix_id=9))
    for a, b in zip(left, after):
        pads = LI - sum(a["attention_mask"])
        assert b["input_ids"] == a["input_ids"][:pads] + [9] * 3 + a["input_ids"][pads:]
        assert b["attention_mask"] == a["attention_mask"][:pads] + [1] * 3 + a["attention_mask"][pads:]
    with pytest.raises(ValueError):
        pack(frame(spark, data), SETTINGS, prefix="after_pad")


def test_prefix_only_packs_the_target(spark):
    data = rows(4)
    for got, (_, b) in zip(collected(pack(frame(spark, data), SETTINGS, prefix_only=True)), data):
        t = (b + [EOS])[:LT]
        assert got["input_ids"] == t + [PAD] * (LT - len(t))
        assert got["labels"] == [-100 if v == PAD else v for v in t] + [-100] * (LT - len(t))


def test_longest_and_no_padding(spark):
    data = rows(5, 40)
    df = frame(spark, data).withColumns({"rank": (F.col("_row_id") % 2).cast("int"), "batch_id": F.expr("_row_id div 8")})
    kept = [(min(len(a) + 1, LI), min(len(b) + 1, LT)) for a, b in data]
    for got, (a, b) in zip(collected(pack(df, SETTINGS, padding="longest")), data):
        mates = [k for i, k in enumerate(kept) if (i % 2, i // 8) == (got["rank"], got["batch_id"])]
        wanted = causal_row(a, b, li=max(k[0] for k in mates), lt=max(k[1] for k in mates))
        assert {k: got[k] for k in wanted} == wanted
    for got, (a, b) in zip(collected(pack(frame(spark, data), SETTINGS, padding="none")), data):
        assert got["input_ids"] == ([BOS] + a)[-LI:] + (b + [EOS])[:LT]
    for got, (a, b) in zip(collected(pack(frame(spark, data), SETTINGS, padding="none", truncation=False)), data):
        assert got["input_ids"] == [BOS] + a + b + [EOS]


def test_unknown_settings_are_refused():
    for wrong in ({"mode": "x"}, {"padding": "x"}, {"prefix": "x"}):
        with pytest.raises(ValueError):
            PackSettings(**wrong)
