"""Operators over the whole corpus, each against brute force: joins, removal, index, mix, lists, pipeline."""

import collections
import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from textmill.llm import ann, components, hashing, mixing, ngram_join, queries, suffix_dedup, url_lists

SF = "/root/testdata/sf0.001"


def similar_groups(rows, num, den, width):
    sets = {}
    for key, text in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        shingles = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets[key] = frozenset(shingles)
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for key, shingles in sets.items():
        for s in shingles:
            holders[s].append(key)
    for a, b in {p for h in holders.values() for p in itertools.combinations(sorted(h), 2)}:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted((key, len(sets[key]), find(key)) for key in sets)


def copied_texts(seed, groups=25):
    rng = random.Random(seed)
    words, rows = [f"w{k}" for k in range(3000)], []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 4, 5, 8, 20, 40, 80, 150, 400]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text = text[: max(1, int(len(text) * rng.uniform(0.8, 1)))]
            rows.append((len(rows), " ".join(text).upper() if rng.random() < 0.2 else "  \n".join(text)))
    n = len(rows)
    return rows + [(n + k, t) for k, t in enumerate([None, "", " \t", "a", "A", "a b", "é É", "é é"])]


@pytest.mark.parametrize("num, width, tile", [(85, 4, 4096), (80, 5, 3)])
def test_links_equal_brute_force(spark, monkeypatch, num, width, tile):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)
    rows = copied_texts(3)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string").repartition(4)
    found = ngram_join.link_documents(df, ngram_join.Similarity(num, 100), width).collect()
    assert sorted(tuple(r) for r in found) == similar_groups(rows, num, 100, width)


def test_a_forest_has_the_components_of_its_edges():
    rng = np.random.default_rng(8)
    for n, m in ((2, 1), (50, 30), (300, 280), (40, 400), (1000, 999)):
        edges = rng.integers(0, n, (m, 2)) * 7
        if m == 999:
            edges = np.stack([np.arange(1, 1000), np.arange(999)], axis=1)  # a path
        made = ngram_join.forest(edges[edges[:, 0] != edges[:, 1]])
        root = {int(v): int(v) for v in np.unique(edges)}
        for _ in range(len(root)):
            for a, b in edges.tolist():
                root[a] = root[b] = min(root[a], root[b])
            if m == 999:
                root = dict.fromkeys(root, 0)
                break
        assert sorted(map(tuple, made.tolist())) == sorted((v, r) for v, r in root.items() if v != r)
    assert len(ngram_join.forest(np.empty((0, 2), np.int64))) == 0


def test_links_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_documents(empty).collect() == []
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (2, "a b c d E")]
    found = ngram_join.link_documents(spark.createDataFrame(rows, empty.schema)).collect()
    assert sorted(map(tuple, found), key=str) == [(2, 2, 2), (4, 2, 2), (4, 2, 2), (None, 2, None)]


def test_equal_parts_and_bitmaps_never_miss_a_similar_pair():
    rng, similarity = np.random.default_rng(0), ngram_join.Similarity(85, 100)
    keys = ngram_join.PartKeys(similarity)
    for n in (1, 6, 7, 12, 13, 20, 50, 200, 1000, 5000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            drop, add = rng.integers(0, n // 6 + 1), rng.integers(0, n // 6 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if len(b) and similarity.linked(both, len(a), len(b)) and both != max(len(a), len(b)):
                assert len(np.intersect1d(keys(a), keys(b)))
                maps, sizes = [ngram_join.bitmap(a), ngram_join.bitmap(b)], [len(a), len(b)]
                assert len(ngram_join.Tile([1, 2], sizes, maps, None, similarity).join()) == 1
                assert len(ngram_join.Tile([1, 2], sizes, maps, [a, b], similarity).join()) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 200), (300, 200)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 300: 200}
    assert dict(map(tuple, found)) == expected


def removed(rows, length, least_words=0):
    times = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        times.update(data[s : s + length] for s in range(len(data) - length + 1))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if times[data[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        for run in re.finditer(b"\1+", bytes(gone)):
            whole = [w for w in re.finditer(rb"[^\x20\x09-\x0D]+", data) if run.start() <= w.start() and w.end() <= run.end()]
            if len(whole) < least_words:
                gone[run.start() : run.end()] = bytes(run.end() - run.start())
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((key, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, gram, hot", [(40, 12, 20_000), (40, 12, 3)])
def test_removed_bytes_equal_brute_force(spark, length, gram, hot):
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    base, rows = [make(rng.randint(0, 600)) for _ in range(40)], []
    for key in range(120):
        text = rng.choice(base) if rng.random() < 0.6 else make(200)
        if rng.random() < 0.4:
            other, at = rng.choice(base), rng.randint(0, 300)
            text = text[: rng.randint(0, len(text))] + other[at : at + rng.randint(0, 200)] + text[rng.randint(0, len(text)) :]
        elif text and rng.random() < 0.6:
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(text))
                text = text[:at] + "X" + text[at + 1 :]
        rows.append((key, text))
    rows += [(200, None), (201, ""), (202, "a" * 500), (203, "ab" * 300), (204, "xyz" * 10), (205, "Q" + "a" * 45 + "Z")]
    rows += [(None, "a" * 60), (0, rows[1][1]), (0, rows[1][1])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, n_spans string, _id int, _RUNS int").repartition(4)
    out = suffix_dedup.remove_repeats(df, length, gram, hot=hot)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()]
    assert sorted(found, key=str) == removed(rows, length)
    out = suffix_dedup.remove_repeats(df, length, gram, hot=hot, least_words=9)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()]
    assert sorted(found, key=str) == removed(rows, length, 9) != removed(rows, length)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


@pytest.mark.parametrize("hot", [20_000, 3])
def test_two_lengths_in_one_pass_equal_brute_force(spark, hot):
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    base, rows = [make(rng.randint(20, 400)) for _ in range(40)], []
    for key in range(150):
        other, at = rng.choice(base), rng.randint(0, 200)
        text = make(rng.randint(0, 90)) + other[at : at + rng.randint(20, 150)] + make(rng.randint(0, 90))
        rows.append((key, rng.choice(base) if rng.random() < 0.3 else text))
    rows += [(200, None), (201, ""), (202, "a" * 300), (203, "ab" * 50), (204, "Q" + "a" * 45 + "Z"), (None, "a" * 60), (0, rows[1][1]), (0, rows[1][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, CUT_text string").repartition(4)
    for length, words, passage, passage_words in [(80, 0, 30, 5), (30, 0, 80, 9), (60, 4, 60, 0)]:
        out = suffix_dedup.remove_repeats(df, length, 12, hot=hot, least_words=words, passages=(passage, passage_words)).collect()
        found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out]
        whole = removed(rows, length, words)
        assert sorted(found, key=str) == whole
        cut = [(k, spans, text.decode("utf-8", "ignore")) for k, _, _, spans, text in removed(rows, passage, passage_words)]
        assert sorted(((r.doc_id, r.n_passages, r["cut_text"]) for r in out), key=str) == sorted(cut, key=str)
        assert sum(w[2] for w in whole) > 0 and sum(c[1] for c in cut) > 0


def test_long_texts_meet_across_parts_of_an_anchor_run(spark, monkeypatch):
    rng = random.Random(4)
    make = lambda n: bytes(rng.choice(b"abcd ") for _ in range(n))
    shared, texts = make(500), []
    for _ in range(12):
        at, n = rng.randint(0, 300), rng.randint(0, 200)
        texts.append(make(rng.randint(0, 60)) + shared[at : at + n] + make(rng.randint(0, 60)))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    lengths = [20, 45]
    for text in texts:
        served = {length: [] for length in lengths}
        for _, _, places, *offsets in suffix_dedup.anchors(np.frombuffer(text, np.uint8), lengths, 8):
            for length, low, high in zip(lengths, offsets[::2], offsets[1::2]):
                served[length] += [p - o for p, a, b in zip(places.tolist(), low.tolist(), high.tolist()) for o in range(a, b + 1)]
        assert all(sorted(v) == list(range(len(text) - n + 1)) for n, v in served.items())


def test_passages_too_short_for_the_contract_are_cut_in_a_column_of_their_own(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(52, 60))) for _ in range(10)]
    assert all(200 < len(p) < 400 for p in passages)
    planted = {k: passages[k // 2] for k in range(20)}
    rows = [(k, f"{t[:500]} {planted[k]} {t[500:]}" if k in planted else t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).collect()}
    for key, text in rows:
        r = found[key]
        assert (r.n_removed, r.n_spans, r.kept_text) == (0, 0, text)
        assert (planted[key] in r.cut_text, r.n_passages) == (False, 1) if key in planted else (r.cut_text, r.n_passages) == (text, 0)


def test_quicksort_and_blind_tries_sort_suffixes():
    rng = random.Random(5)
    for _ in range(300):
        strings = [b"abab" + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 40))]
        assert [strings[i] for i in suffix_dedup.suffix_order(strings, 4, 8)] == sorted(strings)
        assert [strings[i] for i in suffix_dedup.blind_trie_order(strings, list(range(len(strings))), 4)] == sorted(strings)


def nearest(rows, k):
    usable = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    usable = sorted({(i, tuple(v)) for i, v in usable})
    out = {}
    for query, v in usable:
        if query % 20 == 0:
            near = [(-float(np.dot(np.array(v), np.array(w))), i) for i, w in usable if i != query and len(w) == len(v)]
            out[query] = sorted(near)[:k]
    return out


def test_index_reaches_its_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = nearest([(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()], 20)
    found = collections.defaultdict(list)
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = sum(len({i for _, i in expected[q]} & {i for _, i, _ in found[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for q in expected:
        assert [r for r, _, _ in sorted(found[q])] == list(range(1, 21))


def recall(spark, vectors, asking, **settings):
    """The share of the 20 true neighbours of the rows ``asking`` that the index finds."""
    df = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>").repartition(8)
    found = collections.defaultdict(set)
    for r in ann.nearest_neighbours(df, F.col("vec_id").isin(asking), **settings).collect():
        found[r.query_id].add(r.vec_id)
    scores = vectors[asking] @ vectors.T
    scores[np.arange(len(asking)), asking] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20].tolist()
    return np.mean([len(found[q] & set(b)) / 20 for q, b in zip(asking, best)])


def test_index_reaches_its_recall_in_full_blocks(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(12_000, 64))
    vectors[:4000] = vectors[0] + 0.1 * rng.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    # With 6 posts and 8 probes of 16 files, hardly an entry is in none of the files read.
    assert recall(spark, vectors, list(range(0, 12_000, 150)), pivots=16) >= 0.98


@pytest.mark.parametrize("spread", [0.5, 1.0])
def test_index_reaches_its_recall_on_unequal_lengths(spark, spread):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(6000, 64))
    vectors *= rng.lognormal(0, spread, 6000)[:, None] / np.linalg.norm(vectors, axis=1)[:, None]
    assert recall(spark, vectors, list(range(0, 6000, 40))) >= 0.93


def test_footrule_of_a_block_by_hand():
    orders = np.array([[2, 0], [1, 3], [0, 2]])
    block = ann.Block(np.array([7, 8, 9]), orders, np.array([[1.0], [5.0], [3.0]]), 1, 4)
    asks = np.array([0, 2, 1])  # pivot 3 stands behind the end
    assert block.footrule(np.arange(3), asks).tolist() == [1 + 1, 2 + 2, 0 + 0]
    assert [c.tolist() for c in block.nearest(asks, 0, np.array([1.0]), 2, None)] == [[8, 9], [5.0, 3.0], [1.0, 1 / 3]]
    assert block.nearest(asks, 0, np.array([1.0]), 2, 0.6)[0].tolist() == [9, 7]  # the two nearest by footrule
    assert block.nearest(asks, 1, np.array([1.0]), 2, 0.5)[0].tolist() == [7]  # pivot 0 was read before
    assert block.nearest(asks, -1, np.array([1.0]), 1, 0.1)[0].tolist() == [8]


def test_index_scores_a_small_part_of_what_it_reads(spark, monkeypatch):
    parts = []
    measure = ann.footrule_needed
    monkeypatch.setattr(ann, "footrule_needed", lambda *a: parts.append(measure(*a)) or parts[-1])
    vectors = np.random.default_rng(9).normal(size=(12_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    assert recall(spark, vectors, list(range(0, 12_000, 100))) >= 0.9
    assert len(parts) == 1 and parts[0] < 0.4


def test_queries_far_from_all_that_they_read_lose_no_rows(spark):
    vectors = np.concatenate([np.full((400, 2), 9.0) + np.random.default_rng(8).normal(size=(400, 2)), np.full((40, 2), -0.01)])
    vectors[400:] *= np.arange(1, 41)[:, None]
    assert recall(spark, vectors, list(range(0, 440, 4)), posts=1, probes=1, share=0.0, pivots=16) > 0.0
    df = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    found = ann.nearest_neighbours(df, F.col("vec_id") % 4 == 0, posts=1, probes=1, share=0.0, pivots=16).groupBy("query_id").count().collect()
    assert sorted(map(tuple, found)) == [(k, 20) for k in range(0, 440, 4)]


def test_index_on_ties_bad_vectors_and_few_rows(spark):
    v = lambda *a: [None if x is None else float(x) for x in a]
    rows = [(20 * i, v(1, 2, i % 3)) for i in range(40)] + [(i, v(1, 0, 0)) for i in range(1, 10)] + [(0, v(1, 2, 0))]
    rows += [(100, None), (101, v()), (102, v(0, 0, 0)), (103, v(1, None, 2)), (104, v("nan", 1, 1)), (None, v(1, 1, 1)), (140, v(1, 1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = nearest(rows, 20)
    found = collections.defaultdict(list)
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect():
        found[r.query_id].append((-r.score, r.vec_id))
    assert {q: sorted(f) for q, f in found.items()} == {q: e for q, e in expected.items() if e}
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def shares(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else left * weight[s] / total
        if not over:
            break
        left, open_ = left - sum(target[s] for s in over), open_ - over
    return target


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", "B", "é", None]), " ".join("w" * rng.randint(1, 3) for _ in range(int(rng.lognormvariate(4, 1))))) for k in range(600)]
    rows += [(1000, "tiny", "x y"), (1001, "none", None), (1002, "a", ""), (None, "b", "x y z"), (3, "a", "r r"), (3, "a", "r r")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, size int").repartition(3)
    found = mixing.mix_sources(df).collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix_sources(df.repartition(7)).collect()))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in found:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    target = shares(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 3 for s in target)
    assert len(found) == len(rows)
    again = mixing.repeat_rows(mixing.mix_sources(df), ["doc_id"])
    assert again.count() == sum(r.copies for r in found)
    assert mixing.mix_sources(df.limit(0)).collect() == []


@pytest.mark.parametrize("share", [0.3, 0.55, 0.6, 1.3])
def test_a_dominant_document_does_not_keep_a_source_from_its_target(spark, share):
    rng = random.Random(9)
    cells = [(f"a{name}", rng.randint(5, 200), k % 64, 1) for name in "xy" for k in range(1000)] + [("ax", 400_000, 0, 1)]
    total = collections.Counter()
    cells = [(*k, n) for k, n in collections.Counter(c[:3] for c in cells).items()]
    for key, size, _, n in cells:
        total[key] += n * size
    cells = spark.createDataFrame(cells, "key string, size long, cell long, n long")
    targets = spark.createDataFrame([(k, float(v), share * v) for k, v in total.items()], "key string, source_size double, target double")
    found = mixing.cell_copies(cells, cells.groupBy("key", "size").agg(F.sum("n").alias("n")), targets, 3).collect()
    taken = collections.Counter()
    for r in found:
        assert 0 <= r.copies <= 3 * r.n
        taken[r.key] += r.copies * r["size"]
    most = 3 * (total["ax"] - 400_000)
    for key in total:
        reachable = share * total[key] if key == "ay" or share > 1 else min(share * total[key], most)
        assert abs(taken[key] - reachable) <= 5


def test_url_lists_follow_their_dates(spark):
    entries = [
        ("l1", "Evil.com.", "add", 10), ("l1", "evil.com", "remove", 20), ("l1", "evil.com", "add", 30), ("l1", "evil.com", "add", 30),
        ("l2", "b.evil.com/x/", "add", 5), ("l2", "b.evil.com/x", "remove", 25), ("l3", "com", "add", 40), ("l3", "com", "remove", 40),
        ("l4", None, "add", 1), ("l4", "evil.com", "other", 1), ("l4", "evil.com", "add", None),
    ]
    captures = [
        (1, "https://user@B.evil.com:80/x/y?q", 9), (2, "https://b.evil.com/x/y?q", 10), (3, "http://b.evil.com/xy", 20), (4, "http://evil.com", 35),
        (5, "http://notevil.com/", 35), (6, None, 35), (7, "nonsense", 35), (8, "http://a.com/", 41), (9, "http://evil.com", None), (4, "http://evil.com", 35),
    ]
    df = spark.createDataFrame([(*c, "z", 1) for c in captures], "page_id long, url string, fetched_at int, pattern string, _id int")
    listed = spark.createDataFrame(entries, "list string, pattern string, action string, at int")
    found = {r.page_id: (r.blocked, list(r.lists), r.pattern) for r in url_lists.evaluate_captures(df, listed).collect()}
    assert found[1] == (True, ["l2"], "b.evil.com/x") and found[2] == (True, ["l1", "l2"], "b.evil.com/x")
    assert found[4] == (True, ["l1"], "evil.com")
    assert all(found[k] == (False, [], None) for k in (3, 5, 6, 7, 8, 9))
    assert url_lists.evaluate_captures(df, listed.limit(0)).filter("blocked").count() == 0
    assert url_lists.evaluate_captures(df.limit(0), listed).count() == 0


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in entry_points.queries() and set(queries.TWINS) <= set(queries.QUERIES)


def test_join_and_removal_queries_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op1_ngram_join"](spark, SF).collect()
    assert sorted(map(tuple, found)) == similar_groups(rows, 85, 100, 4)
    found = queries.QUERIES["op7_suffix_dedup"](spark, SF).collect()
    expected = [(k, n, gone, spans, hashlib.sha256(kept).hexdigest()) for k, n, gone, spans, kept in removed(rows, 400)]
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(expected, key=str)
    texts = {k: kept.decode("utf-8", "ignore") for k, _, _, _, kept in removed(rows, 400)}
    assert {r.doc_id: r.kept_text for r in found} == texts


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_equals_sql_in_llm(spark, name):
    sf_dir = os.environ.get("ORACLE_SF_DIR", SF)
    assert differences(spark, connect(sf_dir), name, queries.QUERIES[name], queries.TWINS[name], sf_dir) is None


def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, SF)
    measured = {r.doc_id: r for r in queries.QUERIES["op5_quality_rules"](spark, SF).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {k for k, r in measured.items() if r.kept}
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    single = stages["n-gram Jaccard join"](spark, kept, SF)
    assert sorted(r[0] for r in single.select("doc_id").collect()) == [k for k, _, c in similar_groups(rows, 80, 100, 5) if k == c]
    rows = [tuple(r) for r in single.select("doc_id", "text").collect()]
    cut = stages["suffix-array dedup"](spark, single, SF)
    expected = {k: text.decode("utf-8", "ignore") for k, _, _, _, text in removed(rows, 200, 50)}
    found = {r.doc_id: r for r in cut.collect()}
    assert {k: r.text for k, r in found.items()} == {k: t for k, t in expected.items() if t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in found.values())
    mixed = stages["mixing sources to target weights"](spark, cut, SF)
    times = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(times.values()) <= 3 and set(times) <= set(found)
    assert all(d.columns == columns for d in (kept, single, cut, mixed))
    out = stages["BPE encoding and decoding"](spark, mixed, SF)
    assert out.filter("NOT round_trip").count() == 0 and out.count() == sum(times.values())


def test_pipeline_stages_keep_columns_that_operators_also_make(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["size", "target", "copies", "kept", "n_words", "n_removed"]
    own = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    stages = dict(corpus_pipeline.STAGES)
    for stage in ("quality rules", "suffix-array dedup", "mixing sources to target weights"):
        out = stages[stage](spark, own, SF)
        assert out.columns == own.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)


def test_a_pattern_with_many_dates_is_searched_not_compared(spark):
    rng = np.random.default_rng(3)
    times = np.unique(rng.integers(0, 10_000, 2_000)).tolist()
    entries = [(f"l{k % 2}", "a.com", "remove" if rng.random() < 0.5 else "add", t) for k, t in enumerate(times)]
    captures = [(k, "http://a.com/x", int(t)) for k, t in enumerate(rng.integers(-5, 10_010, 300))]
    df, listed = spark.createDataFrame(captures, "page_id long, url string, fetched_at int"), spark.createDataFrame(entries, "list string, pattern string, action string, at int")
    evaluated = url_lists.evaluate_captures(df, listed)
    for key, _, at in captures:
        last = {name: max((t, action) for n, _, action, t in entries if n == name and t <= at)[1] for name in ("l0", "l1") if any(n == name and t <= at for n, _, _, t in entries)}
        captures[key] = (key, sorted(n for n, action in last.items() if action == "add"))
    assert sorted((r.page_id, list(r.lists)) for r in evaluated.select("page_id", "lists").collect()) == captures
    # One row for each list and pattern is joined, so a capture is not copied for each date.
    joined = evaluated._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in joined


def test_samples_join_near_copies_at_a_fixed_number_of_rows(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 400)]
    texts = []
    for k in range(40):
        copy = list(words)
        copy[int(rng.integers(0, 400))] = f"x{k}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = ngram_join.set_keys(df.withColumnRenamed("doc_id", "id"), "text", 4)
    edges = ngram_join.sample_edges(keyed).collect()
    assert 0 < len(edges) <= 40 * ngram_join.SAMPLES
    groups = components.components(ngram_join.sample_edges(keyed)).collect()
    assert len({r.component for r in groups}) == 1
    assert {r.component_id for r in ngram_join.link_documents(df).collect()} == {0}
    tiny = [len(ngram_join.sample_keys(np.arange(n, dtype=np.uint64))) for n in (1, 2, 3)]
    assert all(1 <= n <= ngram_join.SAMPLES for n in tiny)


def test_shared_lines_make_no_candidates(spark):
    rng = np.random.default_rng(7)
    lines = [" ".join(f"line{k}w{w}" for w in range(14)) for k in range(6)]
    texts = []
    for k in range(300):
        own = [f"w{w}" for w in rng.integers(0, 10**6, 45)]
        texts.append("\n".join([" ".join(own[:20]), *rng.permutation(lines)[:3], " ".join(own[20:])]))
    copies = [texts[0].replace("w", "W", 1), texts[0] + " more", texts[9] + " or less"]
    rows = [(k, k, False, t) for k, t in enumerate(texts + copies)]
    df = spark.createDataFrame(rows, "id long, group long, many boolean, text string").repartition(4)
    edges = ngram_join.candidate_edges(df, ngram_join.Similarity(85, 100), 4, 3).collect()
    assert {tuple(sorted(e)) for e in edges} <= {(0, 300), (0, 301), (300, 301), (9, 302)}
    linked = ngram_join.link_documents(df.select(df["id"].alias("doc_id"), "text")).collect()
    assert {(r.doc_id, r.component_id) for r in linked if r.doc_id != r.component_id} == {(300, 0), (301, 0), (302, 9)}


def test_what_similar_sets_show_has_a_common_element():
    rng = np.random.default_rng(2)
    for similarity in (ngram_join.Similarity(85, 100), ngram_join.Similarity(80, 100), ngram_join.Similarity(1, 2)):
        for _ in range(2000):
            a = rng.permutation(1000)[: rng.integers(1, 60)]
            b = np.concatenate([a[rng.integers(0, len(a) // 4 + 1) :], 1000 + np.arange(rng.integers(0, len(a) // 4 + 1))])
            if similarity.linked(len(np.intersect1d(a, b)), len(a), len(b)) and set(a) != set(b):
                order = rng.permutation(2000)
                first = [set(s[np.argsort(order[s])][: similarity.prefix(len(s))].tolist()) for s in (a, b)]
                assert first[0] & first[1] and all(similarity.has_others(len(s)) for s in (a, b))


def test_documents_of_several_texts_join_what_each_is_similar_to(spark):
    rng = np.random.default_rng(3)
    one, two = (" ".join(f"w{k}" for k in rng.integers(0, 10**6, 90)) for _ in range(2))
    rows = [(2, one), (5, one), (5, two), (5, two), (7, two + " end"), (7, two + " end"), (9, "far away from all of these")]
    found = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(2, 2), (5, 2), (5, 2), (5, 2), (7, 2), (7, 2), (9, 9)]


def test_shingles_of_many_texts_equal_those_of_each():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 5, n).astype(np.uint64) for n in [0, 1, 2, 3, 4, 5, 0, 40, 3, 0]]
    for width in (1, 3, 4):
        found = hashing.shingle_sets(words, width)
        alone = [hashing.shingle_sets([w], width)[0] for w in words]
        runs = [{tuple(w[k : k + width].tolist()) for k in range(max(1, len(w) - width + 1)) if len(w)} for w in words]
        assert [len(f) for f in found] == [len(r) for r in runs]
        assert all(np.array_equal(a, b) and (a[1:] > a[:-1]).all() for a, b in zip(found, alone))
    assert hashing.shingle_sets([], 4) == []
