"""Vector-approximation files, hard negatives and conversation repair against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import conversations, hard_negatives, queries, vector_file, vectors

VECTORS = "vec_id long, embedding array<float>, label int, dims string, Score string"


def whole(vector):
    if vector is None or not len(vector) or any(x is None or not math.isfinite(x) for x in vector):
        return None
    big = 1 << 26
    return [int(max(-big, min(big, math.floor(256 * float(np.float32(x)))))) for x in vector]


def vector_rows(seed, n=400, size=8):
    """Clusters, a vector that a third of the rows share, long ones, repeated ids, and vectors that take no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        vector = centres[0] if i % 3 == 0 else [c + rng.gauss(0, rng.choice([0.01, 0.3])) for c in centre]
        if i % 41 == 0:
            vector = [20 * x for x in vector]
        if i % 37 == 0:
            vector = vector[:3]
        rows.append([i, vector, i % 4 if i % 5 else 1])
    rows += [[None, centres[1], 1], [700, None, 1], [800, [1.0, None] * 4, 1], [900, [float("nan")] * 8, 2], [1000, [float("inf")] * 8, 2]]
    rows += [[1100, [], 1], [1200, [0.0] * 8, 3], [1300, [3e30, -3e30] * 4, 2], [1400, centres[2], None], list(rows[100]), [100, centres[3], 0]]
    rng.shuffle(rows)
    return [(*r, "x", "y") for r in rows]


def one_of_each(rows, labelled):
    best = {}
    for key, vector, label, *_ in rows:
        made = whole(vector)
        if key is not None and made is not None and (label is not None or not labelled):
            entry = (label if labelled else 0, made)
            best[key] = min(best.get(key, entry), entry)
    return best


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.fixture
def small_blocks(monkeypatch):
    for module in (vector_file, hard_negatives):
        monkeypatch.setattr(module, "BLOCK_ROWS", 30)
        monkeypatch.setattr(module, "GROUP_ROWS", 3)
    monkeypatch.setattr(vectors, "STRIP_BLOCKS", 4)


def test_top_products_equal_brute_force(spark, small_blocks):
    rows = vector_rows(1)
    found = vector_file.top_products(spark.createDataFrame(rows, VECTORS).repartition(5), F.col("vec_id") % 50 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    data, expected = one_of_each(rows, False), []
    for key, (_, vector) in data.items():
        if key % 50 == 0:
            near = sorted((-product(vector, v), k) for k, (_, v) in data.items() if k != key and len(v) == len(vector))
            expected += [(key, i + 1, k, -s) for i, (s, k) in enumerate(near[:5])]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_top_products_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_file.top_products(empty, F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives.mine_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0], 1, "", ""), (5, [2.0], 1, "", ""), (6, [2.0, 1.0], 2, "", "")], VECTORS)
    assert [tuple(r) for r in vector_file.top_products(two, F.col("vec_id") == 0).collect()] == [(0, 1, 5, 256 * 512)]
    renamed = two.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    assert [tuple(r) for r in vector_file.top_products(renamed, F.col("id") == 0, row_id="id", vector="vector").collect()] == [(0, 1, 5, 256 * 512)]
    assert hard_negatives.mine_negatives(two, F.col("vec_id") % 100 == 0).collect() == []


def test_cells_bound_products_and_spare_reading():
    rng = np.random.default_rng(2)
    plain = np.floor(rng.normal(0, 32, (4000, 64))).astype(np.int32)
    long = plain * np.where(rng.random((4000, 1)) < 0.05, 50, 1).astype(np.int32)
    equal = np.repeat(plain[:40], 100, axis=0)
    huge = np.full((5, 64), vectors.LARGEST, dtype=np.int32)
    for matrix in (plain, long, equal, huge, plain[:1], np.zeros((3, 2), np.int32)):
        file = vector_file.VectorFile(np.arange(len(matrix)), matrix, vector_file.approximate(matrix))
        low, high = file.bounds(matrix[:7])
        exact = vectors.exact_products(matrix[:7], matrix)
        assert (low <= exact).all() and (exact <= high).all()
    file = vector_file.VectorFile(np.arange(4000), plain, vector_file.approximate(plain))
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * 50
    file.search(plain[:50], best, 6)
    assert file.read < 50 * 4000 * 0.02  # exact vectors are read for few candidates only
    for query, (scores, ids) in zip(plain, best):
        exact = vectors.exact_products(plain, query[None])[:, 0]
        assert ids.tolist() == np.lexsort((np.arange(4000), -exact))[:6].tolist()


def test_negatives_equal_brute_force(spark, small_blocks):
    rows = vector_rows(3)
    found = hard_negatives.mine_negatives(spark.createDataFrame(rows, VECTORS).repartition(5), F.col("vec_id") % 10 == 0)
    data, expected = one_of_each(rows, True), []
    for anchor, (label, vector) in data.items():
        if anchor % 10 == 0:
            scores = sorted((-product(vector, v), k, lab) for k, (lab, v) in data.items() if k != anchor and len(v) == len(vector))
            for s, positive, _ in [x for x in scores if x[2] == label][:5]:
                inside = [(t, k) for t, k, lab in scores if lab != label and 80 * -s <= 100 * -t <= 100 * -s]
                expected += [(anchor, positive, i + 1, k, -s, -t) for i, (t, k) in enumerate(inside[:5])]
    assert len(expected) > 300
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_tree_spans_and_its_bounds_spare_rescoring():
    rng = np.random.default_rng(4)
    anchors = np.repeat(rng.normal(0, 300, (4, 16)), 25, axis=0) + rng.normal(0, 1, (100, 16))
    anchors = anchors.astype(np.int32)
    tree = hard_negatives.spanning_tree(anchors)
    assert sorted(v for v, _, _ in tree) == list(range(100)) and [p for _, p, _ in tree].count(-1) == 1
    seen = set()
    for vertex, parent, length in tree:
        assert parent in seen or parent == -1
        assert parent == -1 or length == pytest.approx(np.linalg.norm(anchors[vertex] - anchors[parent].astype(float)))
        seen.add(vertex)
    away = np.linalg.norm(anchors[:, None].astype(float) - anchors[None], axis=2)
    inside, total = {0}, 0.0
    while len(inside) < 100:  # the least total length, by the plain definition
        length, new = min((away[a, b], b) for a in inside for b in set(range(100)) - inside)
        inside.add(new)
        total += length
    assert sum(length for _, _, length in tree) == pytest.approx(total)

    group = hard_negatives.AnchorTree(np.arange(100), np.zeros(100, np.int64), anchors)
    matrix = rng.normal(0, 300, (3000, 16)).astype(np.int32)
    exact = vectors.exact_products(matrix, anchors)

    def wanted(anchor, low, high, rescore):
        assert (low <= exact[:, anchor]).all() and (exact[:, anchor] <= high).all()
        top = np.sort(exact[:, anchor])[-5]
        rescore(np.flatnonzero(high >= top))

    group.walk(matrix, wanted)
    assert group.rescored < 0.2 * 100 * 3000


def plain_repair(symbols):
    """Least (cost, audit) by a search in that order over whole audits."""
    moves, heap, done = {0: 2, 1: 2, 3: 2, 2: 3}, [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        heapq.heappush(heap, (cost + 2, audit + "I", i, moves[state]))
        if i < len(symbols):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            c = symbols[i]
            if c != "d":
                extra = int(c.isupper())
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(c.lower(), {}).get(state)
                if kept is not None:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kept))
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, moves[state]))


def test_cheapest_audits_equal_brute_force():
    for n in range(5):
        for symbols in map("".join, itertools.product("suaxdUA", repeat=n)):
            assert conversations.cheapest(symbols) == plain_repair(symbols), symbols
    rng = random.Random(5)
    for _ in range(300):
        symbols = "".join(rng.choice("suaxdSUAX") for _ in range(rng.randint(5, 40)))
        assert conversations.cheapest(symbols) == plain_repair(symbols), symbols


def plain_report(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in rows]
    symbols = "".join("d" if k in ("blank", "duplicate") else c.upper() if k else c for k, c in zip(kinds, initials))
    cost, audit = plain_repair(symbols)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    said, i, begun = [], 0, 0
    for edit in audit:
        if edit == "I":
            said.append(["", ""])
        else:
            if edit != "D":
                said.append([rows[i][1] if edit == "K" else "", rows[i][2]])
                begun += edit == "K" and initials[i] == "s"
            i += 1
    lines = [f"{r or ('user' if (k - begun) % 2 == 0 else 'assistant')}:{x}" for k, (r, x) in enumerate(said)]
    kind = lambda name: kinds.count(name)
    return gaps, kind("blank"), kind("duplicate"), kind("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talks(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why?", "é!\n", "a.b", None, "long " * 3000 + "."]
    roles = ["user", "assistant", "system", "User", "", None, "tool", "um"]
    rows = []
    for conv in [None, *range(40)]:
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, t, t, t + 5, None, -1])
            role = roles[t % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"said {t}." if rng.random() < 0.6 else rng.choice(texts)
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows + [(77, t % 60, roles[t % 3 % 2], f"{t % 50}" + ".!x"[t % 3]) for t in range(300)]


@pytest.mark.parametrize("segment", [64, 3, 1])
def test_repairs_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment)
    rows = talks(6)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, k string, Audit string")
    reports, turns = conversations.repair(df.repartition(3))
    said = {r["k"]: r["repaired_sha256"] for r in conversations.joined_digests(turns).collect()}
    none = hashlib.sha256(b"").hexdigest()
    found = {r["conv_id"]: (*r[2:], said.get(r["k"], none)) for r in reports.collect()}
    by_id = {}
    for conv, *row in rows:
        by_id.setdefault(conv, []).append(row)
    assert found == {conv: plain_report(some) for conv, some in by_id.items()}


def test_repair_of_odd_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports, turns = conversations.repair(empty)
    assert reports.collect() == [] and turns.collect() == [] and conversations.joined_digests(turns).collect() == []
    one = spark.createDataFrame([("c", None, None, None)], "conv_id string, turn int, role string, text string")
    assert [tuple(r)[1:] for r in conversations.repair(one)[0].collect()] == [("c", 0, 1, 0, 0, 0, 3, "D")]


def test_every_conversation_is_reported(spark, tmp_path):
    """A conversation that the damage empties has a row of zeros."""
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 9)
    rows = [(dropped, 0, "user", "Hi."), (kept, 0, "user", "Hi."), (None, None, "user", "Hi.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["conv_id"]: r for r in queries.op11_repair_conversations(spark, str(tmp_path)).collect()}
    assert set(found) == {dropped, kept, None}
    assert found[dropped]["audit"] == "" and found[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[kept]["audit"] == "KI" and found[kept]["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()
