"""The prefix forest against brute force."""

import random

import numpy as np
import pytest

from laserfold.llm import prefix_forest as forest

DDL = "vec_id bigint, embedding array<double>, label int, key string, ids string, hash int, level int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", "i", 1, 2) for i, v in rows], DDL).repartition(3)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, every, k=forest.K):
    """query -> list of its (score, id) in order, one list per query row."""
    found = []
    for at, (i, v) in enumerate(rows):
        if i is None or i % every or not usable(v):
            continue
        others = [
            (-float(np.dot(np.array(v, float), np.array(w, float))), j is None, j or 0)
            for o, (j, w) in enumerate(rows)
            if o != at and usable(w) and len(w) == len(v)
        ]
        found.append((i, [(-s, None if null else j) for s, null, j in sorted(others)[:k]]))
    return found


def answers(df):
    rows = sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"]))
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return found


def recall(got, want):
    hits = total = 0
    for query, near in want:
        own = {i for _, i in got[query]}
        hits += sum(i in own for _, i in near)
        total += len(near)
    return hits / total


def clustered(n, width, seed, spread=0.35, long=False):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    x = centres[draw.integers(0, 12, n) * (draw.random(n) < 0.7)] + spread * draw.normal(size=(n, width))
    if long:
        x *= draw.exponential(1, (n, 1))
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("long", [False, True])
def test_recall_and_scores(spark, long):
    rows = clustered(3000, 24, 4, long=long)
    got = answers(forest.search(table(spark, rows), every=50, range_points=256))
    want = brute(rows, 50)
    assert recall(got, want) >= 0.9
    vectors = dict(rows)
    for query, near in got.items():
        assert len(near) == forest.K
        assert near == sorted(near, key=lambda x: (-x[0], x[1])) and query not in {i for _, i in near}
        for score, i in near:
            assert abs(score - float(np.dot(vectors[query], vectors[i]))) < 1e-9


def test_given_vectors(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = answers(forest.search(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), every=20, range_points=128))
    want = brute(rows, 20)
    assert set(got) == {q for q, _ in want} and recall(got, want) >= 0.9


def test_fewer_points_than_wanted_are_all_found(spark):
    rows = [(i, [float(i % 5 - 2), 1.0, 0.5 * i]) for i in range(12)] + [
        (40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [float("nan"), 1.0, 1.0]),
        (140, [float("inf"), 1.0, 1.0]), (160, [1.0, 2.0]), (180, [-1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
        (200, [3.0]), (220, [1e200, 0.0, 1e200]),
    ]
    got = answers(forest.search(table(spark, rows), every=20))
    want = {q: near for q, near in brute(rows, 20) if near}
    assert got == want


def test_copies_and_ties(spark):
    """A group of copies larger than a result; ties go to smaller ids, its own row stays out."""
    rows = [(i, [1.0, 0.0]) for i in range(100)] + [(1000 + i, [0.0, 1.0]) for i in range(30)]
    rows += [(None, [1.0, 0.0]), (5000, [-0.0, 1.0])]
    draw = random.Random(2)
    draw.shuffle(rows)
    got = answers(forest.search(table(spark, rows), every=20))
    for query, near in brute(rows, 20):
        assert got[query] == near


def test_repeated_rows_are_queries_and_candidates(spark):
    rows = [(0, [1.0, 2.0])] * 2 + [(1, [1.0, 2.0]), (2, [0.5, 0.5])]
    found = sorted(map(tuple, forest.search(table(spark, rows), every=20).collect()))
    each = [(0, 1, 0, 5.0), (0, 2, 1, 5.0), (0, 3, 2, 1.5)]
    assert found == sorted(each * 2)


def test_hot_range_is_split(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_POINTS", 64)
    monkeypatch.setattr(forest, "BLOCK_QUERIES", 8)
    rows = clustered(900, 8, 6, spread=0.05)
    got = answers(forest.search(table(spark, rows), every=10, range_points=64))
    assert recall(got, brute(rows, 10)) >= 0.9


def test_longest_matches_and_ascent():
    strings = np.array([0b0000, 0b0011, 0b0100, 0b0101, 0b1111])
    low, high = forest._slices(strings, np.array([0b0101, 0b0101, 0b0001]), np.array([2, 4, 2]), 4)
    assert low.tolist() == [2, 3, 0] and high.tolist() == [4, 4, 2]
    held = {"a": {0: 40, 1: 20, 2: 8, 3: 2}}
    # Prefixes of the true neighbours: three quarters share two bits or more.
    assert forest.enough(held, {"a": [2, 3, 2, 1]}, 2, 0.75) <= 8
    assert 8 < forest.enough(held, {"a": [2, 3, 2, 1]}, 2, 1.0) <= 20


def test_empty_table(spark):
    assert forest.search(table(spark, []), every=20).count() == 0
    assert forest.search(table(spark, [(1, [1.0])]), every=20).count() == 0
