import random

import numpy as np
import pytest

from laserfold.llm import jaccard_join, stars, vector_dedup
from tests.llm.data import awkward, documents, prose


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_stars_equal_union_find(spark):
    draw = random.Random(2)
    links = [(f"{draw.randint(0, 300):03}", f"{draw.randint(0, 300):03}") for _ in range(250)]
    links += [(f"p{i:03}", f"p{i + 1:03}") for i in range(70)]
    want = components({n for x in links for n in x}, links)
    want = {n: r for n, r in want.items() if any(n in x and x[0] != x[1] for x in links)}
    got = stars.labels(spark.createDataFrame(links, "hi string, lo string")).collect()
    assert {r.key: r.root for r in got} == want and len(got) == len(want)


def test_stars_of_no_edges(spark):
    assert stars.labels(spark.createDataFrame([], "hi string, lo string")).count() == 0


def near_rows():
    draw = random.Random(4)
    rows = []
    for group in range(6):
        base = prose(150, 50 + group).split()
        for copy in range(9):
            words = list(base)
            for _ in range(copy % 5):
                words[draw.randrange(len(words))] = f"w{draw.randint(0, 99)}"
            rows.append((group * 100 + copy, " ".join(words), "en", "a", 0))
    passage = prose(60, 99)
    rows += [(900 + i, f"{prose(100, 200 + i)} {passage}", "en", "a", 0) for i in range(20)]
    return rows


def brute(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] | sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    return links, components(sets, links)


@pytest.mark.parametrize("block", [512, 3])
def test_join_equals_brute_force(spark, block):
    rows = near_rows()
    got = jaccard_join.join(documents(spark, rows), block=block).collect()
    links, root = brute(rows)
    assert {r.doc_id: r.class_id for r in got} == root
    assert {r.doc_id: r.n_links for r in got} == {d: sum(d in x for x in links) for d in root}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_bands_reach_the_recall():
    for rows in (4, 8):
        bands = jaccard_join.bands_for(0.8, 0.999, rows)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_join_of_awkward_rows(spark):
    got = jaccard_join.join(documents(spark)).collect()
    assert len(got) == len(awkward())
    by_id = {}
    for row in got:
        by_id.setdefault(row.doc_id, []).append(row)
    assert [r.n_links for r in by_id[2]] == [2, 2] and by_id[1][0].n_links == 2
    assert {r.class_id for r in by_id[1] + by_id[2]} == {1}
    assert by_id[8][0].class_id == 7 and not by_id[8][0].kept
    for empty in (3, 4, 5):
        assert by_id[empty][0].kept and by_id[empty][0].n_links == 0
    assert all(r.kept and r.n_links == 0 for r in by_id[None])
    assert by_id[9][0].kept


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = jaccard_join.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-5, 1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert ids.count(None) == 2
    assert jaccard_join.deduplicate(documents(spark, [])).count() == 0


def test_repeats_of_the_representative_go(spark):
    near = prose(200, 31).split()
    texts = {"a": prose(90, 32), "b": prose(90, 33), "n": " ".join(near), "m": " ".join([*near[:99], "new", *near[100:]])}
    rows = [(1, texts["a"], "en", "x", 0)] * 40 + [(2, texts["a"], "en", "y", 0)]
    rows += [(3, texts["n"], "en", "x", 0)] * 2 + [(3, texts["m"], "en", "x", 0)] * 2
    rows += [(None, texts["b"], "en", "x", 0)] * 3
    rows += [(None, texts["b"] + " " + w, "en", "x", 0) for w in ("one", "two")]
    rows += [(4, "", "en", "x", 0)] * 2 + [(None, "", "en", "x", 0)] * 2 + [(5, prose(90, 34), "en", "x", 0)]
    got = jaccard_join.deduplicate(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [1, 3, 4, 5]
    loose = [r.text for r in got if r.doc_id is None]
    assert len(loose) == 3 and loose.count("") == 2
    assert {str(tuple(r)[:5]) for r in got} <= {str(r) for r in rows}


def vectors():
    draw = np.random.default_rng(5)
    rows = []
    centres = draw.normal(size=(12, 16))
    for i in range(240):
        x = centres[i % 12] + draw.normal(size=16) * (0.05 if i % 3 else 0.6)
        rows.append((1000 - i, [float(v) for v in x.astype(np.float32)], i % 5))
    rows.append((5000, rows[0][1], 1))
    rows.append((5001, [2 * v for v in rows[0][1]], 1))
    return rows


def odd_vectors():
    return [
        (1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [float("nan")] + [1.0] * 15, 0),
        (5, [float("inf")] + [1.0] * 15, 0), (6, [None] + [1.0] * 15, 0), (7, [1.0, 2.0], 0),
        (None, [1.0] * 16, None), (None, [1.0] * 16, None), (8, [1e30] * 16, 0),
    ]


DDL = "vec_id bigint, embedding array<float>, label int, kept string, key string, n_links string"


@pytest.mark.parametrize(("cell_rows", "block", "spread"), [(2000, 1024, 3.0), (10, 7, None)])
def test_vectors_equal_brute_force(spark, cell_rows, block, spread):
    rows = vectors()
    table = spark.createDataFrame([(*r, "k", "y", "n") for r in rows + odd_vectors()], DDL)
    got = vector_dedup.link(table, cell_rows=cell_rows, block=block, spread=spread).collect()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [r[0] for r in rows]
    close = x @ x.T >= 0.9
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(close), strict=True) if i != j]
    root = components(ids, links)
    found = {r.vec_id: r for r in got if r.vec_id is not None and r.vec_id > 8}
    assert {i: r.component_id for i, r in found.items()} == root
    assert {i: r.n_links for i, r in found.items()} == {i: sum(a == i for a, _ in links) for i in ids}
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    odd = {r.vec_id: r for r in got if r.vec_id in range(1, 8)}
    assert len(got) == len(rows) + len(odd_vectors()) and len(odd) == 7
    assert all(r.n_links == 0 and r.kept and r.component_id == i for i, r in odd.items())
    loose = [r for r in got if r.vec_id is None]
    assert [(r.n_links, r.component_id, r.kept) for r in loose] == [(2, 8, False)] * 2
    assert len({str(r) for r in got if r.vec_id == 8 and r.n_links == 2 and r.kept}) == 1


def test_default_search_over_many_cells_is_exact(spark):
    # Variance that decays over the dimensions: differences point along the main axes.
    draw = np.random.default_rng(11)
    scale = np.arange(1, 33) ** -1.0
    x = (draw.normal(size=(600, 32)) * scale).astype(np.float32)
    table = spark.createDataFrame(
        [(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<float>"
    )
    got = vector_dedup.link(table, cell_rows=30, block=16).collect()
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    root = components(range(600), zip(*np.nonzero(close), strict=True))
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(close.sum(1).tolist()))
    assert {r.vec_id: r.component_id for r in got} == root


def test_every_dimension_and_every_finite_double_links(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(v) for v in draw.normal(size=2 + i % 3)]) for i in range(240)]
    rows += [(1000 + i, rows[5][1]) for i in range(2)]  # copies in a dimension
    rows += [(2000, [1e300, 1.0]), (2001, [1e300, 1.0]), (2002, [5e299, -3.0]), (2003, [1e-310, 0.0])]
    rows += [(3000, [1.0] * 9), (3001, [2.0] * 9), (3002, [1.0] * 8)]  # dimensions of few vectors
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = vector_dedup.link(table, cell_rows=30, block=16).collect()

    def unit(v):
        x = np.array(v) / max(map(abs, v))
        return x / np.linalg.norm(x)

    links = [
        (a, b) for a, x in rows for b, y in rows if a != b and len(x) == len(y) and unit(x) @ unit(y) >= 0.9
    ]
    assert {r.vec_id: r.n_links for r in got} == {i: sum(a == i for a, _ in links) for i, _ in rows}
    assert {r.vec_id: r.component_id for r in got} == components([i for i, _ in rows], links)


def test_tables_without_usable_vectors(spark):
    table = spark.createDataFrame([(*r, "k", "y", "n") for r in odd_vectors()[:6]], DDL)
    assert all(r.kept and r.n_links == 0 for r in vector_dedup.link(table).collect())
    assert vector_dedup.link(table.where("false")).count() == 0


def test_deduplicate_passes_columns_called_like_helpers(spark):
    from pyspark.sql import functions as F

    from laserfold.llm import jaccard_join
    from tests.llm.data import documents, prose

    same = [(1, prose(60, 1), "en", "a", 0)] * 3 + [(2, prose(60, 1), "en", "a", 0), (3, prose(60, 2), "en", "a", 0)]
    names = ["kept_id", "kept_key", "repeated", "row", "_kept_id", "_kept_key"]
    docs = documents(spark, same, clashing=False).withColumns({n: F.lit("own") for n in names})
    got = jaccard_join.deduplicate(docs).collect()
    assert sorted(r.doc_id for r in got) == [1, 3] and all(r[n] == "own" for r in got for n in names)
