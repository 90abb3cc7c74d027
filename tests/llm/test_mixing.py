import pytest
from pyspark.sql import functions as F

from laserfold.llm import mixing, tokens
from tests.llm.data import PATH, awkward, documents, prose

def levels():
    return {"lang": F.col("lang"), "source": F.col("source")}


def rows(n=240):
    return [
        (i, prose(20 + i % 30, i), "en" if i % 4 else "de", ("hot", "hot", "b", "c")[i * 7 % 4], 0)
        for i in range(n)
    ]


def test_budgets_go_to_siblings_first():
    leaves = {("x", "a"): 100, ("x", "b"): 1000, ("y", "c"): 10, ("y", "d"): 10_000}
    weights = {("x",): 0.5, ("y",): 0.5, ("x", "a"): 0.5, ("x", "b"): 0.5}
    weights |= {("y", "c"): 0.5, ("y", "d"): 0.5}
    got = mixing.budgets(leaves, 1000, weights, 1)
    assert got == {("x", "a"): 100, ("x", "b"): 400, ("y", "c"): 10, ("y", "d"): 490}
    # x is full as a whole, so its ancestor gives the rest to y.
    got = mixing.budgets(leaves, 4000, weights, 1)
    assert got == {("x", "a"): 100, ("x", "b"): 1000, ("y", "c"): 10, ("y", "d"): 2890}
    assert sum(mixing.budgets(leaves, 10**9, weights, 2).values()) == 2 * sum(leaves.values())
    assert mixing.budgets({("x",): 0, (None,): 5}, 3, {("x",): 1.0}, 1) == {("x",): 0, (None,): 3}
    assert mixing.budgets({}, 5, {}, 1) == {}


@pytest.mark.parametrize(("share", "epochs"), [(0.5, 1), (0.9, 3), (1.0, 1), (0.0, 1)])
def test_selection_equals_a_plain_prefix(spark, share, epochs):
    docs = documents(spark, rows())
    weights = {("de",): 0.5, ("en",): 0.5, ("de", "b"): 0.8}
    options = dict(path=PATH, share=share, weights=weights, max_epochs=epochs)
    got = mixing.select(docs, levels(), **options).select("doc_id", "lang", "source", "epoch").collect()
    encoder = tokens.encoder(PATH)
    sizes = {r[0]: encoder.count(r[1]) for r in rows()}
    leaves = {}
    for r in rows():
        leaves.setdefault((r[2], r[3]), []).append(r[0])
    totals = {p: sum(sizes[d] for d in own) for p, own in leaves.items()}
    given = mixing.budgets(totals, int(sum(totals.values()) * share), weights, epochs)
    draws = {
        e: {
            r["doc_id"]: r["draw"]
            for r in docs.select(
                "doc_id", mixing._draw(F.lit(e).cast("bigint"), mixing._base(docs, "text"), mixing.SEED).alias("draw")
            ).collect()
        }
        for e in range(1, epochs + 2)
    }
    want = set()
    for path, own in leaves.items():
        whole, left = divmod(given[path], totals[path])
        want |= {(d, e) for d in own for e in range(1, whole + 1)}
        for d in sorted(own, key=draws[whole + 1].get):
            if sizes[d] > left:
                break
            left -= sizes[d]
            want.add((d, whole + 1))
    assert {(r.doc_id, r.epoch) for r in got} == want and len(got) == len(want)


def test_awkward_rows(spark):
    docs = documents(spark)
    everything = mixing.select(docs, levels(), path=PATH)
    assert set(everything.columns) == set(docs.columns) and everything.count() == len(awkward())
    half = mixing.select(docs, levels(), path=PATH, budget=500).drop("epoch").collect()
    assert sum(tokens.encoder(PATH).count(r.text or "") for r in half) <= 500
    assert mixing.select(documents(spark, []), levels(), path=PATH).count() == 0


def test_equal_rows_go_together(spark):
    same = [(1, prose(30, 1), "en", "a", 0)] * 6 + [(2, prose(30, 2), "en", "a", 0)]
    for budget in (40, 100, 10**4):
        ids = [r.doc_id for r in mixing.select(documents(spark, same), levels(), path=PATH, budget=budget).collect()]
        assert ids.count(1) in (0, 6)


def test_whole_budget_takes_every_document(spark):
    options = dict(path=PATH, share=None, weights={("de",): 0.5, ("en",): 0.5, ("de", "b"): 0.8})
    got = mixing.select(documents(spark, rows()), levels(), max_epochs=2, **options).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows()}
    assert max(r.epoch for r in got) == 2
    assert mixing.whole_budget({("x",): 100, ("y",): 10}, {("x",): 0.5, ("y",): 0.5}) >= 200
    assert mixing.whole_budget({}, {}) == 0 and mixing.whole_budget({("x",): 0}, {}) == 0


def test_columns_called_like_helpers_pass_through(spark):
    names = ["_bits", "_epochs", "_prefix", "_draw", "_taken", "_base", "_level_0", "_row", "_level_0_of"]
    docs = documents(spark, rows(), clashing=False).withColumns({n: F.lit("own") for n in names})
    got = mixing.select(docs, levels(), path=PATH, share=0.5).collect()
    assert got and all(r[n] == "own" for r in got for n in names)
