import re
import zlib

import numpy as np
import pytest

from laserfold.llm import quality_gam, quality_rules
from tests.llm.data import awkward, documents, prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 1000 else None
    if twice is None:
        seen, twice = set(), set()
        for w in windows:
            (twice if w in seen else seen).add(w)
    inside = {j for i, w in enumerate(windows) if w in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside),
    )


TEXTS = [r[1] or "" for r in awkward()] + [
    "a b c a b c", "a b c d", "x\n\nx\n \n \nx ", "#|<>&%$* a|b", "a b a b a b a", "é é \x1c b",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts_equal_the_plain_ones(text):
    words = quality_rules.words_of(text)
    got = quality_rules.base_counts(text, words, quality_rules.word_hashes(words))
    assert got == plain_counts(text)


def corpus():
    good = [(i, prose(120, i), "en", "a", 0) for i in range(60)]
    junk = [(100 + i, prose(120, i).upper().replace(" ", "!! "), "en", "b", 0) for i in range(20)]
    return good + junk


def test_rules_equal_a_plain_model(spark):
    rows = corpus() + [(*r[:4], 0) for r in awkward()]
    docs = documents(spark, rows)
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,), (0,)], "doc_id bigint")
    size = 512
    got = quality_rules.judge(docs, trusted, size=size).collect()
    assert len(got) == len(rows)

    def grams(text):
        words = quality_rules.words_of(text or "")
        return quality_rules.buckets(quality_rules.word_hashes(words), size)

    want = []
    for doc_id, text, *_ in rows:
        found = grams(text)
        raw, target = np.zeros(size), np.zeros(size)
        for other_id, other, *_ in rows:
            if zlib.crc32((other or "").encode()) % 3 == zlib.crc32((text or "").encode()) % 3:
                continue
            np.add.at(raw, grams(other), 1)
            if other_id is not None and 0 <= other_id < 60 and other_id % 2 == 0:
                np.add.at(target, grams(other), 1)
        ratio = np.log((target + 1) / (raw * target.sum() / raw.sum() + 1))
        want.append((doc_id, round(float(ratio[found].mean()), 9) if len(found) else 0.0))
    assert sorted(map(str, ((r.doc_id, round(r.llr, 9)) for r in got))) == sorted(map(str, want))
    assert all(r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD) for r in got)


def test_rules_part_good_from_junk(spark):
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint")
    kept = quality_rules.keep(documents(spark, corpus()), trusted, size=1024)
    assert kept.columns == documents(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == set(range(60))


def test_a_trusted_text_is_not_scored_by_itself(spark):
    """Trusted or not, a text of the corpus gets the same score if the others stay."""
    docs = documents(spark, corpus())
    ids = list(range(0, 60, 2))
    scores = []
    for names in (ids, [i for i in ids if i != 4]):
        trusted = spark.createDataFrame([(i,) for i in names], "doc_id bigint")
        scores.append({r.doc_id: r.llr for r in quality_rules.judge(docs, trusted).collect()})
    assert scores[0][4] == scores[1][4] and scores[0] != scores[1]


def test_rules_without_target_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint")
    got = quality_rules.judge(documents(spark, corpus()), none).collect()
    assert all(r.llr == 0 and r.kept == (not r.base_failed) for r in got)
    assert quality_rules.judge(documents(spark, []), none).count() == 0


def test_classifier_learns_and_holds_out(spark):
    docs = documents(spark, corpus())
    rows = [(i, int(i < 60), 0) for i in range(130)] + [(None, 1, 0), (3, None, 0), (5, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    got = quality_gam.score(docs, quality_gam.train(docs, labels)).collect()
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        assert row.predicted == int(row.doc_id < 60)


def test_held_out_labels_do_not_matter(spark):
    docs = documents(spark, corpus())
    rows = [(i, int(i < 60)) for i in range(130)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in rows]
    models = [
        quality_gam.train(docs, spark.createDataFrame(r, "doc_id bigint, quality int"))
        for r in (rows, flipped)
    ]
    x = quality_gam.matrix([r[1] for r in corpus()])
    assert np.array_equal(models[0].score(x), models[1].score(x))


def test_classifier_on_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.where("false")):
        model = quality_gam.train(docs, known)
        got = quality_gam.score(docs, model).collect()
        assert len(got) == len(awkward())
        assert not any(r.held_out for r in got if r.doc_id is None)
        assert len({r.score for r in got}) == 1  # nothing to tell apart
        assert quality_gam.keep(docs, model).columns == docs.columns
    assert quality_gam.score(documents(spark, []), model).count() == 0


def test_additive_model_finds_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:1500], y[:1500], n_pairs=1)
    assert model.pairs == [(0, 1)]
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    # The score is the sum of its tables.
    b = model.bins(x[:5])
    total = model.constant + sum(t[b[:, i]] for i, t in enumerate(model.tables))
    total = total + model.pair_tables[0][b[:, 0], b[:, 1]]
    assert np.allclose(model.margin(x[:5]), total)


def test_training_rows_are_bounded_by_labels(spark, monkeypatch):
    """A labelled doc_id that repeats in the documents counts once."""
    from laserfold.llm import quality_gam
    from tests.llm.data import documents, prose

    seen = []
    monkeypatch.setattr(quality_gam, "fit", lambda x, y: seen.append(len(x)))
    rows = [(i % 12, prose(20, i), "en", "a", 0) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id bigint, quality int, toxic int")
    quality_gam.train(documents(spark, rows), labels, sample=10)
    assert seen[0] <= 12
