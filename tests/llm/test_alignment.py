"""Token alignment against the libraries on whole texts, pair by pair."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from laserfold.llm import queries, tokens
from laserfold.llm import token_alignment as alignment
from tests.llm import data

PATHS = tokens.alignment_paths()


@pytest.fixture(scope="module")
def both():
    return alignment.Aligner(*PATHS)


def plain_pairs(both, text):
    """(n_a, n_b, groups, links) from byte offsets, or nothing."""
    if not text:
        return 0, 0, [], Counter()
    a = both.a.encode(f" {text}", add_special_tokens=False).ids
    b = both.b.encode(text)
    ends = []
    for ids, table in ((a, both.bytes_a), (b, both.bytes_b)):
        if b"".join(table[i] for i in ids) != f" {text}".encode():
            return 0, 0, [], Counter()
        ends.append(np.cumsum([len(table[i]) for i in ids]).tolist())
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups, links = [], Counter()
    cuts = [np.searchsorted(at, [0, *shared], side="right").tolist() for at in ends]
    for (i, j), (k, m) in zip(*(zip(c, c[1:]) for c in cuts), strict=True):
        own = a[i:j], b[k:m]
        groups.append("|".join(",".join(map(str, x)) for x in own))
        for x in own[0]:
            for y in own[1]:
                links[x, y] += 1
    return len(a), len(b), groups, links


def plain(both, rows):
    found = [(doc_id, *plain_pairs(both, text)) for doc_id, text in rows]
    counts = Counter(pair for *_, links in found for pair in links)
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    return sorted(
        (
            (
                doc_id,
                n_a,
                n_b,
                len(groups),
                sum(links.values()),
                sum(n for pair, n in links.items() if counts[pair] == highest[pair[0]]),
                sum(n * counts[pair] for pair, n in links.items()),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def odd_texts():
    draw = random.Random(1)
    marks = list("abç ▁\n\t\r'é中😀.-0½,_") + ["  ", " the", "don't", "<|endoftext|>", "<s>", "<0x0A>", "\xa0", " ", ");\r"]
    return ["".join(draw.choice(marks) for _ in range(draw.randint(0, 40))) for _ in range(3000)] + [
        " ", "  ", "a ", " a", "a  b", "\n", "x\n y", "x\n  y", "▁", "a▁b", "-" * 3000, "ab" * 4000,
    ]


def test_cut_pieces_are_tokenized_as_in_whole_texts(both):
    assert both.coarse and both.fine
    texts = odd_texts() + [r[1] for r in data.awkward()]
    for text, found in zip(texts, both.documents([t or "" for t in texts]), strict=True):
        n_a, n_b, groups, links = plain_pairs(both, text)
        assert found[0] == (n_a, n_b, len(groups), sum(links.values())), repr(text)
        assert found[1].decode() == ";".join(groups), repr(text)


def test_wide_groups_are_counted(both, monkeypatch):
    text = "日本" * 20
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    piece = both.align(f" {text}", both.a.encode(f" {text}").ids, both.b.encode(text))
    links = Counter(np.frombuffer(piece[2], np.int64).tolist()) + Counter(piece[3] or {})
    assert links == {a * both.width + b: n for (a, b), n in plain_pairs(both, text)[3].items()}


@pytest.mark.parametrize("size", [1, 9, 70, 3000])
def test_containers_and_planes(size):
    draw = np.random.default_rng(size)
    keys = np.unique(draw.integers(0, 40, 4 * size) * size + draw.integers(0, size, 4 * size))
    codes, places = np.divmod(keys, size)
    times = draw.integers(1, 9, len(keys))
    made = alignment.invert(codes, places, times, size)
    which, found = alignment.places_of(made["docs"], size)
    assert (np.array(made["code"])[which] == codes).all() and (found == places).all()
    total = np.ones(len(keys), np.int64)
    at = {(c, p): i for i, (c, p) in enumerate(zip(codes.tolist(), places.tolist(), strict=True))}
    for code, planes in zip(made["code"], made["planes"], strict=True):
        for k, plane in enumerate(planes):
            for place in alignment.places_of([plane], size)[1] if plane else []:
                total[at[code, place]] += 1 << k
    assert (total == times).all()
    assert sum(made["n_links"]) == times.sum() and sum(made["n_docs"]) == len(keys)


def run(docs):
    return sorted((tuple(r) for r in alignment.align(docs, *PATHS).collect()), key=str)


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_awkward_rows(spark, both, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", block)
    rows = data.awkward() + [(100 + i, t, "xx", "o", 0) for i, t in enumerate(odd_texts()[-60:])]
    docs = data.documents(spark, rows).repartition(3)
    assert run(docs) == plain(both, [(r[0], r[1]) for r in rows])


def test_query_on_the_given_documents(spark, both):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in queries.op12_token_alignment(spark, folder).collect()), key=str)
    assert got == plain(both, rows)


def test_links_of_pairs(spark, both):
    docs = data.documents(spark)
    counts = alignment.pair_counts(alignment.index(docs, *PATHS))
    want_docs, want_links = Counter(), Counter()
    for r in data.awkward():
        links = plain_pairs(both, r[1])[3]
        want_docs.update(links.keys())
        want_links.update(links)
    got = {(r["a"], r["b"]): (r["count"], r["links"]) for r in counts.collect()}
    assert got == {pair: (n, want_links[pair]) for pair, n in want_docs.items()}


def test_empty_table(spark):
    assert run(data.documents(spark, [])) == []
