import zlib

import numpy as np
import pytest

from laserfold.llm import packing
from tests.llm.data import PATH, awkward, documents, library_ids, prose


def check(pieces, rows, length):
    """All laws of a packing; returns the tokens per sequence and source."""
    encoded = sorted(library_ids(text) + [packing.END_ID] for _, text, *_ in rows)
    parts = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32
        parts.setdefault(p.sequence_id, []).append(p)
    sizes = {}
    for number, own in parts.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes[number] = at
        assert at <= length and at & (at - 1) == 0
    assert sorted(sizes) == list(range(len(sizes)))
    assert sum(sizes.values()) == sum(map(len, encoded))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.source), []).append(p)
    for (doc_id, source), own in by_doc.items():
        same = [r for r in rows if (r[0], r[3]) == (doc_id, source)]
        total = sum(len(library_ids(r[1])) + 1 for r in same)
        assert sum(p.length for p in own) == total
        if len(same) == 1:
            own.sort(key=lambda p: p.start)
            joined = b"".join(p.ids for p in own)
            assert np.frombuffer(joined, "<u4").tolist() == library_ids(same[0][1]) + [2]
            assert all(p.doc_tokens == total for p in own)
            assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
    return parts


@pytest.mark.parametrize(("length", "window"), [(64, 64), (64, 512), (4096, 32768)])
def test_awkward_rows_are_packed_whole(spark, length, window):
    got = packing.pack(documents(spark), PATH, length=length, window=window).collect()
    check(got, awkward(), length)


def test_windows_hold_the_target_shares(spark):
    rows = [(i, prose(60, i), "en", "hot" if i % 3 else f"s{i % 2}", 0) for i in range(300)]
    weights = {"hot": 0.5, "s0": 0.25, "s1": 0.25}
    got = packing.pack(
        documents(spark, rows), PATH, length=64, window=256, weights=weights
    ).collect()
    parts = check(got, rows, 64)
    for window in range(20):
        taken = {}
        for number in range(4 * window, 4 * window + 4):
            for p in parts[number]:
                taken[p.source] = taken.get(p.source, 0) + p.length
        assert abs(taken["hot"] - 128) <= 4 and abs(taken["s0"] - 64) <= 4


def test_queues_without_weight_are_served_last(spark):
    rows = [(i, prose(40, i), "en", "a" if i < 5 else "b", 0) for i in range(10)]
    got = packing.pack(documents(spark, rows), PATH, length=64, window=64, weights={"b": 1.0}).collect()
    check(got, rows, 64)
    first_a = min(p.sequence_id for p in got if p.source == "a")
    assert first_a >= max(p.sequence_id for p in got if p.source == "b")


def test_schedule_carries_deficits():
    names, phases = packing.schedule({"a": 1000, "b": 10, "c": 333}, {"a": 1, "b": 1, "c": 1}, 10)
    placed = []
    for i, n in enumerate((1000, 10, 333)):
        at, position, size = packing.place(phases, i, 0, n)
        assert at.tolist() == np.cumsum([0, *size[:-1]]).tolist()
        placed += [(p, p + s) for p, s in zip(position.tolist(), size.tolist(), strict=True)]
    placed.sort()
    assert placed[0][0] == 0 and placed[-1][1] == 1343
    assert all(a[1] == b[0] for a, b in zip(placed, placed[1:], strict=False))


def plain_round_robin(totals, share, window):
    """Queue by queue, round by round: (queue, first token, stream position, length)."""
    served, credit = [0] * len(totals), [0] * len(totals)
    found, position = [], 0
    live = [n > 0 for n in totals]
    while any(live):
        whole = sum(s for s, on in zip(share, live, strict=True) if on)
        quantum = [int(s / whole * window * packing.UNIT) if on else 0 for s, on in zip(share, live, strict=True)]
        credit, dry = [0] * len(totals), False
        while not dry:
            for q, on in enumerate(live):
                if not on:
                    continue
                credit[q] += quantum[q]
                n = min(credit[q] // packing.UNIT, totals[q] - served[q])
                dry |= credit[q] // packing.UNIT > n
                credit[q] -= n * packing.UNIT
                if n:
                    found.append((q, served[q], position, n))
                served[q] += n
                position += n
            # A queue that has nothing left ends the round as well.
            dry |= all(served[q] == totals[q] for q, on in enumerate(live) if on)
        live = [served[q] < totals[q] for q in range(len(totals))]
    return found


@pytest.mark.parametrize("window", [16, 100, 1000])
def test_places_equal_a_plain_round_robin(window):
    totals = {"a": 5003, "b": 77, "c": 1201, "d": 1}
    weights, rest = {"a": 0.3, "c": 0.4}, 0.3
    names, phases = packing.schedule(totals, weights, window, rest)
    assert names == ["a", "b", "c", "d"]
    share = [0.3, 0.3 * 77 / 78, 0.4, 0.3 * 1 / 78]
    plain = plain_round_robin([totals[n] for n in names], share, window)
    for q, name in enumerate(names):
        want = {first + i: at + i for k, first, at, n in plain if k == q for i in range(n)}
        for low, high in ((0, totals[name]), (totals[name] // 3, totals[name] // 2)):
            at, position, size = packing.place(phases, q, low, high)
            got = {a + i: p + i for a, p, n in zip(at.tolist(), position.tolist(), size.tolist(), strict=True) for i in range(n)}
            assert got == {t: want[t] for t in range(low, high)}


def test_unnamed_queues_divide_the_rest(spark):
    rows = [(i, prose(60, i), "en", "src0" if i % 3 else f"s{i % 2}", 0) for i in range(300)]
    got = packing.pack(
        documents(spark, rows), PATH, length=64, window=256, weights={"src0": 0.25}, rest=0.75
    ).collect()
    parts = check(got, rows, 64)
    for window in range(10):
        own = [p for n in range(4 * window, 4 * window + 4) for p in parts[n]]
        assert abs(sum(p.length for p in own if p.source == "src0") - 64) <= 4


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_sequence_length_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark), PATH, length=100)
