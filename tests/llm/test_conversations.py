"""Conversation repair against a plain parser that walks the turns one by one."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from laserfold.llm import conversation_repair as repair
from laserfold.llm import queries

WHITE = " \t\n\x0b\x0c\r"
PATTERN = re.compile("(s?(ua)+)?")


def faults_of(rows):
    """Fault of each (turn, role, text) row, in order."""
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif bare[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """(cost, audit, repaired rows) by a forward walk over (initials' state) with least paths."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def insertions(table):
        for _ in range(4):
            for state, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        better(table, step[state, role[0]], (cost + 2, audit + "I", [*out, (role, "")]))
        return table

    best = insertions({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults_of(rows), strict=True):
        following = {}
        for state, (cost, audit, out) in best.items():
            better(following, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            if not role:
                better(following, state, (more, audit + "K", [*out, (role, text)]))
            elif (state, role[0]) in step:
                better(following, step[state, role[0]], (more, audit + "K", [*out, (role, text)]))
            for new in ("user", "assistant"):
                if (state, new[0]) in step:
                    better(following, step[state, new[0]], (more + 2, audit + "R", [*out, (new, text)]))
        best = insertions(following)
    return min(best[state] for state in ("", "a") if state in best)


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.sha256(text.encode()).digest())


def plain_report(rows):
    rows = sorted(rows, key=order)
    faults = faults_of(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, out = plain_repair(rows)
    assert PATTERN.fullmatch("".join(role[:1] for role, _ in out))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(
            a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)
        ),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def plain_query(table):
    """Rows of the query for (conv_id, turn, role, text) rows, by conversation."""
    found = {}
    for conv, turn, role, text in table:
        rows = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        address = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(address.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {conv: plain_report(rows) for conv, rows in found.items()}


def random_rows(seed, n, roles=("user", "assistant", "system", "tool", "", "User")):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "and so", " ", "", "Why?\n", "a . b", "tab\t", "x."]
    return [(draw.choice([None, *range(n)]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def span_of(rows):
    building = repair.Builder()
    rows = sorted(rows, key=order)
    first = {}
    for turn, role, text in rows:
        first.setdefault((role, text), (turn is not None, turn or 0))
    for row, same in itertools.groupby(rows):
        turn, role, text = row
        bare = text.strip(WHITE)
        building.add(
            turn, role, len(list(same)), not bare,
            (turn is not None, turn or 0) > first[role, text], bool(bare) and bare[-1] not in ".!?",
        )
    return building.close()


def least(cells):
    return min(c for c in (cells[repair.AT[0, 0]], cells[repair.AT[0, 3]]) if c is not None)


@pytest.mark.parametrize("seed", range(150))
def test_spans_give_the_walks_audit(seed):
    rows = random_rows(seed, seed % 11 + 1)
    assert least(span_of(rows).cells) == plain_repair(sorted(rows, key=order))[:2]


@pytest.mark.parametrize("seed", range(25))
def test_any_split_of_a_span_gives_the_same_cells(seed):
    """Full interval parsing: every split point of every span."""
    draw = random.Random(seed)
    leaves = [
        repair.deleted_cells(1) if draw.random() < 0.2 else repair.turn_cells(draw.choice("suax"), draw.random() < 0.3)
        for _ in range(7)
    ]
    cells = {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for length in range(2, 8):
        for i in range(8 - length):
            made = {repair.combine(cells[i, m], cells[m, i + length]) for m in range(i + 1, i + length)}
            assert len(made) == 1
            cells[i, i + length] = made.pop()


def test_all_edit_scripts_of_short_conversations():
    """Tries every audit up to a length, role by role, and takes the cheapest."""

    def tried(rows, faults):
        best = None
        for length in range(len(rows) + 5):
            for script in itertools.product("DIKR", repeat=length):
                if sum(x != "I" for x in script) != len(rows):
                    continue
                for roles in itertools.product("ua", repeat=sum(x in "IR" for x in script)):
                    new, i, cost, text = iter(roles), 0, 0, ""
                    for x in script:
                        if x == "I":
                            cost, text = cost + 2, text + next(new)
                            continue
                        fault, role = faults[i], rows[i][1]
                        i += 1
                        if x == "D":
                            cost += 3
                        elif fault in ("blank", "duplicate"):
                            cost += 1000
                        else:
                            cost += (fault == "truncated") + 2 * (x == "R")
                            text += role[:1] if x == "K" else next(new)
                    if PATTERN.fullmatch(text) and (best is None or (cost, "".join(script)) < best):
                        best = cost, "".join(script)
        return best

    for seed in range(6):
        rows = sorted(random_rows(seed, 2, ("user", "assistant", "system", "x")), key=order)
        assert tried(rows, faults_of(rows)) == plain_repair(rows)[:2]


DDL = "conv_id bigint, turn bigint, role string, text string, conv string, audit string, row int, place int"


def save(spark, folder, rows):
    spark.createDataFrame([(*r, "c", "a", 1, 2) for r in rows], DDL).repartition(5).write.parquet(
        f"{folder}/conversations.parquet"
    )


def test_query_against_plain_version(spark, tmp_path):
    draw = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        rows += [(conv, *r) for r in random_rows(conv or 99, draw.randint(1, 9))]
    rows += [(7, 0, "user", "Yes.")] * 5 + [(None, None, None, None)] * 3
    # One conversation with more turns than all others, longer than any range; one long text.
    rows += [(1000, *r) for r in random_rows(5, 1500)]
    rows += [(1001, 0, "user", "word " * 60_000 + "."), (1001, 1, "assistant", "ü" * 9_000)]
    save(spark, tmp_path, rows)
    got = {r["conv_id"]: r.asDict() for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = plain_query(rows)
    assert set(got) == set(want)
    for conv, report in want.items():
        assert {k: got[conv][k] for k in report} == report, conv


def test_repaired_rows_and_ranges(spark):
    """One conversation holds most rows and crosses every range; the repaired rows are legal."""
    rows = [("hot", t, r, x) for t, (_, r, x) in enumerate(random_rows(8, 400))]
    turns = spark.createDataFrame([(5, *r[1:]) for r in rows] + [(1, 0, "user", "Hm.")], DDL.split(", conv ")[0])
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        repaired, report = repair.repair(turns)
        out = repaired.orderBy("conv", "place").collect()
        audits = {r["conv"]: r["audit"] for r in report.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    _, audit, plain = plain_repair(sorted([r[1:] for r in rows], key=order))
    assert audits["5"] == audit
    assert [(r["role"], r["text"]) for r in out if r["conv"] == "5"] == plain
    assert [r["place"] for r in out if r["conv"] == "5"] == list(range(len(plain)))
    assert [(r["role"], r["edit"]) for r in out if r["conv"] == "1"] == [("user", "K"), ("assistant", "I")]


def test_empty_table(spark, tmp_path):
    save(spark, tmp_path, [])
    assert queries.op11_conversation_repair(spark, str(tmp_path)).count() == 0


def test_all_turns_dropped(spark, tmp_path):
    turn = next(t for t in range(1000) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    save(spark, tmp_path, [(4, turn, "user", "Gone.")])
    row = queries.op11_conversation_repair(spark, str(tmp_path)).drop("conv_id").first().asDict()
    empty = hashlib.sha256(b"").hexdigest()
    assert row.pop("audit") == "" and row.pop("repaired_sha256") == empty and set(row.values()) == {0}


def test_no_text_reaches_the_parser(spark, tmp_path):
    turns = spark.createDataFrame([(1, 0, "user", "Hm.")], DDL.split(", conv ")[0])
    plan = repair.parse(turns)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan
