"""Conversation structure repair: weighted interval parsing over spans of turns.

A repaired conversation spells `(s?(ua)+)?` with the initials of its roles. The grammar
has one symbol [p q] for each pair of states of that pattern (nothing yet, after s,
after u, after a) that can follow each other, and in Chomsky normal form the rules
[p q] -> [p r] [r q] plus one rule per edit of a turn: Keep (0), Rerole (2), Delete (3,
forced for blank and repeated turns), and 1 more for a truncated turn that stays.
Insertions (2 each) are the closure of the empty span and stand on both sides of a turn.

A span's cells hold, for each symbol, the least (cost, audit), audit being the edits'
initials in order. Cells are combined bottom-up by span length: 1, 2, 4, ... turns. The
rules join state pairs, so every split point of a span gives the same cells, and one
split per span is enough. The least audit is well defined span by span: an audit that
begins with another one of the same span only adds insertions and so costs more.

1. Turns become narrow rows (no text); equal turns are counted, so copies are one row.
2. They are sorted by ranges. A task combines the turns of a conversation that lie in its
   range; conversations that cross ranges are combined from their spans in rounds, eight
   neighbours at a time, so a conversation of any length is spread over tasks.
3. Texts are shuffled once, to their conversation's audit, and streamed: no conversation
   is held in memory. A conversation's repaired rows come out of one task in their order,
   which a digest over the whole conversation needs anyway; its audit is one string.

Results: turns are ordered by turn (nulls first), then role, then the SHA-256 of the
text, so equal turns are neighbours. A null role or text counts as one space; a null
conv_id is a conversation of its own. A turn is blank without a character other than
white space (space, tab to carriage return), else repeated if its role and text stood in
an earlier turn, else truncated if the last such character is none of `.!?`. An empty
role that is kept spells nothing. Very long texts pass through whole; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold.llm.common import Batches, column, read_back
from laserfold.runtime import lookup_join, store

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
# Which state each kept or new initial leads to.
STEPS = {
    "s": ((START, SYSTEM),),
    "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)),
    "a": ((USER, ASSISTANT),),
}
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
FAN_IN = 8
# Cells of short spans are kept for reuse.
SHORT_SPAN, KEPT_CELLS = 4, 20_000
OUT_BYTES = 4_000_000

Cells = tuple  # per symbol: (cost, audit) or None


def _symbols() -> list[tuple[int, int]]:
    reached = {(p, p) for p in STATES} | {step for steps in STEPS.values() for step in steps}
    while True:
        more = {(p, r) for p, q in reached for s, r in reached if q == s} | reached
        if more == reached:
            return sorted(reached)
        reached = more


SYMBOLS = _symbols()
AT = {pair: i for i, pair in enumerate(SYMBOLS)}
# For each symbol [p q] its rules, as places of [p r] and [r q].
RULES = [
    [(AT[p, r], AT[r, q]) for r in STATES if (p, r) in AT and (r, q) in AT] for p, q in SYMBOLS
]


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans taken together."""
    cells = []
    for rules in RULES:
        best = None
        for i, j in rules:
            a, b = left[i], right[j]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if best is None or cost < best[0]:
                best = (cost, a[1] + b[1])
            elif cost == best[0]:
                audit = a[1] + b[1]
                if audit < best[1]:
                    best = (cost, audit)
        cells.append(best)
    return tuple(cells)


_combine_short = functools.lru_cache(KEPT_CELLS)(combine)


def _closure() -> Cells:
    """Cells of the empty span: what insertions alone can do."""
    cells: list = [None] * len(SYMBOLS)
    for p in STATES:
        cells[AT[p, p]] = (0, "")
    for initial in "ua":
        for step in STEPS[initial]:
            cells[AT[step]] = (INSERT, "I")
    closed = tuple(cells)
    while (more := combine(closed, closed)) != closed:
        closed = more
    return closed


EMPTY = _closure()


@functools.lru_cache(64)
def turn_cells(initial: str, truncated: bool) -> Cells:
    """Cells of one turn that may stay, with insertions around it."""
    extra = TRUNCATED if truncated else 0
    options: dict[tuple[int, int], list] = {(p, p): [(DELETE, "D")] for p in STATES}
    if not initial:
        for p in STATES:
            options[p, p].append((extra, "K"))
    for step in STEPS.get(initial, ()):
        options.setdefault(step, []).append((extra, "K"))
    for new in "ua":
        for step in STEPS[new]:
            options.setdefault(step, []).append((REROLE + extra, "R"))
    row = tuple(min(options[pair]) if pair in options else None for pair in SYMBOLS)
    return combine(combine(EMPTY, row), EMPTY)


@functools.lru_cache(1_024)
def deleted_cells(times: int) -> Cells:
    """Cells of so many turns in a row that must go."""
    row = tuple((DELETE * times, "D" * times) if p == q else None for p, q in SYMBOLS)
    return combine(combine(EMPTY, row), EMPTY)


@dataclass
class Span:
    """Neighbouring turns of one conversation: counts and cells."""

    first: str
    last: str
    low: int | None
    high: int | None
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cells: Cells

    def then(self, other: Span, cells: Cells | None = None) -> Span:
        return Span(
            self.first,
            other.last,
            other.low if self.low is None else self.low,
            self.high if other.high is None else other.high,
            self.turns + other.turns - (self.high is not None and self.high == other.low),
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in LEGAL),
            combine(self.cells, other.cells) if cells is None else cells,
        )


class Builder:
    """Combines turns, given in order, to the span of one conversation."""

    def __init__(self) -> None:
        self.counts: Span | None = None
        self.stack: list[tuple[int, Cells]] = []

    def _push(self, cells: Cells, size: int = 1) -> None:
        while self.stack and self.stack[-1][0] == size:
            left = self.stack.pop()[1]
            cells = (_combine_short if size <= SHORT_SPAN else combine)(left, cells)
            size *= 2
        self.stack.append((size, cells))

    def add(
        self, turn: int | None, role: str, copies: int, blank: bool, again: bool, open_end: bool
    ) -> None:
        initial = role[:1]
        gone = copies if blank or again else copies - 1
        stays = copies - gone
        here = Span(
            initial,
            initial,
            turn,
            turn,
            int(turn is not None),
            copies if blank else 0,
            0 if blank else gone,
            int(bool(stays) and open_end),
            copies - 1,
            (),
        )
        self.counts = self.counts.then(here, ()) if self.counts else here
        if stays:
            self._push(turn_cells(initial, open_end))
        if gone:
            self._push(deleted_cells(gone))

    def close(self) -> Span:
        cells = self.stack.pop()[1]
        while self.stack:
            cells = combine(self.stack.pop()[1], cells)
        self.counts.cells = cells
        return self.counts


COUNTS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
SPAN_SCHEMA = (
    "conv string, place bigint, first string, last string, "
    + ", ".join(f"{name} bigint" for name in COUNTS)
    + ", costs array<bigint>, audits array<string>"
)
SPAN_ARROW = pa.schema(
    [("conv", pa.string()), ("place", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [(name, pa.int64()) for name in COUNTS]
    + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)


def _row(conv: str, place: int, span: Span) -> dict:
    costs, audits = zip(*(cell or (None, None) for cell in span.cells), strict=True)
    plain = {name: getattr(span, name) for name in ("first", "last", *COUNTS)}
    return {"conv": conv, "place": place, **plain, "costs": costs, "audits": audits}


def _span(row: dict) -> Span:
    cells = tuple(
        None if cost is None else (cost, audit)
        for cost, audit in zip(row["costs"], row["audits"], strict=True)
    )
    return Span(*(row[name] for name in ("first", "last", *COUNTS)), cells)


def _records(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, SPAN_ARROW)


def _parse(batches: Batches) -> Batches:
    """Spans of the conversations in one sorted range; a span's place is its task's number."""
    from pyspark import TaskContext

    place, conv, building, rows, held = TaskContext.get().partitionId(), None, None, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if building is None or row[0] != conv:
                if building:
                    rows.append(_row(conv, place, building.close()))
                    held += sum(len(audit or "") for audit in rows[-1]["audits"])
                conv, building = row[0], Builder()
                if len(rows) >= 2_000 or held > OUT_BYTES:
                    yield _records(rows)
                    rows, held = [], 0
            building.add(*row[1:])
    if building:
        rows.append(_row(conv, place, building.close()))
    yield _records(rows)


def _merge(table: pa.Table) -> pa.Table:
    rows = table.sort_by("place").to_pylist()
    whole = functools.reduce(Span.then, map(_span, rows))
    return pa.Table.from_batches([_records([_row(rows[0]["conv"], rows[0]["place"], whole)])])


WHITE = r"\x20\x09-\x0D"


def _turns(turns: DataFrame) -> DataFrame:
    """Columns conv (key), conv_id, dated, turn, role, text, digest; nulls of texts replaced."""
    number = column(turns, "turn", "bigint")
    text = F.coalesce(column(turns, "text", "string"), F.lit(" "))
    conv_id = column(turns, "conv_id", "bigint")
    return turns.select(
        conv_key(conv_id).alias("conv"),
        conv_id.alias("conv_id"),
        number.isNotNull().alias("dated"),
        number.alias("turn"),
        F.coalesce(column(turns, "role", "string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def conv_key(conv_id: Column) -> Column:
    """A key that is never null: the empty string for a null conversation."""
    return F.coalesce(conv_id.cast("string"), F.lit(""))


ORDER = ("conv", "dated", "turn", "role", "digest")


def parse(turns: DataFrame) -> DataFrame:
    """One row per conversation that has turns: conv, gaps, faults, illegal, cost, audit."""
    text = F.col("text")
    each = (
        _turns(turns)
        .select(
            *ORDER,
            (~text.rlike(f"[^{WHITE}]")).alias("blank"),
            (~text.rlike(f"[.!?][{WHITE}]*+\\z")).alias("open_end"),
        )
        .groupBy(*ORDER)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.first("blank").alias("blank"),
            F.first("open_end").alias("open_end"),
        )
    )
    each = read_back(each, "turns")
    at = F.struct("dated", F.coalesce("turn", F.lit(0)).alias("turn"))
    # Only texts that a conversation holds in two turns or more.
    firsts = store(
        each.groupBy("conv", "role", "digest")
        .agg(F.min(at).alias("earliest"), F.count(F.lit(1)).alias("places"))
        .where("places > 1")
        .drop("places"),
        "first-turns",
    )
    marked = lookup_join(each, firsts, ("conv", "role", "digest"), "left", spread=("turn",))
    narrow = marked.select(
        *ORDER, "copies", "blank", F.coalesce(at > F.col("earliest"), F.lit(False)).alias("again"), "open_end"
    )
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = read_back(
        narrow.repartitionByRange(ranges, *ORDER)
        .sortWithinPartitions(*ORDER)
        .select("conv", "turn", "role", "copies", "blank", "again", "open_end")
        .mapInArrow(_parse, SPAN_SCHEMA),
        "spans",
    )
    # At most two conversations of a range go on beyond it.
    parts = spans.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    cut = store(parts.select("conv"), "cut-conversations")
    crossing = lookup_join(spans, cut, ("conv",), "left_semi", spread=("place",))
    whole = lookup_join(spans, cut, ("conv",), "left_anti", spread=("place",))
    width, top = FAN_IN, spans.agg(F.max("place")).first()[0] or 0
    while True:
        group = F.floor(F.col("place") / width).alias("group")
        crossing = crossing.groupBy("conv", group).applyInArrow(_merge, SPAN_SCHEMA)
        if width > top:
            break
        width *= FAN_IN
    cells = F.filter(
        F.array(
            *(
                F.struct(
                    F.col("costs")[AT[START, q]].alias("cost"),
                    F.col("audits")[AT[START, q]].alias("audit"),
                )
                for q in ENDS
            )
        ),
        lambda cell: cell["cost"].isNotNull(),
    )
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return whole.unionByName(crossing).select(
        "conv",
        gaps.alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        F.array_min(cells).alias("best"),
    ).select("*", "best.cost", "best.audit").drop("best")


REPAIRED_SCHEMA = "conv string, place bigint, role string, text string, edit string"


def _apply(batches: Batches) -> Batches:
    """Streams turns behind their conversation's audit and gives the rows that it leaves."""
    names = ("conv", "place", "role", "text", "edit")
    out: dict[str, list] = {n: [] for n in names}
    size, conv, audit, at, state, place = 0, None, "", 0, START, 0

    def emit(role: str, text: str, edit: str) -> None:
        nonlocal size, state, place
        for name, value in zip(names, (conv, place, role, text, edit), strict=True):
            out[name].append(value)
        size += len(text) + 64
        place += 1
        initial = role[:1]
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial, state)

    def due() -> str:
        return "assistant" if state == USER else "user"

    def inserts() -> None:
        nonlocal at
        while audit[at : at + 1] == "I":
            emit(due(), "", "I")
            at += 1

    def flush() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out[n], pa.int64() if n == "place" else pa.string()) for n in names], names=names
        )
        for n in names:
            out[n].clear()
        size = 0
        return batch

    for batch in batches:
        for key, script, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if script is not None:
                inserts()
                conv, audit, at, state, place = key, script, 0, START, 0
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit != "D":
                emit(role if edit == "K" else due(), text, edit)
            if size > OUT_BYTES:
                yield flush()
    inserts()
    yield flush()


def apply(turns: DataFrame, parsed: DataFrame) -> DataFrame:
    """The repaired turns: conv, place (from 0), role, text, edit (K, R or I).

    Each conversation's rows lie together and in order in one partition."""
    scripts = parsed.select(
        "conv",
        F.lit(False).alias("row"),
        F.lit(None).cast("boolean").alias("dated"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        "audit",
        F.lit(None).cast("string").alias("text"),
    )
    rows = _turns(turns).select(
        "conv", F.lit(True).alias("row"), "dated", "turn", "role", "digest",
        F.lit(None).cast("string").alias("audit"), "text",
    )
    return (
        scripts.unionByName(rows)
        .repartition("conv")
        .sortWithinPartitions("conv", "row", *ORDER[1:])
        .select("conv", "audit", "role", "text")
        .mapInArrow(_apply, REPAIRED_SCHEMA)
    )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired turns, report): see `apply` and `parse`. The report is written once."""
    parsed = read_back(parse(turns), "parsed")
    return apply(turns, parsed), parsed


def digests(repaired: DataFrame) -> DataFrame:
    """conv, repaired_sha256 of `role:text` lines, streamed over rows as `apply` gives them."""
    import hashlib

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or key != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(conv, state.hexdigest())])

    return repaired.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def _digest_rows(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["conv", "repaired_sha256"]
    )
