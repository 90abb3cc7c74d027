"""Mixing sources to target weights by hierarchical budgeting.

Documents hang under a tree (domain, language, source). A token budget is handed down
the tree in proportion to the weights of siblings. A child that cannot use its part
(its documents times `max_epochs`) gives the rest to its siblings; only when all of them
are full does a shortage reach the level above, where the parent's siblings take it
(`budgets`). Every leaf then takes whole epochs of its documents and, of the next epoch,
the longest prefix in seeded random order that its budget covers.

The order is that of a hash of (seed, epoch, document), so a prefix is a threshold on the
hash. It is found exactly without sorting: per level of ten hash bits the leaf's tokens
are summed in at most 1024 bins, on the map side first, and the bin that crosses the
budget is opened next. What the driver holds is one row per leaf. The documents are read
once to count their tokens and once to filter them, and are never shuffled.

Results: a null text is empty (0 tokens) and a null level value is a branch of its own.
Rows with equal doc_id and text have one place in the order: they are taken together or
not at all. Documents that would exceed the leaf's budget, and all behind them, are left
out of that epoch. Columns of `docs` pass through as they are; `select` adds `epoch` (a
column of that name is replaced) and gives a row per document and epoch. An empty table
or a budget of 0 gives no rows; a leaf without any token is taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from laserfold.llm import tokens
from laserfold.llm.common import add_columns, column, read_back, text_of

SEED = 11
STEP = 10  # hash bits per level
BITS = 60

Path = tuple[str | None, ...]


@dataclass
class Leaf:
    tokens: int
    budget: int = 0
    epochs: int = 0  # whole epochs
    left: int = 0  # tokens of the prefix
    prefix: int = 0  # the hash bits that are settled
    bits: int = 0
    before: int = 0  # tokens under smaller bits
    open: bool = False


def budgets(
    leaves: Mapping[Path, int],
    budget: int,
    weights: Mapping[Path, float],
    max_epochs: int,
) -> dict[Path, int]:
    """Tokens for every leaf; they sum up to the budget, or to all that is there."""
    found: dict[Path, int] = {}

    def room(path: Path) -> int:
        return max_epochs * sum(n for p, n in leaves.items() if p[: len(path)] == path)

    def hand_down(path: Path, amount: int) -> None:
        if path in leaves:
            found[path] = amount
            return
        below = {p[: len(path) + 1] for p in leaves if p[: len(path)] == path}
        children = sorted(below, key=lambda p: (p[-1] is not None, p[-1] or ""))
        rooms = {c: room(c) for c in children}
        everything = sum(rooms.values())
        share = {
            c: max(0.0, float(weights.get(c, rooms[c] / everything if everything else 0.0)))
            for c in children
        }
        given = dict.fromkeys(children, 0)
        left = min(amount, everything)
        while left > 0:
            free = [c for c in children if given[c] < rooms[c]]
            # Children of no weight take what the weighted ones cannot.
            asked = [c for c in free if share[c] > 0] or free
            total = sum(share[c] for c in asked)
            part = {c: share[c] / total if total else 1 / len(asked) for c in asked}
            handed = 0
            for c in asked:
                n = min(int(left * part[c]), rooms[c] - given[c])
                given[c] += n
                handed += n
            if not handed:  # less than one token each: in order
                c = max(asked, key=lambda x: part[x])
                given[c] += 1
                handed = 1
            left -= handed
        for c in children:
            hand_down(c, given[c])

    hand_down((), budget)
    return found


def whole_budget(leaves: dict[Path, int], weights: Mapping[Path, float]) -> int:
    """The least budget whose shares reach all tokens of every leaf that has a weight."""
    tokens_of: dict[Path, int] = {}
    for path, n in leaves.items():
        for depth in range(len(path) + 1):
            tokens_of[path[:depth]] = tokens_of.get(path[:depth], 0) + n
    shares = {
        p: max(0.0, float(weights.get(p, n / tokens_of[p[:-1]] if n else 0.0)))
        for p, n in tokens_of.items()
        if p
    }
    of_siblings: dict[Path, float] = {}
    for path, share in shares.items():
        of_siblings[path[:-1]] = of_siblings.get(path[:-1], 0.0) + share
    needed = {p: float(n) for p, n in tokens_of.items()}
    for path in sorted(shares, key=len, reverse=True):
        above = path[:-1]
        if shares[path] > 0 and tokens_of[path]:
            # One more, as shares are handed down in whole tokens.
            need = (needed[path] + 1) * of_siblings[above] / shares[path]
            needed[above] = max(needed[above], need)
    return math.ceil(needed[()]) if needed else 0


def _draw(epoch: Column, base: Column, seed: int) -> Column:
    """60 bits that order the documents of an epoch."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, base), 64 - BITS)


def _base(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(column(docs, "doc_id", "bigint"), F.md5(text_of(docs, text).cast("binary")))


def _level_names(levels: Mapping[str, Column]) -> list[str]:
    return [f"_level_{i}" for i in range(len(levels))]


def _with_leaves(docs: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """Join one row of numbers per leaf; bounded by the leaves of the mixture."""
    keys = [StructField(f"{n}_of", StringType()) for n in names]
    numbers = [StructField(n, LongType()) for n in ("_epochs", "_prefix", "_bits")]
    table = docs.sparkSession.createDataFrame(rows, StructType([*keys, *numbers]))
    on = [docs[n].eqNullSafe(table[f"{n}_of"]) for n in names]
    return docs.join(F.broadcast(table), on).drop(*(f"{n}_of" for n in names))


def _cross(sized: DataFrame, names: list[str], leaves: dict[Path, Leaf], seed: int) -> None:
    """Settle the next STEP bits of every open leaf."""
    rows = [(*p, v.epochs, v.prefix, v.bits) for p, v in leaves.items() if v.open]
    joined = _with_leaves(sized, names, rows)
    draw = _draw(F.col("_epochs") + 1, F.col("base"), seed)
    bits = next(v.bits for v in leaves.values() if v.open)
    inside = joined.withColumn("draw", draw).where(
        F.shiftrightunsigned("draw", BITS - bits) == F.col("_prefix") if bits else F.lit(True)
    )
    bins = inside.groupBy(
        *names, F.shiftrightunsigned("draw", BITS - bits - STEP).alias("bin")
    ).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows"))
    # At most 1024 bins per leaf, which only the leaf's own prefix sum needs together.
    listed = F.sort_array(F.collect_list(F.struct("bin", "n", "rows")))
    for row in bins.groupBy(*names).agg(listed.alias("bins")).toLocalIterator():
        leaf = leaves[tuple(row[n] for n in names)]
        leaf.bits = bits + STEP
        for found in row["bins"]:
            leaf.prefix = found["bin"]
            if leaf.before + found["n"] > leaf.left:
                leaf.open = found["rows"] > 1 and leaf.bits < BITS
                break
            leaf.before += found["n"]
        else:
            leaf.prefix, leaf.open = leaf.prefix + 1, False


def plan(
    docs: DataFrame,
    levels: Mapping[str, Column],
    *,
    path: str,
    budget: int | None = None,
    share: float | None = 1.0,
    weights: Mapping[Path, float] | None = None,
    max_epochs: int = 1,
    seed: int = SEED,
    text: str = "text",
) -> dict[Path, Leaf]:
    """Budget, whole epochs and threshold of every leaf. Without `budget` the budget is
    `share` of all tokens, and without `share` the least at which the weights take every
    document once (scarce leaves then repeat, up to `max_epochs`)."""
    names = _level_names(levels)
    rows = docs.select(
        *(c.cast("string").alias(n) for n, c in zip(names, levels.values(), strict=True)),
        _base(docs, text).alias("base"),
        text_of(docs, text).alias("text"),
    )
    counted = add_columns(
        rows,
        StructType([StructField("n_tokens", LongType())]),
        lambda bodies: {"n_tokens": tokens.encoder(path).counts(bodies)},
    )
    sized = read_back(counted.drop("text"), "sized")
    totals = sized.groupBy(*names).agg(F.sum("n_tokens").alias("n")).toLocalIterator()
    leaves = {tuple(r[n] for n in names): Leaf(int(r["n"])) for r in totals}
    everything = sum(v.tokens for v in leaves.values())
    of_leaves = {p: v.tokens for p, v in leaves.items()}
    if budget is not None:
        wanted = budget
    elif share is None:
        wanted = whole_budget(of_leaves, weights or {})
    else:
        wanted = int(everything * share)
    given = budgets(of_leaves, wanted, weights or {}, max_epochs)
    for p, leaf in leaves.items():
        leaf.budget = given.get(p, 0)
        if leaf.tokens == 0:
            leaf.epochs = 1
            continue
        leaf.epochs, leaf.left = divmod(leaf.budget, leaf.tokens)
        leaf.open = leaf.left > 0
    while any(v.open for v in leaves.values()):
        _cross(sized, names, leaves, seed)
    return leaves


def select(
    docs: DataFrame, levels: Mapping[str, Column], *, seed: int = SEED, text: str = "text", **options
) -> DataFrame:
    """Rows of `docs` with `epoch` (from 1), one for each epoch a document is taken in."""
    names = _level_names(levels)
    leaves = plan(docs, levels, seed=seed, text=text, **options)
    rows = [(*p, v.epochs, v.prefix, v.bits) for p, v in leaves.items()]
    # The rows travel as one struct, so no column of theirs meets a helper.
    passed = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "epoch"]
    keyed = docs.select(
        F.struct(*passed).alias("_row"),
        *(c.cast("string").alias(n) for n, c in zip(names, levels.values(), strict=True)),
        _base(docs, text).alias("_base"),
    )
    joined = _with_leaves(keyed, names, rows)
    draw = _draw(F.col("_epochs") + 1, F.col("_base"), seed)
    more = (F.col("_bits") > 0) & (
        F.expr(f"shiftrightunsigned(_draw, cast({BITS} - _bits as int))") < F.col("_prefix")
    )
    taken = joined.withColumn("_draw", draw).withColumn(
        "_taken", F.col("_epochs") + F.when(more, 1).otherwise(0)
    )
    return taken.where("_taken > 0").select(
        "_row.*",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_taken"))).alias("epoch"),
    )

