"""Approximate nearest neighbours by a forest of hash strings.

Largest inner product is turned into smallest angle by one more component
(sqrt(longest^2 - |x|^2), zero for queries). Each tree gives a vector a string of
HASH_BITS signs of random projections; points with a long common prefix are near.

1. Equal vectors become one class with its smallest vec_ids (as many as a result can
   need). Every class is hashed into every tree, and the strings, sorted, are kept in
   ranges: a tree's strings with the same first bits are one range, and ranges with many
   points (copies of a cluster) are split into blocks, each a sorted array of its own.
2. Descent: a query meets its range in each tree and counts, by bisection, the points
   that share each longer prefix; shorter prefixes are counted from whole ranges.
3. Ascent: all trees go up together from the longest match to the first prefix length at
   which their ranges hold enough points between them. Queries thus stop at different
   lengths. How many points are enough is measured: a bounded sample of queries
   (`sample`) is compared with every vector, and the smallest number is taken at which
   the forest finds the share `recall` of their true neighbours.
4. A query visits the ranges under its prefix; a task multiplies one block of points with
   one block of queries in double precision, each query against its own slice of the
   sorted array, and hands on the best few. Candidates of several trees are merged.

Every vector is indexed and searched. For vectors that point evenly in all directions the
measured number grows to a large share of all, and the work with the square of the rows.

Results: `k` rows per query (or all candidates, if fewer), ranked by score, ties to the
smaller vec_id (null last). Vectors that are null, empty, zero, or hold a null or
non-finite component take no part, neither as query nor as candidate. A vector's
candidates are those of its own dimension. Rows that repeat a vec_id and a vector are
candidates of each other, and each is a query. A score beyond the range of doubles is
infinite. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laserfold.llm.common import Batches, column, read_back
from laserfold.runtime import lookup_join, store

K = 20
TREES = 16
HASH_BITS = 48
SEED = 20_011
RANGE_POINTS = 4_096
BLOCK_POINTS, BLOCK_QUERIES = 8_192, 4_096
PIECE = 256
SAMPLE = 64
RECALL = 0.96
NO_ID = np.iinfo(np.int64).max


def planes(width: int, trees: int, bits: int) -> np.ndarray:
    """The forest's random directions for vectors of one dimension (and one component more)."""
    return np.random.default_rng((SEED, width)).normal(size=(width + 1, trees * bits))


def hashes(x: np.ndarray, log_longest: float | None, trees: int, bits: int) -> np.ndarray:
    """Hash strings of rows as integers of `bits` bits, one column per tree.

    For points, the logarithm of the longest norm gives the component that is added."""
    reach = np.abs(x).max(1, keepdims=True)
    x = x / reach
    if log_longest is None:
        last = np.zeros((len(x), 1))
    else:
        x *= np.exp(np.log(reach) - log_longest)
        last = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))
    signs = np.c_[x, last] @ planes(x.shape[1], trees, bits) > 0
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    return signs.reshape(len(x), trees, bits) @ weights


def rows_of(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A matrix of vectors of one dimension."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row; a pair's value does not depend on the other rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.einsum("nd,nd->n", x, y)


def best_of(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(query row, point row, score) of each query's best k points, ties to smaller ids."""
    found: list[tuple] = []
    if not len(points) or not len(queries):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    longest = np.linalg.norm(points, axis=1).max()
    for top in range(0, len(queries), PIECE):
        own = queries[top : top + PIECE]
        with np.errstate(over="ignore", invalid="ignore"):
            rough = own @ points.T
        if len(points) > k:
            kth = np.partition(rough, len(points) - k, axis=1)[:, len(points) - k]
            slack = 1e-12 * longest * np.linalg.norm(own, axis=1)
            chosen = ~(rough < (kth - slack)[:, None])
        else:
            chosen = np.ones(rough.shape, bool)
        q, p = np.nonzero(chosen)
        scores = dots(own[q], points[p])
        order = np.lexsort((ids[p], -scores, q))
        q, p, scores = q[order], p[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        found.append((q[keep] + top, p[keep], scores[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- classes and strings -------------------------------------------------------------


@dataclass(frozen=True)
class Shape:
    """Numbers that all steps share."""

    k: int
    trees: int
    bits: int
    depth: int  # leading bits that name a range


def _usable(vectors: DataFrame, vec: str) -> DataFrame:
    """id, key, vector of the rows that take part; a null vec_id is the largest number."""
    e = column(vectors, vec, "array<double>")
    odd = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = e.isNotNull() & (F.size(e) > 0) & ~odd & (F.array_max(F.transform(e, F.abs)) > 0)
    # A negative zero is a zero: equal vectors have equal keys.
    plain = F.transform("e", lambda v: v + F.lit(0.0))
    rows = vectors.select(column(vectors, "vec_id", "bigint").alias("vec_id"), e.alias("e"), usable.alias("usable"))
    hashed = F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(SEED), "vector"))
    return (
        rows.where("usable")
        .select(F.coalesce("vec_id", F.lit(int(NO_ID))).alias("id"), plain.alias("vector"))
        .withColumn("key", F.concat_ws("-", F.size("vector"), *hashed))
    )


def _classes(counted: DataFrame, k: int) -> DataFrame:
    """key, width, vector, ids (the k + 1 smallest, with copies), log_norm of distinct vectors.

    The bound on the row number leaves few rows of a class in each task before the shuffle."""
    by_id = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    copies = F.flatten(
        F.transform(
            F.sort_array(F.collect_list(F.struct("id", "times"))),
            lambda own: F.array_repeat(own["id"], F.least(own["times"], F.lit(k + 1)).cast("int")),
        )
    )
    top = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, v: total + F.pow(v / top, F.lit(2.0)))
    return (
        counted.withColumn("place", by_id)
        .where(F.col("place") <= k + 1)
        .groupBy("key")
        .agg(F.slice(copies, 1, k + 1).alias("ids"), F.first("vector").alias("vector"))
        .select("key", F.size("vector").alias("width"), "vector", "ids", (F.log(top) + F.log(squares) / 2).alias("log_norm"))
    )


def _hashed(rows: DataFrame, longest: dict[int, float] | None, shape: Shape) -> DataFrame:
    """`rows` (with width, vector) and their hash strings, one per tree."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            found = np.zeros((len(widths), shape.trees), np.int64)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                x = rows_of(batch.column("vector").take(pa.array(at)))
                found[at] = hashes(x, longest and longest[int(width)], shape.trees, shape.bits)
            ends = np.arange(len(widths) + 1, dtype=np.int32) * shape.trees
            lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "hashes"])

    return rows.mapInArrow(run, f"{_ddl(rows)}, hashes array<bigint>")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _in_trees(rows: DataFrame, shape: Shape) -> DataFrame:
    """One row per tree: tree, hash, range."""
    each = rows.select("*", F.posexplode("hashes").alias("tree", "hash")).drop("hashes")
    return each.withColumn("range", F.shiftright("hash", shape.bits - shape.depth))


# ---- tasks: blocks of points against blocks of queries -----------------------------


def _tasks(points: DataFrame, visits: DataFrame, totals, run, schema: str) -> DataFrame:
    """`run` on every block of points of a range with every block of its queries.

    points and visits are rows in ranges (width, tree, range) with a key each."""
    ranges = ("width", "tree", "range")
    guests = store(
        visits.groupBy(*ranges).agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("guests")),
        "guests",
    )
    here = lookup_join(points, guests, ranges, "inner", spread=("key",))
    here = lookup_join(here, totals, ranges, "inner", spread=("key",))
    there = lookup_join(visits, guests, ranges, "inner", spread=("visitor",))
    there = lookup_join(there, totals, ranges, "inner", spread=("visitor",))
    here = here.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int")).withColumn(
        "guest", F.explode(F.sequence(F.lit(0), F.col("guests") - 1))
    )
    there = there.withColumn("guest", F.pmod(F.xxhash64("visitor"), "guests").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    both = here.drop("blocks", "guests", "points").unionByName(
        there.drop("blocks", "guests", "points"), allowMissingColumns=True
    )
    return both.groupBy(*ranges, "block", "guest").applyInArrow(run, schema)


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(points sorted by hash string, queries) of a task."""
    visiting = table.column("visitor").is_valid()
    points = table.filter(table.column("visitor").is_null()).sort_by([("hash", "ascending"), ("key", "ascending")])
    return points, table.filter(visiting)


def _slices(strings: np.ndarray, wanted: np.ndarray, levels: np.ndarray, bits: int) -> tuple:
    """Where the strings that share the first `levels` bits with `wanted` begin and end."""
    shift = bits - levels
    low = wanted >> shift << shift
    return np.searchsorted(strings, low), np.searchsorted(strings, low + (np.int64(1) << shift))


def _descend(shape: Shape):
    """Counts of points that share each prefix longer than a range's with a query."""

    def run(table: pa.Table) -> pa.Table:
        points, queries = _sides(table)
        strings, wanted = points.column("hash").to_numpy(), queries.column("hash").to_numpy()
        found = []
        for level in range(shape.depth + 1, shape.bits + 1):
            low, high = _slices(strings, wanted, np.full(len(wanted), level), shape.bits)
            some = np.flatnonzero(high > low)
            if not len(some):
                break
            found.append((some, np.full(len(some), level), (high - low)[some]))
        which, level, held = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
        return pa.table(
            {
                "visitor": queries.column("visitor").take(pa.array(which)),
                "level": pa.array(level, pa.int32()),
                "held": pa.array(held, pa.int64()),
            }
        )

    return run


def _search(shape: Shape):
    """The best few points of a block for each query that visits it."""

    def run(table: pa.Table) -> pa.Table:
        points, queries = _sides(table)
        strings, levels = points.column("hash").to_numpy(), queries.column("level").to_numpy()
        low, high = _slices(strings, queries.column("hash").to_numpy(), np.maximum(levels, shape.depth).astype(np.int64), shape.bits)
        near = levels <= shape.depth
        low[near], high[near] = 0, len(strings)
        x = rows_of(points.column("vector")) if len(strings) else np.zeros((0, 1))
        y = rows_of(queries.column("vector"))
        ids = pa.chunked_array(points.column("ids")).combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()] if len(ids) else np.zeros(0, np.int64)
        found = []
        spans, group = np.unique(np.stack([low, high], 1), axis=0, return_inverse=True)
        for i, (start, end) in enumerate(spans.tolist()):
            own = np.flatnonzero(group == i)
            # One more than asked for, as the query's own class may be among them.
            q, p, score = best_of(y[own], x[start:end], first[start:end], shape.k + 1)
            found.append((own[q], p + start, score))
        q, p, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
        q, p = pa.array(q, pa.int64()), pa.array(p, pa.int64())
        return pa.table(
            {
                "visitor": queries.column("visitor").take(q),
                "key": points.column("key").take(p),
                "ids": points.column("ids").take(p),
                "score": pa.array(score, pa.float64()),
            }
        )

    return run


# ---- how far to go up ----------------------------------------------------------------


def _held(points: DataFrame, queries: DataFrame, totals, shape: Shape) -> DataFrame:
    """visitor, level, held: points under a query's prefixes of each length, over all trees."""
    longer = _tasks(
        points.select("width", "tree", "range", "key", "hash"),
        queries.select("width", "tree", "range", "visitor", "hash"),
        totals,
        _descend(shape),
        "visitor string, level int, held bigint",
    )
    levels = F.explode(F.sequence(F.lit(0), F.lit(shape.depth))).alias("level")
    prefix = F.expr(f"shiftright(range, {shape.depth} - level)").alias("prefix")
    known = store(
        totals.df.select("width", "tree", "range", "points", levels)
        .groupBy("width", "tree", "level", prefix)
        .agg(F.sum("points").alias("held")),
        "prefix-counts",
    )
    asked = queries.select("width", "tree", "range", "visitor", levels).select(
        "width", "tree", "level", prefix, "visitor"
    )
    shorter = lookup_join(asked, known, ("width", "tree", "level", "prefix"), "inner", spread=("visitor",))
    both = longer.unionByName(shorter.select("visitor", "level", "held"))
    return both.groupBy("visitor", "level").agg(F.sum("held").alias("held"))


def _true_neighbours(points: DataFrame, asked: list, shape: Shape) -> dict[str, list[int]]:
    """For each of the few sampled queries, the longest prefix that each true neighbour shares.

    Each task keeps its best `k` per query, so `len(asked)` x k rows leave it."""
    by_width: dict[int, list] = {}
    for row in asked:
        by_width.setdefault(row["width"], []).append(row)

    def run(batches: Batches) -> Batches:
        best: dict[str, list] = {}
        for batch in batches:
            widths = batch.column("width").to_numpy()
            keys = np.array(batch.column("key").to_pylist(), object)
            strings = rows_of(batch.column("hashes"))
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                own = by_width.get(int(width))
                if not own:
                    continue
                x = rows_of(batch.column("vector").take(pa.array(at)))
                y = np.array([row["vector"] for row in own])
                q, p, score = best_of(y, x, np.arange(len(x)), shape.k + 1)
                differ = np.array([row["hashes"] for row in own])[q] ^ strings[at[p]]
                shared = (shape.bits - np.ceil(np.log2(differ + 1.0))).max(1)
                for i, j, s, prefix in zip(q, at[p], score, shared, strict=True):
                    if keys[j] != own[i]["key"]:
                        best.setdefault(own[i]["visitor"], []).append((s, int(prefix)))
            best = {v: sorted(found, reverse=True)[: shape.k] for v, found in best.items()}
        rows = [(v, s, prefix) for v, found in best.items() for s, prefix in found]
        types = pa.string(), pa.float64(), pa.int32()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["visitor", "score", "shared"]
        )

    found = points.select("width", "key", "vector", "hashes").mapInArrow(
        run, "visitor string, score double, shared int"
    )
    place = F.row_number().over(Window.partitionBy("visitor").orderBy(F.desc("score"), F.desc("shared")))
    result: dict[str, list[int]] = {}
    for row in found.withColumn("place", place).where(F.col("place") <= shape.k).collect():
        result.setdefault(row["visitor"], []).append(row["shared"])
    return result


def enough(held: dict[str, dict[int, int]], shared: dict[str, list[int]], floor: int, recall: float) -> int:
    """The smallest number of points, from `floor` by steps of a fifth, that finds `recall`."""
    wanted = float(floor)
    most = max((levels[0] for levels in held.values()), default=0)
    while wanted < most:
        hits = total = 0
        for visitor, prefixes in shared.items():
            level = max((at for at, n in held[visitor].items() if n >= wanted), default=0)
            hits += sum(prefix >= level for prefix in prefixes)
            total += len(prefixes)
        if hits >= recall * total:
            break
        wanted *= 1.2
    return math.ceil(wanted)


# ---- the operator --------------------------------------------------------------------

RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def search(
    vectors: DataFrame,
    *,
    every: int,
    k: int = K,
    trees: int = TREES,
    bits: int = HASH_BITS,
    range_points: int = RANGE_POINTS,
    sample: int = SAMPLE,
    recall: float = RECALL,
    vec: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    counted = _usable(vectors, vec).groupBy("key", "id").agg(
        F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector")
    )
    counted = read_back(counted, "vector-rows")
    known = read_back(_classes(counted, k), "vector-classes")
    # One row per dimension that occurs.
    sizes = known.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max("log_norm").alias("longest")).collect()
    if not sizes:
        return spark.createDataFrame([], RESULT)
    depth = max(0, math.ceil(math.log2(max(row["n"] for row in sizes) / range_points)))
    shape = Shape(k, trees, bits, min(depth, bits - 1))
    points = read_back(
        _hashed(known.drop("log_norm"), {row["width"]: row["longest"] for row in sizes}, shape), "points"
    )
    asking = counted.where((F.col("id") != int(NO_ID)) & (F.col("id") % every == 0)).select(
        F.concat_ws("/", "key", "id").alias("visitor"), "key", "id", "times",
        F.size("vector").alias("width"), "vector",
    )
    queries = read_back(_hashed(asking, None, shape), "queries")
    in_trees, asked = _in_trees(points, shape), _in_trees(queries, shape)
    totals = store(
        in_trees.groupBy("width", "tree", "range")
        .agg(F.count(F.lit(1)).alias("points"))
        .withColumn("blocks", F.ceil(F.col("points") / BLOCK_POINTS).cast("int")),
        "ranges",
    )
    held = read_back(_held(in_trees, asked, totals, shape), "held")
    few = queries.orderBy(F.xxhash64("visitor"), "visitor").limit(sample).collect()
    chosen = [row["visitor"] for row in few]
    by_visitor: dict[str, dict[int, int]] = {}
    for row in held.where(F.col("visitor").isin(chosen)).collect():  # a row per sampled query and level
        by_visitor.setdefault(row["visitor"], {})[row["level"]] = row["held"]
    wanted = enough(by_visitor, _true_neighbours(points, few, shape), trees * (k + 1), recall)
    stops = held.groupBy("visitor").agg(
        F.coalesce(F.max(F.when(F.col("held") >= wanted, F.col("level"))), F.lit(0)).alias("level")
    )
    # At the root every tree holds the same points, so one is enough.
    routed = asked.join(stops, "visitor").where((F.col("level") > 0) | (F.col("tree") == 0))
    up = F.expr(f"greatest({shape.depth} - level, 0)")
    under = F.expr("shiftleft(shiftright(range, up), up)")
    routed = routed.withColumn("up", up).withColumn("low", under)
    visits = routed.withColumn(
        "range", F.explode(F.expr("sequence(low, low + shiftleft(1L, up) - 1)"))
    ).select("width", "tree", "range", "visitor", "hash", "level", "vector")
    found = _tasks(
        in_trees.select("width", "tree", "range", "key", "hash", "vector", "ids"),
        visits,
        totals,
        _search(shape),
        "visitor string, key string, ids array<bigint>, score double",
    )
    own = queries.select("visitor", F.col("key").alias("own_key"), F.col("id").alias("query_id"), "times")
    merged = (
        found.repartition("visitor")
        .groupBy("visitor", "key")
        .agg(F.first("ids").alias("ids"), F.max("score").alias("score"))
        .join(own, "visitor")
    )
    others = F.expr("filter(ids, (x, i) -> key != own_key OR i != array_position(ids, query_id) - 1)")
    each = merged.select("visitor", "query_id", "times", "score", F.explode(others).alias("id"))
    rank = F.row_number().over(Window.partitionBy("visitor").orderBy(F.desc("score"), "id"))
    best = each.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("_time", F.explode(F.sequence(F.lit(1), "times"))).select(
        "query_id", "rank", F.nullif("id", F.lit(int(NO_ID))).alias("vec_id"), "score"
    )
