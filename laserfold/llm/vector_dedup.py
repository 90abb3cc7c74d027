"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

1. Vectors equal in every component become one class, so copies are never compared.
2. Each dimension has cells of its own; vectors of different dimensions never meet. In a
   dimension with more than `cell_rows` vectors, spherical k-means is fitted to its part
   of a bounded sample (`sample`) and gives every vector its nearest centre as home cell;
   a rarer dimension is one cell. A vector also visits each lower-numbered cell that a
   vector within the threshold of it can be at home in: if u is at home in i and v in j,
   v's products with both centres differ by at most |u - v| |c_i - c_j| (`reach`). So
   every pair within the threshold meets in the lower of the two homes, and only there:
   the search is exact for any vectors. Vectors that point evenly in all directions of
   many dimensions reach most cells; then the work grows with the square of the rows.
   A `spread` shrinks the border to where that many shares of 1/sqrt(d) of the distance
   reach, which loses pairs; no query sets it.
3. Homes and visitors of a cell are split into blocks of bounded size. A task takes one
   block of homes and one block of homes or visitors, multiplies them in single precision
   piece by piece, checks what comes near the threshold in double precision, and hands on
   link counts and a local spanning star: linear output, no pairs.
4. The stars are contracted to components.

Results: one row per row of `vectors`. Vectors that are null, empty, zero, or hold a null
or non-finite component link with nothing: no links, their own vec_id as component, kept.
Components keep the precision they come in (single or double), so finite doubles beyond
single precision take part. Equal vectors link with each
other. Null vec_ids rank behind all others; rows that repeat a vec_id and vector count as
copies. Other columns (labels too) are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.llm import stars
from laserfold.llm.common import Batches, column, read_back
from laserfold.llm.jaccard_join import local_stars
from laserfold.runtime import lookup_join, store

THRESHOLD = 0.9
SAMPLE = 20_000
CELL_ROWS = 2_000
MAX_CELLS = 1_024
BLOCK = 2_048
# A block of visitors has at most so many components (and at least BLOCK vectors).
GUEST_VALUES = 1 << 20
# Rows and columns of one product, and how many links are held before they become a star.
PIECE = 512, 4_096
HELD_LINKS = 1 << 20
ROUNDS = 12
SEED = 7


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Unit centres (k or fewer rows) fitted to unit vectors x."""
    k = max(1, min(k, len(x)))
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), k, replace=False)] if len(x) else np.zeros((1, 1))
    for _ in range(rounds if len(x) else 0):
        home = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        good = norms > 1e-12
        centres[good] = sums[good] / norms[good, None]
    return np.unique(centres.round(12), axis=0)


def reach(
    x: np.ndarray, centres: np.ndarray, threshold: float, spread: float | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of unit vectors, and which lower cells each visits (a boolean matrix)."""
    products = x @ centres.T
    home = products.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))[home]
    ahead = products[np.arange(len(x)), home][:, None] - products
    # Greatest distance of two vectors within the threshold.
    bound = math.sqrt(2 - 2 * threshold) + 1e-9
    if spread is not None:
        bound *= min(1.0, spread / math.sqrt(centres.shape[1]))
    visits = (ahead <= bound * apart) & (np.arange(len(centres)) < home[:, None])
    return home, visits


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    # Scaled first, so that the squares of very large or small components stay finite.
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[np.ndarray]:
    """Pairs of rows of x and y whose product reaches the threshold, as arrays (i, j)."""
    # The rounding of single precision, of the components and of their sum.
    slack = (x.shape[1] + 8) * 2.0**-23
    single = x.astype(np.float32), y.astype(np.float32)
    tall, wide = PIECE
    for top in range(0, len(x), tall):
        for left in range(0, len(y), wide):
            rough = single[0][top : top + tall] @ single[1][left : left + wide].T
            at = np.flatnonzero(rough >= np.float32(threshold - slack))
            if not len(at):
                continue
            i, j = np.divmod(at, rough.shape[1])
            if len(at) > rough.size // 16:
                exact = (x[top : top + tall] @ y[left : left + wide].T)[i, j]
            else:
                exact = np.einsum("nd,nd->n", x[top + i], y[left + j])
            good = exact >= threshold
            if good.any():
                yield np.stack([top + i[good], left + j[good]], 1)


def _compare(threshold: float):
    """Task for two blocks of a cell."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        keys = table.column("key")
        docs = table.column("n_docs").to_numpy()
        side = table.column("side").to_numpy()
        x = _matrix(table.column("vector"), table.column("size")[0].as_py())
        same = table.column("right")[0].as_py() == table.column("left")[0].as_py()
        a = np.flatnonzero(side == 0)
        b = a if same else np.flatnonzero(side == 1)
        found = np.zeros(len(keys), np.int64)
        root = np.arange(len(keys))
        held, n = [], 0

        def star() -> np.ndarray:
            return local_stars(np.concatenate([*held, np.stack([np.arange(len(root)), root], 1)]), len(root))

        for pairs in near_pairs(x[a], x[b], threshold):
            links = np.stack([a[pairs[:, 0]], b[pairs[:, 1]]], 1)
            links = links[links[:, 0] != links[:, 1]]
            np.add.at(found, links[:, 0], docs[links[:, 1]])
            if not same:
                np.add.at(found, links[:, 1], docs[links[:, 0]])
            held.append(links)
            n += len(links)
            if n > HELD_LINKS:
                root, held, n = star(), [], 0
        root = star() if n else root
        some = np.flatnonzero(found)
        return pa.table(
            {
                "key": keys.take(pa.array(some)),
                "near": keys.take(pa.array(root[some])),
                "documents": pa.array(found[some], pa.int64()),
            }
        )

    return run


def _kind(vectors: DataFrame, vec: str) -> str:
    """Single precision where the column holds it, else double."""
    given = dict(vectors.dtypes).get(vec)
    return given if given == "array<float>" else "array<double>"


def classes_of(vectors: DataFrame, vec: str) -> tuple[DataFrame, DataFrame]:
    """(vec_id, key) of all rows, key null where nothing links; and the distinct vectors."""
    e = column(vectors, vec, _kind(vectors, vec))
    top = F.array_max(F.transform(e, lambda v: F.abs(v)))
    odd = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = e.isNotNull() & (F.size(e) > 0) & ~odd & (top > 0)
    rows = vectors.select(column(vectors, "vec_id", "bigint").alias("vec_id"), e.alias("vector"), usable.alias("usable"))
    key = F.concat(
        F.hex(F.xxhash64("vector")), F.lit("-"), F.hex(F.xxhash64(F.lit(SEED), "vector"))
    )
    keyed = rows.select("vec_id", "vector", F.when(F.col("usable"), key).alias("key"))
    distinct = (
        keyed.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("copy_id"),
            F.count(F.lit(1)).alias("n_docs"),
            F.first("vector").alias("vector"),
        )
    )
    return keyed.select("vec_id", "key"), distinct


def link(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    max_cells: int = MAX_CELLS,
    block: int = BLOCK,
    spread: float | None = None,
    vec: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors`."""
    keyed, distinct = classes_of(vectors, vec)
    distinct = read_back(distinct, "vector-classes")
    n = distinct.count()
    lot = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    size = F.size("vector").alias("size")
    counts = distinct.groupBy(size).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > cell_rows)
    # A row for each dimension with more than `cell_rows` vectors.
    rows_of = {r["size"]: r["rows"] for r in counts.collect()}
    drawn = distinct if n <= sample else distinct.where(lot < int((1 << 30) * sample / n))
    # Bounded by `sample` vectors.
    got = drawn.where(F.size("vector").isin(*rows_of)).select("key", size, "vector").toArrow().sort_by("key")
    fitted = {}
    for width, rows in rows_of.items():
        part = got.filter(pc.equal(got.column("size"), width)).column("vector")
        if len(part):
            number = min(max_cells, math.ceil(rows / cell_rows))
            fitted[width] = spherical_kmeans(_matrix(part, width), number)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def assign(batches: Batches) -> Batches:
        for whole in batches:
            widths = pc.list_value_length(whole.column("vector"))
            for width in pc.unique(widths).to_pylist():
                batch = whole.filter(pc.equal(widths, width))
                if width in shared.value:
                    x = _matrix(batch.column("vector"), width)
                    home, visits = reach(x, shared.value[width], threshold, spread)
                else:
                    home, visits = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, 0))
                row, cell = np.nonzero(visits)
                ends = np.searchsorted(row, np.arange(len(home) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("key", "n_docs", "vector")),
                        pa.array(np.full(len(home), width), pa.int32()),
                        pa.array(home, pa.int32()),
                        pa.ListArray.from_arrays(ends, pa.array(cell, pa.int32())),
                    ],
                    names=["key", "n_docs", "vector", "size", "home", "visits"],
                )

    kind = distinct.schema["vector"].dataType.simpleString()
    homes = read_back(
        distinct.select("key", "n_docs", "vector").mapInArrow(
            assign,
            f"key string, n_docs bigint, vector {kind}, size int, home int, visits array<int>",
        ),
        "cells",
    )
    cells = F.explode(F.concat(F.array("home"), "visits")).alias("cell")
    at_home = F.col("home") == F.col("cell")
    guests = F.greatest(F.lit(block), F.floor(GUEST_VALUES / F.col("size")))
    # At most `max_cells` rows for each dimension.
    sizes = homes.select("size", "home", cells).groupBy("size", "cell").agg(
        F.ceil(F.count(F.when(at_home, 1)) / block).cast("int").alias("homes"),
        F.ceil(F.count(F.when(~at_home, 1)) / guests).cast("int").alias("guests"),
    )
    in_cells = homes.select("key", "n_docs", "vector", "size", "home", cells)
    placed = lookup_join(
        in_cells, store(sizes, "cell-sizes"), ["size", "cell"], "inner", spread=("key",)
    ).where("homes > 0")
    own = F.pmod(F.xxhash64("key"), F.when(at_home, F.col("homes")).otherwise(F.col("guests"))).cast("int")
    placed = placed.withColumn("own", own)
    # Home blocks are 0..homes-1, guest blocks follow. A task compares left with right.
    as_left = F.sequence(F.col("own"), F.col("homes") + F.col("guests") - 1)
    as_right = F.when(
        at_home & (F.col("own") > 0), F.sequence(F.lit(0), F.col("own") - 1)
    ).when(~at_home, F.sequence(F.lit(0), F.col("homes") - 1))
    place = F.when(at_home, F.col("own")).otherwise(F.col("homes") + F.col("own"))
    lefts = F.when(
        at_home, F.transform(as_left, lambda r: F.struct(F.col("own").alias("left"), r.alias("right"), F.lit(0).alias("side")))
    ).otherwise(F.array().cast("array<struct<left:int,right:int,side:int>>"))
    rights = F.transform(
        F.coalesce(as_right, F.array().cast("array<int>")),
        lambda s: F.struct(s.alias("left"), place.alias("right"), F.lit(1).alias("side")),
    )
    tasks = placed.select("size", "cell", "key", "n_docs", "vector", F.inline(F.concat(lefts, rights)))
    links = read_back(
        tasks.groupBy("size", "cell", "left", "right").applyInArrow(
            _compare(threshold),
            "key string, near string, documents bigint",
        ),
        "vector-links",
    )
    roots = stars.labels(links.select(F.col("key").alias("hi"), F.col("near").alias("lo")))
    degree = links.groupBy("key").agg(F.sum("documents").alias("documents"))
    small = distinct.select("key", "copy_id", "n_docs")
    firsts = small.join(roots, "key").groupBy("root").agg(F.min("copy_id").alias("first"))
    by_class = (
        small.join(roots.join(firsts, "root"), "key", "left")
        .join(degree, "key", "left")
        .select(
            "key",
            F.coalesce("first", "copy_id").alias("component_id"),
            (F.coalesce("documents", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
        )
    )
    ready = read_back(by_class, "vectors-linked")
    joined = keyed.where("key is not null").join(ready, "key").select("vec_id", "n_links", "component_id")
    alone = keyed.where("key is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
