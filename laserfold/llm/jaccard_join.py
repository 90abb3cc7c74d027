"""Near-duplicate join: MinHash banding, then exact Jaccard on full n-gram sets.

1. Every text is cut into n-grams of words (a text with fewer words is one n-gram);
   a MinHash signature is folded into one hash per band. Equal texts are one class.
   Bands and rows are chosen so that a pair at the threshold shares a band with at
   least the target probability (`bands_for`).
2. Band hashes of the classes are shuffled; classes that share a band are linked to the
   smallest one there (no pairs), and these links are contracted to candidate groups.
3. Only classes of candidate groups get their texts back. A group is split into blocks
   of bounded size, and every pair of blocks is one task, which verifies all its pairs
   on the full n-gram sets by counting common n-grams. So no text is compared by
   signature alone, no pair is emitted, and pairs that no band proposed are found too.
4. What tasks emit is linear: link counts per class and a local spanning star, which
   is contracted to the near-duplicate groups.

Copies are never expanded: a class stands for all documents of equal text.

Results: one row per row of `docs`. `class_id` is the smallest doc_id of the group,
`kept` says that a row carries it, `copy_id` is the smallest doc_id with equal text,
`n_links` counts the other documents linked directly (equal texts included). Null and
empty texts, and texts without a word, link with nothing and are kept. Null doc_ids
rank behind all others; a group of nothing but nulls has a null class_id and is kept.
Rows that repeat a doc_id and its text count as copies. Other columns are ignored.
`deduplicate` keeps one row of each group: a row of the class with the smallest doc_id
(then the smallest key), so also one of a group of nulls, and one of rows that repeat a
doc_id and text. Rows without a word and without a doc_id all stay.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.llm import stars
from laserfold.llm.common import Batches, column, read_back, slices, text_of, texts, unused

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
ROWS = 8
BLOCK = 512
SPACES = " \t\n\x0b\x0c\r"
SEED = 20240229


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of `rows` rows so that a pair of that similarity meets with that probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    words = text.encode("utf-8", "replace").split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        mixed += hashes[i : i + len(mixed)]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


@functools.lru_cache(maxsize=4)
def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    odd = draw.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, size, np.uint64)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit hash per band."""
    factor, shift = _family(bands * rows)
    lowest = np.full(bands * rows, np.iinfo(np.uint64).max)
    for i in range(0, len(grams), 256):
        values = grams[i : i + 256, None] * factor[None, :] + shift[None, :]
        np.minimum(lowest, values.min(0), out=lowest)
    folded = np.zeros(bands, np.uint64)
    for row in lowest.reshape(bands, rows).T:
        folded = (folded ^ row) * np.uint64(0xC2B2AE3D27D4EB4F)
        folded ^= folded >> np.uint64(29)
    return (folded * np.uint64(0x9E3779B97F4A7C15) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def key_of(text: Column) -> Column:
    """Equal texts have equal keys."""
    return F.md5(text.cast("binary"))


def signatures(docs: DataFrame, bands: int, rows: int, words: int, text: str) -> DataFrame:
    """(doc_id, key, hashes) per row; hashes is null for texts without a word."""
    body = text_of(docs, text)
    wanted = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), key_of(body).alias("key"), body.alias("text")
    )

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            sets = [shingles(t, words) for t in texts(batch)]
            found = [band_hashes(s, bands, rows) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "key", "hashes"],
            )

    return wanted.mapInArrow(run, "doc_id bigint, key string, hashes array<bigint>")


def common_counts(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections of two lists of sorted sets."""
    owner = np.repeat(np.arange(len(others)), [len(s) for s in others])
    values = np.concatenate(others) if others else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    found = np.zeros((len(sets), len(others)), np.int64)
    for i, grams in enumerate(sets):
        low = np.searchsorted(values, grams, "left")
        n = np.searchsorted(values, grams, "right") - low
        low, n = low[n > 0], n[n > 0]
        if len(n):
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            found[i] = np.bincount(owner[at], minlength=len(others))
    return found


def local_stars(links: np.ndarray, size: int) -> np.ndarray:
    """Smallest node reachable, for nodes 0..size-1 and an array of linked pairs."""
    root = np.arange(size)
    while len(links):
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        before = root.copy()
        np.minimum.at(root, links[:, 0], low)
        np.minimum.at(root, links[:, 1], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _verify(similarity: float, words: int):
    """Task for one pair of blocks: link counts and spanning star of the classes in it."""

    def run(table: pa.Table) -> pa.Table:
        data = table.select(["key", "block", "left", "right", "n_docs", "text"]).to_pydict()
        seen: dict[str, int] = {}
        for i, key in enumerate(data["key"]):
            seen.setdefault(key, i)
        rows = sorted(seen.values(), key=lambda i: data["key"][i])
        keys = [data["key"][i] for i in rows]
        sets = [shingles(data["text"][i] or "", words) for i in rows]
        sizes = np.array([len(s) for s in sets], np.int64)
        docs = np.array([data["n_docs"][i] for i in rows], np.int64)
        left, right = data["left"][0], data["right"][0]
        blocks = np.array([data["block"][i] for i in rows])
        a, b = np.flatnonzero(blocks == left), np.flatnonzero(blocks == right)
        common = common_counts([sets[i] for i in a], [sets[i] for i in b])
        union = sizes[a][:, None] + sizes[b][None, :] - common
        linked = common >= similarity * union - 1e-9
        if left == right:
            np.fill_diagonal(linked, False)
        x, y = np.nonzero(linked)
        links = np.stack([a[x], b[y]], 1)
        count, docs_linked = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        np.add.at(count, links[:, 0], 1)
        np.add.at(docs_linked, links[:, 0], docs[links[:, 1]])
        if left != right:
            np.add.at(count, links[:, 1], 1)
            np.add.at(docs_linked, links[:, 1], docs[links[:, 0]])
        root = local_stars(links, len(rows))
        some = np.flatnonzero(count)
        return pa.table(
            {
                "key": pa.array([keys[i] for i in some], pa.string()),
                "near": pa.array([keys[root[i]] for i in some], pa.string()),
                "classes": pa.array(count[some], pa.int64()),
                "documents": pa.array(docs_linked[some], pa.int64()),
            }
        )

    return run


def _grouped(
    docs: DataFrame,
    *,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    recall: float = RECALL,
    rows: int = ROWS,
    block: int = BLOCK,
    text: str = "text",
) -> DataFrame:
    """What `join` gives, and with it worded and first_key, the key of the group's first class."""
    bands = bands_for(similarity, recall, rows)
    signed = read_back(signatures(docs, bands, rows, words, text), "signatures")
    classes = read_back(
        signed.groupBy("key").agg(
            F.min("doc_id").alias("copy_id"),
            F.count(F.lit(1)).alias("n_docs"),
            F.first("hashes").alias("hashes"),
        ),
        "classes",
    )
    links = _verified(docs, classes, _candidates(classes), similarity, words, block, text)
    roots = stars.labels(links.select(F.col("key").alias("hi"), F.col("near").alias("lo")))
    degree = links.groupBy("key").agg(F.sum("documents").alias("documents"))
    grouped = classes.join(roots, "key").select("root", "copy_id", "key")
    rank = F.struct(F.col("copy_id").isNull(), "copy_id", "key")
    firsts = grouped.groupBy("root").agg(
        F.min("copy_id").alias("class_id"), F.min(rank)["key"].alias("first_key")
    )
    by_class = (
        classes.select("key", "copy_id", "n_docs", F.col("hashes").isNotNull().alias("worded"))
        .join(roots.join(firsts, "root"), "key", "left")
        .join(degree, "key", "left")
        .select(
            "key",
            "copy_id",
            "worded",
            F.coalesce("class_id", "copy_id").alias("class_id"),
            F.coalesce("first_key", "key").alias("first_key"),
            (F.coalesce("documents", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
        )
    )
    ready = read_back(by_class, "classes-linked")
    alone = ~F.col("worded")
    return signed.select("doc_id", "key").join(ready, "key").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
        (alone | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        "key",
        "worded",
        "first_key",
    )


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links, kept, copy_id, key of every row of `docs`."""
    return _grouped(docs, **options).drop("worded", "first_key")


def _candidates(classes: DataFrame) -> DataFrame:
    """(key, root) of the classes that share a band, directly or through others."""
    exploded = classes.select("key", F.explode("hashes").alias("band"))
    lowest = exploded.groupBy("band").agg(F.min("key").alias("lo"), F.count(F.lit(1)).alias("n"))
    shared = lowest.where("n > 1").select("band", "lo")
    edges = (
        exploded.join(shared, "band")
        .where(F.col("key") != F.col("lo"))
        .select(F.col("key").alias("hi"), "lo")
    )
    return stars.labels(edges)


def _verified(docs, classes, candidates, similarity, words, block, text) -> DataFrame:
    """Verified links as (key, near, classes, documents), per class and task."""
    sizes = candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    spread = F.pmod(F.xxhash64("key"), F.col("blocks"))
    placed = (
        candidates.join(sizes, "root")
        .join(classes.select("key", "copy_id", "n_docs"), "key")
        .select("key", "root", "copy_id", "n_docs", "blocks", spread.alias("block"))
    )
    body = text_of(docs, text)
    bodies = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), key_of(body).alias("key"), body.alias("text")
    )
    found = bodies.withColumnRenamed("key", "k").join(
        placed, F.col("doc_id").eqNullSafe(F.col("copy_id")) & (F.col("k") == F.col("key"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    tasks = found.withColumn("other", other).select(
        "root",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        "block",
        "key",
        "n_docs",
        "text",
    )
    verified = tasks.groupBy("root", "left", "right").applyInArrow(
        _verify(similarity, words), "key string, near string, classes bigint, documents bigint"
    )
    return read_back(verified, "links")


def deduplicate(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, as they are, of which one row per group stays."""
    kept_id, kept_key, again, row = (unused(docs, n) for n in ("kept_id", "kept_key", "repeated", "row"))
    first = ~F.col("worded") | (F.col("key") == F.col("first_key"))
    kept = (
        _grouped(docs, text=text, **options)
        .where(F.col("kept") & first)
        .groupBy(F.col("doc_id").alias(kept_id), F.col("key").alias(kept_key))
        .agg(((F.count(F.lit(1)) > 1) & (F.first("worded") | F.col(kept_id).isNotNull())).alias(again))
    )
    repeats = F.coalesce(F.sum(F.col(again).cast("bigint")), F.lit(0))
    written = runtime.store(kept, "kept", repeats=repeats)
    same = F.col(kept_id).eqNullSafe(column(docs, "doc_id", "bigint")) & (
        key_of(text_of(docs, text)) == F.col(kept_key)
    )
    single = docs.join(written.df.where(~F.col(again)), same, "left_semi")
    n = written.metrics["repeats"]
    if not n:
        return single
    repeated = written.df.where(again).drop(again)
    # Few repeated rows are broadcast by their count, so a row repeated often is no hot task.
    side = F.broadcast(repeated) if n <= runtime.BROADCAST_ROWS else repeated
    # One of the repeats, which does not depend on how rows lie in partitions.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    mark = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind))
    one = docs.join(side, same).groupBy(kept_id, kept_key).agg(F.min_by(whole, mark).alias(row))
    return single.unionByName(one.select(f"{row}.*"))
