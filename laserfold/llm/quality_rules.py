"""Quality rules: plain counts of a text, then an n-gram likelihood ratio.

Two multinomials over hashed word n-grams (single words and pairs) are counted: one
over the documents of a trusted target, one over the whole corpus. A document's score
is the mean over its n-grams of log(target share / corpus share); that is a
log-likelihood ratio divided by its length. Documents under a fixed threshold go; a
document at the threshold stays.

Both counts are kept in FOLDS parts by a hash of the text, and a text is scored by the
other parts' counts. So neither its own n-grams nor those of its exact copies speak for
it, and trusted texts are held to what texts not seen are held to. An n-gram that the
other parts lack says nothing: its ratio is 1 in every language.

The texts are shuffled once, to meet the trusted doc_ids. A task counts its n-grams in
arrays whose size is the number of buckets and hands on a row per occupied bucket, so
what is shuffled is bounded by tasks × buckets however skewed the words are; the summed
model has at most one row per bucket and is broadcast. A very long text is read whole,
alone in its slice of a batch.

Results: a null or empty text has no words, counts 0 and fails the base rules; texts
without any n-gram score 0. An empty table gives no rows. Without a trusted document in
the other parts nothing can be told apart, so
texts score 0 and the base rules decide alone. Repeated rows are counted and judged each.
Null doc_ids are judged like others and are never trusted. Columns of `docs` named
like results are replaced in `judge` and untouched in `keep`.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from laserfold.llm.common import Batches, add_columns, column, read_back, slices, text_of, texts

BUCKETS = 1 << 17
THRESHOLD = -0.17
PRIOR = 1.0  # added to the target's and to the scaled corpus count of each bucket
FOLDS = 3
MIN_WORDS = 50
REPEAT_PERCENT = 50

SPACES = " \t\n\x0b\x0c\r"  # the code points that part words
SYMBOLS = "#*$%&|<>"  # fixed values of the rule
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = StructType(
    [StructField(n, LongType()) for n in COUNTS]
    + [
        StructField("base_failed", BooleanType()),
        StructField("llr", DoubleType()),
        StructField("kept", BooleanType()),
    ]
)
# Odd multipliers of the polynomial hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: str) -> list[bytes]:
    # Splitting bytes parts at exactly the six code points of SPACES.
    return text.encode("utf-8", "replace").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, equal on every machine."""
    low = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    high = np.fromiter(map(zlib.adler32, words), np.uint64, len(words))
    return low | high << np.uint64(32)


def buckets(hashes: np.ndarray, size: int) -> np.ndarray:
    """Buckets of all single words and pairs of neighbours."""
    pairs = hashes[:-1] * MIX[0] + hashes[1:] * MIX[1]
    both = np.concatenate([hashes * MIX[2], pairs])
    both ^= both >> np.uint64(29)
    both *= MIX[1]
    return (both >> np.uint64(32)).astype(np.int64) % size


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(hashes)
    if n < 4:
        return 0
    windows = hashes[:-2] * MIX[0] + hashes[1:-1] * MIX[1] + hashes[2:] * MIX[2]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(inside.sum())


def base_counts(text: str, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


def fold_of(text: str) -> int:
    """The part of the corpus whose counts a text is in; equal texts share it."""
    return zlib.crc32(text.encode("utf-8", "replace")) % FOLDS


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target share / corpus share) by fold and bucket, from the other folds' counts.

    Both shares are smoothed alike: the corpus is scaled to the target's size first."""
    raw, target = raw.sum(0) - raw, target.sum(0) - target
    scale = target.sum(1, keepdims=True) / np.maximum(raw.sum(1, keepdims=True), 1)
    return np.where(scale > 0, np.log((target + PRIOR) / (raw * scale + PRIOR)), 0.0)


def learn(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    size: int = BUCKETS,
    text: str = "text",
) -> np.ndarray:
    """Log ratios by fold and bucket (see `log_ratios`), counted over all documents.

    `trusted` names the target's documents in its column doc_id."""
    marked = column(docs, "doc_id", "bigint").alias("doc_id")
    rows = docs.select(marked, text_of(docs, text).alias("text"))
    names = trusted.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    # Trusted ids grow with the corpus, so they are never broadcast: one shuffle of the texts.
    rows = rows.join(names.withColumn("chosen", F.lit(True)).hint("merge"), "doc_id", "left")
    sums = [f"{kind}{fold}" for kind in ("raw", "target") for fold in range(FOLDS)]

    def count(batches: Batches) -> Batches:
        raw, target = np.zeros((FOLDS, size), np.int64), np.zeros((FOLDS, size), np.int64)
        for batch in slices(batches):
            chosen = batch.column("chosen").to_pylist()
            for body, good in zip(texts(batch), chosen, strict=True):
                found, fold = buckets(word_hashes(words_of(body)), size), fold_of(body)
                np.add.at(raw[fold], found, 1)
                if good:
                    np.add.at(target[fold], found, 1)
        some = np.flatnonzero(raw.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), *(pa.array(part[some]) for part in (*raw, *target))],
            names=["bucket", *sums],
        )

    schema = ", ".join(f"{name} bigint" for name in ("bucket", *sums))
    parts = rows.select("chosen", "text").mapInArrow(count, schema)
    summed = parts.groupBy("bucket").agg(*(F.sum(name).alias(name) for name in sums))
    # At most `size` rows.
    counted = read_back(summed, "ngram-counts").toPandas()
    both = np.zeros((2 * FOLDS, size))
    both[:, counted["bucket"]] = counted[sums].to_numpy(np.float64).T
    return log_ratios(both[:FOLDS], both[FOLDS:])


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    threshold: float = THRESHOLD,
    size: int = BUCKETS,
    text: str = "text",
) -> DataFrame:
    """doc_id and the results (see FIELDS) of every document."""
    rows = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), text_of(docs, text).alias("text")
    )
    return add_columns(rows, FIELDS, _judged(docs, trusted, threshold, size, text)).drop("text")


def keep(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    threshold: float = THRESHOLD,
    size: int = BUCKETS,
    text: str = "text",
) -> DataFrame:
    """The rows of `docs`, as they are, that the rules keep."""
    compute = _judged(docs, trusted, threshold, size, text)
    return add_columns(docs, FIELDS, compute, keep="kept", text=text)


def _judged(docs, trusted, threshold, size, text):
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, trusted, size=size, text=text))

    def compute(bodies: list[str]) -> dict[str, list]:
        found = {f.name: [] for f in FIELDS}
        for body in bodies:
            words = words_of(body)
            hashes = word_hashes(words)
            counts = base_counts(body, words, hashes)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > REPEAT_PERCENT * counts[0]
            llr = float(model.value[fold_of(body), buckets(hashes, size)].mean()) if words else 0.0
            for name, value in zip(COUNTS, counts, strict=True):
                found[name].append(value)
            found["base_failed"].append(failed)
            found["llr"].append(llr)
            found["kept"].append(not failed and llr >= threshold)
        return found

    return compute
