"""Quality classifier: an additive model with pairwise interactions.

Each text is measured by a fixed set of features. The model is a sum of lookup tables,
one per feature and one per chosen pair of features, over quantile bins. The tables are
grown by cyclic boosting: in every round each feature in turn gets a shallow tree (at
most four leaves) fitted to the present residuals, and the tree is added to the
feature's table; afterwards the pairs with the largest remaining gain get tables the
same way. Scoring looks a document's bins up and adds the table values.

Training takes a bounded sample of the labelled rows (`sample`, a parameter): their
features, not their texts, reach the driver. The labels of the sample are broadcast to
the documents, so nothing is shuffled; scoring is one pass.

Results: a null or empty text has all features 0 and gets a score like any other. Rows
with a null doc_id are scored and never learned from. A doc_id labelled twice counts
once, by its larger label; null labels are left out. If the sample holds only one kind
of label (or none), every score is that kind's share (or 0.5). Repeated rows get equal
scores. Columns named like results are replaced in `score` and untouched in `keep`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from laserfold.llm.common import Batches, add_columns, column, slices, text_of

SAMPLE = 20_000
FIELDS = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])
FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "distinct_pairs", "twin_words",
    "upper_words", "marks", "symbols", "digits", "stops", "line_repeats", "words_per_line",
    "top_word", "worst_block",
)
BLOCK = 40


def features(text: str) -> list[float]:
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper = list(map(str.isupper, words))
    # Share of odd words in the worst stretch, so that half-spoilt texts stand out.
    odd = np.array(upper) | np.array([False, *map(eq, words, words[1:])])
    odd |= np.fromiter((not w[-1].isalnum() and len(w) > 3 and w[-1] == w[-2] for w in words), bool, n)
    sums = np.concatenate([[0], np.cumsum(odd)])
    width = min(BLOCK, n)
    worst = float((sums[width:] - sums[:-width]).max()) / width
    return [
        float(np.log1p(chars)),
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n,
        pairs / max(1, n - 1),
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        sum(upper) / n,
        sum(map(text.count, "!?;:")) / n,
        sum(map(text.count, "#*$%&|<>")) / n,
        sum(map(text.count, "0123456789")) / chars,
        sum(map(text.count, ".,")) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        n / max(1, len(lines)),
        max(counts.values()) / n,
        worst,
    ]


def matrix(texts: Sequence[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass
class Additive:
    """Bin edges, lookup tables, and the constant of an additive model."""

    constant: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros(x.shape, np.int64)
        for i, edges in enumerate(self.edges):
            found[:, i] = np.searchsorted(edges, x[:, i], "right")
        return found

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.constant)
        for i, table in enumerate(self.tables):
            total += table[b[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[b[:, i], b[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, least: float = 2.0) -> np.ndarray:
    """Leaf value by bin of a greedy tree over ordered bins with gradient sums g, weights h."""
    value = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return value
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gains = _gain(left_g, left_h) + _gain(right_g, right_h)
    gains[(left_h < least) | (right_h < least)] = -1.0
    cut = int(gains.argmax()) + 1
    if gains[cut - 1] <= _gain(g.sum(), h.sum()) + 1e-9:
        return value
    return np.concatenate(
        [_tree(g[:cut], h[:cut], depth - 1, least), _tree(g[cut:], h[cut:], depth - 1, least)]
    )


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best cut of both axes into four cells: values of the cells, and their gain."""
    def sums(a):
        return np.cumsum(np.cumsum(a, 0), 1)

    G, H = sums(g), sums(h)
    g11, h11 = G[:-1, :-1], H[:-1, :-1]
    g12, h12 = G[:-1, -1:] - g11, H[:-1, -1:] - h11
    g21, h21 = G[-1:, :-1] - g11, H[-1:, :-1] - h11
    g22, h22 = G[-1, -1] - g11 - g12 - g21, H[-1, -1] - h11 - h12 - h21
    gains = _gain(g11, h11) + _gain(g12, h12) + _gain(g21, h21) + _gain(g22, h22)
    if not gains.size:
        return np.zeros_like(g), 0.0
    a, b = np.unravel_index(int(gains.argmax()), gains.shape)
    value = np.zeros_like(g)
    cells = ((g11, h11), (g12, h12), (g21, h21), (g22, h22))
    v = [x[a, b] / (y[a, b] + 1.0) for x, y in cells]
    value[: a + 1, : b + 1], value[: a + 1, b + 1 :] = v[0], v[1]
    value[a + 1 :, : b + 1], value[a + 1 :, b + 1 :] = v[2], v[3]
    return value, float(gains[a, b])


def fit(
    x: np.ndarray,
    y: np.ndarray,
    *,
    bins: int = 48,
    rounds: int = 150,
    pair_rounds: int = 60,
    n_pairs: int = 6,
    rate: float = 0.1,
) -> Additive:
    """Boost the lookup tables on features x and labels y (0 or 1)."""
    model = Additive()
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        model.constant = 0.0 if len(y) == 0 else (30.0 if share else -30.0)
        return model
    model.constant = float(np.log(share / (1 - share)))
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, i], cuts)) for i in range(x.shape[1])]
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    margin = np.full(len(y), model.constant)

    def residuals():
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for i, size in enumerate(sizes):
            r, w = residuals()
            g, h = np.bincount(b[:, i], r, size), np.bincount(b[:, i], w, size)
            step = rate * _tree(g, h)
            model.tables[i] += step
            margin += step[b[:, i]]

    def grid(i, j):
        r, w = residuals()
        flat, shape = b[:, i] * sizes[j] + b[:, j], (sizes[i], sizes[j])
        n = shape[0] * shape[1]
        return np.bincount(flat, r, n).reshape(shape), np.bincount(flat, w, n).reshape(shape)

    every = [(i, j) for i in range(len(sizes)) for j in range(i + 1, len(sizes))]
    ranked = sorted(every, key=lambda p: (-_pair_tree(*grid(*p))[1], p))
    model.pairs = ranked[:n_pairs]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for table, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            step = rate * _pair_tree(*grid(i, j))[0]
            table += step
            margin += step[b[:, i], b[:, j]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are kept for testing: the remainder 1 of crc32(doc_id) by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, text: str = "text"
) -> Additive:
    """Fit the model to at most about `sample` labelled documents outside the held-out part."""
    doc_id = F.col("doc_id").cast("bigint")
    known = (
        labels.select(doc_id.alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    n = known.count()
    if n > sample:
        spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        known = known.where(spread < int((1 << 30) * sample / n))
    # Bounded by `sample` rows of two numbers.
    rows = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), text_of(docs, text).alias("text")
    ).join(F.broadcast(known), "doc_id")
    # One row per label, however often its doc_id repeats: that of the least text hash.
    rows = rows.groupBy("doc_id", "quality").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    )
    fields = ", ".join(f"{f} double" for f in FEATURES)

    def measure(batches: Batches) -> Batches:
        for batch in slices(batches):
            x = matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), *map(pa.array, x.T)],
                names=["doc_id", "quality", *FEATURES],
            )

    got = (
        rows.select("doc_id", "quality", "text")
        .mapInArrow(measure, f"doc_id bigint, quality int, {fields}")
        .toPandas()
        .sort_values(["doc_id", *FEATURES])
    )
    return fit(got[list(FEATURES)].to_numpy(float), got["quality"].to_numpy(float))


def _scored(docs: DataFrame, model: Additive, threshold: float):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(bodies: list[str]) -> dict[str, list]:
        score = shared.value.score(matrix(bodies))
        good = score >= threshold
        return {"score": score, "predicted": good.astype(np.int32), "keep": good}

    return compute


def score(
    docs: DataFrame, model: Additive, *, threshold: float = 0.5, text: str = "text"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    doc_id = column(docs, "doc_id", "bigint")
    rows = docs.select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), text_of(docs, text).alias("text")
    )
    return add_columns(rows, FIELDS, _scored(docs, model, threshold)).drop("text")


def keep(
    docs: DataFrame, model: Additive, *, threshold: float = 0.5, text: str = "text"
) -> DataFrame:
    """The rows of `docs`, as they are, that the model takes for good."""
    return add_columns(docs, FIELDS, _scored(docs, model, threshold), keep="keep", text=text)
