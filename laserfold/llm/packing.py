"""Mixture-controlled packing of token ids into fixed-length sequences.

Every source is a queue of its documents' tokens. Deficit round-robin serves the
queues: in each round a queue's credit grows by its quantum (window length × target
share), whole tokens are taken and the fraction is carried to the next round. What is
taken forms one stream without gaps, cut into sequences. When a queue runs dry the
others go on with their shares raised in proportion, so every token is packed; windows
hold all targets until the first queue is dry, and those of the others after that.

The credit after m rounds is m × quantum, so the round that takes a given token of a
queue follows from the token's place in the queue. Spark therefore needs no sequential
pass: documents are range-partitioned by (source, doc_id) and encoded once; only the
token totals per (partition, source), at most partitions + sources rows, go through
the driver to make the schedule, which every task then applies to its own rows. A
source with a third of all rows is many partitions.

Results: a null text is empty; each document ends with `end_id`, so an empty one is one
token; a null source is a queue of its own; null doc_ids come first; repeated rows are
packed each; documents of equal doc_id in a queue follow the hash of their text; very
long texts are encoded whole and cut only where windows and sequences end; other columns
are ignored; an empty table gives no pieces. The last,
incomplete sequence is cut into powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.llm import tokens
from laserfold.llm.common import Batches, column, read_back, slices, text_of

SEQUENCE = 4096
END_ID = 2
# Tokens of one round over all queues; several sequences, so that few documents are cut.
WINDOW = 8 * SEQUENCE
# Credits are counted in this fraction of a token.
UNIT = 4096

ENCODED = "part int, queue string, doc_id bigint, first bigint, n_tokens bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, source string, ids_crc32 bigint"
)


@dataclass(frozen=True)
class Phase:
    """Rounds between two exhaustions: all arrays are by queue, in queue order."""

    served: np.ndarray  # tokens taken before the phase
    credit: np.ndarray  # quantum in units
    rounds: int
    ends: np.ndarray  # tokens taken when the phase is over, last short round included
    position: int  # of the phase's first token in the stream


def schedule(
    totals: Mapping[str, int],
    weights: Mapping[str, float] | None,
    window: int,
    rest: float = 0.0,
):
    """Queue order and phases that serve every token.

    `weights` are target shares; without them each queue has its share of all tokens.
    Queues that `weights` does not name divide the share `rest` by their tokens. Queues
    of no weight are served after the others."""
    names = sorted(totals)
    left = np.array([totals[n] for n in names], dtype=np.int64)
    if weights is None:
        share = left.astype(float)
    else:
        named = np.array([n in weights for n in names], dtype=bool)
        given = np.array([max(0.0, float(weights.get(n, 0.0))) for n in names])
        unnamed = np.where(named, 0.0, left.astype(float))
        share = given + max(0.0, rest) * unnamed / max(1.0, unnamed.sum())
    served = np.zeros(len(names), np.int64)
    phases, position = [], 0
    while left.any():
        live = left > 0
        wanted = np.where(live, share, 0.0)
        if not wanted.any():
            wanted = np.where(live, left, 0).astype(float)
        credit = np.floor(wanted / wanted.sum() * window * UNIT).astype(np.int64)
        credit = np.where(wanted > 0, np.maximum(credit, 1), 0)
        fed = credit > 0
        # Most rounds in which no queue is asked for more than it has.
        rounds = int((((left[fed] + 1) * UNIT - 1) // credit[fed]).min())
        full = rounds * credit // UNIT
        short = np.minimum((rounds + 1) * credit // UNIT - full, left - full)
        phases.append(Phase(served, credit, rounds, served + full + short, position))
        position += int((full + short).sum())
        served = served + full + short
        left = left - full - short
    return names, phases


def place(phases: list[Phase], queue: int, first: int, last: int):
    """Stream runs of the queue's tokens [first, last): arrays (queue place, position, length)."""
    found = []
    for phase in phases:
        low, high = max(first, int(phase.served[queue])), min(last, int(phase.ends[queue]))
        if low >= high:
            continue
        credit, base = int(phase.credit[queue]), int(phase.served[queue])

        def after(m, credit=phase.credit, phase=phase):  # tokens taken after m rounds, all queues
            taken = np.asarray(m, np.int64)[:, None] * credit[None, :] // UNIT
            return np.minimum(taken, (phase.ends - phase.served)[None, :])

        # The first round after which more than x tokens are taken.
        begin = min(-(-(low - base + 1) * UNIT // credit), phase.rounds + 1)
        end = min(-(-(high - base) * UNIT // credit), phase.rounds + 1)
        for chunk in range(begin, end + 1, 4096):
            m = np.arange(chunk, min(chunk + 4096, end + 1), dtype=np.int64)
            before, now = after(m - 1), after(m)
            taken = now - before
            start = phase.position + before.sum(1) + taken[:, :queue].sum(1)
            a = np.maximum(before[:, queue] + base, low)
            b = np.minimum(now[:, queue] + base, high)
            some = b > a
            found.append((a[some], (start + a - base - before[:, queue])[some], (b - a)[some]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def sequences(total: int, length: int) -> tuple[np.ndarray, int]:
    """Positions where the sequences of the tail start, and where the tail starts."""
    tail = total - total % length
    starts, at, size = [], tail, length
    while at < total:
        while size > total - at:
            size //= 2
        starts.append(at)
        at += size
    return np.array(starts, np.int64), tail


def stored_type(path: str, end_id: int) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    most = max(tokens.encoder(path).tokenizer.get_vocab_size() - 1, end_id)
    return "<u2" if most < 1 << 16 else "<u4"


def encode(docs: DataFrame, path: str, end_id: int, queue: str, text: str) -> DataFrame:
    """Documents in queue order with their ids, written once."""
    rows = docs.select(
        column(docs, queue, "string").alias("queue"),
        column(docs, "doc_id", "bigint").alias("doc_id"),
        text_of(docs, text).alias("text"),
    )

    stored = stored_type(path, end_id)
    width, ending = np.dtype(stored).itemsize, np.uint32(end_id)

    def run(batches: Batches) -> Batches:
        make = tokens.encoder(path)
        part = TaskContext.get().partitionId()
        before: dict[str | None, int] = {}  # tokens of a queue earlier in this partition
        for batch in slices(batches):
            found = (np.frombuffer(make.ids(t), "<u4") for t in batch.column("text").to_pylist())
            ids = [np.append(x, ending).astype(stored).tobytes() for x in found]
            counts = [len(x) // width for x in ids]
            firsts = []
            for name, n in zip(batch.column("queue").to_pylist(), counts, strict=True):
                firsts.append(before.get(name, 0))
                before[name] = firsts[-1] + n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    batch.column("queue"),
                    batch.column("doc_id"),
                    pa.array(firsts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "queue", "doc_id", "first", "n_tokens", "ids"],
            )

    ordered = rows.repartitionByRange("queue", "doc_id").sortWithinPartitions(
        "queue", "doc_id", F.xxhash64("text")
    )
    return read_back(ordered.mapInArrow(run, ENCODED), "encoded")


def pack(
    docs: DataFrame,
    path: str,
    *,
    end_id: int = END_ID,
    length: int = SEQUENCE,
    window: int = WINDOW,
    weights: Mapping[str, float] | None = None,
    rest: float = 0.0,
    queue: str = "source",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents: their place in a sequence, checksum and (with_ids) their ids."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    encoded = encode(docs, path, end_id, queue, text)
    # At most partitions + sources rows: the queues are range-partitioned.
    counted = encoded.groupBy("queue", "part").agg(F.sum("n_tokens").alias("n")).collect()
    bases, totals, nulls = {}, {}, {}
    for row in sorted(counted, key=lambda r: (r["queue"] is not None, r["queue"] or "", r["part"])):
        # The null queue must not meet a source that is called the empty text.
        name = "\0" if row["queue"] is None else row["queue"]
        bases[row["queue"], row["part"]] = totals.get(name, 0)
        totals[name] = totals.get(name, 0) + row["n"]
        nulls[row["queue"]] = name
    names, phases = schedule(totals, weights, window, rest)
    total = sum(totals.values())
    tail_starts, tail = sequences(total, length)
    plan = docs.sparkSession.sparkContext.broadcast(
        (bases, {q: names.index(n) for q, n in nulls.items()}, phases, tail_starts, tail)
    )

    schema, stored = PIECES + ", ids binary" * with_ids, stored_type(path, end_id)

    def run(batches: Batches) -> Batches:
        bases, order, phases, tail_starts, tail = plan.value
        for batch in slices(batches, "ids"):
            queues, parts = batch.column("queue").to_pylist(), batch.column("part").to_pylist()
            counts, firsts = (batch.column(c).to_numpy() for c in ("n_tokens", "first"))
            first = 0
            for i in range(1, batch.num_rows + 1):
                # Rows that follow each other in their queue are placed at once.
                if (
                    i < batch.num_rows
                    and (queues[i], parts[i]) == (queues[first], parts[first])
                    and firsts[i] == firsts[i - 1] + counts[i - 1]
                ):
                    continue
                key = (queues[first], parts[first])
                begin = bases[key] + int(firsts[first])
                ends = begin + np.cumsum(counts[first:i])
                rows = batch.slice(first, i - first)
                yield cut(rows, begin, ends, *place(phases, order[key[0]], begin, int(ends[-1])))
                first = i

    def cut(rows, begin, ends, at, position, size):
        starts = np.concatenate([[begin], ends[:-1]])
        # Cut the runs at document borders ...
        marks = np.unique(np.concatenate([at, starts]))
        run_of = np.searchsorted(at, marks, "right") - 1
        stream = position[run_of] + marks - at[run_of]
        sizes = np.diff(np.append(marks, ends[-1]))
        # ... and at the borders of sequences.
        parts = sequence_of(stream + sizes - 1) - sequence_of(stream) + 1
        which = np.repeat(np.arange(len(marks)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        sequence = sequence_of(stream[which])
        start = np.where(nth == 0, stream[which], 0)
        later = nth > 0
        number = sequence + nth
        start[later] = origin_of(number[later])
        stop = np.append(start[1:], 0)
        final = np.append(which[1:] != which[:-1], True) if len(which) else np.zeros(0, bool)
        stop[final] = (stream + sizes)[which[final]]
        doc = np.searchsorted(starts, marks, "right")[which] - 1
        begin_in_doc = marks[which] + start - stream[which] - starts[doc]
        n = stop - start
        joined = b"".join(rows.column("ids").to_pylist())
        view = memoryview(np.frombuffer(joined, stored).astype("<u4").tobytes())
        first = marks[which] + start - stream[which] - begin
        ids = [view[4 * a : 4 * (a + k)] for a, k in zip(first.tolist(), n.tolist(), strict=True)]
        more = [pa.array(list(map(bytes, ids)), pa.binary())] if with_ids else []
        take = pa.array(doc, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").take(take),
                pa.array(begin_in_doc, pa.int64()),
                pa.array(n, pa.int64()),
                rows.column("n_tokens").take(take),
                pa.array(number, pa.int64()),
                pa.array(start - origin_of(number), pa.int64()),
                rows.column("queue").take(take),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                *more,
            ],
            names=[f.split()[0] for f in schema.split(", ")],
        )

    def sequence_of(stream):
        in_tail = stream >= tail
        number = stream // length
        if len(tail_starts):
            place_in_tail = np.searchsorted(tail_starts, stream, "right") - 1
            number = np.where(in_tail, tail // length + place_in_tail, number)
        return number

    def origin_of(number):
        origin = number * length
        if len(tail_starts):
            nth = np.clip(number - tail // length, 0, len(tail_starts) - 1)
            origin = np.where(number >= tail // length, tail_starts[nth], origin)
        return origin

    return encoded.mapInArrow(run, schema)
