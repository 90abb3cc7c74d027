"""Alignment of two tokenizers by inverted pair bitmaps.

A text's tokens under A and under B are cut into groups where both end at the same byte;
every A token of a group is linked to every B token of it. The index is inverted: for
each pair of ids a compressed bitmap of the documents that hold it linked, and planes of
the bits of (links - 1) per document. Popcounts give a pair's documents, planes its
links; its postings carry scores back to the documents.

1. One pass over the texts. Documents are numbered inside blocks of bounded size, so a
   pair's bitmap in one block is small however common the pair is. The bitmaps of all
   documents of a block are merged there; those of different blocks hold different
   documents, so their union counts the sum of their popcounts. A bitmap is an array of
   16-bit places, or a bitset where that is no longer.
2. Counts per pair are partial sums; the best count per A id is a table no longer than
   A's vocabulary (broadcast).
3. Postings meet their pair's count, are dealt to their block, and sum up per document.

Texts are cut where A's pattern starts a pre-token and no piece of B reaches across:
before a space that follows other than white space (`cuts_hold`), and in Latin texts also
behind letters and around a lone line feed (`fine_cuts_hold`). Both are proved from the
files, else texts stay whole or coarse. A cut piece is tokenized alike everywhere, so
distinct pieces of a slice of documents go through the libraries once, as one batch.

Results: one row per row of `docs`; a null or empty text, and one whose joined tokens of
A or B are not exactly the bytes of space and text, has no tokens, no groups and an empty
group string. Special strings in texts are plain text. Very long texts are handled whole
(a block ends behind them); repeated rows count as documents of their own; links of a
pair with the best count of its A id are all best, ties included. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.llm.common import Batches, column, read_back, slices, texts
from laserfold.llm.tokens import LAST_LATIN, SPACES, byte_letters, latin

# A block ends at so many links or documents (places have 16 bits).
BLOCK_LINKS, BLOCK_DOCS = 3_000_000, 1 << 16
# Pieces kept for reuse, in a worker; beyond, its table starts anew (only speed changes).
KEPT_PIECES, KEPT_BYTES = 400_000, 64_000_000
# A group with more links is kept as counts of its pairs.
WIDE_GROUP = 4_096
OUT_ROWS = 20_000
BETWEEN = re.compile(f"(?<=[^{SPACES}])(?= )")
LETTERS = latin("L")
# Words, other marks up to white space, one white space alone, longer white space.
PIECES = re.compile(
    f" ?[{LETTERS}]+| ?[^{SPACES}{LETTERS}][^{SPACES}]*|[^\\S ](?=[^{SPACES}])|[{SPACES}]+[^{SPACES}]*"
)


class Aligner:
    """Both tokenizers of a worker, and what is known of pieces of texts.

    A known piece has a number; its counts, its group string and its packed links are kept
    under that number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: bytes([b]) for b, c in byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = {
            n: b"".join(back.get(c) or c.encode() for c in entry) for entry, n in vocabulary.items()
        }
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.width = len(pieces)
        self.sizes_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.sizes_a[list(self.bytes_a)] = list(map(len, self.bytes_a.values()))
        self.sizes_b = np.fromiter(map(len, self.bytes_b), np.int64)
        self.decimals = [b"%d" % i for i in range(max(len(self.sizes_a), self.width))]
        with open(path_a, encoding="utf-8") as file:
            described = json.load(file)
        # Bytes stand for themselves; control pieces never come from a text.
        apart = self.b.is_byte, self.b.is_control, self.b.is_unknown
        whole = [p for i, p in enumerate(pieces) if not any(kind(i) for kind in apart)]
        self.coarse = cuts_hold(described, whole)
        self.fine = self.coarse and fine_cuts_hold(whole)
        # A line feed is a byte of its own in B, so what follows it stands as after a cut.
        self.lead = self.b.encode("\n")
        self.fine = self.fine and self.b.encode("\nx")[: len(self.lead)] == self.lead
        self.odd = re.compile(f"[^\\x00-{LAST_LATIN}]|[{''.join(map(re.escape, _in_pieces(whole)))}]")
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros((1024, 4), np.int64)
        self.groups: list[bytes] = []
        self.links: list[bytes] = []
        self.wide: dict[int, Counter] = {}
        self.kept_bytes = 0

    def align(self, text: str, ids_a: list[int], ids_b: list[int]) -> tuple | None:
        """(counts, groups, links, wide) of a stretch of text, or None if bytes differ."""
        parts_a = [self.bytes_a[i] for i in ids_a]
        parts_b = [self.bytes_b[i] for i in ids_b]
        raw = text.encode()
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        width = self.width
        groups, links, wide, n_links = [], array("q"), Counter(), 0
        i = j = end_a = end_b = 0
        while i < len(ids_a):
            first_a, first_b = i, j
            end_a += len(parts_a[i])
            end_b += len(parts_b[j])
            i += 1
            j += 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a += len(parts_a[i])
                    i += 1
                else:
                    end_b += len(parts_b[j])
                    j += 1
            own_a, own_b = ids_a[first_a:i], ids_b[first_b:j]
            groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
            size = len(own_a) * len(own_b)
            n_links += size
            if size <= WIDE_GROUP:
                links.extend([x * width + y for x in own_a for y in own_b])
            else:
                counts_b = Counter(own_b)
                for x, times in Counter(own_a).items():
                    for y, more in counts_b.items():
                        wide[x * width + y] += times * more
        counts = (len(ids_a), len(ids_b), len(groups), n_links)
        return counts, ";".join(groups).encode(), links.tobytes(), wide or None

    def _ids(self, found: list[str]) -> tuple[list, list]:
        in_a = self.a.encode_batch_fast(found, add_special_tokens=False)
        in_b = self.b.encode([t[1:] if t[0] == " " else f"\n{t}" for t in found], num_threads=1)
        skip = len(self.lead)
        in_b = [b if t[0] == " " else b[skip:] for t, b in zip(found, in_b, strict=True)]
        return [e.ids for e in in_a], in_b

    def _align_all(self, found: list[str]) -> Iterator[tuple[str, tuple | None]]:
        """(piece, what `align` gives for it) of many pieces, all in one pass over arrays."""
        if not found:
            return
        in_a, in_b = self._ids(found)
        good = []
        for piece, a, b in zip(found, in_a, in_b, strict=True):
            raw = piece.encode()
            same_a = b"".join(map(self.bytes_a.__getitem__, a)) == raw
            same_b = b"".join(map(self.bytes_b.__getitem__, b)) == raw
            if same_a and same_b and len(a) * len(b) <= WIDE_GROUP:
                good.append((piece, a, b))
            else:
                yield piece, self.align(piece, a, b) if same_a and same_b else None
        if not good:
            return
        names, in_a, in_b = zip(*good, strict=True)
        a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (in_a, in_b))
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # Each A token with all B tokens of its group.
        times = n_b[of_a]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - before_b[of_a], times)
        links = (np.repeat(a, times) * self.width + b[at]).astype("<i8").tobytes()
        # A group's decimal ids in order: those of A, then those of B, each with its separator.
        order = np.zeros(len(a) + len(b), np.int64)
        ends = np.zeros(len(order), np.int64)
        at_a, at_b = np.arange(len(a)) + before_b[of_a], np.arange(len(b)) + (before_a + n_a)[of_b]
        order[at_a], order[at_b] = a, b
        ends[at_a[before_a + n_a - 1]], ends[at_b[before_b + n_b - 1]] = 1, 2
        written: list[bytes] = [b""] * (2 * len(order))
        written[0::2] = map(self.decimals.__getitem__, order.tolist())
        written[1::2] = map((b",", b"|", b";").__getitem__, ends.tolist())
        # Where each piece's tokens, groups and links end.
        last_a, last_b = (np.cumsum(np.fromiter(map(len, x), np.int64)) for x in (in_a, in_b))
        last_group = of_a[last_a - 1] + 1
        last_link = np.cumsum(times)[last_a - 1]
        ends_of = np.stack([last_a, last_b, last_group, last_link], 1)
        counts = np.diff(ends_of, axis=0, prepend=0)
        token = link = 0
        for piece, own, (t_a, t_b, _, n) in zip(names, counts.tolist(), ends_of.tolist(), strict=True):
            end = 2 * (t_a + t_b)
            yield piece, (own, b"".join(written[token : end - 1]), links[8 * link : 8 * n], None)
            token, link = end, n

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text with its leading space, each tokenized alone as within it."""
        if not self.coarse:
            return [text]
        if not self.fine or self.odd.search(text):
            return BETWEEN.split(text)
        return PIECES.findall(text)

    def _learn(self, pieces: set[str]) -> None:
        for piece, made in self._align_all(list(pieces)):
            if made is None:
                self.number[piece] = -1
                continue
            n = self.number[piece] = len(self.groups)
            if n == len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.counts[n] = made[0]
            self.groups.append(made[1])
            self.links.append(made[2])
            self.kept_bytes += len(made[1]) + len(made[2])
            if made[3]:
                self.wide[n] = made[3]

    def documents(self, batch: list[str]) -> Iterator[tuple]:
        """(counts, group string, packed links, wide links) of each text; zeros without tokens."""
        cut = [self._cut(f" {t}") if t else [] for t in batch]
        if len(self.groups) > KEPT_PIECES or self.kept_bytes > KEPT_BYTES:
            self._forget()
        missing = set().union(*cut) - self.number.keys()
        if missing:
            self._learn(missing)
        for text, pieces in zip(batch, cut, strict=True):
            numbers = list(map(self.number.__getitem__, pieces))
            if -1 in numbers:  # whole, where a piece alone has other bytes
                (in_a,), (in_b,) = self._ids([f" {text}"])
                yield self.align(f" {text}", in_a, in_b) or NOTHING
                continue
            wide: Counter = Counter()
            for n in self.wide.keys() & set(numbers) if self.wide else ():
                for code, times in self.wide[n].items():
                    wide[code] += times * numbers.count(n)
            yield (
                tuple(self.counts[numbers].sum(0).tolist()),
                b";".join(map(self.groups.__getitem__, numbers)),
                b"".join(map(self.links.__getitem__, numbers)),
                wide or None,
            )


NOTHING = ((0, 0, 0, 0), b"", b"", None)


def cuts_hold(described: dict, pieces: list[str]) -> bool:
    """Whether texts may be cut before a space that follows other than white space."""
    before = described.get("pre_tokenizer") or {}
    plain = described.get("normalizer") is None and before.get("type") == "ByteLevel"
    return bool(plain and before.get("use_regex")) and not any(re.search("[^▁]▁", p) for p in pieces)


def fine_cuts_hold(pieces: list[str]) -> bool:
    """Whether no piece of B goes on after a letter with anything but letters, or holds a line feed."""
    return not any("\n" in p or re.search(f"[{LETTERS}][^{LETTERS}]", p) for p in pieces)


def _in_pieces(pieces: list[str]) -> set[str]:
    """White space other than spaces that stands inside longer pieces (and a stand-in)."""
    return {"\r"} | {c for p in pieces if len(p) > 1 for c in p if c.isspace()}


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# ---- bitmaps -------------------------------------------------------------------------


def container(places: np.ndarray, size: int) -> bytes:
    """Compressed bitmap of ascending places below `size`."""
    n_bytes = (size + 7) // 8
    if 2 * len(places) < n_bytes:
        return places.astype("<u2").tobytes()
    bits = np.zeros(size, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def places_of(bitmaps: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which bitmap, place) of all set bits, bitmap by bitmap in ascending places."""
    n_bytes = (size + 7) // 8
    lengths = np.fromiter(map(len, bitmaps), np.int64, len(bitmaps))
    dense = np.flatnonzero(lengths == n_bytes)
    sparse = np.flatnonzero(lengths != n_bytes)
    places = np.frombuffer(b"".join([bitmaps[i] for i in sparse]), "<u2").astype(np.int64)
    which = np.repeat(sparse, lengths[sparse] // 2)
    found = [(which, places)]
    for i in dense:
        bits = np.unpackbits(np.frombuffer(bitmaps[i], np.uint8), bitorder="little", count=size)
        set_bits = np.flatnonzero(bits)
        found.append((np.full(len(set_bits), i), set_bits))
    which, places = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(which, kind="stable")
    return which[order], places[order]


def invert(codes: np.ndarray, places: np.ndarray, times: np.ndarray, size: int) -> dict[str, list]:
    """Bitmaps and planes of postings (code, place, times) sorted by code, then place."""
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(codes)]
    n_bytes = (size + 7) // 8
    packed = places.astype("<u2").tobytes()
    bitmaps = [
        packed[2 * s : 2 * e] if 2 * (e - s) < n_bytes else container(places[s:e], size)
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True)
    ]
    planes: list[list[bytes]] = [[] for _ in bitmaps]
    more = times - 1
    row = np.repeat(np.arange(len(starts)), ends - starts)
    for k in range(int(more.max(initial=0)).bit_length()):
        at = np.flatnonzero(more >> k & 1)
        if not len(at):
            continue
        rows, first = np.unique(row[at], return_index=True)
        for r, chosen in zip(rows.tolist(), np.split(at, first[1:]), strict=True):
            planes[r] += [b""] * (k - len(planes[r])) + [container(places[chosen], size)]
    return {
        "code": codes[starts].tolist(),
        "n_docs": (ends - starts).tolist(),
        "n_links": np.add.reduceat(times, starts).tolist() if len(starts) else [],
        "docs": bitmaps,
        "planes": planes,
    }


# ---- the index -----------------------------------------------------------------------

# Rows of documents have a place in their block, rows of pairs have ids and bitmaps.
DOC_FIELDS = {
    "place": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
}
PAIR_FIELDS = {
    "a": pa.int32(), "b": pa.int32(), "n_docs": pa.int64(), "pair_links": pa.int64(),
    "docs": pa.binary(), "planes": pa.list_(pa.binary()),
}
FIELDS = {"block": pa.int64(), "size": pa.int32()} | DOC_FIELDS | PAIR_FIELDS
INDEX_SCHEMA = (
    "block bigint, size int, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "n_links bigint, groups_sha256 string, a int, b int, n_docs bigint, pair_links bigint, "
    "docs binary, planes array<binary>"
)


class _Block:
    """Documents and links of one block while it fills."""

    def __init__(self, number: int, width: int):
        self.number, self.width, self.n_links = number, width, 0
        self.docs: dict[str, list] = {name: [] for name in DOC_FIELDS}
        self.links: list[bytes] = []
        self.lengths: list[int] = []
        self.wide: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, found: tuple) -> None:
        place = len(self.lengths)
        counts, groups, links, wide = found
        digest = hashlib.sha256(groups).hexdigest() if groups else ""
        for name, value in zip(DOC_FIELDS, (place, doc_id, *counts, digest), strict=True):
            self.docs[name].append(value)
        self.links.append(links)
        self.lengths.append(len(links) // 8)
        self.n_links += len(links) // 8
        self.wide += [(code, place, times) for code, times in (wide or {}).items()]

    def full(self) -> bool:
        return self.n_links >= BLOCK_LINKS or len(self.lengths) >= BLOCK_DOCS

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.frombuffer(b"".join(self.links), np.int64) << 16
        self.links.clear()
        keys |= np.repeat(np.arange(len(self.lengths)), self.lengths)
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        times = np.diff(np.r_[starts, len(keys)])
        keys = keys[starts]
        if self.wide:
            code, place, more = np.array(self.wide, np.int64).T
            keys, where = np.unique(np.r_[keys, code << 16 | place], return_inverse=True)
            summed = np.zeros(len(keys), np.int64)
            np.add.at(summed, where, np.r_[times, more])
            times = summed
        return keys >> 16, keys & 0xFFFF, times

    def rows(self) -> Batches:
        size = len(self.lengths)
        yield self._batch(self.docs, size)
        made = invert(*self.postings(), size)
        code = np.array(made.pop("code"), np.int64)
        pairs = {"a": code // self.width, "b": code % self.width, "pair_links": made.pop("n_links")} | made
        for top in range(0, len(code), OUT_ROWS):
            yield self._batch({n: v[top : top + OUT_ROWS] for n, v in pairs.items()}, size)

    def _batch(self, values: dict, size: int) -> pa.RecordBatch:
        n = len(next(iter(values.values())))
        filled = {"block": [self.number] * n, "size": [size] * n} | values
        return pa.RecordBatch.from_arrays(
            [pa.array(filled[f], t) if f in filled else pa.nulls(n, t) for f, t in FIELDS.items()],
            names=list(FIELDS),
        )


def index(docs: DataFrame, path_a: str, path_b: str, *, text: str = "text") -> DataFrame:
    """The inverted index of `docs`, written once: rows of documents and of pairs."""

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        both = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number, both.width)
        for batch in slices(batches):
            found = both.documents(texts(batch))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                block.add(doc_id, own)
                if block.full():
                    yield from block.rows()
                    number += 1
                    block = _Block(number, both.width)
        if block.lengths:
            yield from block.rows()

    rows = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), column(docs, text, "string").alias("text")
    )
    return read_back(rows.mapInArrow(run, INDEX_SCHEMA), "pair-index")


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b, count (documents), links, best (whether the count is the highest of its a)."""
    pairs = (
        found.where("a is not null")
        .groupBy("a", "b")
        .agg(F.sum("n_docs").alias("count"), F.sum("pair_links").alias("links"))
    )
    pairs = read_back(pairs, "pairs")
    # At most one row per id of A's vocabulary.
    highest = pairs.groupBy("a").agg(F.max("count").alias("highest"))
    return pairs.join(F.broadcast(highest), "a").select(
        "a", "b", "count", "links", (F.col("count") == F.col("highest")).alias("best")
    )


RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _score(table: pa.Table) -> pa.Table:
    """Results of a block's documents, from the counts on its postings."""
    is_pair = table.column("docs").is_valid()
    docs, pairs = table.filter(pc.invert(is_pair)), table.filter(is_pair)
    size = table.column("size")[0].as_py()
    sums = np.zeros((2, size), np.int64)
    if pairs.num_rows:
        counts = pairs.column("count").to_numpy()
        best = pairs.column("best").to_numpy(zero_copy_only=False)

        def add(bitmaps: list[bytes], rows: np.ndarray, times: int) -> None:
            which, places = places_of(bitmaps, size)
            np.add.at(sums[0], places, times * counts[rows[which]])
            np.add.at(sums[1], places, times * best[rows[which]])

        add(pairs.column("docs").to_pylist(), np.arange(pairs.num_rows), 1)
        planes = pairs.column("planes").to_pylist()
        for k in range(max(map(len, planes))):
            rows = [i for i, own in enumerate(planes) if len(own) > k and own[k]]
            add([planes[i][k] for i in rows], np.array(rows, np.int64), 1 << k)
    place = docs.column("place").to_numpy()
    own = {"n_best": pa.array(sums[1][place]), "count_sum": pa.array(sums[0][place])}
    names = [f.split()[0] for f in RESULT.split(", ")]
    return pa.table({n: own[n] if n in own else docs.column(n) for n in names})


def score(found: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of the index, with counts carried back by the postings."""
    postings = found.where("a is not null").select("block", "size", "a", "b", "docs", "planes")
    pairs = postings.join(counts.select("a", "b", "count", "best"), ["a", "b"]).drop("a", "b")
    rows = found.where("place is not null").select("block", "size", *DOC_FIELDS)
    return (
        rows.unionByName(pairs, allowMissingColumns=True)
        .groupBy("block")
        .applyInArrow(_score, RESULT)
    )


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Index, counts and scores in one call."""
    found = index(docs, path_a, path_b)
    return score(found, pair_counts(found))
