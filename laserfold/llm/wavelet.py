"""Token ids on disk as one wavelet matrix per shard.

Documents are range-partitioned by doc_id; a partition is written as one or more shard
files in ascending doc_id order. A file holds, for each bit of the ids from the
highest down, a plane of bits, after which the ids are stably parted into those with a
0 and those with a 1. With counts of ones per block that gives access, rank
(occurrences before a place), select (place of the n-th occurrence) and so counting
and lookup of a token without decoding the rest. Planes are compressed in blocks, so a
query opens one block per plane.

File: magic, length of the header, JSON header (sizes, places of the sections), then
zstandard sections: document ids and lengths, counts of ones, plane blocks. Tasks write
under temporary names and rename; what a task returns is its manifest row, and only
files in the manifest count, so a repeated task does no harm.

Results: a null or empty text is its end id alone; null doc_ids come first; repeated
doc_ids stay rows of their own, in text order; a very long text is one document of one
file, which then is longer than the bound; an empty table gives no file and no row;
other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.llm import tokens
from laserfold.llm.common import (
    Batches,
    column,
    new_folder,
    qualified,
    read_back,
    shared_files,
    slices,
    text_of,
)

MAGIC = b"WVMATRX1"
END_ID = 2
SHARD_TOKENS = 4_000_000
BLOCK_BITS = 1 << 18
LEVEL = 3
NO_ID = np.iinfo(np.int64).min  # stands for a null doc_id in the document section

MANIFEST = (
    "part int, shard int, path string, docs bigint, n_tokens bigint, bytes bigint, first_doc bigint"
)
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def pack_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard file."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    planes = max(1, int(ids.max(initial=0)).bit_length())
    current = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    numbers = np.array([NO_ID if d is None else d for d in doc_ids], "<i8")
    sections = [squeeze(numbers.tobytes()), squeeze(lengths.astype("<i8").tobytes())]
    zeros, ones = [], []
    for level in range(planes - 1, -1, -1):
        bits = (current >> level & 1).astype(bool)
        packed = np.packbits(bits, bitorder="little")
        step = BLOCK_BITS // 8
        blocks = [packed[i : i + step] for i in range(0, len(packed), step)] or [packed]
        ones.append([int(np.bitwise_count(b).sum()) for b in blocks])
        sections.extend(squeeze(b.tobytes()) for b in blocks)
        zeros.append(len(bits) - sum(ones[-1]))
        # Taking by number is several times as fast as a boolean mask.
        current = np.concatenate([np.compress(~bits, current), np.compress(bits, current)])
    counts = squeeze(np.array(ones, "<i8").tobytes())
    sections.insert(2, counts)
    header = json.dumps(
        {
            "docs": len(doc_ids),
            "tokens": len(ids),
            "planes": planes,
            "zeros": zeros,
            "block_bits": BLOCK_BITS,
            "sections": [len(s) for s in sections],
        }
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class WaveletMatrix:
    """Reader of one shard file; `read(place, size)` gives bytes of the file."""

    def __init__(self, read):
        start = read(0, 12)
        if start[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = struct.unpack("<I", start[8:12])[0]
        head = json.loads(read(12, size))
        self._read = read
        self.tokens, self.planes, self.zeros = head["tokens"], head["planes"], head["zeros"]
        self.block_bits = head["block_bits"]
        places = np.cumsum([12 + size, *head["sections"]])
        self._sections = list(zip(places.tolist(), head["sections"], strict=False))
        self._open = zstandard.ZstdDecompressor().decompress
        self.doc_ids = [
            None if d == NO_ID else d for d in np.frombuffer(self._section(0), "<i8").tolist()
        ]
        self.lengths = np.frombuffer(self._section(1), "<i8")
        counts = np.frombuffer(self._section(2), "<i8").reshape(self.planes, -1)
        self._blocks = counts.shape[1]
        self._ones = np.hstack([np.zeros((self.planes, 1), np.int64), np.cumsum(counts, 1)])

    @classmethod
    def of_bytes(cls, data: bytes) -> WaveletMatrix:
        return cls(lambda place, size: data[place : place + size])

    def _section(self, i: int) -> bytes:
        place, size = self._sections[i]
        return self._open(self._read(place, size))

    def _block(self, plane: int, block: int) -> np.ndarray:
        data = self._section(3 + plane * self._blocks + block)
        return np.frombuffer(data, np.uint8)

    def _ones_before(self, plane: int, place: int) -> int:
        block, inside = divmod(place, self.block_bits)
        if inside == 0:
            return int(self._ones[plane, block])
        data = self._block(plane, block)
        whole, rest = divmod(inside, 8)
        n = int(np.bitwise_count(data[:whole]).sum())
        if rest:
            n += (int(data[whole]) & ((1 << rest) - 1)).bit_count()
        return int(self._ones[plane, block]) + n

    def _bit(self, plane: int, place: int) -> int:
        block, inside = divmod(place, self.block_bits)
        return int(self._block(plane, block)[inside // 8]) >> inside % 8 & 1

    def _levels(self) -> Iterator[tuple[int, int]]:
        return enumerate(range(self.planes - 1, -1, -1))

    def access(self, place: int) -> int:
        """The token at a place."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        found = 0
        for plane, level in self._levels():
            ones = self._ones_before(plane, place)
            if self._bit(plane, place):
                found |= 1 << level
                place = self.zeros[plane] + ones
            else:
                place -= ones
        return found

    def _span(self, token: int, first: int, last: int) -> tuple[int, int]:
        """Where the occurrences of the token in [first, last) lie after the last plane."""
        for plane, level in self._levels():
            a, b = self._ones_before(plane, first), self._ones_before(plane, last)
            if token >> level & 1:
                first, last = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of a token in [first, last)."""
        if token < 0 or token >> self.planes:
            return 0
        a, b = self._span(token, first, self.tokens if last is None else last)
        return b - a

    def _find(self, plane: int, bit: int, nth: int) -> int:
        """Place of the nth (from 0) such bit of a plane."""
        before = self._ones[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * self.block_bits, self.tokens) - before
        block = int(np.searchsorted(before, nth, "right")) - 1
        size = min(self.block_bits, self.tokens - block * self.block_bits)
        bits = np.unpackbits(self._block(plane, block), bitorder="little", count=size)
        return block * self.block_bits + int(np.flatnonzero(bits == bit)[nth - before[block]])

    def select(self, token: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of a token, or -1."""
        if token < 0 or token >> self.planes:
            return -1
        first, last = self._span(token, 0, self.tokens)
        if not 0 <= nth < last - first:
            return -1
        place = first + nth
        for plane, level in reversed(list(self._levels())):
            if token >> level & 1:
                place = self._find(plane, 1, place - self.zeros[plane])
            else:
                place = self._find(plane, 0, place)
        return place

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, n) for n in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        found = np.zeros(self.tokens, np.uint16 if self.planes <= 16 else np.uint32)
        for plane, level in reversed(list(self._levels())):
            packed = np.concatenate([self._block(plane, b) for b in range(self._blocks)])
            bits = np.unpackbits(packed, bitorder="little", count=self.tokens).astype(bool)
            earlier = np.empty_like(found)
            earlier[np.flatnonzero(~bits)] = found[: self.zeros[plane]]
            earlier[np.flatnonzero(bits)] = found[self.zeros[plane] :] | found.dtype.type(1 << level)
            found = earlier
        return found


def write_shards(
    docs: DataFrame,
    path: str,
    folder: str | None = None,
    *,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    text: str = "text",
) -> DataFrame:
    """Write all documents under `folder`; the manifest, one row per file, as a stored table."""
    folder = qualified(docs.sparkSession, folder or new_folder(docs, "wavelet"))
    rows = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"), text_of(docs, text).alias("text")
    )

    def run(batches: Batches) -> Batches:
        make = tokens.encoder(path)
        ending = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        files, root = shared_files(folder)
        doc_ids, buffers, held, shard = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, buffers, held, shard
            lengths = np.array([len(b) // 4 for b in buffers], np.int64)
            data = pack_file(doc_ids, lengths, np.frombuffer(b"".join(buffers), "<u4"))
            name = f"{root}/shard-{part:06d}-{shard:05d}.wvm"
            files.create_dir(root, recursive=True)
            waiting = f"{root}/.{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(waiting) as out:
                out.write(data)
            files.move(waiting, name)
            row = [part, shard, name, len(doc_ids), int(lengths.sum()), len(data), doc_ids[0]]
            doc_ids, buffers, held, shard = [], [], 0, shard + 1
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
            )

        for batch in slices(batches):
            for doc_id, body in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                ids = make.ids(body) + ending
                if buffers and held + len(ids) // 4 > shard_tokens:
                    yield flush()
                doc_ids.append(doc_id)
                buffers.append(ids)
                held += len(ids) // 4
        if buffers:
            yield flush()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return read_back(ordered.mapInArrow(run, MANIFEST), "wavelet-manifest")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files in the manifest, with the place of its first id.

    The manifest has a row per file and gives each file its place among all ids."""
    listed = manifest.orderBy("part", "shard").select("path", "n_tokens").collect()
    starts, total = [], 0
    for row in listed:
        starts.append((row["path"], total))
        total += row["n_tokens"]
    session = manifest.sparkSession
    folder = qualified(session, folder)
    jobs = session.createDataFrame(starts, "path string, before bigint")
    tasks = jobs.repartition(max(1, len(starts)), "path") if starts else jobs

    def run(batches: Batches) -> Batches:
        files, _ = shared_files(folder)
        for batch in batches:
            for path, before in zip(
                batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True
            ):
                with files.open_input_file(path) as source:
                    shard = WaveletMatrix(lambda at, size, s=source: s.read_at(size, at))
                    ids = shard.decode().astype("<u4").tobytes()
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                view = memoryview(ids)
                sums = [
                    zlib.crc32(view[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(starts + before, pa.int64()),
                        pa.array(shard.lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return tasks.mapInArrow(run, DOCS)
