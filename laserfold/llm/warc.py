"""Deterministic sharded WARC writer and reader.

Pages are range-sorted by page_id; a partition writes files that are rolled by their
compressed size. Every record is its own gzip member with headers made anew: record id,
length, block and payload digest follow from the page alone, and the date is a
parameter, so equal input gives equal files. Among pages of equal payload the one with
the largest page_id is the response; the others are revisit records that refer to it.

Which payloads repeat is found natively: digests are aggregated on the map side, and
only repeated ones, counted, are joined back (broadcast when few, else a join whose hot
digest Spark splits). Tasks write under temporary names and rename; the rows they
return are the manifest, stored in the shared folder, and only its files are read.

Results: a null html is the empty payload and a null url the empty target. Payloads
below `least` bytes are all responses. Null page_ids sort first; a payload whose copies
all lack a page_id is all responses, and so are rows that repeat the response's
page_id. Extra columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.llm.common import Batches, column, qualified, read_back, shared_files, slices

LEAST = 1000
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "part int, file int, path string, records bigint, bytes bigint, sha1 string"
READ = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, payload binary"
)


def _record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}|{url}|{digest}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _head(first: str, fields: list[tuple[str, str]]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8")


def record(
    page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One uncompressed WARC record of a page."""
    url = " ".join(url.split())  # a header is one line
    digest = _sha1(payload)
    http = _head(
        "HTTP/1.1 200 OK",
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
    )
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, url, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", _sha1(block)),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def squeeze(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time or name, so equal data gives equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _mark_repeats(pages: DataFrame, least: int) -> DataFrame:
    """Pages with `refers_to`, the page_id of the response for repeated payloads."""
    payload = F.coalesce(column(pages, "html", "string"), F.lit("")).cast("binary")
    rows = pages.select(
        column(pages, "page_id", "bigint").alias("page_id"),
        F.coalesce(column(pages, "url", "string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    long = F.octet_length("payload") >= least
    keyed = rows.where(long).select("page_id", F.sha1("payload").alias("digest"))
    counted = keyed.groupBy("digest").agg(
        F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    repeated = runtime.store(
        counted.where("n > 1 and first_id is not null").select("digest", "first_id"), "repeats"
    )
    firsts = F.broadcast(repeated.df) if repeated.broadcastable else repeated.df
    digest = F.when(long, F.sha1("payload"))
    return rows.withColumn("digest", digest).join(firsts, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )


def write(
    pages: DataFrame,
    folder: str,
    *,
    least: int = LEAST,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write the archive files; the stored manifest has a row per file."""
    folder = qualified(pages.sparkSession, folder)
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Batches) -> Batches:
        files, root = shared_files(folder)
        part = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = number = 0

        def roll() -> pa.RecordBatch:
            nonlocal held, size, number
            data = b"".join(held)
            name = f"{root}/pages-{part:06d}-{number:05d}.warc.gz"
            files.create_dir(root, recursive=True)
            waiting = f"{root}/.{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(waiting) as out:
                out.write(data)
            files.move(waiting, name)
            row = [part, number, name, len(held), size, hashlib.sha1(data).hexdigest()]
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
            )

        for batch in slices(batches, "payload"):
            fields = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*fields, strict=True):
                made = record(page_id, url, payload, refers_to, refers_to is not None, date)
                member = squeeze(made)
                if held and size + len(member) > file_bytes:
                    yield roll()
                held.append(member)
                size += len(member)
        if held:
            yield roll()

    ordered = (
        _mark_repeats(pages, least)
        .repartitionByRange("page_id")
        .sortWithinPartitions("page_id", "url", F.xxhash64("payload"))
    )
    return read_back(ordered.mapInArrow(run, MANIFEST), "warc-manifest")


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive file, unpacked."""
    while data:
        packer = zlib.decompressobj(31)
        yield packer.decompress(data) + packer.flush()
        data = packer.unused_data


def parse(data: bytes) -> dict:
    """Headers and payload of a record; raises where a length or digest does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a record: {first[:40]}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record has another length than its header says")
    if _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError("a block does not have its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    of_http = dict(x.split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
    fields["payload"], fields["payload_bytes"] = payload, int(of_http["Content-Length"])
    if fields["WARC-Type"] == "response":
        if len(payload) != fields["payload_bytes"] or _sha1(payload) != fields["WARC-Payload-Digest"]:
            raise ValueError("a payload does not have its digest")
    return fields


def read(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the files in the manifest, checked against its digests."""
    folder = qualified(manifest.sparkSession, folder)
    # A fixed number of tasks; without it adaptive execution would join them to one.
    tasks = manifest.select("path", "sha1").repartition(max(1, manifest.count()), "path")
    kept = READ if with_payload else READ.removesuffix(", payload binary")

    def run(batches: Batches) -> Batches:
        files, _ = shared_files(folder)
        for batch in batches:
            for path, sha1 in zip(
                batch.column("path").to_pylist(), batch.column("sha1").to_pylist(), strict=True
            ):
                with files.open_input_file(path) as source:
                    data = source.read()
                if hashlib.sha1(data).hexdigest() != sha1:
                    raise ValueError(f"{path} is not what the manifest says")
                yield from rows_of(data)

    def rows_of(data: bytes) -> Batches:
        rows: list[tuple] = []
        size = 0
        for member in members(data):
            f = parse(member)
            page, refers = f.get("X-Page-ID"), f.get("X-Refers-To-Page-ID")
            digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            row = (
                None if page is None else int(page), f["payload_bytes"], digest, f["WARC-Type"],
                None if refers is None else int(refers), f["WARC-Target-URI"],
            )
            rows.append((*row, f["payload"]) if with_payload else row)
            size += len(f["payload"])
            if size > 4_000_000 or len(rows) >= 10_000:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [f.split()[0] for f in kept.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names
        )

    return tasks.mapInArrow(run, kept)
