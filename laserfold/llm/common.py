"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from laserfold import runtime

Batches = Iterator[pa.RecordBatch]
# Texts of one Arrow batch are handled in slices of about this many bytes.
SLICE_BYTES = 4_000_000


def column(df: DataFrame, name: str, kind: str) -> Column:
    """The column `name` cast to `kind`, or nulls of that kind where the table lacks it."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def narrow(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, with fixed types; other columns cannot get in the way."""
    return df.select(*(column(df, name, kind).alias(name) for name, kind in kinds.items()))


def text_of(df: DataFrame, name: str = "text") -> Column:
    """A text column in which a null counts as the empty text."""
    return F.coalesce(column(df, name, "string"), F.lit(""))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` without columns called like an operator's own results."""
    return df.drop(*(n for n in df.columns if n.lower() in {x.lower() for x in names}))


def unused(df: DataFrame, name: str) -> str:
    """`name`, made longer until `df` has no column that is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_back(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read again, so later jobs reuse its rows."""
    return runtime.store(df, name).df


def new_folder(df: DataFrame, name: str) -> str:
    return qualified(
        df.sparkSession,
        f"{runtime.shared_root(df.sparkSession)}/laserfold-llm/{name}-{uuid.uuid4().hex}",
    )


def qualified(spark: SparkSession, folder: str) -> str:
    """`folder` with its file system's scheme, so that tasks and Spark mean the same place.

    Spark takes a path without a scheme from the default file system of the cluster."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def slices(batches: Batches, name: str = "text") -> Batches:
    """Cut batches so that one slice holds few long texts; every row stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
        first = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > SLICE_BYTES:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if first < batch.num_rows:
            yield batch.slice(first)


def add_columns(
    df: DataFrame,
    fields: StructType,
    compute: Callable[[list[str]], dict[str, list]],
    *,
    keep: str | None = None,
    text: str = "text",
) -> DataFrame:
    """One Arrow pass that adds `fields` computed from the text to every row.

    With `keep`, rows where that computed boolean is false are left out and no column
    is added. No shuffle, no join; all columns of `df` pass through untouched."""
    schema = df.schema if keep else StructType([*df.schema.fields, *fields.fields])
    types = {f.name: pa_type(f.dataType.simpleString()) for f in fields}

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, text):
            found = compute(texts(batch, text))
            if keep:
                yield batch.filter(pa.array(found[keep], pa.bool_()))
                continue
            arrays = [pa.array(found[n], t) for n, t in types.items()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *types]
            )

    return df.mapInArrow(run, schema)


def pa_type(name: str) -> pa.DataType:
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[name]


def shared_files(root: str):
    """(file system, path) of a folder that tasks write ordinary files to."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root if "://" in root else f"file://{root[5:]}")
    return fs.LocalFileSystem(), root
