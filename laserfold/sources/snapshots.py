"""Snapshots that switch at once: a folder per build, and a pointer per scope.

A build writes all its tables under `<root>/<table>/build=<id>/`. Nothing of it is seen
until `switch` writes, for each scope (a site, or a site's run), one small pointer file
that names the build; it is written aside and renamed, so a reader finds the old build
or the new one, for all tables of that scope. A build that fails leaves every pointer as
it was. Builds of different scopes do not touch each other's pointers.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BUILD = "build"
POINTERS = "_current"


def new_build() -> str:
    return uuid.uuid4().hex


def build_path(root: str, table: str, build: str) -> str:
    return f"{root}/{table}/{BUILD}={build}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> dict[tuple, str]:
    """Build of every scope that was published: one small file per scope."""
    folder = f"{root}/{POINTERS}"
    if not _files(spark, folder).exists(_path(spark, folder)):
        return {}
    lines = spark.read.text(f"{folder}/*.json").toLocalIterator()
    found = (json.loads(line.value) for line in lines)
    return {tuple(f["scope"]): f[BUILD] for f in found}


def switch(spark: SparkSession, root: str, scopes: Iterable[Sequence], build: str) -> None:
    """Let every scope show `build` from now on."""
    jvm = spark.sparkContext._jvm
    fs = _files(spark, root)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    replacing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replacing[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    for scope in scopes:
        text = json.dumps({"scope": list(scope), BUILD: build})
        name = hashlib.sha1(json.dumps(list(scope)).encode()).hexdigest()
        aside = _path(spark, f"{root}/{POINTERS}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        context.rename(fs.makeQualified(aside), fs.makeQualified(_path(spark, f"{root}/{POINTERS}/{name}.json")), replacing)


def open_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    scope: Sequence[str],
    pointers: Mapping[tuple, str] | None = None,
) -> DataFrame:
    """What the pointers show of a table. Only builds that a pointer names are read."""
    shown = current(spark, root) if pointers is None else pointers
    folders = [build_path(root, table, b) for b in sorted(set(shown.values()))]
    fs = _files(spark, root)
    folders = [f for f in folders if fs.exists(_path(spark, f))]
    if not folders:
        return spark.createDataFrame([], schema)
    wide = StructType([*schema.fields, StructField(BUILD, StringType())])
    rows = spark.read.schema(wide).option("basePath", f"{root}/{table}").parquet(*folders)
    # One row per scope.
    kinds = [StructField(f"{c}_shown", schema[c].dataType) for c in scope]
    named = StructType([*kinds, StructField(f"{BUILD}_shown", StringType())])
    live = spark.createDataFrame([(*s, b) for s, b in shown.items()], named)
    same = [rows[c].eqNullSafe(live[f"{c}_shown"]) for c in (*scope, BUILD)]
    return rows.join(F.broadcast(live), same, "left_semi").select(*schema.fieldNames())


def drop_builds(
    spark: SparkSession, root: str, tables: Iterable[str], keep: Iterable[str]
) -> None:
    """Delete builds that no pointer names and that are not in `keep` (failed or old ones)."""
    needed = set(current(spark, root).values()) | set(keep)
    fs = _files(spark, root)
    for table in tables:
        for found in fs.globStatus(_path(spark, f"{root}/{table}/{BUILD}=*")) or ():
            if found.getPath().getName().removeprefix(f"{BUILD}=") not in needed:
                fs.delete(found.getPath(), True)
