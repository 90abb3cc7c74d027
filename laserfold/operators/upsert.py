"""Keyed merge operations on tables without row-level updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], replace_when: Column
) -> DataFrame:
    """Insert rows with a new key; overwrite an existing row only if it qualifies.

    `replace_when` is a condition on the columns of the existing row. `updates` must
    hold one row per key and the same columns as `target`; the result is the new
    content of the table."""
    keys = list(keys)
    if set(target.columns) != set(updates.columns):
        raise ValueError("target and updates must have the same columns")
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values, replace_when.alias("_open")).alias("old"))
    new = updates.select(*keys, F.struct(*values).alias("new"))
    both = old.join(new, keys, "full_outer")
    take_new = F.col("new").isNotNull() & (
        F.col("old").isNull() | F.coalesce(F.col("old._open"), F.lit(False))
    )
    picked = [
        F.when(take_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values
    ]
    return both.select(*keys, *picked)


def conditional_delete(target: DataFrame, removals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows left after deleting those that match `removals` on every column of `on`.

    Repeated removals are folded first, so one key repeated often stays one row."""
    return target.join(removals.select(*on).distinct(), list(on), "left_anti")


def claims(locks: DataFrame, requests: DataFrame, now: Column) -> DataFrame:
    """Site claims: a request wins a free or expired site, else the holder stays."""
    return conditional_upsert(locks, requests, ["siteId"], F.col("expiresAt") < now)
