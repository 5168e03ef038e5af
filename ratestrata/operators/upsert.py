"""Insert or overwrite by key, as a plan over immutable tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.operators.series import dedup_latest


def has_null(keys: Sequence[str]) -> Column:
    return reduce(lambda left, right: left | right, [F.col(key).isNull() for key in keys])


def one_per_key(rows: DataFrame, keys: Sequence[str], order_by: str, ties: Sequence[str] | None = None) -> DataFrame:
    """Last writer per key. A row with a NULL key equals no other row, so all of them stay:
    each gets a number of its own, which also spreads them over the tasks."""
    if ties is None:
        ties = [name for name in rows.columns if name not in (*keys, order_by)]
    alone = F.when(has_null(keys), F.monotonically_increasing_id())
    return dedup_latest(rows.withColumn("_alone", alone), [*keys, "_alone"], order_by, ties).drop("_alone")


def counted_per_key(rows: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """`one_per_key` with `_copies`, how many rows a key had. An aggregate: map tasks send one row per key."""
    rest = [name for name in rows.columns if name not in (*keys, order_by)]
    # NULL counts as newest; among the others NULL is smallest, as in the order of `dedup_latest`
    last = F.max(F.struct(F.col(order_by).isNull().alias("_undated"), order_by, *rest)).alias("_last")
    alone = F.when(has_null(keys), F.monotonically_increasing_id())
    grouped = rows.withColumn("_alone", alone).groupBy(*keys, "_alone").agg(last, F.count("*").alias("_copies"))
    names = [F.col(name) if name in keys else F.col(f"_last.{name}") for name in rows.columns]
    return grouped.select(*names, "_copies")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: str = "_extracted_at",
    newest_wins: bool = False,
) -> DataFrame:
    """`target` after writing `updates` over it: the table a caller should store.

    The last writer wins, or with `newest_wins` the row with the larger `order_by`. An
    empty batch returns the target unchanged.
    """
    if newest_wins:
        both = target.withColumn("_written", F.lit(0)).unionByName(updates.withColumn("_written", F.lit(1)))
        rest = [name for name in target.columns if name not in (*keys, order_by)]
        return one_per_key(both, keys, order_by, ["_written", *rest]).drop("_written")
    # Distinct keys only: all copies of a key that owns most of the batch would meet in one task.
    untouched = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(one_per_key(updates, keys, order_by))
