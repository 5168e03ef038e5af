"""Window functions over series longer than a task: segments by a range of the order, with a halo of rows before each.

A window puts a whole series into one task. Here a series is cut into segments, such as months or hours, and
each becomes a window of its own. What a row needs from before its segment, the last row for a lag or six rows for a mean of seven,
is put in front of it: the halo. It comes from the last rows of the earlier segments alone, a few for each segment.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

HALO = "_halo"


def tails(rows: DataFrame, keys: Sequence[str], segment: str, order: Sequence[str], n: int = 1) -> DataFrame:
    """The last `n` rows of each series and segment. Map tasks send no more than `n` rows of each into the shuffle."""
    back = Window.partitionBy(*keys, segment).orderBy(*[F.desc_nulls_last(name) for name in order])
    return rows.withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= n).drop("_back")


def halo(ends: DataFrame, keys: Sequence[str], segment: str, order: Sequence[str], n: int = 1) -> DataFrame:
    """For each series and segment of `ends`, which holds the last `n` rows of every segment, the `n` rows before it.

    They carry the segment that they precede, and reach back over as many segments as it takes.
    """
    series = Window.partitionBy(*keys).orderBy(*order)
    rest = [name for name in ends.columns if name not in (*keys, segment)]
    before = F.collect_list(F.struct(*rest)).over(series.rowsBetween(-n, -1))
    first = F.row_number().over(Window.partitionBy(*keys, segment).orderBy(*order))
    opened = ends.select("*", before.alias("_before"), first.alias("_first")).filter(F.col("_first") == 1)
    return opened.select(*keys, segment, F.inline("_before")).select(*ends.columns)


def over_segments(
    rows: DataFrame,
    before: DataFrame,
    keys: Sequence[str],
    segment: str,
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """`rows` with `columns` of the window of their series and segment, in front of which stand the rows of `before`."""
    both = rows.withColumn(HALO, F.lit(False)).unionByName(before.withColumn(HALO, F.lit(True)), allowMissingColumns=True)
    window = Window.partitionBy(*keys, segment).orderBy(*order)
    return both.withColumns(columns(window)).filter(~F.col(HALO)).drop(HALO)


def segmented(
    rows: DataFrame,
    keys: Sequence[str],
    segment: str,
    order: Sequence[str],
    n: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """`rows` with columns that need at most the `n` rows before each, whatever the length of a series.

    `order` must be total within a series, and `segment`, a column, must not fall when `order` rises. The largest
    window is the largest segment, or the `n` last rows of all segments of one series.
    """
    names = [*keys, segment, *order]
    needed = [name for name in rows.columns if name not in names]
    ends = tails(rows.select(*names, *needed), keys, segment, order, n)
    return over_segments(rows, halo(ends, keys, segment, order, n), keys, segment, order, columns)
