"""Joining codes to rows whose list text contains them.

`list LIKE '%code%'` as a join condition compares every code with every row. Here each
list is cut into the pieces a code could equal, and codes meet pieces in an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

CODE = "_listed_code"


def listed_codes(
    dim: DataFrame,
    list_col: str,
    codes: DataFrame | None = None,
    code_col: str | None = None,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
) -> DataFrame:
    """`dim` with one row per distinct code its list contains, in the column `_listed_code`.

    `token` takes the `", "`-separated members. `substring` also finds a code inside a
    longer one: it cuts all pieces as long as some code, the lengths being read from
    `codes` by a subquery of the same job, unless the caller knows them (3 for ISO 4217).
    A piece counts where it first occurs, so a row never meets a code twice.
    """
    text = F.col(list_col)
    if match == "token":
        return dim.withColumn(CODE, F.explode(F.array_distinct(F.split(text, ", "))))
    if match != "substring":
        raise ValueError(f"match must be 'substring' or 'token', not {match!r}")
    if code_lengths is not None:
        lengths = F.array(*[F.lit(int(n)) for n in code_lengths])
    else:
        # At most as many members as the longest code has characters.
        lengths = codes.agg(F.collect_set(F.length(code_col))).scalar()
    size = F.length(text)
    return (
        dim.withColumn("_lengths", lengths)
        .withColumn("_length", F.explode("_lengths"))
        .filter(size >= F.col("_length"))
        .withColumn("_start", F.explode(F.sequence(F.lit(1), size - F.col("_length") + 1)))
        .withColumn(CODE, F.substr(text, F.col("_start"), F.col("_length")))
        .filter(F.position(F.col(CODE), text) == F.col("_start"))
        .drop("_lengths", "_length", "_start")
    )


def matching_pieces(
    dim: DataFrame,
    list_col: str,
    codes: DataFrame | None = None,
    code_col: str | None = None,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
) -> DataFrame:
    """`listed_codes` without the pieces that are no code at all, where `codes` tells which are.

    Most pieces of a list are none; they go where they are cut, before any shuffle, if Spark can broadcast
    the distinct codes, and in a join otherwise.
    """
    pieces = listed_codes(dim, list_col, codes, code_col, match, code_lengths)
    if codes is None or code_col is None:
        return pieces
    return pieces.join(codes.select(F.col(code_col).alias(CODE)).distinct(), CODE, "left_semi")


def container_map(
    dim: DataFrame,
    list_col: str,
    rank_col: str,
    keep: Sequence[str],
    codes: DataFrame | None = None,
    code_col: str | None = None,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
    unique_by: Sequence[str] | None = None,
) -> DataFrame:
    """Per listed code the row with the largest rank value; a NULL rank never wins.

    Rows that tie are all kept, unless `unique_by` orders them and keeps the first. The
    window limit inside the map tasks drops all but the leading rows of a code before
    the shuffle, also of a code that most rows list.
    """
    needed = dim.select(*dict.fromkeys([list_col, rank_col, *keep, *(unique_by or [])]))
    pieces = matching_pieces(needed, list_col, codes, code_col, match, code_lengths)
    best = Window.partitionBy(CODE).orderBy(F.desc(rank_col), *[F.asc(name) for name in unique_by or []])
    place = F.row_number() if unique_by else F.rank()
    return (
        pieces.filter(F.col(rank_col).isNotNull())
        .withColumn("_place", place.over(best))
        .filter(F.col("_place") == 1)
        .select(CODE, *keep)
    )


def top_container(
    df: DataFrame,
    dim: DataFrame,
    code_col: str,
    list_col: str,
    rank_col: str,
    keep: dict[str, str],
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
    unique_by: Sequence[str] | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Left-join `df` to the top-ranked `dim` row(s) that list its code.

    `keep` maps columns of `dim` to their new names; they are NULL without a match. `codes`
    may be any cheaper frame that holds at least the codes of `df`; with `code_lengths` none is
    needed, and `df` is not read for them. No broadcast is forced: Spark broadcasts the map if its size, estimated or measured at run time,
    allows, and otherwise splits skewed codes of the left side.
    """
    source = df if codes is None and code_lengths is None else codes
    best = container_map(
        dim, list_col, rank_col, list(keep), source, code_col, match, code_lengths, unique_by
    ).withColumnsRenamed(keep)
    return df.join(best, F.col(code_col) == F.col(CODE), "left").drop(CODE)
