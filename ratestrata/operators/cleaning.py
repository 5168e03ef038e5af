"""Cleaning of text tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratestrata.functions.text import MISSING_TOKENS, missing_to_null, normal_name, strip_white

log = logging.getLogger(__name__)

# Data frame type names that callers may use instead of Spark's.
TYPE_NAMES = {
    "int32": "int", "int64": "bigint", "Int64": "bigint", "float32": "float", "float64": "double",
    "str": "string", "object": "string", "bool": "boolean", "datetime64[ns]": "timestamp",
}


def normalize_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Headers to snake case, then renamed by `mapping`, whose keys are normalised alike.

    Only the schema changes, so the scan below keeps its pruning.
    """
    wanted = {normal_name(old): new for old, new in (mapping or {}).items()}
    names = [wanted.get(name, name) for name in map(normal_name, df.columns)]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns share a name once normalised: {repeated}")
    return df.toDF(*names)


def _text_columns(df: DataFrame) -> set[str]:
    return {field.name for field in df.schema if isinstance(field.dataType, T.StringType)}


def _map_text(df: DataFrame, change) -> DataFrame:
    text = _text_columns(df)
    return df.select(
        *[change(F.col(f"`{name}`")).alias(name) if name in text else F.col(f"`{name}`") for name in df.columns]
    )


def null_tokens(df: DataFrame, tokens: list[str] = MISSING_TOKENS) -> DataFrame:
    return _map_text(df, lambda col: missing_to_null(col, tokens))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows without any value. Run it before `trim_strings`: a row of blanks is not empty."""
    return df.na.drop("all")


def trim_strings(df: DataFrame) -> DataFrame:
    return _map_text(df, strip_white)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast whole columns or leave them: one bad cell keeps its column text.

    All columns are checked in one map-side aggregation, which runs at once because
    its outcome decides the schema. NULL is no bad cell. Unknown names are ignored.
    """
    wanted = {name: TYPE_NAMES.get(kind, kind) for name, kind in types.items() if name in df.columns}
    if not wanted:
        return df
    bad = df.agg(
        *[
            F.count_if(F.col(f"`{name}`").isNotNull() & F.col(f"`{name}`").try_cast(kind).isNull()).alias(name)
            for name, kind in wanted.items()
        ]
    ).first()
    for name, kind in wanted.items():
        if bad[name]:
            log.warning("column %s stays text: %d cells are no %s", name, bad[name], kind)
    return df.withColumns(
        {name: F.col(f"`{name}`").cast(kind) for name, kind in wanted.items() if not bad[name]}
    )


def rate_rule() -> Column:
    """A finite number above zero. Text that is no number breaks the rule, and fails no job."""
    rate = F.col("rate").cast("string").try_cast("double")
    return (rate > 0) & (rate < float("inf"))


def country_rule() -> Column:
    return (F.coalesce("cca2", F.lit("")) != "") | (F.coalesce("cca3", F.lit("")) != "")


def any_value_rule(df: DataFrame) -> Column:
    """True for rows with at least one value that is more than whitespace."""
    filled = [
        F.coalesce(strip_white(F.col(f"`{name}`").cast("string")), F.lit("")) != "" for name in df.columns
    ]
    rule = F.lit(False)
    for check in filled:
        rule = rule | check
    return rule


def validate(df: DataFrame, rule: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into rows that keep the rule and rows that break it; an unknown outcome breaks it."""
    kept = F.coalesce(F.lit(True) if rule is None else rule, F.lit(False))
    return df.filter(kept), df.filter(~kept)
