"""Text rules of the ingest side."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The tokens that mean "missing" in a landed CSV.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# All characters that count as whitespace when a cell is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accepted spellings of a truth value, compared in lower case.
TRUE_WORDS = ["true", "1", "t", "yes"]
FALSE_WORDS = ["false", "0", "f", "no"]


def normal_name(name: str) -> str:
    """`" Country-Name (EN) "` becomes `country_name_en`."""
    joined = re.sub(r"[\s\-.]+", "_", name.strip().lower())
    return re.sub(r"\W", "", joined)


def strip_white(col: Column) -> Column:
    """Remove whitespace of every kind at both ends; SQL `trim` knows the blank only."""
    return F.btrim(col, F.lit(WHITESPACE))


def missing_to_null(col: Column, tokens: list[str] = MISSING_TOKENS) -> Column:
    return F.when(~col.isin(tokens), col)


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def blank_to_null(col: Column) -> Column:
    return empty_to_null(F.trim(col))


def truth(col: Column) -> Column:
    """Boolean of a spelled truth value; any other spelling is NULL."""
    word = F.lower(col)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def join_sorted(col: Column, kind: str) -> Column:
    """Multi-valued cell as `", "`-joined text.

    `keys` and `values` of a map are sorted, and an empty map is NULL; an `array`
    keeps its order, and a missing one is the empty text.
    """
    if kind == "array":
        return F.coalesce(F.array_join(col, ", "), F.lit(""))
    members = {"keys": F.map_keys, "values": F.map_values}[kind](col)
    return F.when(F.size(members) > 0, F.array_join(F.sort_array(members), ", "))


def double_text(col: Column) -> Column:
    """A double in the digits of its shortest form: `17098242.0`, and from 1e16 up or below 1e-4 `1e+16`, `1.5e-05`;
    Spark's own cast gives `1.7098242E7`, `1.0E16` and `1.5E-5`."""
    text = col.cast("string")
    magnitude = F.abs(col)
    digits = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))
    padded = F.when(F.abs(power) < 10, F.concat(F.lit("0"), F.abs(power).cast("string"))).otherwise(F.abs(power).cast("string"))
    return (
        F.when(~text.contains("E"), text)
        .when((magnitude >= 1e-4) & (magnitude < 1e16), plain)
        .otherwise(F.concat(mantissa, sign, padded))
    )


def epoch_day(seconds: Column) -> Column:
    """UTC date of an epoch time, whatever the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
