"""Tolerant conversions at the JSON boundary (text and numbers mixed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "missing" once a table went through CSV.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Batting-side words, tested in this order.
HIT_SIDES = [("양타", "S"), ("좌타", "L"), ("우타", "R")]


PLAIN_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def nullable_number(text: Column) -> Column:
    """DOUBLE, or NULL when the text is missing, blank, no plain number or NaN.

    A number may stand between blanks and have an exponent; type letters behind it
    make it text.
    """
    number = F.when(F.rlike(text, F.lit(PLAIN_NUMBER)), F.trim(text)).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_number(text: Column, default: float = 0.0) -> Column:
    """DOUBLE with a default in place of anything unparsable."""
    return F.coalesce(nullable_number(text), F.lit(float(default)))


def base_flag(text: Column) -> Column:
    """1 when the base holds a runner (any non-zero integer), otherwise 0."""
    return F.when(text.try_cast("int") != 0, 1).otherwise(0).cast("int")


def score_difference(home: Column, away: Column) -> Column:
    """Home minus away, fractions cut toward zero."""
    return (safe_number(home) - safe_number(away)).cast("int")


def hit_side(text: Column) -> Column:
    """L / R / S from the handedness text, NULL when none of the words occurs."""
    out = F.lit(None).cast("string")
    for word, side in reversed(HIT_SIDES):
        out = F.when(F.contains(text, F.lit(word)), F.lit(side)).otherwise(out)
    return out


def na_to_null(text: Column) -> Column:
    """NULL for every word the tabular layer reads as missing."""
    return F.when(~text.isin(NA_WORDS), text)


def variant_truthy(value: Column) -> Column:
    """Number 0, '', null and absent are false; any other text, even '0.000', is true."""
    json = F.to_json(value)
    number = F.when(~F.startswith(json, F.lit('"')), json.try_cast("double"))
    return F.when(number.isNotNull(), number != 0).otherwise(
        F.coalesce(~json.isin('""', "null", "false"), F.lit(False))
    )
