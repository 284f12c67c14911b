"""Column types of text frames, found in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablekit.functions.columns import quoted, string_columns

# Text forms a value must have before a cast is tried. They keep suffixed numbers
# ('1d'), yes/no words and bare clock times text instead of letting a cast that
# happens to succeed decide, and spare text columns the cost of failing casts.
NUMBER_TEXT = r"^-?\d+(\.\d+)?([eE]-?\d+)?$"
DATE_TEXT = r"^\d{4}-\d\d-\d\d \d\d:"

# A number with decimals but without an exponent, no digit of it to spare.
PLAIN_TEXT = r"^-?(0|[1-9]\d*)\.(0|\d*[1-9])$"
WHOLE_TEXT = r"^-?\d+$"

# Most numbers: so short that both types, or a double in both spellings, print the same.
SHORT_WHOLE = r"^(0|-?[1-9]\d{0,14})\z"
SHORT_DECIMAL = r"^-?[1-9]\d{0,6}\.(0|\d{0,7}[1-9])\z"

# From narrow to wide; the first type that every value accepts wins. Bit i of a mask
# stands for the i-th type. Doubles have two ways to be spelt, Spark's own (1.0E7) and
# without an exponent; a column of text has to keep to one.
CANDIDATES = ("bigint", "double", "double", "boolean", "timestamp")
BIGINT, SPARK_DOUBLE, PLAIN_DOUBLE, BOOLEAN, TIMESTAMP = (1 << i for i in range(len(CANDIDATES)))
DOUBLE = SPARK_DOUBLE | PLAIN_DOUBLE


def infer_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type for every string column; ``string`` if nothing fits.

    Each value becomes a mask with one bit per type that accepts it. ``bit_and``
    skips nulls and combines the masks before the shuffle, so one row per task
    reaches the final aggregate.
    """
    text = [c for c in df.columns if c in string_columns(df)]
    if not text:
        return {}
    found = df.agg(*[F.bit_and(text_mask(quoted(c))).alias(str(i)) for i, c in enumerate(text)])
    return {name: narrowest(mask) for name, mask in zip(text, found.first())}


def _digits(number: Column) -> Column:
    """The significant digits of a number's text. A double has the same ones as the text
    it was read from if and only if it is the same number when printed."""
    return F.btrim(F.regexp_replace(number, r"[eE].*$|[-+.]", ""), F.lit("0"))


def text_mask(c: Column) -> Column:
    """The types that hold one text so that it prints as the same text again: no zeros
    before a key, no sign, no digit and no spelling is lost to a type."""
    # a cast that fails costs an exception: only what looks like a type is cast to it
    whole = F.when(c.rlike(WHOLE_TEXT), c.try_cast("bigint"))
    real, moment = c.try_cast("double"), c.try_cast("timestamp")
    exact = whole.between(-(2**53), 2**53)
    plain = c.rlike(PLAIN_TEXT) & (_digits(real.cast("string")) == _digits(c))
    number = F.when(whole.cast("string") == c, F.when(exact, BIGINT | DOUBLE).otherwise(BIGINT))
    decimal = F.when(real.cast("string") == c, SPARK_DOUBLE).otherwise(0)
    number = number.otherwise(decimal.bitwiseOR(F.when(plain, PLAIN_DOUBLE).otherwise(0)))
    to_second = F.length(c) == len("yyyy-MM-dd HH:mm:ss")
    shown = F.when(to_second, F.date_format(moment, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS"))
    date = c.rlike(DATE_TEXT) & F.coalesce(shown == c, F.lit(False))
    short = F.when(c.rlike(SHORT_WHOLE), BIGINT | DOUBLE).when(c.rlike(SHORT_DECIMAL), DOUBLE)
    mask = short.when(c.rlike(NUMBER_TEXT), number).when(date, TIMESTAMP).when(c.isin("true", "false"), BOOLEAN).otherwise(0)
    return F.when(c.isNotNull(), mask)


def narrowest(mask: int | None) -> str:
    """The first type that a mask accepts."""
    accepted = [name for i, name in enumerate(CANDIDATES) if mask is not None and mask & 1 << i]
    return accepted[0] if accepted else "string"


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(
        *[
            quoted(c).try_cast(types[c]).alias(c) if types.get(c, "string") != "string" else quoted(c)
            for c in df.columns
        ]
    )
