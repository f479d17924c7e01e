"""Lenient readers for dates, numbers, flags and arrays: bad input becomes NULL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions.text import strip, to_null

NUMBER_TEXT = r"(?i)^[+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?$|^[+-]?inf(?:inity)?$"

# Accepted spellings of a flag.
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")

# Words that may precede a scraped release date.
RELEASE_PREFIX = r"(?i)^(?:Opened|Streaming)\s*"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value computed once, however often the body uses it.

    Without this the input expression is repeated at every use, and a chain of
    parsers outgrows the size of a generated method.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_timestamp(c: Column) -> Column:
    """ISO text to a UTC instant; text without an offset is UTC."""
    iso = lambda t: F.when(t.rlike(r"^\d{4}-\d{1,2}"), F.try_to_timestamp(t))
    return bind(to_null(c), lambda t: F.coalesce(iso(t), _date_of(t).cast("timestamp")))


def parse_date(c: Column) -> Column:
    """Calendar date from the usual spellings, month first where ambiguous."""
    return bind(to_null(c), _date_of)


def _date_of(text: Column) -> Column:
    spoken = F.regexp_replace(F.regexp_replace(text, r"[,.]", " "), r"\s+", " ")
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text))
        .when(
            text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"),
            # The date as written, whatever its offset.
            F.when(F.try_to_timestamp(text).isNotNull(), F.try_to_date(F.left(text, F.lit(10)))),
        )
        .when(text.rlike(r"^\d{4}(-\d{1,2}){0,2}$"), F.to_date(F.try_to_timestamp(text)))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "M/d/yyyy"))
        .when(text.rlike(r"^[A-Za-z]{3}"), bind(spoken, _spoken_date))
    )


def _spoken_date(text: Column) -> Column:
    return (
        F.when(text.rlike(r"^[A-Za-z]{3} \d{1,2} \d{4}$"), F.try_to_date(text, "MMM d yyyy"))
        .when(text.rlike(r"^[A-Za-z]{4,9} \d{1,2} \d{4}$"), F.try_to_date(text, "MMMM d yyyy"))
        .when(text.rlike(r"^[A-Za-z]{3} \d{4}$"), F.try_to_date(text, "MMM yyyy"))
        .when(text.rlike(r"^[A-Za-z]{4,9} \d{4}$"), F.try_to_date(text, "MMMM yyyy"))
    )


def parse_release_date(c: Column) -> Column:
    return parse_date(F.regexp_replace(strip(c), RELEASE_PREFIX, ""))


def release_year(date: Column) -> Column:
    return F.year(date)


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def safe_double(c: Column) -> Column:
    """Number out of text; anything else, NaN included, is NULL."""
    text = strip(c)
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def double_of(df: DataFrame, name: str) -> Column:
    """``safe_double`` for text columns, a plain cast for numeric ones."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return safe_double(F.col(name))
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def parse_percent(c: Column) -> Column:
    return safe_double(F.replace(c, F.lit("%"), F.lit("")))


def parse_flag(c: Column) -> Column:
    """Text to true, false or NULL; a number is true unless it is zero."""
    text = F.lower(strip(c.cast("string")))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False).otherwise(safe_double(text) != 0)


def ids_text(c: Column) -> Column:
    """Array of ids as ``[a, b]``; NULL stays NULL."""
    return F.concat(
        F.lit("["),
        F.array_join(F.transform(c, lambda x: x.cast("string")), ", ", "null"),
        F.lit("]"),
    )


def sorted_json(c: Column, dtype: T.DataType) -> Column:
    """Nested value as JSON text with its fields in name order."""
    return F.to_json(_sorted_fields(c, dtype))


def _sorted_fields(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        ordered = sorted(dtype.fields, key=lambda f: f.name)
        fields = [_sorted_fields(c.getField(f.name), f.dataType).alias(f.name) for f in ordered]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _sorted_fields(x, dtype.elementType))
    return c


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; an empty whole gives 0."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))
