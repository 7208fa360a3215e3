"""Typing, text and arithmetic rules shared by all models, as JVM-side expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def strict_number(text: Column, to: str = "double") -> Column:
    """Text to number. Blank means "no value yet"; any other non-number fails under ANSI."""
    return blank_to_null(text).cast(to)


def column_names(df: DataFrame) -> set[str]:
    """The columns a frame really has, lower-cased. Reads the schema only; runs no job."""
    return {name.lower() for name in df.columns}


def optional_column(df: DataFrame, name: str, to: str, alias: str | None = None) -> Column:
    """A column that may be missing from every file: cast when there, else a typed NULL.

    Numeric text gets the strict treatment, so a blank is NULL here too.
    """
    if name.lower() not in column_names(df):
        return F.lit(None).cast(to).alias(alias or name)
    is_text = df.select(name).schema[0].dataType.simpleString() == "string"
    value = strict_number(F.col(name), to) if is_text and to != "string" else F.col(name).cast(to)
    return value.alias(alias or name)


def scaled(units: Column, per_whole: float = 10.0) -> Column:
    """Whole units from exact integer sub-units (tenths by default), as a double."""
    return units / F.lit(float(per_whole))


def ratio(numerator: Column, denominator: Column) -> Column:
    """a / b as a double; NULL, not an error or infinity, where b is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def joined_text(*parts: Column | str) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def span_length(first: Column, last: Column) -> Column:
    return last - first + F.lit(1)


def facet_mean(home: Column, away: Column) -> Column:
    return (home + away) / F.lit(2.0)


def nested_text(value: Column) -> Column:
    """A nested value kept whole as JSON text, with the nulls inside it."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def epoch_text_to_timestamp(text: Column) -> Column:
    return F.timestamp_seconds(text.cast("double"))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality: two NULLs agree, a NULL and a value differ."""
    return ~left.eqNullSafe(right)


def apart(left: Column, right: Column, tolerance: float = 0.001) -> Column:
    return F.abs(left - right) > F.lit(tolerance)


def is_one_of(value: Column, allowed: Iterable) -> Column:
    return value.isin(*allowed)


def document_field(document: Column, path: str, to: str) -> Column:
    """A field of a VARIANT document, NULL when it is missing or is a JSON null."""
    return F.try_variant_get(document, path, to)


def document_null(document: Column, path: str) -> Column:
    """True for a JSON null, false for a value, NULL when the document has no such key."""
    inner = F.variant_get(document, path, "variant")
    return F.when(inner.isNotNull(), F.is_variant_null(inner))
