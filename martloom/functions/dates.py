"""Timestamp parsing and calendar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp formats, first match wins.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd-MM-yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "dd-MM-yyyy",
    "MM-dd-yyyy",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "yyyy/MM/dd",
)


def _shape_of(pattern: str) -> str:
    return re.sub(r"[yMdHms]", "9", pattern)


def _numeric(formats: tuple[str, ...]) -> bool:
    """Whether every format consists of digits and separators only."""
    return not any(re.search(r"[a-zA-Z']", _shape_of(f)) for f in formats)


def digit_shape(text: Column) -> Column:
    """The text with every digit replaced by ``9``."""
    return F.translate(text, "012345678", "9" * 9)


def _attempts(text: Column, formats: tuple[str, ...], shape: Column | None) -> list[Column]:
    """One parse per format, tried only where the shape of the text does not rule it out.

    A failed attempt costs several times a successful one. Texts of no listed shape are tried with
    every format, so nothing is read differently from trying them all.
    """
    parses = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    if not _numeric(formats):
        return parses
    shape = digit_shape(text) if shape is None else shape
    unlisted = ~shape.isin(*dict.fromkeys(_shape_of(f) for f in formats))
    return [F.when((shape == _shape_of(f)) | unlisted, p) for f, p in zip(formats, parses, strict=True)]


def parse_timestamp(
    text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS, shape: Column | None = None
) -> Column:
    """Timestamp by the first matching format, or null.

    ``shape`` may name a column already holding :func:`digit_shape` of the text.
    """
    return F.coalesce(*_attempts(text, formats, shape))


def readable_by(
    text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS, shape: Column | None = None
) -> dict[str, Column]:
    """Per format, whether it reads the text."""
    attempts = _attempts(text, formats, shape)
    return {f: a.isNotNull() for f, a in zip(formats, attempts, strict=True)}


def date_key(day: Column) -> Column:
    """Calendar key YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def leading_date(text: Column) -> Column:
    """Date held by the first ten characters of a timestamp text, or null."""
    return F.left(text, F.lit(10)).try_cast("date")


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "Year": F.year(day),
        "Month": F.month(day),
        "Day": F.dayofmonth(day),
        "Quarter": F.quarter(day),
        "Month_Name": F.date_format(day, "MMMM"),
    }
