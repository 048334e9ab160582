"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for "no value" in the source files, upper-cased.
PLACEHOLDERS = ("", "NA", "N/A", "NULL", "NONE", "-")

# Characters left around product names by list-style text.
LIST_MARKS = "[]'\""


def without_placeholder(text: Column) -> Column:
    """Null for placeholder words in any letter case, otherwise the text."""
    return F.when(~F.upper(text).isin(*PLACEHOLDERS), text)


def category(text: Column) -> Column:
    """Trimmed, placeholder-free, title-cased text; the placeholder test precedes the casing."""
    return F.initcap(without_placeholder(F.trim(text)))


# How a cell is written on one line. The mark itself comes first when writing and last when
# reading, so that whatever a cell holds comes back as it was.
_ONE_LINE = (("~", "~t"), ("\n", "~n"), ("\r", "~r"))


def one_line(text: Column) -> Column:
    """Text without line breaks, reversible by ``restored``."""
    for plain, written in _ONE_LINE:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def restored(text: Column) -> Column:
    """What ``one_line`` was given."""
    for plain, written in reversed(_ONE_LINE):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def strip_marks(text: Column, marks: str = LIST_MARKS) -> Column:
    return F.translate(text, marks, "")


def clean_product(text: Column) -> Column:
    """One spelling per product: list marks gone, trimmed, lower case."""
    return F.lower(F.trim(strip_marks(text)))


def basket(text: Column) -> Column:
    """Array of product names; an empty list text gives an empty array."""
    names = F.split(F.trim(strip_marks(text)), " *, *")
    return F.array_remove(names, "")


def basket_verbatim(text: Column) -> Column:
    """Array of comma-separated pieces, trimmed and otherwise untouched."""
    return F.transform(F.split(text, ","), lambda piece: F.trim(piece))
