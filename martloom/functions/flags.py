"""Yes/no texts to boolean, by named rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FlagRule:
    true: tuple[str, ...]
    false: tuple[str, ...]
    otherwise: bool | None


# The three readings of a discount flag in use.
SOURCE_FLAG = FlagRule(("yes", "true", "1"), ("no", "false", "0"), None)
TYPED_STAGING_FLAG = FlagRule(("true",), ("false",), False)
TEXT_STAGING_FLAG = FlagRule(("true", "1"), ("false", "0"), None)


def to_flag(text: Column, rule: FlagRule = SOURCE_FLAG) -> Column:
    word = F.lower(text)
    return (
        F.when(word.isin(*rule.true), F.lit(True))
        .when(word.isin(*rule.false), F.lit(False))
        .otherwise(F.lit(rule.otherwise).cast("boolean"))
    )
