"""Column profiles that merge: sketches of parts of a table are stored, and only they are read afterwards.

The exact profiles of ``operators.profile`` stay the default. Here distinct counts and quantiles are
estimates with known error, and counts, sums, extremes and frequent values of few distinct ones are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.profile import CATEGORICAL, QUARTILES

NUMBERS = ("Total_Items", "Total_Cost")
# Relative standard error of a distinct count is 1.04 / sqrt(2^12) = 1.6 %; a quantile's rank is within 0.6 % of
# all rows, 99 times in 100; values are counted exactly up to 768 distinct ones (three quarters of the table).
LOG2_DISTINCT = 12
RANKS = 512
TRACKED = 1024


def _parts(numbers: tuple[str, ...], categories: tuple[str, ...]) -> dict[str, Column]:
    found = {"n": F.count(F.lit(1))}
    for c in numbers:
        x = F.col(c).cast("double")
        found |= {
            f"n_{c}": F.count(c),
            f"mean_{c}": F.avg(x),
            f"squares_{c}": F.var_pop(x) * F.count(c),
            f"min_{c}": F.min(x),
            f"max_{c}": F.max(x),
            f"ranks_{c}": F.kll_sketch_agg_double(x, F.lit(RANKS)),
        }
    for c in categories:
        text = F.col(c).cast("string")
        found |= {
            f"nulls_{c}": F.count_if(F.col(c).isNull()),
            f"distinct_{c}": F.hll_sketch_agg(text, F.lit(LOG2_DISTINCT)),
            f"frequent_{c}": F.expr(f"approx_top_k_accumulate(cast(`{c}` AS string), {TRACKED}) FILTER (WHERE `{c}` IS NOT NULL)"),
        }
    return found


def sketched(
    df: DataFrame, by: str | None = None, numbers: tuple[str, ...] = NUMBERS, categories: tuple[str, ...] = CATEGORICAL
) -> DataFrame:
    """One row of mergeable parts, or one per value of ``by``; a few hundred KB each at any number of rows."""
    parts = [part.alias(name) for name, part in _parts(numbers, categories).items()]
    return df.groupBy(*([by] if by else [])).agg(*parts)


def _inlined(df: DataFrame, cells: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*cells)))


def summary(parts: DataFrame, numbers: tuple[str, ...] = NUMBERS) -> DataFrame:
    """Count, mean, sample deviation, extremes and estimated quartiles per numeric column."""
    merged = []
    for c in numbers:
        n, mean = F.col(f"n_{c}"), F.col(f"mean_{c}")
        merged += [
            F.sum(n).alias(f"n_{c}"),
            F.try_divide(F.sum(n * mean), F.sum(n).cast("double")).alias(f"mean_{c}"),
            (F.sum(f"squares_{c}") + F.sum(n * mean * mean)).alias(f"squares_{c}"),
            F.min(f"min_{c}").alias(f"min_{c}"),
            F.max(f"max_{c}").alias(f"max_{c}"),
            F.kll_merge_agg_double(f"ranks_{c}").alias(f"ranks_{c}"),
        ]
    cells = []
    for c in numbers:
        n, mean = F.col(f"n_{c}"), F.col(f"mean_{c}")
        spread = F.greatest(F.col(f"squares_{c}") - n * mean * mean, F.lit(0.0))
        quartiles = [
            F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(f"ranks_{c}"), F.lit(s))).alias(f"p{int(s * 100)}")
            for s in QUARTILES
        ]
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                n.alias("value_count"),
                F.round(mean, 4).alias("mean_value"),
                F.round(F.sqrt(F.try_divide(spread, n - 1)), 4).alias("stddev_value"),
                F.col(f"min_{c}").alias("min_value"),
                F.col(f"max_{c}").alias("max_value"),
                *quartiles,
            )
        )
    return _inlined(parts.agg(*merged), cells)


def distinct_counts(parts: DataFrame, categories: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """Estimated distinct values per column, null counting as one."""
    merged = [
        (
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")), F.lit(0))
            + F.coalesce(F.max((F.col(f"nulls_{c}") > 0).cast("int")), F.lit(0))
        )
        .cast("bigint")
        .alias(c)
        for c in categories
    ]
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count")) for c in categories]
    return _inlined(parts.agg(*merged), cells)


def _counted(c: str) -> Column:
    """Tracked values of a column and its nulls as cells of the distribution."""

    def cell(value: Column, n: Column) -> Column:
        name = F.lit(c).alias("column_name")
        return F.struct(name, value.alias("column_value"), n.cast("long").alias("value_count"))

    nulls = F.array(cell(F.lit(None).cast("string"), F.coalesce(F.col(f"nulls_{c}"), F.lit(0))))
    return F.concat(F.transform(F.col(c), lambda x: cell(x["item"], x["count"])), nulls)


def value_distribution(parts: DataFrame, categories: tuple[str, ...] = CATEGORICAL, top: int = 10) -> DataFrame:
    """The most frequent values of each column with their counts, null being one of them.

    Ties are settled by the value, as far as tied values are among the frequent ones that are tracked.
    """
    merged = []
    for c in categories:
        merged += [
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent_{c}, {TRACKED}), {TRACKED // 2})").alias(c),
            F.sum(f"nulls_{c}").alias(f"nulls_{c}"),
        ]
    # Grouped by nothing in particular: frequent values of no parts at all cannot be combined.
    one = parts.groupBy(F.lit(0).alias("all")).agg(*merged)
    rows = one.select(F.inline(F.concat(*[_counted(c) for c in categories]))).filter("value_count > 0")
    # As many rows as a column has tracked values.
    place = F.expr("row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, column_value ASC NULLS FIRST)")
    return rows.withColumn("place", place).filter(F.col("place") <= top)
