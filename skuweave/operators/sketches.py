"""Mergeable sketches as columns: distinct counts and quantiles per day and group, merged for any range of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct count (relative error about 0.8 / sqrt(2^k)) and the k of quantiles (rank error about 1.3 % at 200).
DISTINCT_BITS, QUANTILE_K = 14, 400


def daily_sketches(rows: DataFrame, groups: list[str], day: str, distinct: str, value: str) -> DataFrame:
    """One row for each group and day: n, lowest and highest value, a sketch of the distinct ones and one of the values.

    Sketches have a bounded size whatever the rows, and are built before the shuffle; store them, and any range of days and any
    coarser group is a merge of few rows. Null values count in n only.
    """
    return rows.groupBy(*groups, day).agg(
        F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.hll_sketch_agg(distinct, DISTINCT_BITS).alias("distinct_sketch"), F.kll_sketch_agg_bigint(value, QUANTILE_K).alias("value_sketch"),
    )


def merged_sketches(sketches: DataFrame, groups: list[str], quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Sketches of many days as one row for each group: n, low, high, n_distinct (estimated), and the estimated quantiles."""
    m = sketches.groupBy(*groups).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"), F.kll_merge_agg_bigint("value_sketch").alias("_v"),
    )
    return m.select(*groups, "n", "low", "high", "n_distinct", *[F.kll_sketch_get_quantile_bigint("_v", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles])
