"""Variant families: attributes of variants, what is fixed or varies, and series along the varying axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.operators.measures import all_measures

#: Dimensions that count pieces; they are the axis of a family before physical ones.
COUNTS = ("pieces", "packs", "sheets", "tablets", "capsules")


def is_count(dim: str) -> Column:
    return F.startswith(dim, F.lit("count")) | F.col(dim).isin(*COUNTS)



def variant_attributes(variants: DataFrame, features: DataFrame, key: str = "uid", text: str = "title", price: str = "price") -> DataFrame:
    """(key, attr, value): the measures of a variant's title, its price, its price for a piece or for 100 units, and the
    features that at least half of its specs name.

    variants: key, text, price; features: key, spec_id, feature. A price for 100 units is for grams, else for millilitres,
    and only where no piece is counted. Measures among the features are left out.
    """
    m = all_measures(variants.select(key, text), text).select(key, "dim", "base_value")
    wide = m.groupBy(key).agg(
        F.min(F.when(is_count("dim"), F.struct("dim", "base_value")))["base_value"].alias("count"), F.max(F.when(F.col("dim") == "mass", F.col("base_value"))).alias("mass"), F.max(F.when(F.col("dim") == "volume", F.col("base_value"))).alias("volume")
    )
    v = variants.select(key, F.col(price).cast("double").alias("price")).where("price > 0").join(wide, key, "left")
    piece, amount = F.bround(F.try_divide("price", "count"), 0), F.coalesce("volume", "mass")
    prices = v.select(key, F.explode(F.map_filter(F.create_map(
        F.lit("price"), F.col("price"), F.lit("price_per_piece"), F.when(F.col("count") > 0, piece),
        F.lit("price_per_100"), F.when(F.col("count").isNull(), F.bround(F.try_divide(F.col("price"), amount) * 100, 0)),
    ), lambda k, x: x.isNotNull())).alias("attr", "value"))
    n = features.groupBy(key).agg(F.count_distinct("spec_id").alias("n"))
    named = features.where(~F.col("feature").rlike(r"^[0-9]+(\.[0-9]+)?[a-z]+$")).groupBy(key, "feature").agg(F.count_distinct("spec_id").alias("c"))
    most = named.join(n, key).where(F.col("c") >= F.floor((F.col("n") + 1) / 2)).select(key, F.col("feature").alias("attr"), F.lit(1.0).alias("value"))
    return m.select(key, F.col("dim").alias("attr"), F.col("base_value").alias("value")).union(prices).union(most)


def family_series(attributes: DataFrame, families: DataFrame, key: str = "uid", family: str = "family") -> DataFrame:
    """(family, axis, attr, bars): prices of a family's variants in order of the dimension that varies.

    The axis is a dimension with at least two different values in the family: a count if there is one, else the first
    by name. bars is 'axis value=price' for each variant that has both, at least two of them.
    """
    a = attributes.join(families, key)
    dims = a.where(~F.startswith("attr", F.lit("price")) & (is_count("attr") | F.col("attr").isin("mass", "volume", "length", "power")))
    axis = dims.groupBy(family, "attr").agg(F.count_distinct(F.round("value", 4)).alias("n")).where("n >= 2")
    axis = axis.groupBy(family).agg(F.min(F.struct((~is_count("attr")).alias("physical"), F.col("attr").alias("axis"))).alias("x")).select(family, "x.axis")
    at = dims.join(axis, family).where("attr = axis").select(family, "axis", key, F.col("value").alias("at"))
    bars = at.join(a.where(F.startswith("attr", F.lit("price"))).select(key, "attr", "value"), key)
    text = lambda s: F.concat(F.bround(s["at"], 2).cast("string"), F.lit("="), F.bround(s["value"], 0).cast("bigint").cast("string"))
    out = bars.groupBy(family, "axis", "attr").agg(F.sort_array(F.collect_list(F.struct("at", key, "value"))).alias("b")).where(F.size("b") >= 2)
    return out.select(family, "axis", "attr", F.array_join(F.transform("b", text), "|").alias("bars"))


def rating(meta: DataFrame, reviews: DataFrame, key: str, least: int = 3) -> DataFrame:
    """The catalogue's own rating and count if it has them, else the mean of at least three ratings, else none.

    meta: key, rating, n; reviews: key, stars. Two decimals.
    """
    r = reviews.where("stars is not null").groupBy(key).agg(F.avg("stars").alias("mean"), F.count("*").alias("c"))
    j = meta.join(r, key, "full_outer")
    own = F.col("rating").isNotNull() & (F.coalesce("n", F.lit(0)) > 0)
    enough = F.col("c") >= least
    return j.select(key, S.round_even(F.when(own, F.col("rating")).when(enough, F.col("mean")), 2).alias("rating"), F.when(own, F.col("n")).when(enough, F.col("c")).alias("n"), F.when(own, "catalog").when(enough, "reviews").otherwise("none").alias("origin"))
