"""Offers, price ladders, cleaned prices, undercuts and demand priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuweave.functions import scalars as S

USED_TYPES = (4, 5, 6)
HISTOGRAM_EDGES = (0, 1_000, 3_000, 5_000, 10_000, 30_000, 50_000, 100_000, 200_000)


def real_offers(offers: DataFrame) -> DataFrame:
    """Priced offers of a named mall, with a category path and the used flag; 4, 5 and 6 are used types."""
    return offers.where((F.col("price") > 0) & (F.trim("mall") != "")).withColumn("path", F.concat_ws(" > ", "brand", "category")).withColumn("used", F.col("product_type").isin(*USED_TYPES))


def sane_prices(offers: DataFrame, floor: int, ceil: int) -> DataFrame:
    return offers.where(F.col("price").between(floor, ceil))


def sane_price_counts(offers: DataFrame, floor: int, ceil: int) -> DataFrame:
    ok = F.col("price").between(floor, ceil)
    return offers.agg(F.count_if(ok).alias("kept"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("dropped"))


def price_ladder(offers: DataFrame, key: str = "product_uid", approx: bool = False) -> DataFrame:
    """Per product: offers, distinct malls, lowest, highest and median price, spread, used offers, cheapest mall.

    The cheapest mall of equal prices is the first by name. approx counts malls by a sketch.
    """
    malls = F.approx_count_distinct("mall") if approx else F.countDistinct("mall")
    out = offers.groupBy(key).agg(
        F.count("*").alias("n_offers"), malls.alias("n_malls"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), S.median_floor("price").alias("median_price"),
        F.count_if(F.col("product_type").isin(*USED_TYPES)).alias("n_used"), F.min(F.struct("price", "mall"))["mall"].alias("cheapest_mall"),
    )
    return out.withColumn("spread_pct", S.spread_over_min("min_price", "max_price"))


def price_distribution(offers: DataFrame, key: str) -> DataFrame:
    """Quartiles by linear interpolation, rounded half to even; the mean is cut to a whole number."""
    p = F.percentile("price", F.lit([0.25, 0.5, 0.75]))
    out = offers.groupBy(key).agg(p.alias("p"), F.floor(F.sum("price") / F.count("price")).cast("bigint").alias("avg_price"), F.count("*").alias("n"))
    return out.select(key, "n", "avg_price", *[F.bround(F.get("p", F.lit(i)), 0).cast("bigint").alias(n) for i, n in enumerate(("p25", "p50", "p75"))])


def top_values(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The k most common values of each group with their counts; ties by value."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dominant_model_prices(offers: DataFrame, group: str, model: str) -> DataFrame:
    """Price range of each group's most common model beside that of all its offers."""
    top = top_values(offers, [group], model, 1).select(group, F.col(model).alias("top_model"))
    mine = F.when(F.col(model) == F.col("top_model"), F.col("price"))
    out = offers.join(top, group).groupBy(group, "top_model").agg(
        F.count(mine).alias("n_top"), F.min(mine).alias("top_min"), F.max(mine).alias("top_max"), F.count("price").alias("n_all"), F.min("price").alias("all_min"), F.max("price").alias("all_max")
    )
    return out


def clean_offers(
    offers: DataFrame, group: str = "product_uid", wanted_qty: str | None = None, gate: F.Column | None = None, ratio: float = 4.0, trim: tuple[float, float] | None = None, iqr: float | None = None
) -> DataFrame:
    """The offers of each group that pass a cascade of stages, each on what the one before it left.

    name gate (may empty a group); same count (a missing count passes for single packs); not used; price within
    `ratio` of the median (3 rows at least); between the trim percentiles (5 rows); inside the IQR fence (4 rows, with
    q1 the row n div 4 and q3 the row 3n div 4). Every stage after the gate is skipped for a group that it would empty.
    """
    w = Window.partitionBy(group)

    def stage(df: DataFrame, ok: F.Column) -> DataFrame:
        df = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_any", F.max("_ok").over(w))
        return df.where(F.col("_ok") | ~F.col("_any")).drop("_ok", "_any")

    out = offers if gate is None else offers.where(gate)
    if wanted_qty is not None:
        out = stage(out, (F.col("qty") == F.col(wanted_qty)) | (F.col("qty").isNull() & (F.col(wanted_qty) == 1)))
    out = stage(out, ~F.col("product_type").isin(*USED_TYPES))
    mid, n = F.percentile("price", F.lit(0.5)).over(w), F.count("*").over(w)
    out = stage(out.withColumn("_m", mid).withColumn("_n", n), (F.col("_n") < 3) | ((F.col("price") <= F.col("_m") * ratio) & (F.col("price") * ratio >= F.col("_m")))).drop("_m", "_n")
    if trim is not None:
        p = F.percentile("price", F.lit(list(trim))).over(w)
        out = stage(out.withColumn("_p", p).withColumn("_n", n), (F.col("_n") < 5) | F.col("price").between(F.get("_p", F.lit(0)), F.get("_p", F.lit(1)))).drop("_p", "_n")
    if iqr is not None:
        order = Window.partitionBy(group).orderBy("price", "mall", "day", "title", "official_price")
        out = out.withColumn("_r", F.row_number().over(order) - 1).withColumn("_n", n)
        q1 = F.max(F.when(F.col("_r") == F.floor(F.col("_n") / 4), F.col("price"))).over(w)
        q3 = F.max(F.when(F.col("_r") == F.floor(F.col("_n") * 3 / 4), F.col("price"))).over(w)
        out = out.withColumn("_q1", q1).withColumn("_q3", q3)
        fence = (F.col("_q3") - F.col("_q1")) * iqr
        out = stage(out, (F.col("_n") < 4) | F.col("price").between(F.col("_q1") - fence, F.col("_q3") + fence)).drop("_r", "_n", "_q1", "_q3")
    return out


def category_statistics(offers: DataFrame) -> DataFrame:
    unit = F.col("price") / F.col("qty")
    per = offers.groupBy("category", "product_uid").agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    spreads = per.groupBy("category").agg(F.percentile(S.spread_over_min("lo", "hi"), F.lit(0.5)).alias("median_spread"), F.count("*").alias("n_products"))
    out = offers.groupBy("category").agg(F.count("*").alias("n"), S.median_floor("price").alias("median_price"), F.bround(F.percentile(unit, F.lit(0.5)), 2).alias("median_unit"))
    return out.join(spreads, "category").withColumn("median_spread", F.bround("median_spread", 2))


def mall_price_index(offers: DataFrame, min_malls: int = 2, min_listings: int = 8, malls: int = 14, categories: int = 10) -> DataFrame:
    """Per mall and category: mean of (the mall's lowest price of a product / median of the malls' lowest) - 1, percent."""
    low = offers.groupBy("category", "product_uid", "mall").agg(F.min("price").alias("low"))
    w = Window.partitionBy("product_uid")
    low = low.withColumn("mid", F.percentile("low", F.lit(0.5)).over(w)).withColumn("n", F.count("*").over(w)).where((F.col("n") >= min_malls) & (F.col("mid") > 0))
    index = low.groupBy("mall", "category").agg(F.count("*").alias("n"), F.bround((F.sum(F.col("low") / F.col("mid")) / F.count("*") - 1) * 100, 1).alias("index_pct")).where(F.col("n") >= min_listings)
    top_m = top_sums(index, "mall", malls)
    top_c = top_sums(index, "category", categories)
    return index.join(top_m, "mall", "left_semi").join(top_c, "category", "left_semi")


def top_sums(index: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.orderBy(F.desc("s"), by)
    return index.groupBy(by).agg(F.sum("n").alias("s")).orderBy(F.desc("s"), by).limit(k).withColumn("r", F.row_number().over(w)).select(by)


def mall_index_pivot(index: DataFrame, categories: list[str]) -> DataFrame:
    return index.groupBy("mall").pivot("category", categories).agg(F.first("index_pct"))


def price_position(offers: DataFrame) -> DataFrame:
    """Where a product is cheapest and dearest: prices, both malls (of equal prices the first by name), spread, and the mean spread of its category."""
    ladder = price_ladder(offers)
    dear = offers.groupBy("product_uid").agg(F.min(F.struct((-F.col("price")).alias("p"), "mall"))["mall"].alias("dearest_mall"), F.min("category").alias("category"))
    j = ladder.select("product_uid", "min_price", "max_price", "cheapest_mall", "n_malls", "spread_pct").join(dear, "product_uid")
    mean = j.groupBy("category").agg(F.bround(F.sum(F.col("spread_pct").cast("decimal(20,1)")).cast("double") / F.count("spread_pct"), 2).alias("category_spread"))
    return j.join(mean, "category")


def mall_coverage(offers: DataFrame, official_prefix: str) -> DataFrame:
    """Per mall: listings, products, prices and prices for a unit from lowest to highest, whether it is official."""
    unit = F.bround(F.col("price") / F.col("qty"), 0).cast("bigint")
    out = offers.groupBy("mall").agg(
        F.count("*").alias("n_listings"), F.count_distinct("product_uid").alias("n_products"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.min(unit).alias("min_unit"), F.max(unit).alias("max_unit"),
    )
    return out.withColumn("official", F.startswith("mall", F.lit(official_prefix)))


def official_undercut(offers: DataFrame) -> DataFrame:
    """Per product: official price, lowest offer and its mall, percent under the official price."""
    out = offers.groupBy("product_uid").agg(F.min("official_price").alias("official"), F.min("price").alias("lowest"), F.min(F.struct("price", "mall"))["mall"].alias("lowest_mall"), F.count("*").alias("n"))
    out = out.withColumn("undercut_pct", S.percent_below("lowest", "official"))
    return out.withColumn("severity", S.severity("undercut_pct"))


def undercut_by_unit(offers: DataFrame, official_mall: F.Column) -> DataFrame:
    """Per product that official malls sell: their lowest price for a unit, the lowest of the other malls, percent under it.

    Products without an official offer are left out; those without another offer have no percentage.
    """
    unit = F.col("price") / F.col("qty")
    own, rest = F.when(official_mall, unit), F.when(~official_mall, unit)
    other = F.min(F.when(~official_mall, F.struct(unit.alias("unit"), F.col("mall"))))
    out = offers.groupBy("product_uid").agg(F.min(own).alias("o"), F.count_distinct(F.when(official_mall, F.col("mall"))).alias("n_official"), F.min(rest).alias("u"), other["mall"].alias("lowest_mall")).where("o is not null")
    pct = S.percent_below("u", "o")
    return out.select("product_uid", F.bround("o", 0).cast("bigint").alias("official_unit"), "n_official", F.bround("u", 0).cast("bigint").alias("lowest_unit"), "lowest_mall", pct.alias("undercut_pct"), S.severity(pct).alias("severity"))


def seller_footprint(offers: DataFrame) -> DataFrame:
    """Per mall: products, listings, mean discount where it is under the official price, whether it sells grey goods."""
    below = F.when(F.col("price") < F.col("official_price"), (F.col("official_price") - F.col("price")) * 100.0 / F.col("official_price"))
    return offers.groupBy("mall").agg(
        F.count_distinct("product_uid").alias("n_products"), F.count("*").alias("n_listings"), F.count(below).alias("n_below"), F.bround(F.avg(F.round(below, 6).cast("decimal(20,6)")).cast("double"), 2).alias("mean_discount"),
        F.bool_or(F.col("product_type").isin(*USED_TYPES)).alias("grey"),
    )


def offenders(footprint: DataFrame, k: int = 20) -> DataFrame:
    """The malls with most listings under the official price, then the larger mean discount, then by name."""
    top = footprint.orderBy(F.desc("n_below"), F.desc_nulls_last("mean_discount"), "mall").limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n_below"), F.desc_nulls_last("mean_discount"), "mall")))


def dossier(offers: DataFrame, business: F.Column) -> DataFrame:
    """Per business: storefronts, products, listings, mean discount, grey flag, categories."""
    below = F.when(F.col("price") < F.col("official_price"), (F.col("official_price") - F.col("price")) * 100.0 / F.col("official_price"))
    return offers.groupBy(business.alias("business")).agg(
        F.count_distinct("mall").alias("n_storefronts"), F.count_distinct("product_uid").alias("n_products"), F.count("*").alias("n_listings"), F.bround(F.avg(F.round(below, 6).cast("decimal(20,6)")).cast("double"), 2).alias("mean_discount"),
        F.bool_or(F.col("product_type").isin(*USED_TYPES)).alias("any_used"), F.array_join(F.sort_array(F.collect_set("category")), "|").alias("categories"),
    )


def exposure(offers: DataFrame, accessible: F.Column) -> DataFrame:
    """Sum over products of (official - lowest), over accessible malls (floor) and over all malls (ceiling)."""
    per = offers.groupBy("product_uid").agg(F.min("official_price").alias("o"), F.min("price").alias("lo"), F.min(F.when(accessible, F.col("price"))).alias("lo_a"))
    gap = lambda c: F.sum(F.greatest(F.col("o") - F.col(c), F.lit(0)))
    return per.agg(gap("lo_a").alias("floor_exposure"), gap("lo").alias("ceiling_exposure"), F.count("*").alias("n"))


def violations(offers: DataFrame) -> DataFrame:
    """Listings with their violation class: grey (used type), false-authentic (double the official price), undercut."""
    rule = F.when(F.col("product_type").isin(*USED_TYPES), "grey").when(F.col("price") > F.col("official_price") * 2, "false_authentic").when(F.col("price") < F.col("official_price"), "undercut").otherwise("none")
    return offers.withColumn("violation", rule).withColumn("below_pct", S.percent_below("price", "official_price"))


def violation_report(offers: DataFrame) -> DataFrame:
    v = violations(offers)
    rank = F.when(F.col("violation") == "grey", 3).when(F.col("violation") == "false_authentic", 2).when(F.col("violation") == "undercut", 1).otherwise(0)
    return v.groupBy("product_uid").agg(F.max(rank).alias("severity"), F.count_if(F.col("violation") != "none").alias("n_violations"), F.max("below_pct").alias("worst_pct"))


def violation_totals(offers: DataFrame) -> DataFrame:
    """One row: listings, violating ones by class, products and malls concerned, the deepest discount."""
    v, bad = violations(offers), F.col("violation") != "none"
    by = [F.count_if(F.col("violation") == c).alias(c) for c in ("grey", "false_authentic", "undercut")]
    return v.agg(F.count("*").alias("listings"), *by, F.count_distinct(F.when(bad, F.col("product_uid"))).alias("products"), F.count_distinct(F.when(bad, F.col("mall"))).alias("malls"), F.max("below_pct").alias("worst_pct"))


def peer_position(offers: DataFrame, points: DataFrame) -> DataFrame:
    """A product among its category: rank by lowest price, and its weaknesses and dimensions against the category's mean.

    points: product_uid, weak (boolean), dim. Products without points count as 0.
    """
    low = offers.groupBy("category", "product_uid").agg(F.min("price").alias("price"))
    p = points.groupBy("product_uid").agg(F.count_if("weak").alias("weak"), F.count_distinct("dim").alias("dims"))
    j = low.join(p, "product_uid", "left").fillna(0, ["weak", "dims"])
    mean = j.groupBy("category").agg((F.sum("weak") / F.count("*")).alias("m_weak"), (F.sum("dims") / F.count("*")).alias("m_dims"))
    rank = F.rank().over(Window.partitionBy("category").orderBy("price"))
    return j.withColumn("price_rank", rank).join(mean, "category").select("category", "product_uid", "price_rank", F.bround(F.col("weak") - F.col("m_weak"), 3).alias("weak_vs_peers"), F.bround(F.col("dims") - F.col("m_dims"), 3).alias("dims_vs_peers"))


def low_malls(offers: DataFrame, k: int = 12) -> DataFrame:
    """How often each mall has the lowest price of a product; the first k by that, then by name."""
    return price_ladder(offers).groupBy(F.col("cheapest_mall").alias("mall")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mall").limit(k)


def histogram(df: DataFrame, value: str, edges: tuple[int, ...] = HISTOGRAM_EDGES) -> DataFrame:
    """Counts between the edges; the last bucket is open."""
    bucket = F.lit(None).cast("int")
    for i, e in enumerate(edges):
        bucket = F.when(F.col(value) >= e, F.lit(i)) if i == 0 else F.when(F.col(value) >= e, F.lit(i)).otherwise(bucket)
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def cheapest_per_mall(offers: DataFrame) -> DataFrame:
    """The cheapest offer of each mall for a product, and the mall's place among the product's malls."""
    one = Window.partitionBy("product_uid", "mall").orderBy("price", "day", "qty", "product_type")
    low = offers.withColumn("r", F.row_number().over(one)).where("r = 1")
    return low.withColumn("mall_rank", F.row_number().over(Window.partitionBy("product_uid").orderBy("price", "mall"))).select("product_uid", "mall", "price", "mall_rank")


def headline_offer(offers: DataFrame, major: F.Column) -> DataFrame:
    """One offer per product: major malls first, then the lowest price, then the mall's name."""
    w = Window.partitionBy("product_uid").orderBy(F.desc("major"), "price", "mall", "day", "qty")
    return offers.withColumn("major", major).withColumn("r", F.row_number().over(w)).where("r = 1").select("product_uid", "mall", "price", "major")


def ladder_position(offers: DataFrame) -> DataFrame:
    """Where a product's lowest price stands between those of its category, 0 to 100 percent."""
    low = offers.groupBy("category", "product_uid").agg(F.min("price").alias("price"))
    w = Window.partitionBy("category")
    lo, hi = F.min("price").over(w), F.max("price").over(w)
    return low.select("category", "product_uid", "price", F.bround(F.coalesce(F.try_divide((F.col("price") - lo) * 100.0, hi - lo), F.lit(0.0)), 1).alias("position_pct"))


def price_trend(days: DataFrame) -> DataFrame:
    """First, last, lowest and highest daily minimum, and the change from first to last in percent."""
    out = days.groupBy("product_uid").agg(F.min_by("min_price", "day").alias("first"), F.max_by("min_price", "day").alias("last"), F.min("min_price").alias("low"), F.max("min_price").alias("high"), F.count("*").alias("n_days"))
    return out.withColumn("change_pct", F.bround(F.try_divide((F.col("last") - F.col("first")) * 100.0, F.col("first")), 1))


def snapshot_changes(days: DataFrame) -> DataFrame:
    """Each day's minimum beside the one before it, where it changed; the first day has none."""
    w = Window.partitionBy("product_uid").orderBy("day")
    out = days.withColumn("before", F.lag("min_price").over(w)).withColumn("gap", F.datediff("day", F.lag("day").over(w)))
    return out.where("before is not null and before <> min_price").select("product_uid", "day", "before", "min_price", (F.col("min_price") - F.col("before")).alias("delta"), "gap")


def daily_velocity(days: DataFrame, value: str) -> DataFrame:
    """(now - before) / days between, at least one; null on the first."""
    w = Window.partitionBy("product_uid").orderBy("day")
    gap = F.greatest(F.lit(1), F.datediff("day", F.lag("day").over(w)))
    return days.withColumn("velocity", F.bround((F.col(value) - F.lag(value).over(w)) / gap, 3))


def peer_rank(offers: DataFrame) -> DataFrame:
    """Rank of a product's lowest price in its category, beside the category's mean."""
    low = offers.groupBy("category", "product_uid").agg(F.min("price").alias("price"))
    w = Window.partitionBy("category")
    return low.select("category", "product_uid", "price", F.rank().over(w.orderBy("price")).alias("price_rank"), F.bround(F.sum("price").over(w) / F.count("*").over(w), 2).alias("peer_mean"))


def panel_rollup(offers: DataFrame) -> DataFrame:
    return offers.groupBy("brand").agg(
        F.countDistinct("product_uid").alias("n_catalogs"), F.countDistinct(F.when(F.col("price") > 0, F.col("product_uid"))).alias("n_priced"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.countDistinct("mall").alias("n_malls")
    )


def upper_median(df: DataFrame, value: str) -> DataFrame:
    """The value in place n div 2 + 1 of the sorted rows: the discrete median from above."""
    return df.agg(F.expr(f"percentile_disc(0.5) within group (order by {value} desc)").alias("mid"))


def demand_priority(offers: DataFrame) -> DataFrame:
    """sqrt(demand / largest demand) * undercut, and the quadrant by the upper medians of demand and undercut."""
    per = official_undercut(offers).select("product_uid", F.col("n").alias("demand"), F.greatest(F.coalesce("undercut_pct", F.lit(0.0)), F.lit(0.0)).alias("gap"))
    most = per.agg(F.max("demand").alias("most"))
    d, g = upper_median(per, "demand").withColumnRenamed("mid", "d_mid"), upper_median(per, "gap").withColumnRenamed("mid", "g_mid")
    out = per.join(F.broadcast(most)).join(F.broadcast(d)).join(F.broadcast(g))
    return out.select("product_uid", "demand", "gap", F.bround(F.sqrt(F.col("demand") / F.col("most")) * F.col("gap"), 4).alias("priority"), S.quadrant(F.col("demand"), F.col("gap"), F.col("d_mid"), F.col("g_mid")).alias("quadrant"))


def anomalies(offers: DataFrame, spread: float = 300.0) -> DataFrame:
    """Products whose spread of prices is extreme."""
    return price_ladder(offers).where(F.col("spread_pct") > spread).select("product_uid", "n_offers", "n_malls", "min_price", "max_price", "spread_pct")


def offers_hygiene(offers: DataFrame) -> DataFrame:
    return offers.agg(F.count("*").alias("n"), F.count_if(F.col("price") <= 0).alias("n_unpriced"), F.count_if(F.col("qty") > 40).alias("n_large_packs"), F.count_if(F.col("product_type").isin(*USED_TYPES)).alias("n_used"))


def market_official(offers: DataFrame, official: DataFrame) -> DataFrame:
    """Market offers beside the official row of the same style code, with the severity of the gap."""
    out = offers.join(official, "product_uid", "left").withColumn("below_pct", S.percent_below("price", "list_price"))
    return out.withColumn("severity", F.when(F.col("list_price").isNull(), "unknown").otherwise(S.severity("below_pct")))


def opinion_mismatch(offers: DataFrame, opinions: DataFrame, least: int = 5, dear: float = 2.5, cheap: float = 0.4) -> DataFrame:
    """Per category: offers of products that are liked or blamed for their price, and those whose unit price says otherwise.

    opinions: product_uid, opinion (pos, neg or null) for each point; a product is liked with more pos than neg. Dear is
    over 2.5 times the category's median unit price, cheap under 0.4 times; categories of under five offers are left out.
    """
    o = opinions.groupBy("product_uid").agg(F.count_if(F.col("opinion") == "pos").alias("pos"), F.count_if(F.col("opinion") == "neg").alias("neg"))
    u = offers.select("product_uid", "category", (F.col("price") / F.col("qty")).alias("unit"))
    mid = u.groupBy("category").agg(F.percentile("unit", F.lit(0.5)).alias("mid"), F.count("*").alias("n")).where(F.col("n") >= least)
    liked, blamed = F.col("pos") > F.col("neg"), F.col("neg") > F.col("pos")
    return u.join(mid, "category").join(o, "product_uid").groupBy("category").agg(
        F.count("*").alias("offers"), F.count_if(liked).alias("positive"), F.count_if(blamed).alias("negative"),
        F.count_if(liked & (F.col("unit") > F.col("mid") * dear)).alias("dear_but_liked"), F.count_if(blamed & (F.col("unit") < F.col("mid") * cheap)).alias("cheap_but_blamed"),
    )


def slim_shop(offers: DataFrame, title_length: int = 30, malls: int = 3) -> DataFrame:
    """Offers by brand and model (the beginning of the title): prices, malls, categories, SKUs, and the malls with most offers."""
    o = offers.withColumn("model", F.substring("title", 1, title_length))
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), "|")
    out = o.groupBy("brand", "model").agg(F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"), F.count_distinct("mall").alias("n_malls"), listed("category").alias("categories"), listed("product_uid").alias("skus"))
    top = top_values(o, ["brand", "model"], "mall", malls).groupBy("brand", "model").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "mall"))), lambda x: x["mall"]), "|").alias("top_malls"))
    return out.join(top, ["brand", "model"])
