"""Queries over mall offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.operators import prices as P
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_offer, v_price_day

LADDER = """SELECT product_uid, count(*) AS n_offers, count(DISTINCT mall) AS n_malls, min(price) AS min_price, max(price) AS max_price, CAST(floor(quantile_cont(price, 0.5)) AS BIGINT) AS median_price,
 count(*) FILTER (product_type IN (4,5,6)) AS n_used, min(struct_pack(price := price, mall := mall)).mall AS cheapest_mall,
 round_even((max(price) - min(price)) * 100.0::DOUBLE / nullif(min(price), 0), 1) AS spread_pct FROM v_offer GROUP BY product_uid"""


@query("ag1_price_ladder", LADDER)
def ag1(spark, sf):
    return P.price_ladder(v_offer(spark, sf))


@query("tk2_report_order", f"SELECT * FROM ({LADDER}) ORDER BY n_malls > 1 DESC, n_malls DESC, spread_pct DESC, product_uid LIMIT 50")
def tk2(spark, sf):
    return P.price_ladder(v_offer(spark, sf)).orderBy(F.desc(F.col("n_malls") > 1), F.desc("n_malls"), F.desc("spread_pct"), "product_uid").limit(50)


@query("tk7_report_page", f"SELECT * FROM (SELECT *, row_number() OVER (ORDER BY spread_pct DESC, product_uid) AS place FROM ({LADDER})) WHERE place BETWEEN 21 AND 40")
def tk7(spark, sf):
    ordered = P.price_ladder(v_offer(spark, sf)).orderBy(F.desc("spread_pct"), "product_uid").limit(40)
    return ordered.withColumn("place", F.expr("row_number() over (order by spread_pct desc, product_uid)").cast("bigint")).where("place between 21 and 40")


@query("jn2_price_ladder_view", """SELECT o.product_uid, p.p_name AS keyword, count(*) AS n_offers, count(DISTINCT mall) AS n_malls, min(price) AS min_price, max(price) AS max_price,
 CAST(round(quantile_cont(price, 0.5)) AS BIGINT) AS median_price FROM v_offer o JOIN part p ON o.product_uid = concat('P', CAST(p.p_partkey AS VARCHAR)) GROUP BY o.product_uid, p.p_name""")
def jn2(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_uid"), F.col("p_name").alias("keyword"))
    return v_offer(spark, sf).join(p, "product_uid").groupBy("product_uid", "keyword").agg(
        F.count("*").alias("n_offers"), F.countDistinct("mall").alias("n_malls"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.round(F.percentile("price", F.lit(0.5)), 0).cast("bigint").alias("median_price"))


@query("flt1_real_offers", "SELECT product_uid, mall, price, concat_ws(' > ', brand, category) AS path, product_type IN (4,5,6) AS used, day FROM v_offer WHERE price > 0 AND trim(mall) <> ''")
def flt1(spark, sf):
    return P.real_offers(v_offer(spark, sf)).select("product_uid", "mall", "price", "path", "used", "day")


@query("flt2_sane_prices", "SELECT count(*) FILTER (price BETWEEN 95000 AND 150000) AS kept, count(*) FILTER (NOT price BETWEEN 95000 AND 150000) AS dropped FROM v_offer")
def flt2(spark, sf):
    return P.sane_price_counts(v_offer(spark, sf), 95_000, 150_000)


CLEAN = """WITH a AS (SELECT * FROM v_offer),
b AS (SELECT * FROM (SELECT *, qty = 1 AS ok FROM a) QUALIFY ok OR NOT max(ok::INT) OVER (PARTITION BY product_uid)::BOOL),
c AS (SELECT * FROM (SELECT * EXCLUDE (ok), product_type NOT IN (4,5,6) AS ok FROM b) QUALIFY ok OR NOT max(ok::INT) OVER (PARTITION BY product_uid)::BOOL),
d0 AS (SELECT * EXCLUDE (ok), quantile_cont(price, 0.5) OVER (PARTITION BY product_uid) AS m, count(*) OVER (PARTITION BY product_uid) AS n FROM c),
d AS (SELECT * FROM (SELECT *, n < 3 OR (price <= m * {ratio} AND price * {ratio} >= m) AS ok FROM d0) QUALIFY ok OR NOT max(ok::INT) OVER (PARTITION BY product_uid)::BOOL),
e0 AS (SELECT * EXCLUDE (ok, m, n), quantile_cont(price, 0.05) OVER (PARTITION BY product_uid) AS lo, quantile_cont(price, 0.95) OVER (PARTITION BY product_uid) AS hi, count(*) OVER (PARTITION BY product_uid) AS n FROM d),
e AS (SELECT * FROM (SELECT *, n < 5 OR price BETWEEN lo AND hi AS ok FROM e0) QUALIFY ok OR NOT max(ok::INT) OVER (PARTITION BY product_uid)::BOOL),
f0 AS (SELECT * EXCLUDE (ok, lo, hi, n), row_number() OVER (PARTITION BY product_uid ORDER BY price, mall, day, title, official_price) - 1 AS r, count(*) OVER (PARTITION BY product_uid) AS n FROM e),
f1 AS (SELECT *, max(price) FILTER (r = n // 4) OVER (PARTITION BY product_uid) AS q1, max(price) FILTER (r = 3 * n // 4) OVER (PARTITION BY product_uid) AS q3 FROM f0),
f AS (SELECT * FROM (SELECT *, n < 4 OR price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM f1) QUALIFY ok OR NOT max(ok::INT) OVER (PARTITION BY product_uid)::BOOL)
SELECT product_uid, mall, price, qty, product_type, day FROM f"""


@query("flt3_clean_offers", CLEAN.format(ratio="1.2"))
def flt3(spark, sf):
    out = P.clean_offers(v_offer(spark, sf).withColumn("wanted", F.lit(1)), wanted_qty="wanted", ratio=1.2, trim=(0.05, 0.95), iqr=1.5)
    return out.select("product_uid", "mall", "price", "qty", "product_type", "day")


@query("ag2_price_distribution", "SELECT category, count(*) AS n, CAST(floor(sum(price)::DOUBLE / count(price)) AS BIGINT) AS avg_price, CAST(round_even(quantile_cont(price, 0.25), 0) AS BIGINT) AS p25, CAST(round_even(quantile_cont(price, 0.5), 0) AS BIGINT) AS p50, CAST(round_even(quantile_cont(price, 0.75), 0) AS BIGINT) AS p75 FROM v_offer GROUP BY category")
def ag2(spark, sf):
    return P.price_distribution(v_offer(spark, sf), "category")


@query("ag3_dominant_model_prices", """WITH t AS (SELECT category, brand AS top_model FROM (SELECT category, brand, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, brand) AS r FROM v_offer GROUP BY category, brand) WHERE r = 1)
SELECT o.category, top_model, count(*) FILTER (brand = top_model) AS n_top, min(price) FILTER (brand = top_model) AS top_min, max(price) FILTER (brand = top_model) AS top_max, count(*) AS n_all, min(price) AS all_min, max(price) AS all_max FROM v_offer o JOIN t ON o.category = t.category GROUP BY o.category, top_model""")
def ag3(spark, sf):
    return P.dominant_model_prices(v_offer(spark, sf), "category", "brand")


@query("tk1_top_malls", "SELECT * FROM (SELECT category, mall, count(*) AS n, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, mall) AS rank FROM v_offer GROUP BY category, mall) WHERE rank <= 5")
def tk1(spark, sf):
    return P.top_values(v_offer(spark, sf), ["category"], "mall", 5)


@query("ag9_category_statistics", """WITH s AS (SELECT category, quantile_cont(sp, 0.5) AS ms, count(*) AS n_products FROM (SELECT category, product_uid, round_even((max(price) - min(price)) * 100.0::DOUBLE / min(price), 1) AS sp FROM v_offer GROUP BY category, product_uid) GROUP BY category)
SELECT o.category, count(*) AS n, CAST(floor(quantile_cont(price, 0.5)) AS BIGINT) AS median_price, round_even(quantile_cont(price::DOUBLE / qty, 0.5), 2) AS median_unit, round_even(any_value(ms), 2) AS median_spread, any_value(n_products) AS n_products FROM v_offer o JOIN s ON s.category = o.category GROUP BY o.category""")
def ag9(spark, sf):
    return P.category_statistics(v_offer(spark, sf))


INDEX = """low AS (SELECT category, product_uid, mall, min(price) AS low FROM v_offer GROUP BY ALL),
mid AS (SELECT *, quantile_cont(low, 0.5) OVER (PARTITION BY product_uid) AS mid, count(*) OVER (PARTITION BY product_uid) AS n FROM low),
idx AS (SELECT mall, category, count(*) AS n, round_even((sum(low / mid) / count(*) - 1) * 100, 1) AS index_pct FROM mid WHERE n >= 2 AND mid > 0 GROUP BY mall, category HAVING count(*) >= {least}),
tm AS (SELECT mall FROM idx GROUP BY mall ORDER BY sum(n) DESC, mall LIMIT 14), tc AS (SELECT category FROM idx GROUP BY category ORDER BY sum(n) DESC, category LIMIT 10)"""


@query("ag10_mall_price_index", "WITH " + INDEX.format(least=3) + " SELECT mall, category, n, index_pct FROM idx WHERE mall IN (FROM tm) AND category IN (FROM tc)")
def ag10(spark, sf):
    return P.mall_price_index(v_offer(spark, sf), min_listings=3).select("mall", "category", "n", "index_pct")


@query("ag13_price_position", f"WITH l AS (SELECT product_uid, min_price, max_price, cheapest_mall, n_malls, spread_pct FROM ({LADDER})), d AS (SELECT product_uid, min(struct_pack(p := -price, m := mall)).m AS dearest_mall, min(category) AS category FROM v_offer GROUP BY product_uid), j AS (SELECT * FROM l JOIN d USING (product_uid)) SELECT j.*, round_even((SELECT CAST(sum(CAST(k.spread_pct AS DECIMAL(20,1))) AS DOUBLE) / count(k.spread_pct) FROM j k WHERE k.category = j.category), 2) AS category_spread FROM j")
def ag13(spark, sf):
    return P.price_position(v_offer(spark, sf))


@query("ag14_mall_coverage", "SELECT mall, count(*) AS n_listings, count(DISTINCT product_uid) AS n_products, min(price) AS min_price, max(price) AS max_price, CAST(min(round_even(price::DOUBLE / qty, 0)) AS BIGINT) AS min_unit, CAST(max(round_even(price::DOUBLE / qty, 0)) AS BIGINT) AS max_unit, starts_with(mall, 'Supplier#00000001') AS official FROM v_offer GROUP BY mall")
def ag14(spark, sf):
    return P.mall_coverage(v_offer(spark, sf), "Supplier#00000001")


UNDERCUT = """SELECT *, CASE WHEN undercut_pct >= 40 THEN 'serious' WHEN undercut_pct >= 20 THEN 'caution' WHEN undercut_pct > 0 THEN 'slight' ELSE 'none' END AS severity FROM (
SELECT product_uid, min(official_price) AS official, min(price) AS lowest, min(struct_pack(price := price, mall := mall)).mall AS lowest_mall, count(*) AS n, round_even((min(official_price) - min(price)) * 100.0::DOUBLE / nullif(min(official_price), 0), 1) AS undercut_pct FROM v_offer GROUP BY product_uid)"""


@query("ag15_official_undercut", UNDERCUT)
def ag15(spark, sf):
    return P.official_undercut(v_offer(spark, sf))


_OWN = "starts_with(mall, 'Supplier#00000001')"


@query("ag15_undercut_by_unit", f"""SELECT product_uid, CAST(round_even(o, 0) AS BIGINT) AS official_unit, n_official, CAST(round_even(u, 0) AS BIGINT) AS lowest_unit, lowest_mall, undercut_pct, CASE WHEN undercut_pct >= 40 THEN 'serious' WHEN undercut_pct >= 20 THEN 'caution' WHEN undercut_pct > 0 THEN 'slight' ELSE 'none' END AS severity FROM (SELECT *, round_even((o - u) * 100.0::DOUBLE / nullif(o, 0), 1) AS undercut_pct FROM (
SELECT product_uid, min(price::DOUBLE / qty) FILTER ({_OWN}) AS o, count(DISTINCT mall) FILTER ({_OWN}) AS n_official, min(price::DOUBLE / qty) FILTER (NOT {_OWN}) AS u, (min(struct_pack(unit := price::DOUBLE / qty, mall := mall)) FILTER (NOT {_OWN})).mall AS lowest_mall FROM v_offer GROUP BY product_uid) WHERE o IS NOT NULL)""")
def ag15_unit(spark, sf):
    return P.undercut_by_unit(v_offer(spark, sf), F.startswith("mall", F.lit("Supplier#00000001")))


FOOTPRINT = """SELECT mall, count(DISTINCT product_uid) AS n_products, count(*) AS n_listings, count(*) FILTER (price < official_price) AS n_below, round_even(sum(CAST(round((official_price - price) * 100.0::DOUBLE / official_price, 6) AS DECIMAL(20,6))) FILTER (price < official_price)::DOUBLE / nullif(count(*) FILTER (price < official_price), 0), 2) AS mean_discount, bool_or(product_type IN (4,5,6)) AS grey FROM v_offer GROUP BY mall"""


@query("ag16_seller_footprint", FOOTPRINT)
def ag16(spark, sf):
    return P.seller_footprint(v_offer(spark, sf))


@query("ag16_offenders", f"SELECT *, row_number() OVER (ORDER BY n_below DESC, mean_discount DESC NULLS LAST, mall) AS place FROM ({FOOTPRINT}) ORDER BY place LIMIT 20")
def ag16_offenders(spark, sf):
    return P.offenders(P.seller_footprint(v_offer(spark, sf)))


@query("ag17_exposure", """SELECT CAST(sum(greatest(o - lo_a, 0)) AS BIGINT) AS floor_exposure, CAST(sum(greatest(o - lo, 0)) AS BIGINT) AS ceiling_exposure, count(*) AS n FROM (SELECT product_uid, min(official_price) AS o, min(price) AS lo, coalesce(min(price) FILTER (qty <= 10), min(official_price)) AS lo_a FROM v_offer GROUP BY product_uid)""")
def ag17(spark, sf):
    return P.exposure(v_offer(spark, sf), F.col("qty") <= 10)


@query("ag18_violations", """SELECT product_uid, max(CASE v WHEN 'grey' THEN 3 WHEN 'false_authentic' THEN 2 WHEN 'undercut' THEN 1 ELSE 0 END) AS severity, count(*) FILTER (v <> 'none') AS n_violations, max(b) AS worst_pct FROM (
SELECT product_uid, CASE WHEN product_type IN (4,5,6) THEN 'grey' WHEN price > official_price * 2 THEN 'false_authentic' WHEN price < official_price THEN 'undercut' ELSE 'none' END AS v, round_even((official_price - price) * 100.0::DOUBLE / official_price, 1) AS b FROM v_offer) GROUP BY product_uid""")
def ag18(spark, sf):
    return P.violation_report(v_offer(spark, sf))


@query("ag18_violation_totals", """SELECT count(*) AS listings, count(*) FILTER (v = 'grey') AS grey, count(*) FILTER (v = 'false_authentic') AS false_authentic, count(*) FILTER (v = 'undercut') AS undercut, count(DISTINCT product_uid) FILTER (v <> 'none') AS products, count(DISTINCT mall) FILTER (v <> 'none') AS malls, max(b) AS worst_pct FROM (
SELECT product_uid, mall, CASE WHEN product_type IN (4,5,6) THEN 'grey' WHEN price > official_price * 2 THEN 'false_authentic' WHEN price < official_price THEN 'undercut' ELSE 'none' END AS v, round_even((official_price - price) * 100.0::DOUBLE / official_price, 1) AS b FROM v_offer)""")
def ag18_totals(spark, sf):
    return P.violation_totals(v_offer(spark, sf))


@query("ag19_business_dossier", """SELECT substr(mall, 1, 17) AS business, count(DISTINCT mall) AS n_storefronts, count(DISTINCT product_uid) AS n_products, count(*) AS n_listings, round_even(sum(CAST(round((official_price - price) * 100.0::DOUBLE / official_price, 6) AS DECIMAL(20,6))) FILTER (price < official_price)::DOUBLE / nullif(count(*) FILTER (price < official_price), 0), 2) AS mean_discount, bool_or(product_type IN (4,5,6)) AS any_used, string_agg(DISTINCT category, '|' ORDER BY category) AS categories FROM v_offer GROUP BY 1""")
def ag19(spark, sf):
    return P.dossier(v_offer(spark, sf), F.substring("mall", 1, 17))


@query("wn10_peer_position", """WITH low AS (SELECT category, product_uid, min(price) AS price FROM v_offer GROUP BY ALL), p AS (SELECT concat('P', CAST(user_id AS VARCHAR)) AS product_uid, count(*) FILTER (event_type = 'error') AS weak, count(DISTINCT event_type) AS dims FROM events GROUP BY user_id),
j AS (SELECT low.*, coalesce(weak, 0) AS weak, coalesce(dims, 0) AS dims FROM low LEFT JOIN p USING (product_uid)), m AS (SELECT category, sum(weak)::DOUBLE / count(*) AS mw, sum(dims)::DOUBLE / count(*) AS md FROM j GROUP BY category)
SELECT category, product_uid, rank() OVER (PARTITION BY category ORDER BY price) AS price_rank, round_even(weak - mw, 3) AS weak_vs_peers, round_even(dims - md, 3) AS dims_vs_peers FROM j JOIN m USING (category)""")
def wn10_peers(spark, sf):
    e = table(spark, sf, "events").select(F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("product_uid"), (F.col("event_type") == "error").alias("weak"), F.col("event_type").alias("dim"))
    return P.peer_position(v_offer(spark, sf), e)


@query("dm4_low_malls", f"SELECT cheapest_mall AS mall, count(*) AS n FROM ({LADDER}) GROUP BY cheapest_mall ORDER BY n DESC, mall LIMIT 12")
def dm4_low_malls(spark, sf):
    return P.low_malls(v_offer(spark, sf))


@query("ag22_price_histogram", "SELECT CASE WHEN x >= 200000 THEN 8 WHEN x >= 100000 THEN 7 WHEN x >= 50000 THEN 6 WHEN x >= 30000 THEN 5 WHEN x >= 10000 THEN 4 WHEN x >= 5000 THEN 3 WHEN x >= 3000 THEN 2 WHEN x >= 1000 THEN 1 WHEN x >= 0 THEN 0 END AS bucket, count(*) AS n FROM (SELECT official_price AS x FROM v_offer) GROUP BY 1")
def ag22(spark, sf):
    return P.histogram(v_offer(spark, sf), "official_price")


@query("ag30_panel_rollup", "SELECT brand, count(DISTINCT product_uid) AS n_catalogs, count(DISTINCT product_uid) FILTER (price > 0) AS n_priced, min(price) AS min_price, max(price) AS max_price, count(DISTINCT mall) AS n_malls FROM v_offer GROUP BY brand")
def ag30(spark, sf):
    return P.panel_rollup(v_offer(spark, sf))


@query("wn3_group_medians", "SELECT product_uid, mall, price, day, quantile_cont(price, 0.5) OVER (PARTITION BY product_uid) AS median FROM v_offer")
def wn3(spark, sf):
    return v_offer(spark, sf).select("product_uid", "mall", "price", "day", F.expr("percentile(price, 0.5) over (partition by product_uid)").alias("median"))


@query("wn4_daily_velocity", "SELECT product_uid, day, n, min_price, round_even((min_price - lag(min_price) OVER w)::DOUBLE / greatest(1, day - lag(day) OVER w), 3) AS velocity FROM v_price_day WINDOW w AS (PARTITION BY product_uid ORDER BY day)")
def wn4(spark, sf):
    return P.daily_velocity(v_price_day(spark, sf), "min_price")


@query("wn5_price_trend", "SELECT *, round_even((last - first) * 100.0::DOUBLE / first, 1) AS change_pct FROM (SELECT product_uid, arg_min(min_price, day) AS first, arg_max(min_price, day) AS last, min(min_price) AS low, max(min_price) AS high, count(*) AS n_days FROM v_price_day GROUP BY product_uid)")
def wn5(spark, sf):
    return P.price_trend(v_price_day(spark, sf))


@query("jn16_snapshot_changes", "SELECT product_uid, day, before, min_price, min_price - before AS delta, gap FROM (SELECT *, lag(min_price) OVER w AS before, day - lag(day) OVER w AS gap FROM v_price_day WINDOW w AS (PARTITION BY product_uid ORDER BY day)) WHERE before IS NOT NULL AND before <> min_price")
def jn16(spark, sf):
    return P.snapshot_changes(v_price_day(spark, sf))


@query("wn6_cheapest_per_mall", "SELECT product_uid, mall, price, row_number() OVER (PARTITION BY product_uid ORDER BY price, mall) AS mall_rank FROM (SELECT product_uid, mall, min(price) AS price FROM v_offer GROUP BY product_uid, mall)")
def wn6(spark, sf):
    return P.cheapest_per_mall(v_offer(spark, sf))


@query("wn7_headline_offer", "SELECT product_uid, mall, price, major FROM (SELECT *, mall LIKE '%1' AS major FROM v_offer) QUALIFY row_number() OVER (PARTITION BY product_uid ORDER BY major DESC, price, mall, day, qty) = 1")
def wn7(spark, sf):
    return P.headline_offer(v_offer(spark, sf), F.col("mall").like("%1"))


@query("wn8_ladder_position", "SELECT category, product_uid, price, round_even(coalesce((price - min(price) OVER w) * 100.0::DOUBLE / nullif(max(price) OVER w - min(price) OVER w, 0), 0), 1) AS position_pct FROM (SELECT category, product_uid, min(price) AS price FROM v_offer GROUP BY ALL) WINDOW w AS (PARTITION BY category)")
def wn8(spark, sf):
    return P.ladder_position(v_offer(spark, sf))


@query("wn10_peer_rank", "SELECT category, product_uid, price, rank() OVER (PARTITION BY category ORDER BY price) AS price_rank, round_even(sum(price) OVER (PARTITION BY category)::DOUBLE / count(*) OVER (PARTITION BY category), 2) AS peer_mean FROM (SELECT category, product_uid, min(price) AS price FROM v_offer GROUP BY ALL)")
def wn10(spark, sf):
    return P.peer_rank(v_offer(spark, sf))


@query("dm1_demand_priority", f"""WITH p AS (SELECT product_uid, n AS demand, greatest(coalesce(undercut_pct, 0.0), 0.0) AS gap FROM ({UNDERCUT})),
m AS (SELECT max(demand) AS most FROM p), dm AS (SELECT demand AS d_mid FROM p QUALIFY row_number() OVER (ORDER BY demand) = count(*) OVER () // 2 + 1), gm AS (SELECT gap AS g_mid FROM p QUALIFY row_number() OVER (ORDER BY gap) = count(*) OVER () // 2 + 1)
SELECT product_uid, demand, gap, round_even(sqrt(demand::DOUBLE / most) * gap, 4) AS priority, CASE WHEN demand >= d_mid AND gap >= g_mid THEN 'act' WHEN demand >= d_mid THEN 'watch' WHEN gap >= g_mid THEN 'check' ELSE 'rest' END AS quadrant FROM p, m, dm, gm""")
def dm1(spark, sf):
    return P.demand_priority(v_offer(spark, sf))


@query("dm4_price_anomalies", f"SELECT product_uid, n_offers, n_malls, min_price, max_price, spread_pct FROM ({LADDER}) WHERE spread_pct > 30")
def dm4(spark, sf):
    return P.anomalies(v_offer(spark, sf), spread=30.0)


@query("dm4_offers_hygiene", "SELECT count(*) AS n, count(*) FILTER (price <= 0) AS n_unpriced, count(*) FILTER (qty > 40) AS n_large_packs, count(*) FILTER (product_type IN (4,5,6)) AS n_used FROM v_offer")
def dm4b(spark, sf):
    return P.offers_hygiene(v_offer(spark, sf))


@query("jn3_exact_key_facts", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, p_brand, p_size FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def jn3(spark, sf):
    facts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(facts, F.expr("l_partkey = p_partkey"), "left").drop("p_partkey")


@query("jn4_market_official", """SELECT o.product_uid, mall, price, list_price, round_even((list_price - price) * 100.0::DOUBLE / list_price, 1) + 0.0 AS below_pct, CASE WHEN list_price IS NULL THEN 'unknown' WHEN round_even((list_price - price) * 100.0::DOUBLE / list_price, 1) >= 40 THEN 'serious'
 WHEN round_even((list_price - price) * 100.0::DOUBLE / list_price, 1) >= 20 THEN 'caution' WHEN round_even((list_price - price) * 100.0::DOUBLE / list_price, 1) > 0 THEN 'slight' ELSE 'none' END AS severity FROM v_offer o LEFT JOIN (SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS product_uid, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS list_price FROM part WHERE p_partkey % 3 <> 0) l ON l.product_uid = o.product_uid""")
def jn4(spark, sf):
    official = table(spark, sf, "part").where("p_partkey % 3 <> 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_uid"), F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint").alias("list_price"))
    return P.market_official(v_offer(spark, sf).select("product_uid", "mall", "price"), official)


@query("sc10_bands", "SELECT product_uid, day, round_even((official_price - price) * 100.0::DOUBLE / official_price, 1) AS below_pct, qty FROM v_offer WHERE price < official_price")
def sc10(spark, sf):
    return v_offer(spark, sf).where("price < official_price").select("product_uid", "day", S.percent_below("price", "official_price").alias("below_pct"), "qty")


@query("flt12_major_malls", "SELECT mall, count(*) AS n FROM v_offer WHERE regexp_matches(mall, '(1|7)$') GROUP BY mall")
def flt12(spark, sf):
    return v_offer(spark, sf).where(F.col("mall").rlike("(1|7)$")).groupBy("mall").agg(F.count("*").alias("n"))


@query("src3_listing_scan", "SELECT title, mall, price FROM v_offer WHERE price > 0 GROUP BY title, mall, price")
def src3(spark, sf):
    return v_offer(spark, sf).where("price > 0").select("title", "mall", "price").dropDuplicates(["title", "mall", "price"])


@query("snk8_flat_listing", "SELECT product_uid, mall, price, day, CASE WHEN product_type IN (4,5,6) THEN 'used' ELSE 'new' END AS condition FROM v_offer")
def snk8(spark, sf):
    return v_offer(spark, sf).select("product_uid", "mall", "price", "day", F.when(F.col("product_type").isin(4, 5, 6), "used").otherwise("new").alias("condition"))
