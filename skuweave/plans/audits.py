"""Queries of rules, quantity checks, variant families, opinions, and clean-up of colours, sizes and notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.functions import text as A
from skuweave.operators import family as FM
from skuweave.operators import quality as Q
from skuweave.operators.prices import opinion_mismatch
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_listing, v_offer, v_state


def _rules():
    has = F.col("n_dims") > 0
    return [
        Q.Rule("flag_drift", "low", F.col("has_insight") != has, {"has_insight": has}),
        Q.Rule("attempts", "high", F.col("attempts") > 4, {"attempts": F.lit(0), "status": F.lit("pending")}),
        Q.Rule("missing_status", "low", F.col("status").isNull()),
    ]


@query("qv1_run_summary", "SELECT rule, severity, count(*) AS n, CASE WHEN rule = 'missing_status' THEN 0 ELSE count(*) END AS fixed FROM (SELECT 'flag_drift' AS rule, 'low' AS severity FROM v_state WHERE has_insight <> (n_dims > 0) UNION ALL SELECT 'attempts', 'high' FROM v_state WHERE attempts > 4 UNION ALL SELECT 'missing_status', 'low' FROM v_state WHERE status IS NULL) GROUP BY rule, severity")
def qv1_summary(spark, sf):
    return Q.rule_summary(Q.run_rules(v_state(spark, sf), _rules(), "uid", fix=True)[0])


@query("qv1_second_run", "SELECT uid, 'missing_status' AS rule, 'low' AS severity, false AS fixed FROM v_state WHERE status IS NULL AND attempts <= 4")
def qv1_second(spark, sf):
    """Violations of a second run over the repaired states: only what is reported and never repaired."""
    _, repaired = Q.run_rules(v_state(spark, sf), _rules(), "uid", fix=True)
    return Q.run_rules(repaired, _rules(), "uid")[0]


def _evidence(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.expr("l_partkey = p_partkey"))
    grams = F.when(F.col("l_linenumber") % 4 != 0, F.when((F.col("l_orderkey") + F.col("p_partkey")) % 3 == 0, F.col("p_size") * 10).otherwise(F.col("p_size") * 10 + F.col("p_partkey") % 3))
    return j.select(F.col("p_partkey").alias("uid"), "l_orderkey", "l_linenumber", F.concat_ws(" ", "p_name", F.concat(grams.cast("string"), F.lit("g")), F.concat(F.col("l_linenumber").cast("string"), F.lit("pcs"))).alias("text"))


MODE = """e AS (SELECT p_partkey AS uid, l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 <> 0 THEN CASE WHEN (l_orderkey + p_partkey) % 3 = 0 THEN p_size * 10 ELSE p_size * 10 + p_partkey % 3 END END AS g FROM lineitem JOIN part ON l_partkey = p_partkey),
  c AS (SELECT uid, g, count(*) AS c, min(struct_pack(o := l_orderkey, l := l_linenumber)) AS pos FROM e WHERE g IS NOT NULL GROUP BY uid, g),
  d AS (SELECT uid, g, c, sum(c) OVER (PARTITION BY uid) AS n, row_number() OVER (PARTITION BY uid ORDER BY c DESC, pos) AS k FROM c),
  bad AS (SELECT d.uid, 'mass' AS dim, (p_size * 10)::DOUBLE AS catalog, g::DOUBLE AS evidence, round_even(c::DOUBLE / n, 4) AS share FROM d JOIN part ON p_partkey = d.uid WHERE k = 1 AND c::DOUBLE / n >= 0.5 AND g <> p_size * 10)"""


def _mismatches(spark, sf):
    catalog = table(spark, sf, "part").select(F.col("p_partkey").alias("uid"), (F.col("p_size") * 10).alias("mass"), F.lit(None).cast("double").alias("vol"))
    return Q.quantity_mismatch(catalog, _evidence(spark, sf), "uid", "text", ["l_orderkey", "l_linenumber"])


@query("qv3_quantity_mismatch", f"WITH {MODE} SELECT * FROM bad")
def qv3(spark, sf):
    return _mismatches(spark, sf)


@query("qv3_emptied", f"WITH {MODE} SELECT s.uid, CASE WHEN b.uid IS NULL THEN n_dims ELSE 0 END AS n_dims, b.uid IS NULL AND has_insight AS has_insight, attempts + (b.uid IS NOT NULL)::INT AS attempts, CASE WHEN b.uid IS NOT NULL THEN 'source_mismatch' END AS invalidated FROM v_state s LEFT JOIN (SELECT DISTINCT concat('C', CAST(uid AS VARCHAR)) AS uid FROM bad) b ON b.uid = s.uid")
def qv3_emptied(spark, sf):
    bad = _mismatches(spark, sf).select(F.concat(F.lit("C"), F.col("uid").cast("string")).alias("uid"))
    return Q.emptied(v_state(spark, sf), bad, "uid").drop("status")


OPINION = "SELECT user_id, CASE WHEN regexp_matches(t, '(^|[^a-z])(not|no)([^a-z]|$)') THEN NULL WHEN contains(t, 'cheap') AND NOT contains(t, 'dear') THEN 'pos' WHEN contains(t, 'dear') AND NOT contains(t, 'cheap') THEN 'neg' END AS opinion FROM (SELECT user_id, concat(CASE event_id % 5 WHEN 0 THEN 'not ' ELSE '' END, CASE event_id % 3 WHEN 0 THEN 'cheap' WHEN 1 THEN 'dear' ELSE 'cheap and dear' END, ' ', event_type) AS t FROM events)"


@query(
    "ag33_opinion_mismatch",
    f"""WITH o AS ({OPINION}), p AS (SELECT concat('P', CAST(user_id AS VARCHAR)) AS product_uid, count(*) FILTER (opinion = 'pos') AS pos, count(*) FILTER (opinion = 'neg') AS neg, count(*) AS n FROM o GROUP BY user_id),
  u AS (SELECT product_uid, category, price::DOUBLE / qty AS unit FROM v_offer), m AS (SELECT category, quantile_cont(unit, 0.5) AS mid FROM u GROUP BY category HAVING count(*) >= 5)
  SELECT category, count(*) AS offers, count(*) FILTER (pos > neg) AS positive, count(*) FILTER (neg > pos) AS negative, count(*) FILTER (pos > neg AND unit > 2.5 * mid) AS dear_but_liked, count(*) FILTER (neg > pos AND unit < 0.4 * mid) AS cheap_but_blamed
  FROM u JOIN m USING (category) JOIN p USING (product_uid) GROUP BY category""",
)
def ag33(spark, sf):
    e = table(spark, sf, "events")
    word = F.when(F.col("event_id") % 3 == 0, "cheap").when(F.col("event_id") % 3 == 1, "dear").otherwise("cheap and dear")
    points = e.select(F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("product_uid"), F.concat(F.when(F.col("event_id") % 5 == 0, "not ").otherwise(""), word, F.lit(" "), "event_type").alias("point"))
    opinions = points.withColumn("opinion", A.polarity("point", ("cheap",), ("dear",)))
    return opinion_mismatch(v_offer(spark, sf), opinions)


@query("ag25_variant_attributes", """WITH l AS (SELECT title_id AS uid, title, p_size * 10 AS g, 1 + p_partkey % 2 AS x, CASE p_partkey % 3 WHEN 1 THEN 45 WHEN 2 THEN 65 END AS w, floor(p_retailprice) AS price, p_name, p_type FROM v_listing JOIN part ON p_partkey = title_id),
  f AS (SELECT uid, f FROM l, LATERAL (SELECT lower(p_type) AS f UNION ALL SELECT split_part(p_name, ' ', 2) WHERE uid % 2 = 0))
  SELECT uid, 'mass' AS attr, g::DOUBLE AS value FROM l UNION ALL SELECT uid, 'power', w::DOUBLE FROM l WHERE w IS NOT NULL UNION ALL SELECT uid, 'price', price::DOUBLE FROM l UNION ALL SELECT uid, 'price_per_100', round_even(price::DOUBLE / g * 100, 0) FROM l UNION ALL SELECT uid, f, 1.0::DOUBLE FROM f""")
def ag25(spark, sf):
    return _variant_attributes(spark, sf)


def _variant_attributes(spark, sf):
    p = table(spark, sf, "part")
    variants = v_listing(spark, sf).join(p.select(F.col("p_partkey").alias("title_id"), F.floor("p_retailprice").alias("price")), "title_id").select(F.col("title_id").alias("uid"), "title", "price")
    # Four specs for each variant: all name the type, half of them the kind (of even ones), one a measure.
    specs = p.select(F.col("p_partkey").alias("uid"), "p_name", "p_type", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("spec_id"))
    kind = F.when((F.col("spec_id") < F.when(F.col("uid") % 2 == 0, 2).otherwise(1)), F.split_part("p_name", F.lit(" "), F.lit(2)))
    features = specs.select("uid", "spec_id", F.explode(F.array_compact(F.array(F.lower("p_type"), kind, F.lit("315g")))).alias("feature"))
    return FM.variant_attributes(variants, features)


@query("ag26_family_series", """WITH l AS (SELECT title_id AS uid, entity, (p_size * 10)::DOUBLE AS g, CASE p_partkey % 3 WHEN 1 THEN 45.0 WHEN 2 THEN 65.0 END AS w, floor(p_retailprice)::DOUBLE AS price FROM v_listing JOIN part ON p_partkey = title_id),
  x AS (SELECT entity, CASE WHEN count(DISTINCT g) >= 2 THEN 'mass' WHEN count(DISTINCT w) >= 2 THEN 'power' END AS axis FROM l GROUP BY entity),
  b AS (SELECT entity, axis, uid, CASE axis WHEN 'mass' THEN g ELSE w END AS x, attr, CASE attr WHEN 'price' THEN price ELSE round_even(price / g * 100, 0) END AS v FROM l JOIN x USING (entity) CROSS JOIN (SELECT unnest(['price', 'price_per_100']) AS attr) WHERE axis IS NOT NULL)
  SELECT entity AS family, axis, attr, string_agg(concat(CAST(x AS VARCHAR), '=', CAST(v::BIGINT AS VARCHAR)), '|' ORDER BY x, uid) AS bars FROM b WHERE x IS NOT NULL GROUP BY entity, axis, attr HAVING count(*) >= 2""")
def ag26(spark, sf):
    families = v_listing(spark, sf).select(F.col("title_id").alias("uid"), F.col("entity").alias("family"))
    return FM.family_series(_variant_attributes(spark, sf), families)


@query("ag27_ratings", "WITH m AS (SELECT o_custkey AS uid, (1 + o_custkey % 5)::DOUBLE AS rating, o_custkey % 4 AS n FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey % 3 = 0), r AS (SELECT o_custkey AS uid, avg(1 + o_orderkey % 5) AS mean, count(*) AS c FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) SELECT coalesce(m.uid, r.uid) AS uid, round_even(CASE WHEN n > 0 THEN rating WHEN c >= 3 THEN mean END, 2) AS rating, CASE WHEN n > 0 THEN n WHEN c >= 3 THEN c END AS n, CASE WHEN n > 0 THEN 'catalog' WHEN c >= 3 THEN 'reviews' ELSE 'none' END AS origin FROM m FULL JOIN r ON m.uid = r.uid")
def ag27_ratings(spark, sf):
    o = table(spark, sf, "orders")
    meta = o.select(F.col("o_custkey").alias("uid")).distinct().where("uid % 3 = 0").select("uid", (1 + F.col("uid") % 5).cast("double").alias("rating"), (F.col("uid") % 4).alias("n"))
    stars = F.when(F.col("o_orderstatus") != "P", 1 + F.col("o_orderkey") % 5)
    return FM.rating(meta, o.select(F.col("o_custkey").alias("uid"), stars.alias("stars")), "uid")


@query("att30_clean_colour_and_sizes", "SELECT p_partkey, CASE WHEN p_name LIKE 'new %' THEN split_part(p_name, ' ', 2) ELSE p_name END AS colour, CASE WHEN p_partkey % 4 = 0 THEN concat('L|', lower(p_type), '|xs') ELSE array_to_string(list_transform(list_sort(list_distinct([p_size, p_size % 7, 10])), lambda x: CAST(x AS VARCHAR)), '|') END AS sizes FROM part")
def att30(spark, sf):
    p, text = table(spark, sf, "part"), lambda c: c.cast("string")
    raw = F.when(F.col("p_partkey") % 4 == 0, F.concat_ws("|", F.lit("xs"), F.lit("Hidden"), F.lower("p_type"), F.lit(" L"), F.lit("xs"))).otherwise(F.concat_ws("|", text(F.col("p_size")), text(F.col("p_size") % 7), F.lit("10"), text(F.col("p_size"))))
    return p.select("p_partkey", A.clean_colour(F.concat(F.lit("The "), "p_name")).alias("colour"), A.clean_sizes(raw).alias("sizes"))


@query("att31_notice_facts", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Vietnam' WHEN 1 THEN 'Korea' ELSE '' END AS origin, CASE WHEN p_partkey % 2 = 0 THEN concat('cotton ', p_size, '%') ELSE '' END AS material, CASE WHEN p_partkey % 5 = 0 THEN concat('2024-', lpad(CAST(1 + p_partkey % 12 AS VARCHAR), 2, '0')) ELSE '' END AS made, concat(p_brand, ',', p_type) AS listed FROM part")
def att31(spark, sf):
    k, text = F.col("p_partkey"), lambda c: c.cast("string")
    note = F.concat_ws(
        "; ", F.when(k % 3 == 0, "Origin: Vietnam").when(k % 3 == 1, "assembled in Korea"), F.when(k % 2 == 0, F.concat(F.lit("Material: cotton "), text(F.col("p_size")), F.lit("%"))).otherwise("Material: pure joy"),
        F.when(k % 5 == 0, F.concat(F.lit("made in month: 2024-"), F.lpad(text(1 + k % 12), 2, "0"))),
    )
    f = table(spark, sf, "part").select("p_partkey", A.notice_facts(note).alias("f"), A.distinct_list(F.concat_ws(",", "p_brand", F.lit(" "), "p_type", "p_brand")).alias("listed"))
    return f.select("p_partkey", "f.origin", "f.material", "f.made", "listed")


@query("sc15_codes", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'KGM' WHEN 1 THEN 'MLT' WHEN 2 THEN 'E34' END AS unit, CASE event_id % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender FROM events")
def sc15(spark, sf):
    k = F.col("event_id")
    unit = F.when(k % 4 == 0, "kg").when(k % 4 == 1, "mL").when(k % 4 == 2, "GB").otherwise("furlong")
    return table(spark, sf, "events").select("event_id", A.unit_code(unit).alias("unit"), A.gender_label(F.when(k % 3 == 0, " Men").when(k % 3 == 1, "women").otherwise("x")).alias("gender"))


@query("sc16_priority", "SELECT uid, attempts + 5 * n_dims AS weight, attempts AS reviews, row_number() OVER (ORDER BY attempts + 5 * n_dims DESC, attempts DESC, uid) AS place FROM v_state ORDER BY place LIMIT 50")
def sc16(spark, sf):
    top = v_state(spark, sf).select("uid", A.priority("attempts", "n_dims").alias("p")).orderBy(F.desc("p"), "uid").limit(50)
    return top.select("uid", "p.weight", "p.reviews", F.expr("row_number() over (order by p desc, uid)").alias("place"))


# Attribute rules over listings whose titles hold the attributes.


@query("att5_listing_measures", "SELECT title_id, (p_size * 10)::DOUBLE AS grams, CASE p_partkey % 3 WHEN 1 THEN 45.0::DOUBLE WHEN 2 THEN 65.0::DOUBLE END AS watts, 1 + p_partkey % 2 AS pack FROM v_listing JOIN part ON p_partkey = title_id")
def att5_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", A.measure("title", A.WEIGHT).alias("grams"), A.measure("title", A.POWER).alias("watts"), A.pack_count("title").alias("pack"))


@query("att8_listing_connector", "SELECT title_id, connector FROM v_attr")
def att8_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", A.first_rule("title", A.CONNECTORS).alias("connector"))


@query("att9_listing_models", "SELECT title_id, array_to_string(models, '|') AS models FROM v_attr")
def att9_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", F.array_join(A.model_codes("title", "brand_raw"), "|").alias("models"))


@query("att10_listing_bundle", "SELECT title_id, bundle FROM v_attr")
def att10_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", A.is_bundle("title").alias("bundle"))


@query("att11_listing_condition", "SELECT title_id, nullif(state, 'new') AS condition, title_id % 17 = 0 AS grey FROM v_attr")
def att11_listing(spark, sf):
    t = v_listing(spark, sf).withColumn("title", F.when(F.col("title_id") % 17 == 0, F.concat("title", F.lit(" parallel"))).otherwise(F.concat("title", F.lit(" important"))))
    return t.select("title_id", A.condition("title").alias("condition"), A.is_grey("title").alias("grey"))


@query("att12_listing_category", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'plated' ELSE CASE WHEN p_type = 'PROMO' THEN 'promo' ELSE 'metal' END END AS category FROM part")
def att12_listing(spark, sf):
    k = F.col("p_partkey")
    title = F.when(k % 2 == 0, F.concat_ws(" ", "p_name", F.lit("Plated steel"))).otherwise(F.concat_ws(" ", "p_type", "p_name", F.lit("brass, polished")))
    return table(spark, sf, "part").select("p_partkey", A.earliest_marker(title, A.CATEGORIES).alias("category"))


@query("att13_listing_lines", "SELECT title_id, array_to_string(lines, '|') AS lines, size_token FROM v_attr")
def att13_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", F.array_join(A.product_lines("title"), "|").alias("lines"), A.size_token("title").alias("size_token"))


@query("att15_listing_pack", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size WHEN p_partkey % 3 = 1 THEN 2 + p_partkey % 5 ELSE 1 END::INT AS pack FROM part")
def att15_listing(spark, sf):
    k, text = F.col("p_partkey"), lambda c: c.cast("string")
    title = F.concat_ws(" ", "p_name", F.when(k % 3 == 0, F.concat(F.lit("4 pcs x"), text(F.col("p_size")))).when(k % 3 == 1, F.concat(F.lit("7 pcs in "), text(2 + k % 5), F.lit(" pack"))))
    return table(spark, sf, "part").select("p_partkey", A.pack_count_priority(title).alias("pack"))


@query("att21_listing_family", "SELECT p_partkey, CASE WHEN split_part(p_name, ' ', 2) IN ('ring', 'bolt') THEN 'fastener' WHEN split_part(p_name, ' ', 1) IN ('hot', 'cold') THEN 'thermal' ELSE 'other' END AS family FROM part")
def att21_listing(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.coalesce(A.first_rule("p_name", (("fastener", r"\b(ring|bolt)\b"), ("thermal", r"\b(hot|cold)\b"))), F.lit("other")).alias("family"))


@query("att28_listing_sku", "SELECT title_id, CASE WHEN title_id % 11 <> 0 THEN concat('Brand#', split_part(split_part(entity, '|', 1), '#', 2)) END AS sku FROM v_listing")
def att28_listing(spark, sf):
    return v_listing(spark, sf).select("title_id", A.sku_in_title(F.split_part("entity", F.lit("|"), F.lit(1)), "title").alias("sku"))
