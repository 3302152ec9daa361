"""Queries over nested serving records; lists are printed as text for the comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.operators import family as FM
from skuweave.operators import nested as N
from skuweave.operators import prices as P
from skuweave.operators import serving as R
from skuweave.plans.nested import FAQ, _faqs
from skuweave.plans.prices import LADDER
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_catalog, v_listing, v_offer, v_point
from skuweave.plans.voice import paged_points


def _printed(items, each, sep="|"):
    return F.coalesce(F.array_join(F.transform(items, each), sep), F.lit(""))


def _key(column: str):
    return F.concat(F.lit("C"), F.col(column).cast("string")).alias("bundle_uid")


def _faq_rows(spark, sf):
    return N.faq_rows(_faqs(spark, sf), "conv_id").withColumn("bundle_uid", _key("conv_id"))


def _filmed(spark, sf):
    """What videos say: the points that are cited most."""
    return v_point(spark, sf).where("cited >= 5")


FAQ_TEXT = "SELECT concat('C', conv_id) AS bundle_uid, md5(string_agg(concat(question, '=', coalesce(answer, '')), '|' ORDER BY ord)) AS faqs FROM f GROUP BY conv_id"
_faq_text = lambda c: F.md5(F.nullif(_printed(c, lambda q: F.concat(q["question"], F.lit("="), q["short_answer"])), F.lit("")))


@query("shp13_nested_summary", f"""WITH {FAQ}, p AS (SELECT bundle_uid, dim_path, point, min(ord) AS ord FROM v_point GROUP BY ALL),
 t AS (SELECT bundle_uid, starts_with(dim_path, 'verdict.strengths') AS good, point, min(struct_pack(d := dim_path, o := ord, p := point)) AS pos FROM p WHERE starts_with(dim_path, 'verdict.strengths') OR starts_with(dim_path, 'verdict.weaknesses') GROUP BY ALL),
 v AS (SELECT bundle_uid, string_agg(point, '|' ORDER BY pos.d, pos.o, pos.p) FILTER (good) AS strengths, string_agg(point, '|' ORDER BY pos.d, pos.o, pos.p) FILTER (NOT good) AS weaknesses FROM t GROUP BY bundle_uid),
 a AS (SELECT bundle_uid, string_agg(concat(dim_path, '(', texts, ')'), '|' ORDER BY dim_path) AS aspects FROM (SELECT bundle_uid, dim_path, string_agg(point, ';' ORDER BY ord, point) AS texts FROM p WHERE starts_with(dim_path, 'aspect.') GROUP BY ALL) GROUP BY bundle_uid),
 r AS (SELECT concat('C', c_custkey) AS bundle_uid, concat('best for ', c_mktsegment) AS recommendation FROM customer WHERE c_acctbal > 0), q2 AS ({FAQ_TEXT}),
 k AS (SELECT bundle_uid FROM p UNION SELECT bundle_uid FROM r UNION SELECT bundle_uid FROM q2)
 SELECT k.bundle_uid, coalesce(recommendation, '') AS recommendation, coalesce(strengths, '') AS strengths, coalesce(weaknesses, '') AS weaknesses, coalesce(aspects, '') AS aspects, faqs FROM k LEFT JOIN v USING (bundle_uid) LEFT JOIN a USING (bundle_uid) LEFT JOIN r USING (bundle_uid) LEFT JOIN q2 USING (bundle_uid)""")
def shp13_nested(spark, sf):
    said = F.to_json(F.struct(F.struct(F.when(F.col("c_acctbal") > 0, F.concat(F.lit("best for "), "c_mktsegment")).alias("overall_recommendation")).alias("verdict")))
    told = R.recommendations(table(spark, sf, "customer").select(_key("c_custkey"), said.alias("taxonomy")), "bundle_uid")
    s = R.flat_summary(v_point(spark, sf), _faq_rows(spark, sf), told, "bundle_uid")
    aspects = _printed(F.map_entries("aspects"), lambda e: F.concat(e["key"], F.lit("("), F.array_join(e["value"], ";"), F.lit(")")))
    return s.select("bundle_uid", "recommendation", F.array_join("strengths", "|").alias("strengths"), F.array_join("weaknesses", "|").alias("weaknesses"), aspects.alias("aspects"), _faq_text("faqs").alias("faqs"))


@query("ev12_group_records", f"""WITH l AS ({LADDER}), s AS (SELECT l_partkey AS uid, avg(1 + l_orderkey % 5) AS mean, count(*) AS c FROM lineitem GROUP BY 1),
 g AS (SELECT p_partkey AS uid, CASE WHEN p_size > 40 AND p_size % 4 > 0 THEN (1 + p_size % 5)::DOUBLE WHEN c >= 3 THEN round_even(mean, 2) END AS rating FROM part LEFT JOIN s ON s.uid = p_partkey)
 SELECT entity, concat_ws('|', CASE WHEN count(DISTINCT watts) >= 2 THEN '소비전력' END, CASE WHEN count(DISTINCT grams) >= 2 THEN '중량' END) AS varies_by,
  string_agg(concat(title, '{{중량=', grams, 'g', CASE WHEN watts IS NOT NULL THEN concat(';소비전력=', watts, 'W') ELSE '' END, '}}', coalesce(CAST(median_price AS VARCHAR), '-'), '/', coalesce(CAST(rating AS VARCHAR), '-')), '|' ORDER BY title, title_id) AS variants
 FROM v_attr LEFT JOIN l ON l.product_uid = concat('P', title_id) LEFT JOIN g ON g.uid = title_id GROUP BY entity""")
def ev12_records(spark, sf):
    price = P.price_ladder(v_offer(spark, sf)).select(F.substring("product_uid", 2, 20).cast("long").alias("title_id"), F.col("median_price").alias("price"))
    meta = table(spark, sf, "part").where("p_size > 40").select(F.col("p_partkey").alias("title_id"), (1 + F.col("p_size") % 5).cast("double").alias("rating"), (F.col("p_size") % 4).alias("n"))
    stars = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("title_id"), (1 + F.col("l_orderkey") % 5).alias("stars"))
    g = R.product_groups(v_listing(spark, sf), price, FM.rating(meta, stars, "title_id"), "entity", "title_id", "title")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    props = lambda v: F.array_join(F.transform(v["properties"], lambda p: F.concat(p["name"], F.lit("="), p["value"])), ";")
    return g.select("entity", F.array_join("varies_by", "|").alias("varies_by"), _printed("variants", lambda v: F.concat(v["name"], F.lit("{"), props(v), F.lit("}"), text(v["price"]), F.lit("/"), text(v["rating"]))).alias("variants"))


def _items(x: str, where: str = "") -> str:
    """A page's items as common table expressions whose names begin with x: d points, u texts once, b those shown."""
    return f"""{x}d AS (SELECT *, dense_rank() OVER (PARTITION BY bundle_uid ORDER BY total DESC, dim_path) AS dim_rank FROM (SELECT *, sum(cited) OVER (PARTITION BY bundle_uid, dim_path) AS total FROM v_point {where})),
 {x}e AS (SELECT *, CASE WHEN starts_with(dim_path, 'verdict.strengths') THEN 'good' WHEN starts_with(dim_path, 'verdict.weaknesses') THEN 'caveat' WHEN starts_with(dim_path, 'aspect.taste') THEN 'taste' WHEN starts_with(dim_path, 'aspect.size') THEN 'pack' ELSE 'use' END AS section, CASE WHEN ord % 5 > 0 THEN ord % 5 ELSE cited END AS mentions FROM {x}d),
 {x}u AS (SELECT * FROM {x}e QUALIFY row_number() OVER (PARTITION BY bundle_uid, point ORDER BY dim_rank, ord, point) = 1),
 {x}b AS (SELECT *, row_number() OVER (PARTITION BY bundle_uid, section ORDER BY mentions DESC, dim_rank, ord) AS r, list_position(['good', 'taste', 'spec', 'pack', 'use', 'gift', 'caveat'], section) AS place FROM {x}u QUALIFY r <= 3)"""


@query("ev16_guide_rows", f"""WITH {_items('p')}, {_items('y', 'WHERE cited >= 5')},
 c AS (SELECT bundle_uid, point, max(cited) AS m, min(struct_pack(l := -cited, d := dim_rank, o := ord)) AS pos FROM pd WHERE starts_with(dim_path, 'verdict.weaknesses') GROUP BY ALL),
 cs AS (SELECT bundle_uid, string_agg(concat(point, '=', m), '|' ORDER BY pos.l, pos.d, pos.o, point) AS cons FROM c GROUP BY bundle_uid),
 g AS (SELECT * FROM pb WHERE section <> 'caveat' AND NOT EXISTS (SELECT 1 FROM c WHERE c.bundle_uid = pb.bundle_uid AND c.point = pb.point)),
 ps AS (SELECT bundle_uid, string_agg(t, '|' ORDER BY place) AS pros FROM (SELECT bundle_uid, place, concat(section, '(', string_agg(concat(point, '=', mentions), ';' ORDER BY r), ')') AS t FROM g GROUP BY bundle_uid, place, section) GROUP BY bundle_uid),
 k AS (SELECT bundle_uid, string_agg(point, '|' ORDER BY mentions DESC, place, r) AS card FROM (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY bundle_uid ORDER BY mentions DESC, place, r) <= 3) GROUP BY bundle_uid),
 ym AS (SELECT * FROM yb WHERE section <> 'caveat' QUALIFY row_number() OVER (PARTITION BY bundle_uid ORDER BY mentions DESC, place, r) <= 4),
 ys AS (SELECT bundle_uid, string_agg(concat(point, '=', mentions), '|' ORDER BY mentions DESC, place, r) AS video_pros FROM ym WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.bundle_uid = ym.bundle_uid AND c.point = ym.point) GROUP BY bundle_uid),
 o AS (SELECT concat('C', o_custkey) AS bundle_uid, concat('P', l_partkey) AS product_uid, s_name AS mall, CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) AS BIGINT) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
 h AS (SELECT bundle_uid, min(struct_pack(minor := NOT mall LIKE '%1', price := price, mall := mall)) AS h FROM o WHERE price > 0 GROUP BY bundle_uid),
 w AS (SELECT bundle_uid, md5(string_agg(concat(product_uid, '=', low, '/', n), '|' ORDER BY low, product_uid)) AS ladder FROM (SELECT bundle_uid, product_uid, min(price) AS low, count(DISTINCT mall) AS n FROM o WHERE price > 0 GROUP BY ALL) GROUP BY bundle_uid),
 z AS (SELECT concat('C', user_id) AS bundle_uid, count(*) AS buzz FROM events GROUP BY 1),
 hl AS (SELECT b.bundle_uid, coalesce(any_value(s.strength), arg_min(b.point, struct_pack(p := b.place, r := b.r))) AS headline FROM pb b LEFT JOIN (SELECT bundle_uid, arg_min(point, struct_pack(a := dim_rank, b := ord)) AS strength FROM pe WHERE section = 'good' GROUP BY 1) s USING (bundle_uid) GROUP BY b.bundle_uid),
 n AS (SELECT bundle_uid, CAST(sum(mentions) AS BIGINT) AS review_count FROM pu GROUP BY 1)
 SELECT hl.bundle_uid, headline, review_count, coalesce(card, '') AS card, coalesce(pros, '') AS pros, coalesce(video_pros, '') AS video_pros, coalesce(cons, '') AS cons, h.mall AS low_mall, h.price AS low, NOT h.minor AS major, ladder, coalesce(buzz, 0) AS buzz
 FROM hl JOIN n USING (bundle_uid) LEFT JOIN k USING (bundle_uid) LEFT JOIN ps USING (bundle_uid) LEFT JOIN ys USING (bundle_uid) LEFT JOIN cs USING (bundle_uid) LEFT JOIN h USING (bundle_uid) LEFT JOIN w USING (bundle_uid) LEFT JOIN z USING (bundle_uid)""")
def ev16_rows(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey")).join(table(spark, sf, "supplier"), F.expr("s_suppkey = l_suppkey"))
    offers = li.select(_key("o_custkey"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_uid"), F.col("s_name").alias("mall"), F.floor(F.expr("l_extendedprice / l_quantity * 100 + 0.5")).cast("bigint").alias("price"))
    buzz = table(spark, sf, "events").groupBy(_key("user_id")).agg(F.count("*").alias("buzz"))
    g = R.consumer_guide(paged_points(v_point(spark, sf)), paged_points(_filmed(spark, sf)), offers, buzz, F.col("mall").like("%1"))
    said = lambda x: F.concat(x["text"], F.lit("="), x["mentions"].cast("string"))
    pros = _printed("pros", lambda s: F.concat(s["section"], F.lit("("), F.array_join(F.transform(s["items"], said), ";"), F.lit(")")))
    rung = lambda r: F.concat(r["product_uid"], F.lit("="), r["low"].cast("string"), F.lit("/"), r["n_malls"].cast("string"))
    return g.select(
        "bundle_uid", "headline", "review_count", _printed("card", lambda x: x["text"]).alias("card"), pros.alias("pros"), _printed("video_pros", said).alias("video_pros"), _printed("cons", said).alias("cons"),
        F.col("head.mall").alias("low_mall"), F.col("head.price").alias("low"), F.col("head.major").alias("major"), F.md5(F.nullif(_printed("ladder", rung), F.lit(""))).alias("ladder"), "buzz",
    )


def _dims(x: str, where: str = "") -> str:
    """A key's dimensions in their order and its number of links, as common table expressions whose names begin with x."""
    return f"""{x}d AS (SELECT *, dense_rank() OVER (PARTITION BY bundle_uid ORDER BY total DESC, dim_path) AS dim_rank FROM (SELECT *, sum(cited) OVER (PARTITION BY bundle_uid, dim_path) AS total FROM v_point {where})),
 {x}t AS (SELECT bundle_uid, dim_rank, dim_path, point, min(ord) AS ord FROM {x}d GROUP BY ALL),
 {x}l AS (SELECT bundle_uid, md5(string_agg(concat(dim_path, '(', texts, ')'), '|' ORDER BY dim_rank, dim_path)) AS dims FROM (SELECT bundle_uid, dim_rank, CASE string_split(dim_path, '.')[-2] {{labels}} ELSE string_split(dim_path, '.')[-2] END AS dim_path, string_agg(concat(point, '[', ord % 5, ']'), ';' ORDER BY ord, point) AS texts FROM {x}t GROUP BY ALL) GROUP BY bundle_uid),
 {x}s AS (SELECT bundle_uid, CAST(sum(len(list_filter(range(ord % 5), lambda i: (i + ord) % 4 <> 3))) AS BIGINT) AS n FROM {x}d GROUP BY bundle_uid)"""


def _labelled(sql: str) -> str:
    from skuweave.operators.voice import DIM_LABELS

    return sql.replace("{labels}", " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DIM_LABELS.items()))


@query("dm5_catalog_report", _labelled(f"""WITH {FAQ}, {_dims('p')}, {_dims('y', 'WHERE cited >= 5')}, q2 AS ({FAQ_TEXT}), l AS ({LADDER}), c AS (SELECT *, concat('C', seq) AS bundle_uid FROM v_catalog)
 SELECT c.bundle_uid, c.brand, c.name, l.min_price AS low, l.median_price AS median, l.max_price AS high, l.n_malls, l.cheapest_mall AS low_mall, l.spread_pct, pl.dims, coalesce(ps.n, 0) AS n_sources, faqs, yl.dims IS NOT NULL AS has_video, yl.dims AS video_dims, coalesce(ys.n, 0) AS video_sources
 FROM c LEFT JOIN l ON l.product_uid = concat('P', seq) LEFT JOIN pl USING (bundle_uid) LEFT JOIN ps USING (bundle_uid) LEFT JOIN q2 USING (bundle_uid) LEFT JOIN yl USING (bundle_uid) LEFT JOIN ys USING (bundle_uid) WHERE l.min_price IS NOT NULL OR pl.dims IS NOT NULL OR yl.dims IS NOT NULL"""))
def dm5_report(spark, sf):
    prices = P.price_ladder(v_offer(spark, sf)).withColumn("bundle_uid", F.concat(F.lit("C"), F.substring("product_uid", 2, 20)))
    catalog, faqs = v_catalog(spark, sf).withColumn("bundle_uid", _key("seq")), _faq_rows(spark, sf)
    r = R.catalog_report(catalog, prices, paged_points(v_point(spark, sf)), faqs, paged_points(_filmed(spark, sf)), faqs.limit(0), "bundle_uid")
    point = lambda p: F.concat(p["text"], F.lit("["), F.size(p["evidence"]).cast("string"), F.lit("]"))
    dims = lambda c: F.md5(F.nullif(_printed(c, lambda d: F.concat(d["label"], F.lit("("), F.array_join(F.transform(d["points"], point), ";"), F.lit(")"))), F.lit("")))
    return r.select("bundle_uid", "brand", "name", "price.*", dims("dims").alias("dims"), "n_sources", _faq_text("faqs").alias("faqs"), "has_video", dims("video_dims").alias("video_dims"), "video_sources")
