"""Queries over routed rows: suspects, relevance, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.operators import routing as R
from skuweave.plans.registry import query
from skuweave.plans.views import table

#: Offers of a part: its name in another form; some add another good, another size, or another word.
GOODS = """g AS (SELECT p_partkey AS id, concat(p_name, ' ', p_size * 10, 'g') AS name, CASE p_partkey % 6 WHEN 0 THEN concat(p_brand, ' ', upper(p_name), ' ', p_size * 10, 'g') WHEN 1 THEN concat(p_name, ' + ', p_type, ' ', p_size * 10, 'g') WHEN 2 THEN concat(p_name, ' ', p_size * 10 + 5, 'g')
  WHEN 3 THEN concat(split_part(p_name, ' ', 1), ' 김치 ', split_part(p_name, ' ', 2), ' ', p_size * 10, 'g') WHEN 4 THEN concat('제일제당 ', split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), ' ', p_size * 10, 'g') ELSE concat(split_part(p_name, ' ', 1), ' ', p_type) END AS title, string_split(p_name, ' ') AS core FROM part)"""


def _goods(spark, sf):
    word = lambda i: F.get(F.split("p_name", " "), F.lit(i))
    size, k = F.concat((F.col("p_size") * 10).cast("string"), F.lit("g")), F.col("p_partkey") % 6
    title = (
        F.when(k == 0, F.concat_ws(" ", "p_brand", F.upper("p_name"), size)).when(k == 1, F.concat("p_name", F.lit(" + "), "p_type", F.lit(" "), size)).when(k == 2, F.concat("p_name", F.lit(" "), (F.col("p_size") * 10 + 5).cast("string"), F.lit("g")))
        .when(k == 3, F.concat_ws(" ", word(0), F.lit("김치"), word(1), size)).when(k == 4, F.concat(F.lit("제일제당 "), word(0), word(1), F.lit(" "), size)).otherwise(F.concat_ws(" ", word(0), "p_type"))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", size).alias("name"), title.alias("title"), F.split("p_name", " ").alias("core"))


@query("flt5_suspect_reasons", f"""WITH {GOODS}, b AS (SELECT *, replace(lower(name), ' ', '') AS n, replace(lower(title), ' ', '') AS t FROM g),
 r AS (SELECT *, list_distinct(list_transform(range(1, len(n)), lambda i: n[i:i + 1])) AS gn, list_distinct(list_transform(range(1, len(t)), lambda i: t[i:i + 1])) AS gt FROM b)
 SELECT id, CASE WHEN share >= 0.5 AND share < 0.8 THEN 'recall' WHEN contains(title, '+') THEN 'combo' WHEN id % 6 = 2 THEN 'size' END AS reason FROM (SELECT *, len(list_intersect(gn, gt))::DOUBLE / len(gn) AS share FROM r) WHERE reason IS NOT NULL""")
def flt5_reasons(spark, sf):
    return _goods(spark, sf).select("id", R.suspect("name", "title", 0.5, 0.8).alias("reason")).where("reason is not null")


@query("flt6_irrelevant_goods", f"""WITH {GOODS}, w AS (SELECT *, replace(title, ' ', '') AS t FROM g) SELECT id, CASE WHEN len(list_filter(core, lambda c: NOT contains(t, c))) > 0 THEN 'core' WHEN contains(title, '+') THEN 'bundle' WHEN contains(title, '김치') THEN 'sub_type' END AS reason FROM w""")
def flt6_goods(spark, sf):
    return _goods(spark, sf).select("id", R.irrelevant("title", "core").alias("reason"))


@query("flt10_contained_flags", "SELECT p_partkey FROM part WHERE p_size > 25 AND p_size % 2 = 0 AND (p_type = 'PROMO' OR p_brand = 'PROMO')")
def flt10_flags(spark, sf):
    flags = F.to_json(F.struct((F.col("p_size") > 25).alias("is_gift_set"), F.array("p_type", "p_brand").alias("tags"), F.struct((F.col("p_size") % 2).alias("odd"), "p_size").alias("at")))
    return table(spark, sf, "part").withColumn("flags", flags).where(R.holds_flags("flags", {"is_gift_set": True, "tags": ["PROMO"], "at": {"odd": 0}})).select("p_partkey")
