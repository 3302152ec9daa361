"""Views that bind the star-schema tables to the shapes that the operators read, and the same views as SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(x: str) -> F.Column:
    return F.floor(F.expr(x) * 100 + 0.5).cast("bigint")


def v_offer(spark, sf) -> DataFrame:
    """Mall offers: one row per line item."""
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.expr("l_partkey = p_partkey")).join(table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
    return j.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_uid"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.col("s_name").alias("mall"),
        _cents("l_extendedprice / l_quantity").alias("price"), _cents("p_retailprice").alias("official_price"), F.col("l_quantity").cast("int").alias("qty"),
        F.when(F.col("l_returnflag") == "R", 4).when(F.col("l_returnflag") == "A", 2).otherwise(1).alias("product_type"), F.col("l_shipdate").cast("date").alias("day"),
        F.concat("p_brand", F.lit(" "), "p_name", F.lit(" "), (F.col("p_size") * 10).cast("string"), F.lit("g x"), F.col("l_quantity").cast("int").cast("string")).alias("title"),
    )


def v_title(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("title_id"), F.col("p_brand").alias("brand_raw"), F.col("p_type").alias("category"),
        F.concat("p_brand", F.lit(" "), "p_name", F.lit(" "), (F.col("p_size") * 10).cast("string"), F.lit("g")).alias("title"),
    )


def v_product(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("uid"), F.concat(F.lit("B:"), "p_name").alias("parent_uid"), F.col("p_name").alias("keyword"), F.col("p_type").alias("category_l1"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_partkey")).alias("ctlg_no"), F.concat((F.col("p_size") * 10).cast("string"), F.lit("g")).alias("size"),
    )


def v_catalog(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_type").alias("source"), F.col("p_brand").alias("brand"), F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("style_code"), F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_name")).alias("material"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type")).alias("origin"),
        _cents("p_retailprice").alias("price"), F.col("p_partkey").alias("seq"),
    )


def v_point(spark, sf) -> DataFrame:
    p = F.col("o_orderpriority")
    dim = F.when(p == "1-URGENT", "verdict.strengths").when(p == "2-HIGH", "aspect.taste").when(p == "3-MEDIUM", "aspect.size").when(p == "4-NOT SPECIFIED", "verdict.weaknesses").otherwise("context.when.scene")
    return table(spark, sf, "orders").join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")).select(
        F.col("c_mktsegment").alias("category"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("bundle_uid"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("product_uid"),
        F.concat(dim, F.lit("."), F.lower("o_orderstatus")).alias("dim_path"), F.concat(F.lit("point "), (F.col("o_orderkey") % 97).cast("string")).alias("point"),
        (F.col("o_orderkey") % 7).cast("int").alias("cited"), F.col("o_orderkey").alias("ord"),
    )


def v_source(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    # The numbering sorts ids only; texts do not pass the window.
    number = d.select("source", "doc_id").select("doc_id", F.expr("concat('S', cast(row_number() over (partition by source order by doc_id) as string))").alias("local_id"))
    return d.join(number, "doc_id").select(F.col("source").alias("product_uid"), "local_id", "doc_id", "lang", F.col("text").alias("body"))


def v_citation(spark, sf) -> DataFrame:
    """A citation of each source's first longer sentence: exact, respaced, cut, of a wrong source, made up, misspelt or a question."""
    s = v_source(spark, sf).withColumn("s", F.coalesce(F.get(F.filter(F.transform(F.split("body", r"[.!?\n]+"), lambda x: F.trim(x)), lambda x: F.length(x) >= 20), F.lit(0)), F.lit("")))
    kind, made = F.col("doc_id") % 8, F.concat_ws(" ", F.md5(F.col("doc_id").cast("string")), F.md5(F.concat(F.lit("x"), F.col("doc_id").cast("string"))))
    loud = F.replace(F.translate("s", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit(" "), F.lit("  "))
    cut = F.array_join(F.filter(F.split("s", " "), lambda w, i: (i + 1) % 4 != 0), " ")
    quote = F.when(kind == 1, loud).when(kind == 2, cut).when(kind == 5, made).when(kind == 6, F.translate("s", "aeio", "4310")).when(kind == 7, F.concat("s", F.lit("?"))).otherwise(F.col("s"))
    wrong = (kind == 3) | ((kind == 5) & (F.col("doc_id") % 16 >= 8))
    role = F.when(F.col("doc_id") % 3 == 0, "point").when(F.col("doc_id") % 3 == 1, "answer").otherwise("question")
    return s.select(
        F.col("doc_id").alias("citation_id"), "product_uid", F.concat(F.lit("[s"), F.when(wrong, "9999999").when(kind == 4, "1").otherwise(F.substring("local_id", 2, 20)), F.lit("]")).alias("local_source_id"),
        quote.alias("quote"), role.alias("role"), (role == "question").alias("allow_question"), (F.col("doc_id") % 25).alias("owner"),
    )


def v_evidence(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("evidence_id"), F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("product_uid"),
        F.concat(F.lit("[s"), (F.col("item_id") % 10 + 1).cast("string"), F.lit("]")).alias("local_source_id"), F.col("text").alias("quote"),
    )


def v_state(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), k.cast("string")).alias("uid"), F.when(k % 4 == 0, "done").when(k % 4 == 1, "pending").when(k % 4 == 2, "empty").alias("status"),
        (k % 6).cast("int").alias("attempts"), (k % 3).cast("int").alias("n_dims"), (k % 5 < 3).alias("has_insight"),
    )


def v_price_day(spark, sf) -> DataFrame:
    return v_offer(spark, sf).groupBy("product_uid", "day").agg(F.min("price").alias("min_price"), F.count("*").alias("n"))


def v_pair(spark, sf) -> DataFrame:
    """Each listing with the first one of its brand and category."""
    t = v_title(spark, sf)
    first = t.groupBy("brand_raw", "category").agg(F.min("title_id").alias("a"))
    return t.join(first, ["brand_raw", "category"]).where("a < title_id").select("a", F.col("title_id").alias("b"))


def v_listing(spark, sf) -> DataFrame:
    """Mall listings with all that titles hold: model, connector, measures, pack, condition, bundle words, GTIN."""
    k, text = F.col("p_partkey"), lambda c: c.cast("string")
    brand = F.when(k % 11 != 0, F.col("p_brand"))
    title = F.concat_ws(
        " ", brand, "p_name", F.when(k % 4 != 0, F.concat(F.lit("MX"), text(k % 40), F.lit("A"))), F.when(k % 5 == 0, "USB-C").when(k % 5 == 1, "Lightning"), F.concat(text(F.col("p_size") * 10), F.lit("g")),
        F.when(k % 3 == 1, "45W").when(k % 3 == 2, "65W"), F.concat(F.lit("x"), text(1 + k % 2)), F.when(k % 7 == 0, "refurb").when(k % 7 == 1, "used"), F.when(k % 13 == 0, "set"),
    )
    return table(spark, sf, "part").select(
        k.alias("title_id"), brand.alias("brand_raw"), F.col("p_type").alias("category"), F.when(k % 3 == 0, F.concat(F.lit("88"), text(F.col("p_size")), F.lit("0"), text(k % 50))).otherwise("").alias("gtin"), title.alias("title"),
        F.concat(F.lit("M"), text(k % 6)).alias("market"), F.concat_ws("|", "p_brand", "p_name").alias("entity"),
    )


def v_seed(spark, sf) -> DataFrame:
    """Names to be matched: whole, shortened, and those of a colour only, with colour, size, category and domain."""
    k = F.col("p_partkey")
    name = F.when(k % 10 == 0, "red").when(k % 3 == 0, F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" kit"))).otherwise(F.concat("p_name", F.lit(" 500g")))
    return table(spark, sf, "part").select(
        k.alias("seed_id"), name.alias("name"), F.when(k % 3 == 0, "black").when(k % 3 == 1, "white").otherwise("blue").alias("color"), F.col("p_size").cast("string").alias("size"), F.col("p_type").alias("category"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "A").when(F.col("p_type") == "PROMO", "B").alias("domain"), F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string"), F.lit("-"), (k % 8).cast("string")).alias("style_code"),
    )


def v_extracted(spark, sf) -> DataFrame:
    """Catalogue rows that seeds are matched with."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        k.alias("row_id"), F.col("p_name").alias("name"), F.when(k % 4 == 0, "jet black").when(k % 4 == 1, "White").when(k % 4 == 2, "blue").otherwise("").alias("color"),
        F.concat_ws(",", F.col("p_size").cast("string"), (F.col("p_size") + 1).cast("string")).alias("sizes"), F.when(k % 5 == 0, "A").when(k % 5 == 1, "B").alias("domain"),
        F.when(k % 6 == 0, F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string"), F.lit("-"), (k % 8).cast("string"))).alias("style_code"),
    )


SQL = {
    "v_offer": """SELECT concat('P', CAST(l.l_partkey AS VARCHAR)) AS product_uid, p.p_type AS category, p.p_brand AS brand, s.s_name AS mall,
  CAST(floor(l.l_extendedprice / l.l_quantity * 100 + 0.5) AS BIGINT) AS price, CAST(floor(p.p_retailprice * 100 + 0.5) AS BIGINT) AS official_price,
  CAST(l.l_quantity AS INT) AS qty, CASE l.l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 2 ELSE 1 END AS product_type, CAST(l.l_shipdate AS DATE) AS day,
  concat(p.p_brand, ' ', p.p_name, ' ', CAST(p.p_size * 10 AS VARCHAR), 'g x', CAST(CAST(l.l_quantity AS INT) AS VARCHAR)) AS title
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "v_title": "SELECT p_partkey AS title_id, p_brand AS brand_raw, p_type AS category, concat(p_brand, ' ', p_name, ' ', CAST(p_size * 10 AS VARCHAR), 'g') AS title FROM part",
    "v_product": """SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS uid, concat('B:', p_name) AS parent_uid, p_name AS keyword, p_type AS category_l1,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey END AS ctlg_no, concat(CAST(p_size * 10 AS VARCHAR), 'g') AS size FROM part""",
    "v_catalog": """SELECT p_type AS source, p_brand AS brand, concat(p_brand, '-', CAST(p_size AS VARCHAR)) AS style_code, p_name AS name,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS material, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS origin,
  CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price, p_partkey AS seq FROM part""",
    "v_point": """SELECT c.c_mktsegment AS category, concat('C', CAST(o.o_custkey AS VARCHAR)) AS bundle_uid, concat('O', CAST(o.o_orderkey AS VARCHAR)) AS product_uid,
  concat(CASE o.o_orderpriority WHEN '1-URGENT' THEN 'verdict.strengths' WHEN '2-HIGH' THEN 'aspect.taste' WHEN '3-MEDIUM' THEN 'aspect.size'
    WHEN '4-NOT SPECIFIED' THEN 'verdict.weaknesses' ELSE 'context.when.scene' END, '.', lower(o.o_orderstatus)) AS dim_path,
  concat('point ', CAST(o.o_orderkey % 97 AS VARCHAR)) AS point, CAST(o.o_orderkey % 7 AS INT) AS cited, o.o_orderkey AS ord
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_source": "SELECT source AS product_uid, concat('S', CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS VARCHAR)) AS local_id, doc_id, lang, text AS body FROM documents",
    "v_citation": """SELECT doc_id AS citation_id, product_uid, concat('[s', CASE WHEN doc_id % 8 = 3 OR (doc_id % 8 = 5 AND doc_id % 16 >= 8) THEN '9999999' WHEN doc_id % 8 = 4 THEN '1' ELSE local_id[2:] END, ']') AS local_source_id,
  CASE doc_id % 8 WHEN 1 THEN replace(translate(s, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ', '  ') WHEN 2 THEN array_to_string(list_filter(string_split(s, ' '), lambda w, i: i % 4 <> 0), ' ')
    WHEN 5 THEN concat(md5(CAST(doc_id AS VARCHAR)), ' ', md5(concat('x', doc_id))) WHEN 6 THEN translate(s, 'aeio', '4310') WHEN 7 THEN concat(s, '?') ELSE s END AS quote,
  CASE doc_id % 3 WHEN 0 THEN 'point' WHEN 1 THEN 'answer' ELSE 'question' END AS role, doc_id % 3 = 2 AS allow_question, doc_id % 25 AS owner
  FROM (SELECT *, coalesce(list_filter(list_transform(regexp_split_to_array(body, '[.!?\n]+'), lambda x: trim(x)), lambda x: len(x) >= 20)[1], '') AS s FROM v_source)""",
    "v_evidence": """SELECT item_id AS evidence_id, concat('src', CAST(item_id % 20 AS VARCHAR)) AS product_uid, concat('[s', CAST(item_id % 10 + 1 AS VARCHAR), ']') AS local_source_id, text AS quote FROM benchmark""",
    "v_state": """SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS uid, CASE c_custkey % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'pending' WHEN 2 THEN 'empty' END AS status,
  CAST(c_custkey % 6 AS INT) AS attempts, CAST(c_custkey % 3 AS INT) AS n_dims, (c_custkey % 5 < 3) AS has_insight FROM customer""",
    "v_price_day": "SELECT product_uid, day, min(price) AS min_price, count(*) AS n FROM v_offer GROUP BY product_uid, day",
    "v_pair": "SELECT f.a, t.title_id AS b FROM v_title t JOIN (SELECT brand_raw, category, min(title_id) AS a FROM v_title GROUP BY brand_raw, category) f ON f.brand_raw = t.brand_raw AND f.category = t.category AND f.a < t.title_id",
    "v_listing": """SELECT p_partkey AS title_id, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS brand_raw, p_type AS category, CASE WHEN p_partkey % 3 = 0 THEN concat('88', p_size, '0', p_partkey % 50) ELSE '' END AS gtin,
  concat_ws(' ', CASE WHEN p_partkey % 11 <> 0 THEN p_brand END, p_name, CASE WHEN p_partkey % 4 <> 0 THEN concat('MX', p_partkey % 40, 'A') END, CASE p_partkey % 5 WHEN 0 THEN 'USB-C' WHEN 1 THEN 'Lightning' END, concat(p_size * 10, 'g'),
    CASE p_partkey % 3 WHEN 1 THEN '45W' WHEN 2 THEN '65W' END, concat('x', 1 + p_partkey % 2), CASE p_partkey % 7 WHEN 0 THEN 'refurb' WHEN 1 THEN 'used' END, CASE WHEN p_partkey % 13 = 0 THEN 'set' END) AS title,
  concat('M', p_partkey % 6) AS market, concat(p_brand, '|', p_name) AS entity FROM part""",
    "v_attr": """SELECT l.*, CASE WHEN p_partkey % 4 <> 0 THEN [concat('MX', p_partkey % 40, 'A')] ELSE []::VARCHAR[] END AS models, p_size * 10 AS grams, CASE p_partkey % 3 WHEN 1 THEN 45 WHEN 2 THEN 65 END AS watts, 1 + p_partkey % 2 AS pack,
  CASE WHEN split_part(p_name, ' ', 1) IN ('red', 'blue') THEN split_part(p_name, ' ', 1) END AS colour, CASE p_partkey % 5 WHEN 0 THEN 'usb_c' WHEN 1 THEN 'lightning' END AS connector, p_partkey % 13 = 0 AS bundle,
  CASE p_partkey % 7 WHEN 0 THEN 'refurb' WHEN 1 THEN 'used' ELSE 'new' END AS state, CASE WHEN split_part(p_name, ' ', 2) IN ('gear','plate','ring','widget','bolt') THEN [split_part(p_name, ' ', 2)] ELSE []::VARCHAR[] END AS lines,
  CASE WHEN split_part(p_name, ' ', 1) IN ('small', 'large') THEN split_part(p_name, ' ', 1) END AS size_token, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+')) AS toks FROM v_listing l JOIN part ON p_partkey = title_id""",
    "v_key": """SELECT title_id AS id, 'model' AS leg, concat(coalesce(brand_raw, '?'), '|', models[1]) AS key FROM v_attr WHERE len(models) > 0
  UNION ALL SELECT title_id, 'prefix', left(models[1], 5) FROM v_attr WHERE len(models) > 0
  UNION ALL SELECT title_id, 'numbers', concat_ws('|', brand_raw, grams, coalesce(CAST(watts AS VARCHAR), '-'), coalesce(colour, '-'), coalesce(connector, '-')) FROM v_attr WHERE brand_raw IS NOT NULL
  UNION ALL SELECT title_id, 'line', concat_ws('|', brand_raw, array_to_string(lines, '+'), category, size_token) FROM v_attr WHERE brand_raw IS NOT NULL AND size_token IS NOT NULL
  UNION ALL SELECT title_id, 'gtin', gtin FROM v_attr WHERE gtin <> ''""",
    "v_block": "SELECT x.id AS a, y.id AS b, string_agg(DISTINCT x.leg, '|' ORDER BY x.leg) AS legs FROM v_key x JOIN v_key y ON x.leg = y.leg AND x.key = y.key AND x.id < y.id GROUP BY x.id, y.id",
    "v_scored": """SELECT a, b, conflicts, round_even(CASE WHEN state_differs AND conflicts = '' THEN least(s, 0.66::DOUBLE) ELSE s END, 4) AS score, brand_ok, state_differs FROM (SELECT *, CASE WHEN conflicts <> '' OR brand_ok = false THEN least(raw, 0.30::DOUBLE) ELSE raw END AS s FROM (SELECT *,
  least(1.0::DOUBLE, CASE WHEN gtin_ok AND (coalesce(brand_ok, false) OR model_ok OR words > 0.30::DOUBLE) THEN 0.55::DOUBLE WHEN gtin_ok THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN model_ok THEN 0.45::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN brand_ok THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END + agree * 0.08::DOUBLE + words * 0.35::DOUBLE) AS raw FROM (
  SELECT p.a, p.b, x.brand_raw = y.brand_raw AS brand_ok, x.state <> y.state AS state_differs, x.gtin <> '' AND x.gtin = y.gtin AS gtin_ok, list_has_any(x.models, y.models) AS model_ok,
    len(list_intersect(x.toks, y.toks))::DOUBLE / len(list_distinct(list_concat(x.toks, y.toks))) AS words,
    (x.grams = y.grams)::INT + coalesce((x.watts = y.watts)::INT, 0) + (x.pack = y.pack)::INT + coalesce((x.colour = y.colour)::INT, 0) + coalesce((x.connector = y.connector)::INT, 0) AS agree,
    concat_ws('|', CASE WHEN len(x.models) > 0 AND len(y.models) > 0 AND NOT list_has_any(x.models, y.models) THEN 'model' END, CASE WHEN x.colour <> y.colour THEN 'colour' END, CASE WHEN x.connector <> y.connector THEN 'connector' END,
      CASE WHEN x.category <> y.category THEN 'category' END, CASE WHEN x.size_token <> y.size_token THEN 'size_token' END, CASE WHEN len(x.lines) > 0 AND len(y.lines) > 0 AND NOT list_has_any(x.lines, y.lines) THEN 'line' END,
      CASE WHEN x.grams <> y.grams THEN 'grams' END, CASE WHEN x.watts <> y.watts THEN 'watts' END, CASE WHEN x.pack <> y.pack THEN 'pack' END, CASE WHEN x.bundle <> y.bundle THEN 'bundle' END) AS conflicts
  FROM v_block p JOIN v_attr x ON x.title_id = p.a JOIN v_attr y ON y.title_id = p.b)))""",
    "v_routed": """SELECT *, CASE route WHEN 'merge' THEN 'strong evidence' WHEN 'review' THEN 'boundary' ELSE CASE WHEN conflicts <> '' THEN concat('conflict: ', split_part(conflicts, '|', 1)) WHEN brand_ok = false THEN 'brand mismatch' ELSE 'weak evidence' END END AS reason
  FROM (SELECT *, CASE WHEN score > 0.72 THEN 'merge' WHEN score >= 0.33 THEN 'review' ELSE 'reject' END AS route FROM v_scored)""",
    "v_judged": """SELECT a, b, score, conflicts, route, CASE route WHEN 'merge' THEN true WHEN 'reject' THEN false ELSE parted IS NULL END AS same, CASE WHEN route = 'review' THEN coalesce(parted, 'nothing against it') ELSE reason END AS reason
  FROM (SELECT *, CASE WHEN conflicts <> '' THEN concat('conflict: ', split_part(conflicts, '|', 1)) WHEN brand_ok = false THEN 'brand mismatch' WHEN state_differs THEN 'condition mismatch' END AS parted FROM v_routed)""",
    "v_entity": "SELECT title_id AS id, min(title_id) OVER (PARTITION BY entity) AS cluster_id FROM v_listing",
    "v_seed": """SELECT p_partkey AS seed_id, CASE WHEN p_partkey % 10 = 0 THEN 'red' WHEN p_partkey % 3 = 0 THEN concat(split_part(p_name, ' ', 2), ' kit') ELSE concat(p_name, ' 500g') END AS name, CASE p_partkey % 3 WHEN 0 THEN 'black' WHEN 1 THEN 'white' ELSE 'blue' END AS color,
  CAST(p_size AS VARCHAR) AS size, p_type AS category, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'A' WHEN p_type = 'PROMO' THEN 'B' END AS domain, concat(p_brand, '-', p_size, '-', p_partkey % 8) AS style_code FROM part""",
    "v_extracted": """SELECT p_partkey AS row_id, p_name AS name, CASE p_partkey % 4 WHEN 0 THEN 'jet black' WHEN 1 THEN 'White' WHEN 2 THEN 'blue' ELSE '' END AS color, concat(p_size, ',', p_size + 1) AS sizes, CASE p_partkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS domain,
  CASE WHEN p_partkey % 6 = 0 THEN concat(p_brand, '-', p_size, '-', p_partkey % 8) END AS style_code FROM part""",
}
NEEDS = {"v_citation": ["v_source"], "v_price_day": ["v_offer"], "v_pair": ["v_title"], "v_attr": ["v_listing"], "v_key": ["v_attr"], "v_block": ["v_key"], "v_scored": ["v_block", "v_attr"], "v_routed": ["v_scored"], "v_judged": ["v_routed"], "v_entity": ["v_listing"]}


def _needed(name: str) -> list[str]:
    return [x for n in NEEDS.get(name, []) for x in _needed(n)] + [name]


def with_views(sql: str) -> str:
    """sql with the views that it names put in front as common table expressions."""
    names: list[str] = []
    for name in SQL:
        if re.search(rf"\b{name}\b", sql):
            names += [n for n in dict.fromkeys(_needed(name)) if n not in names]
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[14:].strip()}"
    return f"WITH {ctes},\n{body[4:].strip()}" if body.upper().startswith("WITH") else f"WITH {ctes}\n{body}"
