"""Queries over nested records: taxonomies, FAQs, dotted pairs and raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.operators import nested as N
from skuweave.operators import shape as H
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_point, v_product


def _deep_points(spark, sf) -> DataFrame:
    """Points in dimensions of four to six parts, with up to two pieces of evidence each."""
    k, text = F.col("ord") % 3, lambda c: F.col(c).cast("string")
    deep = F.concat("dim_path", F.when(k == 0, ".k0").when(k == 1, ".k1.m").otherwise(".k2.m.n"))
    one = lambda i: F.struct(F.concat(F.lit(f"S{i}"), text("cited")).alias("source_id"), F.concat(F.lit("quote "), text("ord"), F.lit(f" of '{i}'")).alias("quote"), F.when(F.col("cited") % 2 == 0, "verified").otherwise("partial").alias("match"))
    return v_point(spark, sf).select("product_uid", deep.alias("dim_path"), "point", "cited", "ord", F.slice(F.array(one(0), one(1)), 1, k).alias("evidence"))


DEEP = """deep AS (SELECT product_uid, concat(dim_path, CASE ord % 3 WHEN 0 THEN '.k0' WHEN 1 THEN '.k1.m' ELSE '.k2.m.n' END) AS dim_path, point, cited, ord, ord % 3 AS n_evidence FROM v_point)"""


def _blocks(spark, sf) -> DataFrame:
    """Blocks of bundles: all points of a customer's orders as one tree, ordered inside a dimension."""
    p = _deep_points(spark, sf).join(v_point(spark, sf).select("product_uid", "bundle_uid"), "product_uid")
    return N.nest_points(p.drop("product_uid"), "bundle_uid")


@query("shp1_walk_points", f"WITH {DEEP} SELECT b.bundle_uid, d.dim_path, d.point, d.cited, d.n_evidence, row_number() OVER (PARTITION BY b.bundle_uid, d.dim_path ORDER BY d.ord) - 1 AS ord FROM deep d JOIN v_point b USING (product_uid)")
def shp1(spark, sf):
    return N.walk_points(_blocks(spark, sf), "bundle_uid").select("bundle_uid", "dim_path", "point", "cited", F.size("evidence").cast("long").alias("n_evidence"), "ord")


@query("shp4_point_evidence", f"""WITH {DEEP}, o AS (SELECT b.bundle_uid, d.*, row_number() OVER (PARTITION BY b.bundle_uid, d.dim_path ORDER BY d.ord) - 1 AS point_ord FROM deep d JOIN v_point b USING (product_uid))
 SELECT bundle_uid, dim_path, point_ord, i AS ord, concat('S', i, cited) AS local_source_id, concat('quote ', ord, ' of ''', i, '''') AS quote, CASE WHEN cited % 2 = 0 THEN 'verified' ELSE 'partial' END AS match FROM (SELECT *, unnest(range(n_evidence)) AS i FROM o)""")
def shp4(spark, sf):
    return N.point_evidence(N.walk_points(_blocks(spark, sf), "bundle_uid"), "bundle_uid")


TREES = """v AS (SELECT parent_uid, keyword, CASE WHEN ctlg_no % 9 = 0 THEN concat(size, '|x') WHEN ctlg_no % 7 = 0 THEN '' ELSE size END AS value, uid FROM v_product),
 o AS (SELECT *, row_number() OVER (PARTITION BY parent_uid ORDER BY uid) - 1 AS pos FROM v),
 r AS (SELECT *, CASE WHEN trim(value) = '' THEN 'empty' WHEN contains(value, '|') THEN 'separator' WHEN row_number() OVER (PARTITION BY parent_uid, value ORDER BY pos) > 1 THEN 'repeated' END AS reason FROM o)"""


def _trees(spark, sf) -> DataFrame:
    p = v_product(spark, sf).withColumn("value", F.when(F.col("ctlg_no") % 9 == 0, F.concat("size", F.lit("|x"))).when(F.col("ctlg_no") % 7 == 0, "").otherwise(F.col("size")))
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("uid", "value"))), lambda s: F.struct(s["value"].alias("value")))
    return p.groupBy("parent_uid", "keyword").agg(sizes.alias("sizes"))


@query("shp2_build_products", f"WITH {TREES} SELECT DISTINCT parent_uid AS uid, NULL AS parent_uid, keyword, 'package' AS type FROM r UNION ALL SELECT concat(parent_uid, '::', value), parent_uid, concat(keyword, ' ', value), 'variant' FROM r WHERE reason IS NULL")
def shp2(spark, sf):
    return H.build_products(_trees(spark, sf))[0]


@query("shp2_refused_sizes", f"WITH {TREES} SELECT parent_uid, pos, value, reason FROM r WHERE reason IS NOT NULL")
def shp2_refused(spark, sf):
    return H.build_products(_trees(spark, sf))[1]


FAQ = """q AS (SELECT conv_id, turn, text AS question, nxt AS answer FROM (SELECT *, lead(text) OVER w AS nxt, lead(role) OVER w AS nrole FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nrole = 'assistant'),
 f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ord FROM q)"""


def _faqs(spark, sf) -> DataFrame:
    """Blocks of FAQs as JSON: a user's turn is the question, the next turn the answer; both are quoted."""
    c = table(spark, sf, "conversations")
    nxt = lambda col: F.expr(f"lead({col}) over (partition by conv_id order by turn)")
    c = c.withColumns({"answer": nxt("text"), "nrole": nxt("role")}).where("role = 'user' and nrole = 'assistant'")
    quote = lambda col, n: F.struct(F.concat(F.lit("S"), F.col("turn").cast("string")).alias("source_id"), F.left(col, F.lit(n)).alias("quote"), F.lit("verified").alias("match"))
    f = F.struct("turn", F.col("text").alias("question"), F.col("answer").alias("short_answer"), (F.col("turn") % 3).alias("cited_examples"), F.array(quote("answer", 20), quote("answer", 40)).alias("answer_evidence"), F.slice(F.array(quote("text", 15)), 1, (F.col("turn") / 2).cast("int") % 2).alias("question_evidence"))
    return c.groupBy("conv_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list(f)), lambda x: x.dropFields("turn"))).alias("faqs"))


@query("shp5_faq_rows", f"WITH {FAQ} SELECT conv_id, ord, question, answer AS short_answer, CAST(turn % 3 AS INT) AS cited FROM f")
def shp5(spark, sf):
    return N.faq_rows(_faqs(spark, sf), "conv_id").select("conv_id", "ord", "question", "short_answer", "cited")


@query("shp5_faq_evidence", f"""WITH {FAQ} SELECT conv_id, ord AS faq_ord, 'answer' AS role, i AS ord, concat('S', turn) AS local_source_id, left(answer, 20 + 20 * i) AS quote, 'verified' AS match FROM (SELECT *, unnest([0, 1]) AS i FROM f)
 UNION ALL SELECT conv_id, ord, 'question', 0, concat('S', turn), left(question, 15), 'verified' FROM f WHERE turn // 2 % 2 = 1""")
def shp5_evidence(spark, sf):
    return N.faq_evidence(N.faq_rows(_faqs(spark, sf), "conv_id"), "conv_id")


@query("shp10_faq_chunks", f"""WITH {FAQ}, b AS (SELECT *, trim(concat('conversation ', conv_id, ' - Q: ', question, ' A: ', coalesce(answer, ''))) AS body FROM f)
 SELECT conv_id, 'faq' AS kind, ord AS ref_id, md5(body) AS content_hash, concat('conversation=', conv_id, '|cited=', turn % 3, '|qa=true') AS metadata FROM b""")
def shp10_faq(spark, sf):
    head = F.concat(F.lit("conversation "), F.col("conv_id").cast("string"))
    c = N.faq_chunks(N.faq_rows(_faqs(spark, sf), "conv_id"), head, {"conversation": F.col("conv_id"), "cited": F.col("cited")}, "conv_id")
    return c.select("conv_id", "kind", "ref_id", "content_hash", F.array_join(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("metadata"))


@query("shp18_json_pairs", """WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS i FROM lineitem),
 s AS (SELECT l_orderkey, string_agg(l_partkey, ', ' ORDER BY i) FILTER (i < 10) AS parts FROM l GROUP BY l_orderkey)
 SELECT o_orderkey, '@type' AS name, 'order' AS value FROM orders UNION ALL SELECT o_orderkey, 'customer.key', CAST(o_custkey AS VARCHAR) FROM orders UNION ALL SELECT o_orderkey, 'customer.at.deep.status', o_orderstatus FROM orders
 UNION ALL SELECT l_orderkey, concat('lines.', i, '.part'), CAST(l_partkey AS VARCHAR) FROM l WHERE i < 2 UNION ALL SELECT l_orderkey, concat('lines.', i, '.odd'), CASE WHEN l_partkey % 2 = 1 THEN 'true' ELSE 'false' END FROM l WHERE i < 2
 UNION ALL SELECT l_orderkey, 'parts', parts FROM s""")
def shp18(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").alias("part"), (F.col("l_partkey") % 2 == 1).alias("odd")))).alias("lines"))
    o = table(spark, sf, "orders").join(li, F.expr("o_orderkey = l_orderkey"), "left")
    customer = F.struct(F.col("o_custkey").alias("key"), F.lit("x").alias("@id"), F.struct(F.struct(F.col("o_orderstatus").alias("status"), F.lit("").alias("none")).alias("deep")).alias("at"))
    row = F.struct(F.lit("order").alias("@type"), F.col("o_orderkey").alias("@id"), customer.alias("customer"), F.transform("lines", lambda x: x.dropFields("l_linenumber")).alias("lines"), F.transform("lines", lambda x: x["part"]).alias("parts"), F.array().alias("empty"))
    return N.flatten_json(o.select("o_orderkey", F.to_json(row).alias("j")), "o_orderkey", "j")


@query("src5_attribute_bags", "SELECT k AS name, count(*) AS n, count(DISTINCT json_extract_string(props, concat('$.', k))) AS n_values FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY k")
def src5(spark, sf):
    return N.flatten_json(table(spark, sf, "events"), "event_id", "props").groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


def v_page(spark, sf) -> DataFrame:
    """Pages with the markup of a product: JSON-LD (one block broken, one a graph), meta pairs, a table of notices, options."""
    p = table(spark, sf, "pages").join(table(spark, sf, "part"), F.expr("p_partkey = page_id + 1"))
    offer = lambda i: F.struct((F.col("p_size") + i).alias("price"), F.struct(F.concat(F.lit(f"M{i}-"), "p_brand").alias("name"), F.lit("z").alias("@id")).alias("seller"))
    product = F.struct(F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.array("p_size", F.col("p_size") + 1).alias("sizes"), F.array(offer(0), offer(1), offer(2)).alias("offers"))
    graph = F.struct(F.array(F.struct(F.lit("WebPage").alias("@type"), F.col("url"), F.lit(None).cast("string").alias("name")), F.struct(F.lit("Product").alias("@type"), F.lit(None).cast("string").alias("url"), F.concat("p_name", F.lit(" again")).alias("name"))).alias("@graph"))
    ld = lambda j: F.concat(F.lit('<script type="application/ld+json">'), j, F.lit("</script>"))
    return p.select("page_id", F.concat(
        "html", ld(F.to_json(product)), ld(F.lit("{broken")), F.when(F.col("page_id") % 3 == 0, ld(F.to_json(graph))).otherwise(""),
        F.lit('<meta property="og:title" content="'), "p_name", F.lit('"/><meta name="product:price" content=" "/><meta name="product:brand" content="first"/><meta name="product:brand" content="'), "p_brand",
        F.lit('"/><table><tr><th>Material</th><td><b>'), "p_type", F.lit("</b></td></tr><tr><th>Weather</th><td>fine</td></tr><tr><th> origin </th>\n<td>A &amp;  B</td></tr><tr><th>origin</th><td>second</td></tr></table>"),
        F.lit('<select><option value="">Choose one</option><option value="0">choose a size</option><option value="1">'), F.col("p_size").cast("string"), F.lit('</option><option value="2"> big  one </option></select>'),
    ).alias("html"))


@query("src7_page_facts", """WITH p AS (SELECT * FROM pages JOIN part ON p_partkey = page_id + 1), again AS (SELECT *, page_id % 3 = 0 AS twice FROM p)
 SELECT page_id, 'title' AS kind, 'title' AS name, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS value FROM p WHERE regexp_extract(html, '(?s)<title>(.*?)</title>', 1) <> ''
 UNION ALL SELECT page_id, 'jsonld', '@type', 'Product' FROM p UNION ALL SELECT page_id, 'jsonld', 'name', CASE WHEN twice THEN concat(p_name, ' again') ELSE p_name END FROM again UNION ALL SELECT page_id, 'jsonld', 'brand.name', p_brand FROM p
 UNION ALL SELECT page_id, 'jsonld', 'sizes', concat(p_size, ', ', p_size + 1) FROM p UNION ALL SELECT page_id, 'jsonld', concat('offers.', i, '.price'), CAST(p_size + i AS VARCHAR) FROM p, (SELECT unnest([0, 1]) AS i)
 UNION ALL SELECT page_id, 'jsonld', concat('offers.', i, '.seller.name'), concat('M', i, '-', p_brand) FROM p, (SELECT unnest([0, 1]) AS i) UNION ALL SELECT page_id, 'jsonld', 'url', left(url, 120) FROM again WHERE twice
 UNION ALL SELECT page_id, 'meta', 'og:title', p_name FROM p UNION ALL SELECT page_id, 'meta', 'product:brand', p_brand FROM p UNION ALL SELECT page_id, 'spec', 'Material', p_type FROM p WHERE regexp_matches('Material', 'material') UNION ALL SELECT page_id, 'spec', 'origin', 'A & B' FROM p
 UNION ALL SELECT page_id, 'option', '0', CAST(p_size AS VARCHAR) FROM p UNION ALL SELECT page_id, 'option', '1', 'big one' FROM p""")
def src7(spark, sf):
    return N.page_facts(v_page(spark, sf))
