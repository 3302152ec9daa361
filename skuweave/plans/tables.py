"""Queries over shaping, joins, upserts, audits and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.functions import text as A
from skuweave.operators import prices as P
from skuweave.operators import shape as H
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_catalog, v_extracted, v_listing, v_offer, v_point, v_product, v_seed, v_state, v_title


@query("shp7_catalog_rows", "SELECT parent_uid, size, ctlg_no, uid AS disp FROM v_product")
def shp7(spark, sf):
    return H.catalog_rows(H.trees_of(v_product(spark, sf)))


@query("src2_tree_scan", "SELECT parent_uid, count(DISTINCT size) AS n_sizes, count(*) AS n_counts FROM v_product GROUP BY parent_uid")
def src2(spark, sf):
    return H.catalog_rows(H.trees_of(v_product(spark, sf))).groupBy("parent_uid").agg(F.countDistinct("size").alias("n_sizes"), F.count("*").alias("n_counts"))


@query("shp3_sources", "SELECT source AS product_uid, doc_id, lang, n_chars, DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS day FROM documents")
def shp3(spark, sf):
    """Maps of a product's sources, in blocks of ids, so that no map holds all of a hot product."""
    d = table(spark, sf, "documents").withColumn("posted", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")), "yyyyMMdd"))
    m = d.groupBy(F.col("source").alias("product_uid"), F.floor(F.col("doc_id") / 1000).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("doc_id", F.struct("lang", "n_chars", "posted")))).alias("m"))
    return H.flatten_sources(m, "product_uid", "m", "posted").withColumnRenamed("source_id", "doc_id")


@query("shp4_evidence_order", "SELECT item_id, i - 1 AS pos, w FROM (SELECT item_id, unnest(a) AS w, unnest(range(1, len(a) + 1)) AS i FROM (SELECT item_id, string_split(text, ' ') AS a FROM benchmark))")
def shp4(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.posexplode_outer(F.split("text", " ")).alias("pos", "w"))


@query("shp5_faq", "SELECT conv_id, turn, text AS question, nxt AS answer FROM (SELECT *, lead(text) OVER w AS nxt, lead(role) OVER w AS nrole FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nrole = 'assistant'")
def shp5(spark, sf):
    c = table(spark, sf, "conversations").withColumn("answer", F.expr("lead(text) over (partition by conv_id order by turn)")).withColumn("nrole", F.expr("lead(role) over (partition by conv_id order by turn)"))
    return c.where("role = 'user' and nrole = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


@query("ag35_faq_merge", "SELECT arg_min(text, struct_pack(c := conv_id, t := turn)) AS question, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY lower(trim(text))")
def ag35(spark, sf):
    c = table(spark, sf, "conversations").where("role = 'user'")
    return c.groupBy(F.lower(F.trim("text")).alias("k")).agg(F.min_by("text", F.struct("conv_id", "turn")).alias("question"), F.count("*").alias("n")).drop("k")


@query("shp6_note_dedup", "SELECT d.doc_id, h.first_id FROM documents d JOIN (SELECT md5(text) AS h, min(doc_id) AS first_id FROM documents GROUP BY 1) h ON h.h = md5(d.text)")
def shp6(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    return d.join(d.groupBy("h").agg(F.min("doc_id").alias("first_id")), "h").select("doc_id", "first_id")


@query("shp8_seed_rows", "SELECT parent_uid, ctlg_no, size FROM v_product WHERE ctlg_no IS NOT NULL UNION ALL SELECT DISTINCT parent_uid, NULL, NULL FROM v_product WHERE parent_uid NOT IN (SELECT parent_uid FROM v_product WHERE ctlg_no IS NOT NULL)")
def shp8(spark, sf):
    return H.seed_rows(v_product(spark, sf))


@query("shp14_slim_shop", "WITH o AS (SELECT *, substr(title, 1, 30) AS model FROM v_offer), t AS (SELECT brand, model, string_agg(mall, '|' ORDER BY n DESC, mall) AS top_malls FROM (SELECT brand, model, mall, count(*) AS n, row_number() OVER (PARTITION BY brand, model ORDER BY count(*) DESC, mall) AS r FROM o GROUP BY brand, model, mall) WHERE r <= 3 GROUP BY brand, model) SELECT o.brand, o.model, count(*) AS n, min(price) AS low, max(price) AS high, count(DISTINCT mall) AS n_malls, string_agg(DISTINCT category, '|' ORDER BY category) AS categories, string_agg(DISTINCT product_uid, '|' ORDER BY product_uid) AS skus, any_value(top_malls) AS top_malls FROM o JOIN t ON t.brand = o.brand AND t.model = o.model GROUP BY o.brand, o.model")
def shp14(spark, sf):
    return P.slim_shop(v_offer(spark, sf))


@query("shp15_facts_of_row", "SELECT seq, (material <> '')::INT + (origin <> '')::INT AS n_notice, 4 AS n_facts FROM v_catalog")
def shp15(spark, sf):
    f = H.facts_of_row(v_catalog(spark, sf), ("seq", "source"), ("material", "origin"))
    return f.select("seq", F.size("notice").alias("n_notice"), F.size("facts").alias("n_facts"))


@query("shp17_parse_spec", "SELECT p_partkey, k AS key, v AS value FROM (SELECT p_partkey, 'container' AS k, p_type AS v FROM part UNION ALL SELECT p_partkey, 'brand', p_brand FROM part)")
def shp17(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("[basic] / container: "), "p_type", F.lit(" / brand: "), "p_brand").alias("spec"))
    e = p.select("p_partkey", F.explode(F.split("spec", " / ")).alias("e")).where(F.contains("e", F.lit(":")))
    return e.select("p_partkey", F.trim(F.substring_index("e", ":", 1)).alias("key"), F.trim(F.expr("substr(e, instr(e, ':') + 1)")).alias("value"))


@query("shp19_item_union", "SELECT 'comment' AS kind, concat('c', conv_id, '-', turn) AS id, text AS body FROM conversations WHERE role = 'user' UNION ALL SELECT 'reply', concat('c', conv_id, '-', turn), text FROM conversations WHERE role <> 'user' UNION ALL SELECT 'review', concat('d', doc_id), text FROM documents")
def shp19(spark, sf):
    c = table(spark, sf, "conversations").select(F.when(F.col("role") == "user", "comment").otherwise("reply").alias("kind"), F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("body"))
    return c.unionByName(table(spark, sf, "documents").select(F.lit("review").alias("kind"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("body")))


@query("shp20_official_pages", "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '(list|search|category)')")
def shp20(spark, sf):
    return table(spark, sf, "pages").where(~F.col("url").rlike("(list|search|category)")).select("page_id", "url")


@query("shp21_fact_struct", "SELECT p_partkey, 2 + (p_size > 25)::INT AS n_facts FROM part")
def shp21(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name", F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).alias("size"))
    return H.facts_of_row(p, ("p_partkey",), ()).select("p_partkey", F.size("facts").alias("n_facts"))


@query("src4_catalogs", "SELECT source, brand, style_code, name, price FROM v_catalog WHERE source IN (SELECT source FROM v_catalog GROUP BY source HAVING count(*) >= 3)")
def src4(spark, sf):
    c = v_catalog(spark, sf)
    return c.join(c.groupBy("source").count().where("count >= 3").select("source"), "source", "left_semi").select("source", "brand", "style_code", "name", "price")


@query("src6_warehouse_by_keys", "SELECT p_partkey, p_name, n FROM part JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey WHERE p_partkey IN (SELECT ps FROM (SELECT DISTINCT l_partkey AS ps FROM lineitem WHERE l_quantity > 49))")
def src6(spark, sf):
    li = table(spark, sf, "lineitem")
    keys = li.where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return table(spark, sf, "part").join(keys, "p_partkey", "left_semi").join(li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n")), "p_partkey").select("p_partkey", "p_name", "n")


@query("src8_pending_units", "SELECT o_orderkey FROM orders ANTI JOIN (SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_quantity > 25) l USING (o_orderkey) ORDER BY o_orderkey LIMIT 500")
def src8(spark, sf):
    done = table(spark, sf, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti").orderBy("o_orderkey").limit(500)


@query("snk3_replace_by_key", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 7 <> 0 UNION ALL SELECT o_orderkey, o_custkey, 'X' FROM orders WHERE o_custkey % 7 = 0 AND o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o WHERE o_custkey % 7 = 0 AND NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = o.o_custkey AND x.o_orderkey % 2 = 0)")
def snk3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return H.replace_by_key(o, o.where("o_custkey % 7 = 0 and o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_custkey"])


@query("snk4_merge_preserving", "SELECT n.uid, CASE WHEN o.status = 'done' THEN o.status ELSE 'pending' END AS status, CASE WHEN o.status = 'done' OR (o.status = 'pending' AND o.attempts > 0) THEN o.attempts ELSE 0 END AS attempts, CASE WHEN o.status = 'done' THEN o.n_dims ELSE 0 END AS n_dims FROM v_state n LEFT JOIN v_state o ON o.uid = n.uid")
def snk4(spark, sf):
    s = v_state(spark, sf)
    fresh = s.select("uid", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(0).alias("n_dims"))
    return H.merge_preserving(fresh, s)


@query("snk5_upsert_labels", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END AS quality FROM labels")
def snk5(spark, sf):
    """Old labels of all documents and new ones of every third: the new ones overwrite."""
    x = table(spark, sf, "labels").select("doc_id", "quality")
    return H.upsert_labels(x, x.where("doc_id % 3 = 0").withColumn("quality", 1 - F.col("quality")), "doc_id", overwrite=True)


@query("snk5_insert_labels", "SELECT doc_id, coalesce(quality, 2) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def snk5_insert(spark, sf):
    """Without overwriting only documents that have no label get the new one."""
    x = table(spark, sf, "labels").select("doc_id", "quality")
    new = table(spark, sf, "documents").select("doc_id", F.lit(2).cast(x.schema["quality"].dataType).alias("quality"))
    return H.upsert_labels(x, new, "doc_id", overwrite=False)


@query("snk6_drop_old_runs", "SELECT doc_id, lang, 'run2' AS run FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def snk6(spark, sf):
    """Rows of two runs, the second one over all documents: the first run's go, and so do those whose label is gone."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    rows = d.withColumn("run", F.lit("run1")).union(d.withColumn("run", F.lit("run2")))
    return H.current_run(rows, "run", "run2", table(spark, sf, "labels"), "doc_id")


@query("jn5_strong_keys", "WITH s AS (SELECT seed_id, style_code, CASE WHEN seed_id % 2 = 0 THEN concat('B', seed_id % 700) ELSE '' END AS barcode FROM v_seed), r AS (SELECT row_id, style_code, CASE WHEN row_id % 9 = 0 THEN concat('B', row_id % 700) END AS barcode FROM v_extracted), a AS (SELECT style_code, min(row_id) AS m FROM r WHERE style_code <> '' GROUP BY 1), b AS (SELECT barcode, min(row_id) AS m FROM r WHERE barcode <> '' GROUP BY 1) SELECT seed_id, coalesce(a.m, b.m) AS match_id, CASE WHEN a.m IS NOT NULL THEN 'style_code' ELSE 'barcode' END AS method FROM s LEFT JOIN a USING (style_code) LEFT JOIN b USING (barcode) WHERE coalesce(a.m, b.m) IS NOT NULL")
def jn5(spark, sf):
    k = F.col("seed_id")
    s = v_seed(spark, sf).withColumn("barcode", F.when(k % 2 == 0, F.concat(F.lit("B"), (k % 700).cast("string"))).otherwise(""))
    r = v_extracted(spark, sf).withColumn("barcode", F.when(F.col("row_id") % 9 == 0, F.concat(F.lit("B"), (F.col("row_id") % 700).cast("string"))))
    return H.strong_key_match(s, r, "seed_id", "row_id", ("style_code", "barcode"))


GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}), 2)), lambda i: substr({0}, i, 2)))"


@query("jn8_attach_facts", "SELECT parent_uid, CASE WHEN bool_or(coalesce(n_facts > 0, false)) THEN 'done' ELSE 'empty' END AS status, CAST(sum(coalesce(n_facts, 0)) AS BIGINT) AS n_facts, arg_min(brand, ctlg_no) FILTER (coalesce(brand, '') <> '') AS brand FROM v_product p LEFT JOIN (SELECT p_partkey AS k, p_size % 3 AS n_facts, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS brand FROM part WHERE p_partkey % 2 = 0) f ON f.k = p.ctlg_no GROUP BY parent_uid")
def jn8(spark, sf):
    facts = table(spark, sf, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("ctlg_no"), (F.col("p_size") % 3).alias("n_facts"), F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_brand")).alias("brand"))
    return H.attach_facts(v_product(spark, sf), facts)


@query("jn9_fill_missing", "SELECT c.seq, CASE WHEN c.material <> '' THEN c.material ELSE coalesce(e.m, '') END AS material, CASE WHEN c.origin <> '' THEN c.origin ELSE coalesce(e.o, '') END AS origin FROM v_catalog c LEFT JOIN (SELECT l_partkey, arg_min(l_returnflag, struct_pack(o := l_orderkey, l := l_linenumber, m := l_returnflag)) FILTER (l_returnflag <> 'N') AS m, arg_min(l_linestatus, struct_pack(o := l_orderkey, l := l_linenumber, m := l_linestatus)) AS o FROM lineitem GROUP BY l_partkey) e ON e.l_partkey = c.seq")
def jn9(spark, sf):
    """Many rows of a key in the source: the earliest that has a value fills."""
    blank = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    extra = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("seq"), blank.alias("material"), F.col("l_linestatus").alias("origin"), F.struct("l_orderkey", "l_linenumber").alias("at"))
    return H.fill_missing(v_catalog(spark, sf).select("seq", "material", "origin"), extra, "seq", ("material", "origin"), order="at")


VOTE = "SELECT parent_uid, category FROM (SELECT parent_uid, category_l1 AS category, row_number() OVER (PARTITION BY parent_uid ORDER BY count(*) DESC, category_l1) AS r FROM v_product GROUP BY ALL) WHERE r = 1"


@query("ag6_category_vote", VOTE.replace("GROUP BY ALL", "GROUP BY parent_uid, category_l1"))
def ag6(spark, sf):
    return P.top_values(v_product(spark, sf), ["parent_uid"], "category_l1", 1).select("parent_uid", F.col("category_l1").alias("category"))


@query("jn10_category_propagation", f"SELECT p.uid, v.category FROM v_product p JOIN ({VOTE.replace('GROUP BY ALL', 'GROUP BY parent_uid, category_l1')}) v ON v.parent_uid = p.parent_uid")
def jn10(spark, sf):
    p = v_product(spark, sf)
    return p.join(P.top_values(p, ["parent_uid"], "category_l1", 1).select("parent_uid", F.col("category_l1").alias("category")), "parent_uid").select("uid", "category")


@query("jn12_verdict_cache", "SELECT d.doc_id, coalesce(l.toxic = 0, true) AS keep FROM documents d LEFT JOIN labels l ON sha1(CAST(l.doc_id AS VARCHAR)) = sha1(CAST(d.doc_id AS VARCHAR))")
def jn12(spark, sf):
    cache = table(spark, sf, "labels").select(F.sha1(F.col("doc_id").cast("string")).alias("k"), (F.col("toxic") == 0).alias("same"))
    return table(spark, sf, "documents").select("doc_id", F.sha1(F.col("doc_id").cast("string")).alias("k")).join(cache, "k", "left").select("doc_id", F.coalesce("same", F.lit(True)).alias("keep"))


@query("jn14_unlabelled", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def jn14(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query("jn15_labelled", "SELECT doc_id, lang FROM documents SEMI JOIN labels USING (doc_id)")
def jn15(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left_semi")


@query("wn9_first_wins", "SELECT brand, style_code, min(seq) AS seq FROM v_catalog GROUP BY brand, style_code")
def wn9(spark, sf):
    return H.first_wins(v_catalog(spark, sf), ["brand", "style_code"], "seq").select("brand", "style_code", "seq")


@query("wn12_budget_cut", "SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 90")
def wn12(spark, sf):
    top = table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(90)
    return top.select("o_orderkey", F.expr("row_number() over (order by o_totalprice desc, o_orderkey)").alias("place"))


@query("tk3_per_category_cap", "SELECT p_partkey, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 2 ORDER BY r, p_partkey LIMIT 100")
def tk3(spark, sf):
    p = table(spark, sf, "part").withColumn("r", F.expr("row_number() over (partition by p_type order by p_retailprice desc, p_partkey)")).where("r <= 2")
    return p.orderBy("r", "p_partkey").limit(100).select("p_partkey", "p_type")


@query("tk4_top_mentions", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20")
def tk4(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(20)


@query("tk5_cosine_top_k", "WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings) SELECT query_id, vec_id, cosine, place FROM (SELECT q.vec_id AS query_id, v.vec_id, round_even(list_cosine_similarity(q.e, v.e), 6) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round_even(list_cosine_similarity(q.e, v.e), 6) DESC, v.vec_id) AS place FROM v q JOIN v ON v.label = q.label AND v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0) WHERE place <= 5")
def tk5(spark, sf):
    e = table(spark, sf, "embeddings")
    return H.cosine_top_k(e, e.where("vec_id % 20 = 0"), 5)


@query("st2_pair_sets", "WITH t AS (SELECT a, b FROM v_pair WHERE a % 2 = 0), f AS (SELECT a, b FROM v_pair WHERE b % 3 = 0) SELECT a, b, CASE WHEN (a, b) IN (SELECT (a, b) FROM t) AND (a, b) IN (SELECT (a, b) FROM f) THEN 'both' WHEN (a, b) IN (SELECT (a, b) FROM t) THEN 'missed' ELSE 'wrong' END AS kind FROM (FROM t UNION FROM f)")
def st2(spark, sf):
    """Each pair of truth or prediction: found by both, missed, or wrongly predicted."""
    from skuweave.plans.views import v_pair

    p = v_pair(spark, sf)
    return H.pair_sets(p.where("a % 2 = 0"), p.where("b % 3 = 0"))


@query("st3_subset_check", "SELECT count(*) AS missing FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))")
def st3(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct().join(table(spark, sf, "part"), "p_partkey", "left_anti").agg(F.count("*").alias("missing"))


@query("st6_crawl_union", "SELECT seq, brand FROM v_catalog")
def st6(spark, sf):
    """Crawls that overlap: those with a material, those with an origin, and all that have a price."""
    c = v_catalog(spark, sf)
    return c.where("material <> ''").union(c.where("origin <> ''")).union(c.where("price > 0")).dropDuplicates(["seq"]).select("seq", "brand")


RATE = "round_even(count(*) FILTER ({0} <> '') * 100.0::DOUBLE / count(*), 1) AS {0}_pct"


@query("ag7_fill_rates", f"SELECT brand, count(*) AS n, {RATE.format('material')}, {RATE.format('origin')}, {RATE.format('name')} FROM v_catalog GROUP BY brand")
def ag7(spark, sf):
    return H.fill_rates(v_catalog(spark, sf), "brand", ("material", "origin", "name"))


@query("ag8_brand_leaderboard", "SELECT c.brand, count(*) AS n, min(price) AS low, CAST(floor(quantile_cont(price, 0.5)) AS BIGINT) AS mid, max(price) AS high, round_even(count(*) FILTER (material <> '') * 100.0::DOUBLE / count(*), 1) AS material_pct, round_even(count(*) FILTER (origin <> '') * 100.0::DOUBLE / count(*), 1) AS origin_pct, any_value(m.source) AS modal_source FROM v_catalog c JOIN (SELECT brand, source FROM (SELECT brand, source, row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, source) AS r FROM v_catalog GROUP BY brand, source) WHERE r = 1) m ON m.brand = c.brand GROUP BY c.brand")
def ag8(spark, sf):
    c = v_catalog(spark, sf)
    prices = c.groupBy("brand").agg(F.min("price").alias("low"), S.median_floor("price").alias("mid"), F.max("price").alias("high"))
    modal = P.top_values(c, ["brand"], "source", 1).select("brand", F.col("source").alias("modal_source"))
    return H.fill_rates(c, "brand", ("material", "origin")).join(prices, "brand").join(modal, "brand")


@query("ag20_progress", "SELECT count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status IS NULL OR status = 'pending') AS remaining FROM v_state")
def ag20(spark, sf):
    s = F.col("status")
    return v_state(spark, sf).agg(F.count("*").alias("total"), F.count_if(s == "done").alias("done"), F.count_if(s == "empty").alias("empty"), F.count_if(s.isNull() | (s == "pending")).alias("remaining"))


@query("ag21_kpi_row", "SELECT count(*) AS n, count(*) FILTER (price > 0) AS priced, count(*) FILTER (material <> '') AS with_material, count(DISTINCT source) AS categories, count(DISTINCT brand) AS brands FROM v_catalog")
def ag21(spark, sf):
    return v_catalog(spark, sf).agg(F.count("*").alias("n"), F.count_if(F.col("price") > 0).alias("priced"), F.count_if(F.col("material") != "").alias("with_material"), F.countDistinct("source").alias("categories"), F.countDistinct("brand").alias("brands"))


@query("ag24_fixed_or_varying", "SELECT p_name, count(DISTINCT p_brand) = 1 AS brand_fixed, count(DISTINCT p_size) = 1 AS size_fixed, count(*) AS n FROM part GROUP BY p_name")
def ag24(spark, sf):
    return table(spark, sf, "part").groupBy("p_name").agg((F.countDistinct("p_brand") == 1).alias("brand_fixed"), (F.countDistinct("p_size") == 1).alias("size_fixed"), F.count("*").alias("n"))


@query("ag27_rating", "SELECT source, CASE WHEN count(quality) >= 3 THEN round_even(sum(quality)::DOUBLE / count(quality), 4) END AS rating, count(quality) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source")
def ag27(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return j.groupBy("source").agg(F.when(F.count("quality") >= 3, F.bround(F.sum("quality") / F.count("quality"), 4)).alias("rating"), F.count("quality").alias("n"))


@query("ag29_source_counts", "SELECT source, lang, count(*) AS n, count(*) FILTER (contains(lower(text), 'license')) AS n_ads FROM documents GROUP BY source, lang")
def ag29(spark, sf):
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.contains(F.lower("text"), F.lit("license"))).alias("n_ads"))


@query("ag31_catalog_audit", "SELECT count(*) AS n, count(*) - count(DISTINCT style_code) AS n_duplicate_keys, count(*) FILTER (material = '') AS n_empty FROM v_catalog")
def ag31(spark, sf):
    return v_catalog(spark, sf).agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct("style_code")).alias("n_duplicate_keys"), F.count_if(F.col("material") == "").alias("n_empty"))


@query("ag34_usage_cost", "SELECT event_type, CAST(sum(CAST(round(value * 100) AS BIGINT) * length(event_type)) AS BIGINT) AS cost, count(*) AS n FROM events GROUP BY event_type")
def ag34(spark, sf):
    """Units used, priced by a table of prices: here a model's price is the length of its name."""
    e = table(spark, sf, "events").select("event_type", F.round(F.col("value") * 100, 0).cast("bigint").alias("units"))
    prices = e.select("event_type").distinct().withColumn("unit_price", F.length("event_type").cast("bigint"))
    return H.usage_cost(e, prices, "event_type", "units")


@query("ag36_size_range", "SELECT p_name, min(p_size) AS first_size, max(p_size) AS last_size, count(DISTINCT p_size) AS n_sizes, count(DISTINCT p_size) FILTER (p_partkey % 5 = 0) AS sold_out, concat('88', min(p_partkey)) AS gtin FROM part GROUP BY p_name")
def ag36(spark, sf):
    p = table(spark, sf, "part").select("p_name", "p_size", (F.col("p_partkey") % 5 == 0).alias("gone"), "p_partkey")
    return H.size_range(p, "p_name", "p_size", "gone", "p_partkey").withColumn("gtin", F.concat(F.lit("88"), F.col("first_id").cast("string"))).drop("first_id")


@query("flt4_size_mismatch", "SELECT a, b, s.p_size <> t.p_size AS mismatch FROM v_pair JOIN part s ON s.p_partkey = a JOIN part t ON t.p_partkey = b")
def flt4(spark, sf):
    from skuweave.plans.views import v_pair

    t = v_title(spark, sf).select("title_id", A.unit_sizes("title").alias("s"))
    j = v_pair(spark, sf).join(t.withColumnsRenamed({"title_id": "a", "s": "sa"}), "a").join(t.withColumnsRenamed({"title_id": "b", "s": "sb"}), "b")
    return j.select("a", "b", A.size_mismatch("sa", "sb").alias("mismatch"))


@query("flt7_queue", "SELECT uid FROM v_state WHERE status IS NULL OR status = 'pending' OR (status = 'empty' AND attempts < 3)")
def flt7(spark, sf):
    s = F.col("status")
    return v_state(spark, sf).where(s.isNull() | (s == "pending") | ((s == "empty") & (F.col("attempts") < 3))).select("uid")


@query("flt8_target_filter", "SELECT title_id FROM v_listing JOIN part ON p_partkey = title_id WHERE list_has_all(string_split(lower(title), ' '), ['x2']) AND list_has_any(string_split(lower(title), ' '), ['widget', 'rod', 'ring']) AND p_size % 2 = 0")
def flt8(spark, sf):
    """All of the required words, one of the others, and one of the wanted sizes exactly."""
    sizes = [f"{20 * i}g" for i in range(1, 26)]
    return H.target_filter(v_listing(spark, sf), "title", ("x2",), ("widget", "rod", "ring"), sizes).select("title_id")


@query("flt9_facets", "SELECT seq FROM v_catalog WHERE material <> '' AND price > 0 AND contains(name, 'e')")
def flt9(spark, sf):
    return v_catalog(spark, sf).where((F.col("material") != "") & (F.col("price") > 0) & F.contains("name", F.lit("e"))).select("seq")


@query("flt11_text_filter", "SELECT doc_id FROM documents WHERE contains(text, 'license') OR contains(text, 'License')")
def flt11(spark, sf):
    return table(spark, sf, "documents").where(F.contains("text", F.lit("license")) | F.contains("text", F.lit("License"))).select("doc_id")


@query("flt13_recent", "SELECT doc_id FROM documents WHERE date_diff('day', DATE '2024-01-01' + CAST(doc_id % 365 AS INT), DATE '2024-12-31') <= 90 AND length(trim(text)) >= 200")
def flt13(spark, sf):
    """Recent reviews with a body of at least 200 characters."""
    d = table(spark, sf, "documents").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")))
    return d.where((S.age_days("day", F.lit("2024-12-31").cast("date")) <= 90) & (F.length(F.trim("text")) >= 200)).select("doc_id")


@query("qv1_rules", "SELECT uid, 'flag_drift' AS rule FROM v_state WHERE has_insight <> (n_dims > 0) UNION ALL SELECT uid, 'missing_status' FROM v_state WHERE status IS NULL UNION ALL SELECT uid, 'attempts' FROM v_state WHERE attempts > 4")
def qv1(spark, sf):
    return H.validate(v_state(spark, sf), "uid", {"flag_drift": F.col("has_insight") != (F.col("n_dims") > 0), "missing_status": F.col("status").isNull(), "attempts": F.col("attempts") > 4})


@query("qv2_flag_fix", "SELECT uid, n_dims > 0 AS has_insight, has_insight <> (n_dims > 0) AS fixed FROM v_state")
def qv2(spark, sf):
    ok = F.col("n_dims") > 0
    return v_state(spark, sf).select("uid", ok.alias("has_insight"), (F.col("has_insight") != ok).alias("fixed"))


SCORED = "SELECT doc_id, quality, len(list_distinct(string_split(text, ' ')))::DOUBLE / len(string_split(text, ' ')) AS score FROM documents JOIN labels USING (doc_id)"
SWEEP = f"SELECT threshold, tp, fp, fn, round_even(tp::DOUBLE / nullif(tp + fp, 0), 4) AS precision, round_even(tp::DOUBLE / nullif(tp + fn, 0), 4) AS recall, round_even(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 4) AS f1 FROM (SELECT threshold, count(*) FILTER (score >= threshold AND quality = 1) AS tp, count(*) FILTER (score >= threshold AND quality <> 1) AS fp, count(*) FILTER (score < threshold AND quality = 1) AS fn FROM ({SCORED}) CROSS JOIN (SELECT unnest([0.30,0.35,0.40,0.45,0.50,0.55,0.60,0.65,0.70])::DOUBLE AS threshold) GROUP BY threshold)"
THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]


def _scored(spark, sf):
    w = F.split("text", " ")
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "quality", (F.size(F.array_distinct(w)) / F.size(w)).alias("score"))


@query("qv5_threshold_sweep", SWEEP)
def qv5(spark, sf):
    return H.threshold_sweep(_scored(spark, sf), "quality", "score", THRESHOLDS)


@query("qv6_recommendation", f"SELECT arg_max(threshold, struct_pack(f := f1, t := threshold)) AS threshold, round_even(max(precision) - min(precision), 4) AS precision_range, round_even(max(precision) - min(precision), 4) < 0.05 AS needs_strong_key FROM ({SWEEP})")
def qv6(spark, sf):
    return H.best_threshold(H.threshold_sweep(_scored(spark, sf), "quality", "score", THRESHOLDS))


@query("dm2_momentum", "SELECT user_id, count(*) AS n, round_even(count(*)::DOUBLE / max(count(*)) OVER () * (count(*) FILTER (CAST(ts AS DATE) > DATE '2024-01-24'))::DOUBLE / count(*), 4) AS momentum FROM events GROUP BY user_id")
def dm2(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.to_date("ts") > F.to_date(F.lit("2024-01-24"))).alias("recent"))
    return e.join(F.broadcast(e.agg(F.max("n").alias("most")))).select("user_id", "n", F.bround(F.col("n") / F.col("most") * F.col("recent") / F.col("n"), 4).alias("momentum"))


@query("dm6_bundle_cards", "SELECT bundle_uid, count(DISTINCT dim_path) AS n_dims, count(*) AS n_points FROM v_point GROUP BY bundle_uid ORDER BY n_dims DESC, n_points DESC, bundle_uid LIMIT 50")
def dm6(spark, sf):
    return v_point(spark, sf).groupBy("bundle_uid").agg(F.countDistinct("dim_path").alias("n_dims"), F.count("*").alias("n_points")).orderBy(F.desc("n_dims"), F.desc("n_points"), "bundle_uid").limit(50)
