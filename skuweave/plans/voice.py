"""Queries over insight points, sources and citations."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.operators import grounding as G
from skuweave.operators import voice as V
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_evidence, v_point, v_source

COV = """cov AS (SELECT d.category, dim_path, n_with, cited, n_points, n_bundles, round_even(n_with::DOUBLE / n_bundles, 4) AS coverage FROM (SELECT category, dim_path, count(DISTINCT bundle_uid) AS n_with, CAST(sum(cited) AS BIGINT) AS cited, count(*) AS n_points FROM v_point GROUP BY ALL) d
 JOIN (SELECT category, count(DISTINCT bundle_uid) AS n_bundles FROM v_point GROUP BY category) t ON t.category = d.category),
base AS (SELECT dim_path, CAST(sum(n_with) AS BIGINT) AS n_with, round_even(sum(n_with)::DOUBLE / (SELECT sum(n) FROM (SELECT max(n_bundles) AS n FROM cov GROUP BY category)), 4) AS base FROM cov GROUP BY dim_path)"""
RANKED = COV + """, r0 AS (SELECT cov.*, base, round_even(coverage / nullif(base, 0), 3) AS lift FROM cov JOIN base USING (dim_path) WHERE coverage >= 0.2 AND cov.n_with >= CASE WHEN n_bundles < 3 THEN 1 ELSE 2 END),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY round_even(coverage * lift, 6) DESC, coverage DESC, dim_path) AS rank FROM r0) WHERE rank <= 5 OR starts_with(dim_path, 'verdict.strengths'))"""


@query("ag4_attribute_coverage", f"WITH {COV} SELECT * FROM cov")
def ag4(spark, sf):
    return V.attribute_coverage(v_point(spark, sf))


@query("ag5_global_coverage", f"WITH {COV} SELECT * FROM base")
def ag5(spark, sf):
    return V.global_coverage(v_point(spark, sf))


@query("wn1_rank_attributes", f"WITH {RANKED} SELECT category, dim_path, coverage, base, lift, rank FROM ranked")
def wn1(spark, sf):
    return V.rank_attributes(v_point(spark, sf)).select("category", "dim_path", "coverage", "base", "lift", "rank")


@query("wn2_representatives", f"WITH {RANKED} SELECT p.category, bundle_uid, p.dim_path, rank, row_number() OVER (PARTITION BY p.category, bundle_uid, p.dim_path ORDER BY p.cited DESC, ord) AS r, point, p.cited FROM v_point p JOIN ranked k ON k.category = p.category AND k.dim_path = p.dim_path QUALIFY r <= 3")
def wn2(spark, sf):
    p = v_point(spark, sf)
    return V.representatives(p, V.rank_attributes(p))


@query("ev14_seller_projection", f"WITH {RANKED} SELECT category, dim_path, split_part(dim_path, '.', -2) AS label, rank, coverage, lift, cited AS mentions FROM ranked")
def ev14(spark, sf):
    return V.rank_attributes(v_point(spark, sf)).select("category", "dim_path", F.element_at(F.split("dim_path", r"\."), -2).alias("label"), "rank", "coverage", "lift", F.col("cited").alias("mentions"))


@query("shp9_best_dims", """WITH d AS (SELECT bundle_uid, dim_path, row_number() OVER (PARTITION BY bundle_uid ORDER BY c DESC, dim_path) AS d FROM (SELECT bundle_uid, dim_path, sum(cited) AS c FROM v_point GROUP BY bundle_uid, dim_path))
SELECT p.bundle_uid, p.dim_path, d, row_number() OVER (PARTITION BY p.bundle_uid, p.dim_path ORDER BY cited DESC, ord) AS r, point, cited FROM v_point p JOIN d ON d.bundle_uid = p.bundle_uid AND d.dim_path = p.dim_path WHERE d <= 6 QUALIFY r <= 3""")
def shp9(spark, sf):
    return V.best_dims(v_point(spark, sf), "bundle_uid")


@query("ag11_weakness_ranking", """SELECT category, theme, weight, round_even(weight::DOUBLE / sum(weight) OVER (PARTITION BY category), 4) AS share FROM (SELECT category, CASE WHEN contains(point, '1') THEN 'one' WHEN contains(point, '2') THEN 'two' ELSE 'other' END AS theme, CAST(sum(coalesce(nullif(cited, 0), 1)) AS BIGINT) AS weight FROM v_point WHERE starts_with(dim_path, 'verdict.weaknesses') GROUP BY ALL)""")
def ag11(spark, sf):
    return V.weakness_ranking(v_point(spark, sf), F.when(F.contains("point", F.lit("1")), "one").when(F.contains("point", F.lit("2")), "two").otherwise("other"))


@query("ag12_attribute_gap", f"WITH {RANKED}, have AS (SELECT DISTINCT category, bundle_uid, dim_path FROM v_point), want AS (SELECT h.category, h.bundle_uid, k.dim_path, k.rank FROM (SELECT DISTINCT category, bundle_uid FROM have) h JOIN ranked k ON k.category = h.category) SELECT category, bundle_uid, string_agg(dim_path, '|' ORDER BY rank) AS missing, count(*) AS n_missing FROM want WHERE (category, bundle_uid, dim_path) NOT IN (SELECT (category, bundle_uid, dim_path) FROM have) GROUP BY ALL".replace("WHERE (category, bundle_uid, dim_path) NOT IN (SELECT (category, bundle_uid, dim_path) FROM have)", "ANTI JOIN have USING (category, bundle_uid, dim_path)"))
def ag12(spark, sf):
    p = v_point(spark, sf)
    return V.attribute_gap(p, V.rank_attributes(p))


@query("ag23_heat_map", """WITH c AS (SELECT category, dim_path, count(*) AS n FROM v_point GROUP BY ALL), f AS (SELECT dim_path, count(*) AS k FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, dim_path) AS r FROM c) WHERE r <= 8 GROUP BY dim_path ORDER BY k DESC, dim_path LIMIT 10)
SELECT g.category, f.dim_path, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT category FROM c) g CROSS JOIN f LEFT JOIN c ON c.category = g.category AND c.dim_path = f.dim_path""")
def ag23(spark, sf):
    return V.heat_map(v_point(spark, sf))


BODY = "concat(product_uid, ' - ', CASE split_part(dim_path, '.', -2) WHEN 'strengths' THEN 'Strengths' WHEN 'weaknesses' THEN 'Weaknesses' WHEN 'taste' THEN 'Taste' WHEN 'size' THEN 'Size' WHEN 'scene' THEN 'Scene of use' ELSE split_part(dim_path, '.', -2) END, ': ', point)"


@query("shp10_chunks", f"SELECT product_uid, 'point' AS kind, ord AS ref_id, {BODY} AS body, md5({BODY}) AS content_hash FROM v_point")
def shp10(spark, sf):
    return V.chunks(v_point(spark, sf))


@query("shp12_dim_label", "SELECT dim_path, CASE split_part(dim_path, '.', -2) WHEN 'strengths' THEN 'Strengths' WHEN 'weaknesses' THEN 'Weaknesses' WHEN 'taste' THEN 'Taste' WHEN 'size' THEN 'Size' WHEN 'scene' THEN 'Scene of use' ELSE split_part(dim_path, '.', -2) END AS label, count(*) AS n FROM v_point GROUP BY dim_path")
def shp12(spark, sf):
    return v_point(spark, sf).groupBy("dim_path").agg(F.count("*").alias("n")).withColumn("label", V.dim_label("dim_path"))


@query("shp11_chunk_delta", "SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'gone' WHEN o.t <> n.t THEN 'stale' ELSE 'same' END AS state FROM (SELECT doc_id, text AS t FROM documents WHERE doc_id % 7 <> 0) o FULL JOIN (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN concat(text, '!') ELSE text END AS t FROM documents WHERE doc_id % 5 <> 0) n ON o.doc_id = n.doc_id")
def shp11(spark, sf):
    d = table(spark, sf, "documents")
    new = d.where("doc_id % 5 <> 0").withColumn("text", F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return V.chunk_delta(d.where("doc_id % 7 <> 0"), new, "doc_id", "text")


PAGE = """d AS (SELECT *, dense_rank() OVER (PARTITION BY bundle_uid ORDER BY total DESC, dim_path) AS dim_rank FROM (SELECT *, sum(cited) OVER (PARTITION BY bundle_uid, dim_path) AS total FROM v_point)),
 e AS (SELECT *, CASE WHEN starts_with(dim_path, 'verdict.strengths') THEN 'good' WHEN starts_with(dim_path, 'verdict.weaknesses') THEN 'caveat' WHEN starts_with(dim_path, 'aspect.taste') THEN 'taste' WHEN starts_with(dim_path, 'aspect.size') THEN 'pack' ELSE 'use' END AS section,
  CASE WHEN ord % 5 > 0 THEN ord % 5 ELSE cited END AS mentions, list_filter(range(ord % 5), lambda i: (i + ord) % 4 <> 3) AS l FROM d),
 o AS (SELECT *, list_concat(list_filter(l, lambda i: (i + ord) % 2 = 1), list_filter(l, lambda i: (i + ord) % 2 = 0))[1:3] AS shown FROM e),
 u AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY bundle_uid, point ORDER BY dim_rank, ord, point) = 1),
 b AS (SELECT *, row_number() OVER (PARTITION BY bundle_uid, section ORDER BY mentions DESC, dim_rank, ord) AS r, list_position(['good', 'taste', 'spec', 'pack', 'use', 'gift', 'caveat'], section) AS place FROM u QUALIFY r <= 3),
 s AS (SELECT bundle_uid, place, concat(section, '(', string_agg(concat(point, '=', mentions, '[', array_to_string(list_transform(shown, lambda i: concat('u', ord, '-', i)), ','), ']'), ';' ORDER BY r), ')') AS t, arg_min(point, r) AS first FROM b GROUP BY bundle_uid, place, section)
 SELECT s.bundle_uid, coalesce(g.strength, arg_min(s.first, s.place)) AS headline, n.review_count, array_to_string(list(t ORDER BY s.place)[1:5], '|') AS page FROM s
 JOIN (SELECT bundle_uid, CAST(sum(mentions) AS BIGINT) AS review_count FROM u GROUP BY 1) n USING (bundle_uid) LEFT JOIN (SELECT bundle_uid, arg_min(point, struct_pack(a := dim_rank, b := ord)) AS strength FROM e WHERE section = 'good' GROUP BY 1) g USING (bundle_uid) GROUP BY s.bundle_uid, g.strength, n.review_count"""


def paged_points(p):
    """Points with the rank of their dimension and up to four pieces of evidence, some without a link, some of advertisements."""
    from pyspark.sql import Window

    i = lambda x: x + F.col("ord")
    piece = lambda x: F.struct(F.lit("blog").alias("source"), F.when(i(x) % 4 != 3, F.concat(F.lit("u"), F.col("ord").cast("string"), F.lit("-"), x.cast("string"))).otherwise("").alias("url"), F.lit("q").alias("quote"), (i(x) % 2 == 0).alias("is_ad"))
    p = p.withColumn("total", F.sum("cited").over(Window.partitionBy("bundle_uid", "dim_path")))
    p = p.withColumn("dim_rank", F.dense_rank().over(Window.partitionBy("bundle_uid").orderBy(F.desc("total"), "dim_path")))
    return p.withColumn("evidence", F.slice(F.transform(F.array(*[F.lit(k) for k in range(4)]), piece), F.lit(1), (F.col("ord") % 5).cast("int")))


@query("ev15_customer_pages", f"WITH {PAGE}")
def ev15_pages(spark, sf):
    """Nested pages with headline and linked evidence, printed as text for the comparison."""
    pages = V.customer_pages(paged_points(v_point(spark, sf)))
    item = lambda x: F.concat(x["text"], F.lit("="), x["mentions"].cast("string"), F.lit("["), F.array_join(F.transform(x["evidence"], lambda e: e["url"]), ","), F.lit("]"))
    page = F.array_join(F.transform("sections", lambda s: F.concat(s["section"], F.lit("("), F.array_join(F.transform(s["items"], item), ";"), F.lit(")"))), "|")
    return pages.select("bundle_uid", "headline", "review_count", page.alias("page"))


@query("ev11_shared_points", "SELECT bundle_uid, dim_path, point, count(DISTINCT product_uid) AS n_members FROM v_point GROUP BY ALL HAVING count(DISTINCT product_uid) >= 2")
def ev11(spark, sf):
    return V.shared_points(v_point(spark, sf), "bundle_uid", "product_uid")


@query("ev13_parent_lines", "SELECT bundle_uid, string_agg(point, '|' ORDER BY r) AS lines, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY bundle_uid ORDER BY ord, point) AS r FROM (SELECT bundle_uid, point, min(ord) AS ord FROM v_point GROUP BY ALL)) WHERE r <= 40 GROUP BY bundle_uid")
def ev13(spark, sf):
    return V.parent_lines(v_point(spark, sf), "bundle_uid")


@query("ev15_customer_view", """WITH u AS (SELECT *, array_to_string(string_split(dim_path, '.')[1:2], '.') AS section FROM v_point WHERE NOT starts_with(dim_path, 'verdict.weaknesses') QUALIFY row_number() OVER (PARTITION BY bundle_uid, point ORDER BY cited DESC, ord) = 1)
SELECT bundle_uid, section, r, point, cited FROM (SELECT *, row_number() OVER (PARTITION BY bundle_uid, section ORDER BY cited DESC, ord) AS r, dense_rank() OVER (PARTITION BY bundle_uid ORDER BY section) AS s FROM u) WHERE r <= 3 AND s <= 5""")
def ev15(spark, sf):
    return V.customer_view(v_point(spark, sf))


@query("shp13_flat_summary", """SELECT bundle_uid, string_agg(point, '|' ORDER BY cited DESC, ord) FILTER (starts_with(dim_path, 'verdict.strengths')) AS strengths, string_agg(point, '|' ORDER BY cited DESC, ord) FILTER (starts_with(dim_path, 'verdict.weaknesses')) AS weaknesses, count(DISTINCT dim_path) FILTER (starts_with(dim_path, 'aspect.')) AS n_aspects FROM v_point GROUP BY bundle_uid""")
def shp13(spark, sf):
    pick = lambda d: F.nullif(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.startswith("dim_path", F.lit(d)), F.struct((-F.col("cited")).alias("k"), "ord", "point")))), lambda s: s["point"]), "|"), F.lit(""))
    return v_point(spark, sf).groupBy("bundle_uid").agg(pick("verdict.strengths").alias("strengths"), pick("verdict.weaknesses").alias("weaknesses"), F.countDistinct(F.when(F.startswith("dim_path", F.lit("aspect.")), F.col("dim_path"))).alias("n_aspects"))


RES = """res AS (SELECT e.evidence_id, e.product_uid, e.quote, s.doc_id, s.body FROM v_evidence e LEFT JOIN v_source s ON s.product_uid = e.product_uid AND upper(s.local_id) = upper(regexp_extract(e.local_source_id, '([A-Za-z]+[0-9]+)', 1)))"""
SOFT = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
HARD = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
WORDS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
CHECK = f"""CASE WHEN body IS NULL THEN 'unverified' WHEN contains({SOFT.format('body')}, {SOFT.format('quote')}) OR contains({HARD.format('body')}, {HARD.format('quote')}) THEN 'verified'
 WHEN len(list_filter(list_distinct(list_filter({WORDS.format('quote')}, lambda w: len(w) >= 2)), lambda w: contains(lower(body), w)))::DOUBLE / nullif(len(list_distinct(list_filter({WORDS.format('quote')}, lambda w: len(w) >= 2))), 0) >= 0.6 THEN 'partial' ELSE 'unverified' END"""


@query("ev1_source_resolution", f"WITH {RES} SELECT evidence_id, product_uid, doc_id FROM res")
def ev1(spark, sf):
    return G.resolve_source(v_evidence(spark, sf), v_source(spark, sf)).select("evidence_id", "product_uid", "doc_id")


@query("ev2_quote_check", f"WITH {RES} SELECT evidence_id, doc_id, {CHECK} AS status FROM res")
def ev2(spark, sf):
    return G.resolve_source(v_evidence(spark, sf), v_source(spark, sf)).select("evidence_id", "doc_id", G.quote_check("quote", "body").alias("status"))


HITS = f"hits AS (SELECT e.evidence_id, s.product_uid, s.doc_id, row_number() OVER (PARTITION BY e.evidence_id ORDER BY s.doc_id) AS place FROM v_evidence e JOIN v_source s ON contains({HARD.format('s.body')}, {HARD.format('e.quote')}))"


@query("ev3_supporting_sources", f"WITH {HITS} SELECT * FROM hits")
def ev3(spark, sf):
    return G.supporting_sources(v_evidence(spark, sf), v_source(spark, sf))


@query("ev5_resolution_counters", f"WITH {RES}, {HITS} SELECT CASE WHEN status <> 'unverified' THEN status WHEN h.evidence_id IS NOT NULL THEN 'recovered' ELSE 'dropped' END AS outcome, count(*) AS n FROM (SELECT evidence_id, {CHECK} AS status FROM res) c LEFT JOIN (SELECT DISTINCT evidence_id FROM hits) h ON h.evidence_id = c.evidence_id GROUP BY 1")
def ev5(spark, sf):
    e, s = v_evidence(spark, sf), v_source(spark, sf)
    checked = G.resolve_source(e, s).select("evidence_id", G.quote_check("quote", "body").alias("status"))
    found = G.supporting_sources(e, s).select("evidence_id").distinct().withColumn("found", F.lit(True))
    out = F.when(F.col("status") != "unverified", F.col("status")).when(F.col("found"), "recovered").otherwise("dropped")
    return checked.join(found, "evidence_id", "left").groupBy(out.alias("outcome")).agg(F.count("*").alias("n"))


@query("ev7_recovery_uniqueness", f"WITH {HITS} SELECT evidence_id, count(DISTINCT doc_id) AS n_sources FROM hits GROUP BY evidence_id")
def ev7(spark, sf):
    return G.supporting_sources(v_evidence(spark, sf), v_source(spark, sf)).groupBy("evidence_id").agg(F.countDistinct("doc_id").alias("n_sources"))


@query("ev4_spans", "WITH s AS (SELECT doc_id, unnest(range(len(a))) AS pos, trim(unnest(a)) AS span FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\n]+') AS a FROM documents)), t AS (SELECT *, lead(span) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM s WHERE length(span) > 0), u AS (SELECT doc_id, pos, 1 AS width, span FROM t UNION ALL SELECT doc_id, pos, 2, concat(span, ' ', nxt) FROM t WHERE nxt IS NOT NULL) SELECT doc_id, count(*) AS n, CAST(sum(length(span)) AS BIGINT) AS chars, CAST(sum(pos * width) AS BIGINT) AS places FROM u WHERE length(span) >= 6 GROUP BY doc_id")
def ev4(spark, sf):
    return G.spans_of(v_source(spark, sf)).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("span")).alias("chars"), F.sum(F.col("pos") * F.col("width")).alias("places"))


@query("ev4_reground")
def ev4b(spark, sf):
    return G.reground(v_evidence(spark, sf), G.spans_of(v_source(spark, sf)))


@query("wn11_snippet_budget", "SELECT product_uid, doc_id, CAST(sum(length(body)) OVER w AS BIGINT) AS running, row_number() OVER w AS place, row_number() OVER w = 1 OR sum(length(body)) OVER w <= 28000 AS kept FROM v_source WINDOW w AS (PARTITION BY product_uid ORDER BY doc_id ROWS UNBOUNDED PRECEDING)")
def wn11(spark, sf):
    return V.snippet_budget(v_source(spark, sf), "product_uid", "doc_id", "body").select("product_uid", "doc_id", "running", "place", "kept")


@query("jn1_serving_view", f"WITH {RES} SELECT p.product_uid AS point_uid, p.point, r.evidence_id, r.doc_id FROM v_point p LEFT JOIN (SELECT *, concat('O', CAST(evidence_id AS VARCHAR)) AS uid FROM res) r ON r.uid = p.product_uid")
def jn1(spark, sf):
    r = G.resolve_source(v_evidence(spark, sf), v_source(spark, sf)).select(F.concat(F.lit("O"), F.col("evidence_id").cast("string")).alias("product_uid"), "evidence_id", "doc_id")
    return v_point(spark, sf).join(r, "product_uid", "left").select(F.col("product_uid").alias("point_uid"), "point", "evidence_id", "doc_id")


@query("ev8_variant_families", "SELECT brand_raw, base, count(*) AS n_members FROM (SELECT brand_raw, regexp_replace(title, ' [0-9]+g$', '') AS base FROM v_title) GROUP BY ALL HAVING count(*) >= 2")
def ev8(spark, sf):
    from skuweave.plans.views import v_title

    t = v_title(spark, sf).withColumn("base", F.regexp_replace("title", " [0-9]+g$", ""))
    return t.groupBy("brand_raw", "base").agg(F.count("*").alias("n_members")).where("n_members >= 2")


@query("ev9_variant_tree", """WITH m AS (SELECT p_partkey, p_brand, list_sort(list_distinct(string_split(CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', p_type) ELSE p_name END, ' '))) AS s FROM part)
SELECT a.p_brand, a.p_partkey AS child, b.p_partkey AS parent FROM m a LEFT JOIN LATERAL (SELECT p_partkey FROM m b WHERE b.p_brand = a.p_brand AND len(b.s) < len(a.s) AND list_has_all(a.s, b.s) ORDER BY len(b.s) DESC, p_partkey LIMIT 1) b ON true""")
def ev9(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_partkey", F.split(F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))), " ").alias("s"))
    return V.family_tree(p, "p_brand", "p_partkey", "s")


#: Each member's points: what its line items say. A family shares what a third of its members say.
TREE = """m AS MATERIALIZED (SELECT p_brand AS family, p_partkey AS member, list_sort(list_distinct(string_split(CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', p_type) ELSE p_name END, ' '))) AS s FROM part),
 t AS MATERIALIZED (SELECT a.family, a.member AS node, b.member AS parent FROM m a LEFT JOIN LATERAL (SELECT member FROM m b WHERE b.family = a.family AND len(b.s) < len(a.s) AND list_has_all(a.s, b.s) ORDER BY len(b.s) DESC, member LIMIT 1) b ON true),
 pt AS MATERIALIZED (SELECT p_brand AS family, l_partkey AS node, concat('says ', l_orderkey % 499) AS point, min(concat('d', l_linenumber)) AS dim FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
 sh AS (SELECT family, point FROM (SELECT family, point, count(DISTINCT node) AS k FROM pt GROUP BY family, point) JOIN (SELECT family, count(*) AS n FROM m GROUP BY family) USING (family) WHERE k * 3 >= n),
 up(node, ancestor, level) AS (SELECT node, parent, 1 FROM t UNION ALL SELECT u.node, t.parent, u.level + 1 FROM up u JOIN t ON u.ancestor = t.node WHERE u.ancestor IS NOT NULL),
 lv AS MATERIALIZED (SELECT node, max(level) AS level FROM up GROUP BY node),
 own AS MATERIALIZED (SELECT pt.*, t.parent, lv.level FROM pt JOIN t USING (node) JOIN lv USING (node) WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.family = pt.family AND sh.point = pt.point) AND NOT EXISTS (SELECT 1 FROM up JOIN pt q ON q.node = up.ancestor WHERE up.node = pt.node AND q.point = pt.point))"""
LEVELS = 5


def _promotion() -> str:
    """The levels from the lowest up, each as common table expressions; LEVELS is more than the chains of signatures are long."""
    out = [f"h{LEVELS} AS MATERIALIZED (SELECT family, node, parent, dim, point FROM own WHERE level = {LEVELS})"]
    for n in range(LEVELS, 0, -1):
        out.append(f"c{n} AS MATERIALIZED (SELECT family, parent, point, min(struct_pack(n := node, d := dim)).d AS dim FROM h{n} GROUP BY family, parent, point HAVING count(DISTINCT node) >= 2)")
        out.append(f"k{n} AS (SELECT h.family, h.node, {n} AS level, h.dim, h.point FROM h{n} h LEFT JOIN c{n} c ON c.family = h.family AND c.parent IS NOT DISTINCT FROM h.parent AND c.point = h.point WHERE c.point IS NULL)")
        if n > 1:
            out.append(f"h{n - 1} AS MATERIALIZED (SELECT family, node, parent, dim, point FROM own WHERE level = {n - 1} UNION ALL SELECT c.family, c.parent, t.parent, c.dim, c.point FROM c{n} c JOIN t ON t.node = c.parent WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.node = c.parent AND o.point = c.point))")
    tops = " UNION ALL ".join(f"SELECT family, point, dim FROM c{n} WHERE parent IS NULL" for n in range(1, LEVELS + 1))
    out.append("said AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM k{n}" for n in range(1, LEVELS + 1)) + f" UNION ALL SELECT family, NULL, 0, min(dim), point FROM ({tops}) GROUP BY family, point)")
    return ", ".join(out)


def _variant_points(spark, sf):
    p = table(spark, sf, "part")
    m = p.select(F.col("p_brand").alias("family"), F.col("p_partkey").alias("member"), F.split(F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))), " ").alias("s"))
    says = table(spark, sf, "lineitem").join(p, F.expr("p_partkey = l_partkey"))
    says = says.select(F.col("p_brand").alias("family"), F.col("l_partkey").alias("member"), F.concat(F.lit("d"), F.col("l_linenumber").cast("string")).alias("dim"), F.concat(F.lit("says "), (F.col("l_orderkey") % 499).cast("string")).alias("point"))
    n = m.groupBy("family").agg(F.count("*").alias("n"))
    shared = says.groupBy("family", "point").agg(F.count_distinct("member").alias("k")).join(n, "family").where("k * 3 >= n").select("family", "point")
    return V.family_tree(m, "family", "member", "s"), says, shared


@query("st4_distinctive_points", f"WITH RECURSIVE {TREE} SELECT family, node AS member, dim, point FROM own")
def st4(spark, sf):
    tree, says, shared = _variant_points(spark, sf)
    own = says.groupBy("family", "member", "point").agg(F.min("dim").alias("dim"))
    return V.distinctive(own, V.ancestors(tree), shared, "family").select("family", "member", "dim", "point")


@query("ev10_distinctive_path", f"WITH RECURSIVE {TREE}, {_promotion()} SELECT family, node, level, dim, point FROM said")
def ev10(spark, sf):
    tree, says, shared = _variant_points(spark, sf)
    return V.variant_points(tree, says, shared, "family")[0]


@query("ev10_kept_nodes", f"""WITH RECURSIVE {TREE}, {_promotion()}, n AS (SELECT node, count(*) AS n_points FROM said WHERE node IS NOT NULL GROUP BY node)
 SELECT t.family, t.node, t.parent, lv.level, coalesce(n_points, 0) AS n_points FROM t JOIN lv USING (node) LEFT JOIN n USING (node) WHERE t.node IN (SELECT node FROM n UNION SELECT ancestor FROM up JOIN n USING (node))""")
def ev10_nodes(spark, sf):
    tree, says, shared = _variant_points(spark, sf)
    return V.variant_points(tree, says, shared, "family")[1]


@query("ev12_product_group", "SELECT p_brand, p_name, string_agg(DISTINCT CAST(p_size AS VARCHAR), '|' ORDER BY CAST(p_size AS VARCHAR)) AS sizes, count(DISTINCT p_size) > 1 AS varies, CAST(floor(min(p_retailprice) * 100 + 0.5) AS BIGINT) AS low, CAST(floor(max(p_retailprice) * 100 + 0.5) AS BIGINT) AS high FROM part GROUP BY ALL")
def ev12(spark, sf):
    c = lambda x: F.floor(x * 100 + 0.5).cast("bigint")
    return table(spark, sf, "part").groupBy("p_brand", "p_name").agg(F.array_join(F.sort_array(F.collect_set(F.col("p_size").cast("string"))), "|").alias("sizes"), (F.countDistinct("p_size") > 1).alias("varies"), c(F.min("p_retailprice")).alias("low"), c(F.max("p_retailprice")).alias("high"))


@query("st5_pros_minus_cons", f"SELECT DISTINCT {SOFT.format('text')} AS t FROM documents WHERE doc_id % 2 = 0 AND {SOFT.format('text')} NOT IN (SELECT {SOFT.format('text')} FROM documents WHERE doc_id % 2 = 1)")
def st5(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", S.soft_text("text").alias("t"))
    return d.where("doc_id % 2 = 0").select("t").distinct().join(d.where("doc_id % 2 = 1").select("t"), "t", "left_anti")


@query("ev16_consumer_guide", "SELECT o.bundle_uid, pros, cons, CAST(low AS BIGINT) AS low FROM (SELECT bundle_uid, count(*) FILTER (starts_with(dim_path, 'verdict.strengths')) AS pros, count(*) FILTER (starts_with(dim_path, 'verdict.weaknesses')) AS cons FROM v_point GROUP BY bundle_uid) o LEFT JOIN (SELECT concat('C', CAST(o_custkey AS VARCHAR)) AS bundle_uid, min(floor(o_totalprice * 100 + 0.5)) AS low FROM orders GROUP BY 1) p ON p.bundle_uid = o.bundle_uid")
def ev16(spark, sf):
    p = v_point(spark, sf).groupBy("bundle_uid").agg(F.count_if(F.startswith("dim_path", F.lit("verdict.strengths"))).alias("pros"), F.count_if(F.startswith("dim_path", F.lit("verdict.weaknesses"))).alias("cons"))
    low = table(spark, sf, "orders").groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("bundle_uid")).agg(F.min(F.floor(F.col("o_totalprice") * 100 + 0.5)).cast("bigint").alias("low"))
    return p.join(low, "bundle_uid", "left")
