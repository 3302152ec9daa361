"""Queries of the attribute rules over titles, texts, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.functions import text as A
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_listing, v_offer, v_title


def joined(c):
    return F.array_join(c, "|")


@query("att1_fold", "SELECT doc_id, md5(replace(lower(text), 'the', 'da')) AS folded FROM documents WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]')")
def att1(spark, sf):
    d = table(spark, sf, "documents").where(~F.col("text").rlike(r"[^\x00-\x7F]"))
    return d.select("doc_id", F.md5(A.fold("text", {"the": "da"})).alias("folded"))


@query("att2_tokens", "SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS tokens FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z0-9가-힣]+'), lambda w: w NOT IN ('the','and','with','for','of') AND NOT regexp_matches(w, '^spf[0-9]*$')) AS t FROM documents)")
def att2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.tokens("text").alias("t")).select("doc_id", F.size("t").alias("n"), F.md5(joined("t")).alias("tokens"))


@query("att3_char_ngrams", "SELECT title_id, array_to_string(list_sort(list_distinct(CASE WHEN length(x) < 3 THEN [x] ELSE list_transform(range(1, length(x) - 1), lambda i: substr(x, i, 3)) END)), '|') AS grams FROM (SELECT title_id, regexp_replace(title, '\\s+', '', 'g') AS x FROM v_title)")
def att3(spark, sf):
    return v_title(spark, sf).select("title_id", joined(F.array_sort(S.char_ngrams("title"))).alias("grams"))


@query("att4_brand", "SELECT title_id, CASE WHEN brand_raw IN ('Brand#11','Brand#22','Brand#33') THEN brand_raw ELSE list_filter(string_split(title, ' '), lambda w: w IN ('steel','brass'))[1] END AS brand FROM v_title")
def att4(spark, sf):
    lexicon = ("Brand#11", "Brand#22", "Brand#33")
    return v_title(spark, sf).select("title_id", F.when(F.col("brand_raw").isin(*lexicon), F.col("brand_raw")).otherwise(A.first_listed(F.split("title", " "), ("steel", "brass"))).alias("brand"))


@query("att5_measures", "SELECT title_id, CAST(regexp_extract(title, '([0-9]+)g', 1) AS DOUBLE) AS grams, NULL::DOUBLE AS ml FROM v_title")
def att5(spark, sf):
    return v_title(spark, sf).select("title_id", A.measure("title", A.WEIGHT).alias("grams"), A.measure("title", A.VOLUME).alias("ml"))


@query("att6_pack_count", "SELECT product_uid, day, qty, price, qty AS pack FROM v_offer")
def att6(spark, sf):
    return v_offer(spark, sf).select("product_uid", "day", "qty", "price", A.pack_count("title").alias("pack"))


@query("att15_pack_priority", "SELECT title_id, 1::INT AS pack FROM v_title")
def att15(spark, sf):
    return v_title(spark, sf).select("title_id", A.pack_count_priority("title").alias("pack"))


@query("att14_unit_price", "SELECT product_uid, day, qty AS quantity, CAST(round_even(price::DOUBLE / qty, 0) AS BIGINT) AS unit_price FROM v_offer")
def att14(spark, sf):
    q = A.purchase_quantity("title")
    return v_offer(spark, sf).select("product_uid", "day", q.alias("quantity"), F.bround(F.col("price") / q, 0).cast("bigint").alias("unit_price"))


@query("att7_colour", "SELECT p_partkey, list_filter(['black','white','red','blue','green','grey','pink','brown','beige','navy'], lambda c: contains(lower(p_name), c))[1] AS colour FROM part WHERE NOT list_has_any(string_split(lower(p_name), ' '), ['black','white','red','blue','green','grey','pink','brown','beige','navy'])")
def att7(spark, sf):
    p = table(spark, sf, "part").where(A.first_listed(A.tokens("p_name"), A.COLOURS).isNull())
    return p.select("p_partkey", A.colour("p_name").alias("colour"))


@query("att8_connector", "SELECT title_id, CASE WHEN regexp_matches(title, '(?i)(usb[- ]?c|type[- ]?c)') THEN 'usb_c' WHEN regexp_matches(title, '(?i)(lightning|8[- ]?pin)') THEN 'lightning' WHEN regexp_matches(title, '(?i)(micro[- ]?usb|5[- ]?pin)') THEN 'micro' END AS connector FROM v_title")
def att8(spark, sf):
    return v_title(spark, sf).select("title_id", A.first_rule("title", A.CONNECTORS).alias("connector"))


@query("att9_model_codes", "SELECT c_custkey, replace(c_name, '#', '') AS name_code, 'CUSTOMERX' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS model FROM customer")
def att9(spark, sf):
    c = table(spark, sf, "customer")
    code = F.concat(F.lit("fine CustomerX-"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.lit(" 500ml x2"))
    return c.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("")).alias("name_code"), F.get(A.model_codes(code), F.lit(0)).alias("model"))


@query("att10_bundle", "SELECT doc_id, regexp_matches(regexp_replace(lower(text), 'spf ?[0-9]+\\+*|pa\\++|1\\+1', '', 'g'), '\\+|(^|[^a-z])(set|bundle|combo)([^a-z]|$)|[0-9]종') AS bundle FROM documents")
def att10(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.is_bundle("text").alias("bundle"))


@query("att11_condition", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)refurb') THEN 'refurb' WHEN regexp_matches(text, '(?i)(^|[^a-z])used([^a-z]|$)') THEN 'used' END AS condition, regexp_matches(text, '(?i)(^|[^a-z])(import|grey market|parallel)([^a-z]|$)') AS grey FROM documents")
def att11(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.condition("text").alias("condition"), A.is_grey("text").alias("grey"))


@query("att12_category", "SELECT p_partkey, (list_sort(list_filter([struct_pack(a := instr(lower(p_name), 'steel'), i := 0, l := 'metal'), struct_pack(a := instr(lower(p_name), 'brass'), i := 1, l := 'metal'), struct_pack(a := instr(lower(p_name), 'plated'), i := 2, l := 'plated'), struct_pack(a := instr(lower(p_name), 'polished'), i := 3, l := 'polished'), struct_pack(a := instr(lower(p_name), 'promo'), i := 4, l := 'promo')], lambda s: s.a > 0))[1]).l AS category FROM part")
def att12(spark, sf):
    return table(spark, sf, "part").select("p_partkey", A.earliest_marker("p_name", A.CATEGORIES).alias("category"))


@query("att13_lines_and_size", "SELECT title_id, array_to_string(list_filter(['ECONOMY','PROMO','STANDARD'], lambda w: contains(category, w)), '|') AS lines, regexp_extract(title, '([0-9]+g)', 1) AS size FROM v_title")
def att13(spark, sf):
    lines = F.filter(F.array(*[F.lit(w) for w in ("ECONOMY", "PROMO", "STANDARD")]), lambda w: F.contains(F.col("category"), w))
    return v_title(spark, sf).select("title_id", joined(lines).alias("lines"), F.regexp_extract("title", "([0-9]+g)", 1).alias("size"))


@query("att16_unit_sizes", "SELECT title_id, concat('g:', CAST(CAST(regexp_extract(title, '([0-9]+)g', 1) AS DOUBLE) AS VARCHAR)) AS sizes FROM v_title")
def att16(spark, sf):
    return v_title(spark, sf).select("title_id", joined(A.unit_sizes("title")).alias("sizes"))


@query("att17_mass", "SELECT title_id, CAST(regexp_extract(title, '([0-9]+)g', 1) AS DOUBLE) AS mass FROM v_title")
def att17(spark, sf):
    kg, g = A.measure("title", {"kg": 1000.0}), A.measure("title", {"g": 1.0})
    return v_title(spark, sf).select("title_id", F.coalesce(kg, g).alias("mass"))


@query("att18_all_measures", "SELECT title_id, 'mass' AS dim, concat(grams, 'g') AS raw, grams::DOUBLE AS base_value, true AS ambiguous FROM v_attr UNION ALL SELECT title_id, 'power', concat(watts, 'W'), watts::DOUBLE, true FROM v_attr WHERE watts IS NOT NULL")
def att18(spark, sf):
    from skuweave.operators.measures import measures_of

    m = v_listing(spark, sf).select("title_id", F.explode(measures_of("title")).alias("m"))
    return m.select("title_id", "m.dim", "m.raw", "m.base_value", "m.ambiguous")


@query("att19_base_name", "SELECT title_id, trim(regexp_replace(title, '[0-9]+g$', '')) AS base FROM v_title")
def att19_base(spark, sf):
    from skuweave.operators.measures import strip_measures

    return v_title(spark, sf).select("title_id", strip_measures("title").alias("base"))


@query("att19_parse_variant", """SELECT p_partkey AS title_id, concat_ws(' ', CASE WHEN p_partkey % 11 <> 0 THEN p_brand END, p_name, CASE WHEN p_partkey % 4 <> 0 THEN concat('MX', p_partkey % 40, 'A') END, CASE p_partkey % 5 WHEN 0 THEN 'USB-C' WHEN 1 THEN 'Lightning' END,
 1 + p_partkey % 2, CASE p_partkey % 7 WHEN 0 THEN 'refurb' WHEN 1 THEN 'used' END, CASE WHEN p_partkey % 13 = 0 THEN 'set' END) AS base, concat(p_size * 10, 'g') AS volume, 1 + (p_partkey % 3 > 0)::INT AS n FROM part""")
def att19(spark, sf):
    from skuweave.operators.measures import parse_variant

    v = v_listing(spark, sf).select("title_id", parse_variant("title").alias("v"))
    return v.select("title_id", "v.base", "v.volume", F.size("v.measures").alias("n"))


@query("att19_family_axes", "SELECT entity, 'mass' AS dim, count(DISTINCT grams) AS n FROM v_attr GROUP BY entity HAVING count(DISTINCT grams) >= 2 UNION ALL SELECT entity, 'power', count(DISTINCT watts) FROM v_attr GROUP BY entity HAVING count(DISTINCT watts) >= 2")
def att19_axes(spark, sf):
    from skuweave.operators.measures import family_axes

    return family_axes(v_listing(spark, sf), "entity", "title_id", "title")


@query("att20_style_code", "SELECT doc_id, nullif(upper(regexp_extract(text, '([A-Za-z]{2}[0-9]{4}(?:-[0-9]{3})?)', 1)), '') AS code FROM documents")
def att20(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.style_code("text").alias("code"))


@query("att21_family_label", "SELECT brand_raw, CASE WHEN bool_or(contains(title, 'steel')) THEN 'steel' WHEN bool_or(contains(title, 'brass')) THEN 'brass' ELSE 'other' END AS family FROM v_title GROUP BY brand_raw")
def att21(spark, sf):
    t = v_title(spark, sf).groupBy("brand_raw").agg(F.array_join(F.array_sort(F.collect_set("title")), " ").alias("all"))
    return t.select("brand_raw", F.coalesce(A.first_rule("all", (("steel", "steel"), ("brass", "brass"))), F.lit("other")).alias("family"))


@query("att22_seller_host", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages")
def att22(spark, sf):
    return table(spark, sf, "pages").select("page_id", A.host_of("url").alias("host"))


RULES = (("sale", "(?i)sale"), ("question", r"\?"), ("number", "[0-9]"))


@query("att23_classify", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)sale') THEN 'sale' WHEN regexp_matches(text, '\\?') THEN 'question' WHEN regexp_matches(text, '[0-9]') THEN 'number' END AS label FROM documents")
def att23(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.first_rule("text", RULES).alias("label"))


@query("att24_polarity", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\\b(not|no|never)\\b') THEN NULL WHEN g AND NOT b THEN 'pos' WHEN b AND NOT g THEN 'neg' END AS polarity FROM (SELECT *, contains(lower(text), 'ing') AS g, contains(lower(text), 'stupid') OR contains(lower(text), 'trash') AS b FROM documents WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]'))")
def att24(spark, sf):
    d = table(spark, sf, "documents").where(~F.col("text").rlike(r"[^\x00-\x7F]"))
    return d.select("doc_id", A.polarity("text", ("ing",), ("stupid", "trash")).alias("polarity"))


@query("att25_ad_signals", "SELECT doc_id, array_to_string(list_filter(['license','token','sale','mail'], lambda p: contains(lower(text), p)), '|') AS signals FROM documents")
def att25(spark, sf):
    return table(spark, sf, "documents").select("doc_id", joined(A.signals("text", ("license", "token", "sale", "mail"))).alias("signals"))


@query("att26_question", "SELECT conv_id, turn, regexp_matches(trim(text), '\\?$') OR regexp_matches(trim(text), '^(?i)(who|what|when|where|why|how|is|are|can|does|do)\\b') AS question FROM conversations WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]')")
def att26(spark, sf):
    c = table(spark, sf, "conversations").where(~F.col("text").rlike(r"[^\x00-\x7F]"))
    return c.select("conv_id", "turn", A.is_question("text").alias("question"))


@query("att27_clean_colours", "SELECT title_id, array_to_string(list_filter(string_split(replace(lower(title), '#', ' '), ' '), lambda w: NOT regexp_matches(w, '[0-9]')), '|') AS words FROM v_title WHERE len(list_distinct(string_split(title, ' '))) = len(string_split(title, ' '))")
def att27(spark, sf):
    t = v_title(spark, sf).where(F.size(F.array_distinct(F.split("title", " "))) == F.size(F.split("title", " ")))
    return t.select("title_id", joined(A.clean_colours("title")).alias("words"))


@query("att28_sku_in_title", "SELECT title_id, brand_raw AS sku FROM v_title")
def att28(spark, sf):
    return v_title(spark, sf).select("title_id", A.sku_in_title("brand_raw", "title").alias("sku"))


@query("att29_display_name", "SELECT brand_raw, arg_min(title, struct_pack(n := length(title), t := title)) AS name FROM v_title GROUP BY brand_raw")
def att29(spark, sf):
    best = v_title(spark, sf).groupBy("brand_raw").agg(F.min_by("title", F.struct(F.length("title"), F.col("title"))).alias("t"))
    return best.select("brand_raw", A.display_name("t", "brand_raw").alias("name"))


@query("att32_fine_tokens", "SELECT title_id, array_to_string(list_filter(string_split(lower(title), ' '), lambda w: NOT regexp_matches(w, '[0-9]') AND w NOT IN ('black','white','red','blue','green','grey','pink','brown','beige','navy')), '|') AS tokens FROM v_title")
def att32(spark, sf):
    from skuweave.operators.measures import fine_tokens

    return v_title(spark, sf).select("title_id", joined(fine_tokens("title")).alias("tokens"))


@query("att33_source_kind", "SELECT doc_id, CASE WHEN regexp_matches(source, '^src1') THEN 'blog' WHEN regexp_matches(source, '5$') THEN 'shop' ELSE 'review' END AS kind FROM documents")
def att33(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.coalesce(A.first_rule("source", (("blog", "^src1"), ("shop", "5$"))), F.lit("review")).alias("kind"))


@query("att34_sku_variants", "SELECT p_partkey, concat(p_brand, '|', replace(p_brand, '#', ''), '|', replace(p_brand, '#', '/')) AS variants FROM part")
def att34(spark, sf):
    return table(spark, sf, "part").select("p_partkey", joined(A.sku_variants("p_brand")).alias("variants"))


@query("shp16_parse_option", "SELECT p_partkey, p_brand AS colour, CAST(p_size AS VARCHAR) AS size FROM part")
def shp16(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("Color: "), "p_brand", F.lit("/Size:"), F.col("p_size").cast("string")).alias("o"))
    m = p.select("p_partkey", A.parse_option("o").alias("m"))
    return m.select("p_partkey", F.col("m")["color"].alias("colour"), F.col("m")["size"].alias("size"))


@query("sc6_strip_tags", "SELECT page_id, md5(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS body FROM pages")
def sc6(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(S.strip_tags("html")).alias("body"))


@query("sc12_keyword", "SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: NOT regexp_matches(w, '[0-9]'))[1:2], ' ') AS keyword FROM part")
def sc12(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.keyword_of("p_name", 2).alias("keyword"))


@query("sc9_keys", "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1 FROM documents")
def sc9(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"), F.sha1("text").alias("sha1"))


@query("sc5_normal_forms", "SELECT doc_id, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS soft, md5(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g')) AS hard FROM documents")
def sc5(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(S.soft_text("text")).alias("soft"), F.md5(S.hard_text("text")).alias("hard"))


# The rules above over whole tables: accented and other scripts, null texts, names with a colour word, titles with a
# repeated word. They have no SQL, since DuckDB and Spark differ in such rows.


@query("att1_fold_all")
def att1_all(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(A.fold("text", {"the": "da"})).alias("folded"))


@query("att7_colour_all")
def att7_all(spark, sf):
    return table(spark, sf, "part").select("p_partkey", A.colour("p_name").alias("colour"))


@query("att24_polarity_all")
def att24_all(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.polarity("text", ("ing",), ("stupid", "trash")).alias("polarity"))


@query("att26_question_all")
def att26_all(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", A.is_question("text").alias("question"))


@query("att27_clean_colours_all")
def att27_all(spark, sf):
    return v_title(spark, sf).select("title_id", joined(A.clean_colours("title")).alias("words"))
