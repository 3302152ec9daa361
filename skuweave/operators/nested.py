"""Nested records of any depth: taxonomy walks with evidence, FAQs, dotted pairs, and the facts of raw pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.sources.shared import cut

#: Parts of a taxonomy that hold no points.
SKIP = ("flags", "overall_recommendation")
#: Labels of notices and specifications; other labels are menus.
LABELS = (
    "소재|제조|원산|색상|사이즈|치수|중량|용량|품질|보증|성분|혼용|재질|규격|모델|상품명|color|size|material|origin|brand|"
    "세탁|취급|관리|KC|인증|배송|반품|교환|A/S|책임|업체|수입|판매원|무게|용도|출시|시즌"
)
OBJECT, ARRAY = "OBJECT%", "ARRAY%"


def unrolled(sql: str, **frames) -> DataFrame:
    """A recursive query over the frames, written once; its rows are not limited, its depth is that of the data."""
    spark = next(f.sparkSession for f in frames.values() if isinstance(f, DataFrame))
    limit = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return cut(spark.sql(sql, **frames), "unrolled")
    finally:
        spark.conf.set(limit, was)


# Taxonomies --------------------------------------------------------------------------------------------------------

#: Objects are descended; everything else is a leaf of its path. A step is one round for all records.
_WALK = """
WITH RECURSIVE walk(uid, path, v) AS (
  SELECT uid, '' AS path, v FROM {blocks}
  UNION ALL
  SELECT w.uid, CASE WHEN w.path = '' THEN e.key ELSE concat(w.path, '.', e.key) END, e.value
  FROM walk w, LATERAL variant_explode(w.v) e WHERE e.key IS NOT NULL AND e.key NOT IN ({skip})
)
SELECT uid, path, v FROM walk WHERE path <> '' AND variant_get(v, '$[0].point', 'string') IS NOT NULL
"""


def walk_points(blocks: DataFrame, uid: str = "product_uid", taxonomy: str = "taxonomy", skip: tuple[str, ...] = SKIP) -> DataFrame:
    """Taxonomy JSON -> (uid, dim_path, point, cited, ord, evidence): objects of any depth, arrays of points are leaves.

    A key in `skip` is skipped wherever it is, so are arrays whose first item has no point. Empty cells and points without text give no
    row, neither does text that is no JSON. evidence is an array of (source_id, quote, match) in its order, empty if there is none.
    """
    start = blocks.select(F.col(uid).alias("uid"), F.try_parse_json(taxonomy).alias("v")).where("v is not null")
    names = ", ".join("'" + s.replace("'", "''") + "'" for s in skip) or "''"
    found = unrolled(_WALK.replace("{skip}", names), blocks=start)
    items = found.lateralJoin(found.sparkSession.tvf.variant_explode(F.col("v").outer()))
    evidence = F.variant_get("value", "$.evidence", "array<struct<source_id:string,quote:string,match:string>>")
    out = items.select(
        F.col("uid").alias(uid), F.col("path").alias("dim_path"), F.try_variant_get("value", "$.point", "string").alias("point"), F.try_variant_get("value", "$.cited", "int").alias("cited"), F.col("pos").alias("ord"),
        F.coalesce(evidence, F.array().cast("array<struct<source_id:string,quote:string,match:string>>")).alias("evidence"),
    )
    return out.where("point is not null and point <> ''")


def point_evidence(points: DataFrame, uid: str = "product_uid") -> DataFrame:
    """Points with evidence -> one row for each piece, keyed to its point: (uid, dim_path, point_ord, ord, local_source_id, quote, match)."""
    e = points.select(uid, "dim_path", F.col("ord").alias("point_ord"), F.posexplode("evidence").alias("ord", "e"))
    return e.select(uid, "dim_path", "point_ord", "ord", F.col("e.source_id").alias("local_source_id"), F.coalesce("e.quote", F.lit("")).alias("quote"), F.col("e.match").alias("match"))


def nest_points(points: DataFrame, uid: str = "product_uid") -> DataFrame:
    """The inverse of walk_points: (uid, dim_path, ord, point, cited, evidence) -> one JSON tree per uid, of any depth."""
    item = F.struct("ord", "point", "cited", "evidence")
    rows = points.groupBy(uid, F.split("dim_path", r"\.").alias("p")).agg(F.to_json(F.transform(F.sort_array(F.collect_list(item)), lambda x: x.dropFields("ord"))).alias("json"))
    rows = cut(rows, "leaves")
    deepest = rows.agg(F.max(F.size("p"))).first()[0] or 0
    at = None
    name = lambda k: F.to_json(F.array(k)).substr(F.lit(2), F.length(F.to_json(F.array(k))) - 2)  # noqa: E731  a key with its quotes
    for level in range(deepest, 0, -1):
        here = rows.where(F.size("p") == level)
        here = here if at is None else here.unionByName(at)
        entry = F.struct(F.get("p", F.lit(level - 1)).alias("k"), "json")
        up = here.groupBy(uid, F.slice("p", 1, level - 1).alias("p")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda x: F.concat(name(x["k"]), F.lit(":"), x["json"])), ",").alias("json"))
        at = up.withColumn("json", F.concat(F.lit("{"), F.col("json"), F.lit("}")))
    return at.select(uid, F.col("json").alias("taxonomy")) if at is not None else rows.select(uid, F.col("json").alias("taxonomy"))


# FAQs --------------------------------------------------------------------------------------------------------------

EVIDENCE = "array<struct<source_id:string,quote:string,match:string>>"
FAQS = f"array<struct<question:string,short_answer:string,cited_examples:int,answer_evidence:{EVIDENCE},question_evidence:{EVIDENCE}>>"


def faq_rows(blocks: DataFrame, uid: str = "product_uid", faqs: str = "faqs") -> DataFrame:
    """A JSON array of FAQs per uid -> (uid, ord, question, short_answer, cited, answer_evidence, question_evidence)."""
    f = blocks.select(uid, F.posexplode(F.from_json(faqs, FAQS)).alias("ord", "f"))
    return f.select(uid, "ord", F.coalesce("f.question", F.lit("")).alias("question"), "f.short_answer", F.col("f.cited_examples").alias("cited"), "f.answer_evidence", "f.question_evidence")


def faq_evidence(faqs: DataFrame, uid: str = "product_uid") -> DataFrame:
    """faq_rows -> (uid, faq_ord, role, ord, local_source_id, quote, match): evidence of the answer and of the question."""
    out = None
    for role in ("answer", "question"):
        e = faqs.select(uid, F.col("ord").alias("faq_ord"), F.lit(role).alias("role"), F.posexplode(f"{role}_evidence").alias("ord", "e"))
        e = e.select(uid, "faq_ord", "role", "ord", F.col("e.source_id").alias("local_source_id"), F.coalesce("e.quote", F.lit("")).alias("quote"), F.col("e.match").alias("match"))
        out = e if out is None else out.unionByName(e)
    return out


def faq_chunks(faqs: DataFrame, head: Column, metadata: dict[str, Column], uid: str = "product_uid") -> DataFrame:
    """Retrieval chunks '<head> - Q: <question> A: <answer>' with their hash and a metadata map."""
    body = F.trim(F.concat(head, F.lit(" - Q: "), F.col("question"), F.lit(" A: "), F.coalesce("short_answer", F.lit(""))))
    entries = [x for k, v in {**metadata, "qa": F.lit("true")}.items() for x in (F.lit(k), v.cast("string"))]
    meta = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
    return faqs.select(uid, F.lit("faq").alias("kind"), F.col("ord").alias("ref_id"), body.alias("body"), F.md5(body).alias("content_hash"), meta.alias("metadata"))


# Dotted pairs ------------------------------------------------------------------------------------------------------

#: Objects by their keys but @ ones (@type stays); of a list of objects or lists the first items; other lists are leaves.
_FLATTEN = """
WITH RECURSIVE walk(id, path, v) AS (
  SELECT id, '' AS path, v FROM {start}
  UNION ALL
  SELECT w.id, concat(w.path, coalesce(e.key, cast(e.pos AS string)), '.'), e.value
  FROM walk w, LATERAL variant_explode(w.v) e
  WHERE CASE WHEN e.key IS NOT NULL THEN e.key NOT LIKE '@%' OR e.key = '@type'
             ELSE e.pos < {items} AND (schema_of_variant(variant_get(w.v, '$[0]', 'variant')) LIKE 'OBJECT%' OR schema_of_variant(variant_get(w.v, '$[0]', 'variant')) LIKE 'ARRAY%') END
)
SELECT id, path, v, schema_of_variant(v) AS kind FROM walk WHERE path <> ''
"""


def flatten_json(df: DataFrame, key: str, text: str, items: int = 2, joined: int = 10, longest: int = 120) -> DataFrame:
    """JSON text of any depth -> (key, name, value), the name a dotted path.

    Keys that start with @ are skipped, but @type. A list of objects or lists gives its first `items` by number, a list of values its
    first `joined`, joined by ', '. Null, empty texts and empty lists give no row; values are cut at `longest` characters, those of lists not.
    Text that is no JSON, or only a value, gives no row. Of repeated rows of a key one row for each name and value stays.
    """
    start = df.select(F.col(key).alias("id"), F.try_parse_json(text).alias("v")).where("v is not null")
    found = unrolled(_FLATTEN.replace("{items}", str(items)), start=start)
    nested = F.schema_of_variant(F.variant_get("v", "$[0]", "variant"))
    values = F.col("kind").like(ARRAY) & ~F.coalesce(nested.like(OBJECT) | nested.like(ARRAY), F.lit(False))
    listed = F.array_join(F.slice(F.try_variant_get("v", "$", "array<string>"), 1, joined), ", ", "null")
    value = F.when(values, listed).when(~F.col("kind").like(OBJECT) & ~F.col("kind").like(ARRAY), F.left(F.try_variant_get("v", "$", "string"), F.lit(longest)))
    out = found.select(F.col("id").alias(key), F.expr("left(path, length(path) - 1)").alias("name"), value.alias("value"))
    return out.where("value is not null and value <> ''").distinct()


# Pages -------------------------------------------------------------------------------------------------------------

_BLOCK = r"(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
_SPEC = r"(?s)<(?:th|dt|strong)[^>]*>\s*([가-힣A-Za-z /()]{2,16})\s*</(?:th|dt|strong)>\s*<(?:td|dd|div|span)[^>]*>(.*?)</"
_META = r'<meta[^>]+(?:property|name)="((?:og|product):[^"]+)"[^>]+content="([^"]*)"'
_OPTION = r'<option[^>]*value="[^"]+"[^>]*>([^<]{1,40})</option>'


def json_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The JSON-LD objects of pages: (key, block, v). Lists and @graph give their items; a block that is no JSON is left out."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(_BLOCK), F.lit(1))).alias("block", "t"))
    found = found.select(key, "block", F.try_parse_json(F.trim("t")).alias("v")).where("v is not null")
    graph = F.try_variant_get("v", "$['@graph']", "array<variant>")
    parts = F.when(F.schema_of_variant("v").like(ARRAY), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.coalesce(graph, F.array("v")))
    out = found.select(key, "block", F.posexplode(parts).alias("part", "v"))
    return out.where(F.schema_of_variant("v").like(OBJECT)).select(key, (F.col("block") * 1000 + F.col("part")).alias("block"), "v")


def page_facts(pages: DataFrame, key: str = "page_id", html: str = "html", labels: str = LABELS, options: int = 30) -> DataFrame:
    """Raw pages -> (key, kind, name, value).

    title; jsonld: the dotted pairs of all JSON-LD objects, a later one's value first; meta: og: and product: pairs, the last of a name;
    spec: label and value of tables and lists whose label is one of `labels`, the first of a label, tags and entities resolved, under 100
    characters; option: the first `options` choices by number, without prompts. Null pages have no facts. Keys are unique.
    """
    text = lambda c: F.trim(F.regexp_replace(S.strip_tags(c), r"\s+", " "))
    title = pages.select(key, F.lit("title").alias("kind"), F.lit("title").alias("name"), F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("value"))

    blocks = json_blocks(pages, key, html).select(F.struct(F.col(key).alias("k"), F.col("block").alias("b")).alias("id"), F.to_json("v").alias("j"))
    flat = flatten_json(blocks, "id", "j").groupBy(F.col("id.k").alias(key), "name").agg(F.max_by("value", F.struct("id.b", "value")).alias("value"))
    ld = flat.select(key, F.lit("jsonld").alias("kind"), "name", "value")

    def pairs(pattern: str) -> DataFrame:
        both = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("b"))
        return pages.select(key, F.posexplode(both).alias("pos", "x")).select(key, "pos", F.col("x.a").alias("a"), F.col("x.b").alias("b"))

    meta = pairs(_META).where(F.trim("b") != "").groupBy(key, F.col("a").alias("name")).agg(F.max_by(F.left("b", F.lit(120)), "pos").alias("value"))
    spec = pairs(_SPEC).select(key, "pos", F.trim("a").alias("name"), text("b").alias("value"))
    spec = spec.where((F.col("value") != "") & ~F.startswith("value", F.lit("#")) & (F.length("value") < 100) & F.col("name").rlike(labels))
    spec = spec.groupBy(key, "name").agg(F.min_by("value", "pos").alias("value"))
    choice = F.filter(F.transform(F.regexp_extract_all(html, F.lit(_OPTION), F.lit(1)), text), lambda o: (o != "") & ~o.rlike("(?i)^(선택|choose|-+$)"))
    choices = pages.select(key, F.posexplode(F.slice(choice, 1, options)).alias("pos", "value")).select(key, F.lit("option").alias("kind"), F.col("pos").cast("string").alias("name"), "value")
    out = title.where("value <> ''").unionByName(ld).unionByName(choices)
    for kind, rows in (("meta", meta), ("spec", spec)):
        out = out.unionByName(rows.select(key, F.lit(kind).alias("kind"), "name", "value"))
    return out
