"""Insight points, attribute ranking, representatives, citation grounding and variant families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.sources.shared import cut

DIM_LABELS = {"strengths": "Strengths", "weaknesses": "Weaknesses", "taste": "Taste", "size": "Size", "scene": "Scene of use"}
SELLER_ONLY = ("verdict.weaknesses",)


def attribute_coverage(points: DataFrame, by: str = "bundle_uid") -> DataFrame:
    """Per category and dimension: bundles that mention it, their share, citations and points. by picks the denominator."""
    total = points.groupBy("category").agg(F.countDistinct(by).alias("n_bundles"))
    dims = points.groupBy("category", "dim_path").agg(F.countDistinct(by).alias("n_with"), F.sum("cited").alias("cited"), F.count("*").alias("n_points"))
    return dims.join(total, "category").withColumn("coverage", F.bround(F.col("n_with") / F.col("n_bundles"), 4))


def global_coverage(points: DataFrame, by: str = "bundle_uid") -> DataFrame:
    c = attribute_coverage(points, by)
    total = c.select("category", "n_bundles").distinct().agg(F.sum("n_bundles").alias("all"))
    return c.groupBy("dim_path").agg(F.sum("n_with").alias("n_with")).join(F.broadcast(total)).select("dim_path", "n_with", F.bround(F.col("n_with") / F.col("all"), 4).alias("base"))


def rank_attributes(
    points: DataFrame, by: str = "bundle_uid", rank_by: str = "hybrid", top: int = 5, min_coverage: float = 0.2, min_support: int = 2, min_bundles: int = 3, pinned: tuple[str, ...] = ("verdict.strengths",)
) -> DataFrame:
    """Ranks the dimensions of a category by coverage, lift or coverage * lift, from the already rounded figures.

    Dimensions need min_coverage and min_support bundles (1 where the category has fewer than min_bundles); pinned
    beginnings stay whatever their rank. Ties: coverage, then the dimension's name.
    """
    c = attribute_coverage(points, by).join(global_coverage(points, by).select("dim_path", "base"), "dim_path")
    c = c.withColumn("lift", F.bround(F.try_divide("coverage", "base"), 3))
    key = {"coverage": F.col("coverage"), "lift": F.col("lift"), "hybrid": F.col("coverage") * F.col("lift")}[rank_by]
    support = F.when(F.col("n_bundles") < min_bundles, 1).otherwise(min_support)
    c = c.where((F.col("coverage") >= min_coverage) & (F.col("n_with") >= support)).withColumn("key", F.bround(key, 6))
    w = Window.partitionBy("category").orderBy(F.desc("key"), F.desc("coverage"), "dim_path")
    c = c.withColumn("rank", F.row_number().over(w)).withColumn("pinned", S.any_of([F.startswith("dim_path", F.lit(p)) for p in pinned]))
    return c.where((F.col("rank") <= top) | F.col("pinned"))


def representatives(points: DataFrame, ranks: DataFrame, per_dim: int = 3) -> DataFrame:
    """The most cited points of each bundle for the ranked dimensions of its category, in the category's order."""
    w = Window.partitionBy("category", "bundle_uid", "dim_path").orderBy(F.desc("cited"), "ord")
    top = points.join(ranks.select("category", "dim_path", "rank"), ["category", "dim_path"]).withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_dim)
    return top.select("category", "bundle_uid", "dim_path", "rank", "r", "point", "cited")


def best_dims(points: DataFrame, key: str, per_dim: int = 3, max_dims: int = 6) -> DataFrame:
    """Up to max_dims dimensions of a key by summed citations, and the per_dim best points of each."""
    p = Window.partitionBy(key, "dim_path").orderBy(F.desc("cited"), "ord")
    d = Window.partitionBy(key).orderBy(F.desc("dim_cited"), "dim_path")
    dims = points.groupBy(key, "dim_path").agg(F.sum("cited").alias("dim_cited")).withColumn("d", F.row_number().over(d)).where(F.col("d") <= max_dims)
    return points.withColumn("r", F.row_number().over(p)).where(F.col("r") <= per_dim).join(dims, [key, "dim_path"]).select(key, "dim_path", "d", "r", "point", "cited")


def weakness_ranking(points: DataFrame, themes: Column) -> DataFrame:
    w = points.where(F.startswith("dim_path", F.lit("verdict.weaknesses"))).withColumn("theme", themes)
    out = w.groupBy("category", "theme").agg(F.sum(F.coalesce(F.nullif(F.col("cited"), F.lit(0)), F.lit(1))).alias("weight"))
    return out.withColumn("share", F.bround(F.col("weight") / F.sum("weight").over(Window.partitionBy("category")), 4))


def attribute_gap(points: DataFrame, ranks: DataFrame) -> DataFrame:
    """Ranked dimensions of the category that a bundle does not have, in order of rank."""
    have = points.select("category", "bundle_uid", "dim_path").distinct()
    want = have.select("category", "bundle_uid").distinct().join(ranks.select("category", "dim_path", "rank"), "category")
    gone = want.join(have, ["category", "bundle_uid", "dim_path"], "left_anti")
    return gone.groupBy("category", "bundle_uid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "dim_path"))), lambda s: s["dim_path"]), "|").alias("missing"), F.count("*").alias("n_missing"))


def heat_map(points: DataFrame, per_category: int = 8, dims: int = 10) -> DataFrame:
    """Points per category for the dimensions most often among a category's top ones; missing cells are 0."""
    counts = points.groupBy("category", "dim_path").agg(F.count("*").alias("n"))
    w = Window.partitionBy("category").orderBy(F.desc("n"), "dim_path")
    often = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_category).groupBy("dim_path").count().orderBy(F.desc("count"), "dim_path").limit(dims)
    grid = counts.select("category").distinct().join(often.select("dim_path"), how="inner", on=F.lit(True))
    return grid.join(counts, ["category", "dim_path"], "left").select("category", "dim_path", F.coalesce("n", F.lit(0)).alias("n"))


def dim_label(c) -> Column:
    """The label of a dimension's last part, or that part itself. The path is section.part.state or longer."""
    part = F.element_at(F.slice(F.split(S.col(c), r"\."), 1, 9), -2)
    return S.from_map(part, DIM_LABELS, part)


def chunks(points: DataFrame, head: str = "product_uid") -> DataFrame:
    """Retrieval chunks '<head> - <label>: <point>' with their hash."""
    body = F.concat(F.col(head), F.lit(" - "), dim_label("dim_path"), F.lit(": "), F.col("point"))
    return points.select(head, F.lit("point").alias("kind"), F.col("ord").alias("ref_id"), body.alias("body"), F.md5(body).alias("content_hash"))


def chunk_delta(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """new, gone, stale or same for each key of two snapshots, by a hash of the value."""
    o, n = old.select(key, F.md5(value).alias("h_old")), new.select(key, F.md5(value).alias("h_new"))
    j = o.join(n, key, "full_outer")
    return j.select(key, F.when(F.col("h_old").isNull(), "new").when(F.col("h_new").isNull(), "gone").when(F.col("h_old") != F.col("h_new"), "stale").otherwise("same").alias("state"))


def shared_points(points: DataFrame, family: str, member: str) -> DataFrame:
    """Points that at least two members of a family have, with the number of members."""
    return points.groupBy(family, "dim_path", "point").agg(F.countDistinct(member).alias("n_members")).where("n_members >= 2")


def parent_lines(points: DataFrame, key: str, first: int = 40) -> DataFrame:
    """The distinct points of a key in order, the first 40, as one text."""
    one = points.groupBy(key, "point").agg(F.min("ord").alias("ord"))
    w = Window.partitionBy(key).orderBy("ord", "point")
    one = one.withColumn("r", F.row_number().over(w)).where(F.col("r") <= first)
    return one.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "point"))), lambda s: s["point"]), "|").alias("lines"), F.count("*").alias("n"))


def customer_view(points: DataFrame, per_section: int = 3, sections: int = 5) -> DataFrame:
    """Sections for customers: seller-only dimensions hidden, a text shown once, three points a section, five sections."""
    p = points.where(~S.any_of([F.startswith("dim_path", F.lit(x)) for x in SELLER_ONLY])).withColumn("section", F.substring_index("dim_path", ".", 2))
    once = Window.partitionBy("bundle_uid", "point").orderBy(F.desc("cited"), "ord")
    p = p.withColumn("u", F.row_number().over(once)).where("u = 1")
    r = Window.partitionBy("bundle_uid", "section").orderBy(F.desc("cited"), "ord")
    s = Window.partitionBy("bundle_uid").orderBy("section")
    return p.withColumn("r", F.row_number().over(r)).withColumn("s", F.dense_rank().over(s)).where((F.col("r") <= per_section) & (F.col("s") <= sections)).select("bundle_uid", "section", "r", "point", "cited")


def snippet_budget(items: DataFrame, group: str, order: str, text: str, budget: int = 28_000) -> DataFrame:
    """Items in order while their running length stays in the budget; the first always; nothing after the first overflow."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = items.withColumn("running", F.sum(F.length(text)).over(w)).withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    return out.withColumn("kept", (F.col("place") == 1) | (F.col("running") <= budget))


def family_tree(members: DataFrame, family: str, member: str, signature: str) -> DataFrame:
    """Each member's parent: the family member with the largest signature that is a proper part of its own, else none.

    Of equally large ones the smallest member counts. Equal signatures are one row while signatures are compared, and a
    signature meets only those that hold its first element; an empty one is nobody's parent.
    """
    m = members.select(family, F.col(member).alias("child"), F.sort_array(F.array_distinct(signature)).alias("s"))
    kinds = m.groupBy(family, "s").agg(F.min("child").alias("parent"))
    parts = kinds.where(F.size("s") > 0).select(family, F.col("s").alias("p"), "parent", F.get("s", F.lit(0)).alias("w"))
    wholes = kinds.select(family, "s", F.explode("s").alias("w"))
    cand = wholes.join(parts, [family, "w"]).where((F.size("p") < F.size("s")) & (F.size(F.array_except("p", "s")) == 0))
    best = cand.groupBy(family, "s").agg(F.max(F.struct(F.size("p").alias("n"), (-F.col("parent")).alias("low"))).alias("b")).select(family, "s", (-F.col("b.low")).alias("parent"))
    return m.join(best, [family, "s"], "left").select(family, "child", "parent")


def ancestors(tree: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ancestor, distance) of a forest of (child, parent), by a recursive query: one step a level, no level in one task."""
    spark, limit = tree.sparkSession, "spark.sql.cteRecursionRowLimit"
    links = cut(tree.select(F.col(child).alias("child"), F.col(parent).alias("parent")).where("parent is not null"), "links")
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # rows grow with the table; the recursion ends with the tree
    try:
        return cut(spark.sql("""
            WITH RECURSIVE up(child, ancestor, distance) AS (
              SELECT child, parent, 1 FROM {links} UNION ALL SELECT u.child, l.parent, u.distance + 1 FROM up u JOIN {links} l ON u.ancestor = l.child
            ) SELECT * FROM up""", links=links), "ancestors")  # fmt: skip
    finally:
        spark.conf.set(limit, was)


def distinctive(points: DataFrame, above: DataFrame, shared: DataFrame, family: str) -> DataFrame:
    """points (family, member, dim, point) without those of the member's ancestors and those that the family shares (family, point)."""
    inherited = above.join(points.select(F.col("member").alias("ancestor"), "point").distinct(), "ancestor").select(F.col("child").alias("member"), "point")
    return points.join(inherited, ["member", "point"], "left_anti").join(shared, [family, "point"], "left_anti")


def variant_points(tree: DataFrame, points: DataFrame, shared: DataFrame, family: str) -> tuple[DataFrame, DataFrame]:
    """A family's points along its tree: (node, level, dim, point) of what each node says first, and the nodes that stay.

    tree: family, child, parent (null under the family's root); points: family, member, dim, point; shared: family, point.
    1. A member's own points are those that neither the family shares nor an ancestor has.
    2. From the lowest level up, a point that two or more children of a node have goes to the node, with the dimension of
       the first child; children of the root give to the family (node null, level 0).
    3. A node stays if it or a node below it has points of its own.
    Levels are as many as the longest chain of signatures, each one grouping of its own rows. A member of several rows of a point
    has it once, in its first dimension. Points of members that are not in the tree are left out.

    Returns (family, node, level, dim, point) and (family, node, parent, level, n_points).
    """
    above = ancestors(tree)
    depth = above.groupBy("child").agg((F.max("distance") + 1).alias("level"))
    nodes = tree.select(family, F.col("child").alias("node"), "parent").join(depth.withColumnRenamed("child", "node"), "node", "left").withColumn("level", F.coalesce("level", F.lit(1)))
    nodes = cut(nodes, "nodes")
    own = points.groupBy(family, "member", "point").agg(F.min("dim").alias("dim"))
    first = distinctive(own, above, shared.select(family, "point").distinct(), family)
    first = cut(first.withColumnRenamed("member", "node").join(nodes.select("node", "parent", "level"), "node"), "own-points")
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    cols, done, at = [family, "node", "parent", "level", "dim", "point"], [], None
    for level in range(deepest, 0, -1):
        here = first.where(F.col("level") == level).select(*cols)
        if at is not None:  # what came up from below, where the node does not say it itself
            here = here.unionByName(at.join(here.select("node", "point"), ["node", "point"], "left_anti").select(*cols))
        common = here.groupBy(family, "parent", "point").agg(F.count_distinct("node").alias("n"), F.min(F.struct("node", "dim"))["dim"].alias("dim")).where("n >= 2")
        common = cut(common, "common")
        key = here[family].eqNullSafe(common[family]) & here["parent"].eqNullSafe(common["parent"]) & (here["point"] == common["point"])
        done.append(here.join(common, key, "left_anti"))
        up = common.withColumnRenamed("parent", "node").join(nodes.select("node", "parent"), "node", "left").withColumn("level", F.lit(level - 1))
        root = up.where("node is null").select(*cols)
        done.append(root)
        at = up.where("node is not null").select(*cols)
    out = done[0] if done else first.select(*cols)
    for d in done[1:]:
        out = out.unionByName(d)
    # The family's own points come from several levels at once, each once, in the dimension of the lowest level number.
    out = cut(out.select(family, "node", F.when(F.col("node").isNull(), 0).otherwise(F.col("level")).alias("level"), "dim", "point"), "tree-points")
    top = out.where("node is null").groupBy(family, "point").agg(F.min("dim").alias("dim")).select(family, F.lit(None).cast(nodes.schema["node"].dataType).alias("node"), F.lit(0).alias("level"), "dim", "point")
    out = out.where("node is not null").unionByName(top)
    count = out.where("node is not null").groupBy("node").agg(F.count("*").alias("n_points"))
    alive = count.select("node").union(above.join(count, F.col("child") == F.col("node")).select(F.col("ancestor").alias("node"))).distinct()
    kept = nodes.join(alive, "node", "left_semi").join(count, "node", "left").select(family, "node", "parent", "level", F.coalesce("n_points", F.lit(0)).alias("n_points"))
    return out, kept


#: Sections of a customer's page in their order, and the dimensions that each takes, the first that fits.
SECTIONS = ("good", "taste", "spec", "pack", "use", "gift", "caveat")
SECTION_OF = (
    ("verdict.strengths", "good"), ("verdict.weaknesses", "caveat"), ("context.why.negative_concern", "caveat"), ("verdict.compare", None), ("verdict.trust", "spec"), ("aspect.taste", "taste"), ("aspect.texture", "taste"),
    ("aspect.sensory", "taste"), ("aspect.size", "pack"), ("aspect.care", "pack"), ("aspect.price_range", "pack"), ("aspect", "spec"), ("context.gift", "gift"), ("context", "use"),
)


def section_of(dim) -> Column:
    """The customer's section of a dimension; null where only sellers see it."""
    out, d = F.lit("use"), F.coalesce(S.col(dim), F.lit(""))
    for prefix, section in reversed(SECTION_OF):
        out = F.when(F.startswith(d, F.lit(prefix)), F.lit(section)).otherwise(out)
    return out


def customer_pages(points: DataFrame, key: str = "bundle_uid", per_section: int = 3, sections: int = 5, per_point: int = 3) -> DataFrame:
    """One nested row for each key: headline, review_count, and sections of (section, items of (text, mentions, evidence)).

    points: key, dim_path, dim_rank (the order of dimensions), ord (in the dimension), point, cited, evidence of (source, url, quote, is_ad).
    Seller-only dimensions are hidden, a text is shown once whatever its case and blanks, its mentions are its pieces of evidence, or
    its citations if it has none. A section has its most mentioned points, a point its first pieces of evidence with a link, those
    that are no advertisement first, quotes cut at 90 characters. The headline is the first strength, else the first text shown.
    """
    p = points.withColumn("text", F.trim("point")).withColumn("section", section_of("dim_path")).where("section is not null and text <> ''")
    pieces = F.coalesce(F.size("evidence"), F.lit(0))
    p = p.withColumn("mentions", F.when(pieces > 0, pieces).otherwise(F.coalesce("cited", F.lit(0))).cast("long")).withColumn("at", F.struct("dim_rank", "ord", "text"))
    linked = F.filter(F.coalesce("evidence", F.array().cast(points.schema["evidence"].dataType)), lambda e: F.coalesce(e["url"], F.lit("")) != "")
    ad = lambda e: F.coalesce(e["is_ad"], F.lit(False))
    shown = F.slice(F.concat(F.filter(linked, lambda e: ~ad(e)), F.filter(linked, ad)), 1, per_point)
    p = p.withColumn("shown", F.transform(shown, lambda e: F.struct(e["source"].alias("source"), e["url"].alias("url"), F.left(F.coalesce(e["quote"], F.lit("")), F.lit(90)).alias("quote"))))
    strong = p.where("section = 'good'").groupBy(key).agg(F.min_by("text", "at").alias("strength"))
    norm = F.replace(F.lower("text"), F.lit(" "), F.lit(""))
    once = p.withColumn("u", F.row_number().over(Window.partitionBy(key, norm).orderBy("at"))).where("u = 1")
    total = once.groupBy(key).agg(F.sum("mentions").alias("review_count"))
    best = once.withColumn("r", F.row_number().over(Window.partitionBy(key, "section").orderBy(F.desc("mentions"), "at"))).where(F.col("r") <= per_section)
    place = F.array_position(F.lit(list(SECTIONS)), F.col("section"))
    items = F.transform(F.sort_array(F.collect_list(F.struct("r", F.struct("text", "mentions", F.col("shown").alias("evidence")).alias("i")))), lambda x: x["i"])
    by_section = best.groupBy(key, place.alias("place"), "section").agg(items.alias("items"))
    pages = by_section.groupBy(key).agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("place", F.struct("section", "items").alias("s")))), lambda x: x["s"]), 1, sections).alias("sections"))
    out = pages.join(total, key).join(strong, key, "left")
    first = F.get(F.get("sections", F.lit(0))["items"], F.lit(0))["text"]
    return out.select(key, F.coalesce("strength", first).alias("headline"), "review_count", "sections")
