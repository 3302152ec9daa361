"""Queries of the readers and writers: files made from the tables in the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.plans.registry import query
from skuweave.plans.views import table, v_offer, v_point, v_product, v_state
from skuweave.sources import readers, writers
from skuweave.sources.shared import new_path


@query("src1_read_insights", "SELECT bundle_uid AS uid, dim_path, point, CAST(cited AS BIGINT) AS cited, 0 AS refused FROM v_point UNION ALL SELECT concat('not json ', CAST(s_suppkey AS VARCHAR)), NULL, NULL, NULL, 1 FROM supplier")
def src1(spark, sf):
    dims = v_point(spark, sf).groupBy("bundle_uid", "dim_path").agg(F.collect_list(F.struct("point", F.col("cited").cast("bigint").alias("cited"))).alias("points"))
    blocks = dims.groupBy(F.col("bundle_uid").alias("uid")).agg(F.collect_list(F.struct(F.col("dim_path").alias("path"), "points")).alias("dims"))
    lines = blocks.select(F.to_json(F.struct("uid", "dims")).alias("value"))
    blank = table(spark, sf, "nation").select(F.lit("").alias("value"))
    wrong = table(spark, sf, "supplier").select(F.concat(F.lit("not json "), F.col("s_suppkey").cast("string")).alias("value"))
    lines.union(blank).union(wrong).write.text(path := new_path(spark, "insights"))
    good, refused = readers.read_insights(spark, path)
    points = good.select("uid", F.explode("dims").alias("d")).select("uid", F.col("d.path").alias("dim_path"), F.explode("d.points").alias("p"))
    points = points.select("uid", "dim_path", "p.point", "p.cited", F.lit(0).alias("refused"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("dim_path", "string"), ("point", "string"), ("cited", "bigint"))]
    return points.union(refused.select(F.col("_refused").alias("uid"), *none, F.lit(1).alias("refused")))


@query("src2_read_trees", "SELECT parent_uid, keyword, size, ctlg_no, uid AS disp FROM v_product UNION ALL SELECT concat('T', CAST(s_suppkey AS VARCHAR)), s_name, NULL, NULL, NULL FROM supplier")
def src2(spark, sf):
    from skuweave.operators.shape import trees_of

    trees = trees_of(v_product(spark, sf)).select("parent_uid", "keyword", "sizes")
    bare = table(spark, sf, "supplier").select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("parent_uid"), F.col("s_name").alias("keyword"))
    trees.unionByName(bare, allowMissingColumns=True).write.json(path := new_path(spark, "trees"))
    return readers.read_trees(spark, path)


@query("src3_read_listings", "SELECT title, mall, price, concat('https://', lower(mall), '/', CAST(min(day) AS VARCHAR)) AS link FROM v_offer WHERE qty % 7 <> 0 AND price > 0 GROUP BY title, mall, price")
def src3(spark, sf):
    o = v_offer(spark, sf)
    link = F.concat(F.lit("https://"), F.lower("mall"), F.lit("/"), F.col("day").cast("string"))
    one = F.struct("title", "mall", F.when(F.col("qty") % 7 != 0, F.col("price")).alias("price"), link.alias("link"))
    arrays = o.groupBy(F.col("brand"), F.pmod(F.xxhash64("product_uid"), F.lit(16)).alias("part")).agg(F.to_json(F.collect_list(one)).alias("value"))
    # One array to a file: each key has a folder of its own.
    arrays.repartition("brand", "part").write.partitionBy("brand", "part").text(path := new_path(spark, "listings"))
    return readers.read_listings(spark, f"{path}/*/*/*.txt")


@query(
    "src4_read_catalogs",
    """SELECT p_type AS source, CASE WHEN p_partkey % 4 = 0 THEN concat('house of ', lower(p_type)) ELSE p_brand END AS brand, p_name AS name,
  CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL ELSE concat(p_size, 'g') END AS size, CASE WHEN p_partkey % 3 = 0 THEN concat('2024-0', CAST(1 + p_partkey % 9 AS VARCHAR)) END AS mfg_date, CAST(p_partkey AS VARCHAR) AS seq FROM part""",
)
def src4(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_type").alias("kind"), F.col("p_partkey").cast("string").alias("seq"), F.col("p_name").alias("name"), F.concat(F.col("p_size").cast("string"), F.lit("g")).alias("size"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("brand"),
        F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.struct(F.concat(F.lit("2024-0"), (1 + F.col("p_partkey") % 9).cast("string")).alias("mfg_date")))).alias("specs"),
    )
    path, paths = new_path(spark, "catalogs"), {}
    for kind in ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE"):
        columns = ["seq", "name", "brand", "specs"] + ([] if kind in ("PROMO", "SMALL") else ["size"])
        own = p.where(F.col("kind") == kind).select(*columns).coalesce(1)
        own = own.withColumnRenamed("seq", "﻿seq") if kind == "LARGE" else own  # a byte order mark before the header
        own.write.option("header", True).option("escape", '"').csv(f"{path}/{kind}")
        paths[kind] = f"{path}/{kind}"
    table(spark, sf, "region").select(F.lit("1").alias("seq"), F.lit("two rows only").alias("name")).limit(2).coalesce(1).write.option("header", True).csv(f"{path}/STUB")
    rows = readers.read_catalogs(spark, paths | {"STUB": f"{path}/STUB"}, {k: f"house of {k.lower()}" for k in paths})
    return rows.select("source", "brand", "name", "size", "mfg_date", "seq")


@query(
    "src5_read_attrs",
    """SELECT uid, section, key, value FROM (
  SELECT concat('E', CAST(event_id AS VARCHAR)) AS uid, 'spec' AS section, 'type' AS key, event_type AS value FROM events
  UNION ALL SELECT concat('E', CAST(event_id AS VARCHAR)), 'spec', 'props', props FROM events
  UNION ALL SELECT concat('E', CAST(event_id AS VARCHAR)), 'more', 'list', concat('u', CAST(user_id AS VARCHAR), ', ', event_type) FROM events
  UNION ALL SELECT concat('E', CAST(event_id AS VARCHAR)), 'more', 'long', substr(repeat(concat(event_type, ' '), 80), 1, 300) FROM events)""",
)
def src5(spark, sf):
    e = table(spark, sf, "events")
    listed = F.to_json(F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.col("event_type")))
    spec = F.create_map(F.lit("type"), F.col("event_type"), F.lit("props"), F.col("props"), F.lit("none"), F.lit(""))
    more = F.create_map(F.lit("list"), listed, F.lit("long"), F.repeat(F.concat("event_type", F.lit(" ")), F.lit(80)))
    bag = F.struct(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("uid"), F.create_map(F.lit("spec"), spec, F.lit("more"), more).alias("attrs"))
    e.select(F.to_json(bag).alias("value")).write.text(path := new_path(spark, "attrs"))
    return readers.read_attrs(spark, path)


@query("snk1_write_seed", "SELECT uid AS insight_uid, CAST(ctlg_no AS VARCHAR) AS ctlg_no, parent_uid, keyword, size, NULL::VARCHAR AS color, category_l1 FROM v_product")
def snk1(spark, sf):
    writers.write_seed(v_product(spark, sf).withColumnRenamed("uid", "insight_uid"), path := new_path(spark, "seed"))
    return spark.read.option("header", True).csv(path)


@query(
    "snk2_append_results",
    "SELECT uid, CASE WHEN n_dims > 0 THEN 'done' WHEN attempts % 2 = 0 THEN 'empty' ELSE 'error' END AS status, CASE WHEN n_dims > 0 AND attempts >= 3 THEN 2 ELSE 1 END AS tries FROM v_state",
)
def snk2(spark, sf):
    s = v_state(spark, sf).select("uid", "n_dims", "attempts")
    path = new_path(spark, "results")
    # A first run in which what was tried often fails, a second for those with dimensions.
    failed = (F.col("n_dims") > 0) & (F.col("attempts") >= 3)
    writers.append_results(s.where(failed), path, "error")
    writers.append_results(s.where((F.col("n_dims") == 0) & (F.col("attempts") % 2 == 1)), path, "error")
    writers.append_results(s.where("n_dims > 0"), path, "done")
    writers.append_results(s.where((F.col("n_dims") == 0) & (F.col("attempts") % 2 == 0)), path, "empty")
    return writers.finished(spark.read.schema("uid string, status string, result struct<n_dims: int, attempts: int>").json(path))


@query(
    "snk7_report_tables",
    "SELECT category, mall, n, low, json FROM (SELECT category, mall, count(*) AS n, min(price) AS low FROM v_offer GROUP BY category, mall), LATERAL (SELECT 1 AS json UNION ALL SELECT 0)",
)
def snk7(spark, sf):
    report = v_offer(spark, sf).groupBy("category", "mall").agg(F.count("*").alias("n"), F.min("price").alias("low"))
    writers.write_report(report, path := new_path(spark, "report"), by="category")
    as_json = spark.read.schema("category string, mall string, n bigint, low bigint").json(f"{path}/json")
    columns = ["category", "mall", "n", "low"]
    return as_json.select(*columns, F.lit(1).alias("json")).union(spark.read.parquet(f"{path}/parquet").select(*columns, F.lit(0).alias("json")))
