"""Readers: insight lines, variant trees, listing arrays, catalogues, attribute bags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuweave.functions import scalars as S

#: One insight of a product per line.
INSIGHT_SCHEMA = "uid string, source string, fetched_at string, dims array<struct<path: string, points: array<struct<point: string, cited: bigint>>>>"
TREE_SCHEMA = "parent_uid string, keyword string, sizes array<struct<value: string, counts: array<struct<ctlg_no: bigint, disp: string>>>>"
LISTING_SCHEMA = "title string, mall string, price bigint, link string"
#: Section -> key -> value, where a value is a text or a list of texts.
ATTRIBUTE_SCHEMA = "uid string, attrs map<string, map<string, string>>"


def read_insights(spark: SparkSession, path: str, schema: str = INSIGHT_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """JSON lines -> (insights, refused lines). Blank lines are skipped; a line that is no such object is refused."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    read = lines.select("value", F.from_json("value", f"{schema}, _refused string", {"columnNameOfCorruptRecord": "_refused"}).alias("row"))
    bad = F.col("row").isNull() | F.col("row._refused").isNotNull()
    return read.where(~bad).select("row.*").drop("_refused"), read.where(bad).select(F.col("value").alias("_refused"))


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """Variant trees -> one row per count of a size: parent_uid, keyword, size, ctlg_no, disp; empty levels keep a row."""
    trees = spark.read.schema(TREE_SCHEMA).json(path)
    sizes = trees.select("parent_uid", "keyword", F.explode_outer("sizes").alias("s"))
    counts = sizes.select("parent_uid", "keyword", F.col("s.value").alias("size"), F.explode_outer("s.counts").alias("c"))
    return counts.select("parent_uid", "keyword", "size", "c.ctlg_no", F.coalesce("c.disp", "size").alias("disp"))


def read_listings(spark: SparkSession, glob: str, schema: str = LISTING_SCHEMA) -> DataFrame:
    """Files with a JSON array of listings each -> priced listings, one for each title, mall and price."""
    rows = spark.read.schema(schema).option("multiLine", True).json(glob)
    return rows.where("price > 0").groupBy("title", "mall", "price").agg(F.min("link").alias("link"))


def read_catalogs(spark: SparkSession, paths: dict[str, str], brand_of: dict[str, str] | None = None, least: int = 3) -> DataFrame:
    """CSV catalogues with a header each (UTF-8, a byte order mark may be there) -> one table, all columns text.

    paths: source -> path. Missing columns are null; brand is the source's where the file has none; mfg_date is taken
    from the JSON column specs. A file of under `least` rows is dropped.
    """
    parts = []
    for source, path in paths.items():
        rows = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
        rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
        parts.append(rows.withColumns({"source": F.lit(source), "_file": F.input_file_name()}))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name in ("brand", "specs"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    enough = rows.groupBy("_file").count().where(F.col("count") >= least).select("_file")
    brand = F.coalesce(F.nullif(F.trim("brand"), F.lit("")), S.from_map("source", brand_of or {"": ""}, None))
    out = rows.join(enough, "_file", "left_semi").drop("_file")
    return out.withColumns({"brand": brand, "mfg_date": F.get_json_object("specs", "$.mfg_date")})


def read_attrs(spark: SparkSession, path: str, longest: int = 300) -> DataFrame:
    """Attribute bags as JSON lines -> (uid, section, key, value): lists joined by ', ', values cut at `longest`."""
    bags = spark.read.schema(ATTRIBUTE_SCHEMA).json(path)
    flat = bags.select("uid", F.explode("attrs").alias("section", "bag")).select("uid", "section", F.explode("bag").alias("key", "value"))
    return flat.withColumn("value", F.left(_joined(F.col("value")), F.lit(longest))).where("value <> ''")


def _joined(value: Column) -> Column:
    """A JSON list of texts joined by ', '; any other text as it is."""
    items = F.from_json(value, "array<string>")
    return F.when(F.startswith(value, F.lit("[")) & items.isNotNull(), F.array_join(items, ", ")).otherwise(value)
