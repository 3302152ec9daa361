"""Nested records to tables, and the joins and upserts of the product tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuweave.functions import scalars as S

def build_products(trees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """trees(parent_uid, keyword, sizes[]) -> (base rows and one row per size, refused sizes with the reason).

    A value with '::' or '|' would break the uid, an empty one has none: both are refused, and so is the second of a repeated value.
    """
    base = trees.select(F.col("parent_uid").alias("uid"), F.lit(None).cast("string").alias("parent_uid"), "keyword", F.lit("package").alias("type"))
    v = trees.select("parent_uid", "keyword", F.posexplode("sizes").alias("pos", "s")).select("parent_uid", "keyword", "pos", F.col("s.value").alias("value"))
    again = F.row_number().over(Window.partitionBy("parent_uid", "value").orderBy("pos")) > 1
    v = v.withColumn("reason", F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty").when(F.col("value").rlike(r"::|\|"), "separator").when(again, "repeated"))
    variants = v.where("reason is null").select(F.concat_ws("::", "parent_uid", "value").alias("uid"), "parent_uid", F.concat_ws(" ", "keyword", "value").alias("keyword"), F.lit("variant").alias("type"))
    return base.unionByName(variants), v.where("reason is not null").select("parent_uid", "pos", "value", "reason")


def catalog_rows(trees: DataFrame) -> DataFrame:
    """One row per SKU of a tree: sizes, then counts; a size without counts keeps one row."""
    s = trees.select("parent_uid", F.explode_outer("sizes").alias("s"))
    return s.select("parent_uid", F.col("s.value").alias("size"), F.explode_outer("s.counts").alias("c")).select("parent_uid", "size", F.col("c.ctlg_no").alias("ctlg_no"), F.coalesce("c.disp", "size").alias("disp"))


def trees_of(products: DataFrame) -> DataFrame:
    """Products nested as parent -> sizes[] -> counts[]."""
    counts = products.groupBy("parent_uid", "keyword", "size").agg(F.sort_array(F.collect_list(F.struct("ctlg_no", F.col("uid").alias("disp")))).alias("counts"))
    return counts.groupBy("parent_uid", "keyword").agg(F.sort_array(F.collect_list(F.struct(F.col("size").alias("value"), "counts"))).alias("sizes"))


def seed_rows(products: DataFrame) -> DataFrame:
    """A row per SKU with a catalogue number; a product without any gets one row of its own."""
    has = products.where("ctlg_no is not null")
    rest = products.select("parent_uid").distinct().join(has.select("parent_uid").distinct(), "parent_uid", "left_anti")
    return has.select("parent_uid", "ctlg_no", "size").unionByName(rest.select("parent_uid", F.lit(None).cast("bigint").alias("ctlg_no"), F.lit(None).cast("string").alias("size")))


def replace_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """target without the rows of any key in updates, and then updates; running it twice changes nothing."""
    return target.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def merge_preserving(new: DataFrame, old: DataFrame, key: str = "uid") -> DataFrame:
    """New rows keep what was produced meanwhile: a finished status whole, pending attempts of an unfinished one."""
    o = old.select(key, F.col("status").alias("o_status"), F.col("attempts").alias("o_attempts"), F.col("n_dims").alias("o_dims"))
    done, tried = F.col("o_status") == "done", (F.col("o_status") == "pending") & (F.col("o_attempts") > 0)
    return new.join(o, key, "left").select(
        key, F.when(done, F.col("o_status")).otherwise(F.col("status")).alias("status"),
        F.when(done | tried, F.col("o_attempts")).otherwise(F.col("attempts")).alias("attempts"), F.when(done, F.col("o_dims")).otherwise(F.col("n_dims")).alias("n_dims"),
    )


def upsert_labels(old: DataFrame, new: DataFrame, key: str, overwrite: bool) -> DataFrame:
    """One row per key of both; the new one counts only if overwrite, or if there is no old one.

    Of several rows of a key on one side the first by its columns' text counts.
    """
    both = old.withColumn("_p", F.lit(1 if overwrite else 0)).unionByName(new.withColumn("_p", F.lit(0 if overwrite else 1)))
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_p", F.to_json(F.struct(*old.columns))))).where("_r = 1").drop("_p", "_r")


def strong_key_match(seeds: DataFrame, rows: DataFrame, seed_id: str, row_id: str, keys: tuple[str, ...]) -> DataFrame:
    """The first key in order of priority that matches; of rows with the same key the first by id counts."""
    out = seeds
    for k in keys:
        first = rows.where(F.col(k).isNotNull() & (F.col(k).cast("string") != "")).groupBy(F.col(k).alias(k)).agg(F.min(row_id).alias(f"_by_{k}"))
        out = out.join(first, k, "left")
    hit = F.coalesce(*[F.col(f"_by_{k}") for k in keys])
    how = F.lit(None).cast("string")
    for k in reversed(keys):
        how = F.when(F.col(f"_by_{k}").isNotNull(), k).otherwise(how)
    return out.select(seed_id, hit.alias("match_id"), how.alias("method")).where("match_id is not null")


def attach_facts(products: DataFrame, facts: DataFrame) -> DataFrame:
    """Products with their SKUs' facts: status done or empty, number of facts, the first brand that is not empty."""
    j = products.join(facts, "ctlg_no", "left")
    real = F.coalesce(F.col("n_facts") > 0, F.lit(False))
    return j.groupBy("parent_uid").agg(
        F.when(F.max(real), "done").otherwise("empty").alias("status"), F.sum(F.coalesce("n_facts", F.lit(0))).cast("bigint").alias("n_facts"),
        F.min(F.when(F.coalesce(F.col("brand"), F.lit("")) != "", F.struct("ctlg_no", "brand")))["brand"].alias("brand"),
    )


def fill_missing(base: DataFrame, extra: DataFrame, key: str, columns: tuple[str, ...], order: str | None = None) -> DataFrame:
    """base with its empty columns filled from extra by key: the first value that is not empty, by order (or by value).

    Rows of base are never multiplied, however often a key is in extra.
    """
    place = lambda c: F.struct(order, c) if order else F.col(c)
    first = [F.min_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", place(c))).alias(f"_{c}") for c in columns]
    j = base.join(extra.groupBy(key).agg(*first), key, "left")
    return j.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}"), F.lit("")).alias(c) if c in columns else F.col(c) for c in base.columns])


def first_wins(df: DataFrame, keys: list[str], seq: str, cap: int | None = None) -> DataFrame:
    """The first row of each key in the order of collection; with cap only so many rows over all."""
    out = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).where("_r = 1").drop("_r")
    return out.orderBy(seq).limit(cap) if cap is not None else out


def fill_rates(df: DataFrame, by: str, columns: tuple[str, ...]) -> DataFrame:
    """Percent of rows of each group in which a column is not empty."""
    filled = [F.bround(F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "") * 100.0 / F.count("*"), 1).alias(f"{c}_pct") for c in columns]
    return df.groupBy(by).agg(F.count("*").alias("n"), *filled)


def facts_of_row(df: DataFrame, meta: tuple[str, ...], notice: tuple[str, ...]) -> DataFrame:
    """Two maps of a row's other columns without blanks: notice columns and the rest."""
    cols = [c for c in df.columns if c not in meta]
    as_map = lambda cs: F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in cs]), F.array(*[F.col(c).cast("string") for c in cs])), lambda k, v: F.coalesce(v, F.lit("")) != "")
    return df.select(*meta, as_map([c for c in cols if c in notice]).alias("notice"), as_map([c for c in cols if c not in notice]).alias("facts"))


def validate(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) for every rule that a row breaks."""
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda r: r.isNotNull())
    return df.select(key, F.explode(broken).alias("rule"))


def threshold_sweep(scored: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Precision, recall and F1 for each threshold."""
    t = F.broadcast(scored.sparkSession.createDataFrame([(x,) for x in thresholds], "threshold double"))
    hit, y = F.col(score) >= F.col("threshold"), F.col(label) == 1
    out = scored.join(t).groupBy("threshold").agg(F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"))
    p, r = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.withColumn("precision", F.bround(p, 4)).withColumn("recall", F.bround(r, 4)).withColumn("f1", F.bround(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("tp") * 2 + F.col("fp") + F.col("fn")), 4))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The best F1, the higher threshold of equal ones, and whether precision hardly depends on it."""
    best = sweep.agg(F.max(F.struct("f1", "threshold"))["threshold"].alias("threshold"), F.bround(F.max("precision") - F.min("precision"), 4).alias("precision_range"))
    return best.withColumn("needs_strong_key", F.col("precision_range") < 0.05)


def pair_metrics(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Precision, recall and F1 of pairs (a, b)."""
    t, f = truth.select("a", "b").distinct().withColumn("t", F.lit(1)), found.select("a", "b").distinct().withColumn("f", F.lit(1))
    m = t.join(f, ["a", "b"], "full_outer").agg(F.count_if(F.col("t").isNotNull() & F.col("f").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("f").isNull()).alias("fn"))
    tp = F.col("tp")
    return m.select("tp", "fp", "fn", F.bround(F.try_divide(tp, tp + F.col("fp")), 4).alias("precision"), F.bround(F.try_divide(tp, tp + F.col("fn")), 4).alias("recall"), F.bround(F.try_divide(tp * 2.0, tp * 2 + F.col("fp") + F.col("fn")), 4).alias("f1"))


def flatten_sources(products: DataFrame, uid: str, column: str, posted: str) -> DataFrame:
    """Maps source id -> struct as one row for each source; the text `posted` (YYYYMMDD) becomes the date `day`."""
    rows = products.select(uid, F.explode(column).alias("source_id", "v")).select(uid, "source_id", "v.*")
    return rows.withColumn("day", S.compact_date(posted)).drop(posted)


def current_run(rows: DataFrame, stamp: str, run: str, parents: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """The rows of this run only; with parents, only those whose key still has one."""
    out = rows.where(F.col(stamp) == run)
    return out if parents is None else out.join(parents.select(key).distinct(), key, "left_semi")


def pair_sets(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of either side once, as both, missed (true only) or wrong (found only)."""
    t, f = truth.select("a", "b").distinct().withColumn("t", F.lit(1)), found.select("a", "b").distinct().withColumn("f", F.lit(1))
    kind = F.when(F.col("f").isNull(), "missed").when(F.col("t").isNull(), "wrong").otherwise("both")
    return t.join(f, ["a", "b"], "full_outer").select("a", "b", kind.alias("kind"))


def usage_cost(usage: DataFrame, prices: DataFrame, key: str, units: str) -> DataFrame:
    """Units used times the price table's unit_price, per key; a key without a price costs null."""
    per = usage.groupBy(key).agg(F.sum(units).alias("u"), F.count("*").alias("n"))
    return per.join(prices, key, "left").select(key, (F.col("u") * F.col("unit_price")).alias("cost"), "n")


def size_range(df: DataFrame, group: str, size: str, sold_out: str, item: str) -> DataFrame:
    """Per group the first and last size, the number of sizes and of those with a sold-out item, and its smallest item."""
    return df.groupBy(group).agg(
        F.min(size).alias("first_size"), F.max(size).alias("last_size"), F.count_distinct(size).alias("n_sizes"), F.count_distinct(F.when(F.col(sold_out), F.col(size))).alias("sold_out"), F.min(item).alias("first_id"),
    )


def target_filter(df: DataFrame, text: str, required: tuple[str, ...], any_of: tuple[str, ...], sizes: list[str]) -> DataFrame:
    """Rows whose words hold all of the required ones, one of any_of, and one of the sizes exactly."""
    words = F.split(F.lower(text), r"\s+")
    has = lambda ws: F.array(*[F.lit(w) for w in ws])
    return df.where((F.size(F.array_except(has(required), words)) == 0) & F.arrays_overlap(words, has(any_of)) & F.arrays_overlap(words, has(sizes)))


def metrics_by_part(truth: DataFrame, found: DataFrame, part: DataFrame, id_col: str) -> DataFrame:
    """pair_metrics for each part of the ids: pairs with both ends in one part count there, others nowhere."""
    t, f = truth.select("a", "b").distinct().withColumn("t", F.lit(1)), found.select("a", "b").distinct().withColumn("f", F.lit(1))
    of = {x: part.select(F.col(id_col).alias(x), F.col("part").alias(f"part_{x}")) for x in "ab"}
    j = t.join(f, ["a", "b"], "full_outer").join(of["a"], "a").join(of["b"], "b").where("part_a = part_b")
    m = j.groupBy(F.col("part_a").alias("part")).agg(F.count_if(F.col("t").isNotNull() & F.col("f").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("f").isNull()).alias("fn"))
    tp = F.col("tp")
    return m.select("part", "tp", "fp", "fn", F.bround(F.try_divide(tp, tp + F.col("fp")), 4).alias("precision"), F.bround(F.try_divide(tp, tp + F.col("fn")), 4).alias("recall"), F.bround(F.try_divide(tp * 2.0, tp * 2 + F.col("fp") + F.col("fn")), 4).alias("f1"))


def _unit(v: Column) -> Column:
    d = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(d, lambda x: x / norm)


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, q, v) -> the k best of each query by cosine, then vec_id."""
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    best = pairs.withColumn("cosine", F.bround(dot, 6)).withColumn("place", F.row_number().over(w))
    return best.where(F.col("place") <= k).select("query_id", "vec_id", "cosine", "place")


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """The k most similar vectors of the same label for each query, by exact cosine.

    A label's vectors are dealt into blocks of about `block`; each query meets each block in a task of its own and
    brings its k best from there, so neither a hot label nor many queries need to fit in one place.
    """
    v = vectors.select("vec_id", "label", _unit(F.col("embedding")).alias("v"))
    blocks = v.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    v = v.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    q = queries.select(F.col("vec_id").alias("query_id"), "label", _unit(F.col("embedding")).alias("q")).join(blocks, "label")
    q = q.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return _nearest(q.join(v, ["label", "block"]).where("vec_id <> query_id"), k)


def approx_top_k(vectors: DataFrame, queries: DataFrame, k: int, tables: int = 10, bucket: int = 128) -> DataFrame:
    """cosine_top_k by random projections: candidates are what shares a bucket in one of the tables, ranked exactly.

    A bucket is named by the signs of a vector's products with vectors of +1 and -1; their number grows with a label's
    vectors so that a bucket has about `bucket` of them. A query also looks into the buckets one sign away. Tests and
    the query's own check against cosine_top_k measure the recall; true neighbours beyond those buckets are missed.
    """
    v = vectors.select("vec_id", "label", _unit(F.col("embedding")).alias("v"))
    bits = v.groupBy("label").agg(F.greatest(F.floor(F.log2(F.count("*") / bucket)), F.lit(0)).cast("int").alias("bits"))

    def coded(df: DataFrame, col: str) -> DataFrame:
        sign = lambda t, j, i: F.when(F.pmod(F.xxhash64(t, j, i), F.lit(2)) == 0, 1.0).otherwise(-1.0)
        dot = lambda j: F.aggregate(F.transform(col, lambda x, i: x * sign(F.col("t"), j, i)), F.lit(0.0), lambda s, x: s + x)
        named = F.transform(F.sequence(F.lit(0), F.col("bits") - 1), lambda j: F.when(dot(j) > 0, F.pow(F.lit(2.0), j)).otherwise(0.0))
        code = F.when(F.col("bits") == 0, F.lit(0)).otherwise(F.aggregate(named, F.lit(0.0), lambda s, x: s + x)).cast("bigint")
        return df.join(bits, "label").withColumn("t", F.explode(F.when(F.col("bits") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(tables - 1))))).withColumn("code", code)

    q = coded(queries.select(F.col("vec_id").alias("query_id"), "label", _unit(F.col("embedding")).alias("q")), "q")
    near = F.transform(F.sequence(F.lit(0), F.col("bits") - 1), lambda j: F.col("code").bitwiseXOR(F.pow(F.lit(2.0), j).cast("bigint")))
    q = q.withColumn("code", F.explode(F.when(F.col("bits") == 0, F.array("code")).otherwise(F.concat(F.array("code"), near)))).drop("bits")
    met = q.select("query_id", "label", "t", "code").join(coded(v, "v").select("vec_id", "label", "t", "code"), ["label", "t", "code"])
    met = met.where("vec_id <> query_id").select("query_id", "vec_id").distinct()
    asked = queries.select(F.col("vec_id").alias("query_id"), _unit(F.col("embedding")).alias("q"))
    return _nearest(met.join(asked, "query_id").join(v.select("vec_id", "v"), "vec_id"), k)
