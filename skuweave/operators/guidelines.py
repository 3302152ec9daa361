"""Matching guidelines of categories: recommendations from labels, their upsert with a history of runs, the threshold map, the cockpit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from skuweave.sources.keyed import KeyedTable

#: Thresholds that are tried, the range of precision under which a threshold says nothing, and the matcher's threshold without a guideline.
SWEEP = (0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70)
FLAT, DEFAULT = 0.05, 0.4
_TYPES = {"n_labels": LongType(), "updated_at": TimestampType()} | dict.fromkeys(("recommended", "precision", "recall", "f1", "name_thresh"), DoubleType())
GUIDELINE = StructType([StructField(c, _TYPES.get(c, StringType())) for c in ("category", "status", "recommended", "precision", "recall", "f1", "n_labels", "name_thresh", "updated_by", "updated_at")])


def recommend(labels: DataFrame, thresholds: tuple[float, ...] = SWEEP, by: str = "category", label: str = "label", score: str = "score") -> DataFrame:
    """(category, n_labels, n_positive, status, recommended, best, sweep) of every category that has a label.

    best is the entry of the sweep (threshold, tp, fp, fn, precision, recall, f1; three decimals) of the largest F1, of equal ones the higher
    threshold. Where precision ranges over less than 0.05 the status is needs_strong_key and nothing is recommended, else effective.
    A share of nothing is 0. Rows without a label, a score or a category are left out; labels other than 1 are negative. Counts are
    made by interval of the score before the shuffle, so a hot category is a few rows for each task.
    """
    steps = sorted(set(thresholds))
    passed = sum(F.when(F.col(score) >= t, 1).otherwise(0) for t in steps)
    known = labels.where(F.col(by).isNotNull() & F.col(label).isNotNull() & F.col(score).isNotNull())
    cells = known.groupBy(F.col(by).alias("category"), passed.alias("k")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    at = lambda side, i: F.sum(F.when(F.col("k") > i, F.col(side)).otherwise(0))
    counts = [F.struct(F.lit(t).alias("threshold"), at("pos", i).alias("tp"), at("neg", i).alias("fp"), (F.sum("pos") - at("pos", i)).alias("fn")) for i, t in enumerate(steps)]
    out = cells.groupBy("category").agg(F.sum(F.col("pos") + F.col("neg")).alias("n_labels"), F.sum("pos").alias("n_positive"), F.array(*counts).alias("c"))

    share = lambda a, b: F.when(b > 0, a.cast("double") / b).otherwise(0.0)
    exact = F.transform("c", lambda x: F.struct(x.alias("x"), share(x["tp"], x["tp"] + x["fp"]).alias("p"), share(x["tp"], x["tp"] + x["fn"]).alias("r"), share(x["tp"] * 2, x["tp"] * 2 + x["fp"] + x["fn"]).alias("f")))
    out = out.withColumn("e", exact)
    entry = lambda e: F.struct(e["x"]["threshold"].alias("threshold"), e["x"]["tp"].alias("tp"), e["x"]["fp"].alias("fp"), e["x"]["fn"].alias("fn"), *[F.bround(e[c], 3).alias(n) for c, n in (("p", "precision"), ("r", "recall"), ("f", "f1"))])
    best = F.array_max(F.transform("e", lambda e: F.struct(e["f"].alias("f"), e["x"]["threshold"].alias("t"), entry(e).alias("v"))))["v"]
    precision = F.transform("e", lambda e: e["p"])
    flat = (F.array_max(precision) - F.array_min(precision)) < FLAT
    out = out.withColumn("best", best).withColumn("flat", flat).withColumn("sweep", F.transform("e", entry))
    return out.select("category", "n_labels", "n_positive", F.when(F.col("flat"), "needs_strong_key").otherwise("effective").alias("status"), F.when(~F.col("flat"), F.col("best.threshold")).alias("recommended"), "best", "sweep")


def guideline_table(spark, path: str, buckets: int = 8) -> KeyedTable:
    """The guidelines, one row for each category, of which an update rewrites only the key buckets that it touches."""
    return KeyedTable(spark, path, ["category"], GUIDELINE, buckets)


def apply_recommendations(recommended: DataFrame, guidelines: KeyedTable, history: str, run: int, at: Column, by: str, apply: bool = False) -> None:
    """Upserts the guidelines of the recommended categories, and adds a row for each to the history of runs.

    With apply the recommendation becomes the active threshold name_thresh (none where nothing is recommended); without it that of before
    stays. Runs are numbered upwards and a run's history is a folder of its own, so a run that is repeated after a failure
    changes nothing. Other guidelines are not read or written, but those in the same buckets.
    """
    active = guidelines.read().select("category", "name_thresh")
    new = recommended.join(active, "category", "left").select(
        "category", "status", "recommended", F.col("best.precision").alias("precision"), F.col("best.recall").alias("recall"), F.col("best.f1").alias("f1"), "n_labels",
        (F.col("recommended") if apply else F.col("name_thresh")).alias("name_thresh"), F.lit(by).alias("updated_by"), at.cast("timestamp").alias("updated_at"),
    )
    rows = recommended.select("category", at.cast("timestamp").alias("ts"), "n_labels", "recommended", F.col("status").alias("verdict"), F.lit(apply).alias("applied"), F.lit(by).alias("by"), "sweep")
    rows.write.mode("overwrite").parquet(f"{history}/run={run}")
    guidelines.replace(new, version=run)


def threshold_map(guidelines: DataFrame, default: float = DEFAULT) -> DataFrame:
    """(category, threshold) of the guidelines that have an active one, and 'default' if no guideline is called so."""
    own = guidelines.where("name_thresh is not null").select("category", F.col("name_thresh").alias("threshold"))
    fallback = own.agg(F.count_if(F.col("category") == "default").alias("n")).where("n = 0").select(F.lit("default").alias("category"), F.lit(default).alias("threshold"))
    return own.unionByName(fallback)


def export_thresholds(thresholds: DataFrame, path: str) -> None:
    """The map as JSON lines with a category and its threshold each, for the matcher."""
    thresholds.write.mode("overwrite").json(path)


def import_thresholds(thresholds: DataFrame, guidelines: KeyedTable, run: int, at: Column, by: str = "migrate") -> None:
    """Guidelines from a threshold map (category, threshold): those that exist keep all but status, threshold and stamp. Of repeated categories the highest threshold counts."""
    once = thresholds.where("category is not null").groupBy("category").agg(F.max("threshold").cast("double").alias("t"))
    new = once.join(guidelines.read().drop("status", "name_thresh", "updated_by", "updated_at"), "category", "left")
    guidelines.replace(new.withColumns({"status": F.lit("imported"), "name_thresh": F.col("t"), "updated_by": F.lit(by), "updated_at": at.cast("timestamp")}), version=run)


def cockpit_cards(guidelines: DataFrame) -> DataFrame:
    """One row: guidelines, those that a threshold can tune, those that need a strong key, labels."""
    return guidelines.agg(F.count("*").alias("n_categories"), F.count_if(F.col("status") == "effective").alias("n_effective"), F.count_if(F.col("status") == "needs_strong_key").alias("n_strong_key"), F.coalesce(F.sum("n_labels"), F.lit(0)).alias("n_labels"))


def cockpit_rows(guidelines: DataFrame, runs: DataFrame, latest: int = 10) -> DataFrame:
    """Each guideline with its `latest` runs, the newest first, as an array; empty where it has none. runs: the history, read whole."""
    w = Window.partitionBy("category").orderBy(F.desc("ts"), F.desc("run"))
    some = runs.withColumn("r", F.row_number().over(w)).where(F.col("r") <= latest)
    run = F.struct("r", F.struct("run", "ts", "n_labels", "recommended", "verdict", "applied", "by").alias("x"))
    listed = some.groupBy("category").agg(F.transform(F.sort_array(F.collect_list(run)), lambda x: x["x"]).alias("runs"))
    return guidelines.join(listed, "category", "left").withColumn("runs", F.coalesce("runs", F.filter(F.array(F.lit(None).cast(listed.schema["runs"].dataType.elementType)), lambda x: x.isNotNull())))
