"""Queries over guidelines: a category is a source of documents, and each language is one calibration run, in order of its name."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.operators import guidelines as G
from skuweave.plans.registry import query
from skuweave.plans.views import table
from skuweave.sources.shared import new_path

#: The sweep of each category and run; all runs but the last are applied.
_SWEEP = """s AS (SELECT source AS category, lang, quality, len(list_distinct(string_split(text, ' ')))::DOUBLE / len(string_split(text, ' ')) AS score FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL{0}),
 c AS (SELECT {1}, threshold, count(*) FILTER (score >= threshold AND quality = 1) AS tp, count(*) FILTER (score >= threshold AND quality <> 1) AS fp, count(*) FILTER (score < threshold AND quality = 1) AS fn, count(*) AS n FROM s CROSS JOIN (SELECT unnest([0.30,0.35,0.40,0.45,0.50,0.55,0.60,0.65,0.70])::DOUBLE AS threshold) GROUP BY ALL),
 m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS r, CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END AS f FROM c),
 rec AS (SELECT {1}, n AS n_labels, tp + fn AS n_positive, flat, threshold AS best, round_even(p, 3) AS precision, round_even(r, 3) AS recall, round_even(f, 3) AS f1, CASE WHEN NOT flat THEN threshold END AS recommended, CASE WHEN flat THEN 'needs_strong_key' ELSE 'effective' END AS status
  FROM (SELECT *, max(p) OVER (PARTITION BY {1}) - min(p) OVER (PARTITION BY {1}) < 0.05::DOUBLE AS flat FROM m) QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY f DESC, threshold DESC) = 1)"""
ALL = _SWEEP.format("", "category")
RUNS = _SWEEP.format(" AND lang IS NOT NULL", "category, lang") + """,
 k AS (SELECT lang, row_number() OVER (ORDER BY lang) AS run, count(*) OVER () AS n_runs FROM (SELECT DISTINCT lang FROM s)),
 h AS (SELECT rec.*, run, run < n_runs AS applied FROM rec JOIN k USING (lang)),
 a AS (SELECT category, recommended AS name_thresh FROM h WHERE applied QUALIFY row_number() OVER (PARTITION BY category ORDER BY run DESC) = 1),
 g AS (SELECT h.*, name_thresh FROM h LEFT JOIN a USING (category) QUALIFY row_number() OVER (PARTITION BY category ORDER BY run DESC) = 1)"""


def _labels(spark, sf):
    w = F.split("text", " ")
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select(F.col("source").alias("category"), "lang", F.col("quality").alias("label"), (F.size(F.array_distinct(w)) / F.size(w)).alias("score"))


@query("qv6_recommendations", f"WITH {ALL} SELECT category, n_labels, n_positive, status, recommended, best, precision, recall, f1 FROM rec")
def qv6_recommendations(spark, sf):
    r = G.recommend(_labels(spark, sf))
    return r.select("category", "n_labels", "n_positive", "status", "recommended", F.col("best.threshold").alias("best"), "best.precision", "best.recall", "best.f1")


def _calibrated(spark, sf):
    """The guidelines after a run for each language, and the history of the runs."""
    path = new_path(spark, "guidelines")
    labels, table_ = _labels(spark, sf), G.guideline_table(spark, f"{path}/table")
    langs = sorted(r[0] for r in labels.where("lang is not null").select("lang").distinct().collect())  # as many as there are runs
    for run, lang in enumerate(langs, 1):
        at = F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.lit(run))
        G.apply_recommendations(G.recommend(labels.where(F.col("lang") == lang)), table_, f"{path}/history", run, at, f"run {lang}", apply=run < len(langs))
    return table_.read(), spark.read.parquet(f"{path}/history"), path


@query("qv6_applied_guidelines", f"WITH {RUNS} SELECT category, status, recommended, precision, recall, f1, n_labels, name_thresh, concat('run ', lang) AS updated_by FROM g")
def qv6_guidelines(spark, sf):
    return _calibrated(spark, sf)[0].drop("updated_at")


@query("qv6_threshold_map", f"WITH {RUNS} SELECT category, name_thresh AS threshold FROM g WHERE name_thresh IS NOT NULL UNION ALL SELECT 'default', 0.4::DOUBLE")
def qv6_map(spark, sf):
    """The exported map, read back."""
    guidelines, _, path = _calibrated(spark, sf)
    G.export_thresholds(G.threshold_map(guidelines), f"{path}/thresholds")
    return spark.read.schema("category string, threshold double").json(f"{path}/thresholds")


@query("qv12_cockpit_rows", f"WITH {RUNS} SELECT g.category, g.status, string_agg(concat(h.run, ':', h.n_labels, ':', h.status, ':', coalesce(CAST(h.recommended AS VARCHAR), '-'), ':', CASE WHEN h.applied THEN 'true' ELSE 'false' END), '|' ORDER BY h.run DESC) AS runs FROM g JOIN h USING (category) GROUP BY ALL")
def qv12_rows(spark, sf):
    guidelines, runs, _ = _calibrated(spark, sf)
    text = lambda r: F.concat_ws(":", r["run"].cast("string"), r["n_labels"].cast("string"), r["verdict"], F.coalesce(r["recommended"].cast("string"), F.lit("-")), r["applied"].cast("string"))
    return G.cockpit_rows(guidelines, runs).select("category", "status", F.array_join(F.transform("runs", text), "|").alias("runs"))


@query("qv12_cockpit_cards", f"WITH {RUNS} SELECT count(*) AS n_categories, count(*) FILTER (status = 'effective') AS n_effective, count(*) FILTER (status = 'needs_strong_key') AS n_strong_key, CAST(coalesce(sum(n_labels), 0) AS BIGINT) AS n_labels FROM g")
def qv12_cards(spark, sf):
    return G.cockpit_cards(_calibrated(spark, sf)[0])
