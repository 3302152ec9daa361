"""Guidelines against plain loops: recommendations, upsert and history, repeated runs, the threshold map, the cockpit."""

import random

from pyspark.sql import functions as F

from skuweave.operators import guidelines as G

LABELS = "category string, label int, score double, best int"


def _plain(labels):
    rows = []
    for t in G.SWEEP:
        tp, fp, fn = (sum(1 for y, s in labels if (y == 1) == pos and (s >= t) == hit) for pos, hit in ((True, True), (False, True), (True, False)))
        p, r = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        rows.append((2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0, t, p, r, tp, fp, fn))
    best, flat = max(rows), max(r[2] for r in rows) - min(r[2] for r in rows) < G.FLAT
    return len(labels), sum(y == 1 for y, _ in labels), "needs_strong_key" if flat else "effective", None if flat else best[1], best[1], round(best[2], 3), round(best[3], 3), [r[4:] for r in rows]


def test_recommend(spark):
    rng = random.Random(3)
    rows = [(c, int(rng.random() < 0.2 + 0.6 * s), s, 0) for c in "abcd" for s in [rng.choice([0.3, 0.45, 0.7, round(rng.random(), 2)]) for _ in range(60)]]
    rows += [("flat", 1, 0.9, 0), ("flat", 1, 0.1, 0), ("low", 0, 0.1, 0), ("two", 2, 0.9, 0), ("two", 1, 0.35, 0)]
    odd = [(None, 1, 0.5, 0), ("x", None, 0.5, 0), ("x", 1, None, 0)]
    out = G.recommend(spark.createDataFrame(rows + odd, LABELS)).collect()
    got = {r["category"]: (r["n_labels"], r["n_positive"], r["status"], r["recommended"], r["best"]["threshold"], r["best"]["precision"], r["best"]["recall"], [(e["tp"], e["fp"], e["fn"]) for e in r["sweep"]]) for r in out}
    assert got == {c: _plain([(y, s) for k, y, s, _ in rows if k == c]) for c in {r[0] for r in rows}}
    assert len({r[2] for r in got.values()}) == 2 and [e["threshold"] for e in out[0]["sweep"]] == list(G.SWEEP)
    assert G.recommend(spark.createDataFrame([], LABELS)).count() == 0


def test_runs_history_and_map(spark, tmp_path):
    table, history = G.guideline_table(spark, f"file://{tmp_path}/table"), f"file://{tmp_path}/history"
    df = lambda rows: G.recommend(spark.createDataFrame([(*r, 0) for r in rows], LABELS))
    at = lambda day: F.lit(f"2024-01-0{day}")
    a = [("a", 1, 0.62), ("a", 0, 0.41), ("b", 1, 0.52), ("b", 0, 0.33)]
    G.apply_recommendations(df(a), table, history, 1, at(1), "one", apply=True)
    for _ in range(2):  # a repeated run changes nothing
        G.apply_recommendations(df([("a", 1, 0.5), ("a", 0, 0.2), ("c", 1, 0.9)]), table, history, 2, at(2), "two")
    rows = {r["category"]: (r["status"], r["recommended"], r["name_thresh"], r["n_labels"], r["updated_by"]) for r in table.read().collect()}
    assert rows == {"a": ("effective", 0.50, 0.60, 2, "two"), "b": ("effective", 0.50, 0.50, 2, "one"), "c": ("needs_strong_key", None, None, 1, "two")}
    runs = spark.read.parquet(history)
    assert sorted((r["run"], r["category"], r["verdict"], r["applied"]) for r in runs.collect()) == [(1, "a", "effective", True), (1, "b", "effective", True), (2, "a", "effective", False), (2, "c", "needs_strong_key", False)]
    assert {tuple(r) for r in G.threshold_map(table.read()).collect()} == {("a", 0.60), ("b", 0.50), ("default", 0.4)}
    G.export_thresholds(G.threshold_map(table.read()), f"file://{tmp_path}/map")
    back = spark.read.schema("category string, threshold double").json(f"file://{tmp_path}/map")
    other = back.where("category <> 'b'").withColumn("threshold", F.col("threshold") + 1).unionByName(spark.createDataFrame([("d", 0.1), ("d", 0.2), (None, 1.0)], "category string, threshold double"))
    G.import_thresholds(other, table, 3, at(3))
    rows = {r["category"]: (r["status"], r["recommended"], r["name_thresh"], r["n_labels"]) for r in table.read().collect()}
    assert rows == {"a": ("imported", 0.50, 1.60, 2), "b": ("effective", 0.50, 0.50, 2), "c": ("needs_strong_key", None, None, 1), "d": ("imported", None, 0.2, None), "default": ("imported", None, 1.4, None)}
    assert {tuple(r) for r in G.threshold_map(table.read()).collect()} == {("a", 1.60), ("b", 0.50), ("d", 0.2), ("default", 1.4)}
    assert [tuple(r) for r in G.cockpit_cards(table.read()).collect()] == [(5, 1, 1, 5)] and [tuple(r) for r in G.cockpit_cards(table.read().limit(0)).collect()] == [(0, 0, 0, 0)]
    listed = {r["category"]: [x["run"] for x in r["runs"]] for r in G.cockpit_rows(table.read(), runs).collect()}
    assert listed == {"a": [2, 1], "b": [1], "c": [2], "d": [], "default": []}
    assert {r["category"]: [x["run"] for x in r["runs"]] for r in G.cockpit_rows(table.read(), runs, latest=1).collect()}["a"] == [2]
