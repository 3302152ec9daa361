"""Queries of seed matching and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.operators import match as M
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_extracted, v_seed

THRESHOLDS = {"ECONOMY": 0.5, "PROMO": 0.3}
_CONTENT = "array_to_string(list_filter(string_split(lower(regexp_replace({0}, ' 500g$', '')), ' '), lambda w: w NOT IN ('red', 'blue') AND w <> ''), '')"
_GRAMS = "CASE WHEN {0} = '' THEN [] WHEN length({0}) < 2 THEN [{0}] ELSE list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) END"
_THR = "CASE category WHEN 'ECONOMY' THEN 0.5::DOUBLE WHEN 'PROMO' THEN 0.3::DOUBLE ELSE 0.4::DOUBLE END"
#: Recalls of all pairs of distinct contents.
RECALLS = f"""sx AS (SELECT *, {_CONTENT.format('name')} AS content, {_THR} AS threshold FROM v_seed), rx AS (SELECT *, {_CONTENT.format('name')} AS content FROM v_extracted),
  sc AS (SELECT content, {_GRAMS.format('content')} AS g FROM (SELECT DISTINCT content FROM sx WHERE content <> '')), rc AS (SELECT content, {_GRAMS.format('content')} AS g FROM (SELECT DISTINCT content FROM rx)),
  m AS (SELECT sc.content, rc.content AS r_content, len(list_intersect(sc.g, rc.g))::DOUBLE / len(sc.g) AS recall FROM sc JOIN rc ON list_has_any(sc.g, rc.g))"""
_GATE = "(s.domain IS NULL OR r.domain IS NULL OR s.domain = r.domain)"


def best_sql(gate: str = _GATE, least: str = "s.threshold", ties: bool = True) -> str:
    c, z = ("contains(lower(r.color), s.color)", "contains(r.sizes, s.size)") if ties else ("false", "false")
    return f"""best AS (SELECT seed_id, row_id, recall, threshold, concat('name', CASE WHEN c THEN '+color' ELSE '' END, CASE WHEN z THEN '+size' ELSE '' END) AS tag FROM (
  SELECT s.seed_id, r.row_id, m.recall, s.threshold, {c} AS c, {z} AS z, row_number() OVER (PARTITION BY s.seed_id ORDER BY m.recall DESC, ({c})::INT DESC, ({z})::INT DESC, r.row_id) AS k
  FROM sx s JOIN m ON m.content = s.content JOIN rx r ON r.content = m.r_content WHERE {gate} AND m.recall >= {least}) WHERE k = 1)"""


@query("jn6_name_match", f"WITH {RECALLS}, {best_sql()} SELECT seed_id, row_id, round_even(recall, 6) AS recall, threshold, tag FROM best")
def jn6(spark, sf):
    return M.match_by_name(v_seed(spark, sf), v_extracted(spark, sf), thresholds=THRESHOLDS).withColumn("recall", F.bround("recall", 6))


STRONG = "strong AS (SELECT s.seed_id, min(r.row_id) AS row_id FROM v_seed s JOIN v_extracted r ON r.style_code = s.style_code GROUP BY s.seed_id)"
MATCHED = f"{RECALLS}, {best_sql()}, {STRONG}, matched AS (SELECT seed_id, row_id, 'key:style_code' AS method FROM strong UNION ALL SELECT seed_id, row_id, concat(tag, ':', printf('%.2f', round_even(recall, 2)), '@', CAST(threshold AS VARCHAR)) FROM best WHERE seed_id NOT IN (SELECT seed_id FROM strong))"


@query("jn7_stamp", f"WITH {MATCHED} SELECT row_id, r.name, seed_id, method FROM matched JOIN v_extracted r USING (row_id)")
def jn7(spark, sf):
    rows = v_extracted(spark, sf)
    return M.stamped(rows.select("row_id", "name"), M.match_seeds(v_seed(spark, sf), rows, thresholds=THRESHOLDS))


@query(
    "jn11_best_external",
    """WITH p AS (SELECT p_partkey AS uid, list_distinct(string_split(concat(p_name, ' ', lower(p_type)), ' ')) AS words, concat(p_size, 'g') AS size FROM part), c AS (SELECT p_partkey AS cand_id, concat(lower(p_type), ' ', p_name, ' ', p_size, ' g') AS name, p_partkey % 97 AS reviews FROM part WHERE p_size % 2 = 0)
  SELECT uid, cand_id, overlap, reviews FROM (SELECT uid, cand_id, reviews, len(list_intersect(words, list_distinct(string_split(name, ' ')))) AS overlap, row_number() OVER (PARTITION BY uid ORDER BY len(list_intersect(words, list_distinct(string_split(name, ' ')))) DESC, reviews DESC, cand_id) AS k
  FROM p JOIN c ON contains(replace(name, ' ', ''), size) AND len(list_intersect(words, list_distinct(string_split(name, ' ')))) >= 2) WHERE k = 1""",
)
def jn11(spark, sf):
    p = table(spark, sf, "part")
    products = p.select(F.col("p_partkey").alias("uid"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name"), F.concat(F.col("p_size").cast("string"), F.lit("g")).alias("size"))
    others = p.where("p_size % 2 = 0").select(F.col("p_partkey").alias("cand_id"), F.concat_ws(" ", F.lower("p_type"), "p_name", F.col("p_size").cast("string"), F.lit("g")).alias("name"), (F.col("p_partkey") % 97).alias("reviews"))
    return M.best_external(products, others)


@query("ev17_label_queue", f"WITH {RECALLS}, {best_sql(least='0.0')} SELECT seed_id, row_id, round_even(recall, 4) AS recall FROM best WHERE (seed_id + row_id) % 4 <> 0 ORDER BY recall DESC, seed_id LIMIT 200")
def ev17(spark, sf):
    seeds, rows = v_seed(spark, sf), v_extracted(spark, sf)
    known = M.match_by_name(seeds, rows, any_score=True).where("(seed_id + row_id) % 4 = 0")  # labelled before
    return M.candidate_queue(seeds, rows, known)


_HASH = "CAST(concat('0x', left(md5(concat(CAST(p_partkey AS VARCHAR), ':', CAST({0} AS VARCHAR))), 4)) AS INT) % 3 <> 0"
PERTURBED = f"SELECT p_partkey, coalesce(nullif(array_to_string(list_filter(w, lambda x, i: {_HASH.format('i - 1')}), ' '), ''), w[1]) AS perturbed FROM (SELECT p_partkey, string_split(concat(p_name, ' ', lower(p_type)), ' ') AS w FROM part)"


@query("ev18_perturbed_names", PERTURBED)
def ev18(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name"))
    return M.perturbed(p, "p_partkey", "name").select("p_partkey", "perturbed")


@query("qv7_cross_domain", f"WITH {RECALLS}, {best_sql(gate='s.domain <> r.domain')}, gated AS (SELECT count(*) AS n FROM sx s WHERE EXISTS (SELECT 1 FROM m JOIN rx r ON r.content = m.r_content WHERE m.content = s.content AND s.domain <> r.domain AND {_GATE} AND m.recall >= s.threshold)) SELECT count(*) AS seeds, (SELECT count(*) FROM best) AS without_gate, (SELECT n FROM gated) AS with_gate, round_even((SELECT count(*) FROM best)::DOUBLE / count(*), 4) AS rate FROM v_seed WHERE domain IS NOT NULL")
def qv7(spark, sf):
    """Seeds that would match a row of another domain: with the gate none, without it the rate of false matches."""
    seeds, rows = v_seed(spark, sf).where("domain is not null"), v_extracted(spark, sf).where("domain is not null")
    wrong = {d: (seeds.where(F.col("domain") == d), rows.where(F.col("domain") != d)) for d in ("A", "B")}
    open_, shut = [], []
    for s, r in wrong.values():
        open_.append(M.match_by_name(s.withColumn("domain", F.lit(None).cast("string")), r, thresholds=THRESHOLDS))
        shut.append(M.match_by_name(s, r, thresholds=THRESHOLDS))
    n, a, b = seeds.agg(F.count("*").alias("seeds")), open_[0].union(open_[1]).agg(F.count("*").alias("without_gate")), shut[0].union(shut[1]).agg(F.count("*").alias("with_gate"))
    return n.join(a, how="inner", on=F.lit(True)).join(b, how="inner", on=F.lit(True)).withColumn("rate", F.bround(F.col("without_gate") / F.col("seeds"), 4))


SWEEP = [0.3, 0.5, 0.7, 0.9]


def _report(spark, sf, ties):
    seeds, rows = v_seed(spark, sf), v_extracted(spark, sf)
    found = M.match_by_name(seeds, rows.withColumn("domain", F.lit(None).cast("string")), least=0.0, ties=ties, any_score=True)
    truth = rows.select(F.col("row_id").alias("seed_id"), "row_id", M.content_of("name").alias("content"))
    return M.match_report(found, truth, SWEEP)


def report_sql(ties: bool) -> str:
    return f"""{best_sql(gate='true', least='0.0', ties=ties)}, j AS (SELECT b.recall, b.row_id = b.seed_id AS hit, x.content = y.content AS like_it FROM best b JOIN rx x ON x.row_id = b.seed_id JOIN rx y ON y.row_id = b.row_id),
  rep AS (SELECT t.threshold, count(*) AS matched, count(*) FILTER (hit) AS "right", count(*) FILTER (NOT hit AND like_it) AS variants FROM j JOIN (SELECT unnest([0.3, 0.5, 0.7, 0.9])::DOUBLE AS threshold) t ON j.recall >= t.threshold GROUP BY t.threshold),
  fin AS (SELECT threshold, matched, "right", variants, round_even("right"::DOUBLE / matched, 4) AS precision, round_even("right"::DOUBLE / (SELECT count(*) FROM v_extracted), 4) AS recall, round_even(variants::DOUBLE / nullif(matched - "right", 0), 4) AS variant_share FROM rep)"""


@query("qv8_in_domain", f"WITH {RECALLS}, {report_sql(True)} SELECT * FROM fin")
def qv8(spark, sf):
    return _report(spark, sf, True)


@query("qv9_tie_breaks", f"WITH {RECALLS}, a AS (WITH {report_sql(True)} SELECT * FROM fin), b AS (WITH {report_sql(False)} SELECT * FROM fin) SELECT a.threshold, a.\"right\" AS right_with, b.\"right\" AS right_without, a.\"right\" - b.\"right\" AS gain FROM a JOIN b ON a.threshold = b.threshold")
def qv9(spark, sf):
    on, off = _report(spark, sf, True).select("threshold", F.col("right").alias("right_with")), _report(spark, sf, False).select("threshold", F.col("right").alias("right_without"))
    return on.join(off, "threshold").withColumn("gain", F.col("right_with") - F.col("right_without"))
