"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import unit_hash

#: A mean above this is drawn as the sum of several Poisson variables, so that exp(-mean) stays a normal double.
MAX_MEAN = 256.0
BROADCAST_SOURCES = 20_000


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0, rows_out: int | None = None, source_col: str = "source") -> DataFrame:
    """One row per source: (source, n, mean), mean = expected copies of each of its documents.

    A source's share of the output is its weight over the sum of the weights of the sources present; rows_out
    (default: as many rows as there are) is the expected size of the output. A null source is a source of its own.
    """
    n = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    w = F.lit(float(default_weight))
    for name, x in (weights or {}).items():
        w = F.when(F.col("source") == name, F.lit(float(x))).otherwise(w)
    n = n.withColumn("weight", w)
    sums = n.agg(F.sum("weight").alias("w_all"), F.sum("n").alias("n_all"))
    out = F.lit(rows_out) if rows_out is not None else F.col("n_all")
    mean = F.when(F.col("w_all") > 0, F.col("weight") / F.col("w_all") * out / F.col("n")).otherwise(F.lit(0.0))
    return n.join(F.broadcast(sums)).select("source", "n", mean.alias("mean"))


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = "mix", default_weight: float = 1.0, rows_out: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of docs, repeated n_copies times (0 or more), in a globally shuffled order.

    n_copies inverts the Poisson distribution whose mean is the source's target repetition rate at a uniform number
    hashed from (seed, id, part); so it is the same on every run, on any partitioning. Adds copy (from 1), n_copies
    and shuffle_key; rows are dealt over the partitions by the key's hash and sorted by key inside each, so any
    prefix of the files is a random sample. No row is capped: a mean over MAX_MEAN is drawn in several parts.

    A null id is replaced by the text's md5; repeated ids get the same count; null sources form one source; an empty
    table gives an empty result. Columns of docs named copy, n_copies or shuffle_key are replaced.
    """
    rates = source_rates(docs, weights, default_weight, rows_out, source_col)
    parts = F.greatest(F.lit(1), F.ceil(F.col("mean") / MAX_MEAN)).cast("int")
    per = F.col("mean") / parts
    last = F.ceil(per + 14 * F.sqrt(per) + 30).cast("int")
    start = F.struct(F.exp(-per).alias("p"), F.exp(-per).alias("c"), F.array(F.exp(-per)).alias("all"))

    def step(s, k):
        p = s["p"] * per / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    cdf = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["all"])
    docs = docs.drop("copy", "n_copies", "shuffle_key")
    own = {x: free_name(docs, x) for x in ("_key", "_source", "_parts", "_cdf")}
    rates = rates.select(F.col("source").alias(own["_source"]), parts.alias(own["_parts"]), cdf.alias(own["_cdf"]))
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col(own["_parts"])), F.lit(0), lambda a, i: a + F.size(F.filter(own["_cdf"], lambda c: c <= unit_hash(F.lit(seed), F.col(own["_key"]), i.cast("string"))))
    )
    out = docs.withColumn(own["_key"], key).join(rates, F.col(source_col).eqNullSafe(F.col(own["_source"])))
    out = out.withColumn("n_copies", count).where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    out = out.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed} order"), own["_key"], F.col("copy").cast("string"))))
    return out.drop(*own.values()).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


#: The registered query's weights; a source that is not named has weight 1.
QUERY_WEIGHTS = {"src0": 2.0, "src1": 0.5, "src2": 3.0}

ORACLE_SQL = """
WITH RECURSIVE n AS (
  SELECT source, count(*) AS n, CASE source WHEN 'src0' THEN 2.0 WHEN 'src1' THEN 0.5 WHEN 'src2' THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM documents GROUP BY source),
m AS (SELECT source, weight / (SELECT sum(weight) FROM n) * (SELECT sum(n) FROM n) / n AS mean FROM n),
s AS (SELECT source, mean, greatest(1, ceil(mean / 256.0))::INT AS parts, mean / greatest(1, ceil(mean / 256.0)) AS per FROM m),
c(source, per, k, p, c) AS (
  SELECT source, per, 0, exp(-per), exp(-per) FROM s
  UNION ALL SELECT source, per, k + 1, p * per / (k + 1), c + p * per / (k + 1) FROM c WHERE k < ceil(per + 14 * sqrt(per) + 30)),
d AS (SELECT d.*, s.parts, coalesce(d.doc_id::VARCHAR, 'text' || md5(coalesce(d.text, ''))) AS key FROM documents d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
u AS (SELECT d.*, ('0x' || substr(md5('mix:' || key || ':' || i::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM d, LATERAL (SELECT unnest(range(1, parts + 1)) AS i)),
k AS (SELECT doc_id, text, lang, source, n_chars, key, sum((SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.c <= u.u))::INT AS n_copies FROM u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy::INT AS copy, md5('mix order:' || key || ':' || copy::VARCHAR) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM k WHERE n_copies > 0)
"""
