"""Rules over insight states: detection, repair, and the quantity check against the catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.functions import text as A


@dataclass(frozen=True)
class Rule:
    """A rule's name and severity, when a row breaks it, and the columns that repair it (none: report only)."""

    name: str
    severity: str
    broken: Column
    fix: dict[str, Column] | None = None


def run_rules(states: DataFrame, rules: list[Rule], key: str, fix: bool = False) -> tuple[DataFrame, DataFrame]:
    """(violations, states): key, rule, severity and whether it was fixed; with fix the states after repair.

    Every rule looks at the row as it came; of two rules that set one column the first in order wins. A second run over
    repaired states finds what can be repaired no more.
    """
    hit = [(r, F.coalesce(r.broken, F.lit(False))) for r in rules]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.lit(fix and r.fix is not None).alias("fixed"))) for r, c in hit]))
    violations = states.select(key, F.explode(found).alias("v")).select(key, "v.*")
    if not fix:
        return violations, states
    new = {}
    for r, c in reversed(hit):
        for name, value in (r.fix or {}).items():
            new[name] = F.when(c, value).otherwise(new.get(name, F.col(name)))
    return violations, states.withColumns(new)


def rule_summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule", "severity").agg(F.count("*").alias("n"), F.count_if("fixed").alias("fixed"))


def evidence_quantity(evidence: DataFrame, key: str, text: str, order: list[str]) -> DataFrame:
    """(key, dim, value, share): the commonest mass and volume of a key's texts, among those that name one.

    Of values equally often the one named first counts. Counts are no quantity here: review texts are full of them.
    """
    long = evidence.select(key, F.struct(*order).alias("at"), F.explode(F.create_map(F.lit("mass"), A.measure(text, A.WEIGHT), F.lit("vol"), A.measure(text, A.VOLUME))).alias("dim", "value")).where("value is not null")
    counts = long.groupBy(key, "dim", "value").agg(F.count("*").alias("c"), F.min("at").alias("at"))
    most = counts.groupBy(key, "dim").agg(F.max("c").alias("most"), F.sum("c").alias("n"))
    top = counts.join(most, [key, "dim"]).where("c = most").groupBy(key, "dim").agg(F.min_by("value", "at").alias("value"), F.first("most").alias("most"), F.first("n").alias("n"))
    return top.select(key, "dim", "value", (F.col("most") / F.col("n")).alias("share"))


def quantity_mismatch(catalog: DataFrame, evidence: DataFrame, key: str, text: str, order: list[str], least: float = 0.5) -> DataFrame:
    """Keys whose evidence mostly names another mass or volume than the catalogue: key, dim, catalog, evidence, share.

    catalog: key, mass, vol (null: not stated, then nothing is checked). Mass goes before volume; one row for each key.
    """
    q = evidence_quantity(evidence, key, text, order).where(F.col("share") >= least)
    stated = catalog.select(key, F.explode(F.create_map(F.lit("mass"), F.col("mass").cast("double"), F.lit("vol"), F.col("vol").cast("double"))).alias("dim", "catalog")).where("catalog is not null")
    bad = stated.join(q, [key, "dim"]).where(F.abs(F.col("catalog") - F.col("value")) > 1e-9)
    return bad.groupBy(key).agg(F.min(F.struct("dim", "catalog", F.col("value").alias("evidence"), F.bround("share", 4).alias("share"))).alias("m")).select(key, "m.*")


def emptied(states: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """States in which a key with a mismatch has lost its insight: no dimensions, one attempt more, the reason noted."""
    hit = F.col("_hit").isNotNull()
    j = states.join(bad.select(key, F.lit(1).alias("_hit")).distinct(), key, "left")
    return j.withColumns({
        "n_dims": F.when(hit, 0).otherwise(F.col("n_dims")), "has_insight": F.when(hit, False).otherwise(F.col("has_insight")), "attempts": F.when(hit, F.coalesce("attempts", F.lit(0)) + 1).otherwise(F.col("attempts")),
        "invalidated": F.when(hit, "source_mismatch"),
    }).drop("_hit")
