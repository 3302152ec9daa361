"""Writers: seed CSV, append-only results, report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the seed file that the matcher reads, in order.
SEED_COLUMNS = ("insight_uid", "ctlg_no", "parent_uid", "keyword", "size", "color", "category_l1")


def write_seed(df: DataFrame, path: str, columns: tuple[str, ...] = SEED_COLUMNS) -> None:
    """CSV with a header and exactly these columns; one that df lacks is empty, and null is empty."""
    df.select(*[F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.option("header", True).option("emptyValue", "").csv(path)


def append_results(results: DataFrame, path: str, status: str, key: str = "uid") -> None:
    """Adds JSON lines with a status to the results at path; rows that are there stay."""
    results.select(F.col(key), F.lit(status).alias("status"), F.struct(*[c for c in results.columns if c != key]).alias("result")).write.mode("append").json(path)


def finished(results: DataFrame, key: str = "uid", order: tuple[str, ...] = ("error", "empty", "done")) -> DataFrame:
    """One row per key of an append-only table: the best of its statuses in the given order."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("status"))
    return results.groupBy(key).agg(F.max_by("status", rank).alias("status"), F.count("*").alias("tries"))


def write_report(df: DataFrame, path: str, by: str | None = None) -> None:
    """A report's data part: Parquet, beside it the same rows as JSON lines with one object each."""
    out = df.write.partitionBy(by) if by else df.write
    out.parquet(f"{path}/parquet")
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{path}/json")
