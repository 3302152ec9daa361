"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.sources.shared import new_path, remove


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per Arrow batch: the same connectivity with at most one edge for each vertex."""
    for pdf in batches:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root.setdefault(up, up)
                x = root[x]
            return x

        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        rows = [(v, find(v)) for v in list(root)]
        yield pd.DataFrame([(v, r) for v, r in rows if v != r], columns=["a", "b"], dtype="int64")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(a, b) -> (id, component): component is the smallest id reachable. Vertices without an edge are not returned.

    Null ends and loops are dropped; repeated and reversed edges are harmless; an empty table gives an empty one. Each
    round is a table in the shared folder, which cuts the lineage and is deleted in the end; only whether a round
    changed anything reaches the driver.
    """
    spark, path = edges.sparkSession, new_path(edges.sparkSession, "components")

    def cut(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    e = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where("a <> b")
    e = cut(e.mapInPandas(_forest, "a bigint, b bigint").distinct(), "edges")
    for k in range(max_rounds):
        # Large star: every neighbour that is larger than the vertex goes to the vertex's smallest neighbour.
        both = e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours and the vertex itself go to the smallest neighbour.
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        new = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        e = cut(new.where("a <> b").distinct(), f"round{k}")
        tangled = e.join(e.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if tangled.isEmpty() and e.groupBy("a").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    out = e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
    out.write.parquet(last := new_path(spark, "components-found"))
    remove(spark, path)
    return spark.read.schema(out.schema).parquet(last)
