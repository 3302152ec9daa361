"""Hard negatives by coordinate pruning: length buckets with sorted coordinate lists, feasible ranges, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuweave.llm.common import Scratch

#: Lengths in one bucket differ by this factor at most.
BAND = 1.1
#: Vectors of a block (a part of a bucket) and queries that one task compares with it, about.
BLOCK, QUERY_BLOCK = 8192, 2048
#: Focus coordinates of a query: those in which it is largest.
FOCUS = 5
#: Expected rows of the samples that give the searches their first bars: of a label, and of all rows. They decide no result.
LABEL_SAMPLE, SAMPLE = 1024, 4096
#: Statistics of buckets are broadcast up to so many rows (of at most 16 kB, most of them far less).
BROADCAST_ROWS = 2_000
LEAST = -(1 << 62)


def band(length: Column) -> Column:
    """Bucket of a length; it never falls as the length grows. Lengths under 1 share the lowest."""
    return F.floor(F.log(F.greatest(length, F.lit(1.0))) / float(np.log(BAND))).cast("int")


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """(rid, vec_id, label, v, length, dims) of the rows that take part; v has the components floor(scale * x)."""
    whole = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("v", F.transform("x", lambda x: F.floor(x * scale).cast("long"))).drop("x")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "v", length.alias("length"), F.size("v").alias("dims"))


class Block:
    """Vectors of a length bucket, their unit vectors' coordinates as sorted lists (made when a query asks for them)."""

    def __init__(self, rid, vec_id, label, v: np.ndarray):
        self.rid, self.vec_id, self.label, self.v = rid, vec_id, label, v
        self.length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        self.longest = float(self.length.max(initial=0.0))
        self.most = int(np.abs(v).max(initial=0))
        self.real = v.astype(np.float64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            unit = self.real[:, f] / np.maximum(self.length, 1e-300)
            order = np.argsort(unit, kind="stable")
            self.lists[f] = unit[order], order
        return self.lists[f]

    def candidates(self, q: np.ndarray, length: float, least: int) -> np.ndarray | None:
        """Numbers of the vectors that may have an inner product of `least` with q; None: all may.

        If the cosine must be at least t, the angles of q and of v to an axis differ by at most arccos t: that is the
        feasible range of each focus coordinate, and v must lie in all of them.
        """
        if least <= 0 or not length:
            return None
        need = least / (length * self.longest) if self.longest else np.inf
        if need > 1 + 1e-9:
            return np.zeros(0, np.int64)
        wide = np.arccos(min(1.0, need)) + 1e-6
        unit = q / length
        focus = np.argpartition(-np.abs(unit), min(FOCUS, len(q)) - 1)[:FOCUS]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, angle + wide)) - 1e-9, np.cos(np.maximum(0.0, angle - wide)) + 1e-9
        spans = []
        for f, lo, hi in zip(focus.tolist(), low, high, strict=True):
            values, order = self.sorted_list(f)
            a, b = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
            if b - a < len(values):
                spans.append(order[a:b])
        if not spans:
            return None
        hits = np.zeros(len(self.rid), np.int8)
        for s in spans:
            hits[s] += 1
        return np.flatnonzero(hits == len(spans))

    def scores(self, q: np.ndarray, some: np.ndarray | None) -> np.ndarray:
        """Exact inner products; in doubles where they are exact."""
        if self.most * int(np.abs(q).max(initial=0)) * max(1, len(q)) < 1 << 53:
            return ((self.real if some is None else self.real[some]) @ q.astype(np.float64)).astype(np.int64)
        return (self.v if some is None else self.v[some]) @ q


def _search(same: bool, k: int):
    """Rows sorted by cell and role, vectors (0) before queries (1) -> for each query and range the k best hits in the cell."""

    def best(block: Block, rid: int, label: int, q: np.ndarray, length: float, floors: list[int], caps: list[int]) -> Iterator[tuple]:
        least = min(floors)
        some = block.candidates(q, length, least)
        s = block.scores(q, some)
        own = block.label if some is None else block.label[some]
        ids = np.arange(len(block.rid)) if some is None else some
        keep = (s >= least) & ((own == label) if same else (own != label))
        if same:
            keep &= block.rid[ids] != rid
        s, ids = s[keep], ids[keep]
        for part, (lo, hi) in enumerate(zip(floors, caps, strict=True)):
            at = np.flatnonzero((s >= lo) & (s <= hi))
            if len(at) > k:
                at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
            at = at[np.lexsort((block.rid[ids[at]], block.vec_id[ids[at]], -s[at]))[:k]]
            for j in at.tolist():
                yield rid, part, int(block.rid[ids[j]]), int(block.vec_id[ids[j]]), int(s[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(i).to_pylist() for i in range(4)]
            keys = list(zip(*names, strict=True))
            role, rid, vec_id, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4, 8))
            vectors, length, floors, caps = (batch.column(i) for i in range(8, 12))
            change = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            out = []
            for lo, hi in zip(change, change[1:], strict=False):
                if keys[lo] != cell:
                    cell, held, block = keys[lo], [], None
                mid = lo + int(np.searchsorted(role[lo:hi], 1, "left"))
                wide = len(vectors[lo].as_py())
                v = vectors.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, wide)
                if mid > lo:
                    held.append((rid[lo:mid], vec_id[lo:mid], label[lo:mid], v[: mid - lo]))
                if mid == hi or not held:
                    continue
                block = block or Block(*(np.concatenate(c) for c in zip(*held, strict=True)))
                for i in range(mid, hi):
                    out += best(block, int(rid[i]), int(label[i]), v[i - lo], float(length[i].as_py()), floors[i].as_py(), caps[i].as_py())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["qid", "part", "rid", "vec_id", "score"])

    return run


def search(rows: DataFrame, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of each query and range, by (score, smaller id): (qid, part, rid, vec_id, score).

    rows as of integer_rows; queries (rid, label, v, length, dims, floors, caps) with ranges of scores. same: only rows of the
    query's label other than itself; else only rows of other labels. Rows are dealt to blocks of length buckets, queries to
    blocks by the length that their lowest score needs: a block of vectors meets only query blocks that it can satisfy.
    """
    group = F.concat_ws(":", "dims", "label") if same else F.col("dims").cast("string")
    least = F.array_min("floors").cast("double")
    need = F.when((least > 0) & (F.col("length") > 0), least / F.col("length") * (1 - 1e-9)).otherwise(F.lit(0.0))
    rows = rows.withColumns({"g": group, "band": band(F.col("length"))})
    queries = queries.withColumns({"g": group, "need": band(need)})
    held = rows.groupBy("g", "band").count().select("g", "band", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    asked = queries.groupBy("g", "need").count().select("g", "need", F.ceil(F.col("count") / QUERY_BLOCK).cast("int").alias("blocks"))
    so_far = Window.partitionBy("g").orderBy("need").rowsBetween(Window.unboundedPreceding, -1)
    asked = asked.withColumn("first", F.coalesce(F.sum("blocks").over(so_far), F.lit(0)).cast("int"))
    # A group has some hundred buckets at most, whatever its size.
    held_by = held.groupBy("g").agg(F.collect_list(F.struct("band", "parts")).alias("held"))
    asked_by = asked.groupBy("g").agg(F.collect_list(F.struct("need", "blocks", "first")).alias("asked"))
    if held_by.count() <= BROADCAST_ROWS:
        held_by, asked_by = F.broadcast(held_by), F.broadcast(asked_by)
    cell = ["g", "band", "part", "block"]
    none = F.lit(None).cast("array<bigint>")

    parts = F.element_at(F.filter("held", lambda h: h["band"] == F.col("band")), 1)["parts"]
    last = F.aggregate(F.filter("asked", lambda a: a["need"] <= F.col("band")), F.lit(0), lambda s, a: s + a["blocks"])
    dealt = rows.join(held_by, "g").join(asked_by, "g").withColumns({"part": F.pmod(F.xxhash64("rid"), parts).cast("int"), "last": last}).where("last > 0")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last") - 1)))
    dealt = dealt.select(*cell, F.lit(0).alias("role"), "rid", "vec_id", "label", "v", "length", none.alias("floors"), none.alias("caps"))

    own = F.element_at(F.filter("asked", lambda a: a["need"] == F.col("need")), 1)
    block = own["first"] + F.pmod(F.xxhash64("rid"), own["blocks"]).cast("int")
    reach = F.flatten(F.transform(F.filter("held", lambda h: h["band"] >= F.col("need")), lambda h: F.transform(F.sequence(F.lit(0), h["parts"] - 1), lambda p: F.struct(h["band"].alias("band"), p.alias("part")))))
    asking = queries.join(held_by, "g").join(asked_by, "g").withColumn("block", block).withColumn("at", F.explode(reach))
    asking = asking.select("g", F.col("at.band").alias("band"), F.col("at.part").alias("part"), "block", F.lit(1).alias("role"), "rid", F.lit(0).cast("long").alias("vec_id"), "label", "v", "length", "floors", "caps")

    cells = dealt.union(asking).repartition(*cell).sortWithinPartitions(*cell, "role", "rid")
    found = cells.mapInArrow(_search(same, k), "qid bigint, part int, rid bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("qid", "part").orderBy(F.col("score").desc(), "vec_id", "rid")
    return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vectors -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its inner product with the anchor, of integer components floor(scale * x). An anchor's positives are its best
    rows of the same label; for each, the best rows of other labels with low% to high% of the positive's score are returned.
    Ties: smaller id first. `anchors` is a condition on vec_id, `label` an expression over the input.

    The search is exact. A bounded sample of each label, then of all rows, only gives every anchor a first bar (its
    positives-th best score there); the bar and the range say what length and what coordinates a row needs.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part. Rows of different dimension have no score
    with each other. Repeated ids are different rows: each is an anchor, a positive or a negative by itself. An anchor without
    positives, or a positive without negatives, gives no row. Scores beyond 63 bits wrap. Empty table: empty result.
    """
    scratch = Scratch(vectors.sparkSession, "hard-negatives")
    rows = scratch.table(integer_rows(vectors, id_col, vector_col, label if label is not None else F.col(f"`{label_col}`"), scale), "rows")
    asked = rows.where(anchors)
    here = F.pmod(F.xxhash64(F.lit("bar"), "rid"), F.lit(1 << 30)) / float(1 << 30)

    # Positives: a first bar from a sample of the label, then all of the label's rows above it.
    per_label = rows.groupBy("label").agg(F.count("*").alias("n"))
    per_label = F.broadcast(per_label) if per_label.count() <= BROADCAST_ROWS * 50 else per_label
    sample = rows.join(per_label, "label").where(here * F.col("n") < LABEL_SAMPLE).drop("n")
    open_range = asked.withColumns({"floors": F.array(F.lit(LEAST)), "caps": F.array(F.lit(-LEAST))})
    bars = search(sample, open_range, True, positives).groupBy("qid").agg(F.min("score").alias("bar"), F.count("*").alias("c")).where(F.col("c") >= positives)
    bars = scratch.table(bars.select(F.col("qid").alias("rid"), "bar"), "bars")
    barred = asked.join(bars, "rid", "left").withColumns({"floors": F.array(F.coalesce("bar", F.lit(LEAST))), "caps": F.array(F.lit(-LEAST))}).drop("bar")
    found = scratch.table(search(rows, barred, True, positives), "positives")

    # Negatives: one range for each positive, its lower end raised by what a sample of all rows already offers.
    ends = found.withColumns({"low": F.expr(f"(score * {low} + pmod(-score * {low}, 100)) div 100"), "cap": F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")})
    ranges = scratch.table(ends.select("qid", "k", "low", "cap", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).where("low <= cap"), "ranges")

    def with_ranges(floor: DataFrame) -> DataFrame:
        """Queries with the ranges of their positives in order of k; `part` of a hit is the place in that order."""
        own = floor.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("k", "low", "cap"))).alias("r"))
        own = own.select(F.col("qid").alias("rid"), F.col("r.low").alias("floors"), F.col("r.cap").alias("caps"))
        return asked.join(own, "rid")

    place = (F.row_number().over(Window.partitionBy("qid").orderBy("k")) - 1).alias("part")
    parts = scratch.table(ranges.select("*", place), "parts")
    total = rows.count()
    few = rows.where(here * F.lit(float(total)) < SAMPLE)
    bars = search(few, with_ranges(parts), False, negatives).groupBy("qid", "part").agg(F.min("score").alias("bar"), F.count("*").alias("c")).where(F.col("c") >= negatives)
    raised = scratch.table(parts.join(bars.drop("c"), ["qid", "part"], "left").withColumn("low", F.greatest("low", F.coalesce("bar", "low"))).drop("bar"), "raised")
    hits = search(rows, with_ranges(raised), False, negatives)
    out = hits.join(parts.select("qid", "part", "positive_id", "positive_score"), ["qid", "part"]).join(asked.select(F.col("rid").alias("qid"), F.col("vec_id").alias("anchor_id")), "qid")
    out = out.select("anchor_id", "positive_id", F.col("k").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    return scratch.last(out, "hard-negatives")


def mine_embeddings(vectors: DataFrame) -> DataFrame:
    """mine_hard_negatives of the embeddings table: anchors are ids divisible by 100; every seventh id has the next label, as noise."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


ORACLE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
