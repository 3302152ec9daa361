"""Near-duplicate vectors by a pivot-permutation index: ordered nearest pivots, inverted lists, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import written
from skuweave.operators.components import connected_components

#: Pivots of a label: this times the root of its vectors, within these bounds. Drawn by hash: a bounded sample.
PIVOT_FACTOR, LEAST_PIVOTS, MOST_PIVOTS = 4.0, 32, 16_384
#: Nearest pivots that describe a vector; two vectors meet in the lists if they share at least two of these.
NEAREST = 8
#: Labels whose sizes are broadcast, 40 bytes each.
BROADCAST_LABELS = 100_000
#: Vectors of one list that a task compares at once; a longer list is compared in blocks.
BLOCK = 1024


#: Vectors of a label that a task describes together with the label's pivots, and those of one matrix product.
DESCRIBED, ROWS = 8192, 256


def _permutations(nearest: int):
    """Rows sorted by label, part and role, pivots (0) before vectors (1) -> vectors with their ordered nearest pivots, by number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, pivots, table = None, [], None
        for pdf in batches:
            for own_key, own in pdf.groupby(["label", "part"], sort=False):
                if own_key != key:
                    key, pivots, table = own_key, [], None
                pivots += own.loc[own["role"] == 0, "unit"].tolist()
                own = own[own["role"] == 1]
                for lo in range(0, len(own), ROWS):
                    rows = own.iloc[lo : lo + ROWS]
                    table = np.stack(pivots).T if table is None else table
                    sims = np.stack(rows["unit"].to_numpy()) @ table
                    k = min(nearest, sims.shape[1])
                    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    order = np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable")
                    top = np.take_along_axis(top, order, 1)
                    yield pd.DataFrame({"label": rows["label"], "rep": rows["rep"], "copies": rows["copies"], "unit": rows["unit"], "near": list(top.astype(np.int32))})

    return run


#: Lists up to this length are compared together with many others, longer ones as a matrix product.
SHORT = 48


def _links(x: np.ndarray, near: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs are links that this list counts: those whose two smallest shared pivots are the list's."""
    ok = np.zeros(len(a), bool)
    for lo in range(0, len(a), 1 << 16):
        u, v = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
        hit = np.flatnonzero(np.einsum("ij,ij->i", x[u], x[v]) >= threshold)
        u, v = u[hit], v[hit]
        # Shared-pivot counts: of the pivots up to hi, a pair must share exactly two, else another list has it.
        shared = (near[u][:, :, None] == near[v][:, None, :]).any(2)
        ok[lo + hit[(shared & (near[u] <= hi[u][:, None])).sum(1) == 2]] = True
    return ok


def _compare(threshold: float):
    """Over rows sorted by list and block pair: each vector's weighted number of links, and edges of a spanning forest."""

    def of(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        rep, copies, block, hi = (pdf[c].to_numpy() for c in ("rep", "copies", "block", "hi"))
        within = (pdf["i"] == pdf["j"]).to_numpy()
        x, near = np.stack(pdf["unit"].to_numpy()), np.stack(pdf["near"].to_numpy())
        size = np.diff([*starts, len(pdf)])
        group = np.repeat(np.arange(len(starts)), size)
        small = (size <= SHORT)[group]
        left, right = [], []
        for d in range(1, int(size[size <= SHORT].max(initial=1))):
            at = np.flatnonzero((group[:-d] == group[d:]) & small[d:])
            left.append(at)
            right.append(at + d)
        for g in np.flatnonzero(size > SHORT):
            rows = np.arange(starts[g], starts[g] + size[g])
            a, b = np.nonzero(np.triu(x[rows] @ x[rows].T >= threshold - 1e-9, 1))
            left.append(rows[a])
            right.append(rows[b])
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *left]), np.concatenate([none, *right])
        keep = (within[a] | (block[a] != block[b])) & (rep[a] != rep[b])
        a, b = a[keep], b[keep]
        ok = _links(x, near, hi, a, b, threshold)
        a, b = a[ok], b[ok]
        links = np.bincount(np.concatenate([a, b]), np.concatenate([copies[b], copies[a]]), len(rep)).astype(np.int64)
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while (up := root.setdefault(v, v)) != v:
                root[v] = root.setdefault(up, up)
                v = root[v]
            return v

        for u, v in zip(rep[a].tolist(), rep[b].tolist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
        sums = pd.DataFrame({"rep": rep, "links": links}).query("links > 0").groupby("rep", as_index=False)["links"].sum()
        sums["to"] = [find(v) for v in sums["rep"].tolist()]
        return sums.astype("int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # a list may go over the end of a batch
        names = ["label", "lo", "hi", "i", "j"]
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pd.concat([*held, pdf], ignore_index=True)
            change = (pdf[names] != pdf[names].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(change)
            last = starts[-1]
            held = [pdf.iloc[last:]]
            if last:
                yield of(pdf.iloc[:last].reset_index(drop=True), starts[:-1])
        if held:
            yield of(held[0].reset_index(drop=True), np.array([0]))

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, nearest: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """vectors -> (vec_id, n_links, component_id, kept): links have equal labels and a cosine of at least threshold.

    Vectors of a label with equal unit vectors form a class. Each class is described by its ordered nearest pivots and posted in the
    inverted list of every two of them, so classes that share two pivots meet; they are verified by cosine in double
    precision. The index holds all rows; only the pivots are a sample (at most MOST_PIVOTS for each label). A link is
    missed only if fewer than two pivots are shared (tests measure the recall). Lists longer than BLOCK are compared
    block by block in separate tasks, so a hot list is neither cut nor collected; pairs are counted, not emitted.

    Null, zero, empty or non-finite vectors, null labels and null ids: no links; their component is themselves.
    Vectors of different lengths are never compared. Repeated ids count as different vectors but share a component.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & (norm > 0) & (norm < float("inf")), F.lit(False))
    good = v.where(fit).withColumn("label", F.concat_ws(":", "label", F.size("v").cast("string")))
    good = good.withColumn("norm", norm).select("label", "vec_id", F.transform("v", lambda x: x / F.col("norm")).alias("unit"))
    classes = written(good.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")

    # Each label's vectors in parts, every part with the label's pivots: nothing of them passes through the driver.
    sizes = classes.groupBy("label").agg(F.count("*").alias("n"))
    sizes = sizes.select("label", "n", F.least(F.lit(MOST_PIVOTS), F.greatest(F.lit(LEAST_PIVOTS), F.floor(PIVOT_FACTOR * F.sqrt("n")))).cast("int").alias("wanted"), F.ceil(F.col("n") / DESCRIBED).cast("int").alias("parts"))
    # A row for each label: broadcast where there are few, so that a hot label is no shuffled key.
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LABELS else sizes
    # Candidates by a hash bar first, about twice as many as wanted: only these are ranked, whatever the label's size.
    bar = F.pmod(F.xxhash64("rep", F.lit("pivot")), F.lit(1 << 40)) / float(1 << 40)
    near = classes.select("label", "rep", "unit", bar.alias("h")).join(sizes, "label").where(F.col("h") * F.col("n") < 2 * F.col("wanted") + 64)
    drawn = near.withColumn("k", F.expr("row_number() over (partition by label order by h, rep)")).where("k <= wanted")
    drawn = drawn.select("label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("k").cast("long").alias("rep"), F.lit(0).cast("long").alias("copies"), "unit")
    dealt = classes.join(sizes, "label").select("label", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "rep", "copies", "unit")
    dealt = dealt.union(drawn).repartition("label", "part").sortWithinPartitions("label", "part", "role", "rep")
    shape = "label string, rep bigint, copies bigint, unit array<double>, near array<int>"
    described = written(dealt.mapInPandas(_permutations(nearest), shape), "permutations")

    pairs = F.flatten(F.transform("near", lambda p: F.transform(F.filter("near", lambda q: q > p), lambda q: F.struct(p.alias("lo"), q.alias("hi")))))
    posts = described.select("label", "rep", F.explode(pairs).alias("k")).select("label", "k.lo", "k.hi", "rep")
    key = ["label", "lo", "hi"]
    lists = posts.groupBy(*key).count().where("count > 1").select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    posts = posts.join(lists, key).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    posts = posts.withColumn("m", F.explode(meet)).select(*key, F.col("m.i").alias("i"), F.col("m.j").alias("j"), "block", "rep")
    full = posts.join(described.drop("label"), "rep")
    order = [*key, "i", "j"]
    full = full.select(*order, "block", "rep", "copies", "unit", "near").repartition(*order).sortWithinPartitions(*order)
    found = full.mapInPandas(_compare(threshold), "rep bigint, links bigint, to bigint")
    found = written(found, "vector-links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    members = good.join(classes.select("label", "unit", "rep", "copies"), ["label", "unit"]).select("vec_id", "rep", "copies")
    members = members.join(links, "rep", "left").select("vec_id", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    members = written(members, "vector-members")
    edges = found.select(F.col("rep").alias("a"), F.col("to").alias("b")).union(members.select("vec_id", "rep"))
    comps = connected_components(edges)
    out = members.join(comps, members["vec_id"] == comps["id"], "left").select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
    out = out.union(v.where(~fit).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
