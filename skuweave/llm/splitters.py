"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitioning, split ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuweave.llm.common import unit_hash, written

COARSE = 32


def range_of(key: F.Column, bounds: list[int]) -> F.Column:
    """How many of the sorted bounds are at most key: a coarse search over every COARSE-th bound, then one slice."""
    if not bounds:
        return F.lit(0)
    every = F.lit(bounds[COARSE - 1 :: COARSE]).cast("array<bigint>")
    coarse = F.size(F.filter(every, lambda b: b <= key))
    rest = F.slice(F.lit(bounds).cast("array<bigint>"), coarse * COARSE + 1, F.lit(COARSE))
    return coarse * COARSE + F.size(F.filter(rest, lambda b: b <= key))


def shard_by_splitters(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, ranges_per_shard: int = 32, samples_per_range: int = 32, largest_group: float = 0.1
) -> DataFrame:
    """Rows -> (id, size, text_crc32, law, shard, slot, grown_shard); law is 'bytes': shard sizes are near equal.

    The key is a hash of the text, so equal texts are neighbours and share a shard, unless their bytes together are
    more than largest_group of a shard (then their rows are dealt out as single rows, else the shards could not be near equal).
    1. A sample drawn with probability proportional to size (about shards * ranges_per_shard * samples_per_range
       keys, whatever the number of rows) gives the range boundaries at its quantiles; a key of a large group is a range by itself.
    2. Every row goes to its range. An overfull range, of more than twice its share, is subdivided: evenly in key
       space if it has many keys, by a hash of the row if it is one key.
    3. Exact byte and row offsets of the pieces (a table of a bounded number of rows) place each row in the global
       order by key; the shard follows from the middle of the row's group, the slot is the row's place inside its shard.

    Null or empty text: size 16, crc 0. Null ids sort first. Repeated rows are kept, each with its own slot.
    An empty table gives an empty result. Extra columns are ignored. At any time only one narrow shuffle is needed.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("key"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = written(base, "shard-keys")
    total, rows = base.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = shards * ranges_per_shard
    target = max(1, total // ranges)

    # 1. Size-weighted sample. Its expected length is a constant; rows above the sampling step are always in it.
    rate = ranges * samples_per_range / max(1, total)
    drawn = base.where(unit_hash(F.lit("splitters"), F.col("row").cast("string"), F.col("key").cast("string")) < F.col("size") * rate)
    picked = sorted(r[0] for r in drawn.select("key").collect())
    # Groups of several rows that are too large to stay whole: at most shards / largest_group of them.
    heavy = base.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > largest_group * total / shards) & (F.col("n") > 1))
    alone = sorted(r[0] for r in heavy.select("key").collect())
    top = (1 << 63) - 1
    bounds = sorted({*(picked[len(picked) * i // ranges] for i in range(1, ranges) if picked), *alone, *(k + 1 for k in alone if k < top)})

    # 2. Pieces: what a range is cut into.
    ends = [-1 - top, *bounds, top]
    known = lambda values: F.lit(values).cast("array<bigint>")
    limits = docs.sparkSession.range(len(ends) - 1).select(F.col("id").cast("int").alias("range"), F.element_at(known(ends), F.col("id").cast("int") + 1).alias("lo"), F.element_at(known(ends), F.col("id").cast("int") + 2).alias("hi"))
    limits = limits.withColumn("single", F.array_contains(known(alone), F.col("lo")) if alone else F.lit(False))
    ranged = base.withColumn("range", range_of(F.col("key"), bounds).cast("int"))
    held = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).join(limits, "range")
    held = F.broadcast(held.select("range", "lo", "hi", "single", F.when((F.col("bytes") > 2 * target) | F.col("single"), F.ceil(F.col("bytes") / target)).otherwise(1).cast("int").alias("cuts")))
    share = (F.col("key").cast("double") - F.col("lo").cast("double")) / (F.col("hi").cast("double") - F.col("lo").cast("double"))
    even = F.least(F.col("cuts") - 1, F.floor(share * F.col("cuts")).cast("int"))
    ranged = ranged.join(held, "range").withColumn("cut", F.when(F.col("cuts") == 1, 0).when(F.col("single"), F.pmod(F.xxhash64("row"), F.col("cuts")).cast("int")).otherwise(even))

    # 3. Running bytes and rows inside each piece, then offsets of the pieces.
    piece = ["range", "cut"]
    w = Window.partitionBy(*piece).orderBy("key", "doc_id", "size", "text_crc32", "row")
    g = Window.partitionBy(*piece, "key")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.select(
        *piece, "single", "key", "doc_id", "size", "text_crc32",
        F.row_number().over(w).cast("long").alias("rn"),
        F.sum("size").over(run).alias("bytes_to"),
    )
    placed = placed.withColumn("group_to", F.max("bytes_to").over(g)).withColumn("group_from", F.min(F.col("bytes_to") - F.col("size")).over(g))
    placed = written(placed, "shard-places")
    sums = placed.groupBy(*piece).agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    order = Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sums.select(*piece, F.coalesce(F.sum("b").over(order), F.lit(0)).alias("byte_off"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("row_off")))
    middle = F.when(F.col("single"), F.col("bytes_to") - F.col("size") / 2).otherwise((F.col("group_from") + F.col("group_to")) / 2)
    at = placed.join(offsets, piece).select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(shards - 1), F.floor((F.col("byte_off") + middle) * shards / F.lit(float(max(1, total))))).cast("int").alias("shard"),
        (F.col("row_off") + F.col("rn") - 1).alias("place"),
    )
    first = F.broadcast(at.groupBy("shard").agg(F.min("place").alias("first")))
    return at.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
