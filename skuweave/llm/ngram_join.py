"""Exact n-gram Jaccard components of documents by a token-group matrix."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import Scratch, hold, small_batches
from skuweave.operators.components import connected_components

#: Bits of the map that marks frequent n-grams: 2 MB, whatever the number of documents.
MAP_BITS = 1 << 24
#: One of so many documents is in the sample that only decides the order of n-grams, never a result.
ORDER_SAMPLE = 16
#: A frequent n-gram is in at least FREQUENT sampled documents and in one of FREQUENT_SHARE of them. So there are at
#: most FREQUENT_SHARE times as many as a document has n-grams, however many documents there are.
FREQUENT, FREQUENT_SHARE = 3, 20_000
#: A unit of a group has about so many documents or bytes of n-grams at most; larger groups have several units.
UNIT_DOCS, UNIT_BYTES = 256, 4 << 20
#: Documents that a task compares with one unit; beyond that other tasks take the rest.
UNIT_QUERIES = 2048
#: Bits of the map that spares documents without a candidate the second pass: 16 for each id, up to 32 MB.
ID_BITS, MOST_ID_BITS = 16, 1 << 28
CACHE_WORDS = 300_000


class Shingler:
    """64-bit hashes of the distinct n-grams of a text's words."""

    def __init__(self, n: int):
        self.n, self.cache = n, {}

    def shingles(self, text: str | None) -> np.ndarray:
        return self.of_many([text])[0]

    def of_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text its sorted distinct n-grams; with fewer than n words the whole sequence is one; no words, none."""
        import xxhash

        hold(self.cache)
        get, count, raw = self.cache.get, [], []
        for t in texts:
            parts = t.encode("utf-8", "surrogatepass").lower().split() if t else []  # of bytes: A-Z and the white space \x20 \x09-\x0D only
            found = list(map(get, parts))
            if None in found:
                for k, x in enumerate(found):
                    if x is None:
                        found[k] = self.cache[parts[k]] = xxhash.xxh3_64_digest(parts[k])
            count.append(len(parts))
            raw.append(b"".join(found))
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
        w = np.frombuffer(b"".join([*raw, bytes(8 * self.n)]), "<u8")
        ends = np.cumsum(count)
        # All texts at once; what runs over a text's end is not taken below.
        m = len(w) - self.n
        h = np.full(m, self.n, np.uint64)
        for i in range(self.n):
            h ^= w[i : m + i]
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        out = []
        for c, end in zip(count, ends.tolist(), strict=True):
            if c >= self.n:
                own = np.sort(h[end - c : end - self.n + 1])
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                out.append(own[keep])
            elif c:
                out.append(np.array([xxhash.xxh3_64_intdigest(w[end - c : end].tobytes())], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


@lru_cache(maxsize=4)
def shingler(n: int) -> Shingler:
    return Shingler(n)


def prefix_length(size: np.ndarray | int, percent: int):
    """Two sets of which 100 * both >= percent * either share one of so many first elements of each, in any common order."""
    return size - -(-size * percent // 100) + 1


def least_shared(size):
    """How many of their posted n-grams two linked sets share at least, by the smaller one; a number or a column."""
    return 1 + size // 20 if isinstance(size, int | np.ndarray) else 1 + F.floor(size / 20).cast("int")


def _set_bits(hashes: DataFrame, col: str, bits: int) -> bytes:
    """A bit map of a column of longs, put together from its bytes on the executors."""
    at = F.pmod(F.col(col), F.lit(bits))
    words = hashes.select(F.shiftright(at, 3).cast("int").alias("at"), F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int")).alias("bit"))
    words = words.groupBy("at").agg(F.bit_or("bit").cast("short").alias("bits")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    out[words["at"].to_numpy()] = words["bits"].to_numpy().astype(np.uint8)
    return out.tobytes()


def _has_bit(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    table = np.frombuffer(bits, np.uint8)
    at = np.mod(hashes.view(np.int64), 8 * len(table))
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, rows):
            yield whole.slice(lo, rows)


def frequent_map(texts: DataFrame, n: int) -> bytes:
    """A map of the n-grams that are frequent in a sample of documents.

    It only decides in which order n-grams are compared (rare ones first), so that a passage in very many documents
    brings few candidates. Any map gives the same result: neither its sample nor its hash collisions lose a link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sh = shingler(n)
        for batch in _slices(batches, 1024):
            sets = sh.of_many(batch.column(1).to_pylist())
            if sets:
                hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "c"])

    sample = texts.where(F.pmod(F.xxhash64("id", F.lit("order")), F.lit(ORDER_SAMPLE)) == 0)
    least = max(FREQUENT, texts.count() // ORDER_SAMPLE // FREQUENT_SHARE)
    often = sample.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    return _set_bits(often, "h", MAP_BITS)


def posted_sets(texts: DataFrame, n: int, percent: int, frequent: bytes) -> DataFrame:
    """(id, text) -> (id, size, set_key, rare, tokens): what a document posts of its set.

    tokens are the set's first n-grams in the order (frequent, hash), as longs that sort in that order: as many as two
    linked sets cannot both miss, and least_shared - 1 more, so that linked sets share least_shared of them. rare
    counts the n-grams that are not frequent. Equal keys are equal sets; the key is null for an empty set.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sh, none = shingler(n), np.zeros(0, np.uint64)
        for batch in _slices(batches):
            sets = sh.of_many(batch.column(1).to_pylist())
            size = np.array([len(s) for s in sets], np.int64)
            hot = _has_bit(shared.value, np.concatenate([none, *sets]))
            ends = np.cumsum(size)
            rare, tokens, count = np.zeros(len(sets), np.int64), [none], np.zeros(len(sets) + 1, np.int32)
            for k, (s, end) in enumerate(zip(sets, ends.tolist(), strict=True)):
                if len(s):
                    late = hot[end - len(s) : end]
                    cold = s[~late] >> np.uint64(2)
                    most = prefix_length(len(s), percent) + least_shared(len(s)) - 1
                    tokens += [cold[:most], (s[late][: max(0, most - len(cold))] >> np.uint64(2)) | np.uint64(1 << 62)]
                    rare[k], count[k + 1] = len(cold), min(most, len(s))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(count, dtype=np.int32)), pa.array(np.concatenate(tokens).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(keys, pa.binary()), pa.array(rare), lists], names=["id", "size", "set_key", "rare", "tokens"])

    return texts.mapInArrow(run, "id bigint, size bigint, set_key binary, rare bigint, tokens array<bigint>")


def id_map(ids: DataFrame, col: str = "id"):
    """A broadcast bit map of hashed ids, 16 bits for each of them: what has no bit is not among them."""
    bits = 1 << 16
    while bits < min(MOST_ID_BITS, ID_BITS * ids.count()):
        bits *= 2
    return ids.sparkSession.sparkContext.broadcast(_set_bits(ids.select(F.xxhash64(col).alias("h")), "h", bits))


def sets_of(texts: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, text), ids -> (id, grams): the whole sets of the wanted ids, 8 bytes for each n-gram.

    A bit map spares most other texts; the join decides.
    """
    wanted = id_map(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sh = shingler(n)
        for batch in _slices(batches):
            batch = batch.filter(pa.array(_has_bit(wanted.value, batch.column(2).to_numpy())))
            if batch.num_rows:
                sets = sh.of_many(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "grams"])

    found = texts.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(run, "id bigint, grams binary")
    return found.join(ids, "id", "left_semi")


class Unit:
    """Whole sets of a unit's documents, joined to one sorted table of n-grams."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate(sets)
        order = np.argsort(grams, kind="stable")
        self.grams, self.owner = grams[order], np.repeat(np.arange(len(sets), dtype=np.int32), self.size)[order]

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        """The numbers of the documents linked with the set s: 100 * both >= percent * either, counted exactly."""
        lo, hi = np.searchsorted(self.grams, s, "left"), np.searchsorted(self.grams, s, "right")
        width = hi - lo
        hit = width > 0
        lo, width = lo[hit], width[hit]
        at = np.repeat(lo - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        both = np.bincount(self.owner[at], minlength=len(self.size))
        return np.flatnonzero((both > 0) & (100 * both >= percent * (len(s) + self.size - both)))


def compared(rows: DataFrame, percent: int) -> DataFrame:
    """(k1, k2, role, id, grams) -> links (a, b) that join what is linked inside each key (k1, k2).

    Rows of role 0 are the documents of a unit and are compared with each other; rows of role 1 are compared with
    those of role 0. No more links are returned than a forest has. A task holds one unit and one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, sets, unit, root, out = None, [], [], None, {}, []

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root.setdefault(up, up)
                x = root[x]
            return x

        def join(a: int, others: np.ndarray) -> None:
            for k in others.tolist():
                x, y = find(a), find(names[k])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((a, names[k]))

        def close() -> None:
            nonlocal unit
            if unit is None and sets:
                unit = Unit(sets)
                if len(sets) > 1:
                    for k, s in enumerate(sets):
                        more = unit.linked(s, percent)
                        join(names[k], more[more < k])
                sets.clear()

        for batch in batches:
            k1, k2, role, ids, grams = (batch.column(i) for i in range(5))
            for own, r, i, g in zip(zip(k1.to_pylist(), k2.to_pylist(), strict=True), role.to_pylist(), ids.to_pylist(), grams, strict=True):
                if own != key:
                    close()
                    key, names, unit, root = own, [], None, {}
                s = np.frombuffer(g.as_buffer(), np.uint64)
                if r == 0:
                    names.append(i)
                    sets.append(s)
                else:
                    close()
                    if unit is not None:
                        join(i, unit.linked(s, percent))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    key = ["k1", "k2"]
    dealt = rows.select(*key, "role", "id", "grams").repartition(*key).sortWithinPartitions(*key, "role", "id")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def ngram_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, n_shingles, component_id): exact components of the links 100 * both >= percent * either.

    A document's set is its distinct n-grams of words (A-Z lower-cased, ASCII white space between words); with fewer
    words the whole sequence; without words it is empty, and then linked with nothing. component_id is the smallest
    id reachable by links, the document's own included.

    1. Documents of equal sets form a class; its smallest id stands for it. Each class posts the first n-grams of its
       set in the order (frequent, hash), so many that linked sets share least_shared of them.
    2. Groups of similar documents: each list of postings has one head, the set with the fewest rare n-grams, and each
       document joins the one head that it meets in most lists. Groups are cut into units of a bounded size, the head
       is in all of them, and inside a unit all documents are compared. Links found so far give components.
    3. The token-group matrix has a row for each posted n-gram and unit (documents of one unit and component), with
       the range of their sizes and the most n-grams that any of them has from there on: the union of the unit's posted
       n-grams. A document's overlap with a unit of another component is bounded by its posted n-grams in that union,
       by their number and by what is left after them; only units that may reach a link's overlap are opened, and the
       document is compared with the whole sets in them. Of two units the smaller one's documents ask.
    Nothing is capped or sampled: two linked documents are in one unit, in one component, or one of them opens the
    other's unit. Pairs of documents are never rows: a group of thousands of near copies is a few units.

    A null id keeps its n_shingles and gets a null component. Rows of one id count as linked. Empty table: empty
    result. Other columns are ignored. Broadcast are bit maps of 2 MB and of at most 32 MB.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    scratch = Scratch(spark, "ngram-join")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    posted = scratch.table(posted_sets(texts, n, percent, frequent_map(texts, n)), "posted")
    texts = texts.where("id is not null")
    named = posted.where("set_key is not null and id is not null")
    classes = scratch.table(named.groupBy("set_key").agg(F.min("id").alias("id"), F.count("*").alias("members"), F.first("size").alias("size")), "classes")

    # Postings that more than one class has, each with the head of its list.
    first = named.groupBy("set_key").agg(F.min(F.struct("id", "rare", "tokens")).alias("c"))
    posts = first.select("c.id", "c.rare", F.posexplode("c.tokens").alias("pos", "token"))
    heads = posts.groupBy("token").agg(F.count("*").alias("c"), F.min(F.struct("rare", "id")).alias("head")).where("c > 1")
    met = scratch.table(posts.select("token", "id", "pos").join(heads.select("token", F.col("head.id").alias("head")), "token"), "met")

    # Groups and their units.
    votes = met.where("id <> head").groupBy("id", "head").agg(F.count("*").alias("votes"))
    best = votes.groupBy("id").agg(F.max(F.struct("votes", (-F.col("head")).alias("low"))).alias("b")).select("id", (-F.col("b.low")).alias("grp"), "b.votes")
    best = best.join(classes.groupBy("id").agg(F.max("size").alias("size")), "id").where(F.col("votes") >= least_shared(F.col("size")))
    best = scratch.table(best, "best")
    groups = best.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / UNIT_DOCS), F.ceil(F.sum("size") * 8 / UNIT_BYTES)).cast("int").alias("units"))
    units = best.select("id", "grp").join(groups, "grp").select("grp", F.pmod(F.xxhash64("id"), F.col("units")).cast("int").alias("unit"), "id")
    units = units.union(groups.select("grp", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("unit"), F.col("grp").alias("id")))
    units = scratch.table(units, "units")
    grouped = scratch.table(sets_of(texts, units.select("id").distinct(), n), "sets")
    links = scratch.table(compared(units.join(grouped, "id").select(F.col("grp").alias("k1"), F.col("unit").alias("k2"), F.lit(0).alias("role"), "id", "grams"), percent), "links")
    comps = connected_components(links)

    # Every document is in one unit of its component: in its group's, or by itself.
    places = met.select("id").distinct().join(comps, "id", "left").select("id", F.coalesce("component", "id").alias("comp"))
    own = units.where("id <> grp").groupBy("id").agg(F.min(F.struct("grp", "unit")).alias("at"))
    places = places.join(own, "id", "left").select("id", "comp", F.coalesce("at", F.struct(F.col("id").alias("grp"), F.lit(0).alias("unit"))).alias("at"))
    sizes = places.groupBy("at", "comp").agg(F.count("*").alias("docs"))
    places = places.join(sizes, ["at", "comp"]).select("id", "comp", "at", F.struct("docs", "at", "comp").alias("u"))
    places = scratch.table(places.join(classes.select("id", "size").distinct(), "id"), "places")

    # The matrix, the bound on overlaps, and the units that are opened.
    rows = met.select("token", "id", "pos").join(places.select("id", "u", "size"), "id").withColumn("left", F.col("size") - F.col("pos"))
    rows = scratch.table(rows.drop("pos"), "rows")
    matrix = rows.groupBy("token", F.col("u").alias("other")).agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max("left").alias("other_left"))
    fits = (F.col("high") * 100 >= F.col("size") * percent) & (F.col("size") * 100 >= F.col("low") * percent)
    apart = (F.col("u.comp") != F.col("other.comp")) & (F.col("u.at") != F.col("other.at"))
    # The k-th n-gram of an overlap has all of it but k - 1 left; the first `shared` of an overlap are posted on both sides.
    shared = least_shared(F.least("low", "size"))
    needed = F.greatest("low", F.ceil(F.col("size") * percent / 100)) + F.col("size")
    far = (F.least("left", "other_left") + shared - 1) * (100 + percent) >= needed * percent
    reach = rows.join(matrix, "token").where((F.col("u") < F.col("other")) & apart & fits & far)
    reach = reach.groupBy("id", F.col("other").alias("u")).agg(F.count("*").alias("overlap"), F.min(shared).alias("shared"))
    opened = scratch.table(reach.where("overlap >= shared").select("u", "id"), "opened")

    # Opened units: their documents once for each block of documents that ask.
    blocks = opened.groupBy("u").agg(F.ceil(F.count("*") / UNIT_QUERIES).cast("int").alias("blocks"))
    inside = places.select("id", "u").join(blocks, "u").select("u", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k2"), F.lit(0).alias("role"), "id")
    asking = opened.join(blocks, "u").select("u", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("k2"), F.lit(1).alias("role"), "id")
    both = scratch.table(inside.union(asking).select(F.concat_ws(":", "u.at.grp", "u.at.unit", "u.comp").alias("k1"), "k2", "role", "id"), "open-units")
    rest = sets_of(texts, both.select("id").distinct().join(units.select("id").distinct(), "id", "left_anti"), n)
    sets = grouped.union(scratch.table(rest, "sets"))
    more = scratch.table(compared(both.join(sets, "id"), percent), "links")

    same = named.select("id", "set_key").join(classes.where("members > 1").select("set_key", F.col("id").alias("rep")), "set_key").select("id", "rep")
    found = connected_components(links.union(more).union(same))
    out = posted.select("id", "size").join(found, "id", "left")
    return scratch.last(out.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")), "ngram-components")


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents whose component has a smaller id; of rows with one id the first by text stays.

    Rows without words, and rows with a null id, stay. Of rows with equal id and text the first by all their columns
    stays. Only the ids that go are joined, so texts need not be shuffled where those are few.
    """
    comps = ngram_components(docs, n, percent, id_col, text_col)
    gone = comps.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    going = id_map(gone, id_col)

    @F.pandas_udf("boolean")
    def may_go(h: pd.Series) -> pd.Series:
        return pd.Series(_has_bit(going.value, h.to_numpy(np.int64)))

    here = may_go(F.xxhash64(F.col(id_col).cast("long")))
    out = docs.where(~here).unionByName(docs.where(here).join(gone, id_col, "left_anti").select(*docs.columns))
    twice = comps.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col))
    if twice.isEmpty():
        return out
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = out.join(twice, id_col, "left_semi").groupBy(id_col).agg(F.min_by(whole, F.struct(text_col, F.to_json(whole))).alias("_row")).select("_row.*")
    return out.join(twice, id_col, "left_anti").unionByName(rest)
