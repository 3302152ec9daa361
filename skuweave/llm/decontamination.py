"""Benchmark decontamination: a prefix-filtered join of documents with the item-sized windows of benchmark items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import Scratch, hold, release, small_batches
from skuweave.llm.ngram_join import _has_bit, _set_bits, _slices

#: Words of a shingle; a window's rarest shingle is its prefix token.
SHINGLE = 5
#: Bits of the maps that spare positions without a token the join: 16 for each token, from 64 kB up to 32 MB. A full map only spares less.
TOKEN_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 19, 1 << 28
#: A table of windows is broadcast up to this size; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
CACHE_WORDS = 300_000

#: Of bytes: A-Z lower-cased; all other ASCII but digits and a-z parts words; what is not ASCII belongs to them.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_words: dict[bytes, bytes] = {}


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def hashed(parts: list[list[bytes]]) -> np.ndarray:
    """The 64-bit hashes of the words of all texts, one after another."""
    import xxhash

    hold(_words)
    get, raw = _words.get, []
    for words in parts:
        found = list(map(get, words))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    found[k] = _words[words[k]] = xxhash.xxh3_64_digest(words[k])
        raw.append(b"".join(found))
        if len(_words) > CACHE_WORDS:
            _words.clear()
            release()
    return np.frombuffer(b"".join(raw), "<u8")


def shingle_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n words from each place on; the last n - 1 places have none."""
    m = max(0, len(w) - n + 1)
    h = np.full(m, n, np.uint64)
    for i in range(n):
        h ^= w[i : m + i]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, text) -> (item, words, len, n, shingles): each window of an item, its words joined by a space, and its shingles of n words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                size = min(window, len(words))
                n = min(shingle, size)
                h = shingle_hashes(hashed([words]), n).view(np.int64) if size else ()
                for at in range(len(words) - size + 1 if size else 0):
                    rows.append((item, b" ".join(words[at : at + size]).decode("utf-8", "replace"), size, n, h[at : at + size - n + 1].tolist()))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(("item", "words", "len", "n", "shingles"), r, strict=True)) for r in rows], schema)

    schema = pa.schema([("item", pa.int64()), ("words", pa.string()), ("len", pa.int32()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))])
    return items.mapInArrow(run, "item bigint, words string, len int, n int, shingles array<bigint>")


def token_map(tokens: DataFrame, col: str, count: int):
    """A broadcast bit map of hashes: what has no bit is not among them."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, TOKEN_BITS * count):
        bits *= 2
    return tokens.sparkSession.sparkContext.broadcast(_set_bits(tokens, col, bits))


def _starts(parts: list[list[bytes]]) -> np.ndarray:
    return np.cumsum([0, *map(len, parts)])


def _hits(w: np.ndarray, starts: np.ndarray, sizes: list[int], bits: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each size of shingles: the shingles that have a bit, as (size, text, place in it, hash)."""
    for n in sizes:
        h = shingle_hashes(w, n)
        at = np.flatnonzero(_has_bit(bits, h))
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + n <= starts[text + 1]
        at, text = at[inside], text[inside]
        yield n, text, at - starts[text], h[at]


def shingle_counts(texts: DataFrame, sizes: list[int], bits) -> DataFrame:
    """How often each shingle that has a bit occurs in all texts: (h, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            parts = [words_of(t) for t in batch.column(0).to_pylist()]
            found = [h for _, _, _, h in _hits(hashed(parts), _starts(parts), sizes, bits.value)]
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "c"])

    return texts.select("text").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def posted_tokens(texts: DataFrame, sizes: list[int], window: int, bits) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, posts): a document's shingles that may be prefix tokens.

    A post has the token, its place, and the words around it that a window with this token can have: `lead` words
    before it and enough behind it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            parts = [words_of(t) for t in batch.column(1).to_pylist()]
            own, places, tokens, leads, around = [], [], [], [], []
            for n, text, place, h in _hits(hashed(parts), _starts(parts), sizes, bits.value):
                for k, p in zip(text.tolist(), place.tolist(), strict=True):
                    lead = min(p, window - n)
                    leads.append(lead)
                    around.append(b" ".join(parts[k][p - lead : p + window]).decode("utf-8", "replace"))
                own.append(text)
                places.append(place)
                tokens.append(h.view(np.int64))
            own = np.concatenate(own)
            order = np.argsort(own, kind="stable")
            posts = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(places)[order].astype(np.int32)), pa.array(np.concatenate(tokens)[order]), pa.array(leads, pa.int32()).take(pa.array(order)), pa.array(around, pa.string()).take(pa.array(order))], names=["place", "token", "lead", "around"]
            )
            ends = np.searchsorted(own[order], np.arange(len(parts) + 1), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) for p in parts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), posts)], names=["doc_id", "n_words", "posts"])

    return texts.mapInArrow(run, "doc_id bigint, n_words bigint, posts array<struct<place:int,token:bigint,lead:int,around:string>>")


def _if_small(df: DataFrame, size: Column) -> DataFrame:
    """df with a broadcast hint if the sum of `size`, the bytes of its rows, is small."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"):
    """-> (rows, spans, sets): rows (rid, doc_id, n_words) of all documents; spans (rid, start, end, item_set), the occurrences of
    windows in words, end exclusive; sets (item_set, items), the items that a window comes from.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window.
    1. The shingles of all windows are counted over the whole corpus (a bit map leaves out all other shingles).
    2. A window is a set of shingles in the order of rarity. It lies in a document whole, so its first shingle does too: that is
       the only prefix token. A window whose rarest shingle is nowhere is dropped.
    3. Documents post the shingles that are tokens (by a bit map), with the few words around them. The join on the token gives
       candidates; the token's place in the window and both lengths bound where it can start; equal words decide.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    scratch = Scratch(spark, "decontamination")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    named = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")).where("item is not null")
    every = scratch.table(item_windows(named, window, shingle), "windows")
    distinct = every.groupBy("words", "len", "n").agg(F.first("shingles").alias("shingles"), F.array_sort(F.collect_set("item")).alias("items"))
    distinct = scratch.table(distinct.withColumn("item_set", F.xxhash64("items")).withColumn("wid", F.monotonically_increasing_id()), "distinct")
    sets = scratch.table(distinct.groupBy("item_set", "items").count().drop("count"), "sets")
    shingles = distinct.select("wid", F.posexplode("shingles").alias("offset", "h"))
    sizes = sorted(r[0] for r in distinct.select("n").distinct().collect())

    if sizes:
        bits = token_map(shingles, "h", shingles.count())
        counts = scratch.table(shingle_counts(texts, sizes, bits), "counts")
        rarest = shingles.join(counts, "h", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "offset")).alias("t"))
        tokens = rarest.where("t.c > 0").select("wid", F.col("t.h").alias("token"), F.col("t.offset").alias("offset"))
        tokens = scratch.table(distinct.select("wid", "words", "len", "item_set").join(tokens, "wid"), "tokens")
        bits = token_map(tokens, "token", tokens.count())
        posted = posted_tokens(texts, sizes, window, bits)
    else:  # no item has words: documents have words, but no window
        bits = token_map(shingles, "h", 0)
        tokens = distinct.select("wid", "words", "len", "item_set", F.lit(0).cast("long").alias("token"), F.lit(0).alias("offset"))
        posted = posted_tokens(texts, [shingle], window, bits)
    posted = scratch.table(posted.withColumn("rid", F.monotonically_increasing_id()), "posted")

    posts = posted.select("rid", "n_words", F.explode("posts").alias("p")).select("rid", "n_words", "p.*")
    met = posts.join(_if_small(tokens, F.octet_length("words") + 80), "token").withColumn("start", F.col("place") - F.col("offset"))
    bounded = met.where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    there = F.array_join(F.slice(F.split("around", " "), F.col("lead") - F.col("offset") + 1, F.col("len")), " ")
    spans = bounded.where(there == F.col("words")).select("rid", "start", (F.col("start") + F.col("len")).alias("end"), "item_set")
    return scratch, posted.select("rid", "doc_id", "n_words"), scratch.table(spans, "spans"), sets


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = SHINGLE, **cols: str) -> DataFrame:
    """docs, items -> (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items), one row for each document row.

    n_hit counts the words inside any occurrence of a window; items are the ids of the items with occurring windows.

    Null or empty texts have no words and no hits. Repeated ids are rows of their own; a null id stays. Items of a null id or without
    words have no windows; a repeated item id counts once. Empty tables: no rows, or no hits. Other columns are ignored.
    """
    scratch, rows, spans, sets = contaminated_spans(docs, items, window, shingle, **cols)
    # Spans of one document are at most as many as its words times the lengths of windows.
    runs = spans.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"))
    step = lambda s, x: F.struct((s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["to"]))).alias("hit"), F.greatest(s["to"], x["end"]).alias("to"))
    hit = runs.select("rid", F.aggregate("runs", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("to")), step)["hit"].cast("long").alias("n_hit"))
    of = spans.select("rid", "item_set").distinct().join(_if_small(sets, 8 * F.size("items") + 40), "item_set")
    of = of.groupBy("rid").agg(F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_list("items"))), lambda x: x.cast("string"))).alias("items"))
    out = rows.join(hit.join(of, "rid"), "rid", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    out = out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"), listed.alias("items"),
    )
    return scratch.last(out, "decontaminated")


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the ids of contaminated documents; rows of a null id stay."""
    bad = decontaminate(docs, items, id_col=id_col, **options).where("contaminated and doc_id is not null").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS t
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), places AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hits AS (
  SELECT rid, s, n, item_id FROM places JOIN win USING (n, t)
), hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM hits)) GROUP BY rid
), own AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN own USING (rid)
"""
