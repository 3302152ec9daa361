"""Token-id files compressed by Re-Pair grammars, with random access to documents."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuweave.llm.common import hold, small_batches
from skuweave.sources.shared import new_path

#: Encoded chunks that a Python worker keeps; beyond that the memory starts afresh.
CACHE_CHUNKS = 600_000
#: Bytes of text that are cut and looked up together, about.
PIECE_BYTES = 4 << 20


#: Bits of the table in which pairs are counted by their hash, at most.
SLOT_BITS = 20


#: A word of Latin letters after a space: one word of the pattern.
LETTERS = re.compile(" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Byte-level vocabularies spell a byte as the Latin-1 sign of its number if that is printable, the others as signs from
#: U+0100 on, in order.
SPACE = "\u0120"
BYTE_SIGNS = np.arange(256, dtype="<u4")
BYTE_SIGNS[[*range(33), *range(127, 161), 173]] = 256 + np.arange(68)


class ChunkedTokenizer:
    """The tokenizers library over texts cut at places where its byte-level pattern always cuts.

    One space or line end before another character starts a word of the pattern or is a word of its own, whatever
    stands before it; so does a point or comma after a letter or digit. So a text is cut before those, and each
    distinct chunk goes through the library once: many chunks in a row, whose ids are told apart by the bytes that
    each id stands for. A text that may hold a special token goes through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.model._resize_cache(0)  # no chunk is asked for twice
        special = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in special.values()]
        self.other_space = re.compile(r"[^\S \n]")
        self.cut = re.compile(r"(?=[ \n]\S)")
        # A point or comma after an ASCII or Latin-1 letter or digit starts a word of the pattern, too.
        self.no_stop = re.compile("[.,](?<![A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff][.,])")
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # in byte-level vocabularies a character stands for a byte
            self.width[i] = len(token)
        # The same vocabulary for words of plain letters, each of which is one word of the pattern.
        self.letters = Tokenizer.from_file(path)
        self.letters.model._resize_cache(0)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.cache: dict[str, int] = {}  # the number of each chunk
        self.bounds = np.zeros(1, np.int64)  # chunk i has ids[bounds[i] : bounds[i + 1]]
        self.ids = np.zeros(0, "<u4")

    def _other_space(self, t: str) -> bool:
        return any(c in t for c in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f") if t.isascii() else self.other_space.search(t) is not None

    def _bytes(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encodes new chunks, many in a row; those of letters without the pattern.

        A chunk that does not start with a space or line end, or ends with white space, may not stand beside others in
        the library's input and goes there alone.
        """
        alone, ascii_words, words, other = [], [], [], []
        for c in new:
            if not c or c[0] not in " \n" or c[-1].isspace():
                alone.append(c)
            elif c[0] == " " and c.isascii() and c[1:].isalpha():
                ascii_words.append(c)
            elif LETTERS.fullmatch(c):
                words.append(c)
            else:
                other.append(c)
        known, bounds = [self.ids], [self.bounds]
        top = int(self.bounds[-1])
        for part in (alone, ascii_words, words, other):
            if not part:
                continue
            if part is alone:
                found = [e.ids for e in self.library.encode_batch_fast(part, add_special_tokens=False)]
                ids = np.array([i for own in found for i in own], "<u4")
                bounds.append(top + np.cumsum(list(map(len, found))))
            else:
                ids, ends = self._in_a_row(part, part is not other)
                bounds.append(top + ends)
            known.append(ids)
            top += len(ids)
            self.cache.update(zip(part, range(len(self.cache), len(self.cache) + len(part)), strict=True))
        self.ids, self.bounds = np.concatenate(known), np.concatenate(bounds)

    def _in_a_row(self, part: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks of part and where those of each end; letters: each is a space and letters."""
        library = self.letters if letters else self.library
        ids: list[int] = []
        for lo in range(0, len(part), 128):
            line = "".join(part[lo : lo + 128])
            if letters:  # as the vocabulary spells bytes, blanks between the words
                if not line.isascii():
                    line = BYTE_SIGNS[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-32-le").replace(SPACE, " ")
                line = line.replace(" ", f" {SPACE}")
            ids += library.encode_batch_fast([line], add_special_tokens=False)[0].ids
        out = np.array(ids, "<u4")
        ends = np.cumsum(pc.binary_length(pa.array(part, pa.large_string())).to_numpy())
        reached = np.cumsum(self.width[out])
        at = np.searchsorted(reached, ends)
        if (reached[np.minimum(at, len(out) - 1)] != ends).any():
            raise ValueError("ids that cross a cut: not a byte-level vocabulary")
        return out, at + 1

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks; new ones are encoded first."""
        found = list(map(self.cache.get, chunks))
        new = [c for c, n in zip(chunks, found, strict=True) if n is None] if None in found else []
        if new:
            if len(self.cache) + len(new) > CACHE_CHUNKS:
                self.cache.clear()
                new = chunks
            if not self.cache:  # full, or emptied by another operator
                self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u4")
            self._learn(new)
            found = list(map(self.cache.get, chunks))
        return np.array(found, np.int64)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        hold(self.cache)
        if not texts:
            return []
        cut: list[str] = []  # the texts with a zero sign at each cut
        whole: list[int] = []
        for i, t in enumerate(texts):
            if "\0" in t or any(x in t for x in self.special):
                whole.append(i)
                t = ""
            elif "  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[-1:] in (" ", "\n") or self._other_space(t):
                t = "\0".join(c for c in self.cut.split(t) if c)
            else:
                stops = t[:1] not in ".," and not self.no_stop.search(t)
                t = t.replace(" ", "\0 ").replace("\n", "\0\n")
                if stops:
                    t = t.replace(".", "\0.").replace(",", "\0,")
            cut.append(t)
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), "\0")
        chunks = lists.values.dictionary_encode()
        number = self._numbers(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        first, size = self.bounds[number], self.bounds[number + 1] - self.bounds[number]
        code = chunks.indices.to_numpy()
        own = size[code]
        upto = np.cumsum(own)
        ids = self.ids[np.repeat(first[code] - (upto - own), own) + np.arange(upto[-1])].tobytes()
        ends = (upto[lists.offsets.to_numpy()[1:] - 1] * 4).tolist()
        out = list(map(ids.__getitem__, map(slice, [0, *ends[:-1]], ends)))
        for i in whole:
            out[i] = self._bytes(texts[i])
        return out


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """batch in pieces of whole rows with about PIECE_BYTES in a text column; equal chunks of a piece are looked up once."""
    part = np.cumsum(pc.binary_length(batch.column(column)).to_numpy()) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkedTokenizer:
    """One for each Python worker and file."""
    return ChunkedTokenizer(path)


def compress(ids: np.ndarray, least: int = 5, base: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of one shard: (left, right, sequence); nonterminal base + i stands for the pair left[i], right[i].

    Each round counts the adjacent pairs, makes a nonterminal of every pair that occurs at least `least` times, and
    replaces occurrences from left to right; of two overlapping ones the more frequent pair's is kept. Pairs are
    counted exactly where a table of hash counts says that they may be frequent enough. Rounds go on until no pair
    occurs `least` times; pairs that lost their slot or their occurrences in a round have their turn in a later one.
    A pair's count only falls after the round that made its symbols, so a pair once rare is never counted again.
    """
    seq = ids.astype(np.int32)
    alive = np.ones(len(seq), bool)  # where a pair begins that may be frequent
    alive[-1:] = False
    left, right = [], []
    made = 0
    while len(place := np.flatnonzero(alive)):
        key = (seq[place].astype(np.int64) << 31) | seq[place + 1]
        bits = min(SLOT_BITS, len(place).bit_length() + 2)  # later rounds have few places left
        mask = (1 << bits) - 1
        slot = (key * np.int64(-7046029254386353131) >> (63 - bits)) & mask
        often = np.flatnonzero((np.bincount(slot, minlength=mask + 1) >= least)[slot])
        hot = np.sort(key[often])
        first = np.flatnonzero(np.diff(hot, prepend=-1))
        counts = np.diff(first, append=len(hot))
        good = counts >= least
        if not good.any():
            break
        # Rules by falling count, so that a smaller number is the more frequent pair; one pair for each slot.
        pairs = hot[first[good]]
        pairs = pairs[np.argsort(-counts[good], kind="stable")]
        number = np.full(mask + 1, -1)
        number[(pairs[::-1] * np.int64(-7046029254386353131) >> (63 - bits)) & mask] = np.arange(len(pairs))[::-1]
        rule = number[slot[often]]
        alive[:] = False
        alive[place[often]] = True  # all that a rule does not take now has its turn later
        own = np.flatnonzero((rule >= 0) & (pairs[rule] == key[often]))
        at, rule = place[often[own]], rule[own]
        # A pair that overlaps itself takes every second place of its run.
        twin = np.flatnonzero((pairs >> 31 == pairs & 0x7FFFFFFF)[rule])
        if len(twin):
            start = np.flatnonzero((np.diff(at[twin], prepend=-2) != 1) | (np.diff(rule[twin], prepend=-1) != 0))
            odd = (np.arange(len(twin)) - np.repeat(start, np.diff(start, append=len(twin)))) % 2 == 1
            at, rule = np.delete(at, twin[odd]), np.delete(rule, twin[odd])
        # Runs of overlapping occurrences: keep those that no neighbour beats, then what no kept one touches.
        kept_at, kept_rule = [], []
        for _ in range(3):
            touch = np.diff(at) == 1
            lose = np.zeros(len(at), bool)
            lose[1:] |= touch & (rule[:-1] <= rule[1:])
            lose[:-1] |= touch & (rule[1:] < rule[:-1])
            kept_at.append(at[~lose])
            kept_rule.append(rule[~lose])
            near = np.zeros(len(at), bool)
            near[1:] |= touch & ~lose[:-1]
            near[:-1] |= touch & ~lose[1:]
            rest = lose & ~near
            at, rule = at[rest], rule[rest]
            if not len(at):
                break
        at, rule = np.concatenate(kept_at), np.concatenate(kept_rule)
        times = np.bincount(rule, minlength=len(pairs)) > 0
        used, rule = np.flatnonzero(times), (np.cumsum(times) - 1)[rule]
        chosen = pairs[used]
        left.append(chosen >> 31)
        right.append(chosen & 0x7FFFFFFF)
        seq[at] = base + made + rule
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, alive = seq[stay], alive[stay]
        new = np.sort(at) - np.arange(len(at))
        alive[new] = True
        alive[np.maximum(new - 1, 0)] = True
        alive[-1:] = False
        made += len(used)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), seq


def expansion_lengths(left: np.ndarray, right: np.ndarray, base: int = 1 << 17) -> np.ndarray:
    """Ids that each nonterminal stands for; rules only use earlier rules."""
    size = np.ones(len(left), np.int64)
    todo = np.arange(len(left))
    ready = np.zeros(len(left) + 1, bool)
    while len(todo):
        a, b = left[todo] - base, right[todo] - base
        ok = ((a < 0) | ready[np.maximum(a, 0)]) & ((b < 0) | ready[np.maximum(b, 0)])
        now, a, b = todo[ok], a[ok], b[ok]
        size[now] = np.where(a < 0, 1, size[np.maximum(a, 0)]) + np.where(b < 0, 1, size[np.maximum(b, 0)])
        ready[now] = True
        todo = todo[~ok]
    return size


def expand(seq: np.ndarray, left: np.ndarray, right: np.ndarray, length: np.ndarray, base: int = 1 << 17) -> np.ndarray:
    """The ids that a piece of a sequence stands for; length has the ids of each rule.

    Every symbol's place in the result is known, so ids are put there at once and only nonterminals go on: the work is
    the number of symbols in all derivations, not the sequence for each of their levels.
    """
    width = lambda s: np.where(s < base, 1, length[np.maximum(s - base, 0)]) if len(length) else np.ones(len(s), np.int64)
    ends = np.cumsum(width(seq))
    out = np.empty(int(ends[-1]) if len(seq) else 0, "<u4")
    at = ends - width(seq)
    while len(seq):
        plain = seq < base
        out[at[plain]] = seq[plain]
        at, rule = at[~plain], seq[~plain] - base
        first, second = left[rule], right[rule]
        seq, at = np.concatenate([first, second]), np.concatenate([at, at + width(first)])
    return out


SHARD_FIELDS = "part int, shard int, n_docs bigint, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, rule_left binary, rule_right binary, rule_length binary, sequence binary"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 32 << 20, shard_ids: int = 1_000_000) -> None:
    """Token ids of docs in ascending order of the id, as a Parquet table of Re-Pair shards under path.

    docs is range-partitioned by id (about part_bytes of text each) and every part is cut into shards of whole
    documents with up to shard_ids ids (a longer document is a shard of its own). A shard row holds the documents'
    ids and lengths, the rules (pairs of 32-bit symbols), each rule's expansion length and the final sequence: what
    random access needs. Spark's writer commits the files, so lost executors leave none behind.

    Null ids come first, repeated ids stay in the order of their texts; null or empty text has only the end id. An
    empty table writes an empty table. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, end = tokenizer(tokenizer_path), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        part, shard = TaskContext.get().partitionId(), 0
        names, lengths, held, n = [], [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            left, right, seq = compress(ids)
            raw = [x.astype("<u4").tobytes() for x in (left, right, expansion_lengths(left, right), seq)]
            row = [part, shard, len(names), len(ids), names.copy(), lengths.copy(), *raw]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split()[0] for f in SHARD_FIELDS.split(", ")])

        for whole in batches:
            for batch in pieces(whole, 1):
                for name, own in zip(batch.column(0).to_pylist(), tok.encode_many(batch.column(1).to_numpy(zero_copy_only=False).tolist()), strict=True):
                    own += end
                    if n and n + len(own) // 4 > shard_ids:
                        yield close()
                        shard += 1
                        for x in (names, lengths, held):
                            x.clear()
                        n = 0
                    names.append(name)
                    lengths.append(len(own) // 4)
                    held.append(own)
                    n += len(own) // 4
        if names:
            yield close()

    parts = max(1, -(-size // part_bytes))
    ordered = src.repartitionByRange(parts, "_id").sortWithinPartitions("_id", "_text")
    ordered.mapInArrow(run, SHARD_FIELDS).write.option("compression", "zstd").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Every document of the files in order: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and its place (part, shard, doc)."""
    files = spark.read.schema(SHARD_FIELDS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                left, right, length, seq = (np.frombuffer(row[k].as_buffer(), "<u4").astype(np.int64) for k in ("rule_left", "rule_right", "rule_length", "sequence"))
                names, lengths = row["doc_ids"].values, row["doc_lengths"].values.to_numpy()
                part, shard, ids = row["part"].as_py(), row["shard"].as_py(), expand(seq, left, right, length)
                if len(ids) != row["n_ids"].as_py():
                    raise ValueError(f"part {part}, shard {shard}: {len(ids)} ids instead of {row['n_ids']}")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[a:b]) for a, b in zip((starts * 4).tolist(), (ends * 4).tolist(), strict=True)]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part, np.int32)), pa.array(np.full(k, shard, np.int32)), pa.array(np.arange(k, dtype=np.int32)), names, pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["part", "shard", "doc", "doc_id", "in_shard", "n_tokens", "ids_crc32"],
                )

    docs = files.mapInArrow(run, "part int, shard int, doc int, doc_id bigint, in_shard bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = files.select("part", "shard", "n_ids")
    parts = sums.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_off"))
    shards = sums.select("part", "shard", F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("shard")), F.lit(0)).alias("shard_off"))
    docs = docs.join(shards.join(parts, "part"), ["part", "shard"])
    return docs.select("doc_id", (F.col("part_off") + F.col("shard_off") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", "part", "shard", "doc")


def slice_of(row, start: int, stop: int) -> np.ndarray:
    """ids[start:stop] of one shard row, expanding only the symbols that hold them (random access)."""
    left, right, length, seq = (np.frombuffer(row[k], "<u4").astype(np.int64) for k in ("rule_left", "rule_right", "rule_length", "sequence"))
    base = 1 << 17
    size = np.ones(len(seq), np.int64)
    deep = seq >= base
    size[deep] = length[seq[deep] - base]
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    return expand(seq[a:b], left, right, length)[start - (ends[a] - size[a] if a < len(ends) else 0) :][: stop - start]


def token_file_path(spark) -> str:
    return new_path(spark, "token-files")
