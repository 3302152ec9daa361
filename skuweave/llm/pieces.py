"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda of adjacent symbol pairs."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import hold, small_batches

SPACE = "▁"
#: Segments whose ids a Python worker keeps; beyond that the memory starts afresh.
CACHE_SEGMENTS = 600_000
#: Segments up to this length are merged many at once; longer ones alone.
SHORT = 24
#: A decode call gets about so many ids at most, or one document.
DECODE_IDS = 200_000


class AgendaEncoder:
    """Encodes as the sentencepiece library does for a BPE model with byte fallback and no text normalisation rules.

    A text becomes a space sign, then the text with its spaces replaced by that sign, cut into characters. All
    adjacent pairs that are pieces wait in an agenda ordered by score, then by place; the best is merged and its new
    neighbours join the agenda, until none is left. What is no piece in the end becomes its UTF-8 byte pieces.

    As no piece has the sign after another character, and none holds a line end, merges never cross those places;
    so the text is cut there and each segment's ids are remembered.
    """

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(model_path, "rb") as f:
            data = f.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback, a leading space and no normalisation are supported")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
            elif p.type == kinds.NORMAL:
                self.rank[p.piece] = -p.score
                self.id[p.piece] = i
            elif p.type in (kinds.USER_DEFINED, kinds.UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.id):
            raise ValueError("a piece holds a space sign inside or a line end: segments cannot be cut")
        self._pair_table()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.name = [str(i) for i in range(len(proto.pieces))]
        self.first = self.id[SPACE]
        self.cache: dict[str, tuple[str, tuple[int, ...]]] = {}

    def merge(self, segment: str) -> list[int]:
        """The ids of one segment, its spaces already replaced."""
        rank, sym = self.rank, list(segment)
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            r = rank.get(sym[i] + sym[i + 1])
            if r is not None:
                agenda.append((r, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if not sym[i] or not sym[j] or right[i] != j or len(sym[i]) + len(sym[j]) != size:
                continue  # one of the two has since been merged
            sym[i] += sym[j]
            sym[j] = ""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                r = rank.get(sym[i] + sym[k])
                if r is not None:
                    heapq.heappush(agenda, (r, i, k, len(sym[i]) + len(sym[k])))
            h = left[i]
            if h >= 0:
                r = rank.get(sym[h] + sym[i])
                if r is not None:
                    heapq.heappush(agenda, (r, h, i, len(sym[h]) + len(sym[i])))
        out: list[int] = []
        for s in sym:
            if s:
                i = self.id.get(s)
                if i is not None:
                    out.append(i)
                else:
                    out.extend(self.byte[b] for b in s.encode())
        return out

    def _pair_table(self) -> None:
        """Every pair of symbols that makes a piece, as sorted numbers, with the piece's score rank and symbol."""
        self.symbol = dict(self.id)
        for p in self.id:
            for c in p:
                self.symbol.setdefault(c, len(self.id) + 256 + len(self.symbol))
        rows = []
        for p, r in self.rank.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    rows.append((a * 2**32 + b, r, self.symbol[p]))
        rows.sort()
        self.pair = np.array([*(x[0] for x in rows), 2**62])
        self.pair_rank = np.array([*(x[1] for x in rows), np.inf])
        self.pair_made = np.array([*(x[2] for x in rows), 0])
        self.chars = {c: s for c, s in self.symbol.items() if len(c) == 1}
        self.by_id = {i: (i,) for i in self.id.values()}
        for c, s in self.chars.items():
            if c not in self.id:
                self.by_id[s] = tuple(self.byte[b] for b in c.encode())

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of symbols (negative: none) the score rank, infinite where they make no piece, and the symbol made."""
        key = (a << 32) + b
        at = np.searchsorted(self.pair, key)
        hit = (self.pair[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.pair_rank[at], np.inf), self.pair_made[at]

    def merge_many(self, segments: list[str]) -> list[tuple[int, ...]]:
        """merge() for segments of one length: a row of the matrices is a segment, and holds its agenda's ranks in place."""
        n, length = len(segments), len(segments[0])
        codes = np.array(segments).view(np.uint32).reshape(n, -1)[:, :length]
        kinds, where = np.unique(codes, return_inverse=True)
        sym = np.array([self.chars.get(chr(c), -2 - int(c)) for c in kinds], np.int64)[where].reshape(n, length)
        out: list[tuple[int, ...]] = [()] * n
        row = np.arange(n)
        rank, made = (x.reshape(n, length - 1) for x in self._ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()))
        while True:
            best = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), int)
            live = rank[np.arange(len(row)), best] < np.inf if rank.shape[1] else np.zeros(len(row), bool)
            for r, s in zip(row[~live].tolist(), sym[~live].tolist(), strict=True):
                out[r] = tuple([i for x in s for i in (self.by_id[x] if x >= 0 else [self.byte[b] for b in chr(-2 - x).encode()])])
            if not live.any():
                return out
            row, sym, rank, made, best = row[live], sym[live], rank[live], made[live], best[live]
            m, width = sym.shape
            all_rows = np.arange(m)
            sym[all_rows, best] = made[all_rows, best]
            # The symbol after the merged pair's first goes, and so does the pair's own place in the agenda.
            sym = sym[np.arange(width)[None, :] != best[:, None] + 1].reshape(m, width - 1)
            keep = np.arange(width - 1)[None, :] != best[:, None]
            rank, made = rank[keep].reshape(m, width - 2), made[keep].reshape(m, width - 2)
            for shift in (-1, 0):  # its new neighbours to the left and to the right
                ok = (best + shift >= 0) & (best + shift < width - 2)
                r, at = all_rows[ok], best[ok] + shift
                rank[r, at], made[r, at] = self._ranks(sym[r, at], sym[r, at + 1])

    def merge_all(self, segments: list[str]) -> list[tuple[int, ...]]:
        by_length: dict[int, list[int]] = {}
        out: list[tuple[int, ...]] = [()] * len(segments)
        for i, s in enumerate(segments):
            if 1 < len(s) <= SHORT and "\0" not in s:
                by_length.setdefault(len(s), []).append(i)
            else:
                out[i] = tuple(self.merge(s))
        for at in by_length.values():
            for lo in range(0, len(at), 8192):
                part = at[lo : lo + 8192]
                for i, ids in zip(part, self.merge_many([segments[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    @staticmethod
    def segments(text: str, _slow=re.compile(" *[^ \n]+| +|\n[^ \n]*")) -> list[str]:
        """The cuts of a text that is not empty, with its leading space; each starts with spaces or a line end, or is the rest of spaces."""
        text = " " + text.replace(SPACE, " ")
        if "  " in text or "\0" in text:
            return _slow.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def learn(self, cuts: set[str]) -> None:
        """Encode new segments, and hold every one of them against the library."""
        if len(self.cache) + len(cuts) > CACHE_SEGMENTS:
            self.cache.clear()
        new = [c for c in cuts if c not in self.cache]
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            # The library puts a space before a text: one is taken off, or cut from the ids where there is none.
            theirs = self.library.encode([c[1:] if c[0] == " " else c for c in part], num_threads=1)
            for c, own, ids in zip(part, self.merge_all([c.replace(" ", SPACE) for c in part]), theirs, strict=True):
                if list(own) != (ids if len(c) > 1 and c[0] == " " else ids[1:] if c[0] != " " else [self.first]):
                    raise ValueError(f"the agenda and the library encode {c!r} differently")
                self.cache[c] = (",".join([self.name[i] for i in own]), own)

    def encode_many(self, texts: list[str]) -> Iterator[tuple[int, str, list[int]]]:
        """For each text: number of ids, the ids joined by commas, the ids."""
        hold(self.cache)
        cuts = [self.segments(t) if t else [] for t in texts]
        self.learn(set().union(*cuts))
        get = self.cache.__getitem__
        for own in cuts:
            found = [get(c) for c in own]
            ids = list(chain.from_iterable([x[1] for x in found]))
            yield len(ids), ",".join([x[0] for x in found]), ids

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text]))[2]


@lru_cache(maxsize=2)
def encoder(model_path: str) -> AgendaEncoder:
    """One for each Python worker and model."""
    return AgendaEncoder(model_path)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, digests: bool = False) -> DataFrame:
    """docs -> one row per row: id, n_tokens, ids array<int> (if with_ids), and if digests ids_sha256 and decoded_sha256.

    The file model_path must be readable on every executor. Ids are those of the library without begin or end ids;
    every distinct segment is compared with the library when a worker first meets it, and a difference stops the job.
    decoded_sha256 is of the text that the library's decode(ids) gives. Null or empty text: no ids. Null and repeated
    ids are kept as they are; an empty table gives an empty one; other columns are ignored. Long texts are encoded
    whole; a worker holds one Arrow batch and a bounded memory of segments.
    """
    small_batches(docs.sparkSession)
    fields = f"{id_col} bigint, n_tokens bigint"
    fields += ", ids array<int>" if with_ids else ""
    fields += ", ids_sha256 string, decoded_sha256 string" if digests else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                counts, lists, sums, decoded = [], [], [], []
                waiting: list[list[int]] = []

                def flush():
                    decoded.extend(hashlib.sha256(t.encode()).hexdigest() for t in enc.library.decode(waiting, num_threads=1))
                    waiting.clear()

                held = 0
                texts = [x or "" for x in batch.column(1).to_pylist()]
                for n, joined, ids in enc.encode_many(texts):
                    counts.append(n)
                    if with_ids:
                        lists.append(ids)
                    if digests:
                        sums.append(hashlib.sha256(joined.encode()).hexdigest())
                        waiting.append(ids)
                        held += n
                        if held > DECODE_IDS:
                            flush()
                            held = 0
                if waiting:
                    flush()
                cols = [batch.column(0), pa.array(counts, pa.int64())]
                cols += [pa.array(lists, pa.list_(pa.int32()))] if with_ids else []
                cols += [pa.array(sums, pa.string()), pa.array(decoded, pa.string())] if digests else []
                yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in fields.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, fields)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """Adds out_col: the text of the ids by the library's decode; null ids give null."""

    @F.pandas_udf("string")
    def decode(ids):
        lib = encoder(model_path).library
        return ids.map(lambda x: None if x is None else lib.decode([int(i) for i in x]))

    return df.withColumn(out_col, decode(F.col(ids_col)))
