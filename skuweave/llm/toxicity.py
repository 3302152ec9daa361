"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, learned from document labels."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import hold, small_batches

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
#: Longest word beginnings that are features beside the words themselves.
STEMS = (5, 7)
#: Labelled documents that a model is fitted on at most (those of the smallest hash): a bounded sample.
TRAIN_DOCS = 5000
FEATURES = 4000
THRESHOLD = 0.3


def features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in STEMS if len(word) >= k]]


@dataclass
class SentenceModel:
    """Weights of words and word beginnings; a sentence's logit is bias + the sum over its distinct features."""

    bias: float
    weights: dict[str, float]
    of_word: dict[str, tuple] = field(default_factory=dict, repr=False)

    def hits(self, word: str) -> tuple:
        """The word's features that have a weight; remembered, as few words have any."""
        got = self.of_word.get(word)
        if got is None:
            if len(self.of_word) > 150_000:
                self.of_word.clear()
            got = self.of_word[word] = tuple(f for f in features(word) if f in self.weights)
        return got

    def logits(self, text: str) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Of every sentence that holds a known feature, with its place in the text; the others' logit is the bias."""
        out, places = [], []
        hold(self.of_word)
        low = text.lower()
        text = low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for m in SENTENCE.finditer(text):
            found: set[str] = set()
            for w in WORD.findall(m.group()):
                found.update(self.hits(w))
            if found:
                out.append(self.bias + sum(self.weights[f] for f in found))
                places.append(m.span())
        return np.array(out), places

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over the sentences: 1 - prod(1 - p); and the sentences with their own p, worst first."""
        z, places = self.logits(text or "")
        log_clean = -np.logaddexp(0.0, z)
        p = float(-np.expm1(log_clean.sum())) if len(z) else 0.0
        order = np.argsort(-z, kind="stable")
        return min(1.0, max(0.0, p)), [(*places[i], float(1 / (1 + np.exp(-z[i])))) for i in order]


def fit_sentences(texts: list[str], labels: np.ndarray, max_features: int = FEATURES, rounds: int = 250, rate: float = 0.15, l2: float = 2e-4) -> SentenceModel:
    """Fits the sentence model to document labels through the noisy-or, by Adam on the log-likelihood."""
    def sentences(t: str) -> Iterator[set[str]]:
        return ({f for w in WORD.findall(s) for f in features(w)} for s in SENTENCE.findall(t.lower()))

    n_pos = max(1, int(labels.sum()))
    n_neg = max(1, len(labels) - n_pos)
    # Only beginnings of words in at least 3 positive documents matter; one document's features are held at a time.
    pos: Counter = Counter()
    for t, y in zip(texts, labels, strict=True):
        if y:
            pos.update(set().union(*sentences(t)))
    pos = Counter({f: a for f, a in pos.items() if a >= 3})
    neg: Counter = Counter()
    for t, y in zip(texts, labels, strict=True):
        if not y:
            neg.update(set().union(*sentences(t)) & pos.keys())
    # Features by how unlike their document frequencies are in the two classes (signed root of the chi-square).
    z = {}
    for f, a in pos.items():
        b = neg.get(f, 0)
        p = (a + b) / (n_pos + n_neg)
        z[f] = (a / n_pos - b / n_neg) / np.sqrt(max(p * (1 - p), 1e-9) * (1 / n_pos + 1 / n_neg))
    chosen = sorted((f for f in z if z[f] > 3.0), key=lambda f: (-z[f], f))[:max_features]
    at = {f: i for i, f in enumerate(chosen)}
    doc_of, starts, ids = [], [], []
    for k, t in enumerate(texts):
        for s in sentences(t):
            own = sorted(at[f] for f in s if f in at)
            if own:
                doc_of.append(k)
                starts.append(len(ids))
                ids.extend(own)
    if not ids or labels.min() == labels.max():
        return SentenceModel(-8.0, {})
    doc_of, starts, ids, y = np.array(doc_of), np.array(starts), np.array(ids), labels.astype(float)
    sent_of = np.repeat(np.arange(len(starts)), np.diff([*starts, len(ids)]))
    w, bias = np.full(len(chosen), 0.5), -3.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        logit = bias + np.add.reduceat(w[ids], starts)
        log_clean = np.zeros(len(y))
        np.add.at(log_clean, doc_of, -np.logaddexp(0.0, logit))
        p = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        # d loglik / d logit of a sentence: s for a negative document lowers, (1 - p) / p * s for a positive one raises.
        s = 1 / (1 + np.exp(-logit))
        g = np.where(y[doc_of] > 0, s * (1 - p[doc_of]) / p[doc_of], -s)
        grad = np.append(np.bincount(ids, g[sent_of], len(w)) / len(y) - l2 * w, g.sum() / len(y))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w + step[:-1], bias + step[-1]
    return SentenceModel(float(bias), {f: float(x) for f, x in zip(chosen, w, strict=True) if abs(x) > 1e-3})


def held_out(doc_id, of: int, rest: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % of == rest


def held_out_column(of: int, rest: int, id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo `of`, is `rest`; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of == rest


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 4, held: int = 2) -> SentenceModel:
    """Fits on at most train_docs labelled documents outside the held-out fold, those whose id's hash is smallest."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out_column(folds, held, id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    known = known.orderBy(F.xxhash64("_id", F.lit("train")), "_id").limit(train_docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).join(F.broadcast(known), "_id")
    pdf = rows.orderBy(F.xxhash64("_id", F.lit("train")), "_id", "_text").limit(train_docs).toPandas()
    if pdf.empty:
        return SentenceModel(-8.0, {})
    return fit_sentences(pdf["_text"].tolist(), pdf["_y"].to_numpy())


def score_documents(docs: DataFrame, model: SentenceModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", max_spans: int = 0) -> DataFrame:
    """docs -> (doc_id, score, predicted, spans): every whole text scored; spans are its offending sentences.

    A sentence is offending if its own probability reaches the threshold; spans are 'start:end' in code points, worst
    first. Null, empty or unknown text scores 0. Null ids and repeated rows are kept; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    cache: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = cache.setdefault("model", SentenceModel(*shared.value))
        for batch in batches:
            got = [local.score(t) for t in batch.column(1).to_pylist()]
            spans = [",".join(f"{a}:{b}" for a, b, p in s if p >= threshold) for _, s in got]
            cols = [batch.column(0), pa.array([p for p, _ in got], pa.float64()), pa.array([int(p >= threshold) for p, _ in got], pa.int32()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "predicted", "spans"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id bigint, score double, predicted int, spans string")


def keep_clean(docs: DataFrame, model: SentenceModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is under the threshold, with all their columns. No id is needed and nothing is joined."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    cache: dict = {}
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = cache.setdefault("model", SentenceModel(*shared.value))
        for batch in batches:
            yield batch.filter(pa.array([local.score(t.as_py())[0] < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
