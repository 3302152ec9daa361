"""Quality by a sparse rule ensemble: tree paths as rules over text statistics, lasso logistic weights, Spark columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.toxicity import held_out_column

#: Labelled rows whose statistics a model is fitted on at most (those of the smallest hash): a bounded sample.
TRAIN_ROWS = 6_000
THRESHOLD = 0.3
STATS = ("log_chars", "word_length", "upper", "symbol", "digit", "distinct", "repeated_lines", "line_length")


def statistics(text: F.Column) -> dict[str, F.Column]:
    """Statistics of a whole text as built-in column expressions; null text counts as ''."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.filter(F.split(t, r"\n"), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(pattern: str) -> F.Column:
        return (n - F.length(F.regexp_replace(t, pattern, "")).cast("double")) / n

    return {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "word_length": n / n_words,
        "upper": share(r"\p{Lu}+"),
        "symbol": share(r"[^\p{L}\p{N}\s.,]+"),
        "digit": share(r"[0-9]+"),
        "distinct": F.size(F.array_distinct(words)).cast("double") / n_words,
        "repeated_lines": F.lit(1.0) - F.size(F.array_distinct(lines)).cast("double") / n_lines,
        "line_length": n / n_lines,
    }


@dataclass
class RuleModel:
    """Rules are lists of (statistic, is_at_most, bound); a rule is 1 where all its conditions hold."""

    bias: float
    rules: list[tuple[list[tuple[str, bool, float]], float]]

    def column(self) -> F.Column:
        """The model as one expression over the statistics' columns: the probability of label 1."""
        z = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, at_most, bound in conditions:
                holds = holds & ((F.col(name) <= bound) if at_most else (F.col(name) > bound))
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree(x: np.ndarray, residual: np.ndarray, depth: int, least: int, path: list, out: list, names: tuple[str, ...]) -> np.ndarray:
    """A least-squares regression tree over quantile cuts; every node but the root gives a path. Returns predictions."""
    value = residual.mean() if len(residual) else 0.0
    best = None
    if depth and len(residual) >= 2 * least:
        for j in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 20))):
                left = x[:, j] <= cut
                k = int(left.sum())
                if least <= k <= len(left) - least:
                    a, b = residual[left].mean(), residual[~left].mean()
                    gain = k * a * a + (len(left) - k) * b * b
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, j, float(cut), left)
    if best is None or best[0] <= len(residual) * value * value + 1e-9:
        return np.full(len(residual), value)
    _, j, cut, left = best
    pred = np.empty(len(residual))
    for at_most, rows in ((True, left), (False, ~left)):
        own = [*path, (names[j], at_most, cut)]
        out.append(own)
        pred[rows] = _tree(x[rows], residual[rows], depth - 1, least, own, out, names)
    return pred


def _rule_matrix(x: np.ndarray, rules: list, names: tuple[str, ...]) -> np.ndarray:
    at = {n: i for i, n in enumerate(names)}
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for name, at_most, bound in rule:
            out[:, k] *= (x[:, at[name]] <= bound) if at_most else (x[:, at[name]] > bound)
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = STATS, trees: int = 16, depth: int = 3, rate: float = 0.3, lasso: float = 2e-3, rounds: int = 300, seed: int = 7) -> RuleModel:
    """Boosted trees on half-samples give the rules; FISTA with soft thresholding gives sparse logistic weights."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
        return RuleModel(float(np.log(p / (1 - p))), [])
    rng = np.random.default_rng(seed)
    base = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    f, rules = np.full(len(y), base), []
    least = max(5, len(y) // 200)
    for _ in range(trees):
        part = rng.random(len(y)) < 0.5
        if part.sum() < 2 * least:
            part[:] = True
        own: list = []
        _tree(x[part], (y - 1 / (1 + np.exp(-f)))[part], depth, least, [], own, names)
        if not own:
            continue
        leaves = _rule_matrix(x, own, names)
        deep = [k for k, r in enumerate(own) if not any(o[: len(r)] == r and len(o) > len(r) for o in own)]
        res = y - 1 / (1 + np.exp(-f))
        for k in deep:
            rows = leaves[:, k] > 0
            if rows.any():
                p = 1 / (1 + np.exp(-f[rows]))
                f[rows] += rate * res[rows].sum() / (p * (1 - p)).sum().clip(1e-6)
        rules += own
    unique = list({tuple(sorted(r)): r for r in rules}.values())
    r = _rule_matrix(x, unique, names)
    mean, dev = r.mean(0), r.std(0).clip(0.05)
    r = (r - mean) / dev
    w, b, wm, bm, t = np.zeros(r.shape[1]), base, np.zeros(r.shape[1]), base, 1.0
    v = np.ones(r.shape[1])
    for _ in range(20):  # the largest eigenvalue, by powers
        v = r.T @ (r @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 4.0 / (1.1 * np.linalg.norm(r @ v) ** 2 / len(y) + 1)
    for _ in range(rounds):
        g = 1 / (1 + np.exp(-(bm + r @ wm))) - y
        nw = wm - step * (r.T @ g) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * lasso, 0)
        nb = bm - step * g.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wm, bm = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel(float(b - (w * mean / dev).sum()), [(unique[k], float(w[k] / dev[k])) for k in kept])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held: int = 0) -> RuleModel:
    """Fits on the statistics of at most train_rows labelled documents outside the held-out fold, smallest hash first."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out_column(folds, held, id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("_y"))
    known = known.orderBy(F.xxhash64("_id", F.lit("train")), "_id").limit(train_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    rows = rows.select("_id", "_y", *[c.alias(n) for n, c in statistics(F.col("_text")).items()])
    pdf = rows.orderBy(F.xxhash64("_id", F.lit("train")), *rows.columns).limit(train_rows).toPandas()
    return fit_rules(pdf[list(STATS)].to_numpy(float), pdf["_y"].to_numpy(float))


def score_documents(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, score, predicted): every whole text, scored by built-in columns only.

    Null text is ''. Null ids and repeated rows are kept; an empty table gives an empty one; other columns are ignored.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in statistics(F.col(text_col)).items()])
    out = out.select("doc_id", model.column().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
