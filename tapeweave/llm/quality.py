"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled documents; every
path from a root to a node becomes a conjunction of comparisons, a lasso
logistic regression keeps the few that matter, and those are compiled into one
Spark column expression. Scoring therefore is a projection in the scan: no
shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000  # labelled documents that the fit may see at most; bounds what the driver collects
FOLDS = 5
THRESHOLD = 0.3
_WS = "[\\x20\\x09-\\x0D]+"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text by name; all are 0 for an empty or null one."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    words = F.filter(F.split(t, _WS), lambda w: w != "")
    per_char = F.greatest(n, F.lit(1))
    per_word = F.greatest(F.size(words), F.lit(1))

    def share(pattern: str) -> Column:
        return (n - F.length(F.regexp_replace(t, pattern, ""))) / per_char

    return {
        "log_chars": F.log1p(n.cast("double")),
        "word_length": n / per_word,
        "distinct_words": F.size(F.array_distinct(words)) / per_word,
        "capitals": share("\\p{Lu}+"),
        "digits": share("\\p{N}+"),
        "symbols": share("[#*%&$@~^=<>+_\\\\/{}\\[\\]]+"),
        "bars": share("\\|+"),
        "exclamations": share("!+"),
        "stops": share("[.?]+"),
        "commas": share("[,;:]+"),
        "lines": share("\\n+"),
    }


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions; a condition is (statistic, above, bound): above, or not above it."""

    rules: tuple[tuple[tuple[str, bool, float], ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1 from columns named as the statistics."""
        z = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            met = F.lit(True)
            for name, above, bound in rule:
                met = met & ((F.col(name) > bound) if above else (F.col(name) <= bound))
            z = z + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree(binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, least: int,
          bins: int) -> tuple[list[tuple[tuple[int, bool, int], ...]], np.ndarray]:
    """Paths (feature, above, bin) of all nodes of one regression tree, and its step for each row."""
    step = np.zeros(len(gradient))
    paths: list[tuple[tuple[int, bool, int], ...]] = []
    todo = [((), np.arange(len(gradient)))]
    while todo:
        path, rows = todo.pop()
        if path:
            paths.append(path)
        g, h = gradient[rows], weight[rows]
        best = (1e-9, -1, -1)
        if len(path) < depth and len(rows) >= 2 * least:
            for f in range(binned.shape[1]):
                code = binned[rows, f]
                gs = np.cumsum(np.bincount(code, g, bins))[:-1]
                hs = np.cumsum(np.bincount(code, h, bins))[:-1]
                ns = np.cumsum(np.bincount(code, minlength=bins))[:-1]
                gain = gs ** 2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                gain[(ns < least) | (len(rows) - ns < least)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] < 0:
            step[rows] = g.sum() / (h.sum() + 1)
            continue
        above = binned[rows, best[1]] > best[2]
        todo.append(((*path, (best[1], False, best[2])), rows[~above]))
        todo.append(((*path, (best[1], True, best[2])), rows[above]))
    return paths, step


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """L1 logistic weights by accelerated proximal gradient steps; the intercept is free."""
    n, m = x.shape
    xs = np.c_[x, np.ones(n)]
    v = np.ones(m + 1) / np.sqrt(m + 1)
    for _ in range(20):
        v = xs.T @ (xs @ v)
        v /= np.linalg.norm(v) or 1.0
    rate = 4 * n / max(float(v @ (xs.T @ (xs @ v))), 1e-9)
    w = z = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(xs @ z, -30, 30)))
        new = z - rate * (xs.T @ (p - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w[:-1], float(w[-1])


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, bins: int = 64,
              seed: int = 7, penalties: tuple[float, ...] = (3e-4, 1e-3, 3e-3)) -> RuleModel:
    """Fit on rows ``x`` of statistics with labels ``y`` (0/1). Without both labels the score is constant."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel((), (), 0.0 if len(y) == 0 else (3.0 if y[0] else -3.0))
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    least = max(2, len(y) // 500)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    found: dict[tuple, None] = {}
    for _ in range(trees):
        rows = rng.random(len(y)) < 0.6
        if not rows.any():
            continue
        p = 1 / (1 + np.exp(-margin))
        paths, _ = _tree(binned[rows], (y - p)[rows], (p * (1 - p))[rows], depth, least, bins + 1)
        found.update(dict.fromkeys(paths))
        # every row takes the mean step of its leaf among the drawn rows
        deepest = [q for q in paths if not any(len(o) > len(q) and o[:len(q)] == q for o in paths)]
        for path in deepest:
            met = _met(binned, path)
            use = met & rows
            margin[met] += 0.3 * (y - p)[use].sum() / ((p * (1 - p))[use].sum() + 1)
    # a cut at the top bin can't be crossed
    rules = [q for q in found if all(k < len(cuts[f]) for f, _, k in q)]
    if not rules:
        return RuleModel((), (), float(np.log(y.mean() / (1 - y.mean()))))
    r = np.stack([_met(binned, q) for q in rules], 1).astype(np.float64)
    distinct = np.unique(r, axis=1, return_index=True)[1]
    rules, r = [rules[i] for i in sorted(distinct)], r[:, sorted(distinct)]
    fold = np.arange(len(y)) % FOLDS == 0
    best = (np.inf, penalties[0])
    for penalty in penalties:
        w, b = _lasso(r[~fold], y[~fold], penalty)
        p = np.clip(1 / (1 + np.exp(-(r[fold] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[fold] * np.log(p) + (1 - y[fold]) * np.log(1 - p)) if fold.any() else 0.0
        best = min(best, (float(loss), penalty))
    w, b = _lasso(r, y, best[1])
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel(tuple(tuple((names[f], up, float(cuts[f][k])) for f, up, k in rules[i]) for i in keep),
                     tuple(float(w[i]) for i in keep), b)


def _met(binned: np.ndarray, path) -> np.ndarray:
    met = np.ones(len(binned), bool)
    for f, up, k in path:
        met &= (binned[:, f] > k) == up
    return met


def held_out(id: Column) -> Column:
    """Rows that no fit may see: crc32 of the id's text leaves 0 modulo ``FOLDS``; a null id is not one."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE) -> RuleModel:
    """Fit on at most ``sample`` labelled, not held-out documents, drawn by a hash of the id.

    Null ids and labels other than 0 and 1 are passed over; repeated labels and
    rows count as often as they come.
    """
    known = (labels.select(F.col(id).alias("doc"), F.col(label).cast("int").alias("y"))
             .where("doc is not null and y in (0, 1)").where(~held_out(F.col("doc")))
             .orderBy(F.xxhash64("doc"), "doc", "y").limit(sample))
    stats = statistics(F.col("text"))
    # ``known`` has at most ``sample`` rows of two numbers
    rows = (docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
            .join(F.broadcast(known), "doc")
            .select("doc", "y", *[c.alias(k) for k, c in stats.items()])
            .orderBy(F.xxhash64("doc"), "doc", "y", *stats).limit(sample).toPandas())
    return fit_rules(rows[list(stats)].to_numpy(np.float64), rows["y"].to_numpy(np.float64), list(stats))


def classify(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` behind its columns.

    Every row stays and is scored by its whole text; null and empty texts get
    the score of all-zero statistics. Equal texts get equal scores. Columns of
    these two names are replaced.
    """
    stats = statistics(F.col("text"))
    return (docs.select(F.struct("*").alias("all"), F.col(text).alias("text"))
            .select("all", *[c.alias(k) for k, c in stats.items()])
            .select("all", model.score().alias("score"))
            .select(*[F.col("all")[c].alias(c) for c in docs.columns if c not in ("score", "predicted")], "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")))
