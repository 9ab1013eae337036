"""Quality classifier: a sparse ensemble of rules (operator 3).

Boosted shallow trees over text statistics give conjunctive rules (every path
from a root), the lasso on the logistic loss gives their weights, and rules
with a weight compile to one Spark column expression over the statistics. The
statistics are built-in functions on whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import trees
from tallyforge.llm.storage import stored

# Characters that are counted.
SYMBOLS = "!#$%&*+<=>@\\^_`{|}~[]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
DIGITS = "0123456789"
STOPS = ".,;:?"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; null counts as empty. Shares are of characters or of words."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")

    def share(characters: str) -> Column:
        return (F.length(t) - F.length(F.translate(t, characters, ""))) / n

    return {
        "log_chars": F.log1p(F.length(t)),
        "symbol_share": share(SYMBOLS),
        "upper_share": share(UPPER),
        "digit_share": share(DIGITS),
        "stop_share": share(STOPS),
        "word_length": F.length(t) / F.greatest(F.size(words), F.lit(1)),
        "repeated_words": 1 - F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)),
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
    }


FEATURES = ["log_chars", "symbol_share", "upper_share", "digit_share", "stop_share", "word_length", "repeated_words", "repeated_lines"]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_at_most, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, at_most, c in self.terms:
            out &= (x[:, k] <= c) == at_most
        return out

    def sql(self, names: list[str]) -> str:
        return " AND ".join(f"{names[k]} {'<=' if at_most else '>'} {c!r}D" for k, at_most, c in self.terms)


def paths(tree, so_far: tuple = ()) -> list[Rule]:
    """The rule of each node below the root."""
    if not isinstance(tree, trees.Split):
        return []
    out = []
    for at_most, side in ((True, tree.left), (False, tree.right)):
        terms = (*so_far, (tree.feature, at_most, tree.threshold))
        out += [Rule(_simplified(terms)), *paths(side, terms)]
    return out


def _simplified(terms: tuple) -> tuple:
    """Of several bounds of one feature on one side, the tightest."""
    best: dict[tuple[int, bool], float] = {}
    for k, at_most, c in terms:
        old = best.get((k, at_most))
        best[(k, at_most)] = c if old is None else min(old, c) if at_most else max(old, c)
    return tuple(sorted((k, a, c) for (k, a), c in best.items()))


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + sum((w * r.holds(x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))

    def column(self, names: list[str] = FEATURES) -> Column:
        terms = [f"CASE WHEN {r.sql(names)} THEN {w!r}D ELSE 0D END" for r, w in zip(self.rules, self.weights, strict=True)]
        z = " + ".join([f"{self.bias!r}D", *terms])
        return F.expr(f"1D / (1D + exp(-({z})))")


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and unpenalised bias by accelerated proximal gradient descent."""
    n, k = r.shape
    scale = 0.25 * (np.linalg.norm(np.column_stack([r, np.ones(n)]), 2) ** 2) / n
    w = v = np.zeros(k + 1)
    t = 1.0
    full = np.column_stack([r, np.ones(n)])
    for _ in range(steps):
        g = full.T @ (1 / (1 + np.exp(-(full @ v))) - y) / n
        new = v - g / scale
        new[:k] = np.sign(new[:k]) * np.maximum(np.abs(new[:k]) - penalty / scale, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:k], float(w[k])


def fit(x: np.ndarray, y: np.ndarray, *, n_trees: int = 24, depth: int = 3, rate: float = 0.3, penalty: float = 0.0005) -> RuleEnsemble:
    """Fit on arrays. Without rows the score is 0.5, with one class its smoothed share."""
    base = (y.sum() + 1) / (len(y) + 2)
    bias = float(math.log(base / (1 - base)))
    if len(y) == 0 or y.min() == y.max():
        return RuleEnsemble((), (), bias)
    cuts, z, found = trees.cut_points(x), np.full(len(y), bias), {}
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-z))
        h = np.maximum(p * (1 - p), 1e-4)
        tree = trees.grow(x, (y - p) / h, h, cuts, depth, least=max(2, min(20, len(y) // 50)))
        z = z + rate * np.clip(trees.values(tree, x), -4, 4)
        found |= dict.fromkeys(paths(tree))
    rules = list(found)
    if not rules:
        return RuleEnsemble((), (), bias)
    r = np.column_stack([rule.holds(x) for rule in rules]).astype(float)
    weights, bias = lasso_logistic(r, y.astype(float), penalty)
    kept = [(rule, float(w)) for rule, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    return RuleEnsemble(tuple(rule for rule, _ in kept), tuple(w for _, w in kept), bias)


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, the statistics.

    Learns from at most ``train_rows`` labelled rows that are not held out
    (those whose id hashes lowest); labels other than 0 and 1, null labels and
    rows without a label are not learned from. Null and empty texts are scored
    like any other. Repeated rows give a row each. Other columns are not read.
    """
    stats = statistics(F.col(text_col))
    table = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), *(stats[k].cast("double").alias(k) for k in FEATURES)), "quality-statistics")
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows)
    rows = table.join(sample, "doc_id").select(*FEATURES, "label").orderBy(*FEATURES, "label").limit(train_rows).collect()
    data = np.array([tuple(r) for r in rows], float).reshape(-1, len(FEATURES) + 1)
    model = fit(data[:, :-1], data[:, -1].astype(int))
    return table.withColumn("score", model.column()).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *FEATURES)
