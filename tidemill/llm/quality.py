"""A quality classifier of sparse rules.

Statistics of each text are computed where it is read. On at most ``SAMPLE_ROWS`` labelled rows
shallow trees are boosted; every path from a root to a node becomes a rule, a conjunction of
comparisons of statistics. A logistic regression with a lasso penalty, over rules and
the statistics themselves, keeps a few of them, and these are compiled into one Spark
column expression, so scoring needs no Python beyond the statistics.

Labels of held-out rows are never read.

Defined cases: a null text is empty, all its statistics are 0; without any training label of
one of the two kinds every score is the share of good labels (one half without labels);
repeated rows are scored each on its own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import fold, whole_text
from tidemill.sources.snapshots import freeze

SAMPLE_ROWS = 20_000  # labelled rows the rules are fitted on
TREES, DEPTH, BINS = 40, 3, 32
LEARNING_RATE = 0.3
LEAST_IN_LEAF = 20
LASSO = 4e-4
STEPS = 600
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
TEXTS_AT_ONCE = 256

STATISTICS = (
    "log_chars words_per_line word_length upper_share digit_share symbol_share bang_share bar_share "
    "punctuation_share other_share distinct_words distinct_lines top_word_share one_word_cells "
    "word_pair_repeats short_lines sentence_length mark_ended_words longest_word"
).split()

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#$%&*+<=>@\\^_`{}~[]/"
_PUNCTUATION = b".,;:?'\"()-"
_SENTENCE_END = re.compile(rb"[.!?]")


def statistics_of(text: str | None) -> list[float]:
    """One number per name in ``STATISTICS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, n = raw.split(), len(raw)
    if not words:
        return [0.0] * len(STATISTICS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    count = len(words)

    def share(of: bytes) -> float:
        return (n - len(raw.translate(None, of))) / n

    seen = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    cells = raw.count(b" | ") + 1
    lengths = [len(line.split()) for line in lines]
    return [
        math.log1p(n),
        count / len(lines),
        (n - count) / count,
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        raw.count(b"!") / n,
        raw.count(b"|") / count,
        share(_PUNCTUATION),
        (n - len(raw.decode("utf-8", "replace"))) / n,
        len(seen) / count,
        len(set(lines)) / len(lines),
        seen.most_common(1)[0][1] / count,
        cells / count,
        1.0 - len(pairs) / max(1, count - 1) if count > 1 else 0.0,
        sum(k < 4 for k in lengths) / len(lines),
        count / (len(_SENTENCE_END.findall(raw)) + 1),
        sum(w[-1] in _SYMBOLS or w[-1] == 33 for w in words) / count,
        float(max(map(len, words))),
    ]


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            table = np.array([statistics_of(t) for t in part.column(1).to_pylist()], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(table[:, i]) for i in range(len(STATISTICS)))],
                names=["doc_id", *STATISTICS],
            )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document."""
    columns = ", ".join(f"{name} double" for name in STATISTICS)
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.mapInArrow(_measuring, f"doc_id long, {columns}")


@dataclass(frozen=True)
class Rule:
    """All of (statistic, is above, value)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, (((x[:, i] > v) == above) for i, above, v in self.terms))

    def column(self) -> Column:
        tests = (F.col(STATISTICS[i]) > v if above else F.col(STATISTICS[i]) <= v for i, above, v in self.terms)
        return reduce(lambda a, b: a & b, tests)


def _simplified(terms: list[tuple[int, bool, float]]) -> Rule:
    """Of comparisons of the same kind only the strictest."""
    strictest: dict[tuple[int, bool], float] = {}
    for i, above, v in terms:
        known = strictest.get((i, above), v)
        strictest[(i, above)] = max(known, v) if above else min(known, v)
    return Rule(tuple(sorted((i, above, v) for (i, above), v in strictest.items())))


def _grow(binned, cuts, gradient, weight, rows, depth, terms, rules, out) -> None:
    """Splits ``rows`` by the best Newton gain and writes leaf values to ``out``."""
    if terms:
        rules.add(_simplified(terms))
    g, h = gradient[rows].sum(), weight[rows].sum()
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * LEAST_IN_LEAF:
        for i, edges in enumerate(cuts):
            if not len(edges):
                continue
            b = binned[rows, i]
            size = len(edges) + 1
            n = np.cumsum(np.bincount(b, minlength=size))[:-1]
            gl = np.cumsum(np.bincount(b, gradient[rows], size))[:-1]
            hl = np.cumsum(np.bincount(b, weight[rows], size))[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(n < LEAST_IN_LEAF) | (len(rows) - n < LEAST_IN_LEAF)] = -1
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), i, at)
    _, i, at = best
    if i < 0:
        out[rows] = g / (h + 1)
        return
    above = binned[rows, i] > at
    for side, side_rows in ((False, rows[~above]), (True, rows[above])):
        _grow(binned, cuts, gradient, weight, side_rows, depth - 1, [*terms, (i, side, float(cuts[i][at]))], rules, out)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> list[Rule]:
    """The paths of boosted trees."""
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    cuts = [c[c < x[:, i].max()] for i, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], 1)
    rules: set[Rule] = set()
    margin = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        leaf = np.zeros(len(y))
        _grow(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), DEPTH, [], rules, leaf)
        margin += LEARNING_RATE * leaf
    return sorted(rules, key=lambda r: r.terms)


def lasso_logistic(x: np.ndarray, y: np.ndarray, lasso: float = LASSO, steps: int = STEPS) -> np.ndarray:
    """Weights and, last, the intercept, by accelerated proximal gradient steps."""
    n, k = x.shape
    design = np.hstack([x, np.ones((n, 1))])
    v = np.ones(k + 1)
    for _ in range(20):  # the largest eigenvalue, for the step
        v = design.T @ (design @ v)
        top = np.linalg.norm(v)
        v /= top
    rate = 1 / (0.25 * top / n * 1.05)
    w = ahead = np.zeros(k + 1)
    momentum = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -40, 40)))
        step = ahead - rate * (design.T @ (p - y)) / n
        shrunk = np.sign(step) * np.maximum(0, np.abs(step) - rate * lasso)
        shrunk[k] = step[k]
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = shrunk + (momentum - 1) / after * (shrunk - w)
        w, momentum = shrunk, after
    return w


@dataclass(frozen=True)
class RuleEnsemble:
    rules: list[tuple[Rule, float]]
    linear: list[tuple[int, float, float, float]]  # statistic, low, high, weight of the clipped value
    intercept: float

    def margin(self) -> Column:
        terms = [F.when(rule.column(), w).otherwise(0.0) for rule, w in self.rules]
        for i, low, high, w in self.linear:
            clipped = F.least(F.lit(high), F.greatest(F.lit(low), F.col(STATISTICS[i])))
            terms.append((clipped - F.lit(low)) * F.lit(w / (high - low)))
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def score(self) -> Column:
        bounded = F.least(F.lit(40.0), F.greatest(F.lit(-40.0), self.margin()))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    rules = tree_rules(x, y)
    lows, highs = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    used = [i for i in range(x.shape[1]) if highs[i] > lows[i]]
    linear = [(np.clip(x[:, i], lows[i], highs[i]) - lows[i]) / (highs[i] - lows[i]) for i in used]
    design = np.stack([*(r.holds(x).astype(float) for r in rules), *linear], 1) if rules or linear else np.zeros((len(y), 0))
    w = lasso_logistic(design, y)
    kept = [(r, float(c)) for r, c in zip(rules, w, strict=False) if abs(c) > 1e-6]
    straight = [
        (i, float(lows[i]), float(highs[i]), float(c))
        for i, c in zip(used, w[len(rules) : -1], strict=True)
        if abs(c) > 1e-6
    ]
    return RuleEnsemble(kept, straight, float(w[-1]))


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Fits on at most ``sample_rows`` rows, the first in a hashed order of their ids."""
    train = labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).where("quality IN (0, 1)")
    sample = (
        train.select("doc_id", F.col("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample_rows)
    )
    texts = docs.select("doc_id", whole_text().alias("text"))
    sample = freeze(sample, "sample")
    chosen = texts.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = text_statistics(chosen).join(F.broadcast(sample), "doc_id").orderBy("doc_id").toArrow()
    y = np.array(rows.column("label").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return RuleEnsemble([], [], math.log(share / (1 - share)))
    x = np.stack([rows.column(name).to_numpy() for name in STATISTICS], 1)
    return fit_rules(x, y)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train_quality(docs, labels)
    return (
        text_statistics(docs)
        .select("doc_id", model.score().alias("score"))
        .select(
            "doc_id",
            (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )
