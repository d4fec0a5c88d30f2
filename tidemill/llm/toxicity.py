"""A toxicity classifier that is held to counterfactual fairness.

Features are the distinct words of a text and the beginnings of its words. How often
each occurs among toxic and other documents is counted over all labelled training rows;
the features that tell most are kept, at most ``VOCABULARY`` of them. A logistic
regression is fitted on at most ``SAMPLE_ROWS`` labelled rows. In every sentence of these that
names a group of people, the name is swapped for others, and the squared change of the
sentence's score is part of the loss: what is said decides, not about whom.

A corpus may name no group at all, and its classifier would then never be asked. So each
of these rows also counts a second time with a group's name put in the place of one word of one of
its sentences, under the same label, and that name is swapped as well. Names are
a parameter, by default in four languages; place and name are picked by a hash of the text.

Scores are computed where the text is read. Labels of held-out rows are never read.

Defined cases: a null text is empty and scored by the intercept; without any training label
of one of the two kinds every score is the share of toxic labels (one half without
labels); repeated rows are scored each on its own; of contradictory labels of an id each counts;
an empty table has no rows; a very long text is read whole, as any other; rows reach the fit
in an order of their own, so scores do not depend on partitions.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import fold, whole_text, worker_table
from tidemill.sources.snapshots import freeze

VOCABULARY = 4096
LEAST_DOCUMENTS = 5  # that a feature is in
LEAST_CHI_SQUARE = 15.0  # between a feature and the label
SAMPLE_ROWS = 12_000  # labelled rows the weights are fitted on
RIDGE = 1e-6
FAIRNESS = 1.0  # weight of the squared score changes under swaps
SWAPS = 3  # other groups a sentence is tried with
STEPS = 800
PREFIX = 4
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
TEXTS_AT_ONCE = 256

# fixed values: neutral names of groups of people, in English, German, Spanish and French
IDENTITY_TERMS = (
    "women men girls boys muslims christians jews hindus buddhists atheists gays lesbians "
    "transgender straight black white asian african american european mexican chinese "
    "immigrants refugees disabled deaf blind elderly young poor rich "
    "frauen männer juden christen muslime afrikaner asiaten ausländer flüchtlinge behinderte "
    "mujeres hombres judíos cristianos musulmanes africanos asiáticos inmigrantes refugiados ancianos "
    "femmes hommes juifs chrétiens musulmans africains asiatiques immigrés réfugiés handicapés"
).split()

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features_of(text: str | None) -> set[str]:
    """Distinct words, and a caret with the beginnings of those that are longer."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}


def _swaps(words: list[str], term: str, terms: Sequence[str]) -> list[tuple[set[str], set[str]]]:
    """What the words lose and win when ``term`` makes room for others."""
    at, before, pairs = terms.index(term), features_of(" ".join(words)), []
    stride = 7 if len(terms) % 7 else 1
    for step in range(1, min(SWAPS, len(terms) - 1) + 1):
        other = terms[(at + step * stride) % len(terms)]
        after = features_of(" ".join(other if w == term else w for w in words))
        pairs.append((before - after, after - before))
    return pairs


def counterfactual_pairs(
    text: str | None, terms: Sequence[str] = IDENTITY_TERMS
) -> list[tuple[set[str], set[str]]]:
    """Features lost and won when a group named in a sentence is swapped for another."""
    pairs = []
    for sentence in _SENTENCE.findall((text or "").lower()):
        words = _WORD.findall(sentence)
        for term in sorted(set(words).intersection(terms)):
            pairs += _swaps(words, term, terms)
    return pairs


def mention(text: str | None, terms: Sequence[str] = IDENTITY_TERMS) -> tuple[str, list] | None:
    """The text with a group's name in one place of one sentence, and the swaps of that name.

    None if the text has no word or there is no name.
    """
    sentences = [m for m in _SENTENCE.finditer((text or "").lower()) if _WORD.search(m[0])]
    if not sentences or not terms:
        return None
    draw = zlib.crc32(text.encode())
    sentence = sentences[draw % len(sentences)]
    words = _WORD.findall(sentence[0])
    term = terms[draw // 7 % len(terms)]
    words[draw // 11 % len(words)] = term
    lower = text.lower()
    changed = lower[: sentence.start()] + " ".join(words) + lower[sentence.end() :]
    return changed, _swaps(words, term, terms)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        lists = [sorted(features_of(t)) for t in part.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.list_(pa.string())), part.column(1)], names=["features", "label"]
        )


def training_labels(labels: DataFrame) -> DataFrame:
    train = labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).where("toxic IN (0, 1)")
    return train.select("doc_id", F.col("toxic").cast("int").alias("label"))


def telling_features(texts: DataFrame, train: DataFrame, size: int = VOCABULARY) -> list[str]:
    """The features with the largest chi-square between them and the label."""
    # always by a shuffle: the labels are not bounded
    labelled = texts.join(train.hint("merge"), "doc_id").select("text", "label")
    totals = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = float(totals["n"]), float(totals["toxic"] or 0)
    if not 0 < toxic < n:
        return []
    counts = (
        labelled.mapInArrow(_featured, "features array<string>, label int")
        .select(F.explode("features").alias("feature"), "label")
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
    )
    expected = F.col("n") * (toxic / n)
    chi = F.pow(F.col("toxic") - expected, F.lit(2)) / expected
    telling = counts.where(chi >= LEAST_CHI_SQUARE)
    best = telling.orderBy(chi.desc(), "feature").limit(size).select("feature")
    return [r["feature"] for r in best.collect()]


def _signed(pairs: list[tuple[set[str], set[str]]], index: dict[str, int]) -> list[list[int]]:
    """Numbers of the features won, and minus one minus those of the lost."""
    signed = [
        [*(-1 - index[f] for f in sorted(lost) if f in index), *(index[f] for f in sorted(won) if f in index)]
        for lost, won in pairs
    ]
    return [p for p in signed if p]


def _sampling(index: dict[str, int], terms: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            rows = []
            for text, label in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = sorted(index[f] for f in features_of(text) if f in index)
                rows.append((found, label, _signed(counterfactual_pairs(text, terms), index)))
                made = mention(text, terms)
                if made is not None:
                    found = sorted(index[f] for f in features_of(made[0]) if f in index)
                    rows.append((found, label, _signed(made[1], index)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.list_(pa.list_(pa.int32()))),
                ],
                names=["found", "label", "pairs"],
            )

    return run


class _Sparse:
    """Rows of signed ones; just the two products that fitting needs."""

    def __init__(self, rows: list[list[int]], width: int) -> None:
        flat = np.array([i for row in rows for i in row], np.int64)
        self.sign = np.where(flat < 0, -1.0, 1.0)
        self.column = np.where(flat < 0, -1 - flat, flat)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.shape = (len(rows), width)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column] * self.sign, self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row] * self.sign, self.shape[1])


def fit(
    rows: list[list[int]], labels: np.ndarray, pairs: list[list[int]], width: int, fairness: float = FAIRNESS
) -> np.ndarray:
    """Weights and, last, the intercept, by accelerated gradient steps.

    Each feature is scaled by how rare it is, so that rare ones move as fast.
    """
    x, d = _Sparse([[*r, width] for r in rows], width + 1), _Sparse(pairs, width + 1)
    seen = np.bincount(x.column, minlength=width + 1) + np.bincount(d.column, minlength=width + 1)
    scale = 1 / np.sqrt((seen + 1) / len(rows))
    ridge = np.full(width + 1, RIDGE)
    ridge[width] = 0.0

    def loss(v: np.ndarray) -> float:
        w = scale * v
        z = x.dot(w)
        swapped = d.dot(w) if pairs else np.zeros(1)
        fitted = np.logaddexp(0, np.where(labels == 1, -z, z)).mean()
        return float(fitted + (ridge * w * w).sum() / 2 + fairness * (swapped**2).mean())

    v = ahead = np.zeros(width + 1)
    momentum, least, rate = 1.0, loss(v), 4.0
    for _ in range(STEPS):
        w = scale * ahead
        z = x.dot(w)
        slope = x.back((1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / len(rows)) + ridge * w
        if pairs:
            slope += 2 * fairness * d.back(d.dot(w)) / len(pairs)
        step = ahead - rate * scale * slope
        now = loss(step)
        if now > least:
            if ahead is v:
                rate /= 2
            momentum, ahead = 1.0, v
            continue
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = step + (momentum - 1) / after * (step - v)
        v, momentum, least = step, after, now
    return scale * v


def sampled_rows(
    docs: DataFrame,
    train: DataFrame,
    index: dict[str, int],
    *,
    sample_rows: int = SAMPLE_ROWS,
    terms: Sequence[str] = IDENTITY_TERMS,
) -> list[tuple[list[int], int, list[list[int]]]]:
    """Features, label and swaps of what is fitted on, in an order of their own."""
    sample = train.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)  # bounded
    sampled = (
        docs.select("doc_id", whole_text().alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select("text", "label")
        .mapInArrow(_sampling(index, terms), "found array<int>, label int, pairs array<array<int>>")
        .toArrow()
    )
    return sorted(zip(*(sampled.column(i).to_pylist() for i in range(3)), strict=True))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    *,
    terms: Sequence[str] = IDENTITY_TERMS,
    fairness: float = FAIRNESS,
    vocabulary: int = VOCABULARY,
) -> tuple[dict[str, float], float]:
    """Weights by feature, and the intercept. ``sample_rows`` bounds what is fitted on,
    ``vocabulary`` the features; ``terms`` are the names of groups that get swapped."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    train = freeze(training_labels(labels), "labelled")
    telling = telling_features(texts, train, vocabulary)
    if not telling:
        share = train.agg(F.avg("label")).first()[0]
        share = min(max(0.5 if share is None else share, 1e-6), 1 - 1e-6)
        return {}, math.log(share / (1 - share))
    named = {f for t in terms for f in features_of(t)}
    index = {f: i for i, f in enumerate(telling + sorted(named.difference(telling)))}
    rows = sampled_rows(docs, train, index, sample_rows=sample_rows, terms=terms)
    if not rows:
        return {}, 0.0
    pairs = [p for _, _, ps in rows for p in ps]
    w = fit([r[0] for r in rows], np.array([r[1] for r in rows], float), pairs, len(index), fairness)
    return {f: float(w[i]) for f, i in index.items()}, float(w[-1])


def _scoring(weights: dict[str, float], intercept: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table("weights", dict)  # so that what other tasks remember goes
        known = weights.keys()
        for part in _slices(batches):
            scores = []
            for text in part.column(1).to_pylist():
                # summed in the order of the features, so that equal texts score the same
                z = intercept + math.fsum(weights[f] for f in features_of(text) & known)
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; ``how`` goes to the training."""
    weights, intercept = train_toxicity(docs, labels, **how)
    texts = docs.select("doc_id", whole_text().alias("text"))
    run = _scoring(weights, intercept)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.select(["doc_id", "score"])

    return texts.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    weights, intercept = train_toxicity(docs, labels, **how)
    score = _scoring(weights, intercept)
    text = docs.columns.index("text")

    def mild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            pair = pa.RecordBatch.from_arrays([batch.column(text)] * 2, names=["id", "text"])
            for part in score(iter([pair])):
                kept = pc.less(part.column(2), THRESHOLD)
                yield batch.slice(at, part.num_rows).filter(kept)
                at += part.num_rows

    return docs.mapInArrow(mild, docs.schema)
