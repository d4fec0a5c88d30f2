"""Languages of texts by cross-parsing entropy.

Of each language a bounded reference text is kept. A document is parsed against the suffix
automaton of each reference: every phrase is the longest stretch that occurs somewhere in
the reference, the next one begins behind it. A phrase costs as many bits as a place
in the reference takes to name, so the phrases are normalised by the logarithm of the
reference's length, and the language that needs the fewest bits wins.

Texts are parsed as lower-case bytes; ASCII signs count as spaces and spaces in a row as
one. A document is parsed in blocks of ``BLOCK`` bytes side by side, each from the automaton's
root, which costs every language at most one phrase a block; all of every text is
parsed. The automata are laid out as tables of transitions in which a step that leads nowhere
goes on from the root and sets a flag, so that all blocks of a batch take a step at once.

References: per language the ``SAMPLE_ROWS`` labelled training texts with the smallest
hashes (equal texts once), from each an equal share of ``REFERENCE_BYTES``, beginning at a
word that its hash picks. With very many languages all references together stay within
``ALL_BYTES``. Workers build the automata from the references, which are all that travels.

Defined cases: a null or empty text or one without a letter is ``und`` with score 0, and
so is every text if there is nothing to learn from; languages that need equally many bits
tie, and the first by name wins; repeated rows are answered alike; null languages are not
learned from; a null id falls in the fold of the empty text; an empty table gives an
empty one; columns but doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import fold, worker_table

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS = 400
CANDIDATES = 50  # rows looked at for each row of the sample, copies included
REFERENCE_BYTES = 32_768
ALL_BYTES = 1 << 20
BLOCK = 256
BYTES_AT_ONCE = 1 << 21
UNKNOWN = "und"
_RATE_STEPS = 1 << 30
_FLAG = 1 << 30
_SPACES = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))
FOUND = "doc_id long, held_out boolean, lang_pred string, score double"


def plain_bytes(text: str) -> bytes:
    """The lower-case text with one space for each run of ASCII signs and spaces."""
    return b" ".join(text.lower().encode().translate(_SPACES).split())


def suffix_automaton(reference: bytes) -> list[dict[int, int]]:
    """Transitions of each state; state 0 is the root, every path a stretch of the text."""
    follow: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for byte in reference:
        new, at = len(follow), last
        follow.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        while at >= 0 and byte not in follow[at]:
            follow[at][byte] = new
            at = link[at]
        if at >= 0:
            to = follow[at][byte]
            if longest[to] == longest[at] + 1:
                link[new] = to
            else:  # the short stretches that end there get a state of their own
                apart = len(follow)
                follow.append(dict(follow[to]))
                longest.append(longest[at] + 1)
                link.append(link[to])
                while at >= 0 and follow[at].get(byte) == to:
                    follow[at][byte] = apart
                    at = link[at]
                link[to] = link[new] = apart
        last = new
    return follow


class CrossParser:
    """Counts the phrases of blocks of bytes against one reference."""

    def __init__(self, reference: bytes) -> None:
        states = suffix_automaton(reference)
        used = sorted(set(reference))
        width = len(used) + 2  # the reference's bytes, any other byte, nothing
        other, nothing = len(used), len(used) + 1
        self._kinds = np.full(257, other, np.uint16)
        self._kinds[used] = np.arange(len(used))
        self._kinds[256] = nothing
        lost = len(states)  # the state behind a byte that the reference lacks
        kind = self._kinds.tolist()
        restart = np.full(width, lost * width, np.int32)
        for byte, to in states[0].items():
            restart[kind[byte]] = to * width
        table = np.tile(restart | _FLAG, (lost + 1, 1))
        table[0] = restart
        table[:, nothing] = np.arange(lost + 1) * width
        rows = [s for s, follow in enumerate(states) for _ in follow]
        steps = [kind[b] for follow in states for b in follow]
        table[rows, steps] = [to * width for follow in states for to in follow.values()]
        self._table = table.ravel()
        self.bits = math.log2(max(2, len(reference)))  # of a phrase

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """``blocks`` has a column a block, 256 behind its end."""
        steps = self._kinds[blocks]
        at = np.zeros(blocks.shape[1], np.int32)
        count = (blocks[0] < 256).astype(np.int64)
        where, found = np.empty(len(at), np.intp), np.empty(len(at), np.int32)
        for step in steps:
            np.add(at, step, out=where, casting="unsafe")
            np.take(self._table, where, out=found, mode="clip")
            count += found >> 30
            np.bitwise_and(found, _FLAG - 1, out=at)
        return count


def parse(texts: list[bytes], parsers: list[CrossParser]) -> np.ndarray:
    """Phrases of each text (rows) by each parser (columns)."""
    counts = np.zeros((len(texts), len(parsers)), np.int64)
    blocks = [-(-len(t) // BLOCK) for t in texts]
    if not any(blocks):
        return counts
    joined = b"".join(t.ljust(n * BLOCK, b"\0") for t, n in zip(texts, blocks, strict=True))
    grid = np.frombuffer(joined, np.uint8).reshape(-1, BLOCK).astype(np.uint16)
    grid[grid == 0] = 256  # no text has zero bytes any more: they are signs
    steps = np.ascontiguousarray(grid.T)
    some = [i for i, n in enumerate(blocks) if n]
    starts = np.concatenate(([0], np.cumsum([blocks[i] for i in some])[:-1]))
    for k, parser in enumerate(parsers):
        counts[some, k] = np.add.reduceat(parser.phrases(steps), starts)
    return counts


def _reference_of(size: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("drawn", "ascending"), ("text", "ascending")])
        texts = [plain_bytes(t) for t in rows.column("text").to_pylist()]
        share, parts = max(1, size // max(1, len(texts))), []
        for text in texts:
            start = zlib.crc32(text) % (len(text) - share) if len(text) > share else 0
            start = text.find(b" ", start) + 1 if start else 0
            parts.append(text[start : start + share])
        whole = b" ".join(parts)[:size]
        return pa.table({"lang": pa.array([key[0].as_py()]), "reference": pa.array([whole], pa.binary())})

    return run


def learn_references(
    docs: DataFrame,
    *,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    sample_rows: int = SAMPLE_ROWS,
    reference_bytes: int = REFERENCE_BYTES,
    all_bytes: int = ALL_BYTES,
) -> DataFrame:
    """lang, reference: a row for each language of the training fold's documents."""
    learned = docs.where(
        F.col("lang").isNotNull()
        & (fold(F.col("doc_id"), folds) != held_out)
        & F.col("text").rlike("\\p{L}")
    )
    known = learned.groupBy("lang").count().collect()  # a row for each language
    if not known:
        return docs.sparkSession.createDataFrame([], "lang string, reference binary")
    size = max(1, min(reference_bytes, all_bytes // len(known)))
    draw = F.pmod(F.xxhash64("text"), F.lit(_RATE_STEPS))
    rates = {r["lang"]: min(_RATE_STEPS, _RATE_STEPS * CANDIDATES * sample_rows // r["count"]) for r in known}
    limit = F.create_map(*(F.lit(x) for pair in rates.items() for x in pair))[F.col("lang")]
    first = Window.partitionBy("lang").orderBy("drawn", "text")
    sample = (
        learned.where(draw < limit)
        .groupBy("lang", F.xxhash64("text").alias("drawn"))
        .agg(F.min("text").alias("text"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= sample_rows)
        .select("lang", "text", "drawn")
    )
    return sample.groupBy("lang").applyInArrow(_reference_of(size), "lang string, reference binary")


def _identify(references: list[tuple[str, bytes]]):
    langs = [lang for lang, _ in references]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("cross parsers", tuple(langs), zlib.crc32(b"".join(r for _, r in references)))
        parsers = worker_table(key, lambda: [CrossParser(r) for _, r in references])
        bits = np.array([p.bits for p in parsers])
        for whole in batches:
            texts = whole.column("text").to_pylist()
            best = np.zeros(len(texts), np.int64)
            score = np.zeros(len(texts))
            at = 0
            while at < len(texts):
                some, held = [], 0
                while at + len(some) < len(texts) and (not some or held < BYTES_AT_ONCE):
                    some.append(plain_bytes(texts[at + len(some)] or ""))
                    held += len(some[-1])
                cost = parse(some, parsers) * bits
                least = cost.min(axis=1, keepdims=True)
                best[at : at + len(some)] = cost.argmin(axis=1)
                score[at : at + len(some)] = 1 / np.exp2(np.maximum(least - cost, -1000)).sum(axis=1)
                at += len(some)
            named = pa.array(langs).take(pa.array(best))
            lettered = whole.column("lettered")
            columns = [
                whole.column("doc_id"),
                whole.column("held_out"),
                pc.if_else(lettered, named, UNKNOWN),
                pc.if_else(lettered, pa.array(score), 0.0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return run


def identify_language(
    docs: DataFrame,
    references: DataFrame | None = None,
    *,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    ``score`` is the share of the winner if each language weighs 2 to the power of minus
    its bits. References are learned from the documents' own training fold if none
    are given; they reach the driver, at most ``ALL_BYTES`` of them.
    """
    if references is None:
        references = learn_references(docs, folds=folds, held_out=held_out)
    rows = references.select("lang", "reference").orderBy("lang").collect()
    known = [(r["lang"], bytes(r["reference"])) for r in rows]
    held = (fold(F.col("doc_id"), folds) == held_out).alias("held_out")
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    asked = docs.select(F.col("doc_id").cast("long"), held, lettered.alias("lettered"), "text")
    if not known:
        return asked.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return asked.mapInArrow(_identify(known), FOUND)
