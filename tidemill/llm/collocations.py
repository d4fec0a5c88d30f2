"""Collocations from suffix subtrees that are built group by group.

Every word occurrence begins a suffix: the words from there to the end of its piece, at
most ``max_words`` of them. All suffixes together form a tree; the number of leaves below
a node is how often the node's phrase occurs. The tree is never built whole:

* *Vertical partitioning.* Suffixes are counted by buckets of their language and first word.
  Buckets are packed into groups that fit a memory budget; a bucket over the budget is
  divided further by the second word. What the driver sees is one count a bucket.
* *Subtrees.* Each task cuts its texts into suffixes, adds up equal ones and sends one block
  of leaves to each group: the distinct suffixes with their counts, words as numbers
  of the block's own word list. A group sorts its leaves; runs of equal beginnings are
  the nodes, and their totals are read off the sorted leaves.
* Phrases that are frequent enough become rows, and meet their parts by joins.

So a word or passage that stands everywhere costs one leaf a block, however often it occurs.

Defined cases: a null or empty text has no words; a null language counts as ``und``;
repeated rows count each time; ties go by the phrase's bytes; a language without candidates
has no rows, nor has an empty table; a very long text is cut into suffixes like any
other; columns but text and lang are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import whole_text
from tidemill.session import new_folder, shuffle_partitions
from tidemill.sources.snapshots import drop_frozen, freeze

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
COVERED_PERCENT = 50
SCALE = 1_000_000
GROUP_SUFFIXES = 1 << 20  # the memory budget of a subtree
BUCKETS = 1 << 16
FLUSH_SUFFIXES = 1 << 21  # of a task, before it sends its leaves
FLUSH_WORDS = 1 << 19
BYTES_AT_ONCE = 1 << 20
NO_LANG = "und"
_END = 0  # number of the end of a piece, and of no word at all
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CLEAN = _LOWER.translate(bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" "))
BLOCKS = "group int, lang string, words binary, leaves binary"
NODES = "lang string, phrase string, words int, f long"


class _Words(dict):
    """Numbers words as they come; 0 is the end of a piece, 1 the gap between two spaces."""

    def __init__(self) -> None:
        super().__init__({b"\n": _END, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(texts: list[bytes], words: _Words) -> np.ndarray:
    """The words of all texts by number, each piece ended by ``_END``."""
    joined = b"\n".join([*texts, b""]).translate(_CLEAN).replace(b"\n", b" \n ")
    found = np.fromiter(map(words.__getitem__, joined.split(b" ")), np.int64)
    return found[found != 1]


def _suffixes(numbers: np.ndarray, depth: int) -> np.ndarray:
    """A column for each word: it and those behind it in its piece, then ``_END``."""
    n = len(numbers)
    padded = np.concatenate((numbers, np.zeros(depth, np.int64)))
    table = np.empty((depth, n), np.int64)
    for k in range(depth):
        table[k] = padded[k : k + n]
        if k:
            table[k] *= table[k - 1] != _END
    return table[:, table[0] != _END]


def leaf_totals(suffixes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, a column each, and how often each occurs."""
    depth, n = suffixes.shape
    if not n:
        return suffixes, np.zeros(0, np.int64)
    bits, rank = max(1, int(suffixes.max()).bit_length()), suffixes[0]
    together = bits * depth < 64
    for k in range(1, depth):
        if not together and k > 1:  # keep the rank of the words so far within 32 bits
            rank = np.unique(rank, return_inverse=True)[1]
        rank = (rank << (bits if together else 32)) | suffixes[k]
    order = None if together and counts is None else np.argsort(rank)
    rank = np.sort(rank) if order is None else rank[order]
    first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
    totals = np.diff(first, append=n) if counts is None else np.add.reduceat(counts[order], first)
    if order is not None:
        return suffixes[:, order[first]], totals
    rank = rank[first]
    words = [(rank >> (bits * k)) & ((1 << bits) - 1) for k in range(depth - 1, -1, -1)]
    return np.stack(words), totals


def subtree_nodes(leaves: np.ndarray, totals: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each depth the nodes' words and totals, read from sorted distinct leaves."""
    new = np.zeros(len(totals), bool)
    new[:1] = True
    for depth, words in enumerate(leaves, 1):
        new[1:] |= words[1:] != words[:-1]
        first = np.flatnonzero(new)
        sums = np.add.reduceat(totals, first) if len(first) else totals
        whole = words[first] != _END
        yield depth, leaves[:depth, first[whole]], sums[whole]


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((zlib.crc32(w, seed) for w in words), np.int64, len(words))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, a bounded number of bytes at a time."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] >= BYTES_AT_ONCE:
                yield lang, held.pop(lang)
                del sizes[lang]
    yield from held.items()


def _count_buckets(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        held: dict[str, tuple[_Words, np.ndarray]] = {}

        def add(lang: str, words: _Words, counts: np.ndarray) -> None:
            into = sums.setdefault(lang, np.zeros(buckets, np.int64))
            np.add.at(into, _hashes(lang, list(words)) % buckets, counts[: len(words)])

        for lang, texts in _chunks(batches):
            words, counts = held.pop(lang, None) or (_Words(), np.zeros(FLUSH_WORDS, np.int64))
            numbers = _numbered(texts, words)
            numbers = numbers[numbers != _END]
            if len(words) > len(counts):
                counts = np.concatenate((counts, np.zeros(len(words), np.int64)))
            counts += np.bincount(numbers, minlength=len(counts))
            if len(words) >= FLUSH_WORDS:
                add(lang, words, counts)
            else:
                held[lang] = words, counts
        for lang, (words, counts) in held.items():
            add(lang, words, counts)
        for lang, found in sums.items():
            some = np.flatnonzero(found)
            columns = [pa.array([lang] * len(some)), pa.array(some), pa.array(found[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    return run


class Partitioning:
    """Which group a suffix belongs to, by the hashes of its first two words."""

    def __init__(self, sizes: np.ndarray, budget: int) -> None:
        self.parts = np.maximum(1, -(-sizes // budget))
        self.start = np.zeros(len(sizes), np.int64)
        group, room = -1, 0
        for bucket, (size, parts) in enumerate(zip(sizes.tolist(), self.parts.tolist(), strict=True)):
            if parts > 1:  # divided by the second word, in groups of its own
                self.start[bucket] = group + 1
                group, room = group + parts, 0
                continue
            if size > room or group < 0:
                group, room = group + 1, budget
            self.start[bucket] = group
            room -= size
        self.groups = group + 1

    def group_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        bucket = first % len(self.start)
        return self.start[bucket] + second % self.parts[bucket]


def _send_leaves(partitioning: Partitioning, depth: int):
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary()]

    def blocks(lang: str, words: _Words, numbers: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        leaves, totals = leaf_totals(_suffixes(np.concatenate(numbers), depth))
        if not len(totals):
            return
        listed = list(words)
        hashes = _hashes(lang, listed)
        group = partitioning.group_of(hashes[leaves[0]], hashes[leaves[min(1, depth - 1)]])
        order = np.argsort(group, kind="stable")
        leaves, totals, group = leaves[:, order], totals[order], group[order]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        number = np.zeros(len(listed), np.int64)
        for a, b in zip(starts, np.append(starts[1:], len(group)), strict=True):
            used = np.zeros(len(listed), bool)
            used[leaves[:, a:b]] = True
            used[_END] = False
            own = np.flatnonzero(used)
            number[own] = np.arange(1, len(own) + 1)
            table = np.concatenate((number[leaves[:, a:b]].ravel(), totals[a:b])).astype("<u4")
            text = b"\n".join([listed[i] for i in own.tolist()])
            row = [[int(group[a])], [lang], [text], [table.tobytes()]]
            arrays = [pa.array(c, kind) for c, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Words, list[np.ndarray]]] = {}
        waiting = 0
        for lang, texts in _chunks(batches):
            words, numbers = held.setdefault(lang, (_Words(), []))
            numbers.append(_numbered(texts, words))
            waiting += len(numbers[-1])
            if waiting >= FLUSH_SUFFIXES or len(words) >= FLUSH_WORDS:
                for kept, (its, found) in held.items():
                    yield from blocks(kept, its, found)
                held, waiting = {}, 0
        for kept, (its, found) in held.items():
            yield from blocks(kept, its, found)

    return run


def _subtrees(depth: int, least: int):
    def run(group: pa.Table) -> pa.Table:
        by_lang: dict[str, tuple[_Words, list[np.ndarray], list[np.ndarray]]] = {}
        for lang, text, leaves in zip(
            *(group.column(c).to_pylist() for c in ("lang", "words", "leaves")), strict=True
        ):
            words, found, counts = by_lang.setdefault(lang, (_Words(), [], []))
            listed = np.fromiter(map(words.__getitem__, text.split(b"\n")), np.int64)
            listed = np.concatenate(([_END], listed))
            table = np.frombuffer(leaves, "<u4").reshape(depth + 1, -1)
            found.append(listed[table[:depth]])
            counts.append(table[depth].astype(np.int64))
        columns: list[list] = [[], [], [], []]
        for lang, (words, found, counts) in by_lang.items():
            listed = list(words)
            leaves, totals = leaf_totals(np.concatenate(found, axis=1), np.concatenate(counts))
            for k, nodes, sums in subtree_nodes(leaves, totals):
                # only single words may have other leaves in other groups
                often = np.ones(len(sums), bool) if k == 1 else sums >= least
                phrases = [
                    b" ".join([listed[i] for i in node]).decode() for node in nodes[:, often].T.tolist()
                ]
                columns[0] += [lang] * len(phrases)
                columns[1] += phrases
                columns[2] += [k] * len(phrases)
                columns[3] += sums[often].tolist()
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        names = [c.split()[0] for c in NODES.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in decimals of 38 digits."""
    whole = a.cast("decimal(15,0)")
    product = left.cast("decimal(18,0)") * right.cast("decimal(18,0)")
    return F.call_function("div", whole * whole * F.lit(SCALE).cast("decimal(7,0)"), product).cast("long")


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _first_places(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language. A language with very many rows is thinned
    out in many tasks, then in fewer, before one of them numbers what is left."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    tasks = shuffle_partitions(rows.sparkSession)
    for salts in (tasks, math.isqrt(tasks), 1):
        salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        near = Window.partitionBy("lang", "salt").orderBy(*order)
        placed = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(near).cast("long"))
        rows = placed.where(F.col("rank") <= top)
    return rows


def mine_collocations(
    docs: DataFrame,
    *,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    group_suffixes: int = GROUP_SUFFIXES,
    buckets: int = BUCKETS,
    path: str | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut,
    ``n`` all words of the language. A phrase inside a longer candidate that has at
    least ``covered_percent`` of its count is left out. The nodes of all subtrees are written to
    ``path`` if the caller wants to read or drop them later.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang")
    rows = docs.select(lang, whole_text().alias("text")).where(F.col("text") != "")
    weighed_at = new_folder(spark, "prefixes")
    weights = freeze(
        rows.mapInArrow(_count_buckets(buckets), "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n")),
        "prefixes",
        weighed_at,
    )
    sizes = np.zeros(buckets, np.int64)
    for bucket, n in weights.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets``
        sizes[bucket] = n
    totals = spark.createDataFrame(
        weights.groupBy("lang").agg(F.sum("n").alias("n")).collect(), "lang string, n long"
    )  # a row for each language
    drop_frozen(spark, weighed_at)
    partitioning = Partitioning(sizes, group_suffixes)
    blocks = rows.mapInArrow(_send_leaves(partitioning, max_words), BLOCKS)
    tasks = max(1, min(partitioning.groups, 4 * shuffle_partitions(spark)))
    counted = (
        blocks.repartition(tasks, "group")
        .groupBy("group")
        .applyInArrow(_subtrees(max_words, min_count), NODES)
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("f").alias("f"))
        .where(F.col("f") >= min_count)
    )
    nodes = freeze(counted, "nodes", path)

    candidates = nodes.where(F.col("words") >= 2).select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w")
    )
    cuts = candidates.select(
        "lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "words", "a", "k",
        _part(F.col("w"), F.lit(1), F.col("k")).alias("head"),
        _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    of_head = nodes.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    of_tail = nodes.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(of_head, ["lang", "head"]).join(of_tail, ["lang", "tail"])
    scored = scored.withColumn("score", _exact_score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # every shorter phrase inside a candidate, with the largest count of such a candidate
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    starts = F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)
    inside = (
        candidates.where(F.col("words") > 2)
        .select("lang", "w", "words", "a", F.explode(lengths).alias("length"))
        .select("lang", "w", "length", "a", F.explode(starts).alias("start"))
        .groupBy("lang", _part(F.col("w"), F.col("start"), F.col("length")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent)
    )
    found = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return (
        _first_places(found, top)
        .join(F.broadcast(totals), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
