"""MinHash near-deduplication with fast similarity sketches.

A document is the set of its word shingles. Its sketch has 128 coordinates. In round
``i`` every shingle is thrown into one hashed coordinate with a hashed value, later
rounds count as larger values, and a coordinate keeps the least it gets; after 128 rounds,
round ``i`` throws everything into coordinate ``i - 128``, so every coordinate fills.
Rounds end as soon as all have. Two sets agree in a coordinate with the probability of their
Jaccard similarity, with concentration bounds that ordinary one-permutation sketches lack.

Equal sets are one class from the start, whatever their number. Sketches are cut into
32 bands of four; classes that share a band are candidates (at a similarity of 0.85
all bands miss with probability 6e-11). Candidates are confirmed on their full sets.
What is wanted are components, so a bucket of ``m`` classes is not expanded into pairs.
In two rounds a few pivots of each bucket, those of the smallest components first, are
compared with its members in other components, components are merged, and buckets
within one component are done. For buckets that are still of several components, blocks of
their classes meet, two in a task, which compares all their pairs by a product of matrices
and returns only links that join components: no link between components is lost.
Pairs whose sets cannot overlap enough are not compared: a shingle that only one
candidate has is in no intersection, and a class with too many of those can link with
nothing.

Defined cases: a null text is empty; a document without words or text is linked with
nothing; with fewer words than a shingle has, all of them are the one shingle; rows of equal
ids are nodes of their own, with the component's smallest id; a document whose id is null
only stays where no other of its component has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import fresh, whole_text, worker_table
from tidemill.llm.components import connect
from tidemill.session import new_folder
from tidemill.sources.snapshots import drop_frozen, freeze

COORDINATES = 128
BAND = 4
SHINGLE = 5
SIMILARITY = 80  # of a hundred
WORDS_KEPT = 400_000  # hashes a worker remembers
TEXTS_AT_ONCE = 256
PIVOTS = (1, 4)  # of a bucket, round by round
BLOCK = 128  # classes, two such blocks meet in a task
COLUMNS_AT_ONCE = 4096
UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
# odd constants of well-known 64-bit mixers; any others would do
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = 0x9E3779B97F4A7C15
MASK = 0xFFFFFFFFFFFFFFFF


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _salt(i: int) -> np.uint64:
    return np.uint64((i + 1) * STEP & MASK)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _shared_hashes() -> _WordHashes:
    return worker_table("word hashes", _WordHashes)


def shingle_hashes(words: list[bytes], hashes: dict[bytes, int], width: int) -> np.ndarray:
    """The sorted set of hashed shingles; of fewer words than ``width``, of all of them."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    used = min(width, len(words))
    n = len(words) - used + 1
    joined = np.full(n, _salt(used), np.uint64)
    for i in range(used):
        joined = _mixed(joined + h[i : i + n])
    return np.unique(joined)


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row per set that is not empty; ``coordinates`` is a power of two."""
    out = np.full(len(sets) * coordinates, UNFILLED, np.uint64)
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * coordinates):
        x = _mixed(items + _salt(i + 1000))
        if i < coordinates:
            place = owner * coordinates + (x & np.uint64(coordinates - 1)).astype(np.int64)
        else:
            place = owner * coordinates + (i - coordinates)
        value = (x >> np.uint64(9)) | np.uint64(i << 55)
        empty = out[place] == UNFILLED
        np.minimum.at(out, place[empty], value[empty])
        full = (out.reshape(-1, coordinates) != UNFILLED).all(axis=1)
        if full.all():
            break
        if i % 2 or i < 4:
            going = ~full[owner]
            items, owner = items[going], owner[going]
    return out.reshape(-1, coordinates)


def band_keys(sketched: np.ndarray, band: int = BAND) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    rows = sketched.reshape(len(sketched), -1, band)
    keys = np.broadcast_to(
        np.array([_salt(5000 + b) for b in range(rows.shape[1])], np.uint64), rows.shape[:2]
    )
    for r in range(band):
        keys = _mixed(keys + rows[:, :, r])
    return keys


def _words(text: str | None) -> list[bytes]:
    # bytes.lower changes A-Z only, and bytes.split cuts at ASCII white space only
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def _set_key(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


def _sketching(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _shared_hashes()
        for part in _slices(batches):
            if len(hashes) > WORDS_KEPT:
                hashes.clear()
            sets = [shingle_hashes(_words(t), hashes, width) for t in part.column(1).to_pylist()]
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(sketches(some)).astype("<i8") if some else ())
            bands = [next(keys).tolist() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _setting(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _shared_hashes()
        for part in _slices(batches):
            if len(hashes) > WORDS_KEPT:
                hashes.clear()
            sets = [shingle_hashes(_words(t), hashes, width) for t in part.column(0).to_pylist()]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_key(s) for s in sets], pa.binary()),
                    pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                ],
                names=["set_key", "shingles"],
            )

    return run


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class_id and each of its shingles."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            sets = [np.frombuffer(s.as_buffer(), "<i8") for s in part.column(1)]
            owner = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
            items = np.concatenate(sets)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(items)], names=["class_id", "shingle"])


def _own_shingles(sets: DataFrame) -> DataFrame:
    """class_id, own: how many of its shingles no other of these classes has."""
    return (
        sets.mapInArrow(_one_by_one, "class_id long, shingle long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("class_id"))
        .where("n = 1")
        .groupBy("class_id")
        .agg(F.count(F.lit(1)).alias("own"))
    )


def _confirming(similarity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(a[i].as_buffer(), "<u8")
                y = np.frombuffer(b[i].as_buffer(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                linked[i] = 100 * both >= similarity * (len(x) + len(y) - both)
            kept = batch.select(["a", "b"]).append_column("linked", pa.array(linked))
            yield kept

    return run


def _in_block_pair(similarity: int):
    """Of up to two blocks of classes: links that join different components.

    Intersections of all pairs at once, as products of matrices of ones and zeros; what
    is returned are the fewest links that join the same components.
    """

    def run(block: pa.Table) -> pa.Table:
        label = block.column("label").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), "<u8") for s in block.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), sizes)
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        frequent = np.bincount(column) > 1  # others are in no intersection
        place = np.cumsum(frequent) - 1
        row, column = row[frequent[column]], place[column[frequent[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(frequent.sum()), COLUMNS_AT_ONCE):
            low, high = np.searchsorted(column, [start, start + COLUMNS_AT_ONCE])
            ones = np.zeros((len(sets), COLUMNS_AT_ONCE), np.float32)
            ones[row[low:high], column[low:high] - start] = 1
            both += ones @ ones.T
        linked = 100 * both >= similarity * (sizes[:, None] + sizes[None, :] - both)
        linked &= label[:, None] != label[None, :]
        root: dict[int, int] = {}
        edges = []

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            a, b = top(int(label[i])), top(int(label[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(label[i]), int(label[j])))
        ends = list(zip(*edges, strict=True)) or [(), ()]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return run


def _links_in_blocks(left: DataFrame, sets: DataFrame, similarity: int, kept) -> DataFrame:
    """Links between components of what pivots have not settled: (a, b), labels.

    Classes that buckets connect form a group; it is cut into blocks, and every two
    blocks meet in one task of bounded size. A class is copied once for each block of its
    group, not for each class.
    """
    star = left.groupBy("bucket").agg(F.min("class_id").alias("b"))
    near = left.join(star, "bucket").select(F.col("class_id").alias("a"), "b")
    groups = connect(kept(near.distinct(), "near")).select(F.col("node").alias("class_id"), F.col("root").alias("family"))
    number = groups.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = groups.join(number, "family").withColumn(
        "own", F.pmod(F.xxhash64(F.lit("block"), F.col("class_id")), "blocks").cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    labels = left.select("class_id", "label").distinct()
    met = (
        dealt.join(labels, "class_id")
        .select("class_id", "label", "family", "own", other)
        .select("class_id", "label", "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    return (
        met.join(sets, "class_id")
        .select("family", "i", "j", "label", "shingles")
        .groupBy("family", "i", "j")
        .applyInArrow(_in_block_pair(similarity), "a long, b long")
    )


def _candidate_sets(docs: DataFrame, classes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """class_id and its sorted shingle hashes, for the classes that are in a bucket."""
    wanted = members.select("class_id").distinct().join(classes, "class_id")
    texts = docs.select("doc_id", whole_text().alias("text"))
    # an id may be null
    first = wanted.select(F.coalesce("first_id", F.lit(-1)).alias("w_id"), F.isnull("first_id").alias("w_null")).distinct()
    chosen = texts.join(
        first,
        (F.coalesce("doc_id", F.lit(-1)) == F.col("w_id")) & (F.isnull("doc_id") == F.col("w_null")),
        "left_semi",
    )
    sets = chosen.select("text").mapInArrow(_setting(width), "set_key binary, shingles binary")
    keyed = wanted.select("class_id", "set_key")
    return sets.join(keyed, "set_key").select("class_id", "shingles").dropDuplicates(["class_id"])


def _class_links(docs: DataFrame, classes: DataFrame, width: int, similarity: int) -> DataFrame:
    """class_id, root: the component of every class that is in a bucket with another."""
    spark = docs.sparkSession
    banded = classes.select("class_id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = freeze(banded.join(shared.select("bucket"), "bucket"), "members")
    sets = freeze(_candidate_sets(docs, classes, members, width), "sets")
    # what a class alone has is in no intersection: many can link with nothing for it
    shared = F.col("n_shingles") - F.coalesce("own", F.lit(0))
    sizes = freeze(
        members.select("class_id")
        .distinct()
        .join(classes.select("class_id", "n_shingles"), "class_id")
        .join(_own_shingles(sets), "class_id", "left")
        .select("class_id", F.col("n_shingles").alias("n"), shared.alias("shared"))
        .where(F.col("shared") * 100 >= F.col("n") * similarity),
        "sizes",
    )
    members = freeze(members.join(sizes.select("class_id"), "class_id"), "members")
    labels = members.select("class_id").distinct().withColumn("label", F.col("class_id"))
    labels = freeze(labels, "labels")
    tested = spark.createDataFrame([], "a long, b long")
    held: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        held.append(new_folder(spark, label))
        return freeze(df, label, held[-1])

    def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members, with labels, of the buckets that more than one component has part in."""
        labelled = members.join(labels, "class_id")
        open_buckets = (
            labelled.groupBy("bucket")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low != high")
            .select("bucket")
        )
        return kept(labelled.join(open_buckets, "bucket"), "open")

    def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
        roots = connect(kept(edges.distinct(), "joins")).withColumnRenamed("node", "label")
        label = F.coalesce("root", "label").alias("label")
        return kept(labels.join(roots, "label", "left").select("class_id", label), "labels")

    for pivots in PIVOTS:
        labelled = open_members(members, labels)
        groups = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("bucket").orderBy("n", "label", "class_id")
        chosen = (
            labelled.join(groups, ["bucket", "label"])
            .withColumn("turn", F.row_number().over(order))
            .where(F.col("turn") <= pivots)
            .select("bucket", F.col("class_id").alias("pivot"), F.col("label").alias("p_label"))
        )
        chosen = kept(chosen, "pivots")
        pairs = (
            labelled.join(chosen, "bucket")
            .where("label != p_label")
            .select(F.least("class_id", "pivot").alias("a"), F.greatest("class_id", "pivot").alias("b"))
            .distinct()
        )
        size_a, size_b = (
            sizes.select(*(F.col(c).alias(d) for c, d in zip(sizes.columns, (x, f"n_{x}", f"s_{x}"), strict=True)))
            for x in "ab"
        )
        most = F.least("s_a", "s_b")
        possible = most * 100 >= (F.col("n_a") + F.col("n_b") - most) * similarity
        pairs = kept(
            pairs.join(tested, ["a", "b"], "left_anti")
            .join(size_a, "a")
            .join(size_b, "b")
            .where(possible)
            .select("a", "b"),
            "pairs",
        )
        set_a = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("set_a"))
        set_b = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("set_b"))
        confirmed = pairs.join(set_a, "a").join(set_b, "b").mapInArrow(
            _confirming(similarity), "a long, b long, linked boolean"
        )
        confirmed = kept(confirmed, "confirmed")
        tested = tested.unionByName(pairs)
        links = confirmed.where("linked").select("a", "b")
        la = labels.select(F.col("class_id").alias("a"), F.col("label").alias("label_a"))
        lb = labels.select(F.col("class_id").alias("b"), F.col("label").alias("label_b"))
        edges = links.join(la, "a").join(lb, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        labels = merged(labels, edges)
        met = chosen.select("bucket", F.col("pivot").alias("class_id"))
        members = kept(
            labelled.select("bucket", "class_id").join(met, ["bucket", "class_id"], "left_anti"), "members"
        )
    left = open_members(members, labels)
    labels = merged(labels, _links_in_blocks(left, sets, similarity, kept))
    final = freeze(labels, "labels")
    for path in held:
        drop_frozen(spark, path)
    return final.withColumnRenamed("label", "root")


def near_groups(docs: DataFrame, *, width: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    sketched = freeze(
        texts.mapInArrow(
            _sketching(width), "doc_id long, n_shingles long, set_key binary, bands array<long>"
        ),
        "sketched",
    )
    classes = freeze(
        sketched.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    roots = _class_links(docs, classes, width, similarity)
    rooted = classes.join(roots, "class_id", "left").select(
        "set_key", "first_id", F.coalesce("root", "class_id").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = rooted.join(least, "root").select("set_key", "component_id")
    rows = sketched.select("doc_id", "n_shingles", "set_key")
    linked = rows.where("set_key IS NOT NULL").join(of_class, "set_key")
    alone = rows.where("set_key IS NULL").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, *, width: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """The documents, all columns, that stand for their group, one row of each.

    It is the row of the least id, one without an id only if none has one, and of rows that
    share it any one. The rows are numbered and written first, so that ids need not tell them apart.
    """
    row = fresh(docs, "row")
    rows = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    numbered = rows.select(F.col(row).alias("doc_id"), "text")
    groups = near_groups(numbered, width=width, similarity=similarity)
    groups = groups.select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    first = rows.select("doc_id", row).join(groups, row).groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").drop(row)
