"""Best-fit packing of documents into sequences by bin completion.

Only how many pieces there are of each length matters to how they can be packed, and
there are at most ``capacity`` lengths. The pieces are counted by length, the counts
are packed once, on the driver, and the plan, a bounded number of patterns and how
often each is used, is carried out by all tasks side by side.

Bin completion takes the largest length left and branches on the fillings of the room
beside it: all but those that leave room for another length that is left (they are
dominated), exact ones of few pieces first, then lot by lot those of least waste. If one
piece fills the room, or is the longest where no two fit, it dominates all others and is the
only branch. A filling is used as often as the counts allow, which uses one length up, so
a first plan has at most as many patterns as there are lengths; using it once is the branch
behind that, from which any other number follows. A branch is given up when its sequences
and the least number the rest needs are no fewer than those of the incumbent, at first
best-fit decreasing, or when its counts were reached with as few sequences before. No other
branch is dropped: the search ends at a proven optimum, or after ``nodes`` steps (a filling
tried, or a lot enumerated) with the best plan found. With many pieces it is the latter as
a rule unless the plan is at the bound, so that plan is not proven to be the best.

Defined cases: a null text is empty and has just the end id; repeated rows and null
ids are packed as rows of their own; an empty table needs no sequence.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import whole_text
from tidemill.llm.tokens import ID_BYTES, default_vocabulary, parts_of, shared_encoder
from tidemill.session import shuffle_partitions
from tidemill.sources.snapshots import freeze

CAPACITY = 2048
END_ID = 0
NODES = 20_000
ENUMERATED = 400  # fillings put in order at a time beside one largest piece
FEW = 64  # pieces left, from which on all fillings are put in order

Filling = tuple[tuple[int, int], ...]  # (length, times), longest first
Plan = list[tuple[Filling, int]]


def _maximal_fillings(beside: np.ndarray, without: int) -> Iterator[Filling | None]:
    """Every undominated filling of the room, in lots of which each has its best first.

    A filling is undominated if no length that is left fits beside it, and one piece is
    by a longer one. Exact fillings of up to ``without`` pieces are left out. None stands behind
    each lot, of ENUMERATED fillings or as many as so many steps find.
    """
    lengths = np.flatnonzero(beside)[::-1].tolist()
    counts = beside[lengths].tolist()
    falling, n = [-x for x in lengths], len(lengths)
    behind = [0]
    for length, count in zip(reversed(lengths), reversed(counts), strict=True):
        behind.append(behind[-1] + length * count)
    behind.reverse()
    taken, chosen = [0] * n, []
    room, at, steps = len(beside) - 1, 0, 0
    found: list[tuple[int, int, Filling]] = []
    while True:
        steps += 1
        i = bisect_left(falling, -room, at)
        while i < n and taken[i] == counts[i]:
            i += 1
        if i < n:
            chosen.append(i)
            taken[i] += 1
            room -= lengths[i]
            at = i
            continue
        least = n - 1
        while least >= 0 and taken[least] == counts[least]:
            least -= 1
        maximal = least < 0 or lengths[least] > room
        known = not room and len(chosen) <= without
        if maximal and not known and (len(chosen) != 1 or not chosen[0]):
            found.append((room, len(chosen), tuple((lengths[i], taken[i]) for i in dict.fromkeys(chosen))))
        while chosen:
            i = chosen.pop()
            taken[i] -= 1
            room += lengths[i]
            at = i + 1
            if room - behind[at] < lengths[i]:  # else a piece of this length fits in any case
                break
        else:
            break
        if len(found) >= ENUMERATED or steps >= 20 * ENUMERATED:
            yield from (f for _, _, f in sorted(found, key=lambda x: x[:2]))
            yield None
            found, steps = [], 0
    yield from (f for _, _, f in sorted(found, key=lambda x: x[:2]))


def _exact_fillings(beside: np.ndarray) -> Iterator[Filling]:
    """Fillings of two and of three pieces that leave nothing free, all of them."""
    room, left, some = len(beside) - 1, beside.copy(), beside > 0

    def pairs(total: int, bound: int) -> Iterator[Filling]:
        high = np.arange(min(total - 1, bound), (total - 1) // 2, -1)
        fits = some[high] & some[total - high] & ((2 * high != total) | (left[high] > 1))
        for a in high[fits].tolist():
            yield ((a, 2),) if 2 * a == total else ((a, 1), (total - a, 1))

    yield from pairs(room, room)
    for a in np.flatnonzero(some[: max(room - 1, 0)])[::-1].tolist():
        if 3 * a < room:
            break
        left[a] -= 1
        some[a] = left[a] > 0
        for rest in pairs(room - a, a) if room - a > 1 else ():
            times = dict(rest)
            times[a] = times.get(a, 0) + 1
            yield tuple(sorted(times.items(), reverse=True))
        left[a] += 1
        some[a] = True


def _completions(beside: np.ndarray, few: bool) -> Iterator[tuple[Filling, bool] | None]:
    """Fillings of the room ``len(beside) - 1``, and whether one dominates all others.

    One does if nothing fits, if one piece fills the room, and the longest piece
    if no two fit. With many pieces left those that leave nothing free come first.
    """
    lengths = np.flatnonzero(beside)
    if not len(lengths):
        yield (), True
        return
    shortest, longest = int(lengths[0]), int(lengths[-1])
    if beside[shortest] > 1:
        two = 2 * shortest
    else:
        two = shortest + int(lengths[1]) if len(lengths) > 1 else len(beside)
    if longest == len(beside) - 1 or two >= len(beside):
        yield ((longest, 1),), True
        return
    if not few:
        yield from ((f, False) for f in _exact_fillings(beside))
    for filling in _maximal_fillings(beside, 0 if few else 3):
        yield filling and (filling, False)


def _branches(left: np.ndarray, few: bool) -> Iterator[tuple[Filling, int] | None]:
    """Fillings with the largest length left and how often to use each: in bulk, and once.

    Once is enough for any other number, as it leads to the same choice again.
    """
    largest = int(np.flatnonzero(left)[-1])
    beside = left[: len(left) - largest].copy()
    if largest < len(beside):
        beside[largest] -= 1
    for branch in _completions(beside, few):
        if branch is None:
            yield None
            continue
        times = dict(branch[0])
        times[largest] = times.get(largest, 0) + 1
        whole = tuple(sorted(times.items(), reverse=True))
        most = min(int(left[x]) // n for x, n in whole)
        yield whole, most
        if most > 1 and not branch[1]:
            yield whole, 1


def _at_least(counts: np.ndarray, capacity: int) -> int:
    """A number of sequences that any packing of these pieces needs (Martello and Toth)."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return 0
    n = counts[lengths].astype(object)
    total = int((lengths * n).sum())
    best = -(-total // capacity)
    for small in {1, *(int(x) for x in lengths[lengths <= capacity // 2][:: max(1, len(lengths) // 64)])}:
        large = lengths > capacity - small
        half = (lengths > capacity // 2) & ~large
        rest = (lengths >= small) & (lengths <= capacity // 2)
        bins = int(n[large].sum()) + int(n[half].sum())
        room = capacity * int(n[half].sum()) - int((lengths[half] * n[half]).sum())
        more = int((lengths[rest] * n[rest]).sum()) - room
        best = max(best, bins + max(0, -(-more // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Longest first, each piece into the fullest sequence that has room; in bulk."""
    by_room: dict[int, dict[Filling, int]] = {}
    for length in sorted(counts, reverse=True):
        n = counts[length]
        for room in sorted(r for r in by_room if r >= length):
            for filling in list(by_room[room]):
                each = room // length
                number = by_room[room][filling]
                while n and number and each:
                    bins = min(number, n // each)
                    if not bins:
                        each = n
                        continue
                    more = (*filling, (length, each))
                    by_room.setdefault(room - each * length, {}).setdefault(more, 0)
                    by_room[room - each * length][more] += bins
                    by_room[room][filling] -= bins
                    n, number = n - bins * each, number - bins
                if not by_room[room][filling]:
                    del by_room[room][filling]
        each = capacity // length
        for times, bins in ((each, n // each), (n % each, 1)):
            if times and bins:
                by_room.setdefault(capacity - times * length, {})[((length, times),)] = bins
    return [(f, n) for fs in by_room.values() for f, n in fs.items()]


def plan_fillings(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Fillings and how often each is used, so that every piece is used once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    best = best_fit_decreasing({k: v for k, v in counts.items() if v}, capacity)
    fewest, least = sum(n for _, n in best), _at_least(left, capacity)
    if fewest <= least:
        return best
    draw = random.Random(0)
    names = [draw.getrandbits(128) for _ in range(capacity + 1)]
    plan: Plan = []
    used, pieces, total, state = 0, int(left.sum()), sum(x * n for x, n in counts.items()), 0
    seen: dict[int, int] = {}  # the fewest sequences some counts were reached with

    def use(filling: Filling, bins: int) -> None:
        nonlocal used, pieces, total, state
        used += bins
        for x, n in filling:
            left[x] -= n * bins
            pieces -= n * bins
            total -= x * n * bins
            state = (state + n * bins * names[x]) % 2**128

    open_nodes = [_branches(left, pieces <= FEW)]
    while open_nodes and nodes > 0 and fewest > least:
        closed = used - (-total // capacity) >= fewest
        branch = None if closed else next(open_nodes[-1], ())
        if closed or branch == ():
            open_nodes.pop()
            if plan:
                filling, bins = plan.pop()
                use(filling, -bins)
            continue
        nodes -= 1
        if branch is None:  # a lot of fillings was enumerated
            continue
        use(*branch)
        plan.append(branch)
        if not pieces and used < fewest:
            best, fewest = list(plan), used
        bound = used - (-total // capacity)
        if bound < fewest and (pieces <= FEW or len(plan) % 16 == 0):
            bound = used + _at_least(left, capacity)
        if bound < fewest and used < seen.get(state, used + 1):
            seen[state] = used
            open_nodes.append(_branches(left, pieces <= FEW))
        else:
            plan.pop()
            use(branch[0], -branch[1])
    return best


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Whole pieces of ``capacity``, and a first piece of what remains."""
    first = n % capacity
    return [first] * bool(first) + [capacity] * (n // capacity)


def _pieces(vocabulary: str, end_id: int, capacity: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        for batch in batches:
            for part in parts_of(batch, 1):
                rows: list[tuple] = []
                for doc_id, body in zip(
                    part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True
                ):
                    ids, start = body + end, 0
                    for piece, length in enumerate(piece_lengths(len(ids) // ID_BYTES, capacity)):
                        own = ids[ID_BYTES * start : ID_BYTES * (start + length)]
                        rows.append((doc_id, piece, start, length, zlib.crc32(own), own if with_ids else None))
                        start += length
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                kept = 6 if with_ids else 5
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:kept]
                arrays = [pa.array(c, t) for c, t in zip(columns[:kept], types[:kept], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def token_pieces(
    docs: DataFrame,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and on demand the ids of each piece."""
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long"
    run = _pieces(vocabulary or default_vocabulary(), end_id, capacity, with_ids)
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.mapInArrow(run, columns + ", ids binary" * with_ids)


def _slots(plan: Plan, capacity: int) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, in their order: rows sorted by length, then rank."""
    rows, base, taken = [], 0, {}
    for filling, bins in plan:
        offset = 0
        for length, times in filling:
            first = taken.get(length, 0)
            rows.append((length, first, times, base, offset))
            taken[length] = first + bins * times
            offset += length * times
        base += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "times", "base", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Adds sequence_id and offset to pieces of known length, each within ``capacity``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_fillings(counts, capacity, nodes), capacity)
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_partitions(spark)))
    salted = pieces.withColumn("salt", salt)
    groups = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("place", F.row_number().over(order))
        .join(groups, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("place") - 1)
        .select(*pieces.columns, "rank")
    )
    step = int(slots["first"].max(initial=0)) + max(counts.values(), default=0) + 1
    keys = slots["length"] * step + slots["first"]
    rank_at = len(ranked.columns) - 1

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column(rank_at).to_numpy()
            row = np.searchsorted(keys, length * step + rank, "right") - 1
            turn = rank - slots["first"][row]
            sequence = slots["base"][row] + turn // slots["times"][row]
            offset = slots["offset"][row] + turn % slots["times"][row] * length
            columns = [*batch.columns[:rank_at], pa.array(sequence), pa.array(offset)]
            names = [*batch.schema.names[:rank_at], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:rank_at]]
    return ranked.mapInArrow(put, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, *, nodes: int = NODES, capacity: int = CAPACITY, **how) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed at."""
    return pack(freeze(token_pieces(docs, capacity=capacity, **how), "pieces"), capacity, nodes)
