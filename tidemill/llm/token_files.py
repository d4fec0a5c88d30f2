"""Token ids of a corpus in files of directly addressable codes.

Documents are tokenized in ascending order of their ids and cut into segments of
about a million tokens. A segment's ids are cut into chunks of eight bits: the first level
has the low chunk of every id and a bitmap of those that go on, the next level has the next
chunk of just these, and so on. A directory beside each bitmap counts the ones before every
512th bit, so the place of any token in each level, and so its id, is found by counting
at most 512 bits a level, and no other token is decoded.

The files are Parquet, written by Spark so that a lost task leaves nothing behind; a row
is a segment: the part it is in, its place there, its documents' ids and ends, its codes.
Positions in the whole corpus come from one sum per part.

Defined cases: a null text is empty; a document of no text has just the end id; null ids
come first and equal ids are ordered by their text; a document is never cut, so a segment
is at least as long as the longest text; an empty table gives files without rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import whole_text
from tidemill.llm.tokens import ID_BYTES, default_vocabulary, parts_of, shared_encoder

SEGMENT_TOKENS = 1 << 20
BLOCK_BITS = 512
MAGIC = b"DAC1"
END_ID = 2
SEGMENTS = (
    "part int, segment int, first_token long, n_tokens long, "
    "doc_ids array<long>, doc_ends array<long>, codes binary"
)


def encode(ids: np.ndarray) -> bytes:
    """The codes of unsigned integers under 2**32."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        goes_on = rest > 0xFF
        levels.append((rest.astype(np.uint8), goes_on))
        rest = rest[goes_on] >> np.uint32(8)
        if not len(rest):
            break
    out = [MAGIC, struct.pack("<I", len(levels)), struct.pack(f"<{len(levels)}Q", *(len(c) for c, _ in levels))]
    for chunks, goes_on in levels:
        bits = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(goes_on, np.arange(0, len(goes_on), BLOCK_BITS), dtype=np.uint64) if len(goes_on) else []
        before = np.concatenate(([0], np.cumsum(ones)[:-1] if len(ones) else []))
        out += [chunks.tobytes(), bits.tobytes(), before.astype("<u8").tobytes()]
    return b"".join(out)


class Codes:
    """Reads ids out of codes, any of them by itself."""

    def __init__(self, codes: bytes) -> None:
        if codes[:4] != MAGIC:
            raise ValueError("these are not directly addressable codes")
        (levels,) = struct.unpack_from("<I", codes, 4)
        sizes = struct.unpack_from(f"<{levels}Q", codes, 8)
        at, self._levels = 8 + 8 * levels, []
        for size in sizes:
            blocks = max(1, -(-size // BLOCK_BITS))
            chunks = np.frombuffer(codes, np.uint8, size, at)
            bits = np.frombuffer(codes, np.uint8, -(-size // 8), at + size)
            before = np.frombuffer(codes, "<u8", blocks, at + size + len(bits))
            at += size + len(bits) + 8 * blocks
            self._levels.append((chunks, bits, before))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits."""
        chunks, bits, before = self._levels[level]
        if i >= len(chunks):
            return len(self._levels[level + 1][0]) if level + 1 < len(self._levels) else 0
        block = i // BLOCK_BITS
        start, whole = block * BLOCK_BITS // 8, i // 8
        count = int(before[block]) + int(np.bitwise_count(bits[start:whole]).sum())
        return count + (int(bits[whole]) & ((1 << (i % 8)) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self._levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def span(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to before ``end``, as far as there are any."""
        return self._span(0, start, min(end, len(self)))

    def _span(self, level: int, start: int, end: int) -> np.ndarray:
        chunks, bits, _ = self._levels[level]
        ids = chunks[start:end].astype("<u4")
        if level + 1 < len(self._levels) and start < end:
            low = start // 8
            flags = np.unpackbits(bits[low : -(-end // 8)], bitorder="little")
            goes_on = flags[start - 8 * low : end - 8 * low].astype(bool)
            deeper = self._span(level + 1, self._rank(level, start), self._rank(level, end))
            ids[goes_on] |= deeper << np.uint32(8)
        return ids


def _segments(vocabulary: str, end_id: int, segment_tokens: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(vocabulary), TaskContext.get().partitionId()
        segment, first, ids, ends, parts = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            codes = encode(np.frombuffer(b"".join(parts), "<u4"))
            columns = [[part], [segment], [first], [ends[-1]], [ids], [ends], [codes]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            types += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SEGMENTS.split(", ")])

        for batch in batches:
            for slice_ in parts_of(batch, 1):
                doc_ids = slice_.column(0).to_pylist()
                for doc_id, body in zip(doc_ids, encoder.encode(slice_.column(1).to_pylist()), strict=True):
                    parts += (body, end)
                    ids.append(doc_id)
                    ends.append((ends[-1] if ends else 0) + len(body) // ID_BYTES + 1)
                    if ends[-1] >= segment_tokens:
                        yield close()
                        segment, first = segment + 1, first + ends[-1]
                        ids, ends, parts = [], [], []
        if ids:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    ordered = (
        docs.select("doc_id", whole_text().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    segments = _segments(vocabulary or default_vocabulary(), end_id, segment_tokens)
    ordered.mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows, and with them ``start``: tokens of the corpus before the segment."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    sums = segments.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))  # one row a task
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("part", F.coalesce(F.sum("of_part").over(order), F.lit(0)).alias("before"))
    return segments.join(F.broadcast(before), "part").withColumn(
        "start", F.col("before") + F.col("first_token")
    )


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool = True) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(row["codes"])
            ends = np.array(row["doc_ends"], np.int64)
            starts = np.concatenate(([0], ends[:-1]))
            ids = codes.span(0, len(codes)).tobytes()
            bodies = [
                ids[ID_BYTES * a : ID_BYTES * b]
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
            ]
            columns = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["start"] + starts),
                pa.array(ends - starts),
                pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(bodies, pa.binary()))
            names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_documents(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and on demand ids (4 bytes each) of every document."""
    rows = read_segments(spark, path).select("start", "doc_ids", "doc_ends", "codes")
    types = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(partial(_documents, with_ids=with_ids), types)


def find_segment(spark: SparkSession, path: str, position: int) -> tuple[int, int, int] | None:
    """Part and segment that hold a position, and where the segment starts. Reads no codes."""
    here = read_segments(spark, path).where(
        (F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position)
    )
    row = here.select("part", "segment", "start").first()
    return None if row is None else tuple(row)


def codes_of(spark: SparkSession, path: str, part: int, segment: int) -> DataFrame:
    """The codes of one segment; its numbers reach the scan, which leaves the others out."""
    rows = spark.read.schema(SEGMENTS).parquet(path)
    return rows.where((F.col("part") == part) & (F.col("segment") == segment)).select("codes")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at one position of the corpus; reads the codes of the one segment that has it."""
    found = find_segment(spark, path, position)
    if found is None:
        raise IndexError(position)
    part, segment, start = found
    return Codes(bytes(codes_of(spark, path, part, segment).first()["codes"]))[position - start]
