"""Fill-in-the-middle: texts cut in three and put together in another order.

A text is a sequence of units, runs of Latin letters or single other characters. The cuts
are drawn as unit numbers, and the text needs them as character offsets. Each text gets a
rank index for that: the offsets of all its unit boundaries as a function of their number,
cut greedily into line segments that stay within ``ERROR`` characters of every boundary,
and beside them what is left between line and boundary, a byte each. A cut is predicted by
the line of its segment and put right exactly by that remainder.

Defined cases: a null text is empty; an empty text, one that contains a marker, and those
drawn to stay as they are come out unchanged as ``plain``, with null cuts; a null id is
drawn for as empty text; repeated rows stay, each by itself; an empty table gives an empty
one; a very long text has more segments and is otherwise like any other; columns
but ``doc_id`` and ``text`` are not looked at, whatever they are called. Rows are
independent, so no case moves data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import hex_number
from tidemill.llm.common import whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
CHANGED_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
ERROR = 100  # remainders, which rounding may put one beyond it, fit in a byte
LOOK_AHEAD = 512
TEXTS_AT_ONCE = 512
MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def boundaries(text: str) -> np.ndarray:
    """Offsets of all unit boundaries: 0, the end of the first unit, ..., the text's length."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(points):
        return np.zeros(1, np.int64)
    letter = ((points | np.uint32(32)) - np.uint32(97)) < 26
    inside = letter[:-1] & letter[1:]
    return np.concatenate(([0], np.flatnonzero(~inside) + 1, [len(points)]))


class RankIndex:
    """From the number of a boundary to its offset, by lines and remainders."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        if not 0 < error <= 126:
            raise ValueError("remainders are bytes: the error must be from 1 to 126")
        self._first: list[int] = []  # of each segment: its first boundary, the offset there
        self._base: list[int] = []
        self._slope: list[float] = []
        self.remainders = np.zeros(len(offsets), np.int8)
        at = 0
        while at < len(offsets):
            end, slope = self._reach(offsets, at, error)
            base = int(offsets[at])
            line = base + np.floor(slope * np.arange(end - at) + 0.5).astype(np.int64)
            self.remainders[at:end] = offsets[at:end] - line
            self._first.append(at)
            self._base.append(base)
            self._slope.append(slope)
            at = end
        self._starts = np.array(self._first)

    @staticmethod
    def _reach(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """How far one line from boundary ``at`` stays within the error, and its slope.

        Each boundary allows slopes between two bounds; the segment ends before
        the one whose bounds miss what all before it have in common.
        """
        look = LOOK_AHEAD
        while True:
            end = min(len(offsets), at + 1 + look)
            run = np.arange(1, end - at)
            rise = offsets[at + 1 : end] - offsets[at]
            low = np.maximum.accumulate((rise - error) / run)
            high = np.minimum.accumulate((rise + error) / run)
            missed = low > high
            stop = int(missed.argmax()) if missed.any() else len(run)
            if stop < len(run) or end == len(offsets):
                slope = (low[stop - 1] + high[stop - 1]) / 2 if stop else 0.0
                return at + 1 + stop, float(slope)
            look *= 4

    @property
    def segments(self) -> int:
        return len(self._first)

    def offset(self, boundary: int) -> int:
        """The offset of a boundary; exact, in the time of one search among the segments."""
        if not 0 <= boundary < len(self.remainders):
            raise IndexError(boundary)
        k = int(np.searchsorted(self._starts, boundary, "right")) - 1
        line = self._base[k] + math.floor(self._slope[k] * (boundary - self._first[k]) + 0.5)
        return line + int(self.remainders[boundary])


def _rearranged(text: str, form: str, first: int, second: int) -> tuple:
    index = RankIndex(boundaries(text))
    n = len(index.remainders) - 1
    if form == "plain":
        return n, None, None, text
    cuts = sorted((first % (n + 1), second % (n + 1)))
    a, b = index.offset(cuts[0]), index.offset(cuts[1])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        output = f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    else:
        output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, len(prefix), len(middle), output


def _rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [field.split()[0] for field in MADE.split(", ")]
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch = whole.slice(at, TEXTS_AT_ONCE)
            doc_id, text, form, first, second = (c.to_pylist() for c in batch.columns)
            made = [_rearranged(*row) for row in zip(text, form, first, second, strict=True)]
            n, prefix, middle, output = zip(*made, strict=True)
            columns = [doc_id, n, form, prefix, middle, output]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def fill_in_middle(
    docs: DataFrame,
    *,
    seed: int = SEED,
    changed_percent: int = CHANGED_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every document.

    ``n`` counts the units; ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or
    ``spm`` (suffix, prefix, middle). Draws depend on the seed and the id alone.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [hex_number(F.col("drawn"), 1 + 8 * i, 8) for i in range(4)]
    text = F.col("text")
    stays = (text == "") | (draws[2] % 100 >= changed_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        stays = stays | text.contains(marker)
    form = F.when(stays, "plain").when(draws[3] % 100 < suffix_first_percent, "spm").otherwise("psm")
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), drawn.alias("drawn"))
    return rows.select(
        "doc_id", "text", form.alias("form"), draws[0].alias("first"), draws[1].alias("second")
    ).mapInArrow(_rearrange, MADE)


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone.

    No marker can arise where text and markers meet: each begins with a sign
    that stands nowhere else in it. So each stands once, where it was put.
    """
    head, tail = F.split_part(output, F.lit(SUFFIX), F.lit(1)), F.split_part(output, F.lit(SUFFIX), F.lit(2))
    suffix, middle = F.split_part(tail, F.lit(MIDDLE), F.lit(1)), F.split_part(tail, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(F.split_part(head, F.lit(PREFIX), F.lit(2)), middle, suffix)
    prefix_on = F.split_part(tail, F.lit(PREFIX), F.lit(2))
    spm = F.concat(
        F.split_part(prefix_on, F.lit(MIDDLE), F.lit(1)), middle, F.split_part(tail, F.lit(PREFIX), F.lit(1))
    )
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
