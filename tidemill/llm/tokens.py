"""Byte-level BPE ids of whole texts, in batches on the executors.

The vocabulary cuts a text into pieces before it merges bytes, and every white-space
run that ends in a space gives that space to the word behind it. A text may therefore be
cut in front of any single space that a word follows without changing its ids, and in
front of single line feeds, and between a letter or digit and signs. The distinct
stretches of many texts are found by Arrow, so that each is looked up once for all its
places, and the signs at their ends are parted from them. The
tokenizers library encodes each distinct stretch between such cuts once and its ids
are kept, in bounded number, for the next time. Texts with runs of white space, with
other than ASCII white space or with the content of an added token of the vocabulary
are given to the library whole. Such content gets the id of its token, as it does by
the library's default; only tokens that stand in no text are not added.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count, islice, repeat
from typing import TYPE_CHECKING

from tidemill.llm.common import worker_table

if TYPE_CHECKING:
    import pyarrow as pa

ID_BYTES = 4
KEPT = 600_000  # stretches a worker remembers, half of them from longer ago
TOGETHER = 64  # new stretches the library gets in one string, or whole texts at a time
BYTES_AT_ONCE = 1 << 21  # of texts whose distinct stretches are looked up together
#: What could take part in a run of white space, here or in the library.
_SPACES = re.compile("[ \t\n\x0b\x0c\r\x1c-\x1f][ \t\x0b\x0c\r\x1c-\x1f]| \n")
_OTHER_SPACES = re.compile(
    "[\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
)
#: Behind one of these a sign begins a piece of its own.
_ENDS_IN_LETTER = "[0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]\\z"
_END_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
_CONTROLS = tuple("\t\x0b\x0c\r\x1c\x1d\x1e\x1f")
_IN_TOKENS = {" ": "\u0120", "\n": "\u010a"}  # how the vocabulary writes them


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _only_single_spaces(text: str) -> bool:
    if "  " in text or " \n" in text:
        return False
    if any(c in text for c in _CONTROLS) and _SPACES.search(text):
        return False
    return text.isascii() or not _OTHER_SPACES.search(text)


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, so many at a time that their texts have BYTES_AT_ONCE bytes, or one."""
    import numpy
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends, first = numpy.cumsum(sizes.to_numpy(zero_copy_only=False), dtype="i8"), 0
    while first < batch.num_rows:
        most = BYTES_AT_ONCE + (ends[first - 1] if first else 0)
        last = max(first + 1, int(numpy.searchsorted(ends, most, "right")))
        yield batch.slice(first, last - first)
        first = last


def _places(numpy, start, length):
    """The places in spans, one span behind the other."""
    ends = numpy.cumsum(length, dtype="i8")
    places = numpy.repeat(start - (ends - length), length)
    places += numpy.arange(len(places))
    return places


def _without_signs(numpy, stretches: pa.LargeStringArray):
    """Stretches without the signs behind their last letter or digit, and these signs."""
    import pyarrow as pa
    import pyarrow.compute as pc

    stems = pc.ascii_rtrim(stretches, characters=_END_SIGNS)
    stems = pc.if_else(pc.match_substring_regex(stems, _ENDS_IN_LETTER), stems, stretches)
    _, offsets, data = stretches.buffers()
    ends = numpy.frombuffer(offsets, "i8", len(stretches) + 1)[1:]
    length = pc.binary_length(stretches).to_numpy() - pc.binary_length(stems).to_numpy()
    signs = numpy.frombuffer(data or b"", "u1")[_places(numpy, ends - length, length)]
    own = numpy.concatenate((numpy.zeros(1, "i8"), numpy.cumsum(length, dtype="i8")))
    return stems, pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(own), pa.py_buffer(signs))


class _Stretches(defaultdict):
    """Numbers stretches as they come, and keeps their ids: those of number k are
    ``pool[start[k] : start[k] + length[k]]``. What came last and has no ids yet is ``new``."""

    def __init__(self, numpy) -> None:
        super().__init__(count().__next__)
        self._numpy = numpy
        self.start, self.length = numpy.zeros(1 << 16, "i8"), numpy.zeros(1 << 16, "i4")
        self.pool = numpy.zeros(1 << 18, "<u4")
        self.held, self._used = 0, 0  # stretches with ids, ids

    @property
    def new(self) -> list[str]:
        return list(islice(reversed(self), len(self) - self.held))[::-1]

    def _room(self, array, size: int):
        if size <= len(array):
            return array
        larger = self._numpy.zeros(max(size, len(array) * 3 // 2), array.dtype)
        larger[: len(array)] = array
        return larger

    def put(self, numbers, ids, length) -> None:
        """Puts ids of stretches, which stand one behind the other, into the pool."""
        self.start, self.length = (self._room(a, len(self)) for a in (self.start, self.length))
        self.pool = self._room(self.pool, self._used + len(ids))
        self.pool[self._used : self._used + len(ids)] = ids
        self.length[numbers] = length
        self.start[numbers] = self._used + self._numpy.cumsum(length, dtype="i8") - length
        self._used += len(ids)

    def gather(self, numbers):
        """The ids of stretches one behind the other, and where those of each end."""
        numpy, length = self._numpy, self.length[numbers]
        return self.pool[_places(numpy, self.start[numbers], length)], numpy.cumsum(length, dtype="i8")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, no special tokens added."""

    def __init__(self, vocabulary: str, kept: int = KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy
        from tokenizers import Tokenizer

        self._numpy = numpy
        self._tokenizer = Tokenizer.from_file(vocabulary)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = tuple(token.content for token in added)
        #: Strings with these between them could hold an added token that none holds.
        self._apart = {front: any(front in content for content in self._added) for front in _IN_TOKENS}
        vocabulary = self._tokenizer.get_vocab()
        #: By what stands in front of strings: whether a token, by its id, begins with it.
        self._begins = {front: numpy.zeros(max(vocabulary.values()) + 1, bool) for front in _IN_TOKENS}
        for token, k in vocabulary.items():
            for front, written in _IN_TOKENS.items():
                self._begins[front][k] = token.startswith(written)
        #: By what stands behind a space, or from a line feed on; signs at ends with a space behind them.
        self._behind_space = _Stretches(numpy)
        self._before = _Stretches(numpy)  # the same, of longer ago
        self._kept = kept

    def _library(self, texts: list[str]) -> list[bytes]:
        found = []
        for i in range(0, len(texts), TOGETHER):
            encoded = self._tokenizer.encode_batch_fast(texts[i : i + TOGETHER], add_special_tokens=False)
            found += [self._numpy.array(e.ids, "<u4").tobytes() for e in encoded]
        return found

    def _by_stretches(self, text: str) -> bool:
        return _only_single_spaces(text) and not any(map(text.__contains__, self._added))

    def _cut(self, text: str) -> tuple[str, str | None]:
        """What stands in front of the first cut, and the stretches with spaces between, if
        there are any. Those that begin with a line feed have no space in front."""
        if not self._by_stretches(text):
            return text, None
        if "\n" in text and "\n\n" not in text and not any(map(text.__contains__, _CONTROLS)):
            text = text.replace("\n", " \n")
        front, space, behind = text.partition(" ")
        return front, behind if space else None

    def _learn(self) -> None:
        """Encodes the new stretches."""
        numpy, known, before = self._numpy, self._behind_space, self._before
        new = known.new
        old = numpy.fromiter(map(before.get, new, repeat(-1)), "i8", len(new))
        moved, unknown = known.held + numpy.flatnonzero(old >= 0), (old < 0).tolist()
        known.put(moved, before.gather(old[old >= 0])[0], before.length[old[old >= 0]])
        words, lines, odd = {}, {}, {}  # by number
        for k, s in compress(enumerate(new, known.held), unknown):
            if s[-1:] == " ":
                odd[k] = s[:-1]
            elif s and s == s.strip():
                words[k] = s
            elif s[:1] == "\n":
                line = s[1:]
                if line and line == line.strip() and "\n" not in line:
                    lines[k] = line
                else:
                    odd[k] = s
            else:
                odd[k] = " " + s
        for front, found in ((" ", words), ("\n", lines)):
            numbers = numpy.fromiter(found, "i8", len(found))
            known.put(numbers, *self._together(list(found.values()), front))
        self._put(odd, self._library(list(odd.values())))
        known.held = len(known)

    def _put(self, numbers: dict[int, object], found: list[bytes]) -> None:
        numpy = self._numpy
        length = numpy.fromiter(map(len, found), "i8", len(found)) // ID_BYTES
        ids = numpy.frombuffer(b"".join(found), "<u4")
        self._behind_space.put(numpy.fromiter(numbers, "i8", len(found)), ids, length)

    def _together(self, strings: list[str], front: str):
        """Encodes many strings at once, ``front`` before each: all ids and how many each has.

        The strings hold no such ``front`` and neither begin nor end with white space, so each
        ``front`` begins a piece; each string's first token begins with it, and no other token does.
        """
        numpy, begins = self._numpy, self._begins[front]
        groups = [strings[i : i + TOGETHER] for i in range(0, len(strings), TOGETHER)]
        joined = [] if self._apart[front] else [front + front.join(group) for group in groups]
        encoded = self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids, lengths = [numpy.zeros(0, "<u4")], [numpy.zeros(0, "i8")]
        for group, found in zip(groups, encoded or repeat(None)):
            own = numpy.array(found.ids, "<u4") if found else ids[0]
            starts = numpy.flatnonzero(begins[own])
            if len(starts) == len(group):
                length = numpy.diff(starts, append=len(own))
            else:
                each = self._library([front + s for s in group])
                own = numpy.frombuffer(b"".join(each), "<u4")
                length = numpy.fromiter(map(len, each), "i8", len(each)) // ID_BYTES
            ids.append(own)
            lengths.append(length)
        return numpy.concatenate(ids), numpy.concatenate(lengths)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One value per text; of a null or empty text an empty one."""
        import pyarrow as pa
        import pyarrow.compute as pc

        numpy = self._numpy
        cuts = [self._cut(text or "") for text in texts]
        fronts = self._library([front for front, _ in cuts])
        behind = [stretches for _, stretches in cuts if stretches is not None]
        if not behind:
            return fronts
        parted = pc.split_pattern(pa.array(behind, pa.large_string()), " ")
        ends = iter(parted.offsets.to_numpy()[1:].tolist())
        found = parted.values.dictionary_encode()
        ids, start, length = self._ids(found.dictionary)
        places, out, first = found.indices.to_numpy(), [], 0
        for front, (_, stretches) in zip(fronts, cuts, strict=True):
            if stretches is not None:
                own, first = places[first : (last := next(ends))], last
                front += ids[_places(numpy, start[own], length[own])].tobytes()
            out.append(front)
        return out

    def _ids(self, stretches: pa.LargeStringArray):
        """Ids of stretches; those of the k-th are ``ids[start[k] : start[k] + length[k]]``."""
        numpy = self._numpy
        if len(self._behind_space) > self._kept // 2:
            self._before, self._behind_space = self._behind_space, _Stretches(numpy)
        known = self._behind_space
        stems, signs = (a.dictionary_encode() for a in _without_signs(numpy, stretches))
        strings = stems.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        strings += [s + " " for s in signs.dictionary.to_pylist()]
        numbers = numpy.fromiter(map(known.__getitem__, strings), "i8", len(strings))
        if len(known) > known.held:
            self._learn()
        both = numpy.empty((len(stretches), 2), "i8")
        both[:, 0] = numbers[stems.indices.to_numpy()]
        both[:, 1] = numbers[len(stems.dictionary) + signs.indices.to_numpy()]
        ids, ends = known.gather(both.ravel())
        length = numpy.diff(ends[1::2], prepend=0)
        return ids, ends[1::2] - length, length


def shared_encoder(vocabulary: str) -> Encoder:
    """One encoder for all tasks that a worker process runs, with what it remembers."""
    return worker_table(("encoder", vocabulary), lambda: Encoder(vocabulary))
