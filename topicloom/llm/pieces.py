"""Texts cut into units that tokenizers treat alone, so that each distinct unit of a chunk is encoded once."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from topicloom.llm.common import text_bytes

# White space before which a text may be cut.
BLANKS = b" \t\n\r"


def once(key: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept for the life of the worker process.

    Functions travel by value, so their module's variables last for one task only.
    """
    store = sys.modules.setdefault("_topicloom_kept", types.ModuleType("_topicloom_kept")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of the ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _after_white(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each position is white space, in Unicode or for Python."""

    def back(n: int) -> np.ndarray:
        return np.where(at >= n, flat[np.maximum(at - n, 0)], 0)

    last, middle, lead = back(1), back(2), back(3)
    plain = (last == 32) | ((last >= 9) & (last <= 13)) | ((last >= 28) & (last <= 31))
    two = (middle == 0xC2) & ((last == 0x85) | (last == 0xA0))
    general = (lead == 0xE2) & (middle == 0x80) & (((last >= 0x80) & (last <= 0x8A)) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    rare = ((lead == 0xE1) & (middle == 0x9A) & (last == 0x80)) | ((lead == 0xE2) & (middle == 0x81) & (last == 0x9F)) | ((lead == 0xE3) & (middle == 0x80) & (last == 0x80))
    return plain | two | general | rare


def unit_codes(column: pa.Array, cuts: bytes = BLANKS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of the units of all texts in order, where each text begins among them, and the distinct units.

    A text is cut before every character of ``cuts`` that follows one which is no white space. Pre-tokens of
    byte-level vocabularies never reach over such a place and do not look past it, so units can be encoded alone. The
    units of a text joined are the text; an empty or null text has none.
    """
    flat, offsets = text_bytes(column)
    wanted = np.zeros(len(flat), bool)
    for c in cuts:
        wanted |= flat == c
    at = np.flatnonzero(wanted)
    at = at[~_after_white(flat, at)]
    begin = np.zeros(len(flat), bool)
    begin[at] = True
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    begins = np.flatnonzero(begin)
    bounds = np.append(begins, len(flat)).astype(np.int64)
    held = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])
    coded = held.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), np.searchsorted(begins, offsets), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


class Remembered:
    """Lists of ids by unit, so that a task encodes a unit once while it has room for it."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 18):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def ids_of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All remembered ids, and where among them the ids of each of ``units`` (all different) begin and how many there are."""
        if len(self.place) > self.limit:
            self.forget()
        fresh = [u for u in units if u not in self.place]
        if fresh:
            ids, lengths = self.encode(fresh)
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        at = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))
        return self.ids, offsets_of(self.lengths)[at], self.lengths[at]


def varint(number: int) -> bytes:
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    return bytes([*out, number])


def field(number: int, value: bytes | int) -> bytes:
    """One field of a protocol-buffer message: bytes with their length, or a whole number."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def flat_ids(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the lists and the length of each list."""
    lists = list(lists)
    lengths = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.int64, int(lengths.sum())), lengths


def sized(batches: Iterator[pa.RecordBatch], lengths: Callable[[pa.RecordBatch], np.ndarray], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches whose lengths sum to about ``limit`` at most (one row at least)."""
    for batch in batches:
        total, start = np.cumsum(lengths(batch), dtype=np.int64), 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """``batch`` with one more column at the end; a column of that name gives way."""
    kept = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], names=[*kept, name])
