"""Byte-level BPE through a piece model that is written straight from the vocabulary's ranks.

Each byte becomes a letter of its own, each token a piece of these letters whose score is its negative rank, and the
model leaves texts as they are. The best-scored merge is then the lowest rank, leftmost first, so pre-tokens get the
ids that the ranks give them; the ids are the ranks themselves. Decoding maps ids back to their bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from topicloom.llm.common import text_chunks
from topicloom.llm.pieces import Remembered, field, flat_ids, offsets_of, once, sized, spans, unit_codes, with_column

# Token ids decoded at once.
CHUNK_IDS = 1 << 20
# Letters that stand for bytes: U+0100 to U+01FF.
FIRST_LETTER = 0x100
# Numbers of the piece-model format: piece types, the kind of model, and unset ids.
NORMAL, UNKNOWN, BPE = 1, 2, 2


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def letters(data: bytes) -> str:
    """One letter per byte."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + FIRST_LETTER).astype("<u2").tobytes().decode("utf-16-le")


def piece_model(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised piece model; piece number = place in rank order, the unknown piece last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + field(3, kind))

    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary has no token for the bytes {missing[:5]}")
    if max(ranks.values()) >= 1 << 24:
        raise ValueError("ranks from 2^24 on are no exact scores")
    pieces = [piece(letters(t), -float(ranks[t]), NORMAL) for t in sorted(ranks, key=ranks.get)]
    trainer = field(3, BPE) + field(4, len(pieces) + 1) + field(40, len(pieces))
    # Identity: no dummy prefix, no removal of blanks, no escaping of blanks.
    normalizer = field(1, b"identity") + field(3, 0) + field(4, 0) + field(5, 0)
    return b"".join(pieces) + piece("<unk>", 0.0, UNKNOWN) + field(2, trainer) + field(3, normalizer)


class Codec:
    """Encodes pre-tokens with a piece model made from ``ranks`` and decodes ids by the inverse mapping."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        tokens = sorted(ranks, key=ranks.get)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_model(ranks))
        self.pattern = regex.compile(pattern)
        self.ids = np.array([ranks[t] for t in tokens], np.int32)
        # A pre-token that is a token itself has that one id, even where merges do not lead to it.
        self.whole = {}
        for number, (token, found) in enumerate(zip(tokens, self.model.encode([letters(t) for t in tokens], num_threads=1))):
            if found != [number]:
                self.whole[letters(token)] = [number]
        top = int(self.ids.max()) + 1
        self.lengths = np.full(top, -1, np.int64)
        self.lengths[self.ids] = [len(t) for t in tokens]
        self.starts = np.zeros(top, np.int64)
        self.starts[self.ids] = offsets_of(self.lengths[self.ids])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        # Plain letters, with a blank before them or none, are one pre-token.
        split = [[t] if t.isascii() and (t[1:] if t[:1] == " " else t).isalpha() else self.pattern.findall(t) for t in texts]
        distinct = list({p: None for row in split for p in row})
        ends = offsets_of(np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in distinct), np.int64, len(distinct))).tolist()
        line = letters("".join(distinct).encode())
        mapped = [line[a:b] for a, b in zip(ends, ends[1:])]
        found = dict(zip(distinct, self.model.encode(mapped, num_threads=1)))
        for p, m in zip(distinct, mapped) if self.whole else ():
            found[p] = self.whole.get(m, found[p])
        ids, lengths = flat_ids(found[row[0]] if len(row) == 1 else [i for p in row for i in found[p]] for row in split)
        return self.ids[ids], lengths

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and how many each has; an id that is not in the vocabulary is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or (self.lengths[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.lengths[ids]
        return self.bytes[spans(self.starts[ids], lengths)], lengths


def load_codec(path: str, pattern: str) -> Codec:
    return once(f"codec {path} {pattern}", lambda: Codec(read_ranks(path), pattern))


def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in schema.fields if f.name != name), T.StructField(name, kind)])


def encode_texts(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with the token ids of the whole text in ``ids_col`` (array of int).

    ``path`` names a file of byte-level ranks, ``pattern`` what splits texts into pre-tokens. Special tokens do not
    exist: their strings are ordinary text. Null and empty texts have the empty array. Rows are independent, so
    repeated rows, null ids and ties need no rule; all other columns stay, one named like ``ids_col`` gives way. Texts
    of any length are encoded whole; a task encodes each distinct unit between white
    space once while it has room to remember it.
    """
    path, pattern = path or vocabulary_path(), pattern or _default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(load_codec(path, pattern).encode)
        for batch in text_chunks(batches, text_col):
            codes, first, units = unit_codes(batch.column(text_col))
            ids, starts, lengths = known.ids_of(units)
            rows = np.concatenate([[0], np.cumsum(lengths[codes])])[first]
            flat = ids[spans(starts[codes], lengths[codes])]
            yield with_column(batch, ids_col, pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(flat, pa.int32())))

    return docs.mapInArrow(run, _with(docs.schema, ids_col, T.ArrayType(T.IntegerType(), True)))


def decode_ids(rows: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``rows`` with the bytes that ``ids_col`` (array of int) stands for in ``bytes_col``.

    Null arrays give null, empty ones no bytes; a null or unknown id inside an array is an error. The bytes need not
    be UTF-8 where ids were cut from their text. All other columns stay, one named like ``bytes_col`` gives way.
    """
    path, pattern = path or vocabulary_path(), _default_pattern()

    def count(batch: pa.RecordBatch) -> np.ndarray:
        import pyarrow.compute as pc

        return pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path, pattern)
        for batch in sized(batches, count, CHUNK_IDS):
            column, wide = batch.column(ids_col), count(batch)
            values = column.flatten()
            if values.null_count:
                raise ValueError("a null id has no bytes")
            flat, lengths = codec.decode(values.to_numpy(zero_copy_only=False).astype(np.int64))
            ends = np.concatenate([[0], np.cumsum(lengths)])[offsets_of(wide)]
            held = pa.Array.from_buffers(pa.large_binary(), len(wide), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])
            out = pa.array([v if ok else None for v, ok in zip(held.to_pylist(), column.is_valid().to_pylist())], pa.binary()) if column.null_count else held.cast(pa.binary())
            yield with_column(batch, bytes_col, out)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, _with(rows.schema, bytes_col, T.BinaryType()))

