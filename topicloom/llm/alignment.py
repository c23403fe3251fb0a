"""Alignment of two tokenizers over the same bytes, by pointer jumping.

Tokens of both sides lie on one line of bytes. Every token points to its farthest-right overlapping token (itself if
none reaches farther; where two end together, to the one of side A). Doubling the pointers until nothing changes leads
every token to the last A token of its component, which names the component: the groups are the tokens between two
places where both sides end. All tokens of the distinct units of a chunk of texts move at once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.llm.common import text_chunks
from topicloom.llm.pieces import BLANKS, field, flat_ids, offsets_of, once, spans, unit_codes
from topicloom.session import materialize

# Bytes of text whose pairs are looked up together.
CHUNK = 3 << 20
# Units that one call of the byte-level tokenizer gets as one text.
LINE_UNITS = 512

_ADDED = "n_a long, n_b long, n_groups long, n_links long, groups string, chunk long, place int, links binary, chunk_pairs array<long>, chunk_documents array<long>"


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _letter_bytes() -> dict[str, int]:
    """The usual alphabet of byte-level vocabularies: printable Latin-1 characters stand for their own byte, the other
    bytes in order for the characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer with the bytes of its tokens; ``encode`` gives the ids of all units and how many each has."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = offsets_of(self.lengths)[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.encode = encode

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[spans(self.starts[ids], self.lengths[ids])]


def byte_level(path: str) -> Side:
    """A byte-level vocabulary file (.json); strings of special tokens inside texts are plain text."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    special = {t["id"]: t["content"].encode() for t in given.get("added_tokens", [])}
    alphabet, tokens = _letter_bytes(), [b""] * model.get_vocab_size()
    for piece, i in model.get_vocab().items():
        tokens[i] = special[i] if i in special else bytes(alphabet[c] for c in piece)

    def ids_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids(e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False))

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Units that begin with a blank and end without one can stand in one text: its tokens end where they end.
        alone = np.array([u[0] not in " \t\n" or u[-1].isspace() for u in units], bool)
        cuts = np.unique(np.concatenate([np.flatnonzero(alone), np.flatnonzero(alone) + 1, np.arange(0, len(units), LINE_UNITS), [len(units)]])).tolist()
        ids, _ = ids_of(["".join(units[s:e]) for s, e in zip(cuts, cuts[1:])])
        ends = np.cumsum(side.lengths[ids])
        wanted = np.cumsum([len(u) if u.isascii() else len(u.encode()) for u in units])
        at = np.searchsorted(ends, wanted)
        if len(ends) != (at[-1] + 1 if len(at) else 0) or not np.array_equal(ends[at], wanted):
            return ids_of(units)
        return ids, np.diff(at, prepend=-1)

    side = Side(tokens, encode)
    return side


def pieces(path: str) -> tuple[Side, bytes]:
    """A piece model that escapes blanks, without the blank it puts in front, and the characters before which texts may be cut."""
    import sentencepiece

    with open(path, "rb") as f:
        # A field that comes again overrides the first: no dummy prefix.
        model = sentencepiece.SentencePieceProcessor(model_proto=f.read() + field(3, field(3, 0)))
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    spelled = [t.decode("utf-8", "replace") for t in tokens]
    joined = {after for t in spelled for before, after in zip(t, t[1:]) if not before.isspace()}
    cuts = bytes(c for c in BLANKS if chr(c) not in joined)
    return Side(tokens, lambda units: flat_ids(model.encode(units, num_threads=1))), cuts


def components(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The component (from 0, in order) of each A token and of each B token; both sides cover the same bytes in order."""
    n = len(a_start)
    reach_b = np.searchsorted(b_start, a_end, "left") - 1
    reach_a = np.searchsorted(a_start, b_end, "left") - 1
    to = np.concatenate([
        np.where(b_end[reach_b] > a_end, n + reach_b, np.arange(n)) if n else np.zeros(0, np.int64),
        np.where(a_end[reach_a] >= b_end, reach_a, n + np.arange(len(b_start))) if n else np.zeros(0, np.int64),
    ])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    last, label = np.unique(to, return_inverse=True)
    return label[:n], label[n:]


class UnitTable:
    """Everything about the distinct units of a chunk, in arrays by unit."""

    def __init__(self, units: list[str], a: Side, b: Side):
        raw = [u.encode() for u in units]
        size = np.array([len(r) for r in raw], np.int64)
        flat, begin = np.frombuffer(b"".join(raw), np.uint8), offsets_of(size)
        fine = np.ones(len(units), bool)
        sides = []
        for side in (a, b):
            ids, count = side.encode(units)
            of = np.repeat(np.arange(len(units)), count)
            same = np.bincount(of, side.lengths[ids], len(units)).astype(np.int64) == size
            held = same[of]
            differ = side.spelled(ids[held]) != flat[spans(begin[:-1][same], size[same])]
            same[np.repeat(np.flatnonzero(same), size[same])[differ]] = False
            fine &= same
            sides.append((ids, of))
        (a_ids, a_of), (b_ids, b_of) = [(ids[fine[of]], of[fine[of]]) for ids, of in sides]
        a_end, b_end = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
        a_start, b_start = a_end - a.lengths[a_ids], b_end - b.lengths[b_ids]
        a_group, b_group = components(a_start, a_end, b_start, b_end)
        first = np.searchsorted(b_end, a_start, "right")
        wide = np.searchsorted(b_start, a_end, "left") - first
        link_a = np.repeat(np.arange(len(a_ids)), wide)
        pair = (a_ids[link_a] << 32) | b_ids[spans(first, wide)]
        self.pairs, self.codes = np.unique(pair, return_inverse=True)
        n = len(units)
        group_of = a_of[np.unique(a_group, return_index=True)[1]] if len(a_group) else a_of
        self.fine = fine
        self.n_a, self.n_b = np.bincount(a_of, minlength=n), np.bincount(b_of, minlength=n)
        self.n_groups, self.n_links = np.bincount(group_of, minlength=n), np.bincount(a_of[link_a], minlength=n)
        self.link_start = offsets_of(self.n_links)[:-1]
        self.shown = _shown(a_ids, a_group, b_ids, b_group, offsets_of(np.bincount(a_of, minlength=n) + np.bincount(b_of, minlength=n)))


def _shown(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The groups of each unit as text, each group with a semicolon behind it; a unit has the tokens between two bounds."""
    if not len(a_ids):
        return [""] * (len(bounds) - 1)
    # A number is followed by the sign that tells what comes next: a comma, at the end of side A a bar, of side B a semicolon.
    ids, group, side = np.concatenate([a_ids, b_ids]), np.concatenate([a_group, b_group]), np.repeat([0, 1], [len(a_ids), len(b_ids)])
    order = np.lexsort((side, group))
    ids, key = ids[order], 2 * group[order] + side[order]
    signs = np.where(np.diff(key, append=-1) != 0, np.where(key % 2, ord(";"), ord("|")), ord(","))
    digits = [str(i).encode() for i in range(int(ids.max()) + 1)]
    wide = np.array([len(d) for d in digits], np.int64)
    table = np.frombuffer(b"".join(d + b"," for d in digits), np.uint8)
    lengths = wide[ids] + 1
    line = table[spans(offsets_of(wide + 1)[ids], lengths)]
    ends = offsets_of(lengths)
    line[ends[1:] - 1] = signs
    text, cuts = line.tobytes().decode("ascii"), ends[bounds].tolist()
    return [text[s:e] for s, e in zip(cuts, cuts[1:])]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = offsets_of(values)
    return total[first[1:]] - total[first[:-1]]


def group_tokens(docs: DataFrame, text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``docs`` with the aligned tokens of a blank followed by the text: one row per document.

    n_a, n_b, n_groups, n_links: tokens of either side, groups, and pairs of overlapping token occurrences. groups:
    ``a1,a2|b1;a3|b2,b3`` (ids of A and B by group, in order). chunk, place, links, chunk_pairs and chunk_documents
    are what ``score_links`` reads: documents are worked on in chunks, links holds the pairs of a document with their
    number, the first row of a chunk lists the chunk's pairs (A id times 2^32 plus B id) and how many of its documents
    hold them.

    Texts that are null or empty, or whose tokens of either side do not spell the blank and the text, have no tokens:
    zeros, '' and no links. Rows stay apart whatever their ids, repeated or null. Columns of ``docs`` named like an
    added one give way. Texts are aligned whole; units between white space, where neither side reaches across, are
    encoded once per chunk.
    """
    a_path, b_path = a_path or _path("byte_bpe_50k.json"), b_path or _path("piece_bpe_32k.model")
    added = T.StructType.fromDDL(_ADDED)
    kept = [f for f in docs.schema.fields if f.name not in added.names]
    # The text may itself be one of the columns that give way.
    source = docs.select(F.col(text_col).cast("string").alias("__text"), *(f.name for f in kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        a = once(f"byte level {a_path}", lambda: byte_level(a_path))
        b, cuts = once(f"pieces {b_path}", lambda: pieces(b_path))
        codec = pa.Codec("zstd", compression_level=1)
        chunk = TaskContext.get().partitionId() << 32
        for batch in text_chunks(batches, "__text", CHUNK):
            n = batch.num_rows
            texts = pc.fill_null(batch.column("__text"), "").cast(pa.large_string())
            some = pc.greater(pc.binary_length(texts), 0)
            texts = pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())), texts)
            codes, first, units = unit_codes(texts, cuts)
            table = UnitTable(units, a, b)
            bad = _sums(~table.fine[codes], first) > 0
            of = np.repeat(np.arange(n), np.diff(first))
            use = ~bad[of]
            codes, of = codes[use], of[use]
            first = np.searchsorted(of, np.arange(n + 1))
            links = table.codes[spans(table.link_start[codes], table.n_links[codes])]
            keys, times = np.unique(np.repeat(of, table.n_links[codes]) * max(1, len(table.pairs)) + links, return_counts=True)
            row, code = np.divmod(keys, max(1, len(table.pairs)))
            held, code = np.unique(code, return_inverse=True)
            ends, packed = np.searchsorted(row, np.arange(n + 1)), []
            code, times = code.astype(np.int32), times.astype(np.int32)
            for s, e in zip(ends[:-1], ends[1:]):
                body = code[s:e].tobytes() + times[s:e].tobytes()
                packed.append(len(body).to_bytes(8, "little") + codec.compress(body, asbytes=True) if e > s else None)
            shown = ["".join(map(table.shown.__getitem__, codes[s:e].tolist()))[:-1] for s, e in zip(first[:-1], first[1:])]
            lists = pa.array([0] + [len(held)] * n, pa.int32())
            only = pa.array([False] + [True] * (n - 1), pa.bool_())
            in_chunk = [pa.ListArray.from_arrays(lists, pa.array(x, pa.int64()), mask=only) for x in (table.pairs[held], np.bincount(code, minlength=len(held)))]
            sums = [pa.array(_sums(x[codes], first), pa.int64()) for x in (table.n_a, table.n_b, table.n_groups, table.n_links)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *sums, pa.array(shown, pa.string()), pa.array(np.full(n, chunk)), pa.array(np.arange(n, dtype=np.int32)), pa.array(packed, pa.binary()), *in_chunk],
                names=[*(f.name for f in kept), *added.names],
            )
            chunk += 1

    return source.mapInArrow(run, T.StructType([*kept, *added.fields]))


def _asked(grouped: DataFrame) -> DataFrame:
    """chunk, code, pair, documents: the pairs of each chunk."""
    rows = grouped.where(F.col("chunk_pairs").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("chunk_pairs", "chunk_documents")).alias("code", "z"))
    return rows.select("chunk", "code", F.col("z.chunk_pairs").alias("pair"), F.col("z.chunk_documents").alias("documents"))


def link_counts(grouped: DataFrame) -> DataFrame:
    """a_id, b_id, documents, best: in how many documents of ``group_tokens`` a pair is linked, and whether no pair of its A id is in more."""
    counts = _asked(grouped).groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = materialize(counts.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b_id"), "documents"), "link-counts")
    # One row per token of vocabulary A at most, so its size is bounded by the vocabulary.
    most = counts.groupBy("a_id").agg(F.max("documents").alias("most"))
    return counts.join(F.broadcast(most), "a_id").select("a_id", "b_id", "documents", (F.col("documents") == F.col("most")).alias("best"))


def score_links(grouped: DataFrame) -> DataFrame:
    """``grouped`` (a written result of ``group_tokens``, read twice here) with n_best and count_sum in place of the working columns.

    n_best: links of the document whose pair is in as many documents as any pair of its A id; count_sum: the documents
    of its links' pairs, summed over links. Both are 0 without links. Every pair is asked for once per chunk.
    """
    counts = link_counts(grouped).select(F.shiftleft(F.col("a_id").cast("bigint"), 32).bitwiseOR(F.col("b_id").cast("bigint")).alias("pair"), F.col("documents").alias("count"), "best")
    answers = _asked(grouped).drop("documents").join(counts, "pair").select("chunk", "code", "count", "best")
    kept = [c for c in grouped.columns if c not in ("chunk", "place", "links", "chunk_pairs", "chunk_documents")]
    schema = T.StructType([*(grouped.schema[c] for c in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        code = answers.column("code").to_numpy()
        count, best = np.zeros(len(code), np.int64), np.zeros(len(code), bool)
        count[code] = answers.column("count").to_numpy()
        best[code] = answers.column("best").to_numpy(zero_copy_only=False)
        codec, sums = pa.Codec("zstd"), []
        for links in rows.column("links").to_pylist():
            if links is None:
                sums.append((0, 0))
                continue
            codes, times = np.frombuffer(codec.decompress(links[8:], int.from_bytes(links[:8], "little"), asbytes=True), np.int32).reshape(2, -1)
            sums.append((int(times[best[codes]].sum()), int(count[codes] @ times.astype(np.int64))))
        return pa.table([*(rows.column(c) for c in kept), *(pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1))], names=schema.names)

    narrow = grouped.select(*(F.col(c).alias(c) for c in (*kept, "chunk", "links")))
    answers = answers.select(*(F.col(c).alias(c) for c in answers.columns))
    return narrow.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
