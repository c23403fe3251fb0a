"""Removal of passages that stand elsewhere too, by a sampled suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from topicloom.llm.common import CHUNK_BYTES, mixed, pack_texts, text_bytes, text_chunks, unpack
from topicloom.llm.suffix_sort import sorted_with_prefixes
from topicloom.session import materialize

MIN_BYTES = 400
# Bytes whose hash decides which place of a string is its anchor: at most this many, and half the string.
GRAM = 32
# Bits of a key that hold the place within a piece of text; longer texts are cut into pieces that overlap.
PLACE_BITS = 21
# Strings that are sorted together.
BATCH_ITEMS = 40_000
# Different runs under one key that are sorted together; the strings of more are counted by their digests.
MOST_KINDS = 10_000
# Parts in which the counted strings meet their counts, since one string may be that of most runs.
PARTS = 16


def gram_bytes(size: int) -> int:
    if size < 16:
        raise ValueError("passages have to be 16 bytes long at least")
    return min(GRAM, size // 16 * 8)


def gram_hashes(flat: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each place on."""
    w = flat.astype(np.uint64)
    for k in (1, 2, 4):
        w = w[:-k] | (w[k:] << np.uint64(8 * k))
    n = len(flat) - gram + 1
    total = w[:n] * np.uint64(0x9E3779B97F4A7C15)
    for i, factor in zip(range(8, gram, 8), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        total += w[i : i + n] * np.uint64(factor)
    return mixed(total)


def sliding_smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` keys in a row, from running minima of blocks."""
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(keys) - width + 1], ahead[width - 1 : len(keys)])


def anchored_runs(flat: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``size`` bytes within the texts: place, first and last string start, gram hash.

    The anchor of a string is its leftmost smallest gram, so equal strings have equal anchors at the same distance.
    Neighbouring strings with one anchor are one run.
    """
    empty = np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    long = lengths >= size
    if not long.any():
        return empty, empty, empty, np.zeros(0, np.uint64)
    gram = gram_bytes(size)
    hashes = gram_hashes(flat, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    smallest = sliding_smallest(keys, size - gram + 1)
    turns = np.zeros(len(flat) + 1, np.int32)
    np.add.at(turns, offsets[:-1][long], 1)
    np.add.at(turns, offsets[1:][long] - size + 1, -1)
    starts = np.flatnonzero(np.cumsum(turns[:-1]) > 0)
    at = (smallest[starts] & low).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.append(cut[1:], len(starts)) - 1
    return at[cut], starts[cut], starts[last], hashes[at[cut]]


def _pieces(flat: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The texts as they are, or one very long text in pieces that together hold each of its strings once."""
    most = (1 << PLACE_BITS) - 1
    if len(flat) <= most or len(offsets) != 2:
        yield flat, offsets, 0
        return
    step = most - size
    for start in range(0, len(flat) - size + 1, step):
        piece = flat[start : start + step + size - 1]
        yield piece, np.array([0, len(piece)]), start


_RUNS = "text_hash long, id long, gram long, item binary, place int, low int, high int"


def _runs(docs: DataFrame, size: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            whole, all_offsets = text_bytes(batch.column("text"))
            for flat, offsets, base in _pieces(whole, all_offsets, size):
                place, low, high, _ = anchored_runs(flat, offsets, size)
                # A string has half its bytes after its anchor or before it. Both kinds are runs of their own, named by
                # these bytes, so a gram that most texts share does not bring together what differs around it.
                half = size // 2
                after, before = np.maximum(low, place - half) <= high, low < place - half
                named = np.concatenate([np.ones(after.sum(), bool), np.zeros(before.sum(), bool)])
                low, high = (
                    np.concatenate([np.maximum(low, place - half)[after], low[before]]),
                    np.concatenate([high[after], np.minimum(high, place - half - 1)[before]]),
                )
                place = np.concatenate([place[after], place[before]])
                row = np.searchsorted(offsets, low, side="right") - 1
                data = flat.tobytes()
                items = [hashlib.blake2b(data[a : b + size], digest_size=16).digest() for a, b in zip(low.tolist(), high.tolist())]
                first, last = np.where(named, place, place - half), np.where(named, place + size - half, place + gram_bytes(size))
                keys = [hashlib.blake2b(data[a:b], digest_size=8, person=b"after" if f else b"before").digest() for a, b, f in zip(first.tolist(), last.tolist(), named.tolist())]
                gram = np.frombuffer(b"".join(keys), np.int64)
                begin = offsets[row] - base
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_hash").take(pa.array(row)), batch.column("id").take(pa.array(row)), pa.array(gram), pa.array(items, pa.binary()), *(pa.array((x - begin).astype(np.int32)) for x in (place, low, high))],
                    names=["text_hash", "id", "gram", "item", "place", "low", "high"],
                )

    return docs.mapInArrow(find, _RUNS)


def repeated_starts(texts: list[bytes], lefts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For runs given by their bytes and the distance to their anchor: run and start of every string found in two runs.

    The texts after the anchors and, backwards, the texts before them are brought into order. At distance d from the
    anchor two strings are equal if the orders hold them together for size - d bytes after and d bytes before it.
    """
    count = len(texts)
    lengths = np.array([len(t) for t in texts])
    after, after_prefix = sorted_with_prefixes([t[n:] for t, n in zip(texts, lefts.tolist())])
    before, before_prefix = sorted_with_prefixes([t[:n][::-1] for t, n in zip(texts, lefts.tolist())])
    nearest = lefts - (lengths - size)
    runs, starts = [], []
    for d in range(int(nearest.min()), int(lefts.max()) + 1):
        some = np.flatnonzero((nearest <= d) & (d <= lefts))
        if len(some) < 2:
            continue
        right, left = np.empty(count, np.int64), np.empty(count, np.int64)
        right[after] = np.cumsum(after_prefix < size - d)
        left[before] = np.cumsum(before_prefix < d)
        pair = right[some] * (count + 1) + left[some]
        order = np.argsort(pair, kind="stable")
        equal = pair[order[1:]] == pair[order[:-1]]
        twice = np.zeros(len(some), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        runs.append(some[twice])
        starts.append(lefts[some[twice]] - d)
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(runs), np.concatenate(starts)


def _compared(items: DataFrame, size: int) -> DataFrame:
    """Stretches of string starts (from, to) of runs that occur once but hold strings of other runs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= BATCH_ITEMS and row["gram"] != held[-1]["gram"]:
                    yield from stretches(held)
                    held = []
                # Equal rows of the table give the same run twice.
                if not held or (held[-1]["gram"], held[-1]["item"]) != (row["gram"], row["item"]):
                    held.append(row)
        if held:
            yield from stretches(held)

    def stretches(held: list[dict]) -> Iterator[pa.RecordBatch]:
        lefts = np.array([r["place"] - r["low"] for r in held])
        run, start = repeated_starts([r["bytes"] for r in held], lefts, size)
        once = np.array([r["n"] == 1 for r in held])
        run, start = run[once[run]], start[once[run]]
        if not len(run):
            return
        order = np.lexsort((start, run))
        run, start = run[order], start[order]
        first = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)]))
        last = np.append(first[1:], len(run)) - 1
        low = np.array([r["low"] for r in held])
        yield pa.RecordBatch.from_arrays(
            [pa.array([held[i]["text_hash"] for i in run[first]], pa.int64()), pa.array([held[i]["id"] for i in run[first]], pa.int64()), pa.array((low[run[first]] + start[first]).astype(np.int32)), pa.array((low[run[last]] + start[last]).astype(np.int32))],
            names=["text_hash", "id", "from", "to"],
        )

    dealt = items.repartition("gram").sortWithinPartitions("gram", "item")
    return dealt.mapInArrow(compare, "text_hash long, id long, from int, to int")


def _cut_out(requests: DataFrame, packed: DataFrame, size: int) -> DataFrame:
    """The bytes of the requested runs; ``requests`` has one row per text with an array of runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("gram", pa.int64()), ("item", pa.binary()), ("n", pa.int64()), ("text_hash", pa.int64()), ("id", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("bytes", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("packed", "runs", "text_hash", "id"))
            for blob, runs, text_hash, key in zip(*columns):
                data = unpack(blob)
                rows += [{**r, "text_hash": text_hash, "id": key, "bytes": data[r["low"] : r["high"] + size]} for r in runs]
                held += len(data)
                if held >= CHUNK_BYTES:
                    yield from pa.Table.from_pylist(rows, schema=schema).to_batches()
                    rows, held = [], 0
        yield from pa.Table.from_pylist(rows, schema=schema).to_batches()

    joined = packed.join(requests, ["text_hash", "id"]).select("text_hash", "id", "packed", "runs")
    return joined.mapInArrow(cut, "gram long, item binary, n long, text_hash long, id long, place int, low int, bytes binary")


def _counted(requests: DataFrame, packed: DataFrame, size: int) -> DataFrame:
    """The same as _compared for keys of any number of runs: every string is a row, counted by key and digest."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("packed", "runs", "text_hash", "id"))
            for blob, runs, text_hash, key in zip(*columns):
                data = unpack(blob)
                for r in runs:
                    strings = [hashlib.blake2b(data[s : s + size], digest_size=16).digest() for s in range(r["low"], r["high"] + 1)]
                    n = len(strings)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["gram"]] * n, pa.int64()), pa.array(strings, pa.binary()), pa.array([r["n"] == 1] * n), pa.array([text_hash] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array(range(r["low"], r["high"] + 1), pa.int32())],
                        names=["gram", "string", "once", "text_hash", "id", "from"],
                    )

    joined = packed.join(requests, ["text_hash", "id"]).select("text_hash", "id", "packed", "runs")
    strings = materialize(joined.mapInArrow(digest, "gram long, string binary, once boolean, text_hash long, id long, from int"), "suffix-strings")
    twice = strings.groupBy("gram", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = twice.select("gram", "string", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part"))
    asked = strings.where("once").withColumn("part", F.pmod(F.xxhash64("text_hash", "id", "from"), F.lit(PARTS)))
    return asked.join(twice, ["gram", "string", "part"], "left_semi").selectExpr("text_hash", "id", "`from`", "`from` AS to")


def repeated_stretches(keyed: DataFrame, size: int) -> DataFrame:
    """text_hash, id, stretches: for every text with repeated strings, where these start (from, to)."""
    runs = materialize(_runs(keyed, size), "suffix-runs")
    grams = materialize(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "suffix-grams")
    shared = materialize(runs.join(grams, "gram", "left_semi"), "suffix-shared")
    sample = F.min(F.struct("text_hash", "id", "place", "low", "high"))
    items = shared.groupBy("gram", "item").agg(F.count(F.lit(1)).alias("n"), sample.alias("one"))
    items = materialize(items, "suffix-items")
    others = materialize(items.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "suffix-kinds")

    def asked(some: DataFrame) -> DataFrame:
        return some.groupBy(F.col("one.text_hash").alias("text_hash"), F.col("one.id").alias("id")).agg(
            F.collect_list(F.struct("gram", "item", "n", "one.place", "one.low", "one.high")).alias("runs")
        )

    few = items.join(others.where(F.col("kinds") <= MOST_KINDS).select("gram"), "gram", "left_semi")
    partly = _compared(_cut_out(asked(few), pack_texts(keyed, "text"), size), size)
    hot = others.where(F.col("kinds") > MOST_KINDS).select("gram")
    if not hot.isEmpty():
        # At most one key for every MOST_KINDS runs.
        many = items.join(F.broadcast(hot), "gram", "left_semi")
        partly = partly.union(_counted(asked(many), pack_texts(keyed, "text"), size))
    whole = shared.join(items.where("n > 1").select("gram", "item"), ["gram", "item"], "left_semi").selectExpr("text_hash", "id", "low AS from", "high AS to")
    return partly.union(whole).groupBy("text_hash", "id").agg(F.collect_list(F.struct("from", "to")).alias("stretches"))


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, min_words: int = 0) -> DataFrame:
    """All columns of ``docs`` and n_bytes, n_removed, n_spans, kept (binary) for every row.

    Texts are UTF-8 bytes (null: empty). Every byte covered by a string of ``min_bytes`` bytes that starts anywhere
    else too, in the same text or another row, is removed; strings are judged on the input and never cross texts. ``kept``
    holds the other bytes in a row. With ``min_words`` a covered stretch stays if it has fewer words (runs between ASCII
    white space). Texts shorter than ``min_bytes`` stay whole, equal rows repeat each other, ids may be
    null or repeated, an empty table gives an empty table; columns named like the new ones are replaced.

    The suffixes that are sorted are the texts from the anchors on: of each ``min_bytes`` bytes the place with the smallest
    gram. Runs of strings with one anchor that are equal as a whole are counted and need no sorting; the rest meets
    by half of its bytes, and only these runs' bytes travel. Where more than MOST_KINDS runs meet, the digests of their
    strings are counted instead, so no key is held by one task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.xxhash64(text).alias("text_hash"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")).alias("id"), text.alias("text"))
    found = repeated_stretches(keyed, min_bytes)
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    marked = docs.select(*kept).withColumns({"__hash": F.xxhash64(text), "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), "__text": text})
    named = found.select(F.col("text_hash").alias("__hash"), F.col("id").alias("__id"), "stretches")
    # The text column is told apart from its packed bytes only where it is null.
    bare = pack_texts(marked.withColumn("text", F.when(F.col("text").isNotNull(), F.lit(""))), "__text")
    joined = bare.join(named, ["__hash", "__id"], "left").drop("__hash", "__id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nulls = batch.column("text").is_null().to_pylist()
            start, held, rows = 0, 0, []
            for i, (blob, stretches) in enumerate(zip(batch.column("packed").to_pylist(), batch.column("stretches").to_pylist())):
                data = unpack(blob)
                rows.append((None if nulls[i] else data.decode(), *kept_of(data, stretches)))
                held += len(data)
                if held >= CHUNK_BYTES or i == batch.num_rows - 1:
                    yield shown(batch.slice(start, len(rows)), rows)
                    start, held, rows = i + 1, 0, []

    def kept_of(data: bytes, stretches: list[dict] | None) -> tuple[int, int, int, bytes]:
        # Where text is covered: stretches in order of their starts, joined where they touch.
        spans: list[list[int]] = []
        for r in sorted(stretches or (), key=lambda r: r["from"]):
            if spans and r["from"] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], r["to"] + min_bytes)
            else:
                spans.append([r["from"], r["to"] + min_bytes])
        if min_words:
            spans = [s for s in spans if len(data[s[0] : s[1]].split()) >= min_words]
        edges = [0, *(x for s in spans for x in s), len(data)]
        stay = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        return len(data), len(data) - len(stay), len(spans), stay

    def shown(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        columns = {c: batch.column(c) for c in batch.schema.names if c not in ("packed", "stretches")}
        texts, *numbers, stays = zip(*rows)
        columns["text"] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*columns.values(), *(pa.array(x, pa.int64()) for x in numbers), pa.array(stays, pa.binary())], names=[*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    schema = StructType([docs.schema[c] for c in kept]).add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType()).add("kept", BinaryType())
    return joined.mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, min_words: int = 0) -> DataFrame:
    """``docs`` with the texts that remove_repeats leaves, and n_chars (if there) counted anew.

    A character of which only a part was covered goes as a whole. Rows without repeats, null texts included, stay as
    they are; a text of which nothing is left is empty.
    """
    named = {c: f"__{c}" for c in docs.columns if c in ("n_bytes", "n_removed", "n_spans", "kept")}
    found = remove_repeats(docs.withColumnsRenamed(named), min_bytes, min_words)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("text").to_pylist()
            texts = [t if not n else k.decode("utf-8", "ignore") for t, n, k in zip(whole, batch.column("n_removed").to_pylist(), batch.column("kept").to_pylist())]
            names = [c for c in batch.schema.names if c not in ("n_removed", "kept")]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)

    rows = found.drop("n_bytes", "n_spans")
    plain = rows.mapInArrow(decode, StructType([f for f in rows.schema if f.name not in ("n_removed", "kept")]))
    plain = plain.withColumnsRenamed({new: old for old, new in named.items()})
    if "n_chars" in docs.columns:
        count = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        plain = plain.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return plain.select(*docs.columns)
