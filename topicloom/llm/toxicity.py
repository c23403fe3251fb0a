"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from topicloom.llm.common import mixed, text_chunks, word_codes
from topicloom.session import materialize

# Bound of the fitted model: labelled rows in the sample.
MAX_EXAMPLES = 16_000
# Word beginnings of these lengths (in bytes) are terms beside the words themselves, if toxic texts have them more often.
PREFIXES = (4, 5, 6, 7, 8)
# Every word of two examples or more is a term. Its TF-IDF value is multiplied by FLOOR, and by up to 1 where its share
# of toxic texts is high: 1 - (c / g)^2 for a deviation of g > c. The c is the one of CAUTION that does best between
# two halves of the examples.
FLOOR = 0.05
# Words of more than this share of the examples, and this many, are stop words: they have no floor.
STOP_SHARE = 1 / 32
STOP_TEXTS = 200
CAUTION = (1.5, 2.5, 4.0)
LEAST_PREFIX = 2.0
NEIGHBOURS = 15
BLOCK = 2048
# Blocks that are opened first, for a lower bound of the k-th cosine.
FIRST_BLOCKS = 1
THRESHOLD = 0.7
# Votes weigh similarity to this power; the prior counts as one vote of this weight.
POWER = 6
PRIOR_WEIGHT = 0.05
# Near-copies among the examples of one label count once: texts that share one of MARKS min-hashes of word pairs with a
# text of the same label, and this share of all their pairs.
MARKS = 4
COPY_SHARE = 0.6
# Examples of each half that are scored to choose the caution, and to calibrate.
TRIALS = 400
CALIBRATED = 3000
# Bytes of text whose terms are laid out at once (a term takes some hundred bytes there), and words whose terms are kept.
SCORE_BYTES = 256 << 10
KEPT_WORDS = 100_000

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row and word number of each word of the texts, and the distinct words: runs of letters, in lower case."""
    return word_codes(column, _LETTERS)


def terms_of(word: bytes) -> list[bytes]:
    """The word itself and its beginnings, marked as such."""
    return [word, *(b"^" + word[:n] for n in PREFIXES if len(word) > n)]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of each text's pairs of neighbouring words, and min-hashes of them, which near-copies mostly share."""
    for batch in text_chunks(batches):
        rows, codes, words = words_of(batch.column("text"))
        hashed = hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
        first = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        sets, marks = [], [np.zeros(batch.num_rows, np.uint64) for _ in range(MARKS)]
        for i in range(batch.num_rows):
            own = hashed[codes[first[i] : first[i + 1]]]
            pairs = np.unique(mixed(own[:-1] * np.uint64(3) + own[1:]) if len(own) > 1 else mixed(np.append(own, np.uint64(0))))
            sets.append(pairs.view(np.int64))
            for j in range(MARKS):
                marks[j][i] = mixed(pairs + np.uint64(j + 1)).min()
        ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        marked = pa.array(np.column_stack(marks).reshape(-1).view(np.int64))
        marked = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * MARKS, pa.int32()), marked)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("toxic"), held, marked], names=["doc_id", "text", "toxic", "pairs", "marks"])


def _without_copies(rows: DataFrame) -> DataFrame:
    """The examples without those that are near-copies of another one of their label; each copy is verified."""
    first = F.min_by(F.struct("doc_id", "text", "pairs", "marks"), "doc_id").alias("one")
    rows = materialize(rows.groupBy(F.md5("text").alias("key"), "toxic").agg(first).select("key", "toxic", "one.*"), "toxicity-texts")
    marks = rows.select("key", "toxic", "doc_id", F.posexplode("marks").alias("j", "mark"))
    heads = marks.groupBy("j", "mark", "toxic").agg(F.min(F.struct("doc_id", "key")).alias("head"))
    met = marks.join(heads, ["j", "mark", "toxic"]).where("key <> head.key").select("key", "toxic", F.col("head.key").alias("other")).distinct()
    left = rows.select("key", "toxic", F.col("pairs").alias("mine"))
    right = rows.select(F.col("key").alias("other"), "toxic", F.col("pairs").alias("theirs"))
    common = F.size(F.array_intersect("mine", "theirs"))
    alike = common >= (F.size("mine") + F.size("theirs") - common) * COPY_SHARE
    copies = met.join(left, ["key", "toxic"]).join(right, ["other", "toxic"]).where(alike).select("key", "toxic").distinct()
    return rows.join(copies, ["key", "toxic"], "left_anti").select("doc_id", "text", "toxic")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and toxic texts that hold a term, in each half of the examples."""
    for batch in text_chunks(batches):
        rows, codes, words = words_of(batch.column("text"))
        toxic, half = batch.column("toxic").to_numpy(), batch.column("half").to_numpy()
        numbers: dict[bytes, int] = {}
        listed = [[numbers.setdefault(t, len(numbers)) for t in terms_of(w)] for w in words]
        doc, term, _ = _occurrences(rows, codes, listed, len(numbers))
        columns = []
        for h in (0, 1):
            mine = half[doc] == h
            columns.append(np.bincount(term[mine], minlength=len(numbers)))
            columns.append(np.bincount(term[mine], weights=toxic[doc[mine]].astype(float), minlength=len(numbers)).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(list(numbers), pa.binary()), *[pa.array(c, pa.int64()) for c in columns]], names=["term", "n0", "bad0", "n1", "bad1"])


def _occurrences(rows: np.ndarray, codes: np.ndarray, listed: list[list[int]], terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of every term of the texts; ``listed`` has the terms of every distinct word."""
    sizes = np.array([len(x) for x in listed], np.int64)
    flat = np.array([t for x in listed for t in x], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    hit = np.flatnonzero(sizes[codes] > 0) if len(codes) else np.zeros(0, np.int64)
    doc, code = rows[hit], codes[hit]
    at = _ranges(first[code], sizes[code]) if len(hit) else np.zeros(0, np.int64)
    wide = sizes[code] if len(hit) else np.zeros(0, np.int64)
    key, count = np.unique(np.repeat(doc, wide) * np.int64(terms + 1) + (flat[at] if len(at) else 0), return_counts=True)
    return key // (terms + 1), key % (terms + 1), count


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    total = np.cumsum(lengths)
    return np.repeat(starts - (total - lengths), lengths) + np.arange(total[-1] if len(total) else 0)


def vectors_of(column: pa.Array, terms: dict[bytes, int], seen: dict[bytes, list[int]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the texts: row, term and count of every term of the model, and the words of each row.

    ``seen`` keeps the terms of words between calls.
    """
    rows, codes, words = words_of(column)
    seen = {} if seen is None else seen
    listed = []
    for w in words:
        found = seen.get(w)
        if found is None:
            found = seen[w] = [terms[t] for t in terms_of(w) if t in terms]
        listed.append(found)
    return *_occurrences(rows, codes, listed, len(terms)), np.bincount(rows, minlength=len(column))


class ExampleIndex:
    """Block-max inverted index over the distinct vectors of the examples.

    Besides its terms a vector has one part for the number of its words, so that a long text with one chance hit stays
    close to texts without any. Examples with equal vectors are one entry that votes with its share of toxic labels.
    """

    def __init__(self, idf: np.ndarray, vectors: list[tuple], n: np.ndarray, bad: np.ndarray, ids: list[list[int]], prior: float):
        self.idf, self.n, self.bad, self.ids, self.prior = idf, n, bad, ids, prior
        self.count = len(vectors)
        self.blocks = self.count // BLOCK + 1
        sizes = np.array([len(t) for t, _ in vectors], np.int64)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int32)
        value = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        entry = np.repeat(np.arange(self.count, dtype=np.int32), sizes)
        order = np.argsort(term, kind="stable")
        term, self.value, self.entry = term[order], value[order].astype(np.float32), entry[order]
        # A group is the postings of one term in one block.
        block = self.entry // BLOCK
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, np.int64)
        # Every worker holds a copy, so numbers take no more bytes than they need.
        self.start = np.append(new, len(term)).astype(np.min_scalar_type(-max(1, len(term))))
        self.block = block[new].astype(np.min_scalar_type(-max(1, self.blocks)))
        self.most = np.maximum.reduceat(self.value, new) if len(new) else np.zeros(0)
        self.first = np.searchsorted(term[new], np.arange(int(term.max(initial=-1)) + 2)).astype(np.int32 if len(new) < 1 << 31 else np.int64)
        self.entry = self.entry.astype(np.min_scalar_type(self.count))
        self.terms: dict[bytes, int] = {}
        self.knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave: int = -1) -> list[tuple[int, float]]:
        """The ``k`` entries of largest cosine, exactly; blocks whose bound is below the k-th are never opened."""
        known = terms < len(self.first) - 1
        terms, weights = terms[known], weights[known]
        wide = self.first[terms + 1] - self.first[terms]
        groups = _ranges(self.first[terms], wide)
        weight = np.repeat(weights, wide)
        bound = np.bincount(self.block[groups], weights=weight * self.most[groups], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        found, scores, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        opened = 0
        for last in (FIRST_BLOCKS, self.blocks):
            some = order[opened:last]
            some = some[(bound[some] > 0) & (bound[some] >= least - 1e-12)]
            opened = last
            if not len(some):
                break
            wanted = np.zeros(self.blocks, bool)
            wanted[some] = True
            open_groups = wanted[self.block[groups]]
            g, w = groups[open_groups], weight[open_groups]
            lengths = self.start[g + 1] - self.start[g]
            at = _ranges(self.start[g], lengths)
            sums = np.bincount(self.entry[at], weights=np.repeat(w, lengths) * self.value[at], minlength=self.count)
            hits = np.flatnonzero(sums > 0)
            hits = hits[hits != leave]
            found, scores = np.append(found, hits), np.append(scores, sums[hits])
            if len(found) > k:
                # Equal scores go to smaller numbers; only what reaches the k-th score is sorted.
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= kth
                found, scores = found[near], scores[near]
            best = np.lexsort((found, -scores))[:k]
            found, scores = found[best], scores[best]
            least = scores[-1] if len(found) == k else 0.0
        return [(int(i), float(x)) for i, x in zip(found, scores)]

    def vote(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, list[tuple[int, float]]]:
        """The raw score: shares of toxic labels, weighted by similarity; and the entries that voted."""
        near = self.nearest(terms, weights, NEIGHBOURS)
        top = total = 0.0
        for i, s in near:
            w = min(1.0, s) ** POWER
            top += w * self.bad[i] / self.n[i]
            total += w
        return (top + PRIOR_WEIGHT * self.prior) / (total + PRIOR_WEIGHT), near

    def calibrated(self, raw: float) -> float:
        return float(np.interp(raw, *self.knots))


def weigh(idf: np.ndarray, terms: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length, without terms of no weight; term ``len(idf)`` stands for the number of words."""
    used = idf[terms] > 0
    terms, counts = terms[used], counts[used]
    values = np.append((1.0 + np.log(counts)) * idf[terms], np.log1p(words))
    length = np.sqrt(np.sum(values * values))
    return np.append(terms, len(idf)).astype(np.int32), values / length if length else values


def monotone(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing map from raw scores to the share of labels 1 (pool adjacent violators)."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(raw[order], labels[order]):
        pools.append([float(x), float(x), float(y), 1.0])
        while len(pools) > 1 and (pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3] or pools[-2][1] == pools[-1][0]):
            b = pools.pop()
            a = pools[-1]
            a[1], a[2], a[3] = b[1], a[2] + b[2], a[3] + b[3]
    xs, ys = [], []
    for low, high, bad, n in pools:
        share = (bad + 0.05) / (n + 0.1)
        xs += [low, high]
        ys += [share, share]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def deviation(n: np.ndarray, bad: np.ndarray, share: float) -> np.ndarray:
    """How far the toxic share of a term lies above ``share``: root of the likelihood ratio, in deviations; else 0."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    r = np.clip((bad + share) / (n + 1.0), 1e-9, 1 - 1e-9)
    gain = r * np.log(r / share) + (1 - r) * np.log((1 - r) / (1 - share))
    return np.where(r > share, np.sqrt(np.maximum(0.0, 2.0 * n * gain)), 0.0)


def term_values(n: np.ndarray, bad: np.ndarray, rows: int, toxic: int, caution: float, whole: np.ndarray) -> np.ndarray:
    """IDF times class weight of the terms; beginnings (not ``whole``) and stop words have no floor."""
    g = deviation(n, bad, toxic / max(1, rows))
    weight = np.where(g > caution, 1.0 - (caution / np.maximum(g, caution)) ** 2, 0.0)
    floor = np.where(whole & (n > 0) & (n <= max(STOP_TEXTS, rows * STOP_SHARE)), FLOOR, 0.0)
    return np.log(1.0 + rows / np.maximum(n, 1)) * (floor + (1.0 - floor) * weight)


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> ExampleIndex | None:
    """The index of examples; null without labelled rows.

    Learns from at most ``max_examples`` labelled rows whose crc32(doc_id as text) mod 3 is not 1, taken in the order of
    the md5 of their id. Several labels of one document count as toxic if any is; null labels or ids are left out;
    verified near-copies count once per label. The driver holds the vectors of the sample.
    """
    may = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) != 1
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & may).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = known.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(max_examples)
    # The sample has a fixed bound: an id and a label each.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = materialize(rows.mapInArrow(_signatures, f"doc_id {kind}, text string, toxic int, pairs array<long>, marks array<long>"), "toxicity-marked")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    rows = materialize(_without_copies(rows).withColumn("half", half), "toxicity-sample")
    counted = rows.select("text", "toxic", "half").mapInArrow(_term_counts, "term binary, n0 long, bad0 long, n1 long, bad1 long")
    sizes = {r["half"]: (r["n"], r["bad"]) for r in rows.groupBy("half").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).collect()}
    if not sizes:
        return None
    (n0, b0), (n1, b1) = sizes.get(0, (0, 0)), sizes.get(1, (0, 0))
    counts = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n0", "bad0", "n1", "bad1")]).where("n0 + n1 > 1")
    # Beginnings need toxic texts, and words that are as common as stop words need them too; other words all stay.
    n, bad, share = F.col("n0") + F.col("n1"), F.col("bad0") + F.col("bad1"), (b0 + b1) / (n0 + n1)
    common = 2 * max(STOP_TEXTS, (n0 + n1) * STOP_SHARE)
    word = F.substring("term", 1, 1) != F.lit(b"^")
    counts = counts.where((word & (n <= common)) | (bad > n * share + F.when(word, 0.0).otherwise(F.sqrt(n * share * (1 - share))))).toArrow().sort_by("term")
    names = counts.column("term").to_pylist()
    table = {c: counts.column(c).to_numpy() for c in ("n0", "bad0", "n1", "bad1")}
    whole = np.array([not t.startswith(b"^") for t in names], bool)
    n, bad = table["n0"] + table["n1"], table["bad0"] + table["bad1"]
    keep = (whole & (n <= common)) | (deviation(n, bad, share) > np.where(whole, CAUTION[0], LEAST_PREFIX))
    terms = {t: i for i, t in enumerate(t for t, k in zip(names, keep) if k)}
    stats = np.column_stack([table[c][keep] for c in ("n0", "bad0", "n1", "bad1")])
    whole = whole[keep]

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=SCORE_BYTES):
            doc, term, count, words = vectors_of(batch.column("text"), terms)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), batch.column("half"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(term, pa.int32())), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(count, pa.int32())), pa.array(words, pa.int64())],
                names=["doc_id", "toxic", "half", "terms", "counts", "words"],
            )

    schema = "doc_id long, toxic int, half int, terms array<int>, counts array<int>, words long"
    found = rows.mapInArrow(sparse, schema).toArrow().combine_chunks()
    ids, toxic, half, words = (found.column(c).to_numpy() for c in ("doc_id", "toxic", "half", "words"))
    lists = [[x.values.to_numpy() for x in found.column(c)] for c in ("terms", "counts")]
    order = np.lexsort((words, ids))
    examples = [Example(int(ids[i]), int(toxic[i]), int(half[i]), lists[0][i], lists[1][i], int(words[i])) for i in order]
    model = learn(examples, stats, whole)
    model.terms = terms
    return model


class Example(NamedTuple):
    doc_id: int
    toxic: int
    half: int
    terms: np.ndarray
    counts: np.ndarray
    words: int


def learn(examples: list[Example], stats: np.ndarray, whole: np.ndarray) -> ExampleIndex:
    """The index over all examples, its caution and its calibration from halves that score each other.

    ``stats`` has texts and toxic texts per term in the first and in the second half. A half is scored with the terms'
    values and the entries of the other half only, so that no label has a say in its own score.
    """
    halves = [[e for e in examples if e.half == h] for h in (0, 1)]

    def values(h: int, caution: float) -> np.ndarray:
        one = halves[h]
        return term_values(stats[:, 2 * h], stats[:, 2 * h + 1], len(one), sum(e.toxic for e in one), caution, whole)

    def crossed(caution: float, most: int) -> tuple[np.ndarray, np.ndarray]:
        raw, labels = [], []
        for h in (0, 1):
            if halves[h] and halves[1 - h]:
                model = build(values(h, caution), halves[h])
                for e in halves[1 - h][:: -(-len(halves[1 - h]) // most)]:
                    raw.append(model.vote(*weigh(model.idf, e.terms, e.counts, e.words))[0])
                    labels.append(e.toxic)
        return np.array(raw), np.array(labels, float)

    def loss(caution: float) -> float:
        raw, labels = crossed(caution, TRIALS)
        share = np.clip(np.interp(raw, *monotone(raw, labels)), 1e-3, 1 - 1e-3) if len(raw) else np.zeros(0)
        return float(-np.sum(labels * np.log(share) + (1 - labels) * np.log(1 - share)))

    # Where several do equally well the most cautious is taken.
    caution = min(CAUTION, key=lambda c: (loss(c), -c))
    both = stats[:, :2] + stats[:, 2:]
    model = build(term_values(both[:, 0], both[:, 1], len(examples), sum(e.toxic for e in examples), caution, whole), examples)
    raw, labels = crossed(caution, CALIBRATED)
    if len(raw):
        model.knots = monotone(raw, labels)
    return model


def build(idf: np.ndarray, examples: list[Example]) -> ExampleIndex:
    """The index over the vectors of the examples."""
    entries: dict[bytes, int] = {}
    vectors, n, bad, ids = [], [], [], []
    # Entries with the same weightiest terms stand together, which keeps the bounds of blocks tight.
    weighed = [weigh(idf, e.terms, e.counts, e.words) for e in examples]
    heavy = [tuple(t[:-1][np.argsort(-w[:-1], kind="stable")[:2]].tolist()) if len(w) and w[:-1].max(initial=0) > w[-1] / 3 else () for t, w in weighed]
    for j in sorted(range(len(examples)), key=lambda j: (heavy[j], examples[j].doc_id)):
        t, w = weighed[j]
        key = hashlib.md5(t.tobytes() + w.round(12).tobytes()).digest()
        i = entries.setdefault(key, len(entries))
        if i == len(vectors):
            vectors.append((t, w))
            n.append(0)
            bad.append(0)
            ids.append([])
        n[i] += 1
        bad[i] += examples[j].toxic
        if len(ids[i]) < 3:
            ids[i].append(examples[j].doc_id)
    return ExampleIndex(idf, vectors, np.array(n), np.array(bad), ids, sum(bad) / max(1, sum(n)))


def _scorer(parts: Broadcast, threshold: float):
    """The function that adds score, predicted and evidence to batches; ``parts`` are the attributes of the index."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, tuple[float, list[int]]] = {}
        seen: dict[bytes, list[int]] = {}
        model = None
        if parts.value:
            model = ExampleIndex.__new__(ExampleIndex)
            model.__dict__.update(parts.value)
        for batch in text_chunks(batches, limit=SCORE_BYTES):
            scores, evidence = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            if model is not None:
                doc, term, count, words = vectors_of(batch.column("text"), model.terms, seen)
                if len(seen) > KEPT_WORDS:
                    seen = {}
                first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                for i in range(batch.num_rows):
                    s, e = first[i], first[i + 1]
                    key = hashlib.md5(term[s:e].tobytes() + count[s:e].tobytes() + int(words[i]).to_bytes(8, "big")).digest()
                    if key not in memo:
                        if len(memo) >= 50_000:
                            memo.clear()
                        raw, near = model.vote(*weigh(model.idf, term[s:e], count[s:e].astype(float), int(words[i])))
                        memo[key] = (model.calibrated(raw), [x for j, _ in near[:3] for x in model.ids[j][:1]])
                    scores[i], evidence[i] = memo[key]
            values = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], names=[*batch.schema.names, "score", "predicted", "evidence"])

    return scored


def score_toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and held_out, score, predicted, evidence for every row.

    The score depends on the text alone: the shares of toxic labels among the nearest examples, weighted by cosine and
    mapped to frequencies that were observed when halves of the examples scored each other. ``evidence`` holds ids of the nearest
    examples. Null and blank texts are compared like any other (they have no words). Without any labelled row
    every score is 0. Repeated rows get equal scores; null ids are scored and count as not held out; columns named like
    the new ones are replaced.
    """
    model = fit(docs, labels, max_examples)
    held = F.coalesce((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1, F.lit(False))
    new = ("held_out", "score", "predicted", "evidence")
    kept = [c for c in docs.columns if c not in new]

    rows = docs.select(*kept).withColumn("held_out", held)
    schema = StructType(list(rows.schema.fields)).add("score", DoubleType()).add("predicted", IntegerType()).add("evidence", ArrayType(LongType()))
    # Plain values are sent, since a worker also keeps the bytes of whatever comes with a function; the function carries the class.
    parts = docs.sparkSession.sparkContext.broadcast(vars(model) if model is not None else {})
    return rows.mapInArrow(_scorer(parts, threshold), schema)


def reject_toxic(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``threshold``, with their columns."""
    renamed = {c: f"__{c}" for c in docs.columns if c in ("held_out", "score", "predicted", "evidence")}
    scored = score_toxicity(docs.withColumnsRenamed(renamed), labels, max_examples, threshold).where("predicted = 0")
    return scored.select(*[F.col(renamed.get(c, c)).alias(c) for c in docs.columns])
