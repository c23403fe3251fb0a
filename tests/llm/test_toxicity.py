"""Toxicity on label tables of several sizes and shares, and the search against brute force."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from topicloom.llm import toxicity

COMMON = [f"{a}{b}{c}" for a in ("tor", "mel", "san", "bri", "kol", "fen", "dal", "wes") for b in ("a", "ili", "ou", "ende") for c in ("n", "rk", "st", "ment", "tion", "ly")]
LONG = [f"{w}ification{x}" for w in COMMON[:60] for x in ("", "al")]


def table(seed, texts, share, toxic_words, words, hits=3, length=60):
    """Rows and labels: toxic texts hold ``hits`` of the toxic words at random places."""
    rnd = random.Random(seed)
    bad_words = ["".join(rnd.choice("bdgklmnprstvz") + rnd.choice("aeiou") for _ in range(4)) + "x" for _ in range(toxic_words)]
    rows, labels = [], []
    for i in range(texts):
        bad = rnd.random() < share
        line = [rnd.choice(words) for _ in range(length)]
        for place in rnd.sample(range(length), hits if bad else 0):
            line[place] = rnd.choice(bad_words)
        rows.append((i, " ".join(line), "a"))
        labels.append((i, int(bad)))
    return rows, labels


def outcome(spark, make_docs, rows, labels):
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = dict(labels)
    out = toxicity.score_toxicity(make_docs(rows), known).collect()
    held = [(truth[r.doc_id], r.predicted) for r in out if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    return np.mean(toxic or [1]), np.mean(clean)


@pytest.mark.parametrize(
    ("texts", "share", "toxic_words", "words", "hits"),
    [(400, 0.5, 40, COMMON, 3), (1000, 0.8, 40, COMMON, 3), (2000, 0.5, 40, LONG, 3), (120, 0.5, 6, COMMON, 2), (1500, 0.05, 12, COMMON, 3)],
    ids=["balanced", "mostly toxic", "long common words", "tiny", "rare"],
)
def test_label_tables(spark, make_docs, texts, share, toxic_words, words, hits):
    caught, alarms = outcome(spark, make_docs, *table(5, texts, share, toxic_words, words, hits))
    assert caught >= 0.9 and alarms <= 0.02


def test_one_label_only(spark, make_docs):
    rows, labels = table(6, 90, 0.0, 5, COMMON)
    assert outcome(spark, make_docs, rows, [(i, 0) for i, _ in labels] + [(-1, 1)])[1] == 0


def test_copies_count_once(spark, make_docs):
    rows, labels = table(7, 60, 0.5, 5, COMMON)
    copies = [(1000 + i, f"{rows[3][1]} end{'s' * (i % 3)}", "a") for i in range(40)]
    other = [(2000, " ".join(reversed(rows[3][1].split()[:20] + rows[4][1].split())), "a")]
    known = spark.createDataFrame([(i, t, 1) for i, t, _ in rows + copies + other], "doc_id long, text string, toxic int")
    marked = known.mapInArrow(toxicity._signatures, "doc_id long, text string, toxic int, pairs array<long>, marks array<long>")
    left = {r.doc_id for r in toxicity._without_copies(marked).collect()}
    assert left >= {i for i, _, _ in rows} | {2000} and len(left & {i for i, _, _ in copies}) <= 1


def test_cosine_of_whole_vocabulary():
    rng = np.random.RandomState(3)
    examples = []
    for i in range(300):
        terms = np.sort(rng.choice(200, rng.randint(0, 40), replace=False))
        examples.append(toxicity.Example(i, int(rng.rand() < 0.3), i % 2, terms, rng.randint(1, 4, len(terms)).astype(float), 50))
    stats = np.zeros((200, 4), np.int64)
    for e in examples:
        stats[e.terms, 2 * e.half] += 1
        stats[e.terms, 2 * e.half + 1] += e.toxic
    model = toxicity.learn(examples, stats, np.ones(200, bool))
    assert (model.idf > 0).all()
    dense, ids = np.zeros((300, 201)), []
    for i, e in enumerate(examples):
        dense[i, e.terms] = (1 + np.log(e.counts)) * model.idf[e.terms]
        dense[i, 200] = np.log1p(e.words)
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    for i in range(0, 300, 7):
        e = examples[i]
        near = model.nearest(*toxicity.weigh(model.idf, e.terms, e.counts, e.words), 15)
        want = np.unique(dense.round(12), axis=0) @ dense[i]
        assert np.allclose([s for _, s in near], np.sort(want)[::-1][:15])


def test_scoring_lays_out_few_terms_at_once():
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rnd.choice(letters) for _ in range(9)) for _ in range(3000)]
    terms = {t: i for i, t in enumerate(sorted({t for w in words for t in toxicity.terms_of(w.encode())}))}
    examples = [toxicity.Example(i, i % 2, 0, np.array([i, i + 1], np.int32), np.array([1, 1], np.int32), 2) for i in range(50)]
    model = toxicity.build(np.ones(len(terms)), examples)
    model.terms = terms
    texts = [" ".join(rnd.choice(words) for _ in range(300)) for _ in range(700)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    out = list(toxicity._scorer(SimpleNamespace(value=vars(model)), 0.7)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == len(texts)
    assert peak < 40 << 20
