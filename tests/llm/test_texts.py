"""Operators on documents against brute force, with awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.llm import mixing, near_dup, packing, sharding, suffix_dedup, suffix_sort, token_counts, toxicity

NAMES = ["amber", "birch", "cédar", "dune", "ember", "fjord", "grove", "heath", "inlet", "jetty", "knoll", "ledge"]


def prose(rnd, n):
    return " ".join(rnd.choice(NAMES) + str(rnd.randint(0, 400)) for _ in range(n))


def awkward(rnd):
    long = prose(rnd, 30_000)
    return [(1, None, "a"), (2, "", "b"), (None, "one two", None), (None, "one two", None), (3, "  \n\t ", "a"), (4, long, "b"), (5, prose(rnd, 40), None), (5, prose(rnd, 41), "c"), (6, "x", ""), (6, "x", "")]


# Shards


def jump(key, shards):
    key, here, nxt = key % 2**64, -1, 0
    while nxt < shards:
        here = nxt
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        nxt = int((here + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return here


def test_jump_shards(spark, make_docs):
    ids = [*range(300), -5, -(2**63), 2**63 - 1]
    keys = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: (r.s, r.g) for r in keys.select("doc_id", sharding.jump_shard(F.col("doc_id"), 16).alias("s"), sharding.jump_shard(F.col("doc_id"), 17).alias("g")).collect()}
    assert got == {i: (jump(i, 16), jump(i, 17)) for i in ids}
    assert all(a == b or b == 16 for a, b in got.values())
    rows = awkward(random.Random(1)) + [(i, str(i), "a") for i in range(200)]
    out = sharding.shard_documents(make_docs(rows), 4).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in out) == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    for shard in range(4):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert sharding.shard_documents(make_docs([]), 4).count() == 0


def test_slices_do_not_change_ranks(spark, make_docs, monkeypatch):
    rows = awkward(random.Random(1)) + [(i, str(i % 7), "a") for i in range(200)]
    whole = sorted(map(tuple, sharding.shard_documents(make_docs(rows), 4).collect()), key=str)
    monkeypatch.setattr("topicloom.llm.common.SLICE_ROWS", 4)
    assert sorted(map(tuple, sharding.shard_documents(make_docs(rows), 4).collect()), key=str) == whole


# Mixing


def test_targets_stop_at_the_limit(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, None: 5, "d": 0}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table, (3, 1, 2), 1.5, 2).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= 2 * sizes[s]}
        want |= {s: 2.0 * sizes[s] for s in over} if over else {s: share * weight[s] for s in free}
        left -= sum(2 * sizes[s] for s in over)
        free = free - over if over else set()
    assert got == pytest.approx(want)


def test_mix_comes_near_targets(spark, make_docs):
    rnd = random.Random(4)
    rows = awkward(rnd) + [(i, prose(rnd, int(rnd.paretovariate(1.2) * 5) % 900 + 1), rnd.choice(["a", "b", "b", "b", "c"])) for i in range(100, 900)]
    out = mixing.mix_sources(make_docs(rows)).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(make_docs(rows).repartition(7)).collect()))
    for source in {s for _, _, s in rows}:
        mine = [r for r in out if r.source == source]
        size = sum(len(t.encode().split()) for _, t, s in rows if s == source and t)
        assert {r.source_size for r in mine} == {size} and all(r.taken <= 2 * r["size"] for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r["size"] for r in mine)
    kept = mixing.mixed_documents(make_docs(rows))
    assert kept.columns == make_docs(rows).columns and kept.count() == sum(r.copies for r in out)
    assert mixing.mix_sources(make_docs([])).count() == 0


# Repeated passages


def covered(texts, size):
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - size + 1):
            seen.setdefault(t[s : s + size], []).append((i, s))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + size] = True
    return gone


@pytest.mark.parametrize("size", [20, 64, 200])
def test_repeats_equal_brute_force(spark, make_docs, size, monkeypatch):
    rnd = random.Random(size)
    shared, other = prose(rnd, 30), prose(rnd, 60)
    rows = [r for r in awkward(rnd) if not r[1] or len(r[1]) < 5000]
    rows += [(10, shared + other, "a"), (11, prose(rnd, 9) + shared, "a"), (11, prose(rnd, 9) + shared, "a"), (12, other + other, "b"), (13, "ab" * 300, "b"), (None, shared[5:] + "!" + other[:-7], "c"), (None, shared[5:] + "!" + other[:-7], "c")]
    monkeypatch.setattr(suffix_dedup, "BATCH_ITEMS", 5)
    out = suffix_dedup.remove_repeats(make_docs(rows).repartition(3), size)
    assert out.columns == [c for c in make_docs(rows).columns if c != "kept"] + ["n_bytes", "n_removed", "n_spans", "kept"]
    got = sorted(((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()))
    texts = [(t or "").encode() for _, t, _ in rows]
    want = [(i or -1, len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~g])) for (i, _, _), t, g in zip(rows, texts, covered(texts, size))]
    assert got == sorted(want)
    plain = suffix_dedup.without_repeats(make_docs(rows), size)
    assert plain.columns == make_docs(rows).columns
    assert sorted(str(r.text) for r in plain.collect()) == sorted(str(None if t is None else k[-1].decode("utf-8", "ignore")) for (_, t, _), k in zip(rows, want))


def test_runs_under_a_hot_key_are_not_held_together(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_KINDS", 8, raising=False)
    seen, compared = [], suffix_dedup._compared

    def watch(items, size):
        seen.append(max([r["count"] for r in items.select("gram", "item").distinct().groupBy("gram").count().collect()], default=0))
        return compared(items, size)

    monkeypatch.setattr(suffix_dedup, "_compared", watch)
    rnd = random.Random(21)
    footer = prose(rnd, 40)
    rows = [(i, prose(rnd, 9) + footer + prose(rnd, 9), "a") for i in range(40)] + [(50, footer, "a"), (50, footer, "a")]
    out = suffix_dedup.remove_repeats(make_docs(rows), 64).collect()
    texts = [t.encode() for _, t, _ in rows]
    want = [(i, int(g.sum()), bytes(np.frombuffer(t, np.uint8)[~g])) for (i, _, _), t, g in zip(rows, texts, covered(texts, 64))]
    assert sorted((r.doc_id, r.n_removed, bytes(r.kept)) for r in out) == sorted(want)
    assert max(seen) <= 8


def test_very_long_text_is_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 10)
    flat = np.random.RandomState(1).randint(97, 99, 5000).astype(np.uint8)
    starts = []
    for piece, offsets, base in suffix_dedup._pieces(flat, np.array([0, 5000]), 100):
        _, low, high, _ = suffix_dedup.anchored_runs(piece, offsets, 100)
        starts += [s + base for a, b in zip(low, high) for s in range(a, b + 1)]
    assert starts == list(range(4901))


def test_deep_shallow_order():
    rnd = random.Random(2)
    for small in (2, 4096):
        suffix_sort.SMALL, before = small, suffix_sort.SMALL
        for _ in range(60):
            base = bytes(rnd.choice(b"ab\0") for _ in range(70))
            some = [base[: rnd.randint(0, 70)] + bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 40))]
            order, prefix = suffix_sort.sorted_with_prefixes(some)
            lined = [some[i] for i in order]
            assert lined == sorted(some)
            assert all(prefix[i] == suffix_sort.common_prefix(lined[i - 1], lined[i]) for i in range(1, len(some)))
        suffix_sort.SMALL = before


# Near-duplicates


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("cells", [0, 1 << 21])
def test_banded_alignment(cells, monkeypatch):
    monkeypatch.setattr(near_dup, "BAND_CELLS", cells)
    rng = np.random.RandomState(cells % 97)
    for _ in range(400):
        a = rng.randint(0, 4, rng.randint(0, 25))
        b = [x for x in a if rng.rand() > 0.1]
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b) + 1), rng.randint(0, 4))
        most, exact = int(rng.randint(0, 10)), edit_distance(list(a), b)
        assert near_dup.edits_within(a.astype(np.uint64), np.array(b, np.uint64), most) == (exact if exact <= most else None)


def test_classes_equal_brute_force(spark, make_docs, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 4)
    rnd = random.Random(9)
    rows = awkward(rnd)
    passage = prose(rnd, 30)
    number = 100
    for group in range(12):
        base = prose(rnd, 100).split()
        for _ in range(rnd.randint(1, 7)):
            words = list(base)
            for _ in range(rnd.randint(0, 5)):
                words[rnd.randrange(len(words))] = "edit" + str(rnd.randint(0, 999))
            rows.append((number, " ".join(words), "a"))
            number += 1
    rows += [(number + i, passage + " " + prose(rnd, 60), "a") for i in range(25)]
    out = near_dup.near_duplicates(make_docs(rows)).collect()
    assert len(out) == len(rows)
    split = [(t or "").lower().split() for _, t, _ in rows]
    hashed = [np.array([hash(w) & 0xFFFFFFFFFFFF for w in x], np.uint64) for x in split]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, text, _) in enumerate(rows):
        for j in range(i):
            other = rows[j][1]
            if (text or "") == (other or "") or split[i] and split[j] and near_dup.alike(hashed[i], hashed[j]):
                parent[top(i)] = top(j)
    classes = {}
    for i, (doc, text, _) in enumerate(rows):
        classes.setdefault(top(i), []).append((doc, text or ""))
    want = [(str(d), min((x for x, _ in c if x is not None), default=None), len(c)) for c in classes.values() for d, _ in c]
    assert sorted(str((str(r.doc_id), r.class_id, r.class_size)) for r in out) == sorted(map(str, want))
    kept = near_dup.keep_one(make_docs(rows))
    assert kept.columns == make_docs(rows).columns and kept.count() == len(classes)
    assert near_dup.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("partners", [0, 32])
def test_pairs_among_texts_with_a_common_passage(spark, make_docs, monkeypatch, partners):
    monkeypatch.setattr(near_dup, "PARTNERS", partners)
    rnd = random.Random(12)
    passage, rows = prose(rnd, 70), []
    for i in range(1000 if partners else 60):
        own = [f"the{j}" if j % 5 == 0 else f"own{i}x{j}" for j in range(30)]
        rows.append((i, " ".join([passage, *own]), "a"))
        if i % 10 == 0:
            # No five own words in a row stay, so the two meet where all others do.
            rows.append((10_000 + i, " ".join([passage, *(f"new{i}x{j}" if j % 3 == 1 else w for j, w in enumerate(own))]), "a"))
    out = near_dup.near_duplicates(make_docs(rows)).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in out} == {i: (i % 10_000, 2 if i % 10 == 0 else 1) for i, _, _ in rows}


# Token counts


def test_best_splits_equal_brute_force():
    scores = token_counts.zipf_scores(token_counts.vocabulary_path())
    trie, longest = token_counts.PieceTrie(scores), max(map(len, scores))
    rnd = random.Random(3)
    words = [rnd.choice([" the", "ing", "béta", "", "zz", "a" * 30]) + "".join(rnd.choice("abct é") for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    words = [w.encode() for w in words] + [b"", b"a", b"a", b"ab"]

    def split(word):
        best = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - longest), end):
                if word[start:end] in scores:
                    cand = (best[start][0] + scores[word[start:end]], best[start][1] + 1)
                    if cand[0] > best[end][0] or cand[0] == best[end][0] and cand[1] < best[end][1]:
                        best[end] = cand
        return best[-1]

    got = list(zip(*(x.tolist() for x in token_counts.best_splits(words, trie))))
    assert got == [split(w) for w in words]


def test_token_counts_add_up(spark, make_docs):
    rows = awkward(random.Random(5))
    out = sorted(token_counts.count_tokens(make_docs(rows)).collect(), key=lambda r: (r.doc_id or -1, r.n_words))
    trie = token_counts.PieceTrie(token_counts.zipf_scores(token_counts.vocabulary_path()))
    want = []
    for i, t, _ in rows:
        words = (t or "").encode().split()
        want.append((i, len(words), int(token_counts.best_splits([b" " + w for w in words], trie)[1].sum()) if words else 0))
    assert [(r.doc_id, r.n_words, r.n_tokens) for r in out] == sorted(want, key=lambda x: (x[0] or -1, x[1]))
    assert token_counts.count_tokens(make_docs([])).count() == 0


# Packing


def test_ids_are_those_of_the_vocabulary():
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.load_encoder(packing.vocabulary_path(), packing.SPECIAL)
    for text in ["", " ", "a  b\n\n c", "naïve Äpfel 日本語 🙂", "x<|endoftext|>y <|endoftext|>", "don't we'll 12345", " 　 \t\r\n", "\x00\x01"]:
        assert fast.encode(text, allowed_special="all") == slow.encode(text, add_special_tokens=False).ids


def test_packing_is_lossless_and_dense(spark, make_docs):
    rnd = random.Random(6)
    rows = awkward(rnd) + [(i, prose(rnd, rnd.randint(0, 60)), "a") for i in range(100, 300)]
    out = packing.pack_documents(make_docs(rows), window=128, keep_ids=True).collect()
    sequences, documents = {}, {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
        documents.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    lengths = sorted(sum(r.length for r in p) for p in sequences.values())
    assert lengths[1:] == [128] * (len(lengths) - 1)
    encoder = packing.load_encoder(packing.vocabulary_path(), packing.SPECIAL)
    for i, t, _ in rows:
        ids = [*encoder.encode(t or "", allowed_special="all"), 1]
        pieces = sorted(documents[(i, len(ids))], key=lambda r: r.start)
        if sum(len(encoder.encode(x or "")) + 1 == len(ids) and j == i for j, x, _ in rows) == 1:
            assert [x for r in pieces for x in r.ids] == ids
    assert sum(r.length for r in out) == sum(len(encoder.encode(t or "")) + 1 for _, t, _ in rows)
    assert packing.pack_documents(make_docs([])).count() == 0


def test_neighbours_follow_the_ranking():
    docs = [np.array(x) for x in ([1, 2, 3], [9, 9, 8], [1, 2, 7], [3, 3, 1], [5])]
    index = packing.Bm25Index(docs)
    n, mean = len(docs), np.mean([len(d) for d in docs])

    def score(a, b):
        total = 0.0
        for t in set(docs[a].tolist()):
            df, tf = sum(t in d for d in docs), int((docs[b] == t).sum())
            total += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[b]) / mean))
        return total

    index.unused[0] = False
    assert index.ranked(0).tolist() == sorted((1, 2, 3, 4), key=lambda b: (-round(score(0, b), 5), b))


# Toxicity


def test_toxicity_on_held_out_rows(spark, make_docs):
    rnd = random.Random(8)
    rows, labels = awkward(rnd), []
    for i in range(100, 900):
        bad = i % 9 == 0
        words = prose(rnd, 60).split()
        for _ in range(4 if bad else 0):
            words[rnd.randrange(60)] = rnd.choice(["grubling", "vexfoot", "nastoid"])
        rows.append((i, " ".join(words).title(), "a"))
        if i % 2 == 0 or i % 9 == 0:
            labels.append((i, 1, int(bad)))
    labels += [(None, 0, 1), (101, 0, None), (5, 0, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(make_docs(rows), known).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    mine = [r for r in out if r.doc_id and r.doc_id >= 100]
    assert np.mean([r.predicted == int(r.doc_id % 9 == 0) for r in mine]) > 0.98
    clean = toxicity.reject_toxic(make_docs(rows), known)
    assert clean.columns == make_docs(rows).columns and clean.count() == sum(r.predicted == 0 for r in out)
    none = toxicity.score_toxicity(make_docs(rows), known.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_toxicity(make_docs([]), known).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.RandomState(4)
    vectors = []
    for _ in range(400):
        terms = np.sort(rng.choice(30, rng.randint(1, 6), replace=False))
        weights = rng.rand(len(terms)) + 0.1
        vectors.append((terms, weights / np.sqrt(np.sum(weights**2))))
    index = toxicity.ExampleIndex(np.ones(30), vectors, np.ones(400, int), np.zeros(400, int), [[i] for i in range(400)], 0.1)
    dense = np.zeros((400, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(60):
        sims = dense @ dense[i]
        want = np.sort(sims[sims > 0])[::-1][:15]
        assert np.allclose([s for _, s in index.nearest(*vectors[i], 15)], want)


def test_hash_of_text(spark, make_docs):
    got = make_docs([(1, None, "a"), (2, "é", "a")]).select(near_dup.text_key().alias("k")).collect()
    assert [bytes(r.k) for r in got] == [hashlib.md5(b"").digest(), hashlib.md5("é".encode()).digest()]


def test_passages_by_words(make_docs):
    from topicloom.llm import suffix_dedup

    passage = " ".join(f"w{i} of" for i in range(30))
    string = "x" * 200
    rows = [(1, f"first start {passage} one end", "s"), (2, f"another begin {passage} two close", "s"), (3, f"aa {string} bb", "s"), (4, f"cc {string} dd", "s"), (5, None, "s")]
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(make_docs(rows), 125, 50).collect()}
    assert got[3] == rows[2][1] and got[4] == rows[3][1] and got[5] is None
    assert "w15" not in got[1] + got[2] and got[1].startswith("first start") and got[2].endswith("two close")
    both = {r.doc_id: r.text for r in suffix_dedup.without_repeats(make_docs(rows), 125).collect()}
    assert both[3] == "aabb" and both[1] == got[1]
