"""Alignment of two tokenizers against a plain walk over whole texts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.llm import alignment
from topicloom.session import materialize

pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

TEXTS = [
    "The quick brown fox.", "The quick brown fox.", "", None, " ", "a ▁ b", "naïve café 東京タワー 😀😀", "<|endoftext|> <s> </s> <0x41>", "x\r\ny\t\tz \n\n  w", "end;\r\n  }\r\n\x00\x1c\x85 \xa0q　r",
    "Unbelievable tokenization, antidisestablishmentarianism", "  two  blanks  ", "word " * 900 + "1234567890" * 40, "ﬁ ﬀ ½ ²", "The the THE",
]


def library():
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment._path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment._path("piece_bpe_32k.model"))


def walked(text, a, b):
    """Ids by group of the whole text, and the linked pairs, by offsets."""
    if not text:
        return [], []
    letters = alignment._letter_bytes()
    line = " " + text
    a_ids, b_ids = a.encode(line, add_special_tokens=False).ids, b.encode(text)
    a_raw = [bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a_ids]
    b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in b_ids)]
    if b"".join(a_raw) != line.encode() or b"".join(b_raw) != line.encode():
        return [], []
    a_end, b_end = np.cumsum([len(x) for x in a_raw]), np.cumsum([len(x) for x in b_raw])
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(a_end.tolist()) & set(b_end.tolist())):
        x, y = int(np.searchsorted(a_end, cut, "right")), int(np.searchsorted(b_end, cut, "right"))
        groups.append((a_ids[i:x], b_ids[j:y]))
        for p in range(i, x):
            for q in range(j, y):
                if a_end[p] - len(a_raw[p]) < b_end[q] and b_end[q] - len(b_raw[q]) < a_end[p]:
                    links.append((a_ids[p], b_ids[q]))
        i, j = x, y
    return groups, links


def expected(texts):
    a, b = library()
    done = [walked(t, a, b) for t in texts]
    count = Counter(pair for _, links in done for pair in set(links))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    rows = []
    for groups, links in done:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), shown, sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)))
    return rows, count, most


@pytest.mark.parametrize("chunk,parts", [(4 << 20, 1), (30, 3)])
def test_equals_a_plain_walk(spark, make_docs, monkeypatch, chunk, parts):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    docs = make_docs([(None if i == 4 else i % 12, t, "s") for i, t in enumerate(TEXTS)]).withColumn("at", F.monotonically_increasing_id())
    docs = docs.withColumn("links", F.lit(1)).repartition(parts, "at") if parts > 1 else docs.withColumn("links", F.lit(1))
    grouped = materialize(alignment.group_tokens(docs), "test-aligned")
    rows = alignment.score_links(grouped).collect()
    want, count, most = expected(TEXTS)
    got = sorted((r.text is None, r.text or "", r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in rows)
    assert got == sorted((t is None, t or "", *w) for t, w in zip(TEXTS, want))
    pairs = {(r.a_id, r.b_id): (r.documents, r.best) for r in alignment.link_counts(grouped).collect()}
    assert pairs == {p: (n, n == most[p[0]]) for p, n in count.items()}


def test_marked_texts_have_no_tokens(spark, make_docs):
    row = alignment.group_tokens(make_docs([(1, "a ▁ b", "s")])).first()
    assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.groups, row.links) == (0, 0, 0, 0, "", None)


def test_empty_table(spark, make_docs):
    assert alignment.score_links(materialize(alignment.group_tokens(make_docs([])), "test-empty")).count() == 0


def test_components_by_brute_force():
    rng = np.random.RandomState(5)
    for _ in range(200):
        total = rng.randint(1, 40)
        ends = [np.unique(np.append(rng.randint(1, total + 1, rng.randint(0, 20)), total)) for _ in "ab"]
        starts = [np.concatenate([[0], e[:-1]]) for e in ends]
        a, b = alignment.components(starts[0], ends[0], starts[1], ends[1])
        shared = np.intersect1d(*ends)
        assert a.tolist() == np.searchsorted(shared, ends[0]).tolist() and b.tolist() == np.searchsorted(shared, ends[1]).tolist()
