"""Byte-level BPE through a piece model against the library of the rank files."""

import base64

import numpy as np
import pytest
import sentencepiece

from topicloom.llm import bpe_codec
from topicloom.llm.pieces import unit_codes

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "", None, " ", "\n\n", "a", "don't  stop\r\n\tnow ", "  lead", "trail \n ", "x\x1c \x85y\xa0 z  　w", "<|endoftext|> </s>", "naïve café 東京 😀😀 ​  end",
    "1234567 12,5 !!! ---\n--- 'll 'LL", "\x00\x01 \x7f", "ab " * 3000 + "x" * 5000, "é" * 2000, " \n \n " * 300,
]


@pytest.fixture(scope="module")
def library():
    with open(bpe_codec.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_equal_the_library(spark, make_docs, library):
    docs = make_docs([(i, t, "s") for i, t in enumerate(ODD + ODD)]).withColumnRenamed("size", "ids")
    coded = bpe_codec.encode_texts(docs)
    rows = bpe_codec.decode_ids(coded).collect()
    assert len(rows) == 2 * len(ODD) and set(coded.columns) == set(docs.columns)
    for r in rows:
        text = ODD[r.doc_id % len(ODD)] or ""
        assert r.ids == library.encode_ordinary(text) and bytes(r.decoded) == text.encode()


def test_other_vocabulary(spark, make_docs):
    path = bpe_codec.vocabulary_path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(path), special_tokens={})
    rows = bpe_codec.encode_texts(make_docs([(i, t, "s") for i, t in enumerate(ODD)]), path=path).collect()
    assert all(r.ids == library.encode_ordinary(ODD[r.doc_id] or "") for r in rows)


def test_empty_table_and_bad_ids(spark, make_docs):
    assert bpe_codec.decode_ids(bpe_codec.encode_texts(make_docs([]))).count() == 0
    some = spark.createDataFrame([(1, None), (2, []), (3, [0, 50255])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe_codec.decode_ids(some).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and bytes(got[3]) == bpe_codec.Codec(bpe_codec.read_ranks(bpe_codec.vocabulary_path()), ".").decode(np.array([0, 50255]))[0].tobytes()
    for wrong in (50256, -1, None):
        with pytest.raises(Exception, match="not in the vocabulary|null id"):
            bpe_codec.decode_ids(spark.createDataFrame([([wrong],)], "ids array<int>")).collect()


def test_tokens_that_merges_do_not_reach():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bd": 301}
    codec, library = bpe_codec.Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", "abd abc bd", "xabc"):
        assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)
    with pytest.raises(ValueError, match="no token for the bytes"):
        bpe_codec.piece_model({b"a": 0})


def test_model_is_a_valid_piece_model():
    ranks = bpe_codec.read_ranks(bpe_codec.vocabulary_path())
    model = sentencepiece.SentencePieceProcessor(model_proto=bpe_codec.piece_model(ranks))
    assert model.vocab_size() == len(ranks) + 1 and model.get_score(777) == -777.0 and model.unk_id() == len(ranks)


def test_units_join_to_the_text():
    import pyarrow as pa

    codes, first, units = unit_codes(pa.array(ODD))
    for i, text in enumerate(ODD):
        assert "".join(units[c] for c in codes[first[i] : first[i + 1]]) == (text or "")
    assert unit_codes(pa.array(["a b  c　\nd"]))[2] == ["a", " b  c　\nd"]
