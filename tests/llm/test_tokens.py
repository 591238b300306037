"""Operators 1, 3 and 7 against the tokenizers library, with edge cases."""

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelcast.llm import bpe_codec, bytebpe, token_counts, token_files
from panelcast.llm.common import scratch

BYTE, WORD = bpe_codec.vocabulary_path(), token_files.vocabulary_path()
ODD = [None, "", " ", "  a  b ", "a \n b\n\n c", "<|endoftext|> x<|endoftext|>", "\x1c a\x1d", "don't  we'll\t\tgo", "é́ñ 日本語　x", "\r\n", "same text", "same text", "word " * 30_000]


tokenizer = functools.lru_cache(Tokenizer.from_file)


def library(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\xa0　\x1c\x85ab'sté1²!<|>ÀΣ", "<|endoftext|>", "'ll", " the"]), max_size=25).map("".join), min_size=1, max_size=4))
def test_ids_equal_the_library(texts):
    for t, got in zip(texts, bpe_codec.encode_texts(texts, BYTE)):
        assert np.frombuffer(got, "<u4").tolist() == library(BYTE, t)
        assert bpe_codec.decode_ids(got, BYTE) == tokenizer(BYTE).decode(library(BYTE, t), skip_special_tokens=False)
    enc = token_files._encoder(WORD)
    for t, got in zip(texts, enc(pa.array(texts))):
        assert got.tolist() == library(WORD, t)


def test_merges_apply_left_to_right():
    words = [b"aaaa", b"aaa", b"", b"the", b"\xff\xfe"]
    bpe = bytebpe.load(BYTE)
    for w, got in zip(words[:4], bytebpe.merge_all(words, bpe)):
        assert np.frombuffer(got, "<u4").tolist() == library(BYTE, w.decode())


def test_decode_of_unknown_ids_and_broken_utf8():
    bpe = bytebpe.load(BYTE)
    half = int(bpe.byte_id[0xC3])
    assert bpe_codec.decode_ids(np.array([half, 1 << 30], "<u4").tobytes(), BYTE) == "�"


def frame(spark, texts):
    rows = [(i, t, None, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string, n_tokens int")


def test_round_trip_and_counts(spark):
    df = frame(spark, ODD)
    got = {r["doc_id"]: r for r in bpe_codec.round_trip(df, BYTE).collect()}
    count = {r["doc_id"]: r for r in token_counts.count_tokens(df, BYTE, limit=3).collect()}
    for i, t in enumerate(ODD):
        ids = library(BYTE, t)
        assert got[i]["n_tokens"] == count[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
        assert count[i]["n_bytes"] == len((t or "").encode()) and count[i]["over_limit"] == (len(ids) > 3)
    both = bpe_codec.decode(bpe_codec.encode(df, BYTE).drop("text"), BYTE).collect()
    assert {r["doc_id"]: r["text"] for r in both} == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe_codec.round_trip(df.limit(0), BYTE).count() == 0 and token_counts.count_tokens(df.limit(0), BYTE).count() == 0


def test_columns_named_like_results_are_kept(spark):
    df = spark.createDataFrame([(7, "a b", 1, "x", True, None)], "n_tokens long, text string, ids_sha256 int, kept_ string, Over_limit boolean, in_n_tokens int")
    row = bpe_codec.round_trip(df, BYTE).first().asDict()
    assert (row["in_in_n_tokens"], row["in_n_tokens"], row["in_ids_sha256"], row["kept_"], row["text"]) == (7, None, 1, "x", "a b") and row["n_tokens"] == len(library(BYTE, "a b"))
    row = token_counts.count_tokens(df, BYTE, limit=1).first().asDict()
    assert row["in_Over_limit"] is True and row["over_limit"] is True and row["in_in_n_tokens"] == 7
    texts = spark.createDataFrame([("p", b"")], "text string, ids binary")
    assert bpe_codec.decode(texts, BYTE).first().asDict() == {"in_text": "p", "ids": b"", "text": ""}


def test_proven_strings_are_single_tokens():
    proven = token_counts.prove_whole_tokens(BYTE)
    assert len(proven) > 40_000 and " the" in proven and "a b" not in proven
    assert all(len(library(BYTE, w)) == 1 for w in sorted(proven)[::997])


@pytest.mark.parametrize("shard_bytes", [1 << 30, 200])
def test_token_files(spark, shard_bytes):
    texts = ODD + ["α β γ", "Tie"]
    df = frame(spark, texts).union(spark.createDataFrame([(3, "second text of 3", None, "", 0), (None, "no id", None, "", 0)], frame(spark, []).schema))
    folder = token_files.write_token_files(df, scratch(spark, "t"), WORD, seq_len=64, batch_seqs=4, shard_bytes=shard_bytes)
    rows = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    assert len(rows) == len(texts) + 2 and rows[0]["doc_id"] is None
    assert [r["doc_id"] for r in rows[1:]] == sorted([*range(len(texts)), 3])
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
        if r["doc_id"] not in (3, None):
            ids = np.array(library(WORD, texts[r["doc_id"]]) + [2], "<u4")
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    # random access: sequences are full but the last of a shard, and masks say which ids are real
    for m in spark.read.parquet(f"{folder}/manifest").collect():
        n = -(-m["n_tokens"] // 64)
        ids, masks = token_files.read_sequences(folder, m["ids_file"], list(range(n)))
        assert ids.shape == masks.shape == (n, 64) and masks.sum() == m["n_tokens"] and (ids[masks == 0] == 0).all()


def test_token_files_of_an_empty_table(spark):
    folder = token_files.write_token_files(frame(spark, []), scratch(spark, "t"), WORD)
    assert token_files.read_documents(spark, folder).count() == 0
