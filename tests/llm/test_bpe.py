"""Byte-level BPE against the library that defines it, and back."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import cases
from claimlake.llm import bpe, encoding, queries

PATH, PATTERN = queries.tokenizer_path(queries.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def expected(library, key, text):
    ids = library.encode_ordinary(text or "")
    return key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


TEXTS = ["", " ", "\n", " a", "a ", "a  b", "a \n b", "a\nb", "\na", "a\n", "a\n\nb", "\n\n", "a\tb", "it's we'll I'd o'clock 'tis dogs'", "don't  stop", "x" * 700, "=" * 300 + "\n" + "-" * 77, "日本語 текст émigré naïve", "ひらがな" * 40,
         "a b c　 d", "\x1c\x1d x\x1f", "123 4567 8,901.5", "<|endoftext|> a <|endoftext|>", "é ​﻿ 👩‍👩‍👧", "end.\nNext (line) \"quoted\".\n  indented\n\ttab", "word." * 50, "a\x00b\x85c"]


def test_texts_of_every_kind(library):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice(["a", "b", " ", " ", "\n", ".", "'", "s", "é", "1", "\t", " ", "word", "Thing"]) for _ in range(rng.randrange(40))) for _ in range(800)]
    codec = bpe.codec(PATH, PATTERN)
    for turn in range(2):  # new words, then remembered ones
        got = [np.frombuffer(x, "<u4") for x in codec.encode(texts)]
        assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]
        assert [b.decode() for b in codec.decode(got)] == texts


@pytest.mark.parametrize("room", [20, 50, 200, 1000])
def test_full_memory_and_small_pieces(library, monkeypatch, room):
    monkeypatch.setattr(encoding, "CACHE_WORDS", room)
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 300)
    monkeypatch.setattr(encoding, "BLOCK", 7)
    for name, value in (("WORDS", 5), ("WORD_BYTES", 40), ("TOKENS", 11), ("KNOWN_PIECES", 20)):
        monkeypatch.setattr(bpe, name, value)
    texts = TEXTS + [r[1] for r in cases.edge_rows() if r[1] and len(r[1]) < 5000]
    codec = bpe.Bpe(PATH, PATTERN)
    got = [np.frombuffer(x, "<u4") for x in codec.encode(texts)]
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in codec.decode(got)] == texts


def test_edge_rows(spark, library):
    df = cases.edge_docs(spark).withColumns({c: F.lit("clash") for c in ("ids", "bytes", "ids_sha256", "__other")})
    rows = cases.edge_rows()
    assert Counter(tuple(r) for r in bpe.round_trip(df, PATH, PATTERN).collect()) == Counter(expected(library, r[0], r[1]) for r in rows)
    ids = bpe.encoded(df, PATH, PATTERN)
    assert set(ids.columns) == set(df.columns) - {"text"}
    back = bpe.decoded(ids, PATH, PATTERN)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.select("doc_id", "bytes").collect()) == Counter((r[0], (r[1] or "").encode()) for r in rows)
    assert bpe.round_trip(cases.empty_docs(spark), PATH, PATTERN).count() == 0


def test_whole_table(spark, library, sf_dir):
    got = queries.op13_bpe(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(tuple(r) for r in got.collect()) == Counter(expected(library, r.doc_id, r.text) for r in docs)
