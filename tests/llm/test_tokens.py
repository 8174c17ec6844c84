from __future__ import annotations

import os
import random

import pytest

from tidemark.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(tokens.TOKENIZER_DIR, tokens.TOKENIZER)), reason="no vocabulary files")


def test_chunks_join_and_count_alike():
    rng = random.Random(1)
    for size in (5, 17, 64):
        for _ in range(60):
            text = "".join(rng.choice([" ", "  ", "\n", "\n\n", "\t", "word", "42", "ü", "東京", "don't", "!!", "<|endoftext|>"]) for _ in range(60))
            parts = list(tokens.chunks(text, size))
            assert "".join(parts) == text
            enc = tokens.encoder()
            assert sum(len(enc.encode_ordinary(p)) for p in parts) == len(enc.encode_ordinary(text))


def test_null_empty_and_long():
    assert tokens.count_tokens(None) == tokens.count_tokens("") == 0
    assert tokens.count_tokens("a b " * 100_000) == pytest.approx(200_000, abs=2)


def test_with_tokens(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, None), (3, "", "y")], "doc_id bigint, text string, n_tokens string")
    assert sorted(tuple(r) for r in tokens.with_tokens(docs, "doc_id").collect()) == [(1, 2), (2, 0), (3, 0)]
