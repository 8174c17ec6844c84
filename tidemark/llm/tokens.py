"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.session import ship_package, spread

#: Where the vocabulary files lie and which is used, unless the caller names another.
TOKENIZER_DIR = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.tiktoken"
#: Characters given to the tokenizer at once.
CHUNK = 20_000
#: Fixed value: the public pre-tokenization pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER, folder: str = TOKENIZER_DIR):
    """The tokenizer in this process; loaded once per Python worker."""
    import tiktoken

    with open(os.path.join(folder, name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Pieces that join to the text, each cut before a run of blanks, where the pattern begins anew.

    Where a stretch of ``size`` characters has no blank the piece grows to the next one.
    """
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(" ", start + 1, start + size), text.rfind("\n", start + 1, start + size))
        while cut > start and text[cut - 1].isspace():
            cut -= 1
        if cut <= start:
            following = [p for p in (text.find(" ", start + size), text.find("\n", start + size)) if p > 0]
            if not following or text[min(following) - 1].isspace():
                break
            cut = min(following)
        yield text[start:cut]
        start = cut
    yield text[start:]


def count_tokens(text: str | None, name: str = TOKENIZER, folder: str = TOKENIZER_DIR) -> int:
    """Number of tokens; 0 for NULL and empty texts."""
    if not text:
        return 0
    enc = encoder(name, folder)
    return sum(len(enc.encode_ordinary(part)) for part in chunks(text))


def with_tokens(documents: DataFrame, *keep: str, text: str = "text", name: str = TOKENIZER, folder: str = TOKENIZER_DIR) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``; only these and the text reach Python, and the text stays there."""
    schema = ", ".join(f"`{c}` {dict(documents.dtypes)[c]}" for c in keep) + ", n_tokens bigint"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[list(keep)].copy()
            out["n_tokens"] = [count_tokens(t, name, folder) for t in batch[text]]
            yield out

    ship_package(documents.sparkSession)
    return spread(documents.select(*keep, F.col(text))).mapInPandas(count, schema)
