"""Sizes of texts in tokens of a public tokenizer; the vocabulary's path is a parameter."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The public split pattern that goes with the byte-level vocabularies.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Texts are handed to the tokenizer in slices of at least this many characters, cut where the pattern starts a new piece.
SLICE = 200_000
#: Before a single blank between two signs every pattern starts anew, so a cut there changes no token.
_CUT = re.compile(r"(?<=\S)\s(?=\S)")


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
    return tiktoken.Encoding(Path(path).stem, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of a whole text; 0 for null and empty. Very long texts are encoded in slices, with the same count."""
    if not text:
        return 0
    enc = encoder(path)
    n, start = 0, 0
    while start < len(text):
        cut = _CUT.search(text, start + SLICE) if len(text) - start > SLICE else None
        end = cut.start() if cut else len(text)
        n += len(enc.encode_ordinary(text[start:end]))
        start = end
    return n


def sized(docs: DataFrame, keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, the columns in keep, n_tokens, and n_context: the tokens of the first line where more follows.

    The first line of a text of several lines is its heading; the rest bears the loss in training.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select("doc_id", *keep).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf.pop("text")
            pdf["n_tokens"] = [count_tokens(t, vocabulary) for t in texts]
            heads = [t.split("\n", 1)[0] if t and "\n" in t else "" for t in texts]
            pdf["n_context"] = [min(count_tokens(h, vocabulary), n) for h, n in zip(heads, pdf["n_tokens"])]
            yield pdf

    return docs.select("doc_id", *keep, "text").mapInPandas(run, f"{fields}, n_tokens bigint, n_context bigint")
