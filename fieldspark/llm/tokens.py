"""Counting tokens of a public byte-level BPE tokenizer.

A byte-level BPE tokenizes each *pre-token* (a word with its blank, a run of digits, ...) on its
own, so a text's tokens are the sum over its pre-tokens. Pre-tokens repeat, so their counts are kept
in a bounded table per worker. The vocabulary file is a parameter and stays where it is installed.
"""

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

#: Entries of the per-worker table of pre-token counts; it is emptied when full (counts stay exact).
CACHE_ENTRIES = 400_000

# The tokenizer's published pre-token pattern, as itself and for texts of ASCII only.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

#: Each pre-token's token count is kept with these flags in the bits above COUNT.
BLANK_START, LINE, STOP, BLANK = 1 << 40, 1 << 41, 1 << 42, 1 << 43
COUNT = BLANK_START - 1
STOPS = (".", "!", "?", "…", ":", ";", '."', '!"', '?"', ".)", "?)", "!)", "。", "！", "？")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Counter:
    """Pre-tokens of a text and their token counts."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        space = r"\p{White_Space}"
        self._any = regex.compile(_PATTERN.replace(r"\s+(?!\S)|\s+", rf"{space}+(?!\P{{White_Space}})|{space}+").replace(r"[^\s", rf"[^{space}")).findall
        self._ascii = re.compile(_ASCII, re.ASCII).findall
        self._known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        return self._ascii(text) if text.isascii() else self._any(text)

    def _measure(self, p: str) -> int:
        n = len(self.encoding.encode_ordinary(p))
        if p[0].isspace():
            n |= BLANK_START
        if "\n" in p or "\r" in p:
            n |= LINE
        if p.endswith(STOPS):
            n |= STOP
        return n | BLANK if p.isspace() else n

    def measures(self, pre: list[str]) -> np.ndarray:
        """Token count and flags of each pre-token."""
        known = self._known
        try:
            return np.array([known[p] for p in pre], dtype=np.int64)
        except KeyError:
            pass
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for p in set(pre):
            if p not in known:
                known[p] = self._measure(p)
        return np.array([known[p] for p in pre], dtype=np.int64)

    def tokens(self, text: str | None) -> int:
        return int((self.measures(self.pre_tokens(text)) & COUNT).sum()) if text else 0

    def rest_tokens(self, pre: str, skip: int) -> int:
        """Tokens of what follows the first ``skip`` tokens of a pre-token, as a text of its own."""
        done = int(self.token_bytes(pre)[:skip].sum())
        return len(self.encoding.encode_ordinary(pre[len(pre.encode("utf-8")[:done].decode("utf-8", "ignore")) :]))

    def token_bytes(self, pre: str) -> np.ndarray:
        """Byte length of each token of one pre-token."""
        return np.array([len(b) for b in self.encoding.decode_tokens_bytes(self.encoding.encode_ordinary(pre))])


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary."""
    return Counter(path)


def count_column(text, path: str | None = None):
    """Number of tokens of a text column; NULL and empty text have 0."""
    from pyspark.sql import functions as F

    where = path or default_path()

    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(where)
        for s in it:
            yield pd.Series([c.tokens(t) for t in s], dtype="int64")

    return F.pandas_udf(run, "bigint")(text)
