"""Token counts by the whole-token shortcut.

A vocabulary string that the tokenizer encodes alone as one token costs one token wherever it stands as a pre-token, since
pre-tokens are merged apart from each other. ``whole_tokens`` proves this string by string, once, with the library
itself; tasks then count matching pre-tokens by a set lookup and merge only the rest, each distinct one once per
batch of remembered costs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from opspark.llm.common import byte_size, small_batches, table

#: Costs of merged pre-tokens that a worker remembers before it starts anew.
REMEMBERED = 200_000

#: The vocabulary file that the query counts with.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_text(name: str = VOCABULARY) -> str:
    """The tokenizer's file as text. It has a fixed size, so it may be sent to every task."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def split_pattern(spec: dict) -> str:
    """The pattern of the pre-tokenizer's split step."""
    return next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")


def _plain(text: str) -> bool:
    """Whether lower-casing alone does what the normalizer does, but for white space, which is dropped anyway.

    Final sigma is the one letter whose lower case depends on its neighbours in Python.
    """
    return text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))


class Counter:
    """Counts tokens of texts; made once in each Python worker."""

    def __init__(self, spec_text: str, whole: frozenset[str]):
        spec = json.loads(spec_text)
        self.tokenizer = Tokenizer.from_str(spec_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # the library's white space, written out: the pattern language used here has four control characters more
        pattern = split_pattern(spec).replace(r"[^\s", r"[^\p{White_Space}")
        self.find = regex.compile(pattern).findall
        self.special = re.compile("(" + "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) + ")")
        self.first = tuple({t["content"][0] for t in spec["added_tokens"]})
        self.whole = whole
        self.cost: dict[str, int] = _Costs(self)

    def merged(self, pre_token: str) -> int:
        """Tokens of a pre-token that is not a whole token."""
        return len(self.tokenizer.encode(pre_token, add_special_tokens=False).ids)

    def piece(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        text = text.lower() if _plain(text) else self.tokenizer.normalizer.normalize_str(text)
        cost = self.cost
        if len(cost) > REMEMBERED:
            cost.clear()
        return sum(map(cost.__getitem__, self.find(text)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not any(c in text for c in self.first) or not self.special.search(text):
            return self.piece(text)
        # a special token stands for itself, and what lies between is encoded apart
        parts = self.special.split(text)
        return len(parts) // 2 + sum(self.piece(p) for p in parts[::2])


class _Costs(dict):
    def __init__(self, counter: Counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, pre_token: str) -> int:
        n = 1 if pre_token in self.counter.whole else self.counter.merged(pre_token)
        self[pre_token] = n
        return n


def whole_tokens(spec_text: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer, given them alone, keeps as one pre-token and encodes as one token."""
    spec = json.loads(spec_text)
    tokenizer = Tokenizer.from_str(spec_text)
    end = spec["model"]["end_of_word_suffix"] or ""
    letters = {c: b for b, c in _byte_letters().items()}
    names = []
    for name in spec["model"]["vocab"]:
        if name.endswith(end) and all(c in letters for c in name[: len(name) - len(end)]):
            try:
                names.append(bytes(letters[c] for c in name[: len(name) - len(end)]).decode())
            except UnicodeDecodeError:
                continue
    find = regex.compile(split_pattern(spec).replace(r"[^\s", r"[^\p{White_Space}")).findall
    encoded = tokenizer.encode_batch(names, add_special_tokens=False)
    return frozenset(n for n, e in zip(names, encoded) if len(e.ids) == 1 and find(n) == [n])


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def count_tokens(spark: SparkSession, text: Column, spec_text: str) -> Column:
    """Tokens of a text column; null and empty texts have none. Repeated rows count each by itself."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast((spec_text, whole_tokens(spec_text)))
    counters: list[Counter] = []

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not counters:
            counters.append(Counter(*sent.value))
        for batch in batches:
            yield pd.Series([counters[0].count(t) for t in batch], dtype="int64")

    return tokens(text)


def op1_whole_token_counts(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id", byte_size(docs["text"]).alias("n_bytes"), count_tokens(spark, docs["text"], vocabulary_text()).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > 2048)
