"""Token counts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of a batch are rows of a ragged array (values and row lengths). In every step
each row merges its own lowest-ranked pair, all rows at once; a row is done when none of its pairs has
a rank. What survives is counted, not kept. Counts of pre-tokens are summed per text.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.bpe import byte_symbols, merge_rounds, pieces, read_model, splitter

#: Fixed value: how the byte-level vocabulary cuts texts before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MAX_KNOWN_TOKENS = 200_000  # counts a task remembers before it starts anew; results don't depend on it
SPACE_RUN = re.compile(r"\s ")


class ByteLevel:
    """Counts tokens of texts with a byte-level vocabulary."""

    def __init__(self, path: str):
        spec, vocab, self.merges = read_model(path)
        self.symbols = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pattern = PRE_TOKENS.replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}")
        self.pattern = regex.compile(pattern)
        self.special = splitter(spec)
        self.special_strings = [t["content"] for t in spec["added_tokens"]]
        self.tokens: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def chunks(self, text: str) -> tuple[list[str], int]:
        """Parts of a text that no pre-token crosses, and the number of special tokens.

        A blank belongs to what follows, so a text is cut before its blanks, unless other white space
        precedes one.
        """
        if any(t in text for t in self.special_strings):
            parts = self.special.split(text)
            return [c for p in parts[::2] for c in self._chunks(p)], len(parts) // 2
        return self._chunks(text), 0

    def _chunks(self, text: str) -> list[str]:
        if SPACE_RUN.search(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def learn(self, chunks: set[str]) -> None:
        cut = {c: self.pattern.findall(c) for c in chunks if c not in self.known}
        tokens = list(set().union(*cut.values()) - self.tokens.keys())
        if tokens:
            data = [t.encode("utf-8", "surrogatepass") for t in tokens]
            lengths = np.array([len(d) for d in data], np.int64)
            values = self.symbols[np.frombuffer(b"".join(data), np.uint8)]
            _, counts = merge_rounds(values, lengths, self.merges)
            self.tokens.update(zip(tokens, counts.tolist()))
        get = self.tokens.__getitem__
        self.known.update((c, sum(map(get, own))) for c, own in cut.items())

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > MAX_KNOWN_TOKENS:
            self.known.clear()
            self.tokens.clear()
        cut = [self.chunks(t) for t in texts]
        self.learn(set().union(*(c[0] for c in cut)))
        get = self.known.__getitem__
        return [sum(map(get, chunks)) + special for chunks, special in cut]


def n_tokens(text: Column, path: str) -> Column:
    """Number of tokens of a text; 0 for null and the empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = ByteLevel(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            yield pd.Series([n for run in pieces(texts) for n in model.count(run)], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")(text.cast("string"))


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Null counts as the empty text. Strings of special tokens inside texts count as one token. Repeated
    rows are counted each; further columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    counted = docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(F.col(text_column), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
