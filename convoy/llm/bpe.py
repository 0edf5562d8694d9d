"""BPE encoding and decoding by batched numpy merge rounds.

The distinct words of a batch lie in one flat array of symbols. A round finds the rank of every
adjacent pair by binary search over the sorted pair keys, merges the lowest-ranked pair of every word
at all its places, and drops the words that are finished. Only words not seen before by the task
are merged; texts are put together from the words' results.

The model is a tokenizer file with byte-level symbols and a word end, as its ``model`` section lists
them; its path is a parameter and is read on the executors, so it must be installed there.
"""

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_RANK = np.iinfo(np.int64).max
MAX_KNOWN_WORDS = 100_000  # words a task remembers before it starts anew; results don't depend on it

#: Signs at which Python cuts texts but the vocabulary doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """Pair keys (left * size + right) in order, with rank and merged symbol of each pair."""

    size: int
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray


def read_model(path: str) -> tuple[dict, dict[str, int], Merges]:
    """The whole file, its vocabulary, and its merges as arrays."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    size = max(vocab.values()) + 1
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return spec, vocab, Merges(size, keys[order], order.astype(np.int64), merged[order])


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and lengths of all words after the last merge. ``lengths`` must be positive."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    ended = []
    while len(symbols):
        keys = symbols[:-1] * merges.size + symbols[1:]
        at = np.minimum(np.searchsorted(merges.keys, keys), len(merges.keys) - 1)
        known = (merges.keys[at] == keys) & (word[:-1] == word[1:])
        rank = np.full(len(symbols), NO_RANK)
        rank[:-1][known] = merges.ranks[at[known]]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        counts = np.diff(np.r_[starts, len(word)])
        lowest = np.minimum.reduceat(rank, starts)
        going = np.repeat(lowest != NO_RANK, counts)
        ended.append((word[~going], symbols[~going]))
        take = np.flatnonzero(going & (rank == np.repeat(lowest, counts)))
        if not len(take):
            break
        # of a run of overlapping places every second one, from the left
        run = np.flatnonzero(np.r_[True, np.diff(take) != 1])
        place = np.arange(len(take)) - np.repeat(run, np.diff(np.r_[run, len(take)]))
        take = take[place % 2 == 0]
        symbols = symbols.copy()
        symbols[take] = merges.merged[at[take]]
        stay = going
        stay[take + 1] = False
        symbols, word = symbols[stay], word[stay]
    word = np.concatenate([w for w, _ in ended]) if ended else np.empty(0, np.int64)
    symbols = np.concatenate([s for _, s in ended]) if ended else np.empty(0, np.int64)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.bincount(word, minlength=len(lengths))


def splitter(spec: dict) -> "regex.Pattern | None":
    """Cuts a text at the special tokens, which stand for themselves wherever they occur."""
    strings = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None


class WordEnd:
    """Encodes texts with a word-end vocabulary: NFC, lower case, white space dropped."""

    def __init__(self, path: str):
        self.spec, self.vocab, self.merges = read_model(path)
        self.end = self.spec["model"]["end_of_word_suffix"]
        pattern = self.spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace("\\s", "\\p{White_Space}"))
        self.special = splitter(self.spec)
        self.special_ids = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        letters = byte_symbols()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.last = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        self.names = {i: s for s, i in {**self.vocab, **self.special_ids}.items()}
        self.words: dict[str, tuple[int, str, str]] = {}
        self.known: dict[str, tuple[int, str, str]] = {}

    def chunks(self, text: str) -> list[str]:
        """Parts of a text that no word crosses: what lies between white space. A special token is
        given as its string after a null sign."""
        if any(t in text for t in self.special_ids):
            found = []
            for piece in self.special.split(text):
                found += ["\0" + piece] if piece in self.special_ids else self._chunks(piece)
            return found
        return self._chunks(text)

    def _chunks(self, text: str) -> list[str]:
        # lower case sign by sign: a sigma doesn't look at what follows
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [text] if ODD_SPACE.search(text) else text.split()

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks not yet known; keep number of tokens, ids and decoded text of each."""
        cut = {}
        for chunk in chunks:
            if chunk not in self.known:
                if chunk[0] == "\0" and chunk[1:] in self.special_ids:
                    self.known[chunk] = (1, str(self.special_ids[chunk[1:]]), chunk[1:])
                else:
                    cut[chunk] = self.pattern.findall(chunk)
        words = list(set().union(*cut.values()) - self.words.keys())
        if words:
            data = [w.encode("utf-8", "surrogatepass") for w in words]
            lengths = np.array([len(d) for d in data], np.int64)
            flat = np.frombuffer(b"".join(data), np.uint8)
            symbols = self.inner[flat]
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.last[flat[ends]]
            ids, counts = merge_rounds(symbols, lengths, self.merges)
            ids = ids.tolist()
            shown, names, at = [str(i) for i in ids], [self.names[i] for i in ids], 0
            for word, n in zip(words, counts.tolist()):
                to = at + n
                self.words[word] = (n, " ".join(shown[at:to]), " ".join(names[at:to]))
                at = to
        for chunk, own in cut.items():
            if len(own) == 1:
                self.known[chunk] = self.words[own[0]]
            elif own:
                n, shown, names = zip(*[self.words[w] for w in own])
                self.known[chunk] = (sum(n), " ".join(shown), " ".join(names))
            else:
                self.known[chunk] = (0, "", "")

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of tokens, ids and decoded text of each text; the last two as joined by spaces."""
        if len(self.known) > MAX_KNOWN_WORDS:
            self.known.clear()
            self.words.clear()
        cut = [self.chunks(t) for t in texts]
        self.learn(set().union(*cut))
        for own in cut:
            found = [f for c in own if (f := self.known[c])[0]]
            if found:
                n, ids, shown = zip(*found)
                yield sum(n), " ".join(ids), " ".join(shown)
            else:
                yield 0, "", ""


def pieces(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts with about ``most`` characters, so that what a batch needs is bounded."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded(text: Column, path: str, digests: bool = False) -> Column:
    """Struct of ``n_tokens``, ``ids`` (joined by spaces) and ``decoded``, or, if ``digests``, with the
    SHA-256 of either instead."""

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = WordEnd(path)
        for batch in batches:
            for texts in pieces(["" if t is None else t for t in batch]):
                found = model.encode(texts)
                rows = [(n, sha(i), sha(d)) for n, i, d in found] if digests else list(found)
                yield pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "n_tokens long, ids string, decoded string")(text.cast("string"))


def encode(docs: DataFrame, path: str, text_column: str = "text", out: str = "encoding") -> DataFrame:
    """``docs`` with a struct column ``out``: n_tokens, ids (array), decoded, ids_sha256, decoded_sha256.

    Null counts as the empty text, which has no tokens. Nothing is added at begin or end, nothing cut
    or padded; the strings of special tokens inside texts become those tokens. Decoding joins the
    tokens' strings by spaces, as the file names no decoder. ``out`` replaces a column of its name; other
    columns pass through, but ``__encoded`` is the operator's own name. Characters that came into Unicode after the tables of the installed
    ``regex`` may be cut otherwise than by another library.
    """
    e = F.col("__encoded")
    ids = F.when(e["n_tokens"] > 0, F.split(e["ids"], " ").cast("array<int>")).otherwise(F.array())
    return (
        docs.withColumn("__encoded", encoded(F.col(text_column), path))
        .withColumn(
            out,
            F.struct(
                e["n_tokens"].alias("n_tokens"),
                ids.cast("array<int>").alias("ids"),
                e["decoded"].alias("decoded"),
                F.sha2(e["ids"].cast("binary"), 256).alias("ids_sha256"),
                F.sha2(e["decoded"].cast("binary"), 256).alias("decoded_sha256"),
            ),
        )
        .drop("__encoded")
    )


def encoding_digests(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, as ``encode`` has them.

    Repeated rows are encoded each; further columns are ignored; an empty table gives an empty result.
    """
    done = docs.select(
        F.col(id_column).alias("doc_id"), encoded(F.col(text_column), path, digests=True).alias("e")
    )
    return done.select(
        "doc_id",
        F.col("e.n_tokens").alias("n_tokens"),
        F.col("e.ids").alias("ids_sha256"),
        F.col("e.decoded").alias("decoded_sha256"),
    )
