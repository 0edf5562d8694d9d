"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
LETTER = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
UNSTEP = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that white space divides, and of words that only letters, digits and non-ASCII signs form.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
WORD_SIGNS = np.ones(256, bool)
WORD_SIGNS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


@dataclass(frozen=True)
class Words:
    """Place, end and hash of every word, and where each text's words begin (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, most: int = 1 << 21, texts: int = 1 << 30) -> list[tuple[int, int]]:
    """Ranges of texts with about ``most`` bytes and at most so many ``texts`` each (one text at least)."""
    found, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, a + texts, n)
        found.append((a, b))
        a = b
    return found


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of lower-cased (A-Z) texts. No word crosses texts. Hashes have 64 bits."""
    lowered = LOWER[data]
    inside = is_word[lowered]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    powers = np.full(n, STEP)
    if n:
        powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(LETTER[lowered] * powers, out=sums[1:])
    back = np.full(n + 1, UNSTEP)
    back[0] = 1
    np.cumprod(back, out=back)
    hashes = mixed((sums[ends] - sums[starts]) * back[starts])
    return Words(lowered, starts, ends, hashes, np.searchsorted(starts, offsets))


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` following words."""
    total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        total += hashes[i : i + len(total)] * PLACE[i]
    return mixed(total)
