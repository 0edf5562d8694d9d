"""External induced sorting of suffixes.

A suffix is of type S if it is less than the next one, else of type L; an S after an L starts a
substring (LMS). The starts are ordered by sorting their substrings by induction, naming them and sorting the
reduced string of names, by doubled ranks if it is short and else recursively; then all suffixes follow by induction: scanning in order,
each suffix puts the one before it into the queue of its first character.

The queues are priority queues by (character, order of arrival): a character's entries come out
in one piece, in the order they came in. Up to ``most`` entries stay in memory, the rest lies in
runs on disk, sorted by character and read once. Texts are numpy arrays and may be memory maps. Scratch
files go to the folder that the caller gives and removes.
"""

import os
from collections import defaultdict

import numpy as np

LISTED = 1 << 22  # reduced strings up to this length are put in order by ranks in memory: many characters, few entries each


class Queue:
    """Entries by character in order of arrival; overflows to ``folder``."""

    def __init__(self, folder: str | None, most: int):
        self.folder, self.most = folder, most
        self.held: dict[int, list[np.ndarray]] = defaultdict(list)
        self.size = 0
        self.runs: list[tuple[np.ndarray, dict[int, tuple[int, int]]]] = []

    def push(self, characters: np.ndarray, entries: np.ndarray) -> None:
        if not len(entries):
            return
        order = np.argsort(characters, kind="stable")
        characters, entries = characters[order], entries[order]
        first = np.flatnonzero(np.r_[True, characters[1:] != characters[:-1]])
        for c, a, b in zip(characters[first].tolist(), first.tolist(), [*first[1:].tolist(), len(entries)]):
            self.held[c].append(entries[a:b])
        self.size += len(entries)
        if self.folder is not None and self.size > self.most:
            self._spill()

    def _spill(self) -> None:
        places, at = {}, 0
        path = os.path.join(self.folder, f"run-{id(self)}-{len(self.runs)}")
        with open(path, "wb") as file:
            for c in sorted(self.held):
                n = sum(map(len, self.held[c]))
                for part in self.held[c]:
                    file.write(np.ascontiguousarray(part, np.int64).tobytes())
                places[c], at = (at, at + n), at + n
        self.runs.append((np.memmap(path, np.int64, "r"), places))
        self.held.clear()
        self.size = 0

    def pop(self, c: int) -> np.ndarray:
        """What has arrived for the character so far; runs first, they are older."""
        parts = [np.array(run[slice(*places.pop(c))]) for run, places in self.runs if c in places]
        own = self.held.pop(c, [])
        self.size -= sum(map(len, own))
        parts += own
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S. The last one, the least character, is."""
    n = len(text)
    rise = np.ones(n, np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    # equal neighbours take the type of the next change
    change = np.where(rise != 0, np.arange(n), n - 1)
    change = np.minimum.accumulate(change[::-1])[::-1]
    return rise[change] > 0


def _by_queues(text, is_s, lms, sigma, folder, most) -> np.ndarray:
    """All suffixes in the order that ``lms`` (in order) induces."""
    up, low_parts = Queue(folder, most), [None] * sigma
    first = text[lms].astype(np.int64)
    given = Queue(folder, most)
    given.push(first, lms)
    starts: list = [None] * sigma
    for c in range(sigma):
        done, now = [], up.pop(c)
        while len(now):
            done.append(now)
            before = now[now > 0] - 1
            before = before[~is_s[before]]
            up.push(text[before].astype(np.int64), before)
            now = up.pop(c)
        low_parts[c] = np.concatenate(done) if done else np.empty(0, np.int64)
        starts[c] = given.pop(c)
        before = starts[c][starts[c] > 0] - 1
        up.push(text[before].astype(np.int64), before)
    down, parts = Queue(folder, most), []
    for c in range(sigma - 1, -1, -1):
        done, now = [], down.pop(c)
        while len(now):
            done.append(now)
            before = now[now > 0] - 1
            before = before[is_s[before]]
            down.push(text[before].astype(np.int64), before)
            now = down.pop(c)
        high = np.concatenate(done) if done else np.empty(0, np.int64)
        if c == 0:
            high = starts[0]  # the end of the text precedes no suffix
        low = low_parts[c][::-1]
        before = low[low > 0] - 1
        before = before[is_s[before]]
        down.push(text[before].astype(np.int64), before)
        parts += [high, low]
        low_parts[c] = None
    return np.concatenate(parts)[::-1]


def _by_ranks(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Suffixes of a string of names in order, from its places by name (``same``: with the name of the place before).

    Places of equal rank are told apart by the rank of what follows, twice as far on in every round, until all
    differ. The last name occurs once, so places of equal rank are never followed by the end.
    """
    n, order = len(order), order.copy()
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(same, 0, slots))
    alone = ~same & np.r_[~same[1:], True]
    slots, far = slots[~alone], 1
    while len(slots):
        places = order[slots]
        key = rank[places] * n + rank[places + far]
        by_key = np.argsort(key)
        places, key = places[by_key], key[by_key]
        order[slots] = places
        new = np.r_[True, key[1:] != key[:-1]]
        rank[places] = np.maximum.accumulate(np.where(new, slots, 0))
        slots, far = slots[~(new & np.r_[new[1:], True])], 2 * far
    return order


def suffix_array(text: np.ndarray, sigma: int, folder: str | None = None, most: int = 1 << 23) -> np.ndarray:
    """Positions of all suffixes in order. Characters are below ``sigma``; the last one is 0 and the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    is_s = types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1

    def induce(order: np.ndarray) -> np.ndarray:
        return _by_queues(text, is_s, order, sigma, folder, most)

    found = induce(lms)
    if len(lms) <= 1:
        return found
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = found[is_lms[found]]
    del found
    # name the substrings: from one start to the next, both included
    number = (np.cumsum(is_lms) - 1)[order]
    ends = np.r_[lms[1:], n - 1]
    lengths = (ends - lms)[number]
    same = np.zeros(len(order), bool)
    same[1:] = lengths[1:] == lengths[:-1]
    left, j = np.flatnonzero(same), 0
    while len(left):
        a = np.minimum(order[left] + j, n - 1)
        b = np.minimum(order[left - 1] + j, n - 1)
        equal = text[a] == text[b]
        same[left[~equal]] = False
        left = left[equal & (lengths[left] > j)]
        j += 1
    if len(lms) <= LISTED:
        return induce(lms[_by_ranks(number, same)])
    names = np.cumsum(~same) - 1
    reduced = np.empty(len(lms), np.int64)
    reduced[number] = names
    if names[-1] + 1 < len(lms):
        order = lms[suffix_array(reduced, int(names[-1]) + 1, folder, most)]
    return induce(order)
