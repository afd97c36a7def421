"""Suffix arrays by induced sorting, with permuted common prefixes; a bucket at a time in numpy."""

from __future__ import annotations

import numpy as np

#: Texts hold bytes plus two. The end mark is the least character and stands once, at the end.
END, SEPARATOR, FIRST_BYTE = 0, 1, 2


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces as one text, a separator after each and the end mark last; and where each piece starts."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.uint16) + FIRST_BYTE
    text[starts + lengths] = SEPARATOR
    text[-1] = END
    return text, starts


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (S-type). A run of a character has its last one's type."""
    n = len(text)
    small = np.ones(n, bool)
    differs = np.append(text[:-1] != text[1:], True)
    run_end = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    inner = run_end < n - 1
    small[inner] = text[run_end[inner]] < text[run_end[inner] + 1]
    return small


def leftmost_small(small: np.ndarray) -> np.ndarray:
    """Places of S-type suffixes after an L-type one, in text order; the end mark is the last of them."""
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-small ones in order.

    L-types go to the fronts of their buckets while these are read forwards, then S-types to the backs
    while they are read backwards. A bucket is read in waves: what it has, then what that added to it.
    """
    letters = int(text.max()) + 1
    counts = np.bincount(text, minlength=letters)
    ends = np.cumsum(counts)
    starts = ends - counts
    used = np.flatnonzero(counts)
    slots = np.zeros(len(text), np.int64)

    def give(read: np.ndarray, kind: bool, free: np.ndarray, step: int) -> None:
        """The suffixes before those read, if of this type, to the next free slots of their buckets."""
        places = read[read > 0] - 1
        places = places[small[places] == kind]
        if not len(places):
            return
        first = text[places]
        order = np.argsort(first, kind="stable")
        first = first[order]
        here = np.bincount(first, minlength=letters)
        rank = np.arange(len(first)) - (np.cumsum(here) - here)[first]
        slots[free[first] + step * rank] = places[order]
        free += step * here

    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    bounds = np.searchsorted(text[seeds], np.arange(letters + 1))
    front = starts.copy()
    for c in used:
        low = starts[c]
        while low < front[c]:
            low, high = front[c], low
            give(slots[high:low], False, front, 1)
        give(seeds[bounds[c] : bounds[c + 1]], False, front, 1)
    back = ends - 1
    slots[0] = len(text) - 1
    for c in used[::-1]:
        high = ends[c] - 1
        while high > back[c]:
            high, low = back[c], high
            give(slots[high + 1 : low + 1][::-1], True, back, -1)
        give(slots[starts[c] : front[c]][::-1], True, back, -1)
    return slots


def _names(text: np.ndarray, ordered: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number for each of the sorted substrings, equal for equal ones. lengths is by place in the text."""
    a, b = ordered[:-1], ordered[1:]
    size = lengths[a]
    same = size == lengths[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        differ = text[a[left] + k] != text[b[left] + k]
        same[left[differ]] = False
        k += 1
        left = left[~differ & (size[left] > k)]
    return np.concatenate([[0], np.cumsum(~same)])


def _sorted_names(names: np.ndarray, rounds: int) -> np.ndarray:
    """Ranks of the suffixes of the string of names. Each round sorts substrings of twice as many names."""
    rank, width = names, 1
    for _ in range(rounds):
        top = int(rank.max()) + 1
        if top == len(rank):
            break
        following = np.zeros(len(rank), np.int64)
        following[: len(rank) - width] = rank[width:] + 1
        key = rank * (top + 1) + following
        order = np.argsort(key)
        fresh = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = fresh
        width *= 2
    return rank


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The suffixes of a text that ends with its only end mark, in order.

    Leftmost-small substrings are sorted by a first induction and named; names that repeat make a
    shorter string, whose suffixes are sorted by doubling, as its alphabet is as large as itself. The
    order found seeds the second induction. With `depth`, suffixes that agree in so many characters
    may stand in any order among themselves.
    """
    small = classify(text)
    seeds = leftmost_small(small)
    if not len(seeds):
        return np.arange(len(text))[::-1].copy()
    lengths = np.ones(len(text), np.int64)
    lengths[seeds[:-1]] = np.diff(seeds) + 1
    rough = induce(text, small, seeds)
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds] = True
    ordered = rough[is_seed[rough]]
    by_place = np.zeros(len(text), np.int64)
    by_place[ordered] = _names(text, ordered, lengths)
    names = by_place[seeds]
    # Each substring takes two characters at least.
    rounds = 64 if depth is None else max(1, int(depth).bit_length())
    return induce(text, small, seeds[np.argsort(_sorted_names(names, rounds))])


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Permuted common prefixes up to a depth: for each suffix of the order, by place in the text, how many
    characters it shares with the one before it. A separator or the end mark ends a prefix.

    The order may hold some of the suffixes only; the others have 0.
    """
    shared = np.zeros(len(text), np.int64)
    here, there = order[1:], order[:-1]
    padded = np.concatenate([text, np.zeros(depth + 8, text.dtype)])
    inner = padded >= FIRST_BYTE
    # Eight characters are compared at once, and the last eight one by one.
    n = len(padded) - 7
    whole = np.ones(n, bool)
    words = np.zeros(n, np.uint64)
    for j in range(8):
        whole &= inner[j : j + n]
        words |= ((padded[j : j + n] - FIRST_BYTE) & 0xFF).astype(np.uint64) << np.uint64(8 * j)
    a, b, k = here, there, 0
    while k + 8 <= depth and len(a):
        same = (words[a + k] == words[b + k]) & whole[a + k] & whole[b + k]
        a, b, k = a[same], b[same], k + 8
        shared[a] = k
    at = shared[here]
    left = np.flatnonzero(at < depth)
    a, b, at = here[left], there[left], at[left]
    for _ in range(8):
        same = (padded[a + at] == padded[b + at]) & inner[a + at] & (at < depth)
        a, b, at = a[same], b[same], at[same] + 1
        shared[a] = at
    return shared
