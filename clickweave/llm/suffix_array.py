"""Suffix arrays by induced sorting, and permuted common prefixes, over arrays of small integers.

The text of a shard is sorted with numpy, a bucket at a time: scanning a bucket sends the predecessors of its suffixes
to the ends of their buckets, in order. Buckets are too many for that once leftmost-smaller (LMS) substrings have been
named, so the recursion scans item by item; its text has at most half the length, and about a third for prose.
"""

from __future__ import annotations

import numpy as np


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S type); the last is a sentinel and is."""
    n = len(text)
    smaller = np.empty(n, bool)
    smaller[-1] = True
    differs = np.flatnonzero(text[:-1] != text[1:])
    # Equal neighbours have the type of the first unequal pair to their right.
    place = np.searchsorted(differs, np.arange(n - 1))
    inside = place < len(differs)
    at = differs[np.minimum(place, max(0, len(differs) - 1))] if len(differs) else np.zeros(n - 1, np.int64)
    smaller[:-1] = np.where(inside, text[at] < text[np.minimum(at + 1, n - 1)], False)
    return smaller


def _deal(items: np.ndarray, chars: np.ndarray, heaps: list[list[np.ndarray]]) -> None:
    """Append items to the heaps of their characters, keeping their order."""
    order = chars.argsort(kind="stable")
    items, chars = items[order], chars[order]
    edges = (np.flatnonzero(chars[1:] != chars[:-1]) + 1).tolist()
    for start, end in zip([0, *edges], [*edges, len(items)]):
        heaps[chars[start]].append(items[start:end])


def _scan(heap: list[np.ndarray], char: int, text: np.ndarray, wanted: np.ndarray, heaps: list) -> None:
    """Deal out the wanted predecessors of a bucket's suffixes; those that fall into the same bucket are scanned too."""
    at = 0
    while at < len(heap):
        # All that is there comes before what scanning it adds.
        before = (heap[at] if len(heap) == at + 1 else np.concatenate(heap[at:])) - 1
        at = len(heap)
        _send(before, char, text, wanted, heaps)


def _send(before: np.ndarray, char: int, text: np.ndarray, wanted: np.ndarray, heaps: list) -> None:
    before = before[wanted[before] & (before >= 0)]
    if len(before):
        _deal(before, text[before], heaps)


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order (or by their first characters, for LMS substrings)."""
    larger = ~smaller
    low: list[list[np.ndarray]] = [[] for _ in range(letters)]
    high: list[list[np.ndarray]] = [[] for _ in range(letters)]
    starts: list[list[np.ndarray]] = [[] for _ in range(letters)]
    _deal(lms, text[lms], starts)
    for char in range(letters):
        _scan(low[char], char, text, larger, low)
        for part in starts[char]:
            _send(part - 1, char, text, larger, low)
    # From the right; these heaps are in falling order.
    for char in range(letters - 1, -1, -1):
        _scan(high[char], char, text, smaller, high)
        if low[char]:
            low[char] = [np.concatenate(low[char])]
            _send(low[char][0][::-1] - 1, char, text, smaller, high)
    # The sentinel is the predecessor of nothing.
    out = [np.array([len(text) - 1])]
    for char in range(letters):
        out += low[char]
        if high[char]:
            out.append(np.concatenate(high[char])[::-1])
    return np.concatenate(out)


def _lms(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _names(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers for the LMS substrings, equal for equal ones and in their order; and how many there are."""
    place = np.empty(len(text), np.int64)
    place[lms] = np.arange(len(lms))
    length = np.diff(np.append(lms, len(text) - 1)) + 1
    sort = order[np.isin(order, lms, assume_unique=True)] if len(order) != len(lms) else order
    ranks = place[sort]
    sizes = length[ranks]
    # Sorted neighbours are compared a character at a time, all pairs at once.
    same = sizes[1:] == sizes[:-1]
    active = np.flatnonzero(same)
    a, b, sizes, depth = sort[:-1][active], sort[1:][active], sizes[1:][active], 0
    while len(active):
        inside = depth < sizes
        active, a, b, sizes = active[inside], a[inside], b[inside], sizes[inside]
        differs = (text[a + depth] != text[b + depth]) | (smaller[a + depth] != smaller[b + depth])
        same[active[differs]] = False
        active, a, b, sizes = active[~differs], a[~differs], b[~differs], sizes[~differs]
        depth += 1
    names = np.empty(len(lms), np.int64)
    names[ranks] = np.concatenate([[0], np.cumsum(~same)])
    return names, int(names.max()) + 1


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` in order; its last item must be its only 0."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    smaller = smaller_types(text)
    lms = _lms(smaller)
    rough = _induce(text, smaller, lms, letters)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    names, count = _names(text, smaller, lms, rough[is_lms[rough]])
    if count == len(lms):
        order = np.empty(count, np.int64)
        order[names] = np.arange(count)
    else:
        order = np.array(_suffix_array_of_names(names.tolist(), count))
    return _induce(text, smaller, lms[order], letters)


def _suffix_array_of_names(text: list[int], letters: int) -> list[int]:
    """The same, item by item, for a text over many letters."""
    n = len(text)
    if n == 1:
        return [0]
    smaller = [True] * n
    for i in range(n - 2, -1, -1):
        smaller[i] = text[i] < text[i + 1] or (text[i] == text[i + 1] and smaller[i + 1])
    lms = [i for i in range(1, n) if smaller[i] and not smaller[i - 1]]
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    first, last = (ends - sizes).tolist(), ends.tolist()

    def induce(sorted_lms: list[int]) -> list[int]:
        out, tail = [-1] * n, last[:]
        for i in reversed(sorted_lms):
            c = text[i]
            tail[c] -= 1
            out[tail[c]] = i
        head = first[:]
        for j in out:  # grows as it is read
            if j > 0 and not smaller[j - 1]:
                c = text[j - 1]
                out[head[c]] = j - 1
                head[c] += 1
        tail = last[:]
        for k in range(n - 1, -1, -1):
            j = out[k]
            if j > 0 and smaller[j - 1]:
                c = text[j - 1]
                tail[c] -= 1
                out[tail[c]] = j - 1
        return out

    rough = induce(lms)
    rough[0] = n - 1
    array, kinds = np.array(text), np.array(smaller)
    marks = np.zeros(n, bool)
    marks[lms] = True
    rough = np.array(rough)
    names, count = _names(array, kinds, np.array(lms), rough[marks[rough]])
    if count == len(lms):
        order = np.empty(count, np.int64)
        order[names] = np.arange(count)
        order = order.tolist()
    else:
        order = _suffix_array_of_names(names.tolist(), count)
    out = induce([lms[i] for i in order])
    out[0] = n - 1
    return out


def prefix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes by their first ``length`` items, equal for equal ones, by prefix doubling.

    Only starts that have so many items after them have a rank. Items may come from any alphabet.
    """
    ranks, width = np.unique(text, return_inverse=True)[1], 1
    while width < length:
        step = min(width, length - width)
        pairs = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
        ranks, width = np.unique(pairs, return_inverse=True)[1], width + step
    return ranks


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Permuted common prefixes: for each start, how far its suffix agrees with the one before it in order, and that one's start.

    A suffix ends after ``room`` items, 0 at separators. Where the items before two neighbours agree, the
    prefix is one less than that of the start before; only the others are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    before[suffixes[0]] = -1
    starts = np.arange(n)
    follows = (starts > 0) & (before > 0)
    follows[1:] &= (text[:-1] == text[before[1:] - 1]) & (room[:-1] > 0) & (room[before[1:] - 1] > 0)
    # The neighbour of the start before has to be the item before this one's neighbour only in value, not in place.
    first = np.flatnonzero(~follows & (before >= 0))
    found = np.zeros(n, np.int64)
    raw = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    words = np.ndarray((n,), "<u8", raw.data, strides=(1,))
    i, j = first, before[first]
    most, length, active = np.minimum(room[i], room[j]), np.zeros(len(first), np.int64), np.arange(len(first))
    while len(active):
        active = active[length[active] < most[active]]
        if not len(active):
            break
        at = length[active]
        diff = words[i[active] + at] ^ words[j[active] + at]
        step = np.where(diff == 0, 8, np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)) // 8)
        length[active] += step
        active = active[diff == 0]
    found[first] = np.minimum(length, most)
    # The others count down from the last compared start.
    source = np.zeros(n, np.int64)
    source[~follows] = starts[~follows]
    source = np.maximum.accumulate(source)
    return np.maximum(0, found[source] - (starts - source)), before
