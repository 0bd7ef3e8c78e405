"""Suffix array of one shard by induced sorting, and its permuted common prefixes.

Level 0 works on whole buckets of bytes with numpy: what a bucket induces is
grouped stably by preceding symbol. The reduced strings of deeper levels, at most
half as long each, have large alphabets and few symbols per bucket; there places
are induced one by one. Every level takes time in proportion to its string.
"""

from __future__ import annotations

import numpy as np


def _classes(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the unique smallest."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    if len(change):
        runs = np.searchsorted(change, np.arange(n - 1))  # next place where the symbol changes
        smaller[:-1] = (text[:-1] < text[1:])[change[runs]]
    return smaller


def _leftmost(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _induced(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, given leftmost-smaller ones in order within their buckets."""
    heads = text[leftmost]
    by_head = np.argsort(heads, kind="stable")
    cuts = np.searchsorted(heads[by_head], np.arange(sigma + 1))
    ordered = leftmost[by_head]

    def spread(found: np.ndarray, waiting: list[list[np.ndarray]]) -> None:
        symbols = text[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        edges = np.flatnonzero(np.diff(symbols)) + 1
        for part in np.split(found, edges) if len(found) else []:
            waiting[text[part[0]]].append(part)

    larger: list[np.ndarray] = [None] * sigma
    waiting: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for symbol in range(sigma):
        front, own = (np.concatenate(waiting[symbol]) if waiting[symbol] else np.zeros(0, np.int64)), []
        waiting[symbol] = []
        while len(front):
            own.append(front)
            before = front[front > 0] - 1
            before = before[~smaller[before]]
            front = before[text[before] == symbol]
        larger[symbol] = np.concatenate(own) if own else np.zeros(0, np.int64)
        source = np.concatenate((larger[symbol], ordered[cuts[symbol] : cuts[symbol + 1]]))
        before = source[source > 0] - 1
        before = before[~smaller[before]]
        spread(before[text[before] != symbol], waiting)

    lesser: list[np.ndarray] = [None] * sigma
    waiting = [[] for _ in range(sigma)]
    for symbol in range(sigma - 1, -1, -1):  # from the largest suffix down; parts are kept reversed
        front, own = (np.concatenate(waiting[symbol]) if waiting[symbol] else np.zeros(0, np.int64)), []
        waiting[symbol] = []
        while len(front):
            own.append(front)
            before = front[front > 0] - 1
            before = before[smaller[before]]
            front = before[text[before] == symbol]
        lesser[symbol] = np.concatenate(own) if own else np.zeros(0, np.int64)
        source = np.concatenate((lesser[symbol], larger[symbol][::-1]))
        before = source[source > 0] - 1
        before = before[smaller[before]]
        spread(before[text[before] != symbol], waiting)
    lesser[0] = np.array([len(text) - 1])
    return np.concatenate([part for symbol in range(sigma) for part in (larger[symbol], lesser[symbol][::-1])])


def _names(text: np.ndarray, places: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings at these places, which are in their order."""
    following = np.searchsorted(leftmost, places, side="right")
    ends = np.append(leftmost, len(text) - 1)[following]
    lengths = ends - places + 1
    differs = np.ones(len(places), bool)
    same = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    step = 0
    while len(same):
        done = step >= lengths[same]
        differs[same[done]] = False
        same = same[~done]
        equal = text[places[same] + step] == text[places[same - 1] + step]
        same = same[equal]
        step += 1
    return np.cumsum(differs) - 1


def _induced_singly(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """As :func:`_induced`, place by place: linear in the text, whatever the alphabet."""
    symbols, kinds, count = text.tolist(), smaller.tolist(), len(text)
    sizes = np.bincount(text, minlength=sigma)
    ends = np.cumsum(sizes)
    heads, tails = (ends - sizes).tolist(), ends.tolist()
    order = [-1] * count
    for place in reversed(leftmost.tolist()):
        symbol = symbols[place]
        tails[symbol] -= 1
        order[tails[symbol]] = place
    for place in order:  # larger suffixes land behind the place that induces them
        if place > 0 and not kinds[place - 1]:
            symbol = symbols[place - 1]
            order[heads[symbol]] = place - 1
            heads[symbol] += 1
    tails = ends.tolist()
    for at in range(count - 1, -1, -1):
        place = order[at] - 1
        if place >= 0 and kinds[place]:
            symbol = symbols[place]
            tails[symbol] -= 1
            order[tails[symbol]] = place
    return np.array(order, np.int64)


def suffix_array(text: np.ndarray, sigma: int, induced=_induced) -> np.ndarray:
    """Starts of all suffixes in order; ``text`` has symbols below ``sigma`` and ends with its only 0."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    smaller = _classes(text)
    leftmost = _leftmost(smaller)
    if len(leftmost) > 1:
        ranked = induced(text, smaller, leftmost, sigma)
        marked = np.zeros(len(text), bool)
        marked[leftmost] = True
        ranked = ranked[marked[ranked]]
        names = np.empty(len(text), np.int64)
        names[ranked] = numbers = _names(text, ranked, leftmost)
        if numbers[-1] + 1 < len(leftmost):
            leftmost = leftmost[suffix_array(names[leftmost], int(numbers[-1]) + 1, _induced_singly)]
        else:
            leftmost = ranked
    return induced(text, smaller, leftmost, sigma)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By place: symbols shared with the suffix before it in order, up to ``most``.

    Where both suffixes follow the same symbol, one symbol less is shared than at
    the place before, so only the other places are compared, and their prefixes
    add up to at most n log n symbols. Seven symbols are compared at a time,
    below 512 each, then one by one.
    """
    places = np.arange(len(text))
    before = np.empty(len(text), np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    compared = (places == 0) | (before <= 0)
    compared[1:] |= text[:-1] != text[before[1:] - 1]
    shared = np.zeros(len(text), np.int64)
    active = np.flatnonzero(compared & (before >= 0))
    wide = np.concatenate((text.astype(np.int64), np.full(13, 511)))
    words = wide[:-6].copy()
    for step in range(1, 7):
        words = (words << 9) | wide[step : len(words) + step]
    length = 0
    while len(active):  # the last symbol is unique, so no comparison passes the end
        equal = words[active + length] == words[before[active] + length]
        rest = active[~equal]
        for step in range(6):
            rest = rest[wide[rest + length + step] == wide[before[rest] + length + step]]
            shared[rest] = length + step + 1
        active = active[equal]
        length += 7
        shared[active] = length
    source = np.maximum.accumulate(np.where(compared, places, 0))
    return np.minimum(shared[source] - (places - source), most)
