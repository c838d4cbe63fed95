"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Leftmost-smaller substrings are sorted by a first induction and named by rank; where names repeat, the string of names is sorted
the same way, and so on, as long as its names are under a share of ``few_repeat`` of its letters; beyond that, repeats are told
apart by doubling. Both scans of an induction over many letters take as many buckets at once as put nothing into each other; a bucket whose
suffixes induce others in it goes wave by wave. A string of names has about as many buckets as letters, so nearly all of the
time goes into many small steps: levels make a shard take three times as long (README), so there are none by default.
"""

from __future__ import annotations

import numpy as np

from corpusloom.llm import rolling

#: Names over so large a share of leftmost-smaller substrings are told apart by doubling; 0: always.
FEW_REPEAT = 0.0
#: So few buckets are gone through one by one.
FEW_LETTERS = 256


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True for each suffix that is smaller than the next one; the last, before the end, is not."""
    n = len(t)
    less = np.zeros(n, bool)
    if n > 1:
        less[:-1] = t[:-1] < t[1:]
        # Equal neighbours have the type of the first position after them that differs from its neighbour.
        own = np.r_[t[:-1] != t[1:], True]
        at = np.where(own, np.arange(n), n)
        after = np.minimum.accumulate(at[::-1])[::-1]
        less = less[after]
    return less


def _place(sa: np.ndarray, t: np.ndarray, ptr: np.ndarray, pos: np.ndarray, step: int) -> None:
    """Put ``pos`` in its order into the buckets of its bytes, at ``ptr`` forwards (step 1) or backwards (-1)."""
    c = t[pos]
    by = np.argsort(c, kind="stable")
    c, pos = c[by], pos[by]
    first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    sizes = np.diff(np.r_[first, len(c)])
    rank = np.arange(len(c)) - np.repeat(first, sizes)
    sa[ptr[c] + step * rank] = pos
    ptr[c[first]] += step * sizes


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches, one stretch after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _two(first: np.ndarray, sizes: np.ndarray, second: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Of each bucket what is in ``first`` and then what is in ``second``, which have ``sizes`` and ``more`` of each."""
    if len(sizes) == 1 or not len(first) or not len(second):
        return np.concatenate([first, second])
    k = np.arange(len(sizes))
    by = np.argsort(np.concatenate([np.repeat(2 * k, sizes), np.repeat(2 * k + 1, more)]), kind="stable")
    return np.concatenate([first, second])[by]


def _waves(sa: np.ndarray, t: np.ndarray, ptr: np.ndarray, c: int, done: int, step: int, kind: np.ndarray) -> None:
    """All that suffixes in bucket ``c`` from ``done`` on induce, those too that they put into ``c`` itself."""
    while done != ptr[c]:
        wave = sa[done : ptr[c] : step] if ptr[c] >= 0 else sa[done::step]
        done = ptr[c]
        before = wave[wave > 0] - 1
        before = before[kind[before]]
        if len(before):
            _place(sa, t, ptr, before, step)


def induce(t: np.ndarray, less: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """Order of all suffixes, given leftmost-smaller ones in theirs."""
    n = len(t)
    sizes = np.bincount(t, minlength=letters)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    seeds_of = np.searchsorted(t[seeds], np.arange(letters + 1))  # seeds in order are in order of their letters
    n_seeds = np.diff(seeds_of)
    sa = np.full(n, -1, np.int64)
    larger, ptr = ~less, heads.copy()
    # The suffix that ends the text is larger than none of its own start: it leads its bucket.
    if not less[n - 1]:
        _place(sa, t, ptr, np.array([n - 1]), 1)
    c, width = 0, 1
    while c < letters:
        if letters > FEW_LETTERS:
            e = min(c + width, letters)
            filled = ptr[c:e] - heads[c:e]
            at = _two(sa[_ranges(heads[c:e], filled)], filled, seeds[seeds_of[c] : seeds_of[e]], n_seeds[c:e])
            before = at[at > 0] - 1
            before = before[larger[before]]
            least = int(t[before].min()) if len(before) else e
            if c < least < e:  # buckets from there on wait for what these put into them
                at = at[: np.searchsorted(t[at], least)]
                before = at[at > 0] - 1
                before = before[larger[before]]
            if least > c:
                if len(before):
                    _place(sa, t, ptr, before, 1)
                c, width = min(e, least), 2 * (min(e, least) - c)
                continue
        _waves(sa, t, ptr, c, heads[c], 1, larger)
        before = seeds[seeds_of[c] : seeds_of[c + 1]]
        before = before[before > 0] - 1
        before = before[larger[before]]
        if len(before):
            _place(sa, t, ptr, before, 1)
        c, width = c + 1, 1
    n_larger, ptr = ptr - heads, ends - 1
    c, width = letters, 1  # buckets below c are still to do
    while c > 0:
        if letters > FEW_LETTERS:
            e = max(c - width, 0)
            filled, rest = (ends[e:c] - 1 - ptr[e:c])[::-1], n_larger[e:c][::-1]
            at = _two(sa[_ranges(ptr[e:c] + 1, filled[::-1])][::-1], filled, sa[_ranges(heads[e:c], rest[::-1])][::-1], rest)
            before = at[at > 0] - 1
            before = before[less[before]]
            most = int(t[before].max()) if len(before) else e - 1
            if e <= most < c - 1:
                at = at[: np.searchsorted(-t[at], -most)]
                before = at[at > 0] - 1
                before = before[less[before]]
            if most < c - 1:
                if len(before):
                    _place(sa, t, ptr, before, -1)
                c, width = max(e, most + 1), 2 * (c - max(e, most + 1))
                continue
        c, width = c - 1, 1
        _waves(sa, t, ptr, c, ends[c] - 1, -1, less)
        before = sa[heads[c] : heads[c] + n_larger[c]][::-1]
        before = before[before > 0] - 1
        before = before[less[before]]
        if len(before):
            _place(sa, t, ptr, before, -1)
    return sa


def _doubled(rank: np.ndarray, depth: int | None) -> np.ndarray:
    """Order of the suffixes of a string of names by repeated doubling, as far as ``depth`` bytes tell: a name stands for two at least."""
    reach, names = 1, int(rank.max()) + 1
    while names < len(rank) and (depth is None or 2 * reach < depth + 2):
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-reach] = rank[reach:] + 1
        _, rank = np.unique(rank * (names + 1) + ahead, return_inverse=True)
        names, reach = int(rank.max()) + 1, reach * 2
    return np.argsort(rank, kind="stable")


def suffix_array(t: np.ndarray, depth: int | None = None, few_repeat: float | None = None) -> np.ndarray:
    """Starts of the suffixes of an array of bytes, or of other letters from 0 on, in their order.

    With ``depth`` those that agree over so many letters may stand in any order.
    """
    few_repeat = FEW_REPEAT if few_repeat is None else few_repeat
    n = len(t)
    if n < 2:
        return np.arange(n)
    s = rolling.sums(t)
    t = t.astype(np.int64)
    letters, less = int(t.max()) + 1, suffix_types(t)
    lms = np.flatnonzero(less[1:] & ~less[:-1]) + 1
    if not len(lms):
        return induce(t, less, lms, letters)
    # Order of leftmost-smaller substrings: induced from their first letters.
    order = induce(t, less, lms[np.argsort(t[lms], kind="stable")], letters)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    # Each reaches as far as the next one's first letter, the last as far as the end.
    stop = np.zeros(n, np.int64)
    stop[lms] = np.r_[lms[1:] + 1, n]
    h = rolling.stretch(s, order, stop[order])
    size = stop[order] - order
    final = order == lms[-1]
    new = np.r_[True, (h[1:] != h[:-1]) | (size[1:] != size[:-1]) | final[1:] | final[:-1]]
    names = int(new.sum())
    if names < len(lms):
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        order = lms[suffix_array(rank[lms], None, few_repeat) if names < few_repeat * len(lms) else _doubled(rank[lms], depth)]
    return induce(t, less, order, letters)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By position in the text: the common prefix with the suffix before it in ``sa``, at most ``most`` and ``room``, and that suffix.

    ``room`` is how far a prefix may go from each position. Positions that aren't in ``sa`` have -1.
    """
    plcp, before = np.full(len(t), -1, np.int64), np.full(len(t), -1, np.int64)
    if len(sa) > 1:
        a, b = sa[:-1], sa[1:]
        s = rolling.sums(t)
        bound = np.minimum(np.minimum(room[a], room[b]), most)
        got, step = np.zeros(len(a), np.int64), 1 << most.bit_length()
        while step:
            on = np.flatnonzero(got + step <= bound)
            x, y = a[on] + got[on], b[on] + got[on]
            same = rolling.stretch(s, x, x + step) == rolling.stretch(s, y, y + step)
            got[on[same]] += step
            step >>= 1
        plcp[b], before[b] = got, a
    return plcp, before
