"""Edit-based measures of many pairs of strings at once; each gives what its namesake in similarity.py gives for a pair.

The pairs of a group lie side by side in arrays, and a step of the recurrence is taken for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Cells of the arrays of a group.
CELLS = 1 << 18
#: Of common subsequences: bits of a word (the highest is left for the carry), words of a group, and entries of its table of masks at most.
BITS, WORDS, MASKS = 63, 4096, 1 << 20
LOW, TOP = np.uint64((1 << BITS) - 1), np.uint64(BITS)


def coded(texts: list[str], pad: int) -> np.ndarray:
    """Code points of the texts, one text a row, filled up with the code that is ``pad`` below the highest of its type."""
    size = np.array([len(x) for x in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full((len(texts), max(int(size.max()), 1)), 0xFFFFFFFF - pad, np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def narrow(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type that holds ``most`` and leaves the fill codes alone."""
    kind = np.uint8 if most < 0xF0 else np.uint16 if most < 0xFFF0 else np.uint32
    return a.astype(kind), b.astype(kind)


def pair_codes(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    most = max((ord(max(x)) for y in (a, b) for x in y if x), default=0)
    return narrow(coded(a, 0), coded(b, 1), most)


def groups(a: list[str], b: list[str]) -> list[np.ndarray]:
    """Places of pairs of like lengths, as many as arrays of CELLS hold."""
    longest = np.array([max(len(x), len(y), 1) for x, y in zip(a, b, strict=True)])
    total = longest + np.array([min(len(x), len(y)) / 1e6 for x, y in zip(a, b, strict=True)])
    order = np.argsort(total, kind="stable")
    out, end = [], len(order)
    while end:
        n = max(1, CELLS // int(longest[order[end - 1]]))
        out.append(order[max(0, end - n) : end])
        end = max(0, end - n)
    return out


def origins(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair a column: at k, the least i such that the k-th character of b adds to no common subsequence of a and b[j:k] with j < i.

    All substrings of b are compared with a by it: LCS(a, b[i:j]) counts the k in (i, j] whose origin is at
    most i. Characters beyond the end of b have their own place as origin.
    """
    x, y = (np.ascontiguousarray(t.T) for t in pair_codes(a, b))
    rows, cols = len(x), len(y)
    kind = np.uint8 if cols < 0xFF else np.uint16 if cols < 0xFFFF else np.uint32
    full = np.iinfo(kind).max
    y = np.ascontiguousarray(y[::-1])  # so that a diagonal of cells is a slice of both
    left = np.zeros((rows, x.shape[1]), kind)
    top = np.repeat(np.arange(cols, 0, -1).astype(kind)[:, None], x.shape[1], axis=1)
    room = [np.empty((min(rows, cols), x.shape[1]), k) for k in (bool, kind, kind, kind)]
    for d in range(rows + cols - 1):
        i, end = max(0, d - cols + 1), min(rows, d + 1)
        j = cols - 1 - d + i
        h, v = left[i:end], top[j : j + end - i]
        differ, keep, flip, high = (r[: end - i] for r in room)
        np.not_equal(x[i:end], y[j : j + end - i], out=differ)
        np.negative(differ.view(np.uint8) if kind is np.uint8 else differ.astype(kind), out=keep)
        np.bitwise_xor(keep, full, out=flip)
        # where characters differ the higher goes down and the lower on; where they agree both pass
        np.bitwise_and(v, keep, out=keep)
        np.maximum(h, keep, out=high)
        np.bitwise_or(h, flip, out=flip)
        np.minimum(v, flip, out=h)
        v[...] = high
    return top[::-1]


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences."""
    from .similarity import lcs as one

    out = np.array([len(x) if x == y else 0 for x, y in zip(a, b, strict=True)], np.int64)
    some = np.array([i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y], np.int64)
    if not len(some):
        return out
    short, long = zip(*((a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in some), strict=True)
    words, size = -(-lengths(short) // BITS), lengths(long)
    # pairs of like numbers of words, of these the longest first
    like = np.where(words > 8, np.ceil(np.log(words) / np.log(1.15)) + 8, words)
    order = np.lexsort((-size, like))
    begin = 0
    while begin < len(order):
        end = min(len(order), begin + max(1, WORDS // (int(words[order[begin]] * 1.15) + 2)))
        g = order[begin : begin + int((like[order[begin:end]] == like[order[begin]]).sum())]
        begin += len(g)
        most = int(words[g].max()) + 1
        # microseconds one by one and side by side: those far longer than the others make steps for few
        alone = np.cumsum(size[g] * (0.17 + 0.0055 * words[g]))
        rest = np.cumsum((size[g] * 0.007 * most)[::-1])[::-1]
        cost = np.append(np.concatenate([[0], alone[:-1]]) + 5.0 * (size[g] + most) + rest, alone[-1])
        k = int(cost.argmin())
        out[some[g[:k]]] = [one(short[i], long[i]) for i in g[:k]]
        if k < len(g):
            out[some[g[k:]]] = bit_lcs([short[i] for i in g[k:]], [long[i] for i in g[k:]])
    return out


def bit_lcs(short: list[str], long: list[str]) -> np.ndarray:
    """similarity.lcs() of pairs side by side, the longest of ``long`` first, the number of a pair cut into words.

    In a step a pair's w-th word takes the character w places before that of its first, so that carries have one
    step to reach the next word. A word of zeros behind each pair's takes its last carry.
    """
    x, y, n = coded(short, 0), coded(long, 0), lengths(long)
    letters = np.unique(np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32))
    words = -(-x.shape[1] // BITS)
    pairs, cells = len(short), len(short) * (words + 1)
    if len(letters) * cells > MASKS and pairs > 1:
        half = pairs // 2
        return np.concatenate([bit_lcs(short[:half], long[:half]), bit_lcs(short[half:], long[half:])])
    cell = np.arange(cells).reshape(pairs, words + 1)
    # for each letter, and last for all others, where in the pairs' words it stands
    masks = np.zeros((len(letters) + 1) * cells, np.uint64)
    for bit in range(min(BITS, x.shape[1])):
        part = x[:, bit::BITS]
        at = np.searchsorted(letters, part) * cells + cell[:, : part.shape[1]]
        masks[at[part != 0xFFFFFFFF]] |= np.uint64(1 << bit)
    code = np.searchsorted(letters, y)
    code[letters[np.minimum(code, len(letters) - 1)] != y] = len(letters)
    last = y.shape[1] - 1 + words
    codes = np.full((pairs, last + words + 1), len(letters) * cells)
    codes[:, words : last + 1] = code[:, ::-1] * cells
    row = np.full((pairs, words + 1), LOW)
    row[:, words] = 0
    kept = row.reshape(-1).copy()
    carry, room = np.zeros(cells + 1, np.uint64), [np.empty(cells, k) for k in (np.int64, np.uint64, np.uint64)]
    live = 0
    for t in range(y.shape[1] + words - 1):
        if t % 64 == 0 and live != (now := int((n + words > t).sum())):
            live, m = now, now * (words + 1)
            at, match, total = (r[:m] for r in room)
            mine, low, at_2d, cell_2d, into, out = row.reshape(-1)[:m], kept[:m], at.reshape(live, -1), cell[:live], carry[:m], carry[1 : m + 1]
        np.add(codes[:live, last - t : last - t + words + 1], cell_2d, out=at_2d)
        masks.take(at, out=match, mode="clip")
        np.bitwise_and(mine, match, out=match)
        np.add(mine, match, out=total)
        np.add(total, into, out=total)
        np.bitwise_xor(mine, match, out=mine)
        np.right_shift(total, TOP, out=out)
        np.bitwise_or(mine, total, out=mine)
        np.bitwise_and(mine, low, out=mine)
    return BITS * words - np.bitwise_count(row[:, :words]).sum(axis=1, dtype=np.int64)


def ratios(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """200 LCS / total length; 100 if both are empty."""
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


def lengths(texts: Sequence[str]) -> np.ndarray:
    return np.array([len(x) for x in texts], np.int64)


def ratio(a: list[str], b: list[str]) -> np.ndarray:
    return ratios(lcs(a, b), lengths(a) + lengths(b))


def token_sort(a: list[str], b: list[str]) -> np.ndarray:
    joined = lambda texts: [" ".join(sorted(x.split())) for x in texts]
    return ratio(joined(a), joined(b))


def token_set(a: list[str], b: list[str]) -> np.ndarray:
    out = np.zeros(len(a))
    at, left, right, both = [], [], [], []
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        x, y = set(s.split()), set(t.split())
        if not x or not y:
            continue
        common, dx, dy = x & y, x - y, y - x
        if common and (not dx or not dy):
            out[i] = 100.0
            continue
        at.append(i)
        left.append(" ".join(sorted(dx)))
        right.append(" ".join(sorted(dy)))
        both.append(sum(map(len, common)) + len(common) - 1 if common else -1)
    if at:
        # the shared words and a blank begin both strings
        n = np.array(both) + 1
        one, two, own = n + lengths(left), n + lengths(right), np.maximum(n - 1, 0)
        best = ratios(n + lcs(left, right), one + two)
        with_both = np.maximum(ratios(own, own + one), ratios(own, own + two))
        out[at] = np.where(n > 0, np.maximum(best, with_both), best)
    return out


def windows(short: list[str], long: list[str]) -> np.ndarray:
    """Best ratio of each short string, none of them empty, with a window of its length of the long one, cut off at its ends.

    The k-th character, of origin o, counts in the windows that end at k to k + m - 1, from o + m on unless o is 0.
    """
    out = np.zeros(len(short))
    for g in groups(short, long):
        a, b = [short[i] for i in g], [long[i] for i in g]
        m, n = lengths(a)[:, None], lengths(b)[:, None]
        o = origins(a, b).T.astype(np.int64)
        k = np.arange(1, o.shape[1] + 1)
        width = int((m + n).max()) + 1
        pair, at = np.nonzero((k <= n) & (o < k))
        o, k, size = o[pair, at], k[at], m[pair, 0]
        begin = np.where(o == 0, k, np.maximum(k, o + size))
        pair, begin, end = pair[begin < k + size], begin[begin < k + size], (k + size)[begin < k + size]
        cells = len(g) * width
        count = np.cumsum((np.bincount(pair * width + begin, minlength=cells) - np.bincount(pair * width + end, minlength=cells)).reshape(len(g), width), axis=1)
        ends = np.arange(width)
        size = np.minimum(ends, n) - np.maximum(ends - m, 0)
        out[g] = np.where((ends >= 1) & (ends < m + n), 200.0 * count / (m + np.maximum(size, 0)), 0.0).max(axis=1)
    return out


def partial(a: list[str], b: list[str]) -> np.ndarray:
    out = np.array([100.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)])
    some = np.array([i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y], np.int64)
    if not len(some):
        return out
    short, long = zip(*((a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in some), strict=True)
    out[some] = windows(list(short), list(long))
    like = np.array([i for i in some if len(a[i]) == len(b[i])], np.int64)
    if len(like):
        out[like] = np.maximum(out[like], windows([b[i] for i in like], [a[i] for i in like]))
    return out


def partial_token_set(a: list[str], b: list[str]) -> np.ndarray:
    out = np.zeros(len(a))
    at, left, right = [], [], []
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        x, y = set(s.split()), set(t.split())
        if x and y and not x.isdisjoint(y):
            out[i] = 100.0
        elif x and y:
            at.append(i)
            left.append(" ".join(sorted(x)))
            right.append(" ".join(sorted(y)))
    if at:
        out[at] = partial(left, right)
    return out


def jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    """Strings of up to 64 characters as bits of whole numbers; longer ones pair by pair."""
    from .similarity import jaro_winkler as one

    out = np.zeros(len(a))
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if not x or not y or len(x) > 64 or len(y) > 64:
            out[i] = one(x, y)
    some = np.array([i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and len(x) <= 64 and len(y) <= 64], np.int64)
    for begin in range(0, len(some), 4096):
        part = some[begin : begin + 4096]
        out[part] = short_jaro_winkler([a[i] for i in part], [b[i] for i in part])
    return out


def short_jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    x, y = pair_codes(a, b)
    la, lb, low = lengths(a), lengths(b), np.array([(1 << k) - 1 for k in range(65)], np.uint64)
    y = np.pad(y, ((0, 0), (0, 64 - y.shape[1])), constant_values=np.iinfo(y.dtype).max - 1)
    reach = np.maximum(0, np.maximum(la, lb) // 2 - 1)
    used, hits = np.zeros(len(a), np.uint64), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        free = np.packbits(y == x[:, i : i + 1], axis=1, bitorder="little").view("<u8")[:, 0] & ~used
        free &= low[np.minimum(lb, i + reach + 1)] & ~low[np.minimum(np.maximum(0, i - reach), 64)]
        used |= free & (~free + np.uint64(1))
        hits[:, i] = free != 0
    taken = np.unpackbits(used.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    m = hits.sum(axis=1)
    swaps = np.bincount(np.nonzero(hits)[0], x[hits] != y[taken], len(a)).astype(np.int64) // 2
    jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / np.maximum(m, 1)) / 3, 0.0)
    prefix = np.cumprod(x[:, :4] == y[:, : x[:, :4].shape[1]], axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
