"""Similarities of strings. Set measures and flags are column expressions; edit-based ones are vectorised UDFs.

Ratios are 0 to 100, whole numbers. Edge rules: two empty strings have ratio 100,
Jaro-Winkler 1, token sort 100, and token set, partial token set and partial ratio 0
if either is empty (partial ratio of two empty strings: 100). The functions of two strings
define the measures; columns are measured by those of strings.py, many pairs at once.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from . import strings as many


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit a character of a."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, some = full, [m for m in map(masks.get, b) if m]
    for at in range(0, len(some), 64):
        for mask in some[at : at + 64]:
            match = row & mask
            row = row + match | row ^ match
        # carries beyond the end of a
        row &= full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """200 LCS / (|a| + |b|)."""
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio among the shared words and the shared words with each side's rest; 100 if one side has no rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, dx, dy = x & y, x - y, y - x
    if common and (not dx or not dy):
        return 100.0
    left, right, both = " ".join(sorted(dx)), " ".join(sorted(dy)), " ".join(sorted(common))
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = ratio(one, two)
    if common:
        best = max(best, ratio(both, one), ratio(both, two))
    return best


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer one, cut off at its ends; of strings of one length, either way round."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100.0
    best = windows(short, long)
    return max(best, windows(long, short)) if len(a) == len(b) else best


def windows(short: str, long: str) -> float:
    n, chars, best = len(short), set(short), 0.0
    for end in range(1, len(long) + n):
        window = long[max(0, end - n) : end]
        # the best window begins and ends with a character of the shorter string
        if window[-1] in chars or (end > len(long) and window[0] in chars):
            best = max(best, ratio(short, window))
    return best


def partial_token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    return 100.0 if x & y else partial(" ".join(sorted(x - y)), " ".join(sorted(y - x)))


def jaro_winkler(a: str, b: str) -> float:
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, matched = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                matched.append(c)
                break
    m = len(matched)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(matched, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def _measured(measure, a: pd.Series, b: pd.Series) -> np.ndarray:
    """A measure of strings.py on the pairs without a missing side; NaN for the others."""
    x, y = a.to_numpy(object), b.to_numpy(object)
    some = np.flatnonzero(~(pd.isna(x) | pd.isna(y)))
    out = np.full(len(x), np.nan)
    if len(some):
        out[some] = measure(x[some].tolist(), y[some].tolist())
    return out


def _whole(measure):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.floor(_measured(measure, a, b) + 0.5)).astype("Int32")

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, IntegerType())


def _real(measure):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        found = _measured(measure, a, b)
        return pd.Series([None if x != x else x for x in found.tolist()], dtype=object) if np.isnan(found).any() else pd.Series(found)

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, DoubleType())


indel_ratio = _whole(many.ratio)
token_set_ratio = _whole(many.token_set)
token_sort_ratio = _whole(many.token_sort)
partial_ratio = _whole(many.partial)
partial_token_set_ratio = _whole(many.partial_token_set)
jaro_winkler_similarity = _real(many.jaro_winkler)
seq_ratio = _real(lambda a, b: [SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def words(text: Column, separator: str = " +") -> Column:
    return F.filter(F.split(text, separator), lambda x: x != "")


def set_jaccard(a: Column, b: Column, separator: str = " +") -> Column:
    """Jaccard of the sets of parts; 0 unless both are non-empty."""
    x, y = F.array_distinct(words(a, separator)), F.array_distinct(words(b, separator))
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0)))


def agree(a: Column, b: Column) -> Column:
    """1 equal, -1 different, 0 if either is missing."""
    return F.when((a == "") | (b == ""), 0).when(a == b, 1).otherwise(-1)


def is_subsequence(short: Column, long: Column) -> Column:
    """Whether the characters of one string stand in the other in their order."""
    begin = F.struct(F.lit(1).alias("at"), F.lit(True).alias("ok"))

    def step(state, c):
        hit = F.call_function("locate", c, long, state["at"])
        return F.struct((hit + 1).alias("at"), (state["ok"] & (hit > 0)).alias("ok"))

    chars = F.transform(F.sequence(F.lit(1), F.length(short)), lambda i: F.substring(short, i, F.lit(1)))
    return F.when(F.length(short) == 0, True).otherwise(F.aggregate(chars, begin, step, lambda s: s["ok"]))


def plausible(noisy: Column, canon: Column) -> Column:
    """Whether an alignment can be a spelling of the other: containment, a ratio of 70, or an abbreviation; words outside ASCII and # always."""
    ascii_ = noisy.rlike("^[\\x00-\\x7f]*$") & canon.rlike("^[\\x00-\\x7f]*$")
    a, b = F.replace(noisy, F.lit(" "), F.lit("")), F.replace(canon, F.lit(" "), F.lit(""))
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    spelt = F.contains(long, short) | (indel_ratio(canon, noisy) >= 70) | ((F.substring(short, 1, 1) == F.substring(long, 1, 1)) & is_subsequence(short, long))
    return F.when(~ascii_ | (noisy == "#"), True).when(short == "", False).otherwise(spelt)
