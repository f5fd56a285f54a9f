"""Measures of many pairs at once."""

import random

import pandas as pd
import pytest

from linkspark.functions import similarity as S
from linkspark.functions import strings

MEASURES = ["ratio", "token_sort", "token_set", "partial", "partial_token_set", "jaro_winkler"]


def pairs(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 7))) for _ in range(40)] + ["शक्ति", "😀x", "a"]
    some = lambda: " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 6, 14])))
    left = [some() for _ in range(300)]
    right = [x[: len(x) // 2] + rng.choice("ab ") + x[len(x) // 2 + 1 :] if rng.random() < 0.4 else some() for x in left]
    return left + ["", "", "ab" * 150, "x" * 1600, "y" * 65, "same", "aab"], right + ["", "a", "ba" * 120, "z" + "x" * 900, "y" * 64 + "z", "same", "abb"]


@pytest.mark.parametrize("name", MEASURES)
def test_many_pairs_as_one_by_one(name, monkeypatch):
    left, right = pairs(7)
    for cells in (1 << 18, 500):
        monkeypatch.setattr(strings, "CELLS", cells)
        assert getattr(strings, name)(left, right).tolist() == [getattr(S, name)(a, b) for a, b in zip(left, right, strict=True)]
    assert getattr(strings, name)([], []).tolist() == []


def test_windows_are_not_compared_one_by_one(spark, monkeypatch):
    """A hundred pairs of 90 characters have 18,000 windows."""
    rng = random.Random(2)
    left, right = ([" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(11)) for _ in range(100)] for _ in "ab")
    want = [S.partial_token_set(a, b) for a, b in zip(left[:3], right, strict=False)]
    monkeypatch.setattr(S, "ratio", None)
    monkeypatch.setattr(S, "lcs", None)
    assert S.partial_token_set_ratio.func(pd.Series(left), pd.Series(right)).tolist()[:3] == [int(x + 0.5) for x in want]


def test_missing_sides_have_no_measure(spark):
    rows = spark.createDataFrame([("ab", "abc"), (None, "x"), ("y", None), (None, None)], "a string, b string")
    got = rows.select(S.indel_ratio("a", "b").alias("r"), S.jaro_winkler_similarity("a", "b").alias("j"), S.partial_ratio("a", "b").alias("p")).collect()
    assert [r.r for r in got] == [80, None, None, None] and [r.j is None for r in got] == [False, True, True, True] and [r.p for r in got] == [100, None, None, None]
