"""String similarity (F8, F10): Jaro-Winkler and best partial match, from their published definitions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    in_a = []
    for i, letter in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == letter), None)
        if j is not None:
            free[j] = False
            in_a.append(letter)
    if not in_a:
        return 0.0
    in_b = [letter for letter, unused in zip(b, free, strict=True) if not unused]
    swaps = sum(x != y for x, y in zip(in_a, in_b, strict=True)) // 2
    m = len(in_a)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by a tenth per letter of a common beginning of up to four, where it is over 0.7."""
    base = jaro(a, b)
    if base <= 0.7:
        return base
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return base + 0.1 * same * (1 - base)


def _common(masks: dict[str, int], size: int, text: str) -> int:
    """Length of the longest common subsequence, one machine-word style step per letter of ``text``."""
    row = full = (1 << size) - 1
    for letter in text:
        hit = row & masks.get(letter, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _best_window(short: str, long: str) -> float:
    size = len(short)
    masks: dict[str, int] = {}
    for i, letter in enumerate(short):
        masks[letter] = masks.get(letter, 0) | 1 << i
    best = 0.0
    for end in range(1, len(long) + size):
        window = long[max(0, end - size) : end]
        if 2 * len(window) / (size + len(window)) > best:
            best = max(best, 2 * _common(masks, size, window) / (size + len(window)))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best indel ratio of the shorter text with a window of the longer one, between 0 and 1."""
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 1.0
    best = _best_window(short, long)
    return max(best, _best_window(long, short)) if len(a) == len(b) else best


def by_distinct_pair(function, a: pd.Series, b: pd.Series, missing: float, blank: bool) -> pd.Series:
    """``function`` once for each distinct pair of a batch; pairs with a missing text (or a blank one) are ``missing``."""
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a, b, strict=True):
        if pair not in known:
            bad = any(x is None or (blank and not x.strip()) for x in pair)
            known[pair] = missing if bad else function(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype=float)


@F.pandas_udf(T.DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return by_distinct_pair(jaro_winkler, a, b, 0.0, blank=False)


@F.pandas_udf(T.DoubleType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return by_distinct_pair(partial_ratio, a, b, 0.0, blank=True)
