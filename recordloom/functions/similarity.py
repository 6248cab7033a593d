"""String similarities in Arrow batches; equal pairs of a batch are scored once. All lie in [0, 1].

ratio: 2 * longest common subsequence / summed lengths. token_sort: ratio of the sorted tokens. token_set: 1 if tokens are
shared and one side has no others, else the best ratio of shared, shared + rest of a, shared + rest of b. partial: the best
ratio of the shorter in a window of the longer. jaro_winkler: Jaro with prefix weight 0.1. Two empty strings: 1, but
token_set 0, as no token is shared; one empty string: 0. Strings may be long: no measure looks at every window or at every
pair of places one by one.
"""

from __future__ import annotations

import os
from collections import defaultdict, deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lcs(a: str, b: str) -> int:
    """What both begin and end with, and Hyyrö's bit-parallel algorithm between: bits for the longer, steps for the shorter."""
    if len(a) < len(b):
        a, b = b, a
    start = len(os.path.commonprefix((a, b)))
    a, b = a[start:], b[start:]
    end = 0
    while end < len(b) and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not b:
        return start + end
    masks: dict[str, int] = defaultdict(int)
    wanted = set(b)
    for i, c in enumerate(a):
        if c in wanted:
            masks[c] |= 1 << i
    s = all_ones = (1 << len(a)) - 1
    for c in b:
        if u := s & masks.get(c, 0):
            s = ((s + u) | (s - u)) & all_ones
    return start + end + len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    if a == b:
        return 1.0
    return 2 * _lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if not both:
        return ratio(left, right)
    if not left or not right:
        return 1.0
    begins = lambda whole: 2 * len(both) / (len(both) + len(whole))  # noqa: E731  what is shared begins the whole
    one, other = f"{both} {left}", f"{both} {right}"
    return max(ratio(one, other), begins(one), begins(other))


def partial(a: str, b: str) -> float:
    """By semi-local comparison (Tiskin): one pass over the diagonals, each at once, combs strands from the left and upper edge
    of the grid of both strings; a strand that runs from the upper edge at s to the lower edge at e takes one from the common
    subsequence of every window of b that holds s and e. A strand so counts in a run of windows, and all windows, those that
    stick out at the ends included, are answered by one running sum."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return float(not b)
    if a in b:
        return 1.0
    m, n = len(a), len(b)
    codes = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (a[::-1], b)]
    across, down = np.arange(m), np.arange(m, m + n)
    for d in range(m + n - 1):
        lo, hi = max(0, d - m + 1), min(n, d + 1)
        h, v = across[m - 1 - d + lo : m - 1 - d + hi], down[lo:hi]
        crossed = (h ^ v) * ((codes[0][m - 1 - d + lo : m - 1 - d + hi] == codes[1][lo:hi]) | (h > v))
        h ^= crossed
        v ^= crossed
    ends = np.flatnonzero(down >= m)
    starts = down[ends] - m
    # the window that ends before j (virtually, up to n + m - 1) holds both if e < j <= s + m
    lost = np.bincount(ends + 1, minlength=n + m + 1) - np.bincount(np.maximum(starts + m, ends) + 1, minlength=n + m + 1)
    j = np.arange(1, n + m)
    size = np.minimum(j, n) - np.maximum(j - m, 0)
    return float((2 * (size - np.cumsum(lost)[1 : n + m]) / (size + m)).max())


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    places: dict[str, deque[int]] = defaultdict(deque)
    for i, c in enumerate(a):
        places[c].append(i)
    matched, used = [], []
    for j, c in enumerate(b):  # a place that is left behind by one character's window is behind all later ones
        own = places.get(c)
        while own and own[0] < j - reach:
            own.popleft()
        if own and own[0] <= j + reach:
            used.append(own.popleft())
            matched.append(c)
    m = len(matched)
    if not m:
        return 0.0
    t = sum(x != a[i] for x, i in zip(matched, sorted(used))) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = len(os.path.commonprefix((a[:4], b[:4])))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


SCORERS = {"ratio": ratio, "tset": token_set, "tsort": token_sort, "partial": partial, "jw": jaro_winkler}


def scorers(names: Sequence[str], a: str | Column, b: str | Column) -> Column:
    """A struct with a field for each of the similarities, from one pass over the pairs; null counts as an empty string."""
    scores = {name: SCORERS[name] for name in names}

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        pairs = list(zip(a.fillna(""), b.fillna("")))
        known = {p: [score(*p) for score in scores.values()] for p in set(pairs)}
        return pd.DataFrame([known[p] for p in pairs], columns=list(scores), dtype="float64")

    return F.pandas_udf(run, ", ".join(f"{name} double" for name in names))(a, b)


def scorer(name: str):
    """One similarity as a function of two columns."""
    return lambda a, b: scorers([name], a, b)[name]
