"""String similarity scores, 0 to 100, of lower-case strings.

Our own scorers: ``ratio`` is 100 times twice the length of the longest common subsequence over the sum of the lengths.
``token_set_ratio`` sets the sorted common tokens before each side's own ones and takes the best of three ratios, 100 if a
side has no token of its own; ``wratio`` takes the best of the plain, token-sorted (0.95) and token-set ratio (0.95). Tokens
are split at white space. Only the subsequence is computed in numpy, a batch of pairs at a time; all else are expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells of the tables of one batch of pairs.
CELLS = 1 << 21


def _codes(strings: list[str], width: int, fill: int) -> np.ndarray:
    """Code points as rows, filled up to ``width``."""
    out = np.full((len(strings), max(width, 1)), fill, np.uint32)
    joined = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(s) for s in strings], np.int64)
    row = np.repeat(np.arange(len(strings)), lengths)
    out[row, np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = joined
    return out


def common_subsequence(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair.

    Pairs of like length are taken together. Character by character of the first strings, the lengths for all prefixes of
    the second ones are the running maxima of the last lengths and, where the character matches, of one more."""
    la, lb = (np.array([len(s) for s in x], np.int64) for x in (a, b))
    out, order, at = np.zeros(len(a), np.int64), np.lexsort((lb, la)), 0
    while at < len(order):
        some = order[at : at + 4096]
        while len(some) > 1 and len(some) * (int(lb[some].max()) + int(la[some].max()) + 1) > CELLS:
            some = some[: len(some) // 2]
        at += len(some)
        wide = int(lb[some].max())
        x, y = _codes([a[i] for i in some], int(la[some].max()), 0x110000), _codes([b[i] for i in some], wide, 0x110001)
        row = np.zeros((len(some), y.shape[1] + 1), np.int32)
        for k in range(x.shape[1]):
            match = x[:, k, None] == y
            row[:, 1:] = np.maximum(row[:, 1:], np.where(match, row[:, :-1] + 1, 0))
            np.maximum.accumulate(row, axis=1, out=row)
        out[some] = row[:, -1]
    return out


@F.pandas_udf(T.LongType())
def _subsequence(a: pd.Series, b: pd.Series) -> pd.Series:
    there = (a.notna() & b.notna()).to_numpy()
    out = np.zeros(len(a), np.int64)
    out[there] = common_subsequence(a[there].tolist(), b[there].tolist())
    return pd.Series(out)


def _ratio(a: Column, b: Column) -> Column:
    """Of strings in lower case. A prefix of the other string, and an empty one, need no table."""
    short, both = F.least(F.length(a), F.length(b)), F.length(a) + F.length(b)
    easy = F.startswith(a, b) | F.startswith(b, a)
    return F.when(both == 0, 100.0).when(easy, 200.0 * short / both).otherwise(200.0 * _subsequence(a, b) / both)


def _tokens(a: Column) -> Column:
    return F.filter(F.split(a, r"\s+"), lambda x: x != "")


def sorted_tokens(a: Column) -> Column:
    """The tokens in order, joined by a blank."""
    return F.array_join(F.array_sort(_tokens(a)), " ")


def token_set(a: Column) -> Column:
    """The distinct tokens in order."""
    return F.array_sort(F.array_distinct(_tokens(a)))


def _set_ratio(a: Column, b: Column) -> Column:
    x, y = token_set(a), token_set(b)
    both = F.array_join(F.array_intersect(x, y), " ")
    own = [F.array_join(F.array_except(p, q), " ") for p, q in ((x, y), (y, x))]
    left, right = (F.concat(both, F.when((both != "") & (o != ""), " ").otherwise(""), o) for o in own)
    share = lambda side: F.when(both == "", 0.0).otherwise(200.0 * F.length(both) / (F.length(both) + F.length(side)))
    return F.when((both != "") & ((own[0] == "") | (own[1] == "")), 100.0).otherwise(F.greatest(_ratio(left, right), share(left), share(right)))


def ratio(a: Column, b: Column) -> Column:
    return _ratio(F.lower(a), F.lower(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    return _set_ratio(F.lower(a), F.lower(b))


def wratio(a: Column, b: Column) -> Column:
    a, b = F.lower(a), F.lower(b)
    return F.greatest(_ratio(a, b), 0.95 * _ratio(sorted_tokens(a), sorted_tokens(b)), 0.95 * _set_ratio(a, b))
