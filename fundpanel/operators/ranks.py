"""Rank agreement between series without joining their rows.

A series becomes one row: its sorted row keys and values.  Pairs of series then meet as pairs of vectors; a series is dealt
to as many tasks as there are blocks of series, not once for each other series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Series of a block; a task compares two blocks.
BLOCK = 64


def vectors(rows: DataFrame, code: str, by: Sequence[str], value: str = "value", mark: Column | None = None) -> DataFrame:
    """(code, k, v, m): the keys of a series' rows in order, their values, and a mark of each (false without one); nulls and NaN left out.

    A key is a 64-bit hash of the columns by; of rows that share one the greatest value counts.
    """
    known = rows.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(F.col(code).alias("code"), F.xxhash64(*by).alias("k")).agg(F.max(value).cast("double").alias("v"), F.bool_or(F.lit(False) if mark is None else F.coalesce(mark, F.lit(False))).alias("m"))
    items = F.array_sort(F.collect_list(F.struct("k", "v", "m")))
    return known.groupBy("code").agg(items.alias("x")).select("code", *(F.col(f"x.{c}").alias(c) for c in ("k", "v", "m")))


def mean_ranks(values: np.ndarray) -> np.ndarray:
    """Ranks from 1, the mean among ties."""
    _, back, times = np.unique(values, return_inverse=True, return_counts=True)
    return (np.cumsum(times) - (times - 1) / 2)[back]


def correlation(a: np.ndarray, b: np.ndarray) -> float | None:
    """Of two vectors of ranks; None if one is constant or there are fewer than two."""
    a, b = a - a.mean() if len(a) else a, b - b.mean() if len(b) else b
    size = float(np.sqrt((a * a).sum() * (b * b).sum()))
    return float((a * b).sum() / size) if size else None


class _Series:
    """A series with the ranks of all its values, which every partner on the same rows can use."""

    def __init__(self, k: np.ndarray, v: np.ndarray, m: np.ndarray | None = None):
        self.k, self.v, self.m, self.ranks = np.asarray(k), np.asarray(v), m, mean_ranks(np.asarray(v))

    def agree(self, other: _Series) -> tuple[int, float | None]:
        """Over the rows that both have: their number, and the correlation of the ranks among them."""
        if np.array_equal(self.k, other.k):
            return len(self.k), correlation(self.ranks, other.ranks)
        _, i, j = np.intersect1d(self.k, other.k, assume_unique=True, return_indices=True)
        return len(i), correlation(mean_ranks(self.v[i]), mean_ranks(other.v[j]))

    def marked(self) -> _Series:
        m = np.asarray(self.m, bool)
        return _Series(self.k[m], self.v[m])


def all_pairs(found: DataFrame) -> DataFrame:
    """(a, b, n, rho) for all pairs of codes of vectors() that share a row, a before b.

    Codes fall into blocks; a task has two blocks, or one with itself, and multiplies the standardised ranks of series that
    stand on the same rows all at once.
    """
    blocks = -(-found.count() // BLOCK) or 1
    own = F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    dealt = found.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select("code", "k", "v", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        out, i, j = [], int(part["i"].iloc[0]), int(part["j"].iloc[0])
        series = [(c, o, _Series(k, v)) for c, o, k, v in zip(part["code"], part["own"], part["k"], part["v"], strict=True)]
        same: dict[bytes, list[int]] = {}
        for at, (_, _, s) in enumerate(series):
            same.setdefault(s.k.tobytes(), []).append(at)
        products = {}
        for members in same.values():
            ranks = np.stack([series[at][2].ranks for at in members])
            ranks = ranks - ranks.mean(axis=1, keepdims=True)
            size = np.sqrt((ranks * ranks).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                rho = (ranks @ ranks.T) / np.outer(size, size)
            products.update({(a, b): (ranks.shape[1], float(rho[x, y]) if size[x] and size[y] else None) for x, a in enumerate(members) for y, b in enumerate(members)})
        for x, (a, of_a, s) in enumerate(series):
            for y, (b, of_b, t) in enumerate(series):
                if a < b and (i == j or of_a != of_b):
                    n, rho = products[x, y] if (x, y) in products else s.agree(t)
                    if n:
                        out.append((a, b, n, rho))
        return pd.DataFrame(out, columns=["a", "b", "n", "rho"]).astype({"n": "int64", "rho": "float64"})

    pairs = dealt.groupBy("i", "j").applyInPandas(compare, "a string, b string, n long, rho double")
    return pairs.withColumn("rho", F.nanvl("rho", F.lit(None).cast("double")))


def named_pairs(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b, ..) with n and rho, and n_marked and rho_marked over marked rows; pairs without a common row, or with an unknown code, have n 0."""

    @F.pandas_udf("n long, rho double, n_marked long, rho_marked double")
    def agree(ka: pd.Series, va: pd.Series, ma: pd.Series, kb: pd.Series, vb: pd.Series, mb: pd.Series) -> pd.DataFrame:
        out = []
        for a in zip(ka, va, ma, kb, vb, mb, strict=True):
            if a[0] is None or a[3] is None:
                out.append((0, None, 0, None))
                continue
            x, y = _Series(*a[:3]), _Series(*a[3:])
            out.append((*x.agree(y), *x.marked().agree(y.marked())))
        return pd.DataFrame(out, columns=["n", "rho", "n_marked", "rho_marked"]).astype({"rho": "float64", "rho_marked": "float64"})

    side = lambda s: found.select(F.col("code").alias(s), *(F.col(c).alias(f"{c}{s}") for c in "kvm"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    both = both.withColumn("r", agree("ka", "va", "ma", "kb", "vb", "mb")).select(*pairs.columns, "r.*")
    return both.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("rho", "rho_marked")})
