"""Joins of many rows with few, where some keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stored

#: A key is hot with more than one in SHARE of all rows, so fewer than SHARE keys can be, and with more than FLOOR rows.
SHARE, FLOOR = 1_000, 100_000


class Skew:
    """The hot keys among counts (one row per key, with the number n of its rows), and joins that spread them.

    A hot key's rows stay where they are and meet the few rows of the other side by broadcast, of which there are fewer
    than SHARE keys'; all other rows are shuffled by key. The result is that of a plain join.
    """

    def __init__(self, counts: DataFrame, keys: list[str], n: str) -> None:
        self.keys = keys
        total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
        self.hot = None
        if total > FLOOR:
            hot = stored(counts.where(F.col(n) > max(total // SHARE, FLOOR)).select(*keys))
            self.hot = None if hot.isEmpty() else hot

    def join(self, rows: DataFrame, few: DataFrame, how: str = "inner") -> DataFrame:
        """rows joined with few, which has a bounded number of rows per key (how: inner or left_semi)."""
        if self.hot is None:
            return rows.join(few, self.keys, how)
        hot = F.broadcast(self.hot)
        spread = rows.join(hot, self.keys, "left_semi").join(F.broadcast(few.join(hot, self.keys, "left_semi")), self.keys, how)
        return spread.unionByName(rows.join(hot, self.keys, "left_anti").join(few, self.keys, how))
