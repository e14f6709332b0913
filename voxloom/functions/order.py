"""Order-preserving integer codes, so that numbers can be compared, bisected and bucketed bit by bit."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, LongType


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each whole number."""
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def codes_of(values: np.ndarray) -> np.ndarray:
    """int64 codes that sort as the doubles do (-0.0 as 0.0, NaN above all)."""
    v = np.asarray(values, np.float64) + 0.0
    v = np.where(np.isnan(v), np.nan, v)
    bits = v.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def values_of(codes: np.ndarray) -> np.ndarray:
    c = np.asarray(codes, np.int64)
    return (c ^ ((c >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


@F.pandas_udf(LongType())
def _code(v: pd.Series) -> pd.Series:
    return pd.Series(codes_of(v.to_numpy(np.float64, na_value=np.nan)))


@F.pandas_udf(DoubleType())
def _value(c: pd.Series) -> pd.Series:
    return pd.Series(values_of(c.to_numpy(np.int64, na_value=0)))


def order_code(c: Column) -> Column:
    """Long that orders as the double does; null for null."""
    return F.when(c.isNotNull(), _code(c.cast("double")))


def from_code(c: Column) -> Column:
    return F.when(c.isNotNull(), _value(c))
