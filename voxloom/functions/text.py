"""Column expressions on strings and identifiers."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from .order import mixed

#: Speaker names that stand for no speaker.
NO_SPEAKER = ("", "multi", "unknown")


def strip_blanks(c: Column | str) -> Column:
    """Without blanks of any kind at either end; null stays null."""
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def speaker_key(c: Column | str) -> Column:
    """A speaker's name without outer blanks and letter case; null where it names no speaker."""
    name = F.lower(strip_blanks(c))
    return F.when(~name.isin(*NO_SPEAKER), name)


# ASCII punctuation and what it becomes.
HALF, FULL = ",.?!:;()[]", "，。？！：；（）［］"


def normalized(c: Column | str) -> Column:
    """Full-width punctuation, single blanks, none between two signs beyond ASCII, none at the ends."""
    out = F.regexp_replace(F.translate(c, HALF, FULL), r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(out, r"(?<=[^\x00-\x7f]) (?=[^\x00-\x7f])", ""))


def grams(c: Column | str, n: int = 5) -> Column:
    """Distinct n-grams; a shorter text is its own only gram, an empty or null one has none."""
    c = F.col(c) if isinstance(c, str) else c
    size = F.length(c)
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(many)


def text_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each 5-gram of a whole Arrow batch at once, repeated ones too; those of grams()'s, in 64 bits."""
    size, whole = 5, pc.fill_null(texts, "").to_pylist()
    codes = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32)
    n = np.array([len(t) for t in whole], np.int64)
    m = np.where(n >= size, n - size + 1, n > 0)
    row = np.repeat(np.arange(len(n)), m)
    place = np.repeat(np.cumsum(n) - n, m) + np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
    length = np.minimum(n[row], size)
    bits = mixed(np.r_[codes, np.zeros(size, np.uint32)])
    h = length.astype(np.uint64)
    for i in range(size):
        h = np.where(length > i, h * np.uint64(0x9E3779B97F4A7C15) + bits[np.minimum(place + i, len(bits) - 1)], h)
    return row, mixed(h)


def by_row(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The order by row, then by x. Few rows need few bits, which sort faster."""
    by = np.argsort(x)
    return by[np.argsort(row.astype(np.min_scalar_type(int(row.max(initial=0))))[by], kind="stable")]


def first_of(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where a row's value differs from the one before it."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
    return new


def distinct_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As text_grams(), each once, sorted within its row."""
    row, h = text_grams(texts)
    by = by_row(row, h.view(np.int64))
    row, h = row[by], h[by]
    new = first_of(row, h)
    return row[new], h[new]


@F.arrow_udf(DoubleType())
def gram_jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    """jaccard() of the 5-grams of two texts."""
    (row, h), (row_b, h_b) = distinct_grams(a), distinct_grams(b)
    row, h = np.r_[row, row_b], np.r_[h, h_b]
    by = by_row(row, h.view(np.int64))
    row, h = row[by], h[by]
    both = np.bincount(row[~first_of(row, h)], minlength=len(a))
    return pa.array(both / np.maximum(np.bincount(row, minlength=len(a)) - both, 1))


@F.arrow_udf(StructType().add("n", IntegerType()).add("h", LongType()).add("k", LongType()))
def gram_sign(texts: pa.Array) -> pa.Array:
    """What stands for a text's set of 5-grams: their number, and two sums of hashes (128 bits)."""
    row, h = distinct_grams(texts)
    n = np.bincount(row, minlength=len(texts))
    some, sums = n > 0, np.zeros((2, len(texts)), np.uint64)
    if len(row):
        for i, x in enumerate((h, mixed(h))):
            sums[i, some] = np.add.reduceat(x, (np.cumsum(n) - n)[some])
    return pa.StructArray.from_arrays([pa.array(n.astype(np.int32)), *map(pa.array, sums.view(np.int64))], names=["n", "h", "k"])


def jaccard(a: Column, b: Column) -> Column:
    """0 where either set is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def proportional_slice(text: Column, start: Column, end: Column, total: Column) -> Column:
    """The share of text that [start, end) of total covers; places are rounded half to even."""
    n = F.length(text)

    def place(t: Column) -> Column:
        return F.greatest(F.lit(0), F.least(n, F.rint(n * t / total).cast("int")))

    a, b = place(start), place(end)
    return F.when(total > 0, F.trim(F.substring(text, a + 1, F.greatest(b - a, F.lit(0))))).otherwise(F.lit(""))


def short_hash(c: Column | str) -> Column:
    """First 16 hex digits of the SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def ideographs_only(c: Column | str) -> Column:
    return F.regexp_replace(c, "[^一-鿿]", "")


def cer(ref: Column, hyp: Column) -> Column:
    """(longer length - letters in matching blocks) / reference length, blocks by the Ratcliff/Obershelp method.

    Null for a null text; an empty reference gives 0 for an empty text and 1 otherwise.
    """
    return F.when(ref.isNotNull() & hyp.isNotNull(), _cer(ref, hyp))


@F.pandas_udf(DoubleType())
def _cer(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    def one(r: str | None, h: str | None) -> float | None:
        if r is None or h is None:
            return None
        if not r:
            return float(bool(h))
        same = sum(b.size for b in SequenceMatcher(None, r, h, autojunk=False).get_matching_blocks())
        return (max(len(r), len(h)) - same) / len(r)

    return pd.Series([one(r, h) for r, h in zip(ref, hyp, strict=True)], dtype="float64")
