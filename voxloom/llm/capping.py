"""At most so many records per contributor, by radix selection of each contributor's cutoff."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.order import codes_of
from ..operators.skew import Skew
from ..session import cut, forget, stored

LOW, HIGH = -(2**63), 2**63 - 1


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_c, _score, _id) to (_c, _w): score, best first, and id as big-endian 8-byte words that sort as signed longs."""
    top = np.uint64(1 << 63)
    for b in batches:
        score = codes_of(b.column("_score").to_numpy(zero_copy_only=False))
        ids = b.column("_id").to_pylist()
        width = -(-max((len(x) for x in ids), default=1) // 8) or 1
        flat = np.array(ids, dtype=f"S{8 * width}").view(">u8").astype(np.uint64).reshape(len(ids), width)
        words = np.column_stack([~score, (flat ^ top).view(np.int64)])
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * (width + 1))
        yield pa.RecordBatch.from_arrays([b.column("_c"), pa.ListArray.from_arrays(offsets, pa.array(words.ravel())), b.column("_score"), b.column("_id")], names=["_c", "_w", "_score", "_id"])


def _word(i: Column) -> Column:
    return F.coalesce(F.get("_w", i), F.lit(LOW))


def dropped_by_cap(df: DataFrame, contributor: str, score: str, ident: str, *, share: str | None = None, most: int | None = None) -> DataFrame:
    """Records that go when each contributor keeps at most `most` records, or floor(share x all records).

    Highest score first, for equal scores the smaller id first (by code point). share is a decimal as text,
    so that the cap is exact. Returns contributor, score, id of the dropped records; other columns aren't
    read. Rows with a null contributor, score or id count as records but are never ranked or dropped; NaN
    ranks above every number. Rows equal in contributor, score and id are one rank each; where such equal
    rows straddle the cap none of them is kept, so the cap is never exceeded. An empty input drops nothing.

    Radix selection: a record's rank key is its score and id as order-preserving bytes. In each pass the rows
    still in question are counted per contributor and next differing byte (partially before the shuffle,
    at most 256 rows a contributor after it), the byte at which the cap is reached becomes a cutoff digit, and
    the other rows are decided. Bytes that all rows in question share are skipped. No contributor's
    rows are ever sorted or gathered: those of hot ones stay where they are and meet their cutoffs by broadcast.
    """
    rows = df.select(F.col(contributor).alias("_c"), F.col(score).cast("double").alias("_score"), F.col(ident).cast("string").cast("binary").alias("_id"))
    rows = rows.where("_c IS NOT NULL AND _score IS NOT NULL AND _id IS NOT NULL")
    counts = rows.groupBy("_c").agg(F.count("*").alias("_n"))
    if share is not None:
        total, part = df.count(), Fraction(share)
        most = total * part.numerator // part.denominator
    over = cut(counts.where(F.col("_n") > most))
    if share is not None and Fraction(share) >= Fraction(1, 10_000):
        # There are fewer than 1/share contributors above it: a proven bound for the broadcast.
        def met(x: DataFrame, few: DataFrame, how: str = "inner") -> DataFrame:
            return x.join(F.broadcast(few), "_c", how)
    else:
        met = Skew(over, ["_c"], "_n").join
    kind = rows.schema["_c"].dataType.simpleString()
    big = stored(met(rows, over.select("_c"), "left_semi").mapInArrow(_words, f"_c {kind}, _w array<long>, _score double, _id binary"))

    state = cut(over.select("_c", F.lit(most).cast("long").alias("_k"), F.array().cast("array<bigint>").alias("_fix"), F.lit(LOW).alias("_lo"), F.lit(HIGH).alias("_hi"), F.lit(most == 0).alias("_done"), F.lit(False).alias("_with")))
    per = Window.partitionBy("_c").orderBy("_digit")
    while not (live := state.where("NOT _done")).isEmpty():
        at = F.size("_fix")
        inside = met(big, live).where((F.slice("_w", 1, at) == F.col("_fix")) & _word(at).between(F.col("_lo"), F.col("_hi")))
        differ = F.col("_lo").bitwiseXOR(F.col("_hi"))
        shift = F.coalesce(*[F.when(F.shiftrightunsigned(differ, s) != 0, F.lit(s)) for s in range(56, 0, -8)], F.lit(0))
        # Bytes of the word with its top bit turned back, so that they sort as unsigned.
        digit = F.expr("shiftrightunsigned(_v ^ CAST(-9223372036854775808 AS BIGINT), _shift) & 255")
        bins = inside.select("_c", _word(at).alias("_v"), shift.alias("_shift"), (F.size("_w") > at).alias("_more")).withColumn("_digit", digit)
        bins = bins.groupBy("_c", "_digit").agg(F.count("*").alias("_m"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.max("_more").alias("_more"))
        bins = bins.withColumn("_upto", F.sum("_m").over(per)).join(live, "_c")
        bins = bins.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_m") < F.col("_k")))
        left = F.col("_k") - (F.col("_upto") - F.col("_m"))
        fits, same = left == F.col("_m"), F.col("_min") == F.col("_max")
        stuck = same & ~F.col("_more") & ~fits
        step = bins.select(
            "_c", left.alias("_k"),
            F.when(same | fits, F.concat("_fix", F.array("_max"))).otherwise(F.col("_fix")).alias("_fix"),
            F.when(same, F.lit(LOW)).otherwise(F.col("_min")).alias("_lo"), F.when(same, F.lit(HIGH)).otherwise(F.col("_max")).alias("_hi"),
            (fits | stuck).alias("_done"), fits.alias("_with"))
        past, state = state, cut(state.where("_done").unionByName(step))
        forget(past)
    # Keep what sorts before the cutoff digits, or equals them where the cutoff's own rows all fit.
    head = F.slice(F.transform(F.sequence(F.lit(0), F.size("_fix")), _word), 1, F.size("_fix"))
    state = state.select("_c", "_fix", "_with")
    keep = (F.size("_fix") > 0) & ((head < F.col("_fix")) | ((head == F.col("_fix")) & F.col("_with")))
    out = met(big, state).where(~keep)
    return out.select(F.col("_c").alias(contributor), F.col("_score").alias(score), F.col("_id").cast("string").alias(ident))
