"""Speech rate and pauses from character alignments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings


def valid_chars(chars: Column) -> Column:
    return F.filter(F.coalesce(chars, F.array().cast("array<struct<char:string,start:double,end:double,confidence:double>>")), lambda c: c["end"] > c["start"])


def _mean(a: Column) -> Column:
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda x, y: x + y), F.size(a))


def array_percentile(a: Column, p: float) -> Column:
    """Linear interpolation over a sorted array; null for an empty one."""
    at = (F.size(a) - 1) * F.lit(p)
    low, high = F.get(a, F.floor(at).cast("int")), F.get(a, F.ceil(at).cast("int"))
    return low + (high - low) * (at - F.floor(at))


def with_rate(df: DataFrame, chars: str, duration: str, s: Settings) -> DataFrame:
    """df with n_chars, global_rate_cps, local_rate_*, pause_ratio, long_pause_count and local_rate_skipped.

    All of it is array arithmetic within the row: no shuffle, no Python. Characters with end <= start don't count.
    """
    size, hop, least = (s.get(f"rate.{k}") for k in ("window_chars", "hop_chars", "min_chars"))
    rows = df.withColumn("_c", valid_chars(F.col(chars)))
    n = F.size("_c")
    spoken = F.aggregate("_c", F.lit(0.0), lambda x, c: x + (c["end"] - c["start"]))
    gaps = F.when(n > 1, F.zip_with(F.slice("_c", 2, F.greatest(n - 1, F.lit(0))), F.slice("_c", 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b["start"] - a["end"])).otherwise(F.array().cast("array<double>"))
    last = n - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(hop))).otherwise(F.array().cast("array<int>"))
    spans = F.transform(starts, lambda i: F.get("_c", i + (size - 1))["end"] - F.get("_c", i)["start"])
    rates = F.transform(F.filter(spans, lambda x: x > 0), lambda x: F.lit(float(size)) / x)
    rows = rows.withColumns({"_n": n, "_spoken": spoken, "_gaps": gaps, "_rates": F.array_sort(rates)})
    rows = rows.withColumn("_skip", (F.col("_n") < least) | (F.col("_n") < size) | (F.size("_rates") < 2)).withColumn("_mean", _mean(F.col("_rates")))
    std = F.sqrt(_mean(F.transform("_rates", lambda r: (r - F.col("_mean")) * (r - F.col("_mean")))))
    rows = rows.withColumn("_std", std)
    pauses = F.aggregate(F.filter("_gaps", lambda g: g > 0.2), F.lit(0.0), lambda x, g: x + g)

    def local(c: Column) -> Column:
        return F.when(F.col("_skip"), 0.0).otherwise(c)

    d = F.col(duration)
    out = rows.withColumns({
        "n_chars": F.col("_n"), "global_rate_cps": F.when(F.col("_spoken") > 0, F.col("_n") / F.col("_spoken")).otherwise(0.0),
        "local_rate_mean": local(F.col("_mean")), "local_rate_std": local(F.col("_std")), "local_rate_cv": local(F.when(F.col("_mean") > 0, F.col("_std") / F.col("_mean")).otherwise(0.0)),
        "local_rate_p5_p95_range": local(array_percentile(F.col("_rates"), 0.95) - array_percentile(F.col("_rates"), 0.05)),
        "pause_ratio": F.when(d > 0, pauses / d).otherwise(0.0), "long_pause_count": F.size(F.filter("_gaps", lambda g: g > 0.5)), "local_rate_skipped": F.col("_skip"),
    })
    return out.drop("_c", "_n", "_spoken", "_gaps", "_rates", "_skip", "_mean", "_std")


def alignment_quality(chars: Column, text_chars: Column, start: Column, end: Column, confident: float = 0.6) -> dict[str, Column]:
    """Coverage, degenerate and match ratios and confidences of an aligned text; 0 where there are no characters."""
    n = F.size(chars)
    length = F.aggregate(chars, F.lit(0.0), lambda x, c: x + F.greatest(F.lit(0.0), c["end"] - c["start"]))
    odd = F.size(F.filter(chars, lambda c: (c["end"] - c["start"] < 0.02) | (c["end"] - c["start"] > 0.5)))
    conf = F.array_sort(F.transform(chars, lambda c: c["confidence"]))
    some = n > 0
    return {
        "align_coverage": F.when(some & (end > start), length / (end - start)).otherwise(0.0), "align_degenerate_char_ratio": F.when(some, odd / n).otherwise(1.0),
        "align_char_match_ratio": F.when(text_chars > 0, n / text_chars).otherwise(0.0), "align_conf_mean": F.when(some, _mean(conf)).otherwise(0.0),
        "align_conf_p10": F.when(some, array_percentile(conf, 0.1)).otherwise(0.0), "high_conf_char_ratio": F.when(some, F.size(F.filter(conf, lambda c: c >= confident)) / n).otherwise(0.0),
    }


def shifted(chars: Column, offset: float, start: Column, end: Column) -> Column:
    """Characters moved back by offset, clamped to the segment; end never before start."""
    if not offset:
        return chars

    def move(c: Column) -> Column:
        s = F.least(end, F.greatest(start, c["start"] - offset))
        e = F.greatest(s, F.least(end, c["end"] - offset))
        return F.struct(c["char"].alias("char"), s.alias("start"), e.alias("end"), c["confidence"].alias("confidence"))

    return F.transform(chars, move)


CHARS = "array<struct<char:string,start:double,end:double,confidence:double>>"


def even_chars(text: Column, start: Column, end: Column, confidence: float = 0.95) -> Column:
    """A deterministic stand-in for an aligner: the text's non-blank characters tile [start, end].

    Each is as wide as 1 + (code point mod 7). Widths are summed up over a whole Arrow batch at once.
    """

    @F.arrow_udf(CHARS)
    def run(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        null = pc.or_(pc.or_(texts.is_null(), starts.is_null()), ends.is_null())
        whole = pc.fill_null(texts, "").to_pylist()
        letters = "".join(whole)
        codes = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(whole)), [len(t) for t in whole])
        shown = codes != 0x20
        codes, row = codes[shown], row[shown]
        n = np.bincount(row, minlength=len(whole))
        offsets = np.r_[0, np.cumsum(n)]
        upto = np.r_[0, np.cumsum(1 + codes % 7)].astype(float)
        total = (upto[offsets[1:]] - upto[offsets[:-1]])[row]
        a, b = (x.fill_null(0.0).to_numpy(zero_copy_only=False) for x in (starts, ends))
        length = (b - a)[row]
        before = upto[:-1] - upto[offsets[:-1]][row]
        after = upto[1:] - upto[offsets[:-1]][row]
        raw = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
        width = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
        signs = pa.StringArray.from_buffers(len(codes), pa.py_buffer(np.r_[0, np.cumsum(width)].astype(np.int32)), pa.py_buffer(raw))
        fields = [signs, pa.array(a[row] + length * before / total), pa.array(a[row] + length * after / total), pa.array(np.full(len(codes), confidence))]
        chars = pa.StructArray.from_arrays(fields, names=["char", "start", "end", "confidence"])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), chars, mask=null.combine_chunks() if isinstance(null, pa.ChunkedArray) else null)

    return run(text, start.cast("double"), end.cast("double"))
