"""Percentiles per group: exact ones by bisection, and mergeable summaries of bounded error."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.order import from_code, order_code
from ..operators.skew import Skew
from ..session import cut, forget, stored

#: Parts into which a pass divides each interval: with 16, one pass does the work of four halvings.
SECTIONS = 16


def value_counts(df: DataFrame, group: str, metrics: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """How often each value occurs: (*by, _g, metric, _code, n). Nulls and NaN are no values.

    The tables of single days or partitions can be unioned: their counts add up.
    """
    rows = _values(df, group, metrics, by).groupBy(*by, "_g", "metric", "x").agg(F.count("*").alias("n"))
    return rows.select(*by, "_g", "metric", order_code(F.col("x")).alias("_code"), "n")


def _values(df: DataFrame, group: str, metrics: list[str], by: tuple[str, ...]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics]))
    rows = df.where(F.col(group).isNotNull()).select(*by, F.col(group).alias("_g"), pairs.alias("_p"))
    return rows.where("_p.x IS NOT NULL AND NOT isnan(_p.x)").select(*by, "_g", "_p.metric", "_p.x")


def exact_percentiles(counts: DataFrame, fractions: list[str]) -> DataFrame:
    """_g, metric, fraction, n, value for the union of the given value counts (as made by value_counts).

    value interpolates linearly between the two neighbouring ranks, as NumPy's default does. Groups without
    values have no row; ties and repeated rows count as often as they occur.

    Bisection: each wanted rank holds an interval of value codes, at first all of them. A pass counts the rows
    below the interval's midpoints (SECTIONS - 1 evenly spaced ones), all ranks of all groups at once, moves
    each rank to the section that holds it and narrows that to the values that occur in it. The rank is
    resolved when one value is left. Counts are summed before the shuffle; a pass moves a few numbers
    per group and task, and the values only of groups that aren't hot.
    """
    counts = stored(counts.groupBy("_g", "metric", "_code").agg(F.sum("n").alias("n")))
    sizes = counts.groupBy("_g", "metric").agg(F.sum("n").alias("_all"), F.min("_code").alias("_lo"), F.max("_code").alias("_hi"), F.count("*").alias("_values"))
    sizes = cut(sizes)
    skew = Skew(sizes, ["_g", "metric"], "_values")
    wanted = [F.struct(F.lit(f).alias("fraction"), *_ranks(f)) for f in fractions]
    asked = sizes.withColumn("_w", F.explode(F.array(*wanted))).select("_g", "metric", "_all", "_lo", "_hi", "_w.*")
    both = F.array_distinct(F.array(F.col("_r"), F.least(F.col("_r") + 1, F.col("_all"))))
    ranks = asked.select("_g", "metric", "_lo", "_hi", F.explode(both).alias("_rank")).distinct()
    ranks = cut(ranks.withColumn("_base", F.lit(0).cast("long")))
    open_ = F.col("_lo") < F.col("_hi")
    per = Window.partitionBy("_g", "metric", "_lo").orderBy("_part")
    while not ranks.where(open_).isEmpty():
        spans = ranks.where(open_).groupBy("_g", "metric").agg(F.collect_set(F.struct("_lo", "_hi")).alias("_spans"))
        hit = F.get(F.filter("_spans", lambda s: F.col("_code").between(s["_lo"], s["_hi"])), F.lit(0))
        rows = skew.join(counts, spans).withColumn("_span", hit).where("_span IS NOT NULL")
        rows = rows.select("_g", "metric", "_code", "n", "_span._lo", "_span._hi").withColumn("_part", _section())
        bins = rows.groupBy("_g", "metric", "_lo", "_part").agg(F.sum("n").alias("_m"), F.min("_code").alias("_a"), F.max("_code").alias("_b"))
        bins = bins.withColumn("_upto", F.sum("_m").over(per))
        step = ranks.where(open_).join(bins, ["_g", "metric", "_lo"]).where("_base + _upto >= _rank AND _base + _upto - _m < _rank")
        step = step.select("_g", "metric", F.col("_a").alias("_lo"), F.col("_b").alias("_hi"), "_rank", F.expr("_base + _upto - _m").alias("_base"))
        past, ranks = ranks, cut(ranks.where(~open_).unionByName(step))
        forget(past)
    done = ranks.select("_g", "metric", "_rank", F.col("_lo").alias("_v"))
    low = done.withColumnsRenamed({"_rank": "_r", "_v": "_v1"})
    high = done.withColumnsRenamed({"_rank": "_r2", "_v": "_v2"})
    out = asked.withColumn("_r2", F.least(F.col("_r") + 1, F.col("_all"))).join(low, ["_g", "metric", "_r"]).join(high, ["_g", "metric", "_r2"])
    a, b = from_code(F.col("_v1")), from_code(F.col("_v2"))
    return out.select("_g", "metric", "fraction", F.col("_all").alias("n"), F.when(F.col("_v1") == F.col("_v2"), a).otherwise(a + (b - a) * F.col("_rest")).alias("value"))


def _ranks(fraction: str) -> list[Column]:
    """The lower rank (from 1) and the share of the way to the next, exact for the decimal fraction."""
    f = Fraction(fraction)
    at = F.expr(f"(_all - 1) * {f.numerator}L")
    return [(F.floor(at / F.lit(f.denominator)).cast("long") + 1).alias("_r"), (F.pmod(at, F.lit(f.denominator)) / F.lit(float(f.denominator))).alias("_rest")]


def _section() -> Column:
    """Which of SECTIONS equal parts of [_lo, _hi] holds _code; wide spans are measured in units of 2^10, as their length may not fit a long."""
    wide = F.expr("shiftright(_hi, 10) - shiftright(_lo, 10) > 1048576")
    far = F.expr(f"(shiftright(_code, 10) - shiftright(_lo, 10)) div ((shiftright(_hi, 10) - shiftright(_lo, 10)) div {SECTIONS} + 1)")
    near = F.expr(f"(_code - _lo) div ((_hi - _lo) div {SECTIONS} + 1)")
    return F.when(wide, far).otherwise(near).cast("int")


def sketch(df: DataFrame, group: str, metrics: list[str], by: tuple[str, ...] = (), bits: int = 7) -> DataFrame:
    """A mergeable summary: counts per value bucket, (*by, _g, metric, _bucket, n).

    A bucket holds the values that share sign, exponent and the first `bits` bits of the mantissa, so any value
    in it is within a share 2^-bits of any other. Summaries merge by adding counts, and a group has at
    most 2^(12+bits) buckets however many rows it has; values are put into buckets before they are shuffled.
    """
    codes = _values(df, group, metrics, by).select(*by, "_g", "metric", F.shiftright(order_code(F.col("x")), 52 - bits).alias("_bucket"))
    return codes.groupBy(*by, "_g", "metric", "_bucket").agg(F.count("*").alias("n"))


def sketch_percentiles(sketches: DataFrame, fractions: list[str], bits: int = 7) -> DataFrame:
    """_g, metric, fraction, n, low, high: bounds of the value of rank ceil(fraction x n), high <= low x (1 + 2^-bits) for positive values."""
    merged = sketches.groupBy("_g", "metric", "_bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("_g", "metric")
    merged = merged.withColumn("_upto", F.sum("n").over(w.orderBy("_bucket"))).withColumn("_all", F.sum("n").over(w))
    need = [F.struct(F.lit(f).alias("fraction"), F.expr(f"greatest(1L, (_all * {Fraction(f).numerator}L + {Fraction(f).denominator - 1}L) div {Fraction(f).denominator}L)").alias("_need")) for f in fractions]
    out = merged.withColumn("_w", F.explode(F.array(*need))).where("_upto >= _w._need AND _upto - n < _w._need")
    first, last = F.shiftleft("_bucket", 52 - bits), F.shiftleft(F.col("_bucket") + 1, 52 - bits) - 1
    return out.select("_g", "metric", "_w.fraction", F.col("_all").alias("n"), from_code(first).alias("low"), from_code(last).alias("high"))
