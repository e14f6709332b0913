"""Silences, turn boundaries, cut points, and joins of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def silences(speech: DataFrame, keys: list[str], start: str, end: str, totals: DataFrame, total: str) -> DataFrame:
    """(*keys, start, end): what speech leaves uncovered of [0, total], head and tail included.

    totals has one row per key. Speech beyond total counts up to it; null bounds are left out; a key without speech is silent throughout.
    """
    rows = speech.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e")).where("_s IS NOT NULL AND _e > _s")
    ends = totals.select(*keys, F.col(total).alias("_s"), F.col(total).alias("_e"))
    rows = rows.join(totals.select(*keys, F.col(total).alias("_t")), keys).select(*keys, F.least("_s", "_t").alias("_s"), F.least("_e", "_t").alias("_e"))
    order = Window.partitionBy(*keys).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.unionByName(ends).withColumn("_reach", F.coalesce(F.max("_e").over(order), F.lit(0.0)))
    return out.where("_s > _reach").select(*keys, F.col("_reach").alias("start"), F.col("_s").alias("end"))


def long_silence_middles(gaps: DataFrame, keys: list[str], least_ms: float) -> DataFrame:
    return gaps.where((F.col("end") - F.col("start")) * 1000 >= least_ms).select(*keys, ((F.col("start") + F.col("end")) / 2).alias("mid"), "start", "end")


def turn_boundaries(turns: DataFrame, keys: list[str], start: str, label: str, tie: list[str]) -> DataFrame:
    """Rows of turns that begin a run of another label than the turn before."""
    before = F.lag(label).over(Window.partitionBy(*keys).orderBy(start, *tie))
    return turns.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col(label) != F.col("_before"))).drop("_before")


def label_runs(turns: DataFrame, keys: list[str], start: str, end: str, label: str, tie: list[str], touch: float = 1e-3) -> DataFrame:
    """Neighbouring turns of one label that meet, less than touch apart, become one: (*keys, label, start, end, n)."""
    w = Window.partitionBy(*keys).orderBy(start, *tie)
    new = (F.lag(label).over(w).eqNullSafe(F.col(label)) & (F.abs(F.col(start) - F.lag(end).over(w)) < touch)).cast("int")
    run = F.sum(1 - F.coalesce(F.col("_joined"), F.lit(0))).over(w)
    rows = turns.withColumn("_joined", new).withColumn("_run", run)
    return rows.groupBy(*keys, label, "_run").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n")).drop("_run")


def renamed_labels(turns: DataFrame, keys: list[str], label: str, speaker: Column) -> Column:
    """speaker_a, speaker_b, ... in the order of the labels where a key has several labels, else the speaker itself."""
    w = Window.partitionBy(*keys)
    rank = F.dense_rank().over(w.orderBy(label))
    several = F.min(label).over(w) != F.max(label).over(w)
    return F.when(several, F.concat(speaker, F.lit("_"), F.char(F.lit(96) + rank))).otherwise(speaker)


def cut_spans(points: DataFrame, keys: list[str], point: str, totals: DataFrame, total: str, least: float = 1e-6) -> DataFrame:
    """Spans between neighbouring cut points of [0, total]; ends always cut; spans of `least` at most are left out."""
    inside = points.join(totals.select(*keys, F.col(total).alias("_t")), keys).where(F.col(point).between(0, F.col("_t"))).select(*keys, F.col(point).alias("_p"))
    both = totals.select(*keys, F.explode(F.array(F.lit(0.0), F.col(total))).alias("_p"))
    rows = inside.unionByName(both).distinct()
    rows = rows.withColumn("_q", F.lead("_p").over(Window.partitionBy(*keys).orderBy("_p")))
    return rows.where(F.col("_q") - F.col("_p") > least).select(*keys, F.col("_p").alias("start"), F.col("_q").alias("end"))


def nearest(points: DataFrame, keys: list[str], point: str, ident: str, targets: DataFrame, mid: str, tolerance: float) -> DataFrame:
    """points with `snapped`: the nearest target within tolerance (the earlier of two at one distance), else the point.

    An equi-join on keys and a time bucket as wide as the tolerance: each point looks into three buckets.
    """
    b = targets.select(*keys, F.col(mid).alias("_m"), F.floor(F.col(mid) / tolerance).alias("_b"))
    p = points.withColumn("_b", F.explode(F.array(*[F.floor(F.col(point) / tolerance) + i for i in (-1, 0, 1)])))
    hit = p.join(b, [*keys, "_b"]).withColumn("_d", F.abs(F.col("_m") - F.col(point))).where(F.col("_d") <= tolerance)
    best = hit.groupBy(*keys, ident).agg(F.min_by("_m", F.struct("_d", "_m")).alias("_m"))
    return points.join(best, [*keys, ident], "left").withColumn("snapped", F.coalesce("_m", F.col(point))).drop("_m")


def overlapping(a: DataFrame, b: DataFrame, keys: list[str], bucket: float) -> DataFrame:
    """Pairs of a (a_id, a_start, a_end) and b (b_id, b_start, b_end) of one key that overlap, with the overlap's bounds.

    Each interval enters the buckets of time it touches; a pair is taken in the bucket where its overlap begins.
    """

    def spread(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.where(F.col(e) > F.col(s)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(s) / bucket), F.floor(F.col(e) / bucket))))

    both = spread(a, "a_start", "a_end").join(spread(b, "b_start", "b_end"), [*keys, "_b"])
    s, e = F.greatest("a_start", "b_start"), F.least("a_end", "b_end")
    return both.where((s < e) & (F.floor(s / bucket) == F.col("_b"))).select(*keys, "a_id", "b_id", s.alias("start"), e.alias("end"))


def forced_cuts(start: Column, end: Column, mids: Column, longest: float) -> Column:
    """Cut points of a long segment, as an array: at the silence middle nearest to a full length, else at the full length.

    mids are the sorted silence middles; a fold over as many steps as the segment may need.
    """
    steps = F.sequence(F.lit(1), F.ceil((end - start) / longest).cast("int") + F.size(mids))

    def step(acc: Column, _: Column) -> Column:
        cur = acc["cur"]
        near = F.filter(mids, lambda m: (m > cur) & (m <= cur + longest))
        cut = F.when(F.size(near) > 0, F.array_max(near)).otherwise(cur + longest)
        more = end - cur > longest
        return F.struct(F.when(more, cut).otherwise(cur).alias("cur"), F.when(more, F.concat(acc["cuts"], F.array(cut))).otherwise(acc["cuts"]).alias("cuts"))

    return F.aggregate(steps, F.struct(start.alias("cur"), F.array().cast("array<double>").alias("cuts")), step, lambda acc: acc["cuts"])
