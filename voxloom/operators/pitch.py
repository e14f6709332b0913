"""Pitch statistics of voiced frames, per utterance and per speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scoring import group_percentiles


def speaker_medians(frames: DataFrame, speaker: str, hz: str) -> DataFrame:
    """(speaker, speaker_median_f0_hz): the exact median of all voiced frames of a speaker."""
    per = group_percentiles(frames.where(F.col(hz) > 0), [speaker], F.col(hz), [0.5], "_p")
    return per.select(speaker, F.col("_p")[0].alias("speaker_median_f0_hz"))


def pitch_stats(frames: DataFrame, utt: str, frame: str, hz: str, median: str, confidence: str | None = None) -> DataFrame:
    """Per utterance mean, median, semitone spread, range, P95 of steps between consecutive voiced frames, voiced share, and
    the voiced frames' mean confidence, if there is one.

    frames: one row per frame, hz 0 where unvoiced, with the speaker's median. With fewer than two voiced
    frames, or no positive median, all but the voiced share and the confidence is 0.
    """
    w = Window.partitionBy(utt).orderBy(frame)
    voiced = (F.col(hz) > 0) & (F.col(median) > 0)
    st = F.when(voiced, 12 * F.log2(F.col(hz) / F.col(median)))
    rows = frames.withColumn("_st", st).withColumn("_f0", F.when(F.col(hz) > 0, F.col(hz)))
    step = F.when((F.col(frame) - F.lag(frame).over(w) == 1) & F.lag("_st").over(w).isNotNull(), F.abs(F.col("_st") - F.lag("_st").over(w)))
    rows = rows.withColumn("_step", step)
    out = rows.groupBy(utt).agg(
        F.count("_f0").alias("_v"), F.avg("_f0").alias("f0_mean_hz"), F.percentile("_f0", 0.5).alias("f0_median_hz"), F.stddev_pop("_st").alias("f0_std_st"),
        (F.percentile("_st", 0.95) - F.percentile("_st", 0.05)).alias("f0_range_st"), F.percentile("_step", 0.95).alias("f0_delta_p95_st"), (F.count("_f0") / F.count("*")).alias("voiced_ratio"), F.max(median).alias("_med"),
        *([F.coalesce(F.avg(F.when(F.col(hz) > 0, F.col(confidence))), F.lit(0.0)).alias("f0_confidence")] if confidence else []))
    names = ("f0_mean_hz", "f0_median_hz", "f0_std_st", "f0_range_st", "f0_delta_p95_st")
    return out.withColumns({n: F.when((F.col("_v") >= 2) & (F.col("_med") > 0), F.coalesce(n, F.lit(0.0))).otherwise(0.0) for n in names}).drop("_v", "_med")
