"""Speaker-adaptive limits, hard rules, composite scores, and re-scoring from stored metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings
from ..functions import scores as S

PITCH, RATE = ("f0_std_st", "f0_range_st"), ("global_rate_cps", "local_rate_cv")


def group_percentiles(df: DataFrame, keys: list[str], value: Column, fractions: list[float], out: str) -> DataFrame:
    """Exact, linearly interpolated percentiles of value per keys as an array, and the number n of values.

    Equal values fold into one with a count before the shuffle, so a group's memory follows its distinct
    values. Nulls and NaN are no values; a group without values has no row.
    """
    rows = df.select(*keys, value.cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    ties = rows.groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    return ties.groupBy(*keys).agg(F.percentile("_x", fractions, F.col("_n")).alias(out), F.sum("_n").alias("n"))


def rejected() -> Column:
    return F.coalesce(F.col("status") == "rejected", F.lit(False))


def adaptive_limits(df: DataFrame, speaker: str, s: Settings) -> DataFrame:
    """(speaker, f0_std_st_lo, ..._hi, ...): P10 and P95 per speaker with enough rows; null where switched off.

    Rejected rows don't count (df has a status); a missing metric counts as 0, and skipped local rates count as they
    are stored; rows without a speaker are a speaker of their own.
    """
    out, keyed = None, df.where(~rejected()).withColumn("_spk", F.struct(F.col(speaker).alias("v")))
    for on, least, metrics in ((s.get("f0.adaptive"), s.get("f0.adaptive_min_utts"), PITCH), (s.get("rate.adaptive"), s.get("rate.adaptive_min_utts"), RATE)):
        for m in metrics:
            per = group_percentiles(keyed, ["_spk"], S.number(m), [0.10, 0.95], "_p")
            per = per.where((F.col("n") >= least) & F.lit(bool(on))).select("_spk", F.col("_p")[0].alias(f"{m}_lo"), F.col("_p")[1].alias(f"{m}_hi"))
            out = per if out is None else out.join(per, "_spk", "full")
    return out.withColumn(speaker, F.col("_spk.v")).drop("_spk")


def with_limits(df: DataFrame, speaker: str, s: Settings) -> DataFrame:
    """df with its speaker's own limits, null where it has none."""
    own = adaptive_limits(df, speaker, s).withColumnRenamed(speaker, "_spk")
    return df.join(own, df[speaker].eqNullSafe(own["_spk"]), "left").drop("_spk")


def limits(s: Settings) -> dict[str, tuple[Column, Column]]:
    """A speaker's own limits, else the general ones."""
    general = {m: s.get(("f0." if m in PITCH else "rate.") + m) for m in PITCH + RATE}
    return {m: tuple(F.coalesce(F.col(f"{m}_{e}"), F.lit(float(v))) for e, v in zip(("lo", "hi"), general[m], strict=True)) for m in general}


def with_columns(df: DataFrame, *names: str) -> DataFrame:
    """df with null doubles for the named metrics that it lacks."""
    return df.withColumns({n: F.lit(None).cast("double") for n in names if n not in df.columns})


def scored(df: DataFrame, s: Settings, speaker: str = "speaker_id") -> DataFrame:
    """df with sub-scores, quality_score, grade, prosody_bucket, status and reject_reasons.

    Rows already rejected pass through as they are. The per-speaker limits are a small aggregate joined back.
    """
    df = with_columns(df, "f0_confidence", "clipping_ratio", "cer_vs_manual", "align_coverage", "align_degenerate_char_ratio", "align_char_match_ratio", "align_conf_mean", "high_conf_char_ratio", "snr_db", "lufs")
    df = with_limits(df, speaker, s)
    had = set(df.columns)
    parts = {"audio": S.audio_score(), "align": S.align_score(), "pitch": S.pitch_score(s), "rate": S.rate_score(s), "text": S.text_score()}
    names = {"audio": "audio_quality_score", "align": "align_quality_score", "pitch": "pitch_score", "rate": "rate_score", "text": "text_quality_score"}
    out = df.withColumn("_gone", rejected()).withColumn("_why", S.hard_rules(s, limits(s)))
    out = out.withColumns({f"_{k}": v for k, v in parts.items()})
    out = out.withColumn("_quality", S.quality(s, {k: F.col(f"_{k}") for k in names}))
    old = F.coalesce("reject_reasons", F.array().cast("array<string>"))
    new = {names[k]: F.col(f"_{k}") for k in names} | {"quality_score": F.col("_quality"), "grade": S.grade(F.col("_quality"), s), "prosody_bucket": S.bucket()}
    out = out.withColumns({n: F.when(~F.col("_gone"), c).otherwise(F.col(n) if n in had else F.lit(None)) for n, c in new.items()})
    out = out.withColumns({
        "reject_reasons": F.when(F.col("_gone"), old).otherwise(F.concat(old, "_why")),
        "status": F.when(F.col("_gone") | (F.size("_why") > 0), "rejected").otherwise(F.coalesce("status", F.lit("ok"))),
    })
    return out.drop("_gone", "_why", "_quality", *[f"_{k}" for k in names], *[f"{m}_{e}" for m in PITCH + RATE for e in ("lo", "hi")])


def reason_counts(df: DataFrame, column: str = "reject_reasons") -> DataFrame:
    """(reject_reason, count): how often each reason was given."""
    return df.select(F.explode(column).alias("reject_reason")).groupBy("reject_reason").agg(F.count("*").alias("count"))


def rescored(df: DataFrame, s: Settings) -> DataFrame:
    """Speaker criteria decided again from stored metrics: old reasons of other steps stay, spk_ ones are replaced."""
    t, m = s.get("speaker"), F.col("spk_consistency")
    few = F.array_contains("reject_reasons", "spk_too_few_windows")
    why = S.reasons(
        (m["cluster_silhouette"] > t["silhouette"], "spk_A"), (m["max_dist_to_center"] > t["max_dist_to_center"], "spk_B"), (m["max_neighbor_delta"] > t["max_neighbor_delta"], "spk_C"),
        (m["ref_outlier_ratio"] > t["ref_outlier_ratio"], "spk_D"), (m["overlap_ratio"] > t["overlap_ratio"], "spk_E"))
    old = F.coalesce("reject_reasons", F.array().cast("array<string>"))
    kept = F.filter(old, lambda r: ~r.startswith("spk_"))
    new = F.concat(kept, F.when(few, F.array(F.lit("spk_too_few_windows"))).when(m.isNull(), F.array().cast("array<string>")).otherwise(why))
    return df.withColumn("reject_reasons", new).withColumn("status", F.when(F.size("reject_reasons") > 0, "rejected").otherwise("ok"))
