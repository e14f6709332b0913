"""Leakage-safe splits by group, and the routing of grades."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings

KEEP = (
    "utt_id", "speaker_id", "speaker_label", "source_audio_id", "wav", "sample_rate", "duration", "start", "end", "alignment_json_path", "f0_npy_path", "text", "prev_text", "next_text",
    "f0_median_hz", "f0_std_st", "f0_delta_p95_st", "global_rate_cps", "local_rate_cv", "pause_ratio", "quality_score", "grade", "prosody_bucket", "status", "reject_reasons", "language", "domain", "recording_type",
)


def leakage_key(s: Settings, columns: list[str] | None = None) -> Column:
    """What must not be on two sides: the recording, or the speaker where speakers are held out; of the columns there are."""
    names = ("speaker_id",) if s.get("split.speaker_holdout") else ("source_audio_id", "source_audio", "speaker_id")
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if columns is None or n in columns])


def deal(weights: list[float], ratios: dict[str, float]) -> list[str]:
    """Splits of groups given by falling weight: one group is reserved for each split but the first, from the smallest
    up, as long as one is left for the first; then each goes to the split that lacks most."""
    names = list(ratios)
    total, have, out = sum(weights), dict.fromkeys(names, 0.0), [""] * len(weights)
    last = len(weights)
    for name in names[1:]:
        if last <= 1 or ratios[name] <= 0:
            continue
        last -= 1
        out[last] = name
        have[name] += weights[last]
    for i in range(last):
        best = max(names, key=lambda n: ratios[n] * total - have[n])
        out[i] = best
        have[best] += weights[i]
    return out


def group_splits(groups: DataFrame, key: str, weight: str, ratios: dict[str, float]) -> DataFrame:
    """(key, split). The rule is sequential over groups by falling weight (ties by key), so it runs in one task on one
    narrow row per group; for more groups than a task can hold, use a split by ordered cumulative weight."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["w", "k"], ascending=[False, True], kind="stable")
        return pd.DataFrame({"k": pdf["k"], "split": deal(pdf["w"].tolist(), ratios)})

    rows = groups.select(F.col(key).alias("k"), F.col(weight).cast("double").alias("w")).withColumn("_one", F.lit(1))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.groupBy("_one").applyInPandas(lambda p: run(p), f"k {kind}, split string").withColumnRenamed("k", key)


def routed(df: DataFrame, s: Settings) -> DataFrame:
    """df (already without near copies) with split and split_weight; rows that no split takes are left out.

    A and B rows follow their group; C rows go to train at half weight where their group is in train, and are left out
    elsewhere; D rows and rejected ones are `rejected`. A row without a key is left out unless it is rejected.
    """
    rows = df.withColumn("_key", leakage_key(s, df.columns))
    gone = F.coalesce(F.col("status") == "rejected", F.lit(False))
    good = rows.where(~gone & F.col("grade").isin("A", "B"))
    sizes = good.where("_key IS NOT NULL").groupBy("_key").agg(F.sum(F.coalesce("duration", F.lit(0.0))).alias("_w"))
    dealt = group_splits(sizes, "_key", "_w", s.get("split.ratios"))
    good = good.join(dealt, "_key").withColumn("split_weight", F.lit(None).cast("double"))
    spare = rows.where(~gone & (F.col("grade") == "C")).join(dealt.where("split = 'train'").select("_key"), "_key", "left_semi")
    spare = spare.withColumn("split", F.lit("train")).withColumn("split_weight", F.lit(0.5))
    low = ~gone & F.coalesce(~F.col("grade").isin("A", "B", "C"), F.lit(True))
    bad = rows.where(gone | low).withColumn("split", F.lit("rejected")).withColumn("split_weight", F.lit(None).cast("double"))
    old = F.coalesce("reject_reasons", F.array().cast("array<string>"))
    bad = bad.withColumn("reject_reasons", F.when(F.coalesce(F.col("status") == "rejected", F.lit(False)), old).otherwise(F.concat(old, F.array(F.lit("grade_D"))))).withColumn("status", F.lit("rejected"))
    return good.unionByName(spare).unionByName(bad).drop("_key")


def projected(df: DataFrame) -> DataFrame:
    """The final columns; missing ones as null, sample_rate 24000 where unknown."""
    have = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in KEEP if c != "sample_rate"]
    rate = F.coalesce(F.col("sample_rate").cast("int") if "sample_rate" in df.columns else F.lit(None).cast("int"), F.lit(24000)).alias("sample_rate")
    return df.select(*[F.col(c) for c in ("split", "split_weight") if c in df.columns], *have, rate)
