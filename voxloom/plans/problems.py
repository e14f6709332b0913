"""Queries of the general training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.periods import speech_periods
from .tables import Registry, table

REGISTRY = Registry()

P6_SQL = """
WITH v AS (SELECT source_audio_id, speaker_label, round("start" * 1000)::BIGINT AS s, round("end" * 1000)::BIGINT AS e
           FROM vad_coarse WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND source_audio_id IS NOT NULL AND speaker_label IS NOT NULL),
o AS (SELECT *, max(e) OVER (PARTITION BY source_audio_id, speaker_label ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM v WHERE e > s),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY source_audio_id, speaker_label ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o),
p AS (SELECT source_audio_id, speaker_label, min(s) AS s, max(e) AS e FROM n GROUP BY source_audio_id, speaker_label, island),
g AS (SELECT *, lead(s) OVER (PARTITION BY source_audio_id, speaker_label ORDER BY s) AS next_s FROM p)
SELECT 'period' AS kind, source_audio_id, speaker_label, s AS start_ms, e AS end_ms FROM p
UNION ALL SELECT 'gap', source_audio_id, speaker_label, e, next_s FROM g WHERE next_s IS NOT NULL
"""


@REGISTRY.query("p6_found", P6_SQL)
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    vad = table(spark, folder, "vad_coarse")
    ms = {c: F.expr(f"try_cast(round(`{c}` * 1000) AS BIGINT)") for c in ("start", "end")}
    out = speech_periods(vad, ["source_audio_id", "speaker_label"], ms["start"], ms["end"])
    return out.select("kind", "source_audio_id", "speaker_label", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))
