"""Rows that several of the problems start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import speaker_key
from ..plans.tables import table

#: SQL text of the same rows.
LATEST_SQL = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY utt_id ORDER BY loaded_at DESC NULLS LAST) AS rn,
    lower(regexp_replace(speaker_id, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')) AS speaker FROM filter_score) WHERE rn = 1)"""
SCORED_SQL = LATEST_SQL + """,
scored AS (SELECT utt_id, speaker, quality_score FROM latest WHERE status IS DISTINCT FROM 'rejected' AND quality_score IS NOT NULL
    AND speaker IS NOT NULL AND speaker NOT IN ('', 'multi', 'unknown'))"""


def latest_rows(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """filter_score with one row per utt_id, that of the latest loaded_at; speaker_id as `speaker`.

    A maximum that is partly taken before the shuffle, so that an id that comes back very often costs little.
    """
    rows = table(spark, folder, "filter_score")
    row = F.struct(F.coalesce("loaded_at", F.to_timestamp_ntz(F.lit("0001-01-01"))).alias("_at"), *columns)
    rows = rows.groupBy("utt_id").agg(F.max(row).alias("_r"))
    rows = rows.select("utt_id", *[F.col(f"_r.{c}").alias(c) for c in columns])
    return rows.withColumn("speaker", speaker_key("speaker_id")) if "speaker_id" in columns else rows


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The scored rows of TESTDATA.md: utt_id, speaker, quality_score."""
    rows = latest_rows(spark, folder, ["speaker_id", "quality_score", "status"])
    rows = rows.where(F.coalesce(F.col("status") != "rejected", F.lit(True)) & F.col("quality_score").isNotNull() & F.col("speaker").isNotNull())
    return rows.select("utt_id", "speaker", "quality_score")
