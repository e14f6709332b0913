"""Validation of incoming recordings and quality thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Settings
from ..functions.scores import reasons

REQUIRED = ("audio_path", "speaker_id", "language", "domain", "recording_type")


def cleaned(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns as stripped strings; missing ones and nulls as empty."""
    return df.withColumns({c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in df.columns else F.lit("") for c in columns})


def resolved(path: Column, base: str) -> Column:
    return F.when(path.startswith("/") | (path == ""), path).otherwise(F.concat_ws("/", F.lit(base.rstrip("/")), path))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")


def padded(n: Column, width: int) -> Column:
    """n with leading zeros; longer numbers stay whole."""
    return F.when(F.length(n.cast("string")) < width, F.lpad(n.cast("string"), width, "0")).otherwise(n.cast("string"))


def audio_id(speaker: Column, path: Column, row: Column) -> Column:
    """speaker_stem, or speaker_rowNNNN where there is no path."""
    return F.concat(speaker, F.lit("_"), F.when(path == "", F.concat(F.lit("row"), padded(row, 4))).otherwise(stem(path)))


def ingest_reasons(found: Column | None = None, failed: Column | None = None) -> Column:
    """The first that holds: columns are missing, the file is missing, it can't be hashed (failed tells why, or null).
    Expects cleaned() columns."""
    empty = F.array_compact(F.array(*[F.when(F.col(c) == "", F.lit(c)) for c in REQUIRED]))
    rules = F.when(F.size(empty) > 0, F.array(F.concat(F.lit("missing_columns:"), F.array_join(empty, ","))))
    if found is not None:
        rules = rules.when(~F.coalesce(found, F.lit(False)), F.array(F.lit("audio_missing")))
    if failed is not None:
        rules = rules.when(failed.isNotNull(), F.array(F.concat(F.lit("hash_failed:"), failed)))
    return rules.otherwise(F.array().cast("array<string>"))


def qc_reasons(s: Settings, kind: Column, duration: Column, snr: Column, clip: Column, bw: Column, lufs: Column) -> Column:
    """Reasons by the thresholds of the recording type (those of podcasts for unknown types); none in smoke runs."""
    names = ("studio", "podcast", "interview", "field")

    def limit(name: str) -> Column:
        out = F.lit(float(s.get(f"qc.podcast.{name}")))
        for n in names:
            out = F.when(kind == n, F.lit(float(s.get(f"qc.{n}.{name}")))).otherwise(out)
        return out

    def text(prefix: str, name: str, whole: bool = False) -> Column:
        out = F.lit(prefix + str(float(s.get(f"qc.podcast.{name}"))))
        for n in names:
            out = F.when(kind == n, F.lit(prefix + str(float(s.get(f"qc.{n}.{name}"))))).otherwise(out)
        return out

    if s.get("qc.smoke_test"):
        return F.array().cast("array<string>")
    lo, hi = map(float, s.get("qc.lufs"))
    least = float(s.get("qc.min_duration_sec"))
    return reasons(
        (duration < least, f"duration<{least}"), (snr < limit("min_snr_db"), text("snr<", "min_snr_db")), (clip > limit("max_clipping_ratio"), text("clipping>", "max_clipping_ratio")),
        (bw < limit("min_bw_hz"), text("effective_bw<", "min_bw_hz")), ((lufs < lo) | (lufs > hi), f"lufs_out_of_range[{lo},{hi}]"))


def segment_ids(df: DataFrame, label: str, source: str, order: list[str], width: int, tag: str) -> Column:
    """label_source_tagNNN, counted per source from 1 over all its segments."""
    n = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return F.concat_ws("_", F.col(label), F.col(source), F.concat(F.lit(tag), padded(n, width)))
