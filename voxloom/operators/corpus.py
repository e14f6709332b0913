"""Corpus preparation: clips joined into recordings, long recordings cut ahead, and seeded samples."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .ingest import padded


def seeded_order(ident: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), ident)


def sample_groups(df: DataFrame, group: str, ident: str, groups: int | None, rows: int | None, seed: int = 42) -> DataFrame:
    """At most so many groups, and rows of each, in the order of a seeded hash; the same whatever the partitions."""
    if groups is not None:
        some = df.select(group).where(F.col(group).isNotNull()).distinct().orderBy(seeded_order(F.col(group), seed), group).limit(groups)
        df = df.join(some, group, "left_semi")
    if rows is not None:
        n = F.row_number().over(Window.partitionBy(group).orderBy(seeded_order(F.col(ident), seed), ident))
        df = df.withColumn("_n", n).where(F.col("_n") <= rows).drop("_n")
    return df


def with_enough(df: DataFrame, group: str, least: int) -> DataFrame:
    """Rows of groups that have at least so many."""
    counts = df.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(group)
    return df.join(counts, group, "left_semi")


def joined_parts(clips: DataFrame, speaker: str, ident: str, duration: str, least: float = 45.0, most: float = 75.0, silence_ms: tuple[int, int] = (400, 900)) -> DataFrame:
    """(speaker, ident, part, offset): clips laid one behind the other, with pauses of random length, into parts.

    A part ends before the clip that would make it longer than most, once it has at least least seconds; until then it
    takes clips of any length. A last part below least is left out. Sequential per speaker, over ids and lengths
    only; pauses are seeded by the clip's id. Clips without a speaker or length are left out.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, part, at, held = [], 0, 0.0, []
        for row in pdf.sort_values("i").itertuples():
            if held and at + row.d > most and at >= least:
                out += held
                part, held, at = part + 1, [], 0.0
            if held:
                lo, hi = silence_ms
                at += (lo + int(hashlib.sha256(str(row.i).encode()).hexdigest()[:8], 16) % (hi - lo + 1)) / 1000
            held.append((row.s, row.i, part, at))
            at += row.d
        if at >= least:
            out += held
        return pd.DataFrame(out, columns=["s", "i", "part", "offset"])

    rows = clips.select(F.col(speaker).cast("string").alias("s"), F.col(ident).cast("string").alias("i"), F.col(duration).cast("double").alias("d")).where("d > 0 AND s IS NOT NULL")
    return rows.groupBy("s").applyInPandas(lambda p: run(p), "s string, i string, part int, offset double").withColumnsRenamed({"s": speaker, "i": ident})


def long_cuts(silences: list[tuple[float, float]], total: float, least: float, most: float, pause: float) -> list[tuple[float, float]]:
    """Pieces of a long recording, up to its end: each ends in the middle of the first silence of at least `pause` that begins
    from least to below most seconds on, else of the longest that does, else at most; a tail below one second belongs
    to the piece before.
    """
    points, at = [0.0], 0.0
    while at < total:
        window = [(a, b) for a, b in silences if at + least <= a < at + most]
        fit = [s for s in window if s[1] - s[0] >= pause]
        chosen = fit[0] if fit else max(window, key=lambda s: s[1] - s[0], default=None)
        at = min(at + most, total) if chosen is None else (chosen[0] + chosen[1]) / 2
        if at >= total - 1.0:
            break
        points.append(at)
    points.append(total)
    return list(zip(points, points[1:])) if total > 0 else []


CUTS = ArrayType(StructType([StructField("start", DoubleType()), StructField("end", DoubleType())]))


def cut_pieces(recordings: DataFrame, ident: str, path: str, speech: Column, total: Column, folder: str, least: float = 480.0, most: float = 600.0, pause: float = 0.6) -> DataFrame:
    """The offset table of long recordings cut ahead: (cut_id, source_audio_id, start, end, duration, out_path, audio_path).

    speech is an array of (start, end), the recording's speech in order; what it leaves free are the silences, and a
    recording without speech is one piece. cut_id is the id with _pNN from 00; the pieces' metadata are precut_metadata().
    """

    @F.pandas_udf(CUTS)
    def cuts(spans: pd.Series, length: pd.Series) -> pd.Series:
        out = []
        for x, n in zip(spans, length, strict=True):
            x = [(float(p["start"]), float(p["end"])) for p in x] if x is not None else []
            edges = [(a, b) for a, b in zip([0.0, *(e for _, e in x)], [*(s for s, _ in x), n]) if b > a] if x else []
            out.append([{"start": a, "end": b} for a, b in (long_cuts(edges, n, least, most, pause) if x else [(0.0, n)])])
        return pd.Series(out)

    rows = recordings.where(total > 0).select(F.col(ident).alias("source_audio_id"), F.col(path).alias("audio_path"), F.posexplode(cuts(speech, total)).alias("_i", "_c"))
    name = F.concat(F.col("source_audio_id"), F.lit("_p"), padded(F.col("_i"), 2))
    return rows.select(name.alias("cut_id"), "source_audio_id", "_c.start", "_c.end", (F.col("_c.end") - F.col("_c.start")).alias("duration"), F.concat(F.lit(folder.rstrip("/") + "/"), name, F.lit(".wav")).alias("out_path"), "audio_path")


def precut_metadata(pieces: DataFrame) -> DataFrame:
    """The pieces as an ingest table: conversations of several speakers, without transcripts."""
    fixed = {"speaker_id": "multi", "language": "zh", "domain": "conversation", "recording_type": "interview", "transcript_path": ""}
    return pieces.select(F.col("out_path").alias("audio_path"), *[F.lit(v).alias(k) for k, v in fixed.items()])


def first_of(df: DataFrame, keys: list[str], good: Column, ident: str) -> DataFrame:
    """(*keys, ident): per key the first row that is good, else the first of all, by ident."""
    rank = F.struct(F.coalesce(~good, F.lit(True)).alias("g"), F.col(ident).alias("i"))
    return df.groupBy(*keys).agg(F.min(rank)["i"].alias(ident))


def duration_band(df: DataFrame, duration: str, least: float = 3.0, most: float = 20.0) -> DataFrame:
    """Rows with a length from least to most seconds; unknown lengths are left out."""
    return df.where(F.col(duration).between(least, most))


def adapted(audio: DataFrame, texts: DataFrame, how: str, allowed: DataFrame | None = None) -> DataFrame:
    """audio (path, stem, ...) with the texts of the same stem, of the episodes in allowed (episode) if it is given.

    how is inner, or left for corpora of which some recordings have no text. Several texts of a stem fold to the least.
    """
    rows = audio.join(texts.groupBy("stem").agg(F.min("text").alias("text")), "stem", how)
    if allowed is not None:
        rows = rows.withColumn("episode", episode(F.col("stem"))).join(allowed.select("episode").distinct(), "episode", "left_semi")
    return rows


def episode(stem_: Column) -> Column:
    """Episode of an utterance: its stem without the last _S... part."""
    return F.regexp_replace(stem_, r"_S[^_]*$", "")


def synthetic_speech(seconds: float, base_hz: float, seed: int, rate: int = 24_000) -> np.ndarray:
    """Test signal: a wandering pitch with three harmonics, 0.4 s of silence every 3 s, and noise."""
    rng = np.random.default_rng(seed)
    t = np.arange(int(seconds * rate)) / rate
    phase = 2 * np.pi * np.cumsum(base_hz + 30 * np.sin(2 * np.pi * 0.3 * t) + rng.normal(0, 5, len(t))) / rate
    x = 0.3 * np.sin(phase) + 0.1 * np.sin(2 * phase) + 0.05 * np.sin(3 * phase)
    x[(t % 3.0 > 2.5) & (t % 3.0 < 2.9)] = 0
    return (x + rng.normal(0, 0.005, len(t))).astype(np.float32)
