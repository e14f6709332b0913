"""Recordings to coarse segments: cut at long silences and changes of speaker, kept below a longest length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Settings
from . import intervals as I
from .ingest import padded

KEY = ["audio_id"]


def coarse_segments(records: DataFrame, speech: DataFrame, turns: DataFrame | None, s: Settings) -> DataFrame:
    """(seg_id, source_audio_id, speaker_id, speaker_label, start, end, duration, diar_confidence, status, reject_reasons).

    records: audio_id, speaker_id, total, one row each; speech: audio_id, start, end; turns: audio_id, start, end, label, or
    None, when each recording is its speaker's. Cut points are the middles of long silences, and changes of
    label, moved to such a middle where one is near. What is longer than the longest is cut at silence middles too,
    or hard. A segment is split where its turns change; what no turn covers is left out. A recording with
    turns but without speech is cut by its turns alone; one without length, or with a null id, has no segments.
    """
    records = records.where("audio_id IS NOT NULL AND total > 0")
    mids = I.long_silence_middles(I.silences(speech, KEY, "start", "end", records.select("audio_id", "total"), "total"), KEY, s.get("vad.min_silence_ms")).select(*KEY, "mid")
    plain = records.select("audio_id", F.lit(0.0).alias("start"), F.col("total").alias("end"), "speaker_id", F.lit(1.0).alias("conf"))
    named = plain.withColumn("label", F.col("speaker_id"))
    if turns is not None:
        known = turns.where("audio_id IS NOT NULL AND label IS NOT NULL").join(records.select("audio_id", "speaker_id"), "audio_id")
        known = known.withColumn("label", I.renamed_labels(known, KEY, "label", F.col("speaker_id"))).select("audio_id", "start", "end", "speaker_id", F.lit(float(s.get("vad.min_diar_confidence"))).alias("conf"), "label")
        named = known.unionByName(named.join(known.select("audio_id"), "audio_id", "left_anti"))
    named = named.withColumn("turn", F.row_number().over(Window.partitionBy(*KEY).orderBy("start", "end", "label")))
    changes = I.turn_boundaries(named, KEY, "start", "label", ["turn"]).select(*KEY, "turn", "start")
    snapped = I.nearest(changes, KEY, "start", "turn", mids, "mid", s.get("vad.snap_ms") / 1000).select(*KEY, F.col("snapped").alias("mid"))
    spans = I.cut_spans(mids.unionByName(snapped), KEY, "mid", records, "total")
    longest = float(s.get("vad.max_segment_sec"))
    # A recording's silences are bounded by its length; they meet its spans as one list.
    lists = spans.join(mids.groupBy(*KEY).agg(F.array_sort(F.collect_list("mid")).alias("_m")), KEY, "left")
    inside = F.filter(F.coalesce("_m", F.array().cast("array<double>")), lambda m: (m > F.col("start")) & (m < F.col("end")))
    cuts = F.when(F.col("end") - F.col("start") > longest, I.forced_cuts(F.col("start"), F.col("end"), inside, longest)).otherwise(F.array().cast("array<double>"))
    edges = lists.withColumn("_e", F.concat(F.array("start"), cuts, F.array("end"))).select(*KEY, "_e")
    pieces = edges.select(*KEY, F.explode(F.zip_with(F.slice("_e", 1, F.size("_e") - 1), F.slice("_e", 2, F.size("_e") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("_p"))
    pieces = pieces.select(*KEY, F.col("_p.a").alias("a_id"), F.col("_p.a").alias("a_start"), F.col("_p.b").alias("a_end"))
    own = named.select(*KEY, F.col("turn").alias("b_id"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    chunks = I.overlapping(pieces, own, KEY, longest).join(named.select(*KEY, F.col("turn").alias("b_id"), "label", "conf", "speaker_id"), [*KEY, "b_id"])
    runs = I.label_runs(chunks, [*KEY, "a_id", "conf", "speaker_id"], "start", "end", "label", ["b_id"])
    return numbered(runs, s)


def numbered(runs: DataFrame, s: Settings) -> DataFrame:
    """Segments with ids counted per recording, and the short ones marked."""
    n = F.row_number().over(Window.partitionBy("audio_id").orderBy("a_id", "start", "label"))
    name = F.concat_ws("_", F.col("label"), F.col("audio_id"), F.concat(F.lit("seg"), padded(n, 3)))
    rows = runs.select(name.alias("seg_id"), F.col("audio_id").alias("source_audio_id"), "speaker_id", F.col("label").alias("speaker_label"), "start", "end", (F.col("end") - F.col("start")).alias("duration"), F.col("conf").alias("diar_confidence"))
    why = too_short(F.col("duration"), s)
    return rows.withColumn("reject_reasons", why).withColumn("status", F.when(F.size("reject_reasons") > 0, "rejected").otherwise("passed"))


def too_short(duration: Column, s: Settings) -> Column:
    return F.when(duration < s.get("vad.min_segment_sec"), F.array(F.lit("seg_too_short"))).otherwise(F.array().cast("array<string>"))


def label_at(turns: DataFrame, points: DataFrame, keys: list[str], point: str, ident: str, default: str, bucket: float = 30.0) -> DataFrame:
    """points with `label`: that of the first turn (start, end, label) that holds the point, else default."""
    t = turns.where("`end` > `start`").select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("label").alias("_l"), F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket))).alias("_b"))
    hit = points.withColumn("_b", F.floor(F.col(point) / bucket)).join(t, [*keys, "_b"]).where((F.col("_s") <= F.col(point)) & (F.col(point) < F.col("_e")))
    best = hit.groupBy(*keys, ident).agg(F.min(F.struct("_s", "_e", "_l"))["_l"].alias("label"))
    return points.join(best, [*keys, ident], "left").withColumn("label", F.coalesce("label", F.lit(default)))
