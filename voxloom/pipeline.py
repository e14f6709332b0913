"""Curation steps by name: each takes a DataFrame and gives one, so that any run of them is one lazy plan.

What a model or service would do is a hook of Backends: how a file is read, speech found, speakers told apart, speech
turned into text, text aligned, windows embedded, clips judged, pitch tracked. Each has a deterministic stand-in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from .config import Settings
from .functions import signal as G
from .functions.text import cer, normalized, proportional_slice
from .operators import audio, coarse, ingest as N, pitch, rate, report, scoring, segment, speaker, splits
from .operators.dedup import dedup
from .session import stored

#: Fixed value: the text of a segment for which there is none.
PLACEHOLDER = "测试音频片段一二三"
#: Fixed value: an error rate above which a text is to be reviewed.
REVIEW = 0.08


def stand_in_windows(size: float, hop: float) -> Callable:
    """Embeddings of windows that depend on nothing but a name's hash: one speaker's are near one another."""

    def work(slices: list[tuple]) -> list:
        out = []
        for x, rate_, name in slices:
            utt, _, label = name.partition("\t")
            mean = _seeded(label).uniform(-1, 1, 32)
            n = int((len(x) / rate_ - size) / hop + 1e-9) + 1 if len(x) / rate_ >= size else 0
            v = [mean + _seeded(f"{utt}::w{i}").normal(0, 0.05, 32) for i in range(n)]
            out.append([(w / np.linalg.norm(w)).tolist() for w in v])
        return out

    return work


def _seeded(name: str) -> np.random.Generator:
    return np.random.default_rng(int(hashlib.sha256(name.encode()).hexdigest()[:8], 16))


@dataclass(frozen=True)
class Backends:
    """Hooks of the steps. Functions of slices take a list of (samples, rate, text) and give a list as long."""

    load: audio.Load = audio.local_file
    find_speech: Callable = G.speech_spans
    track_pitch: Callable = G.pitch_track
    #: recordings (audio_id, audio_align_path, ...) to turns (audio_id, start, end, label); none: one speaker each.
    diarize: Callable[[DataFrame], DataFrame] | None = None
    transcribe: Callable[[list], list[str]] | None = None
    #: characters {char, start, end, confidence}, times counted from the slice's beginning.
    align: Callable[[list], list] | None = None
    embed: Callable[[list], list] | None = None
    judge: Callable[[list], list[float]] | None = None
    folder: str = "work"
    #: The ingest table, for transcripts of segments that don't name theirs.
    ingest: DataFrame | None = None


Step = Callable[[DataFrame, Settings, Backends], DataFrame]
STEPS: dict[str, Step] = {}


def step(name: str) -> Callable[[Step], Step]:
    def add(f: Step) -> Step:
        STEPS[name] = f
        return f

    return add


def alive(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows still in play, and rejected ones, which pass every step untouched."""
    gone = scoring.rejected()
    return df.where(~gone), df.where(gone)


def marked(df: DataFrame, why: Column, passed: str | None = "passed") -> DataFrame:
    """df with more reject reasons (an array, or a text of one, or null) and the status they make."""
    kind = df.select(why.alias("w")).schema["w"].dataType
    new = F.when(why.isNotNull(), F.array(why)).otherwise(F.array().cast("array<string>")) if isinstance(kind, StringType) else F.coalesce(why, F.array().cast("array<string>"))
    rows = df.withColumn("_new", new)
    old = F.coalesce("reject_reasons", F.array().cast("array<string>")) if "reject_reasons" in df.columns else F.array().cast("array<string>")
    status = F.col("status") if passed is None and "status" in df.columns else F.lit(passed)
    return rows.withColumns({"status": F.when(F.size("_new") > 0, "rejected").otherwise(status), "reject_reasons": F.concat(old, "_new")}).drop("_new")


def manual_texts(paths: DataFrame, load: audio.Load) -> DataFrame:
    """(audio_id, manual) of (audio_id, transcript_path); one path each, the least; unreadable ones have none."""
    @F.pandas_udf("string")
    def read(path: pd.Series) -> pd.Series:
        out = []
        for p in path:
            try:
                out.append(load(p).decode("utf-8").strip())
            except Exception:
                out.append(None)
        return pd.Series(out)

    one = paths.where("audio_id IS NOT NULL AND transcript_path <> ''").groupBy("audio_id").agg(F.min("transcript_path").alias("_t"))
    return one.select("audio_id", read("_t").alias("manual"))


def with_transcripts(segments: DataFrame, ingest: DataFrame | None) -> DataFrame:
    """segments with transcript_path, their own or that of their recording in the ingest table."""
    rows = segments if "transcript_path" in segments.columns else segments.withColumn("transcript_path", F.lit(None).cast("string"))
    if ingest is None:
        return rows
    known = ingest.where("transcript_path <> ''").groupBy(F.col("audio_id").alias("source_audio_id")).agg(F.min("transcript_path").alias("_known"))
    return rows.join(known, "source_audio_id", "left").withColumn("transcript_path", F.coalesce(F.nullif("transcript_path", F.lit("")), "_known")).drop("_known")


def asr_reasons(duration: Column, found: Column, s: Settings) -> Column:
    """Why a segment isn't turned into text: it is too long, or its audio is missing."""
    most = float(s.get("asr.max_input_sec"))
    return F.when(duration > most, f"asr_duration_gt_{most}").when(~found, "asr_align_audio_missing")


def align_reasons(text: Column, chars: Column) -> Column:
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "align_empty_text").when(F.coalesce(F.size(chars), F.lit(0)) <= 0, "align_no_chars")


def mos_reason(mos: Column, s: Settings) -> Column:
    """Compared before it is rounded."""
    least = float(s.get("mos.min_mos"))
    return F.when(mos < least, f"mos<{least}")


def window_starts(duration: Column, s: Settings) -> Column:
    """Where the windows of a clip begin, in seconds."""
    size, hop = float(s.get("speaker.window_sec")), float(s.get("speaker.hop_sec"))
    n = F.floor((duration - size) / hop).cast("int") + 1
    return F.when((duration > 0) & (n > 0), F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i * hop)).otherwise(F.array().cast("array<double>"))


@step("ingest")
def ingest(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    rows = N.cleaned(df, (*N.REQUIRED, "transcript_path"))
    row = F.col("row") if "row" in df.columns else F.lit(0)
    rows = rows.withColumn("audio_id", N.audio_id(F.col("speaker_id"), F.col("audio_path"), row)).withColumn("_h", F.when(F.col("audio_path") != "", audio.hashed(b.load)("audio_path")))
    error = F.col("_h.error")
    why = N.ingest_reasons(F.coalesce(error != "missing", F.col("_h").isNotNull()), F.when(error != "missing", error))
    rows = rows.withColumns({"reject_reasons": why, "audio_hash": F.coalesce("_h.audio_hash", F.lit(""))}).drop("_h")
    return rows.withColumn("status", F.when(F.size("reject_reasons") > 0, "rejected").otherwise("passed"))


@step("audio_qc")
def audio_qc(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    rows = stored(good.withColumn("_m", audio.probed(b.load)("audio_path")))
    names = [n for n in G.MEASURES.names if n != "error"]
    rows = rows.select("*", *[F.col(f"_m.{n}").alias(n) for n in names], F.col("_m.error").alias("_error")).drop("_m")
    why = N.qc_reasons(s, F.col("recording_type"), F.col("duration_sec"), F.col("snr_db"), F.col("clipping_ratio"), F.col("effective_bw_hz"), F.col("lufs"))
    rows = marked(rows, F.when(F.col("_error").isNotNull(), F.array(F.concat(F.lit("read_failed:"), F.col("_error")))).otherwise(why))
    return rows.withColumn("qc_status", F.when(F.col("_error").isNull(), F.col("status"))).drop("_error").unionByName(bad, allowMissingColumns=True)


@step("resample")
def resample(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    rates = (int(s.get("resample.train_sr")), int(s.get("resample.align_sr")))
    # Stored, so that files are written by one job only.
    rows = stored(good.withColumn("_r", audio.resampled(b.folder, rates, b.load)("audio_path", "audio_id")))
    rows = rows.withColumns({"audio_train_path": F.col("_r.train"), "audio_align_path": F.col("_r.align"), "train_sr": F.lit(rates[0]), "align_sr": F.lit(rates[1])})
    return marked(rows, F.concat(F.lit("resample_failed:"), F.col("_r.error"))).drop("_r").unionByName(bad, allowMissingColumns=True)


QC = ("snr_db", "lufs", "peak_db", "clipping_ratio", "effective_bw_hz", "native_sr")


@step("vad_coarse")
def vad_coarse(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    """Rejected recordings, and those that can't be read, have no segments."""
    good, _ = alive(df)
    paths = {f"audio_{k}_path": F.coalesce(*[c for c in (f"audio_{k}_path", "audio_path") if c in df.columns]) for k in ("align", "train")}
    rows = good.withColumns(paths).withColumn("_v", audio.speech_of(b.load, b.find_speech)("audio_align_path"))
    rows = stored(rows.withColumns({"total": F.col("_v.total"), "_spans": F.col("_v.spans")}).drop("_v").where("total > 0"))
    spans = rows.select("audio_id", F.explode("_spans").alias("_s")).select("audio_id", "_s.start", "_s.end")
    turns = b.diarize(rows) if b.diarize else None
    out = coarse.coarse_segments(rows.select("audio_id", "speaker_id", "total"), spans, turns, s)
    own = rows.select(F.col("audio_id").alias("source_audio_id"), "audio_align_path", "audio_train_path", F.col("total").alias("source_duration"), *[c for c in (*QC, "transcript_path", "language", "domain", "recording_type") if c in rows.columns])
    return out.join(own, "source_audio_id")


@step("asr")
def asr(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    rows = with_transcripts(df, b.ingest)
    good, bad = alive(rows)
    texts = manual_texts(rows.select(F.col("source_audio_id").alias("audio_id"), "transcript_path"), b.load).withColumnRenamed("audio_id", "source_audio_id")
    sliced = proportional_slice(F.col("manual"), F.greatest(F.col("start"), F.lit(0.0)), F.greatest(F.col("end"), F.lit(0.0)), F.col("source_duration"))
    plain = F.coalesce(F.nullif(sliced, F.lit("")), F.lit(PLACEHOLDER))
    good = good.join(texts, "source_audio_id", "left").withColumn("_plain", plain)
    if b.transcribe:
        heard = audio.on_slices("string", b.transcribe, b.load)("audio_align_path", "start", "end", F.lit(""))
        good = stored(good.withColumn("_a", heard)).withColumns({"_found": F.coalesce(F.col("_a.error") != "missing", F.lit(True)), "_text": F.coalesce(F.trim("_a.value"), "_plain")}).drop("_a")
    else:
        good = good.withColumns({"_found": F.coalesce(F.col("audio_align_path") != "", F.lit(False)), "_text": F.col("_plain")})
    why = asr_reasons(F.col("duration"), F.col("_found"), s)
    good = marked(good.withColumn("asr_text", F.when(why.isNull(), F.col("_text"))), why).drop("manual", "_plain", "_found", "_text")
    return good.unionByName(bad, allowMissingColumns=True)


@step("text_normalize")
def text_normalize(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    rows = with_transcripts(df, None)
    texts = manual_texts(rows.select(F.col("source_audio_id").alias("audio_id"), "transcript_path"), b.load).withColumnRenamed("audio_id", "source_audio_id")
    ends = rows.groupBy("source_audio_id").agg(F.max("end").alias("_last"))
    rows = rows.join(texts, "source_audio_id", "left").join(ends, "source_audio_id", "left")
    cut = F.nullif(proportional_slice(F.col("manual"), F.col("start"), F.col("end"), F.col("_last")), F.lit(""))
    rows = rows.withColumn("manual_text", F.when(F.col("_last") > 0, cut)).withColumn("text_normalized", normalized(F.coalesce("manual_text", "asr_text", F.lit(""))))
    rows = rows.withColumn("cer_vs_manual", F.when((F.col("manual_text") != "") & (F.col("asr_text") != ""), cer(F.col("manual_text"), F.col("asr_text"))))
    return rows.withColumn("status", F.when((F.col("cer_vs_manual") > REVIEW) & ~scoring.rejected(), "review").otherwise(F.col("status"))).drop("manual", "_last")


@step("align")
def align(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    text = F.col("text_normalized")
    if b.align:
        at = audio.on_slices(rate.CHARS, b.align, b.load)("audio_align_path", "start", "end", "text_normalized")
        good = stored(good.withColumn("_a", at))
        absolute = F.transform("_a.value", lambda c: F.struct(c["char"].alias("char"), (c["start"] + F.col("start")).alias("start"), (c["end"] + F.col("start")).alias("end"), F.coalesce(c["confidence"], F.lit(0.9)).alias("confidence")))
        good = good.withColumn("chars", F.coalesce(absolute, rate.even_chars(text, F.col("start"), F.col("end")))).drop("_a")
    else:
        good = good.withColumn("chars", rate.even_chars(text, F.col("start"), F.col("end")))
    good = good.withColumn("chars", rate.shifted(F.col("chars"), float(s.get("align.latency_offset_ms")) / 1000, F.col("start"), F.col("end")))
    shown = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: F.trim(c) != ""))
    good = good.withColumns(rate.alignment_quality(F.coalesce("chars", F.array().cast(rate.CHARS)), shown, F.col("start"), F.col("end"), float(s.get("align.min_char_confidence"))))
    good = good.withColumns({"text_audio_duration_ratio": F.col("align_coverage"), "n_chars": shown})
    return marked(good, align_reasons(text, F.col("chars")), None).unionByName(bad, allowMissingColumns=True)


@step("fine_segment")
def fine_segment(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    return segment.utterances(df, "chars", s)


@step("mos")
def mos(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    if b.judge:
        heard = audio.on_slices("double", b.judge, b.load)("audio_align_path", "start", "end", F.lit(""))
        good = stored(good.withColumn("_m", F.coalesce(heard["value"], F.lit(0.0))))
    else:
        good = good.withColumn("_m", F.lit(5.0))
    good = good.withColumns({"mos_score": F.round("_m", 3), "mos_threshold": F.lit(float(s.get("mos.min_mos")))})
    return marked(good, mos_reason(F.col("_m"), s), None).drop("_m").unionByName(bad, allowMissingColumns=True)


@step("spk_consistency")
def spk_consistency(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    embed = b.embed or stand_in_windows(float(s.get("speaker.window_sec")), float(s.get("speaker.hop_sec")))
    label = F.coalesce("speaker_label", F.lit("spk"))
    vectors = audio.on_slices("array<array<float>>", embed, b.load)("audio_align_path", "start", "end", F.concat_ws("\t", "utt_id", label))
    rows = stored(good.select("utt_id", label.alias("label"), vectors["value"].alias("v")))
    windows = rows.select("utt_id", "label", F.posexplode("v").alias("w", "embedding"))
    per = speaker.consistency(windows, "utt_id", "w", "label", "embedding", s).groupBy("utt_id").agg(*[F.first(c).alias(c) for c in ("n_windows", "silhouette", "max_dist_to_center", "max_neighbor_delta", "ref_outlier_ratio", "reasons")])
    out = good.join(per, "utt_id", "left")
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("max_dist_to_center", "max_neighbor_delta", "silhouette", "ref_outlier_ratio")}
    why = F.coalesce("reasons", F.array(F.lit("spk_too_few_windows")))
    found = F.struct((F.size(why) == 0).alias("passed"), F.coalesce(F.col("n_windows").cast("int"), F.lit(0)).alias("n_windows"), zero["max_dist_to_center"].alias("max_dist_to_center"), zero["max_neighbor_delta"].alias("max_neighbor_delta"), zero["silhouette"].alias("cluster_silhouette"), F.lit(0.0).alias("overlap_ratio"), zero["ref_outlier_ratio"].alias("ref_outlier_ratio"))
    out = marked(out.withColumn("spk_consistency", found), why, None).drop("n_windows", *zero, "reasons")
    return out.unionByName(bad, allowMissingColumns=True)


@step("f0")
def f0(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    """Pitch in two passes: all tracks in the general range, then each narrowed to its speaker's own around the median."""
    good, bad = alive(df)
    low, high, hop = (float(s.get(f"f0.{k}")) for k in ("f0_min", "f0_max", "frame_hop_ms"))
    path = F.coalesce(*[c for c in ("wav", "audio_align_path") if c in df.columns])
    tracks = audio.pitch_of(low, high, hop, b.load, b.track_pitch)(path)
    rows = stored(good.select("utt_id", "speaker_id", tracks.alias("t")))
    voiced = rows.select("speaker_id", F.explode("t.f0").alias("hz")).where("hz > 0")
    median = pitch.speaker_medians(voiced.withColumn("speaker_id", F.coalesce("speaker_id", F.lit(""))), "speaker_id", "hz")
    rows = rows.withColumn("speaker_id", F.coalesce("speaker_id", F.lit(""))).join(median, "speaker_id", "left")
    m = F.coalesce("speaker_median_f0_hz", F.lit(0.0))
    a, z = F.when(m > 0, F.greatest(F.lit(low), m * float(s.get("f0.factor_low")))).otherwise(low), F.when(m > 0, F.least(F.lit(high), m * float(s.get("f0.factor_high")))).otherwise(high)
    rows = stored(rows.where("t.f0 IS NOT NULL").select("utt_id", m.alias("speaker_median_f0_hz"), audio.reclamped(F.col("t.f0"), a, z).alias("f0_track"), F.col("t.confidence").alias("c")))
    frames = rows.select("utt_id", "speaker_median_f0_hz", F.posexplode(F.arrays_zip(F.col("f0_track").alias("hz"), F.col("c").alias("conf"))).alias("i", "x")).select("utt_id", "speaker_median_f0_hz", "i", "x.hz", "x.conf")
    per = pitch.pitch_stats(frames, "utt_id", "i", "hz", "speaker_median_f0_hz", "conf")
    out = good.join(rows.drop("c"), "utt_id", "left").join(per, "utt_id", "left")
    return marked(out, F.when(F.col("f0_track").isNull(), "f0_io_error"), None).unionByName(bad, allowMissingColumns=True)


@step("rate")
def rate_metrics(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    return rate.with_rate(good, "chars", "duration", s).unionByName(bad, allowMissingColumns=True)


@step("filter_score")
def filter_score(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    # Read twice, once for the limits by speaker: stored, so that what precedes runs once.
    return scoring.scored(stored(df), s)


@step("split_dataset")
def split_dataset(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    good, bad = alive(df)
    # Of equally good copies an A or B goes before a C.
    ranked = good.where(F.col("grade").isin("A", "B", "C")).withColumn("_order", F.struct(F.col("grade") == "C", "utt_id"))
    kept = dedup(ranked, "utt_id", "speaker_id", "text", "quality_score", "_order", str(s.get("split.dedup_threshold"))).drop("_order")
    rest = good.where(F.coalesce(~F.col("grade").isin("A", "B", "C"), F.lit(True)))
    return splits.projected(splits.routed(stored(kept.unionByName(rest).unionByName(bad)), s))


@step("report")
def report_step(df: DataFrame, s: Settings, b: Backends) -> DataFrame:
    """The speakers' statistics; report.write_report() writes the page and tables."""
    return report.speaker_stats(df)


def run(df: DataFrame, s: Settings, first: str | int | None = None, last: str | int | None = None, backends: Backends | None = None) -> DataFrame:
    """Steps from first to last, by name or by number from 1."""
    names, b = list(STEPS), backends or Backends()

    def place(x: Any, otherwise: int) -> int:
        return otherwise if x is None else x - 1 if isinstance(x, int) else names.index(x)

    for name in names[place(first, 0) : place(last, len(names) - 1) + 1]:
        df = STEPS[name](df, s, b)
    return df
