"""Queries of the steps' predicates, joins and ids over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import pipeline as P
from ..config import profile
from ..operators import coarse, corpus, diarization, ingest as N, rate as R, report
from .tables import Registry, table

REGISTRY = Registry()
query = REGISTRY.query
S0 = profile("conversation")
SEG = 'SELECT DISTINCT seg_id, source_audio_id, "start" AS s, "end" AS e, "end" - "start" AS d FROM vad_coarse WHERE "start" IS NOT NULL AND "end" > "start" AND seg_id IS NOT NULL AND source_audio_id IS NOT NULL'


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "vad_coarse").where("`start` IS NOT NULL AND `end` > `start` AND seg_id IS NOT NULL AND source_audio_id IS NOT NULL")
    return rows.select("seg_id", "source_audio_id", "start", "end", (F.col("end") - F.col("start")).alias("d")).distinct()


@query("transcript_join", f"""WITH seg AS ({SEG}), i AS (SELECT audio_id, min(transcript_path) AS t FROM ingest WHERE transcript_path <> '' GROUP BY 1)
 SELECT DISTINCT seg_id, source_audio_id, t AS transcript_path FROM seg LEFT JOIN i ON audio_id = source_audio_id""")
def transcript_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _segments(spark, folder).select("seg_id", "source_audio_id").distinct()
    return P.with_transcripts(rows, table(spark, folder, "ingest")).select("seg_id", "source_audio_id", "transcript_path")


@query("asr_reasons", f"""WITH seg AS ({SEG}), a AS (SELECT seg_id, max(asr_text) AS t FROM asr GROUP BY 1)
 SELECT seg_id, round(d, 6) AS d, CASE WHEN d > 30 THEN 'asr_duration_gt_30.0' WHEN t IS NULL THEN 'asr_align_audio_missing' END AS reason FROM seg LEFT JOIN a USING (seg_id)""")
def asr_reasons(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "asr").groupBy("seg_id").agg(F.max("asr_text").alias("t"))
    rows = _segments(spark, folder).join(texts, "seg_id", "left")
    return rows.select("seg_id", F.round("d", 6).alias("d"), P.asr_reasons(F.col("d"), F.col("t").isNotNull(), S0).alias("reason"))


@query("align_reasons", """WITH x AS (SELECT DISTINCT seg_id, text_normalized AS t, "start" AS s, "end" AS e FROM text_normalize)
 SELECT seg_id, t AS text, CASE WHEN trim(coalesce(t, '')) = '' THEN 'align_empty_text' WHEN s IS NULL OR e IS NULL THEN 'align_no_chars' END AS reason FROM x""")
def align_reasons(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "text_normalize").select("seg_id", "text_normalized", "start", "end").distinct()
    chars = R.even_chars(F.col("text_normalized"), F.col("start"), F.col("end"))
    return rows.select("seg_id", F.col("text_normalized").alias("text"), P.align_reasons(F.col("text_normalized"), chars).alias("reason"))


@query("mos_reasons", "SELECT DISTINCT utt_id, round(mos_score, 3) AS mos, CASE WHEN mos_score < 4 THEN 'mos<4.0' END AS reason FROM filter_score")
def mos_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "filter_score").select("utt_id", F.round("mos_score", 3).alias("mos"), P.mos_reason(F.col("mos_score"), S0).alias("reason")).distinct()


@query("short_segments", f"""SELECT seg_id, round(d, 6) AS d, CASE WHEN d < 3 THEN 'seg_too_short' ELSE '' END AS why FROM ({SEG})""")
def short_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segments(spark, folder).select("seg_id", F.round("d", 6).alias("d"), F.array_join(coarse.too_short(F.col("d"), S0), ";").alias("why"))


@query("segment_windows", """WITH u AS (SELECT DISTINCT utt_id, duration AS d FROM fine_segment WHERE utt_id IS NOT NULL AND duration IS NOT NULL)
 SELECT utt_id, i AS w, 0.25::DOUBLE * i AS at FROM (SELECT utt_id, unnest(range(0, greatest(0, CASE WHEN d > 0 THEN floor((d - 1.5) / 0.25)::INT + 1 ELSE 0 END))) AS i FROM u)""")
def segment_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fine_segment").where("utt_id IS NOT NULL AND duration IS NOT NULL").select("utt_id", "duration").distinct()
    return rows.select("utt_id", F.posexplode(P.window_starts(F.col("duration"), S0)).alias("w", "at")).select("utt_id", F.col("w").cast("long").alias("w"), "at")


@query("segment_ids", f"""WITH seg AS ({SEG}) SELECT seg_id, round(s, 6) AS s, 'spk_' || source_audio_id || '_seg' || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS made FROM (SELECT *, row_number() OVER (PARTITION BY source_audio_id ORDER BY s, e, seg_id) AS n FROM seg)""")
def segment_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _segments(spark, folder).withColumn("l", F.lit("spk"))
    return rows.select("seg_id", F.round("start", 6).alias("s"), N.segment_ids(rows, "l", "source_audio_id", ["start", "end", "seg_id"], 3, "seg").alias("made"))


@query("duration_band", "SELECT utt_id, count(*) AS n FROM fine_segment WHERE duration BETWEEN 3 AND 20 GROUP BY 1")
def duration_band(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.duration_band(table(spark, folder, "fine_segment"), "duration").groupBy("utt_id").agg(F.count("*").alias("n"))


@query("speakers_with_enough", "SELECT speaker_id, count(*) AS n FROM fine_segment WHERE speaker_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 20")
def speakers_with_enough(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.with_enough(table(spark, folder, "fine_segment").where("speaker_id IS NOT NULL"), "speaker_id", 20).groupBy("speaker_id").agg(F.count("*").alias("n"))


@query("stem_join", """WITH w AS (SELECT DISTINCT regexp_replace(regexp_replace(wav, '^.*/', ''), '(.)\\.[^.]*$', '\\1') AS stem FROM manifests WHERE wav <> ''), t AS (SELECT utt_id AS stem, min(text) AS text FROM fine_segment WHERE speaker_label = 'SPEAKER_00' GROUP BY 1),
 a AS (SELECT DISTINCT regexp_replace(utt_id, '_S[^_]*$', '') AS stem FROM manifests WHERE split = 'train') SELECT stem, text FROM w JOIN t USING (stem) JOIN a USING (stem)""")
def stem_join(spark: SparkSession, folder: str) -> DataFrame:
    audio = table(spark, folder, "manifests").where("wav <> ''").select(N.stem(F.col("wav")).alias("stem")).distinct()
    texts = table(spark, folder, "fine_segment").where("speaker_label = 'SPEAKER_00'").select(F.col("utt_id").alias("stem"), "text")
    allowed = table(spark, folder, "manifests").where("split = 'train'").select(corpus.episode(F.col("utt_id")).alias("episode"))
    return corpus.adapted(audio, texts, "inner", allowed).select("stem", "text")


@query("first_of_grade", """SELECT source_audio_id, utt_id FROM (SELECT source_audio_id, utt_id, row_number() OVER (PARTITION BY source_audio_id ORDER BY CASE WHEN grade = 'A' THEN 0 ELSE 1 END, utt_id) AS n FROM manifests WHERE source_audio_id IS NOT NULL AND utt_id IS NOT NULL) WHERE n = 1""")
def first_of_grade(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "manifests").where("source_audio_id IS NOT NULL AND utt_id IS NOT NULL")
    return corpus.first_of(rows, ["source_audio_id"], F.col("grade") == "A", "utt_id").select("source_audio_id", "utt_id")


@query("label_at", f"""WITH seg AS ({SEG}), t AS (SELECT DISTINCT source_audio_id, "start" AS s, "end" AS e, speaker_label AS l FROM vad_coarse WHERE "end" > "start" AND speaker_label IS NOT NULL AND source_audio_id IS NOT NULL), p AS (SELECT DISTINCT source_audio_id, seg_id, min((s + e) / 2) AS m FROM seg GROUP BY 1, 2),
 h AS (SELECT p.source_audio_id, seg_id, l, row_number() OVER (PARTITION BY p.source_audio_id, seg_id ORDER BY s, e, l) AS n FROM p JOIN t ON p.source_audio_id = t.source_audio_id AND s <= m AND m < e) SELECT p.seg_id, p.source_audio_id, coalesce(l, 'none') AS label FROM p LEFT JOIN h ON h.seg_id = p.seg_id AND h.source_audio_id = p.source_audio_id AND n = 1""")
def label_at(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "vad_coarse").where("`end` > `start` AND speaker_label IS NOT NULL AND source_audio_id IS NOT NULL").select("source_audio_id", "start", "end", F.col("speaker_label").alias("label")).distinct()
    points = _segments(spark, folder).groupBy("source_audio_id", "seg_id").agg(F.min((F.col("start") + F.col("end")) / 2).alias("m"))
    return coarse.label_at(turns, points, ["source_audio_id"], "m", "seg_id", "none").select("seg_id", "source_audio_id", "label")


@query("meeting_match", """WITH h AS (SELECT DISTINCT CASE WHEN length(source_audio_id) % 2 = 0 THEN source_audio_id ELSE 'run1_' || source_audio_id END AS hyp_id FROM fine_segment WHERE source_audio_id IS NOT NULL), r AS (SELECT DISTINCT source_audio_id AS meeting_id FROM vad_coarse WHERE source_audio_id IS NOT NULL)
 SELECT hyp_id, min(meeting_id) AS meeting_id FROM h JOIN r ON CASE WHEN hyp_id IN (SELECT meeting_id FROM r) THEN hyp_id = meeting_id ELSE ends_with(hyp_id, meeting_id) END GROUP BY 1""")
def meeting_match(spark: SparkSession, folder: str) -> DataFrame:
    ref = table(spark, folder, "vad_coarse").select(F.col("source_audio_id").alias("meeting_id"))
    ident = F.col("source_audio_id")
    hyp = table(spark, folder, "fine_segment").select(F.when(F.length(ident) % 2 == 0, ident).otherwise(F.concat(F.lit("run1_"), ident)).alias("meeting_id"))
    return diarization.matched_meetings(ref, hyp)


@query("grade_paths", """SELECT utt_id, wav AS wav_from, CASE WHEN starts_with(wav, 'tts_dataset') THEN 'export' || substr(wav, 12) ELSE wav END AS wav, count(*) AS n FROM manifests WHERE grade = 'A' GROUP BY 1, 2, 3""")
def grade_paths(spark: SparkSession, folder: str) -> DataFrame:
    return report.export_grade(table(spark, folder, "manifests"), "A", "tts_dataset", "export").groupBy("utt_id", "wav_from", "wav").agg(F.count("*").alias("n"))


@query("coarse_segments")
def coarse_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The recordings' segments as speech, their labels as speakers' turns, cut anew. Tested against one recording at a time."""
    rows = _segments(spark, folder).withColumnRenamed("source_audio_id", "audio_id")
    labels = table(spark, folder, "vad_coarse").groupBy("seg_id").agg(F.max("speaker_label").alias("label"), F.max("speaker_id").alias("speaker_id"))
    rows = rows.join(labels, "seg_id")
    records = rows.groupBy("audio_id").agg((F.max("end") + 1).alias("total"), F.max("speaker_id").alias("speaker_id"))
    return coarse.coarse_segments(records, rows, rows.select("audio_id", "start", "end", "label"), S0)


@query("diarization_errors")
def diarization_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Coarse segments as reference turns, utterances as hypothesis. Tested against all mappings."""
    ref = table(spark, folder, "vad_coarse").select(F.col("source_audio_id").alias("meeting_id"), F.col("speaker_label").alias("speaker"), "start", "end").distinct()
    hyp = table(spark, folder, "fine_segment").select(F.col("source_audio_id").alias("meeting_id"), F.col("speaker_label").alias("speaker"), "start", "end").distinct()
    out = diarization.diarization_errors(ref.where("meeting_id IS NOT NULL"), hyp.where("meeting_id IS NOT NULL"))
    return out.select("meeting_id", "n_ref", "n_hyp", *[F.round(c, 6).alias(c) for c in ("ref_sec", "missed", "false_alarm", "confusion", "der", "jer")])
