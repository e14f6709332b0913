"""Queries of the curation steps over the test tables, with SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..config import profile
from ..functions import scores as S
from ..functions.text import cer, grams, jaccard, normalized, proportional_slice, short_hash
from ..operators import ingest as G, intervals as I, rate as R, report as P, scoring as C, speaker as V, splits as L
from ..operators.dedup import dedup, similar_pairs
from ..operators.pitch import pitch_stats, speaker_medians
from .tables import Registry, table

REGISTRY = Registry()
query = REGISTRY.query
S0 = profile("conversation")
KEYS = ["source_audio_id"]


def _speech(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct coarse segments with usable bounds."""
    vad = table(spark, folder, "vad_coarse").where("`start` IS NOT NULL AND `end` > `start` AND NOT isnan(`end`) AND source_audio_id IS NOT NULL AND seg_id IS NOT NULL")
    return vad.groupBy("seg_id", "source_audio_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("speaker_label").alias("speaker_label"), F.max("speaker_id").alias("speaker_id"), F.max("snr_db").alias("snr_db"), F.max("lufs").alias("lufs"))


SPEECH = """sp AS (SELECT seg_id, source_audio_id, min("start") AS s, max("end") AS e, max(speaker_label) AS speaker_label, max(speaker_id) AS speaker_id, max(snr_db) AS snr_db, max(lufs) AS lufs
  FROM vad_coarse WHERE "start" IS NOT NULL AND "end" > "start" AND NOT isnan("end") AND source_audio_id IS NOT NULL AND seg_id IS NOT NULL GROUP BY seg_id, source_audio_id)"""


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg((F.max("end") + 1).alias("total"))


TOTALS = "tot AS (SELECT source_audio_id, max(e) + 1 AS total FROM sp GROUP BY source_audio_id)"


@query("ingest_validate", """SELECT audio_id, CASE WHEN w = '' THEN '' ELSE 'missing_columns:' || w END AS reason, sha AS path_hash FROM (
  SELECT DISTINCT audio_id, array_to_string(list_filter([CASE WHEN trim(coalesce(audio_path, '')) = '' THEN 'audio_path' END, CASE WHEN trim(coalesce(speaker_id, '')) = '' THEN 'speaker_id' END,
   CASE WHEN trim(coalesce("language", '')) = '' THEN 'language' END, CASE WHEN trim(coalesce(domain, '')) = '' THEN 'domain' END, CASE WHEN trim(coalesce(recording_type, '')) = '' THEN 'recording_type' END], lambda x: x IS NOT NULL), ',') AS w,
  substr(sha256(trim(coalesce(audio_path, ''))), 1, 16) AS sha FROM ingest)""")
def ingest_validate(spark: SparkSession, folder: str) -> DataFrame:
    rows = G.cleaned(table(spark, folder, "ingest"), G.REQUIRED).withColumn("r", G.ingest_reasons())
    return rows.select("audio_id", F.coalesce(F.get("r", F.lit(0)), F.lit("")).alias("reason"), short_hash("audio_path").alias("path_hash")).distinct()


@query("audio_ids", """SELECT DISTINCT audio_id, trim(coalesce(speaker_id, '')) || '_' || CASE WHEN trim(coalesce(audio_path, '')) = '' THEN 'row' || lpad((length(audio_id) * 777)::VARCHAR, greatest(4, length((length(audio_id) * 777)::VARCHAR))::INT, '0') ELSE regexp_replace(regexp_replace(trim(audio_path), '^.*/', ''), '\\.[^.]*$', '') END AS made_id FROM ingest""")
def audio_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = G.cleaned(table(spark, folder, "ingest"), G.REQUIRED)
    return rows.select("audio_id", G.audio_id(F.col("speaker_id"), F.col("audio_path"), F.length("audio_id") * 777).alias("made_id")).distinct()


@query("qc_threshold_reasons", f"""WITH {SPEECH}, ing AS (SELECT audio_id, max(recording_type) AS kind FROM ingest GROUP BY audio_id),
j AS (SELECT seg_id, s, e, snr_db, lufs, coalesce(kind, '') AS kind FROM sp LEFT JOIN ing ON audio_id = source_audio_id),
t AS (SELECT *, CASE kind WHEN 'studio' THEN 20.0 WHEN 'interview' THEN 8.0 WHEN 'field' THEN 8.0 ELSE 12.0 END AS least, CASE kind WHEN 'studio' THEN '0.001' WHEN 'field' THEN '0.01' ELSE '0.005' END AS clip,
 CASE kind WHEN 'studio' THEN '7500.0' WHEN 'interview' THEN '1000.0' ELSE '6000.0' END AS bw FROM j)
SELECT seg_id, array_to_string(list_filter([CASE WHEN e - s < 30 THEN 'duration<30.0' END, CASE WHEN snr_db < least::DOUBLE THEN 'snr<' || least::VARCHAR END, CASE WHEN s / 10000 > clip::DOUBLE THEN 'clipping>' || clip END, CASE WHEN e * 100 < bw::DOUBLE THEN 'effective_bw<' || bw END,
 CASE WHEN lufs < -45.0::DOUBLE OR lufs > -10.0::DOUBLE THEN 'lufs_out_of_range[-45.0,-10.0]' END], lambda x: x IS NOT NULL), ';') AS reasons FROM t""")
def qc_threshold_reasons(spark: SparkSession, folder: str) -> DataFrame:
    kinds = table(spark, folder, "ingest").groupBy(F.col("audio_id").alias("source_audio_id")).agg(F.max("recording_type").alias("kind"))
    rows = _speech(spark, folder).join(kinds, KEYS, "left")
    # The tables have no clipping and bandwidth of recordings: the bounds stand in, so that every rule meets both sides.
    why = G.qc_reasons(S0, F.coalesce("kind", F.lit("")), F.col("end") - F.col("start"), F.col("snr_db"), F.col("start") / 10000, F.col("end") * 100, F.col("lufs"))
    return rows.select("seg_id", F.array_join(why, ";").alias("reasons"))


SILENCE = f"""WITH {SPEECH}, {TOTALS}, u AS (SELECT source_audio_id, s, e FROM sp UNION ALL SELECT source_audio_id, total, total FROM tot),
 r AS (SELECT *, coalesce(max(e) OVER (PARTITION BY source_audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM u),
 sil AS (SELECT source_audio_id, reach AS a, s AS b FROM r WHERE s > reach)"""


@query("silence_intervals", SILENCE + ' SELECT source_audio_id, round(a, 6) AS "start", round(b, 6) AS "end" FROM sil')
def silence_intervals(spark: SparkSession, folder: str) -> DataFrame:
    sp = _speech(spark, folder)
    return I.silences(sp, KEYS, "start", "end", _totals(sp), "total").select(*KEYS, F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("label_boundaries", f"""WITH {SPEECH}, l AS (SELECT *, lag(speaker_label) OVER (PARTITION BY source_audio_id ORDER BY s, seg_id) AS p FROM sp)
 SELECT source_audio_id, seg_id, s AS "start", speaker_label FROM l WHERE p IS NOT NULL AND p <> speaker_label""")
def label_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    return I.turn_boundaries(_speech(spark, folder), KEYS, "start", "speaker_label", ["seg_id"]).select(*KEYS, "seg_id", "start", "speaker_label")


@query("label_runs", f"""WITH {SPEECH}, l AS (SELECT *, CASE WHEN lag(speaker_label) OVER w IS NOT DISTINCT FROM speaker_label AND abs(s - lag(e) OVER w) < 0.001::DOUBLE THEN 0 ELSE 1 END AS n FROM sp WINDOW w AS (PARTITION BY source_audio_id ORDER BY s, seg_id)),
 r AS (SELECT *, sum(n) OVER (PARTITION BY source_audio_id ORDER BY s, seg_id ROWS UNBOUNDED PRECEDING) AS run FROM l)
 SELECT source_audio_id, speaker_label, min(s) AS "start", max(e) AS "end", count(*) AS n FROM r GROUP BY source_audio_id, speaker_label, run""")
def label_runs(spark: SparkSession, folder: str) -> DataFrame:
    return I.label_runs(_speech(spark, folder), KEYS, "start", "end", "speaker_label", ["seg_id"])


@query("speaker_labels", f"""WITH {SPEECH}, k AS (SELECT *, dense_rank() OVER (PARTITION BY source_audio_id ORDER BY speaker_label) AS r, min(speaker_label) OVER (PARTITION BY source_audio_id) AS a, max(speaker_label) OVER (PARTITION BY source_audio_id) AS b FROM sp WHERE speaker_label IS NOT NULL)
 SELECT seg_id, CASE WHEN a <> b THEN speaker_id || '_' || chr((96 + r)::INT) ELSE speaker_id END AS label FROM k""")
def speaker_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _speech(spark, folder).where("speaker_label IS NOT NULL")
    return rows.select("seg_id", I.renamed_labels(rows, KEYS, "speaker_label", F.col("speaker_id")).alias("label"))


MIDS = SILENCE + ", mid AS (SELECT source_audio_id, (a + b) / 2 AS m FROM sil WHERE (b - a) * 1000 >= 500)"


@query("cut_points", MIDS + """, pt AS (SELECT source_audio_id, m AS p FROM mid UNION SELECT source_audio_id, 0.0::DOUBLE FROM tot UNION SELECT source_audio_id, total FROM tot),
 q AS (SELECT *, lead(p) OVER (PARTITION BY source_audio_id ORDER BY p) AS n FROM pt) SELECT source_audio_id, round(p, 6) AS "start", round(n, 6) AS "end" FROM q WHERE n - p > 0.000001::DOUBLE""")
def cut_points(spark: SparkSession, folder: str) -> DataFrame:
    sp = _speech(spark, folder)
    totals = _totals(sp)
    mids = I.long_silence_middles(I.silences(sp, KEYS, "start", "end", totals, "total"), KEYS, S0.get("vad.min_silence_ms"))
    return I.cut_spans(mids, KEYS, "mid", totals, "total").select(*KEYS, F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("nearest_silence", MIDS + """, d AS (SELECT sp.seg_id, sp.source_audio_id, sp.e, mid.m, row_number() OVER (PARTITION BY sp.seg_id, sp.source_audio_id ORDER BY abs(mid.m - sp.e), mid.m) AS rn FROM sp JOIN mid ON mid.source_audio_id = sp.source_audio_id AND abs(mid.m - sp.e) <= 0.5::DOUBLE)
 SELECT sp.seg_id, sp.source_audio_id, round(coalesce(d.m, sp.e), 6) AS snapped FROM sp LEFT JOIN d ON d.seg_id = sp.seg_id AND d.source_audio_id = sp.source_audio_id AND d.rn = 1""")
def nearest_silence(spark: SparkSession, folder: str) -> DataFrame:
    sp = _speech(spark, folder)
    mids = I.long_silence_middles(I.silences(sp, KEYS, "start", "end", _totals(sp), "total"), KEYS, S0.get("vad.min_silence_ms"))
    return I.nearest(sp, KEYS, "end", "seg_id", mids, "mid", 0.5).select("seg_id", *KEYS, F.round("snapped", 6).alias("snapped"))


@query("interval_overlap", f"""WITH {SPEECH}, u AS (SELECT utt_id, source_audio_id, min("start") AS s, max("end") AS e FROM fine_segment WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND utt_id IS NOT NULL GROUP BY utt_id, source_audio_id)
 SELECT u.source_audio_id, u.utt_id AS a_id, sp.seg_id AS b_id, greatest(u.s, sp.s) AS "start", least(u.e, sp.e) AS "end" FROM u JOIN sp ON u.source_audio_id = sp.source_audio_id AND greatest(u.s, sp.s) < least(u.e, sp.e) WHERE u.e > u.s""")
def interval_overlap(spark: SparkSession, folder: str) -> DataFrame:
    utt = table(spark, folder, "fine_segment").where("`start` IS NOT NULL AND `end` IS NOT NULL AND utt_id IS NOT NULL").groupBy(F.col("utt_id").alias("a_id"), *KEYS).agg(F.min("start").alias("a_start"), F.max("end").alias("a_end"))
    seg = _speech(spark, folder).select(F.col("seg_id").alias("b_id"), *KEYS, F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    return I.overlapping(utt, seg, KEYS, 30.0)


@query("force_cut", MIDS + """, w AS (WITH RECURSIVE k AS (SELECT source_audio_id, total, 0.0::DOUBLE AS cur, false AS is_cut FROM tot UNION ALL
  (SELECT k.source_audio_id, total, coalesce(max(m), cur + 30), true FROM k LEFT JOIN mid ON mid.source_audio_id = k.source_audio_id AND m > cur AND m <= cur + 30 WHERE total - cur > 30 GROUP BY k.source_audio_id, total, cur)) SELECT * FROM k)
 SELECT source_audio_id, round(cur, 6) AS cut FROM w WHERE is_cut""")
def force_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Speech of a recording as one segment, cut at silence middles so that no part is longer than the limit."""
    sp = _speech(spark, folder)
    totals = _totals(sp)
    mids = I.long_silence_middles(I.silences(sp, KEYS, "start", "end", totals, "total"), KEYS, S0.get("vad.min_silence_ms"))
    lists = totals.join(mids.groupBy(*KEYS).agg(F.array_sort(F.collect_list("mid")).alias("m")), KEYS, "left").withColumn("m", F.coalesce("m", F.array().cast("array<double>")))
    return lists.select(*KEYS, F.explode(I.forced_cuts(F.lit(0.0), F.col("total"), F.col("m"), S0.get("vad.max_segment_sec"))).alias("cut")).select(*KEYS, F.round("cut", 6).alias("cut"))


@query("text_normalize", r"""SELECT DISTINCT seg_id, trim(regexp_replace(regexp_replace(regexp_replace(translate(asr_text, ',.?!:;()[]', '，。？！：；（）［］'), '[\s\p{Z}\x{0b}\x{85}]+', ' ', 'g'), '([^\x00-\x7f]) ([^\x00-\x7f])', '\1\2', 'g'), '([^\x00-\x7f]) ([^\x00-\x7f])', '\1\2', 'g')) AS text FROM asr WHERE asr_text IS NOT NULL""")
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "asr").where("asr_text IS NOT NULL").select("seg_id", normalized("asr_text").alias("text")).distinct()


@query("proportional_slice", """WITH m AS (SELECT source_audio_id, max("end") AS total FROM text_normalize GROUP BY 1), x AS (SELECT DISTINCT t.seg_id, t.text_normalized AS x, t."start" AS s, t."end" AS e, m.total FROM text_normalize t JOIN m USING (source_audio_id) WHERE x IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL),
 p AS (SELECT *, greatest(0, least(length(x), round_even(length(x) * s / total, 0)))::INT AS a, greatest(0, least(length(x), round_even(length(x) * e / total, 0)))::INT AS b FROM x)
 SELECT seg_id, s AS "start", trim(substr(x, a + 1, greatest(b - a, 0))) AS part FROM p""")
def proportional_slices(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "text_normalize").withColumn("total", F.max("end").over(Window.partitionBy(*KEYS))).where("text_normalized IS NOT NULL AND `start` IS NOT NULL AND `end` IS NOT NULL AND source_audio_id IS NOT NULL")
    part = proportional_slice(F.col("text_normalized"), F.col("start"), F.col("end"), F.col("total"))
    return rows.select("seg_id", "start", "text_normalized", "end", "total", part.alias("part")).distinct().select("seg_id", "start", "part")


@query("cer_vs_manual")
def cer_vs_manual(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "text_normalize").where("manual_text IS NOT NULL AND text_normalized IS NOT NULL").select("seg_id", "manual_text", "text_normalized").distinct()
    return rows.select("seg_id", F.round(cer(F.col("manual_text"), F.col("text_normalized")), 6).alias("cer"))


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct utterances with deterministic characters that tile them."""
    rows = table(spark, folder, "fine_segment").where("`text` IS NOT NULL AND `start` IS NOT NULL AND `end` > `start` AND utt_id IS NOT NULL").select("utt_id", "text", "start", "end").distinct()
    return rows.withColumn("chars", R.even_chars(F.col("text"), F.col("start"), F.col("end"))).withColumn("duration", F.col("end") - F.col("start"))


RATE_SQL = """WITH u AS (SELECT DISTINCT utt_id, text, "start" AS s, "end" AS e FROM fine_segment WHERE text IS NOT NULL AND "start" IS NOT NULL AND "end" > "start" AND utt_id IS NOT NULL),
 c AS (SELECT utt_id, text, s, e, unnest(list_filter(string_split(text, ''), lambda x: x <> '' AND trim(x) <> '')) AS ch, generate_subscripts(list_filter(string_split(text, ''), lambda x: x <> '' AND trim(x) <> ''), 1) AS i FROM u),
 w AS (SELECT *, (1 + unicode(ch) % 7)::DOUBLE AS w FROM c), k AS (SELECT *, sum(w) OVER v AS upto, sum(w) OVER (PARTITION BY utt_id, text, s, e) AS total FROM w WINDOW v AS (PARTITION BY utt_id, text, s, e ORDER BY i ROWS UNBOUNDED PRECEDING)),
 b AS (SELECT *, s + (e - s) * (upto - w) / total AS a, s + (e - s) * upto / total AS z FROM k),
 g AS (SELECT *, lead(z, 5) OVER (PARTITION BY utt_id, text, s, e ORDER BY i) AS far FROM b),
 r AS (SELECT utt_id, text, s, e, count(*) AS n, sum(z - a) AS spoken, list(6.0::DOUBLE / (far - a)) FILTER (far IS NOT NULL AND (i - 1) % 3 = 0) AS rates, max(coalesce(gap, 0)) AS widest FROM (SELECT *, lead(a) OVER (PARTITION BY utt_id, text, s, e ORDER BY i) - z AS gap FROM g) GROUP BY utt_id, text, s, e),
 m AS (SELECT *, list_avg(rates) AS mu, list_stddev_pop(rates) AS sd, n < 12 OR coalesce(len(rates), 0) < 2 AS skip FROM r),
 rate AS (SELECT utt_id, text, n::INT AS n_chars, n / spoken AS cps, CASE WHEN skip THEN 0.0 ELSE sd / mu END AS cv, CASE WHEN skip THEN 0.0 ELSE mu END AS mean, CASE WHEN skip THEN 0.0 ELSE sd END AS std, CASE WHEN skip THEN 0.0 ELSE list_aggregate(rates, 'quantile_cont', 0.95) - list_aggregate(rates, 'quantile_cont', 0.05) END AS width,
  CASE WHEN widest > 0.2::DOUBLE THEN widest ELSE 0.0 END AS pause, (CASE WHEN widest > 0.5::DOUBLE THEN 1 ELSE 0 END)::INT AS long_pauses, skip FROM m)"""


@query("rate_metrics", RATE_SQL + " SELECT utt_id, n_chars, round(cps, 6) AS cps, round(cv, 6) AS cv, round(mean, 6) AS mean, round(std, 6) AS std, round(width, 6) AS width, round(pause, 6) AS pause_ratio, long_pauses AS long_pause_count, skip AS skipped FROM rate")
def rate_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.with_rate(_aligned(spark, folder).where("size(chars) > 0"), "chars", "duration", S0)
    names = {"cps": "global_rate_cps", "cv": "local_rate_cv", "mean": "local_rate_mean", "std": "local_rate_std", "width": "local_rate_p5_p95_range", "pause_ratio": "pause_ratio"}
    return rows.select("utt_id", "n_chars", *[F.round(c, 6).alias(n) for n, c in names.items()], "long_pause_count", F.col("local_rate_skipped").alias("skipped"))


def _curve(x: str, lo: float, hi: float, d: float) -> str:
    return f"greatest(0, least(1, least(({x} - {lo - d}::DOUBLE) / {d}::DOUBLE, ({hi + d}::DOUBLE - {x}) / {d}::DOUBLE)))"


@query("rate_grades", RATE_SQL + f""", sc AS (SELECT round(CASE WHEN skip THEN {_curve('cps', 4.0, 7.5, 2.0)} ELSE 0.5 * ({_curve('cps', 4.0, 7.5, 2.0)} + {_curve('cv', 0.12, 0.45, 0.2)}) END, 9) AS x FROM rate)
 SELECT CASE WHEN x >= 0.85 THEN 'A' WHEN x >= 0.75 THEN 'B' WHEN x >= 0.6 THEN 'C' ELSE 'D' END AS grade, count(*) AS n FROM sc GROUP BY 1""")
def rate_grades(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: alignments to rates to rate scores to grade counts, in one stage of column arithmetic and one small count."""
    rows = R.with_rate(_aligned(spark, folder).where("size(chars) > 0"), "chars", "duration", S0)
    return rows.select(S.grade(F.round(S.rate_score(S0), 9), S0).alias("grade")).groupBy("grade").agg(F.count("*").alias("n"))


@query("align_quality", RATE_SQL + """, q AS (SELECT u.utt_id, u.text, u.s, u.e, count(b.ch) AS n, coalesce(sum(b.z - b.a), 0) / (u.e - u.s) AS cover, count(*) FILTER (b.z - b.a < 0.02::DOUBLE OR b.z - b.a > 0.5::DOUBLE) AS odd FROM u LEFT JOIN b ON b.utt_id = u.utt_id AND b.text = u.text AND b.s = u.s AND b.e = u.e GROUP BY u.utt_id, u.text, u.s, u.e)
 SELECT utt_id, round(cover, 6) AS align_coverage, round(CASE WHEN n > 0 THEN odd / n ELSE 1.0 END, 6) AS align_degenerate_char_ratio, round(CASE WHEN length(text) > 0 THEN n / length(text) ELSE 0.0 END, 6) AS align_char_match_ratio, CASE WHEN n > 0 THEN 0.95 ELSE 0.0 END::DOUBLE AS align_conf_mean, CASE WHEN n > 0 THEN 0.95 ELSE 0.0 END::DOUBLE AS align_conf_p10, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS high_conf_char_ratio FROM q""")
def align_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = _aligned(spark, folder)
    return rows.select("utt_id", *[F.round(c, 6).alias(n) for n, c in R.alignment_quality(F.col("chars"), F.length("text"), F.col("start"), F.col("end")).items()])


@query("fine_segments")
def fine_segments(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.segment import utterances

    rows = table(spark, folder, "text_normalize").where("text_normalized <> '' AND `end` > `start`")
    rows = rows.groupBy("seg_id").agg(*[F.max(c).alias(c) for c in ("source_audio_id", "speaker_id", "speaker_label", "text_normalized", "status", "start", "end")])
    rows = rows.withColumn("chars", R.even_chars(F.col("text_normalized"), F.col("start"), F.col("end"))).withColumn("reject_reasons", F.array().cast("array<string>"))
    return utterances(rows, "chars", S0).select("utt_id", "seg_id", "text", "prev_text", "next_text", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "status")


FRAMES = """fr AS (SELECT user_id, event_id AS f, CASE WHEN event_type = 'error' THEN 0.0 ELSE 80.0 + value END AS hz, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
 md AS (SELECT user_id % 10 AS speaker, quantile_cont(hz, 0.5) AS med FROM fr WHERE hz > 0 GROUP BY 1),
 st AS (SELECT fr.*, med, CASE WHEN hz > 0 THEN 12 * log2(hz / med) END AS st FROM fr JOIN md ON user_id % 10 = speaker),
 dl AS (SELECT *, abs(st - lag(st) OVER (PARTITION BY user_id ORDER BY i)) AS d FROM st)"""


def _frames(spark: SparkSession, folder: str) -> DataFrame:
    """Events as pitch frames of users, errors as unvoiced ones, ten speakers."""
    hz = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") + 80.0)
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = table(spark, folder, "events").select("user_id", i.alias("i"), hz.alias("hz"), (F.col("user_id") % 10).alias("speaker"))
    return rows.join(speaker_medians(rows, "speaker", "hz"), "speaker")


@query("pitch_stats", f"""WITH {FRAMES} SELECT user_id, round(count(*) FILTER (hz > 0) / count(*), 6) AS voiced_ratio, round(quantile_cont(hz, 0.5) FILTER (hz > 0), 6) AS f0_median_hz, round(stddev_pop(st), 6) AS f0_std_st,
 round(quantile_cont(st, 0.95) - quantile_cont(st, 0.05), 6) AS f0_range_st, round(coalesce(quantile_cont(d, 0.95), 0), 6) AS f0_delta_p95_st, round(coalesce(avg(0.5 + hz / 1000) FILTER (hz > 0), 0), 6) AS f0_confidence FROM dl GROUP BY user_id HAVING count(*) FILTER (hz > 0) >= 2
 UNION ALL SELECT user_id, round(count(*) FILTER (hz > 0) / count(*), 6), 0.0, 0.0, 0.0, 0.0, round(coalesce(avg(0.5 + hz / 1000) FILTER (hz > 0), 0), 6) FROM fr GROUP BY user_id HAVING count(*) FILTER (hz > 0) < 2""")
def pitch(spark: SparkSession, folder: str) -> DataFrame:
    rows = pitch_stats(_frames(spark, folder).withColumn("conf", F.col("hz") / 1000 + 0.5), "user_id", "i", "hz", "speaker_median_f0_hz", "conf")
    return rows.select("user_id", *[F.round(c, 6).alias(c) for c in ("voiced_ratio", "f0_median_hz", "f0_std_st", "f0_range_st", "f0_delta_p95_st", "f0_confidence")])


@query("speaker_f0_median", "SELECT speaker_id, round(quantile_cont(f0_median_hz, 0.5), 6) AS median_hz FROM filter_score WHERE f0_median_hz > 0 AND NOT isnan(f0_median_hz) GROUP BY speaker_id")
def speaker_f0_median(spark: SparkSession, folder: str) -> DataFrame:
    return speaker_medians(table(spark, folder, "filter_score"), "speaker_id", "f0_median_hz").select("speaker_id", F.round("speaker_median_f0_hz", 6).alias("median_hz"))


def _num(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END"


LIMITS = f"""lim AS (SELECT speaker_id, quantile_cont({_num('f0_std_st')}, 0.1) AS std_lo, quantile_cont({_num('f0_std_st')}, 0.95) AS std_hi, quantile_cont({_num('f0_range_st')}, 0.1) AS range_lo, quantile_cont({_num('f0_range_st')}, 0.95) AS range_hi
 FROM filter_score WHERE status IS DISTINCT FROM 'rejected' GROUP BY speaker_id HAVING count(*) >= 200)"""


@query("adaptive_thresholds", f"WITH {LIMITS} SELECT speaker_id, round(std_lo, 6) AS std_lo, round(std_hi, 6) AS std_hi, round(range_lo, 6) AS range_lo, round(range_hi, 6) AS range_hi FROM lim")
def adaptive_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.adaptive_limits(table(spark, folder, "filter_score"), "speaker_id", S0).where("f0_std_st_lo IS NOT NULL")
    return rows.select("speaker_id", *[F.round(f"f0_{a}_st_{b}", 6).alias(f"{a}_{b}") for a in ("std", "range") for b in ("lo", "hi")])


RULES = f"""WITH {LIMITS}, f AS (SELECT utt_id, quality_score, duration, loaded_at, {', '.join(f'{_num(c)} AS {c}' for c in ('voiced_ratio', 'f0_delta_p95_st', 'f0_std_st', 'f0_range_st', 'global_rate_cps', 'local_rate_cv', 'pause_ratio'))}, coalesce(local_rate_skipped, false) AS skip,
  coalesce(std_lo, 1.0) AS std_lo, coalesce(std_hi, 10.0) AS std_hi, coalesce(range_lo, 3.0) AS range_lo, coalesce(range_hi, 20.0) AS range_hi FROM filter_score LEFT JOIN lim ON filter_score.speaker_id IS NOT DISTINCT FROM lim.speaker_id),
 r AS (SELECT *, list_filter([CASE WHEN voiced_ratio < 0.35::DOUBLE THEN 'voiced_ratio<0.35' END, 'f0_confidence<0.65', CASE WHEN f0_delta_p95_st > 6 THEN 'f0_delta_p95_st>6.0' END,
  CASE WHEN f0_std_st < std_lo THEN printf('f0_std_st<%.2f', std_lo) END, CASE WHEN f0_std_st > std_hi THEN printf('f0_std_st>%.2f', std_hi) END, CASE WHEN f0_range_st < range_lo THEN printf('f0_range_st<%.2f', range_lo) END, CASE WHEN f0_range_st > range_hi THEN printf('f0_range_st>%.2f', range_hi) END,
  CASE WHEN global_rate_cps < 2 THEN 'global_rate_cps<2.00' END, CASE WHEN global_rate_cps > 9 THEN 'global_rate_cps>9.00' END, CASE WHEN NOT skip AND local_rate_cv < 0.06::DOUBLE THEN 'local_rate_cv<0.06' END, CASE WHEN NOT skip AND local_rate_cv > 0.65::DOUBLE THEN 'local_rate_cv>0.65' END,
  CASE WHEN pause_ratio > 0.45::DOUBLE THEN 'pause_ratio>0.45' END], lambda x: x IS NOT NULL) AS why FROM f)"""


def _rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.with_columns(table(spark, folder, "filter_score"), "f0_confidence", "align_coverage", "align_degenerate_char_ratio", "align_char_match_ratio", "align_conf_mean", "high_conf_char_ratio")
    rows = C.with_limits(rows, "speaker_id", S0)
    return rows.withColumn("why", S.hard_rules(S0, C.limits(S0)))


@query("hard_rules", RULES + " SELECT utt_id, array_to_string(why, ';') AS why, count(*) AS n FROM r GROUP BY 1, 2")
def hard_rules(spark: SparkSession, folder: str) -> DataFrame:
    return _rules(spark, folder).groupBy("utt_id", F.array_join("why", ";").alias("why")).agg(F.count("*").alias("n"))


@query("reject_reason_counts", "SELECT x AS reject_reason, count(*) AS \"count\" FROM (SELECT unnest(reject_reasons) AS x FROM filter_score) GROUP BY 1")
def reject_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return C.reason_counts(table(spark, folder, "filter_score"))


SCORES = f"""f AS (SELECT utt_id, {_num('f0_std_st')} AS s, {_num('f0_delta_p95_st')} AS d, {_num('global_rate_cps')} AS c, {_num('local_rate_cv')} AS v, coalesce(local_rate_skipped, false) AS k FROM filter_score),
 p AS (SELECT utt_id, 0.5 * ({_curve('s', 2.0, 6.0, 2.0)} + CASE WHEN d < 0 THEN 0 WHEN d <= 4 THEN 1 ELSE greatest(0, least(1, 1 - (d - 4) / 2)) END) AS pitch, CASE WHEN k THEN {_curve('c', 4.0, 7.5, 2.0)} ELSE 0.5 * ({_curve('c', 4.0, 7.5, 2.0)} + {_curve('v', 0.12, 0.45, 0.2)}) END AS rate,
  CASE WHEN s < 2 OR (NOT k AND v < 0.1::DOUBLE) THEN 'flat' WHEN s < 5 AND (k OR v < 0.35::DOUBLE) THEN 'natural' WHEN (s >= 5 AND s <= 8) OR (NOT k AND v >= 0.35::DOUBLE AND v <= 0.55::DOUBLE) THEN 'expressive' ELSE 'chaotic' END AS bucket FROM f)"""


def _rounded(c: Column, places: int) -> Column:
    """A double rounded as SQL does it: scaled, rounded half away from zero, scaled back. F.round() goes by the decimal digits, which decides ties otherwise."""
    return F.round(c * float(10**places)) / float(10**places)


# Without signal measures a clip has 0.45 for its audio and 0 for its alignment, and its pitch no confidence.
@query("quality_scores", f"""WITH {SCORES}, q AS (SELECT utt_id, bucket, 0.25::DOUBLE * 0.45::DOUBLE + 0.25::DOUBLE * pitch + 0.2::DOUBLE * rate + 0.1::DOUBLE * 0.85::DOUBLE AS x FROM p)
 SELECT utt_id, round(x, 6) AS quality_score, CASE WHEN round(x, 9) >= 0.85 THEN 'A' WHEN round(x, 9) >= 0.75 THEN 'B' WHEN round(x, 9) >= 0.6 THEN 'C' ELSE 'D' END AS grade, bucket AS prosody_bucket, 'rejected' AS status FROM q""")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All sub-scores, grades, buckets and reject reasons anew from the stored metrics."""
    rows = C.scored(table(spark, folder, "filter_score").drop("status", "reject_reasons").withColumns({"status": F.lit(None).cast("string"), "reject_reasons": F.array().cast("array<string>")}), S0)
    # As in SQL a score just below a grade's limit by its last bits has the grade; the operator's own compares without rounding.
    grade = S.grade(_rounded(F.col("quality_score"), 9), S0)
    return rows.select("utt_id", _rounded(F.col("quality_score"), 6).alias("quality_score"), grade.alias("grade"), "prosody_bucket", "status")


@query("pitch_rate_scores", f"WITH {SCORES} SELECT DISTINCT utt_id, round(pitch, 6) AS pitch, round(rate, 6) AS rate, bucket FROM p")
def pitch_rate_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "filter_score")
    return rows.select("utt_id", F.round(S.pitch_score(S0), 6).alias("pitch"), F.round(S.rate_score(S0), 6).alias("rate"), S.bucket().alias("bucket")).distinct()


@query("grades", "SELECT grade, count(*) AS n FROM (SELECT CASE WHEN quality_score >= 0.85 THEN 'A' WHEN quality_score >= 0.75 THEN 'B' WHEN quality_score >= 0.6 THEN 'C' ELSE 'D' END AS grade FROM filter_score) GROUP BY 1")
def grades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "filter_score").groupBy(S.grade(F.col("quality_score"), S0).alias("grade")).agg(F.count("*").alias("n"))


def _clips(spark: SparkSession, folder: str) -> DataFrame:
    """One row per utterance of the manifests, of the greatest values that its rows have."""
    rows = table(spark, folder, "manifests").where("utt_id IS NOT NULL")
    return rows.groupBy("utt_id").agg(*[F.max(c).alias(c) for c in rows.columns if c != "utt_id"])


@query("similar_texts", """WITH t AS (SELECT "language", utt_id, list_sort(list_distinct(list_transform(range(1, greatest(length(text) - 3, 2)), lambda i: substr(text, i, 5)))) AS g FROM manifests WHERE text <> ''),
 c AS (SELECT "language", g, min(utt_id) AS id, len(g) AS n FROM t GROUP BY ALL), w AS (SELECT "language", id, n, unnest(g) AS w FROM c),
 p AS (SELECT x."language", least(x.id, y.id) AS a, greatest(x.id, y.id) AS b, x.n + y.n AS n, count(*) AS both_ FROM w x JOIN w y ON x."language" IS NOT DISTINCT FROM y."language" AND x.w = y.w AND x.id < y.id GROUP BY ALL)
 SELECT "language", a, b, round(both_ / (n - both_), 6) AS jaccard FROM p WHERE both_ / (n - both_) > 0.8""")
def similar_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Near-alike texts of one language: the tables have none of one speaker."""
    rows = table(spark, folder, "manifests").where("text IS NOT NULL")
    return similar_pairs(rows, "utt_id", "language", "text", "0.8").select("language", "a", "b", F.round("jaccard", 6).alias("jaccard"))


# A greedy pass as rounds: who is beaten by nobody, or by dropped rows only, is kept; four rounds are more than the tables need.
def _rounds(n: int) -> str:
    out = ["k0 AS (SELECT id FROM r WHERE id NOT IN (SELECT lose FROM e))", "d0 AS (SELECT DISTINCT lose AS id FROM e WHERE win IN (SELECT id FROM k0))"]
    for i in range(1, n):
        out += [f"k{i} AS (SELECT id FROM r WHERE id NOT IN (SELECT lose FROM e WHERE win NOT IN (SELECT id FROM d{i - 1})) AND id NOT IN (SELECT id FROM d{i - 1}))", f"d{i} AS (SELECT DISTINCT lose AS id FROM e WHERE win IN (SELECT id FROM k{i}))"]
    return ", ".join(out)


@query("dedup_keep", f"""WITH r AS (SELECT row_number() OVER (ORDER BY coalesce(q, 0.0) DESC, utt_id, text) AS id, * FROM (SELECT DISTINCT utt_id, speaker_id, text, quality_score AS q FROM manifests)),
 g AS (SELECT id, speaker_id, list_distinct(list_transform(range(1, greatest(length(text) - 3, 2)), lambda i: substr(text, i, 5))) AS g FROM r WHERE text <> ''), w AS (SELECT id, speaker_id, len(g) AS n, unnest(g) AS w FROM g),
 e AS (SELECT x.id AS win, y.id AS lose FROM w x JOIN w y ON x.w = y.w AND x.speaker_id IS NOT DISTINCT FROM y.speaker_id AND x.id < y.id GROUP BY x.id, y.id, x.n, y.n HAVING count(*) / (x.n + y.n - count(*)) > 0.9),
 {_rounds(4)} SELECT utt_id FROM r WHERE id NOT IN (SELECT id FROM d3)""")
def dedup_keep(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "manifests").select("utt_id", "speaker_id", "text", "quality_score").distinct()
    return dedup(rows, "utt_id", "speaker_id", "text", "quality_score", "utt_id").select("utt_id")


# Groups by falling weight: the lightest is reserved for valid, the next for test, each other goes where most is lacking.
ROUTING = """WITH RECURSIVE c AS (SELECT utt_id, max(source_audio_id) AS src, max(speaker_id) AS spk, max(grade) AS grade, max(status) AS status, max(duration) AS d, max(sample_rate) AS rate FROM manifests WHERE utt_id IS NOT NULL GROUP BY utt_id),
 k AS (SELECT *, coalesce(nullif(src, ''), nullif(spk, '')) AS key, coalesce(status = 'rejected', false) AS gone FROM c),
 g AS (SELECT key, sum(coalesce(d, 0.0)) AS w FROM k WHERE NOT gone AND grade IN ('A', 'B') AND key IS NOT NULL GROUP BY key), o AS (SELECT *, row_number() OVER (ORDER BY w DESC, key) AS i, count(*) OVER () AS n, sum(w) OVER () AS total FROM g),
 s AS (SELECT 0::BIGINT AS i, NULL::VARCHAR AS key, NULL::VARCHAR AS split, 0.90::DOUBLE * total AS tr, 0.05::DOUBLE * total - w1 AS va, 0.05::DOUBLE * total - w2 AS te FROM (SELECT max(total) AS total, max(w) FILTER (i = n) AS w1, max(w) FILTER (i = n - 1) AS w2 FROM o)
  UNION ALL SELECT o.i, o.key, CASE WHEN tr >= va AND tr >= te THEN 'train' WHEN va >= te THEN 'valid' ELSE 'test' END, tr - CASE WHEN tr >= va AND tr >= te THEN w ELSE 0 END, va - CASE WHEN NOT (tr >= va AND tr >= te) AND va >= te THEN w ELSE 0 END, te - CASE WHEN NOT (tr >= va AND tr >= te) AND va < te THEN w ELSE 0 END
   FROM s JOIN o ON o.i = s.i + 1 AND o.i <= n - 2),
 t AS (SELECT key, split FROM s WHERE key IS NOT NULL UNION ALL SELECT key, CASE WHEN i = n THEN 'valid' ELSE 'test' END FROM o WHERE i >= n - 1)
 SELECT utt_id, CASE WHEN gone OR grade IS NULL OR grade NOT IN ('A', 'B', 'C') THEN 'rejected' ELSE split END AS split, CASE WHEN NOT gone AND grade = 'C' THEN 0.5 END::DOUBLE AS split_weight, src AS source_audio_id, coalesce(rate, 24000) AS sample_rate
 FROM k LEFT JOIN t USING (key) WHERE gone OR grade IS NULL OR grade NOT IN ('A', 'B', 'C') OR (grade IN ('A', 'B') AND split IS NOT NULL) OR (grade = 'C' AND split = 'train')"""


@query("split_routing", ROUTING)
def split_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = _clips(spark, folder).drop("split", "split_weight")
    return L.projected(L.routed(rows, S0)).select("utt_id", "split", "split_weight", "source_audio_id", "sample_rate")


@query("c_routing", """SELECT utt_id FROM manifests m WHERE grade = 'C' AND EXISTS (SELECT 1 FROM manifests t WHERE t.split = 'train' AND t.grade IN ('A', 'B') AND t.source_audio_id = m.source_audio_id) GROUP BY utt_id""")
def c_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "manifests")
    keys = rows.where("split = 'train' AND grade IN ('A', 'B')").select("source_audio_id")
    return rows.where("grade = 'C'").join(keys, "source_audio_id", "left_semi").select("utt_id").distinct()


@query("c_dropped", """SELECT DISTINCT utt_id FROM manifests m WHERE grade = 'C' AND source_audio_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manifests t WHERE t.split = 'train' AND t.grade IN ('A', 'B') AND t.source_audio_id = m.source_audio_id)""")
def c_dropped(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "manifests")
    keys = rows.where("split = 'train' AND grade IN ('A', 'B')").select("source_audio_id")
    return rows.where("grade = 'C' AND source_audio_id IS NOT NULL").join(keys, "source_audio_id", "left_anti").select("utt_id").distinct()


@query("speaker_stats", """SELECT speaker_id, count(*) AS n_utt, round(sum(duration::DECIMAL(18,6)), 2)::DOUBLE AS total_duration_sec, round(avg(quality_score), 4) AS avg_quality_score, count(*) FILTER (grade = 'A') AS "grade_A", count(*) FILTER (grade = 'B') AS "grade_B", count(*) FILTER (grade = 'C') AS "grade_C", count(*) FILTER (grade = 'D') AS "grade_D", count(*) FILTER (status = 'rejected') AS rejected FROM filter_score GROUP BY 1""")
def speaker_stats(spark: SparkSession, folder: str) -> DataFrame:
    return P.speaker_stats(table(spark, folder, "filter_score"))


@query("report_summary", """SELECT count(*) AS n_total, count(*) FILTER (status IS DISTINCT FROM 'rejected') AS n_active, count(*) FILTER (status = 'rejected') AS n_rejected, round(sum(duration), 3) AS total_sec, round(sum(duration) FILTER (status IS DISTINCT FROM 'rejected'), 3) AS active_sec FROM filter_score""")
def report_summary(spark: SparkSession, folder: str) -> DataFrame:
    return P.summary(table(spark, folder, "filter_score"))


for _c in ("grade", "prosody_bucket"):
    query(f"{_c}_counts", f"SELECT coalesce({_c}, '?') AS {_c}, count(*) AS n FROM filter_score WHERE status IS DISTINCT FROM 'rejected' GROUP BY 1")(lambda spark, folder, c=_c: P.counts_by(table(spark, folder, "filter_score"), c))


@query("split_counts", "SELECT split, count(*) AS n FROM manifests GROUP BY 1")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "manifests").groupBy("split").agg(F.count("*").alias("n"))


@query("pitch_histogram", "SELECT grade, least(floor(f0_std_st * 30 / 12), 29)::INT AS bin, count(*) AS n FROM filter_score WHERE f0_std_st BETWEEN 0 AND 12 GROUP BY 1, 2")
def pitch_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return P.histogram(table(spark, folder, "filter_score"), F.col("f0_std_st"), 0.0, 12.0, 30, ["grade"])


@query("rate_histogram", "SELECT least(floor(global_rate_cps * 30 / 10), 29)::INT AS bin, count(*) AS n FROM filter_score WHERE global_rate_cps BETWEEN 0 AND 10 AND global_rate_cps > 0 GROUP BY 1")
def rate_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return P.histogram(table(spark, folder, "filter_score").where("global_rate_cps > 0"), F.col("global_rate_cps"), 0.0, 10.0, 30)


@query("grade_export", """WITH a AS (SELECT split, coalesce(speaker_label, '?') AS l, count(*) AS c, sum(duration) AS d FROM manifests WHERE grade = 'A' GROUP BY 1, 2)
 SELECT split, sum(c)::BIGINT AS n, round(sum(d), 3) AS total_sec, string_agg(l || '=' || c, ';' ORDER BY l) AS per_label FROM a GROUP BY split""")
def grade_export(spark: SparkSession, folder: str) -> DataFrame:
    labels = F.array_join(F.transform(F.array_sort(F.map_entries("per_label")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ";")
    return P.export_summary(table(spark, folder, "manifests"), "A").select("split", "n", F.round("total_sec", 3).alias("total_sec"), labels.alias("per_label"))


@query("rescore", """WITH f AS (SELECT utt_id, coalesce(reject_reasons, []) AS old, spk_consistency AS m FROM filter_score),
 g AS (SELECT *, list_filter(old, lambda x: NOT starts_with(x, 'spk_')) AS kept, list_filter([CASE WHEN m.cluster_silhouette > 0.55::DOUBLE THEN 'spk_A' END, CASE WHEN m.max_dist_to_center > 0.75::DOUBLE THEN 'spk_B' END, CASE WHEN m.max_neighbor_delta > 0.75::DOUBLE THEN 'spk_C' END, CASE WHEN m.ref_outlier_ratio > 1.01::DOUBLE THEN 'spk_D' END, CASE WHEN m.overlap_ratio > 0.02::DOUBLE THEN 'spk_E' END], lambda x: x IS NOT NULL) AS new FROM f)
 SELECT utt_id, array_to_string(list_concat(kept, CASE WHEN list_contains(old, 'spk_too_few_windows') THEN ['spk_too_few_windows'] WHEN m IS NULL THEN [] ELSE new END), ';') AS why, count(*) AS n FROM g GROUP BY 1, 2""")
def rescore(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.rescored(table(spark, folder, "filter_score"), S0)
    return rows.groupBy("utt_id", F.array_join("reject_reasons", ";").alias("why")).agg(F.count("*").alias("n"))


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as windows: eight neighbouring ids are an utterance, the label its speaker."""
    return table(spark, folder, "embeddings").select(F.floor(F.col("vec_id") / 8).alias("utt"), F.col("vec_id").alias("w"), F.col("label"), "embedding")


@query("speaker_centers", """WITH d AS (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i),
 n AS (SELECT label, sqrt(sum(m * m)) AS norm FROM d GROUP BY label) SELECT label, (i - 1)::INT AS dim, round(m / (norm + 1e-12), 6) AS x FROM d JOIN n USING (label)""")
def speaker_centers(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.mean_vectors(table(spark, folder, "embeddings"), ["label"], "embedding", "c")
    return rows.select("label", F.posexplode("c").alias("dim", "x")).select("label", "dim", F.round("x", 6).alias("x"))


@query("neighbor_delta", """WITH l AS (SELECT vec_id, label, embedding AS b, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS a FROM embeddings)
 SELECT vec_id, round(1 - list_dot_product(a::DOUBLE[], b::DOUBLE[]) / (sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[])) * sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[])) + 1e-12), 6) AS delta FROM l WHERE a IS NOT NULL""")
def neighbor_delta(spark: SparkSession, folder: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("vec_id")
    rows = table(spark, folder, "embeddings").withColumn("a", F.lag("embedding").over(w)).where("a IS NOT NULL")
    return rows.select("vec_id", F.round(V.cosine_distance(F.col("a"), F.col("embedding")), 6).alias("delta"))


@query("speaker_consistency")
def speaker_consistency(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.consistency(_windows(spark, folder), "utt", "w", "label", "embedding", S0)
    return rows.select("utt", "label", "n_windows", *[F.round(c, 6).alias(c) for c in ("silhouette", "max_dist_to_center", "max_neighbor_delta", "ref_outlier_ratio")], F.array_join("reasons", ";").alias("reasons"))


DISTANCES = """WITH v AS (SELECT vec_id // 8 AS utt, vec_id AS w, label, embedding::DOUBLE[] AS v FROM embeddings), f AS (SELECT utt, label, w, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
 m AS (SELECT utt, label, i, avg(x) AS m FROM f GROUP BY ALL), o AS (SELECT utt, label, list(m / (norm + 1e-12) ORDER BY i) AS own FROM m JOIN (SELECT utt, label, sqrt(sum(m * m)) AS norm FROM m GROUP BY ALL) USING (utt, label) GROUP BY utt, label),
 s AS (SELECT label FROM o GROUP BY label HAVING count(*) >= 2), cf AS (SELECT label, unnest(own) AS x, generate_subscripts(own, 1) AS i FROM o JOIN s USING (label)), cm AS (SELECT label, i, avg(x) AS m FROM cf GROUP BY ALL),
 c AS (SELECT label, list(m / (norm + 1e-12) ORDER BY i) AS centre FROM cm JOIN (SELECT label, sqrt(sum(m * m)) AS norm FROM cm GROUP BY label) USING (label) GROUP BY label),
 d AS (SELECT utt, label, v, own, centre, lag(v) OVER (PARTITION BY utt, label ORDER BY w) AS p FROM v JOIN o USING (utt, label) LEFT JOIN c USING (label)),
 n AS (SELECT utt, label, 1 - list_dot_product(v, own) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(own, own)) + 1e-12) AS near, 1 - list_dot_product(v, centre) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(centre, centre)) + 1e-12) AS far,
  CASE WHEN p IS NOT NULL THEN 1 - list_dot_product(v, p) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(p, p)) + 1e-12) END AS step FROM d)
 SELECT utt, label, count(*) AS n_windows, CASE WHEN count(*) < 4 THEN 0.0 ELSE round(max(near), 6) END AS max_dist_to_center, CASE WHEN count(*) < 4 THEN 0.0 ELSE round(coalesce(max(step), 0), 6) END AS max_neighbor_delta,
  CASE WHEN count(*) < 4 THEN 0.0 ELSE round(coalesce(avg((far > 0.75)::INT), 0), 6) END AS ref_outlier_ratio FROM n GROUP BY utt, label"""


@query("speaker_distances", DISTANCES)
def speaker_distances(spark: SparkSession, folder: str) -> DataFrame:
    """Of the speakers' consistency what SQL can say: all but the silhouettes."""
    rows = V.consistency(_windows(spark, folder), "utt", "w", "label", "embedding", S0)
    return rows.select("utt", "label", "n_windows", *[F.round(c, 6).alias(c) for c in ("max_dist_to_center", "max_neighbor_delta", "ref_outlier_ratio")])


@query("adjacent_jaccard", """WITH x AS (SELECT utt_id, source_audio_id, max(text) AS text FROM fine_segment WHERE utt_id IS NOT NULL GROUP BY 1, 2), l AS (SELECT *, lag(text) OVER (PARTITION BY source_audio_id ORDER BY utt_id) AS b FROM x),
 g AS (SELECT utt_id, list_distinct(list_transform(range(1, greatest(length(text) - 3, 2)), lambda i: substr(text, i, 5))) AS p, list_distinct(list_transform(range(1, greatest(length(b) - 3, 2)), lambda i: substr(b, i, 5))) AS q, text, b FROM l WHERE text IS NOT NULL AND b IS NOT NULL)
 SELECT utt_id, round(CASE WHEN text = '' OR b = '' THEN 0.0 ELSE len(list_intersect(p, q)) / (len(p) + len(q) - len(list_intersect(p, q))) END, 6) AS jaccard FROM g""")
def adjacent_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fine_segment").where("utt_id IS NOT NULL").groupBy("utt_id", "source_audio_id").agg(F.max("text").alias("text"))
    w = Window.partitionBy("source_audio_id").orderBy("utt_id")
    rows = rows.withColumn("before", F.lag("text").over(w)).where("before IS NOT NULL AND text IS NOT NULL")
    return rows.select("utt_id", F.round(jaccard(grams("text"), grams("before")), 6).alias("jaccard"))
