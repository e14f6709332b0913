"""Queries pN_... of the training-data problems that concern language-model corpora."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import speaker_key, strip_blanks
from ..plans.tables import Registry, table
from ..session import stored
from .capping import dropped_by_cap
from .codepoints import LOOKALIKES
from .common import LATEST_SQL, SCORED_SQL, latest_rows, scored_rows
from .cutoffs import below_cutoff, cutoffs
from .garbled import garbled_records, garbled_tokens, restored
from .grouping import assign_splits, linked_groups
from .leaks import leaked
from .lookalike import alike_classes, alike_pairs
from .overlaps import coverage, overlaps, record_pairs, shared_keys
from .packing import pack, token_counts
from .percentiles import exact_percentiles, sketch, sketch_percentiles, value_counts

REGISTRY = Registry()
FRACTIONS = ["0.05", "0.1", "0.25", "0.5", "0.75", "0.95"]
PITCH = ["f0_std_st", "f0_range_st"]
RATIOS = {"train": "0.92", "valid": "0.04", "test": "0.04"}


@REGISTRY.query("p2_found", f"""WITH {SCORED_SQL},
r AS (SELECT utt_id, row_number() OVER (PARTITION BY speaker ORDER BY quality_score DESC, utt_id) AS pos, (SELECT count(*) FROM scored) AS n FROM scored)
SELECT utt_id FROM r WHERE pos > (n * 4) // 100""")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(scored_rows(spark, folder))
    return dropped_by_cap(rows, "speaker", "quality_score", "utt_id", share="0.04").select("utt_id")


P7_T = f"""WITH {SCORED_SQL},
d AS (SELECT speaker, quality_score, count(*) AS m FROM scored GROUP BY ALL),
c AS (SELECT speaker, quality_score, sum(m) OVER (PARTITION BY speaker ORDER BY quality_score DESC) AS upto, sum(m) OVER (PARTITION BY speaker) AS n FROM d),
t AS (SELECT speaker, max(quality_score) AS cutoff, any_value(n)::BIGINT AS n, min(upto)::BIGINT AS kept FROM c WHERE upto * 10 >= n * 8 GROUP BY speaker)"""


@REGISTRY.query("p7_found", P7_T + " SELECT utt_id FROM scored JOIN t USING (speaker) WHERE quality_score < cutoff")
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return below_cutoff(stored(scored_rows(spark, folder)), "speaker", "quality_score", "0.8").select("utt_id")


@REGISTRY.query("p7_cutoffs", P7_T + " SELECT speaker, cutoff, n, kept FROM t")
def p7_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    return cutoffs(scored_rows(spark, folder), "speaker", "quality_score", "0.8")


P4_V = f"""WITH {LATEST_SQL},
v AS (SELECT speaker, metric, x FROM (SELECT speaker, 'f0_std_st' AS metric, f0_std_st AS x FROM latest UNION ALL SELECT speaker, 'f0_range_st', f0_range_st FROM latest)
      WHERE x IS NOT NULL AND NOT isnan(x) AND speaker IS NOT NULL AND speaker NOT IN ('', 'multi', 'unknown'))"""


@REGISTRY.query("p4_percentiles", P4_V + " ".join(("", "UNION ALL".join(f" SELECT speaker, metric, '{f}' AS fraction, count(*) AS n, round(quantile_cont(x, {f}::DOUBLE), 6) AS value FROM v GROUP BY speaker, metric " for f in FRACTIONS))))
def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    counts = value_counts(latest_rows(spark, folder, ["speaker_id", *PITCH]), "speaker", PITCH)
    return exact_percentiles(counts, FRACTIONS).select(F.col("_g").alias("speaker"), "metric", "fraction", "n", F.round("value", 6).alias("value"))


#: Bounds of the values that share sign, exponent and seven bits of the mantissa with the one of the wanted rank.
P4_DAYS = P4_V + """, o AS (SELECT speaker, metric, x, row_number() OVER (PARTITION BY speaker, metric ORDER BY x) AS i, count(*) OVER (PARTITION BY speaker, metric) AS n FROM v),
f AS (SELECT unnest([""" + ", ".join(f"'{f}'" for f in FRACTIONS) + """]) AS fraction),
r AS (SELECT speaker, metric, fraction, n, x, CASE WHEN x = 0 THEN 0.0 ELSE pow(2.0::DOUBLE, floor(log2(abs(x))) - 7) END AS unit FROM o, f WHERE i = greatest(1, ceil(n * fraction::DECIMAL(9,4)))),
b AS (SELECT *, CASE WHEN x = 0 THEN 0.0 ELSE floor(abs(x) / unit) * unit END AS a FROM r)
SELECT speaker, metric, fraction, n, round(CASE WHEN x < 0 THEN -(a + unit) ELSE a END, 6) AS low, round(CASE WHEN x < 0 THEN -a ELSE a + unit END, 6) AS high FROM b"""


@REGISTRY.query("p4_merged_days", P4_DAYS)
def p4_merged_days(spark: SparkSession, folder: str) -> DataFrame:
    """The percentiles again, from summaries of the single run_dates: bounds that hold the exact value."""
    days = sketch(latest_rows(spark, folder, ["speaker_id", "run_date", *PITCH]), "speaker", PITCH, by=("run_date",))
    out = sketch_percentiles(days, FRACTIONS).withColumnRenamed("_g", "speaker")
    return out.select("speaker", "metric", "fraction", "n", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


P5_SQL = """WITH RECURSIVE f AS (SELECT DISTINCT source_audio_id AS v, lower(regexp_replace(speaker_id, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')) AS s FROM fine_segment WHERE source_audio_id IS NOT NULL),
k AS (SELECT * FROM f WHERE s IS NOT NULL AND s NOT IN ('', 'multi', 'unknown')),
m AS (SELECT s, min(v) AS b FROM k GROUP BY s),
e AS (SELECT DISTINCT k.v AS a, m.b FROM k JOIN m USING (s)),
e2 AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(v, g) USING KEY (v) AS (SELECT DISTINCT v, v FROM f UNION
    (SELECT e2.a, min(r.g) FROM r JOIN e2 ON e2.b = r.v JOIN recurring.r AS c ON c.v = e2.a WHERE r.g < c.g GROUP BY e2.a))
SELECT v AS source_audio_id, g AS group_id FROM r"""


@REGISTRY.query("p5_found", P5_SQL)
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return linked_groups(table(spark, folder, "fine_segment"), "source_audio_id", speaker_key("speaker_id"))


@REGISTRY.query("p5_splits")
def p5_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Utterances with their split; one row per utt_id and recording."""
    utts = table(spark, folder, "fine_segment").select("utt_id", "source_audio_id", "duration").where("source_audio_id IS NOT NULL")
    found = stored(p5_found(spark, folder))
    utts = utts.groupBy("utt_id", "source_audio_id").agg(F.max("duration").alias("duration"))
    sizes = utts.groupBy("source_audio_id").agg(F.sum("duration").alias("w")).join(found, "source_audio_id").groupBy("group_id").agg(F.sum("w").alias("w"))
    splits = assign_splits(sizes, "group_id", "w", RATIOS).select("group_id", "split")
    return utts.join(found.join(splits, "group_id"), "source_audio_id").select("utt_id", "source_audio_id", "group_id", "split")


#: Full-width signs, radicals and look-alike letters, and their ordinary forms.
_ALIKE = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in [*range(0xFF01, 0xFF5F), *range(0x2F00, 0x2FD6)]] + [x for one in LOOKALIKES for x in zip(*one, strict=True)]
WIDE, PLAIN = ("".join(x) for x in zip(*_ALIKE, strict=True))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: SQL has no compatibility forms: this knows those of one sign.
P3_SQL = rf"""WITH r AS (SELECT DISTINCT 'text_normalized' AS field, seg_id, text_normalized AS t FROM text_normalize WHERE text_normalized <> '' UNION SELECT DISTINCT 'asr_text', seg_id, asr_text FROM asr WHERE asr_text <> ''),
f AS (SELECT *, trim(regexp_replace(nfc_normalize(translate(regexp_replace(t, '[\p{{Cf}}\x{{fe00}}-\x{{fe0f}}\x{{34f}}]', '', 'g'), {_quoted(WIDE)}, {_quoted(PLAIN)})), '[\p{{Zs}}\t]', ' ', 'g')) AS form FROM r WHERE seg_id IS NOT NULL)
SELECT DISTINCT a.field, a.seg_id AS seg_a, b.seg_id AS seg_b FROM f a JOIN f b ON a.field = b.field AND a.form = b.form AND a.seg_id < b.seg_id AND a.t <> b.t WHERE a.form <> ''"""


@REGISTRY.query("p3_found", P3_SQL)
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = (("text_normalize", "text_normalized"), ("asr", "asr_text"))
    one, two = (table(spark, folder, t).select(F.lit(c).alias("field"), "seg_id", F.col(c).alias("text")) for t, c in fields)
    return alike_pairs(alike_classes(one.unionByName(two), "seg_id", "text", by=("field",)), by=("field",))


@REGISTRY.query("p9_found")
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "eval_items")
    ideographs = F.length(F.regexp_replace("text", r"[^\x{3400}-\x{9fff}]", ""))
    least = F.when(ideographs * 2 > F.length("text"), 40).otherwise(120)
    return leaked(table(spark, folder, "documents"), "doc_id", "text", items, "item_id", "text", least)


def _sides(spark: SparkSession, folder: str) -> DataFrame:
    side = F.when(F.col("split") == "train", 1).when(F.col("split").isin("valid", "test"), 2)
    return table(spark, folder, "manifests").select("utt_id", "source_audio_id", "split", "text", side.alias("side"))


def shared_recordings(spark: SparkSession, folder: str) -> DataFrame:
    """(key, side, id): recordings with one audio hash, of which train has some and valid or test others."""
    heard = F.lower(strip_blanks("audio_hash"))
    used = _sides(spark, folder).where("side IS NOT NULL").select(F.col("source_audio_id").alias("audio_id"), "side").distinct()
    rows = table(spark, folder, "ingest").select("audio_id", heard.alias("h")).where("h IS NOT NULL AND NOT h RLIKE '^0*$'").distinct()
    return shared_keys(rows.join(used, "audio_id"), "audio_id", F.col("h"), "side")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("key_a"), F.greatest(a, b).alias("key_b")]


@REGISTRY.query("p1_found")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    members, near = overlaps(_sides(spark, folder), "utt_id", "text", "side")
    texts = record_pairs(members, near).select(*_ordered("left_id", "right_id"))
    heard = stored(shared_recordings(spark, folder))
    left, right = (heard.where(F.col("side") == s).select("key", F.col("id").alias(x)) for s, x in ((1, "a"), (2, "b")))
    return texts.unionByName(left.join(right, "key").where("a <> b").select(*_ordered("a", "b"))).distinct()


@REGISTRY.query("p1_report")
def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping records per split, source and kind: near texts, with the mean share of a record's letters that spans
    shared with the other side cover, and recordings with one audio hash, which are covered whole."""
    sides = _sides(spark, folder).where("side IS NOT NULL")
    members, per = coverage(sides, "utt_id", "text", "side")
    # An id that stands on both sides with one text is no partner of itself.
    both = members.groupBy("id", "class").agg(F.bit_or("side").alias("_s")).where("_s = 3").select("id", "class", F.lit(1).alias("_self"))
    rows = members.join(per, ["class", "side"]).join(both, ["id", "class"], "left").withColumn("partners", F.col("partners") - F.coalesce("_self", F.lit(0))).where("partners > 0")
    rows = rows.groupBy(F.col("id").alias("utt_id"), "side").agg(F.sum("partners").alias("partners"), F.max("covered").alias("covered"))
    rows = sides.select("utt_id", "side", "split", "source_audio_id").distinct().join(rows, ["utt_id", "side"]).withColumn("kind", F.lit("text"))
    heard = stored(shared_recordings(spark, folder))
    sizes = heard.groupBy("key", F.col("side").alias("_other")).agg(F.count("*").alias("_n"))
    heard = heard.join(sizes, "key").where("side <> _other")
    own = heard.groupBy("key", F.col("id").alias("source_audio_id")).agg(F.bit_or("side").alias("_s"))
    heard = heard.withColumnRenamed("id", "source_audio_id").join(own, ["key", "source_audio_id"]).withColumn("partners", F.col("_n") - F.when(F.col("_s") == 3, 1).otherwise(0)).where("partners > 0")
    heard = heard.groupBy("source_audio_id", "side").agg(F.sum("partners").alias("partners"))
    used = sides.select("source_audio_id", "side", "split").distinct()
    heard = used.join(heard, ["source_audio_id", "side"]).withColumns({"kind": F.lit("recording"), "covered": F.lit(1.0)})
    both = rows.unionByName(heard, allowMissingColumns=True)
    return both.groupBy("split", "source_audio_id", "kind").agg(F.count("*").alias("records"), F.sum("partners").alias("pairs"), F.round(F.avg("covered"), 6).alias("covered"))


#: Tokens that a training sequence holds.
SEQUENCE = 2048


@REGISTRY.query("p8_packing")
def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(token_counts(table(spark, folder, "documents"), "doc_id", "text"), "doc_id", "n_tokens", SEQUENCE)


@REGISTRY.query("p8_fill")
def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the sequences are: tokens, sequences and share of unused room."""
    per = p8_packing(spark, folder).groupBy("container").agg(F.sum("length").alias("n"))
    return per.agg(F.sum("n").alias("tokens"), F.count("*").alias("sequences"), F.round(1 - F.sum("n") / (F.count("*") * SEQUENCE), 6).alias("unused"))


@REGISTRY.query("p10_found")
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_records(table(spark, folder, "documents"), "doc_id", "text")


@REGISTRY.query("p10_restored")
def p10_restored(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return restored(docs, "doc_id", "text", stored(garbled_tokens(docs, "doc_id", "text")))
