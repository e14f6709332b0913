"""Manifests, metadata, transcripts, annotations and audio as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.signal import measured
from ..functions.text import ideographs_only
from ..operators.ingest import REQUIRED, audio_id, cleaned, ingest_reasons, resolved, stem


def read_manifest(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object a line; blank lines are skipped, a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_metadata(spark: SparkSession, path: str, base: str = "") -> DataFrame:
    """The ingest table of a CSV file with header: stripped fields, ids, reasons."""
    rows = cleaned(spark.read.option("header", True).csv(path), (*REQUIRED, "transcript_path"))
    # The place in the file names rows without a path. Only those need numbers that don't depend on partitions: by what
    # the row says, as a file has no order once it is read in parts.
    alike = Window.partitionBy(F.col("audio_path") == "").orderBy("_at")
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    bare = rows.where("audio_path = ''").withColumn("_row", F.row_number().over(alike) - 1)
    rows = rows.where("audio_path <> ''").withColumn("_row", F.lit(0)).unionByName(bare).drop("_at").withColumn("reject_reasons", ingest_reasons())
    rows = rows.withColumn("audio_id", audio_id(F.col("speaker_id"), F.col("audio_path"), F.col("_row"))).withColumn("audio_path", resolved(F.col("audio_path"), base))
    return rows.withColumn("status", F.when(F.size("reject_reasons") > 0, "rejected").otherwise("passed")).drop("_row")


def read_audio(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """path, audio_hash (first 16 hex digits of SHA-256) and measures of audio files; samples stay in the reader's task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", stem(F.col("path")).alias("stem"), F.substring(F.sha2("content", 256), 1, 16).alias("audio_hash"), measured("content").alias("m")).select("path", "stem", "audio_hash", "m.*")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, stem and text of whole text files, stripped."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.trim("value").alias("text"))
    return rows.withColumn("stem", stem(F.col("path")))


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): lines `file<TAB>sign reading sign reading ...`, ideographs only."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.size(parts) == 2).select(F.trim(parts[0]).alias("file"), ideographs_only(parts[1]).alias("text"))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """Lines `[start,end]<TAB>speaker<TAB>gender,dialect<TAB>text`; other lines are skipped; speaker G00000000 is noise."""
    p = F.split("value", "\t", 4)
    span = r"^\[\s*([0-9.]+)\s*,\s*([0-9.]+)\s*\]$"
    rows = spark.read.text(path).where((F.size(p) == 4) & F.trim(p[0]).rlike(span))
    rows = rows.select(stem(F.input_file_name()).alias("meeting_id"), *[F.expr(f"try_cast({x} AS double)").alias(n) for n, x in (("start", f"regexp_extract(trim(split(value, '\\t')[0]), '{span.replace(chr(92), chr(92) * 2)}', 1)"), ("end", f"regexp_extract(trim(split(value, '\\t')[0]), '{span.replace(chr(92), chr(92) * 2)}', 2)"))], F.trim(p[1]).alias("speaker"), F.trim(p[2]).alias("gender_dialect"), F.trim(p[3]).alias("text"))
    return rows.where("`start` IS NOT NULL AND `end` IS NOT NULL").withColumn("is_noise", F.col("speaker") == "G00000000")


def textgrid_turns(text: Column) -> Column:
    """Non-empty intervals of all tiers of a verbose TextGrid: array of (speaker, start, end, text)."""
    def rest(parts: Column) -> Column:
        """What follows the part before the first heading."""
        return F.slice(parts, 2, F.size(parts))

    tiers = rest(F.split(text, r"item\s*\[\d+\]\s*:"))
    number = r"\s*=\s*([0-9.eE+-]+)"

    def turns(tier: Column) -> Column:
        name = F.regexp_extract(tier, r'name\s*=\s*"([^"]*)"', 1)
        spans = rest(F.split(tier, r"intervals\s*\[\d+\]\s*:?"))
        return F.transform(spans, lambda s: F.struct(name.alias("speaker"), F.regexp_extract(s, "xmin" + number, 1).try_cast("double").alias("start"), F.regexp_extract(s, "xmax" + number, 1).try_cast("double").alias("end"), F.trim(F.regexp_extract(s, r'text\s*=\s*"((?:[^"]|"")*)"', 1)).alias("text")))

    return F.filter(F.flatten(F.transform(tiers, turns)), lambda t: (t["text"] != "") & t["start"].isNotNull())


def read_textgrids(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path, wholetext=True).select(stem(F.input_file_name()).alias("meeting_id"), F.explode(textgrid_turns(F.col("value"))).alias("t"))
    return rows.select("meeting_id", "t.*")


def stamped_chars(text: Column, stamps: Column, confidence: float = 0.95) -> Column:
    """Characters of text with stamps (milliseconds, from a JSON list of pairs); surplus characters stand at the last end."""
    times = F.from_json(stamps, "array<array<double>>")
    letters = F.filter(F.split(text, ""), lambda c: F.trim(c) != "")
    last = F.coalesce(F.get(F.get(times, F.size(times) - 1), F.lit(1)), F.lit(0.0)) / 1000
    return F.transform(letters, lambda c, i: F.struct(
        c.alias("char"), F.coalesce(F.get(F.get(times, i), F.lit(0)) / 1000, last).alias("start"), F.coalesce(F.get(F.get(times, i), F.lit(1)) / 1000, last).alias("end"), F.lit(confidence).alias("confidence")))


def read_stamped(spark: SparkSession, path: str) -> DataFrame:
    """(utt_id, text, chars) of two-line files: `id<TAB>text`, then a tab and a JSON list of spans in milliseconds."""
    rows = spark.read.text(path, wholetext=True).withColumn("_l", F.split("value", "\n"))
    one, two = F.split(F.get("_l", F.lit(0)), "\t", 2), F.trim(F.get("_l", F.lit(1)))
    rows = rows.where(F.size("_l") >= 2).select(F.trim(F.get(one, F.lit(0))).alias("utt_id"), F.trim(F.get(one, F.lit(1))).alias("text"), F.regexp_replace(two, r"^\t", "").alias("_s"))
    return rows.select("utt_id", "text", stamped_chars(F.col("text"), F.col("_s")).alias("chars"))


def read_predictions(spark: SparkSession, path: str, schema: StructType | str = "source_audio_id string, speaker_label string, start double, end double, status string") -> DataFrame:
    """(meeting_id, speaker, start, end) of a segment manifest, without rejected segments; no speaker is UNK."""
    rows = read_manifest(spark, path, schema).where(F.coalesce(F.col("status") != "rejected", F.lit(True)))
    return rows.select(F.col("source_audio_id").alias("meeting_id"), F.coalesce("speaker_label", F.lit("UNK")).alias("speaker"), "start", "end")


def without_noise(turns: DataFrame) -> DataFrame:
    """Reference turns of speakers, as (meeting_id, speaker, start, end)."""
    return turns.where(~F.coalesce(F.col("is_noise"), F.lit(False))).select("meeting_id", "speaker", "start", "end")


def read_split(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A split's manifest; no rows where there is none."""
    try:
        return read_manifest(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
