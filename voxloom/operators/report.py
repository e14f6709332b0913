"""Counts, sums and histograms for reports, and their writers."""

from __future__ import annotations

import html
import os
import shutil
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import moved_paths

GRADES = ("A", "B", "C", "D")


def _exact_sum(column: str) -> Column:
    """Summed as decimals, so that the result doesn't depend on the order of rows."""
    return F.sum(F.col(column).cast("decimal(18,6)"))


def _active() -> Column:
    return F.coalesce(F.col("status") != "rejected", F.lit(True))


def speaker_stats(df: DataFrame, speaker: str = "speaker_id") -> DataFrame:
    """Utterances, seconds, mean score and grades per speaker."""
    return df.groupBy(speaker).agg(
        F.count("*").alias("n_utt"), F.round(_exact_sum("duration"), 2).cast("double").alias("total_duration_sec"), F.round(F.avg("quality_score"), 4).alias("avg_quality_score"),
        *[F.count_if(F.col("grade") == g).alias(f"grade_{g}") for g in GRADES], F.count_if(F.col("status") == "rejected").alias("rejected"))


def summary(df: DataFrame) -> DataFrame:
    """One row of totals."""
    return df.agg(
        F.count("*").alias("n_total"), F.count_if(_active()).alias("n_active"), F.count_if(~_active()).alias("n_rejected"),
        F.round(F.sum("duration"), 3).alias("total_sec"), F.round(F.sum(F.when(_active(), F.col("duration"))), 3).alias("active_sec"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value among rows not rejected; null as '?'."""
    return df.where(_active()).groupBy(F.coalesce(column, F.lit("?")).alias(column)).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: Column, lo: float, hi: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """(*by, bin from 0, n): equal bins over [lo, hi], the last one closed; other values, nulls and NaN are left out."""
    rows = df.withColumn("_v", value.cast("double")).where(F.col("_v").between(lo, hi))
    at = F.least(F.floor((F.col("_v") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    return rows.groupBy(*(by or []), at.alias("bin")).agg(F.count("*").alias("n"))


def export_summary(df: DataFrame, grade: str) -> DataFrame:
    """(split, n, total_sec, per_label): one grade's rows per split, with a map of rows per speaker label."""
    rows = df.where(F.col("grade") == grade).groupBy("split", "speaker_label").agg(F.count("*").alias("c"), F.sum("duration").alias("d"))
    pairs = F.array_sort(F.collect_list(F.struct(F.coalesce("speaker_label", F.lit("?")).alias("l"), "c")))
    return rows.groupBy("split").agg(F.sum("c").alias("n"), F.sum("d").alias("total_sec"), F.map_from_entries(pairs).alias("per_label"))


def write_reason_csv(counts: DataFrame, path: str) -> None:
    counts.orderBy(F.desc("count"), "reject_reason").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_speaker_csv(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, folder: str) -> None:
    """The page, the speaker and reason tables of scored rows, into a folder of the driver's; the page as text where it can't
    be written. Rows of the page are sums of a fixed number; the tables are written by the workers."""
    write_speaker_csv(speaker_stats(df), f"{folder}/speaker_stats.csv")
    reasons = df.select(F.explode("reject_reasons").alias("reject_reason")).groupBy("reject_reason").agg(F.count("*").alias("count"))
    write_reason_csv(reasons, f"{folder}/rejected_samples.csv")
    tables = [("Totals", summary(df)), ("Grades", counts_by(df, "grade")), ("Prosody", counts_by(df, "prosody_bucket"))]
    try:
        write_html(tables, f"{folder}/quality_report.html")
    except OSError:
        write_text(tables, f"{folder}/quality_report.txt")


def write_html(tables: list[tuple[str, DataFrame]], path: str) -> None:
    """A page with small tables, a row at a time."""
    with Path(path).open("w", encoding="utf-8") as f:
        f.write("<!doctype html><meta charset='utf-8'><title>Report</title>")
        for title, df in tables:
            f.write(f"<h2>{html.escape(title)}</h2><table><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in df.columns)}</tr>")
            for r in df.toLocalIterator():
                f.write("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>")
            f.write("</table>")


def write_text(tables: list[tuple[str, DataFrame]], path: str) -> None:
    with Path(path).open("w", encoding="utf-8") as f:
        for title, df in tables:
            f.write(f"{title}:\n")
            for r in df.toLocalIterator():
                f.write("  " + "  ".join(f"{c}={v}" for c, v in zip(df.columns, r, strict=True)) + "\n")


def export_grade(df: DataFrame, grade: str, old: str, new: str, artefacts: tuple[str, ...] = ("wav", "alignment_json_path", "f0_npy_path")) -> DataFrame:
    """(rows of one grade with their artefacts' paths below new, the old paths as <name>_from): what is to be linked or copied."""
    rows = df.where(F.col("grade") == grade)
    return moved_paths(rows.withColumns({f"{c}_from": F.col(c) for c in artefacts}), list(artefacts), old, new)


def copy_artefacts(rows: DataFrame, artefacts: tuple[str, ...] = ("wav", "alignment_json_path", "f0_npy_path")) -> DataFrame:
    """(path, done): each artefact of export_grade() linked, or else copied, in folders that all workers share. Done again, it
    is done once; what is missing isn't an error."""

    @F.pandas_udf("boolean")
    def put(source: pd.Series, target: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(source, target, strict=True):
            try:
                Path(b).parent.mkdir(parents=True, exist_ok=True)
                if not Path(b).exists():
                    try:
                        os.link(a, b)
                    except OSError:
                        shutil.copyfile(a, b + ".part")
                        os.replace(b + ".part", b)
                out.append(True)
            except OSError:
                out.append(False)
        return pd.Series(out)

    pairs = F.explode(F.array(*[F.struct(F.col(f"{c}_from").alias("a"), F.col(c).alias("b")) for c in artefacts]))
    flat = rows.select(pairs.alias("_p")).where("_p.a IS NOT NULL")
    return flat.select(F.col("_p.b").alias("path"), put("_p.a", "_p.b").alias("done"))
