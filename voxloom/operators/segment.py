"""Fine cuts of aligned segments into utterances."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..config import Settings
from .ingest import padded

# Signs that end sentences, and signs that part clauses.
SENTENCE, CLAUSE = "。！？!?.", "，；：,;:"
SPANS = ArrayType(StructType([StructField("first", IntegerType()), StructField("last", IntegerType())]))


def spans(chars: list[dict], least: float, most: float, preferred: float) -> list[tuple[int, int]]:
    """First and last character of each utterance, in order; all characters are covered.

    Walks on from an utterance's start and remembers the best place to end it: a sentence end with a short pause and
    a high confidence, a pause, or a first clause sign. Past the longest length the utterance ends there, or else at
    its widest gap.
    """
    n, out, first = len(chars), [], 0
    pause = [chars[i + 1]["start"] - chars[i]["end"] for i in range(n - 1)] + [1e9]
    while first < n:
        end = None
        for i in range(first, n):
            c, elapsed = chars[i], chars[i]["end"] - chars[first]["start"]
            if elapsed < least:
                continue
            full = c["char"] in SENTENCE and pause[i] >= 0.2 and c["confidence"] >= 0.9
            if full or pause[i] >= 0.3:
                end = i
                if (elapsed >= 5.0 or i == n - 1) if full else elapsed >= preferred - 1:
                    break
            elif c["char"] in CLAUSE and c["confidence"] >= 0.85:
                end = i if end is None else end
                if elapsed >= preferred:
                    break
            if elapsed >= most:
                if end is None:
                    end = max(range(first, i + 1), key=lambda k: (pause[k], k))
                break
        chosen = n - 1 if end is None else end
        out.append((first, chosen))
        first = chosen + 1
    return out


def cut_spans_udf(s: Settings):
    least, most, preferred = (s.get(f"segment.{k}") for k in ("min_sec", "max_sec", "preferred_max_sec"))

    @F.pandas_udf(SPANS)
    def run(chars: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in spans(list(c), least, most, preferred)] if c is not None else [] for c in chars])

    return run


def utterances(segments: DataFrame, chars: str, s: Settings, context: int = 20) -> DataFrame:
    """One row per utterance: ids, text, up to 20 characters of context on either side, bounds, and the segment's columns.

    Ids count per label and source in the order of source, start and segment. Utterances below the least
    length are kept and marked. Segments that are rejected or have no characters give none.
    """
    rows = segments.where(F.coalesce(F.col("status") != "rejected", F.lit(True))).withColumnsRenamed({"status": "_st", "reject_reasons": "_rr", "start": "seg_start", "end": "seg_end"}).drop("_st", "_rr")
    rows = rows.withColumn("_span", F.explode(cut_spans_udf(s)(F.col(chars))))
    a, b = F.col("_span.first"), F.col("_span.last")

    def joined(lo: Column, n: Column) -> Column:
        return F.array_join(F.transform(F.slice(chars, lo, n), lambda c: c["char"]), "")

    order = Window.partitionBy("speaker_label", "source_audio_id").orderBy(F.coalesce("seg_start", F.lit(0.0)), F.coalesce("seg_id", F.lit("")), a)
    rows = rows.withColumns({
        "utt_id": F.concat_ws("_", "speaker_label", "source_audio_id", padded(F.row_number().over(order) - 1, 6)),
        "text": joined(a + 1, b - a + 1), "prev_text": joined(F.greatest(a + 1 - context, F.lit(1)), F.least(a, F.lit(context))), "next_text": joined(b + 2, F.lit(context)),
        "start": F.get(chars, a)["start"], "end": F.get(chars, b)["end"], "chars": F.slice(chars, a + 1, b - a + 1),
    })
    rows = rows.withColumn("duration", F.col("end") - F.col("start"))
    short = F.col("duration") < s.get("segment.min_sec")
    return rows.withColumns({"status": F.when(short, "rejected"), "reject_reasons": F.when(short, F.array(F.lit("duration_too_short")))}).drop("_span")
