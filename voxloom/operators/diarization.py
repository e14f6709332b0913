"""Diarization error: overlaps of hypothesis and reference turns, and the best mapping of speakers."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

COLUMNS = "meeting_id string, ref_sec double, missed double, false_alarm double, confusion double, der double, jer double, n_ref int, n_hyp int"


def _cover(turns: list[tuple[float, float, str]], holes: list[tuple[float, float]]) -> list[tuple[float, float, frozenset]]:
    """Stretches of constant speakers outside the holes, in one sweep over the bounds of both."""
    events = sorted([(t, k, s) for a, b, s in turns for t, k in ((a, 1), (b, -1))] + [(t, k, None) for a, b in holes for t, k in ((a, 1), (b, -1))], key=lambda e: e[0])
    out, active, closed, last = [], Counter(), 0, None
    for t, k, s in events:
        if last is not None and t > last and not closed:
            out.append((last, t, frozenset(active)))
        last = t
        if s is None:
            closed += k
        else:
            active[s] += k
            if not active[s]:
                del active[s]
    return out


def best_mapping(weight: dict[tuple[str, str], float], left: list[str], right: list[str]) -> dict[str, str]:
    """One-to-one mapping of greatest total weight, by augmenting paths with potentials (cubic in the speakers)."""
    if len(left) > len(right):
        return {b: a for a, b in best_mapping({(b, a): w for (a, b), w in weight.items()}, right, left).items()}
    n, m = len(left), len(right)
    cost = -np.array([[weight.get((a, b), 0.0) for b in right] for a in left]).reshape(n, m)
    u, v, of = np.zeros(n + 1), np.zeros(m + 1), np.full(m + 1, -1)
    for i in range(n):
        # of[j] is the left one that column j has; the last column is where a path begins.
        of[m], j = i, m
        least, back, seen = np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while of[j] >= 0:
            seen[j] = True
            row = of[j]
            slack = cost[row] - u[row] - v[:m]
            better = ~seen[:m] & (slack < least)
            least[better], back[better] = slack[better], j
            open_ = np.where(seen[:m], np.inf, least)
            to = int(open_.argmin())
            step = open_[to]
            for k in np.flatnonzero(seen):
                u[of[k]] += step
                v[k] -= step
            least[~seen[:m]] -= step
            j = to
        while j != m:
            of[j], j = of[back[j]], back[j]
    return {left[of[j]]: right[j] for j in range(m) if of[j] >= 0 and weight.get((left[of[j]], right[j]), 0.0) > 0}


def meeting_errors(ref: list[tuple[float, float, str]], hyp: list[tuple[float, float, str]], collar: float = 0.25) -> dict:
    """Seconds missed, of false alarm and of confusion, their share of the reference, and the mean Jaccard error."""
    ref, hyp = ([t for t in x if t[1] > t[0]] for x in (ref, hyp))
    holes = [(t - collar, t + collar) for a, b, _ in ref for t in (a, b)] if collar else []
    parts = _cover([(a, b, "r" + s) for a, b, s in ref] + [(a, b, "h" + s) for a, b, s in hyp], holes)
    weight: dict[tuple[str, str], float] = {}
    time: dict[str, float] = {}
    total = missed = alarm = 0.0
    for a, b, who in parts:
        r, h = [s for s in who if s[0] == "r"], [s for s in who if s[0] == "h"]
        total += (b - a) * len(r)
        missed += (b - a) * max(0, len(r) - len(h))
        alarm += (b - a) * max(0, len(h) - len(r))
        for x in r:
            time[x] = time.get(x, 0.0) + b - a
            for y in h:
                weight[x, y] = weight.get((x, y), 0.0) + b - a
        for y in h:
            time[y] = time.get(y, 0.0) + b - a
    names = [sorted({p + s for _, _, s in x}) for p, x in (("r", ref), ("h", hyp))]
    mapping = best_mapping(weight, *names)
    right = 0.0
    for a, b, who in parts:
        right += (b - a) * sum(mapping.get(s) in who for s in who if s[0] == "r")
    both = sum((b - a) * min(sum(s[0] == "r" for s in who), sum(s[0] == "h" for s in who)) for a, b, who in parts)
    confusion = both - right
    jer = [1 - weight.get((r, h), 0.0) / (time.get(r, 0.0) + time.get(h, 0.0) - weight.get((r, h), 0.0) or 1.0) if (h := mapping.get(r)) else 1.0 for r in names[0]]
    return {
        "ref_sec": total, "missed": missed, "false_alarm": alarm, "confusion": confusion, "der": (missed + alarm + confusion) / total if total else 0.0,
        "jer": sum(jer) / len(jer) if jer else 0.0, "n_ref": len(names[0]), "n_hyp": len(names[1]),
    }


def diarization_errors(ref: DataFrame, hyp: DataFrame, collar: float = 0.25) -> DataFrame:
    """Errors per meeting of both (meeting_id, speaker, start, end); meetings of one side only are left out.

    A meeting is one recording, whose turns its length bounds; meetings are independent of one another.
    """
    rows = ref.select("meeting_id", "speaker", "start", "end", F.lit(True).alias("is_ref")).unionByName(hyp.select("meeting_id", "speaker", "start", "end", F.lit(False).alias("is_ref")))
    rows = rows.where("`end` > `start`")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [[(r.start, r.end, r.speaker or "UNK") for r in pdf[pdf.is_ref == x].itertuples()] for x in (True, False)]
        if not all(sides):
            return pd.DataFrame(columns=[c.split()[0] for c in COLUMNS.split(", ")])
        return pd.DataFrame([{"meeting_id": pdf.meeting_id.iloc[0], **meeting_errors(*sides, collar)}])

    return rows.groupBy("meeting_id").applyInPandas(run, COLUMNS)


def pooled(errors: DataFrame) -> DataFrame:
    """One row: errors of all meetings over all their reference seconds, and the mean error in the number of speakers."""
    total = F.sum("ref_sec")
    return errors.agg(total.alias("ref_sec"), *[F.sum(c).alias(c) for c in ("missed", "false_alarm", "confusion")], (F.sum(F.col("missed") + F.col("false_alarm") + F.col("confusion")) / total).alias("der"), F.avg("jer").alias("jer"), F.avg(F.abs(F.col("n_ref") - F.col("n_hyp"))).alias("speaker_count_error"))


def matched_meetings(ref: DataFrame, hyp: DataFrame) -> DataFrame:
    """(hyp_id, meeting_id): the reference meeting of each hypothesis: that of the same name, else the least one that its name
    ends with. Every ending of a name is looked up, so this is a join by equality."""
    names = ref.select("meeting_id").where("meeting_id IS NOT NULL").distinct()
    own = hyp.select(F.col("meeting_id").alias("hyp_id")).where("hyp_id IS NOT NULL").distinct()
    same = own.join(names.select(F.col("meeting_id").alias("hyp_id")), "hyp_id", "left_semi").withColumn("meeting_id", F.col("hyp_id"))
    rest = own.join(same.select("hyp_id"), "hyp_id", "left_anti")
    ends = rest.select("hyp_id", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("hyp_id"), F.lit(1))), lambda i: F.expr("hyp_id").substr(i, F.length("hyp_id")))).alias("meeting_id"))
    return same.unionByName(ends.join(names, "meeting_id").groupBy("hyp_id").agg(F.min("meeting_id").alias("meeting_id")))
