from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.config import profile
from voxloom.functions import scores as S
from voxloom.functions.order import codes_of, values_of
from voxloom.functions.text import cer, grams, normalized, proportional_slice, speaker_key
from voxloom.operators import intervals as I, rate as R, scoring as C, splits as L
from voxloom.operators.dedup import dedup
from voxloom.operators.periods import speech_periods
from voxloom.operators.ranges import range_blocks, running_total
from voxloom.operators.segment import spans
from voxloom.operators.speaker import silhouette


def plain_periods(rows):
    out, by = set(), {}
    for k, a, b in rows:
        if k is not None and a is not None and b is not None and b > a:
            by.setdefault(k, []).append((a, b))
    for k, xs in by.items():
        merged = []
        for a, b in sorted(xs):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out |= {(k, "period", a, b) for a, b in merged} | {(k, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])}
    return out


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_periods(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), (a := rng.randrange(-40, 400)), a + rng.randrange(-2, 30)) for _ in range(600)]
    rows += [("a", None, 3), ("a", 3, None), ("long", 0, 1000), ("long", 5, 10), ("touch", 0, 5), ("touch", 5, 9), *rows[:50]]
    df = spark.createDataFrame(rows, "k string, a long, b long").withColumn("start", F.lit("clash")).withColumn("_s", F.lit(1)).repartition(5)
    got = speech_periods(df, ["k"], F.col("a"), F.col("b"), block)
    assert {tuple(r) for r in got.select("k", "kind", "start", "end").collect()} == plain_periods(rows)
    assert got.limit(0).columns == ["k", "kind", "start", "end"]
    assert speech_periods(df.limit(0), ["k"], F.col("a"), F.col("b")).count() == 0


def test_order_codes():
    v = np.array([-math.inf, -1.5, -0.0, 0.0, 1e-300, 2.0, math.inf, math.nan])
    c = codes_of(v)
    assert (np.diff(c) >= 0).all() and c[2] == c[3]
    assert np.array_equal(values_of(c), v + 0.0, equal_nan=True)


def test_running_total(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
    got = running_total(range_blocks(df, [F.col("k")], 6), [F.col("k")], "w", "run").orderBy("k").collect()
    assert [r["run"] for r in got] == np.cumsum(np.arange(500) % 7).tolist()


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_score_curves(spark):
    for x, want in ((1.9, 0.0), (2.0, 0.0), (3.0, 0.5), (4.0, 1.0), (6.0, 1.0), (7.0, 0.5), (8.0, 0.0)):
        assert one(spark, v=S.bell(F.lit(x), 4.0, 6.0, 2.0))["v"] == pytest.approx(want)
    for x, want in ((-1.0, 0.0), (0.0, 1.0), (4.0, 1.0), (5.0, 0.5), (6.0, 0.0)):
        assert one(spark, v=S.ramp(F.lit(x), 0.0, 4.0, 6.0))["v"] == pytest.approx(want)
    s = profile("default")
    got = one(spark, **{f"g{i}": S.grade(F.lit(x), s) for i, x in enumerate((0.85, 0.8499, 0.75, 0.6, 0.59))})
    assert list(got) == ["A", "B", "B", "C", "D"]


def test_hard_rules_keep_their_order(spark):
    s = profile("default")
    df = spark.createDataFrame([("x", 0.1, 9.0, 0.2, 1.0, 9.5, 0.01, 0.9, False)], "speaker_id string, voiced_ratio double, f0_delta_p95_st double, f0_std_st double, f0_range_st double, global_rate_cps double, local_rate_cv double, pause_ratio double, local_rate_skipped boolean")
    df = df.withColumns({"status": F.lit(None).cast("string"), "reject_reasons": F.lit(None).cast("array<string>")})
    why = C.scored(df, s).first()
    assert why["reject_reasons"] == ["voiced_ratio<0.45", "f0_confidence<0.75", "f0_delta_p95_st>6.0", "f0_std_st<1.00", "f0_range_st<3.00", "global_rate_cps>8.00", "local_rate_cv<0.06", "pause_ratio>0.45", "align_conf_mean<0.6"][: len(why["reject_reasons"])]
    assert why["status"] == "rejected"


def test_text(spark):
    got = one(spark, a=normalized(F.lit("你 好,  a b　 世界 . ")), b=proportional_slice(F.lit("abcde"), F.lit(0.0), F.lit(1.0), F.lit(2.0)), c=grams(F.lit("abcd")), d=grams(F.lit("")), e=cer(F.lit("abc"), F.lit("abd")), f=cer(F.lit(""), F.lit("")), g=speaker_key(F.lit("　VX1 ")), h=speaker_key(F.lit("Unknown")))
    assert got["a"] == "你好， a b 世界。" and got["b"] == "ab" and got["c"] == ["abcd"] and got["d"] == []
    assert got["e"] == pytest.approx(1 / 3) and got["f"] == 0.0 and got["g"] == "vx1" and got["h"] is None


def chars(text, starts, ends, conf=0.95):
    return [{"char": c, "start": float(a), "end": float(b), "confidence": conf} for c, a, b in zip(text, starts, ends)]


def test_rate(spark):
    s = profile("default")
    for n, skip in ((0, True), (5, True), (11, True), (12, False), (15, False)):
        cs = chars("一" * n, np.arange(n) * 0.5, np.arange(n) * 0.5 + 0.25)
        df = spark.createDataFrame([(cs, 10.0)], "chars array<struct<char:string,start:double,end:double,confidence:double>>, duration double")
        r = R.with_rate(df, "chars", "duration", s).first()
        assert (r["n_chars"], r["local_rate_skipped"]) == (n, skip)
        assert r["global_rate_cps"] == pytest.approx(4.0 if n else 0.0)
        assert r["pause_ratio"] == pytest.approx(max(n - 1, 0) * 0.25 / 10)
        if not skip:
            assert r["local_rate_mean"] == pytest.approx(6 / 2.75) and r["local_rate_cv"] == pytest.approx(0.0, abs=1e-9)


def test_spans():
    cs = chars("一二三四。五六七八九", np.arange(10.0), np.arange(10.0) + 1)
    cs[4]["end"] -= 0.2
    assert spans(cs, 3, 20, 15) == [(0, 9)] or spans(cs, 3, 20, 15)[0] == (0, 4)
    cs = chars("字" * 50, np.arange(50.0), np.arange(50.0) + 1)
    got = spans(cs, 3, 20, 15)
    assert got[0][0] == 0 and got[-1][1] == 49 and all(b + 1 == c for (_, b), (c, _) in zip(got, got[1:]))


def test_intervals(spark):
    sp = spark.createDataFrame([("x", 1.0, 2.0), ("x", 1.5, 3.0), ("x", 3.0, 4.0), ("x", 6.0, 7.0)], "k string, s double, e double")
    tot = spark.createDataFrame([("x", 9.0), ("y", 2.0)], "k string, t double")
    got = {tuple(r) for r in I.silences(sp, ["k"], "s", "e", tot, "t").collect()}
    assert got == {("x", 0.0, 1.0), ("x", 4.0, 6.0), ("x", 7.0, 9.0), ("y", 0.0, 2.0)}
    a = spark.createDataFrame([("x", 1, 0.0, 10.0), ("x", 2, 10.0, 70.0)], "k string, a_id int, a_start double, a_end double")
    b = spark.createDataFrame([("x", 7, 5.0, 10.0), ("x", 8, 9.0, 65.0)], "k string, b_id int, b_start double, b_end double")
    got = {tuple(r) for r in I.overlapping(a, b, ["k"], 15.0).collect()}
    assert got == {("x", 1, 7, 5.0, 10.0), ("x", 1, 8, 9.0, 10.0), ("x", 2, 8, 10.0, 65.0)}
    mids = F.array(*[F.lit(x) for x in (4.0, 9.0, 25.0)])
    assert one(spark, c=I.forced_cuts(F.lit(0.0), F.lit(40.0), mids, 10.0))["c"] == [9.0, 19.0, 25.0, 35.0]
    p = spark.createDataFrame([("x", 1, 1.0), ("x", 2, 5.0)], "k string, i int, t double")
    m = spark.createDataFrame([("x", 0.9), ("x", 1.1), ("x", 9.0)], "k string, m double")
    assert {(r["i"], r["snapped"]) for r in I.nearest(p, ["k"], "t", "i", m, "m", 0.2).collect()} == {(1, 0.9), (2, 5.0)}


def plain_dedup(rows, t):
    def g(x):
        return {x[i : i + 5] for i in range(len(x) - 4)} if len(x) >= 5 else ({x} if x else set())

    kept = []
    for i, s, x, q in sorted(rows, key=lambda r: (-(r[3] or 0.0), r[0])):
        a = g(x or "")
        if not any(s == s2 and a and b and len(a & b) / len(a | b) > t for s2, b in kept):
            kept.append((s, a))
            yield i


def test_dedup(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef") for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(120):
        x = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            x[rng.randrange(len(x))] = rng.choice("abcdefgh")
        rows.append((f"u{i:03d}", rng.choice("st"), "".join(x), rng.choice([0.5, 0.7, None, 0.9])))
    rows += [("v1", "s", "", 0.1), ("v2", "s", None, 0.1), ("v3", "s", "abcd", 0.3), ("v4", "s", "abcd", 0.2), ("v5", "t", "abcd", 0.2)]
    df = spark.createDataFrame(rows, "i string, s string, x string, q double")
    for t in ("0.9", "0.6"):
        got = sorted(r["i"] for r in dedup(df, "i", "s", "x", "q", "i", t).collect())
        assert got == sorted(plain_dedup(rows, float(t)))


def test_deal():
    ratios = {"train": 0.8, "valid": 0.1, "test": 0.1}
    assert L.deal([5.0], ratios) == ["train"]
    assert L.deal([5.0, 4.0], ratios) == ["train", "valid"]
    assert L.deal([5.0, 4.0, 3.0], ratios) == ["train", "test", "valid"]


def test_silhouette():
    a, b = np.array([1.0, 0, 0]), np.array([0, 1.0, 0])
    assert silhouette(np.stack([a, a, a])) == 0.0
    assert silhouette(np.stack([a, a, b, b])) == pytest.approx(1.0)
    assert silhouette(np.stack([a] * 5)) == 0.0


def test_registry_covers_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_dedup_null_speakers_and_ids(spark):
    from voxloom.operators.dedup import dedup, similar_pairs

    long = "the quick brown fox jumps over the lazy dog again and again"
    rows = [("a", None, long, 0.9), ("b", None, long + "!", 0.8), ("c", None, "something else entirely", 0.1), ("d", "s", long, 0.5), (None, "s", "one more text of its own", 0.5), (None, "s", long + "?", 0.4)]
    df = spark.createDataFrame(rows, "i string, s string, x string, q double")
    got = {(r["i"], r["s"], r["x"]) for r in dedup(df, "i", "s", "x", "q", "i", "0.8").collect()}
    assert got == {r[:3] for k, r in enumerate(rows) if k not in (1, 5)}
    pairs = {(r["s"], r["a"], r["b"]) for r in similar_pairs(df, "i", "s", "x", "0.8").collect()}
    assert pairs == {(None, "a", "b"), ("s", None, "d")}


def test_similar_pairs_of_common_phrases(spark):
    from voxloom.operators.dedup import similar_pairs

    rng = random.Random(3)
    phrases = ["".join(rng.choices("abcdefghijklmnop", k=10)) for _ in range(30)]
    texts = ["".join(rng.choices(phrases, k=rng.choice([4, 10, 11]))) for _ in range(800)]
    for i in range(0, 800, 20):
        x = list(texts[i + 1])
        for at in rng.sample(range(len(x)), rng.choice([1, 1, 2])):
            x[at] = rng.choice("qrst")
        texts[i] = "".join(x) + rng.choice(["", "u", "vwx"])
    rows = [(f"u{i:03d}", rng.choice("st") if i % 2 else None, x) for i, x in enumerate(texts)]
    # Copies with a letter more stand in the other's group, so that some pairs are of one group and some are not.
    rows += [(f"w{i:03d}", rng.choice([None, "s", "t"]), x + "y") for i, x in enumerate(texts[:60])]
    sets = [(i, s, {x[k : k + 5] for k in range(len(x) - 4)}) for i, s, x in rows]
    want = {(s, i, j) for k, (i, s, a) in enumerate(sets) for j, s2, b in sets[k + 1 :] if s == s2 and len(a & b) / len(a | b) > 0.8}
    assert len(want) > 20

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        summaries = spark.sparkContext._jsc.sc().statusStore().executorList(True)
        return sum(summaries.apply(k).totalShuffleWrite() for k in range(summaries.size()))

    before = shuffled()
    df = spark.createDataFrame(rows, "i string, s string, x string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for it
    try:
        got = similar_pairs(df, "i", "s", "x", "0.8").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert len(got) == len(want) and {(r["s"], r["a"], r["b"]) for r in got} == want
    # Every two texts have phrases in common; pairs that share no more must not be shuffled.
    assert shuffled() - before < 1_000_000


def test_numbers_wider_than_their_padding(spark):
    from voxloom.operators.ingest import audio_id, segment_ids

    df = spark.range(1001).selectExpr("id", "'s' AS l", "'a' AS r")
    ids = {r[0] for r in df.select(segment_ids(df, "l", "r", ["id"], 3, "seg")).collect()}
    assert len(ids) == 1001 and {"s_a_seg007", "s_a_seg100", "s_a_seg1000", "s_a_seg1001"} <= ids
    assert df.where("id = 1").select(audio_id(F.lit("s"), F.lit(""), F.lit(12345))).first()[0] == "s_row12345"


def test_rejected_rows_neither_count_nor_change(spark):
    """Limits of a speaker come from rows that aren't rejected, and a rejected row keeps what it has."""
    s = profile("default").with_changes({"f0.adaptive_min_utts": 5})
    rows = [("a", float(i), 5.0, None, None, None) for i in range(1, 6)] + [("a", 900.0, 900.0, "rejected", ["x"], 0.123)] * 5 + [(None, 2.0, 5.0, None, None, None)] * 5
    df = spark.createDataFrame(rows, "speaker_id string, f0_std_st double, f0_range_st double, status string, reject_reasons array<string>, quality_score double")
    got = {r["speaker_id"]: r["f0_std_st_hi"] for r in C.adaptive_limits(df.withColumns({"global_rate_cps": F.lit(1.0), "local_rate_cv": F.lit(1.0)}), "speaker_id", s).collect()}
    assert got == {"a": pytest.approx(np.percentile([1, 2, 3, 4, 5], 95)), None: 2.0}
    more = df.withColumns({c: F.lit(1.0) for c in ("voiced_ratio", "f0_delta_p95_st", "global_rate_cps", "local_rate_cv", "pause_ratio")} | {"local_rate_skipped": F.lit(False)})
    out = C.scored(more, s).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["reject_reasons"] == ["x"]:
            assert (r["quality_score"], r["grade"], r["pitch_score"]) == (0.123, None, None)
        else:
            assert r["text_quality_score"] == 0.85 and r["grade"] is not None


def test_quality_scores_round_as_sql(spark, tmp_path):
    """Scores halfway between two sixth places, and one that its last bits put below a grade's limit; what its SQL gives."""
    import __spark_entry__ as e

    cases = [(6.4982, 3.38, 14.169, 0.375, 0.516362, "D"), (6.2994, 2.66, 4.477, 0.215, 0.628788, "C"), (7.009, 3.99, 4.61, 0.396, 0.584438, "D"), (6.0284, 4.05, 8.352, 0.2, 0.6, "C"), (6.5, 3.0, 5.0, 0.2, 0.61625, "C")]
    rows = [(str(i), "s", 9.0, 0.5, 0.1, False, *c[:4]) for i, c in enumerate(cases)]
    names = "utt_id string, speaker_id string, f0_range_st double, voiced_ratio double, pause_ratio double, local_rate_skipped boolean, f0_std_st double, f0_delta_p95_st double, global_rate_cps double, local_rate_cv double"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/filter_score.parquet")
    got = e.queries()["quality_scores"](spark, str(tmp_path)).collect()
    assert {r["utt_id"]: (r["quality_score"], r["grade"]) for r in got} == {str(i): c[4:] for i, c in enumerate(cases)}


def test_silhouette_leaves_out_singletons():
    near = [np.array([1.0, x, 0]) for x in (0, 0.1, -0.1)]
    v = np.stack([x / np.linalg.norm(x) for x in [*near, np.array([0, 0, 1.0])]])
    d = 1 - v @ v.T
    want = np.mean([(d[i, 3] - np.mean([d[i, j] for j in range(3) if j != i])) / d[i, 3] for i in range(3)])
    assert silhouette(v) == pytest.approx(want)
