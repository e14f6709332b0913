"""Score curves, sub-scores, hard rules, grades and buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import Settings


def clip01(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def number(name: str, default: float = 0.0) -> Column:
    """The column as double; null and NaN as default (0 is itself, except for a default that stands for 0 too)."""
    c = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.coalesce(F.nullif(c, F.lit(0.0)) if default else c, F.lit(default))


def bell(c: Column, lo: float, hi: float, decay: float) -> Column:
    """1 within [lo, hi], falling linearly to 0 over decay on either side."""
    return clip01(F.least((c - (lo - decay)) / decay, ((hi + decay) - c) / decay))


def ramp(c: Column, lo: float, hi: float, zero: float) -> Column:
    """1 within [lo, hi], 0 below lo, falling linearly to 0 at zero."""
    return F.when(c < lo, 0.0).when(c <= hi, 1.0).otherwise(clip01(1.0 - (c - hi) / max(1e-6, zero - hi)))


def audio_score(snr: str = "snr_db", clip: str = "clipping_ratio", lufs: str = "lufs") -> Column:
    loud = F.greatest(F.lit(0.0), 1.0 - F.abs(number(lufs, -25.0) + 23.0) / 12.0)
    return 0.5 * clip01((number(snr) - 5.0) / 25.0) + 0.2 * clip01(1.0 - number(clip) / 0.01) + 0.3 * loud


def align_score() -> Column:
    names = ("align_coverage", "align_degenerate_char_ratio", "align_char_match_ratio")
    cov = number(names[0])
    cover = F.when((cov < 0.3) | (cov > 1.05), 0.0).when(cov < 0.55, (cov - 0.3) / (0.55 - 0.3)).when(cov <= 0.9, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - (cov - 0.9) / (1.05 - 0.9)))
    degenerate = F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.col(names[1]), F.lit(1.0)) / 0.25)
    match = clip01(1.0 - F.abs(1.0 - F.coalesce(F.col(names[2]), F.lit(0.0))))
    none = F.coalesce(*names).isNull()
    return F.when(none, number("align_conf_mean")).otherwise(0.5 * cover + 0.3 * degenerate + 0.2 * match)


def pitch_score(s: Settings) -> Column:
    (lo, hi), (a, b, zero) = s.get("score.std"), s.get("score.delta")
    return 0.5 * (bell(number("f0_std_st"), lo, hi, 2.0) + ramp(number("f0_delta_p95_st"), a, b, zero))


def rate_score(s: Settings) -> Column:
    cps = bell(number("global_rate_cps"), *s.get("score.cps"), 2.0)
    cv = bell(number("local_rate_cv"), *s.get("score.cv"), 0.2)
    return F.when(F.coalesce("local_rate_skipped", F.lit(False)), cps).otherwise(0.5 * (cps + cv))


def text_score(cer: str = "cer_vs_manual") -> Column:
    c = F.col(cer).cast("double")
    # greatest() and least() skip nulls: a missing rate must not become a zero score.
    return F.when(c.isNull(), 0.85).otherwise(clip01(1.0 - c))


def quality(s: Settings, parts: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, weight in s.get("score.weights").items():
        total = total + F.lit(float(weight)) * parts[name]
    return clip01(total)


def grade(score: Column, s: Settings) -> Column:
    cuts = s.get("score.grades")
    return F.when(score >= cuts["A"], "A").when(score >= cuts["B"], "B").when(score >= cuts["C"], "C").otherwise("D")


def bucket() -> Column:
    """flat, natural, expressive or chaotic; the first that fits."""
    std, cv, skip = number("f0_std_st"), number("local_rate_cv"), F.coalesce("local_rate_skipped", F.lit(False))
    flat = (std < 2.0) | (~skip & (cv < 0.10))
    natural = (std >= 2.0) & (std < 5.0) & (skip | ((cv >= 0.10) & (cv < 0.35)))
    expressive = ((std >= 5.0) & (std <= 8.0)) | (~skip & (cv >= 0.35) & (cv <= 0.55))
    return F.when(flat, "flat").when(natural, "natural").when(expressive, "expressive").otherwise("chaotic")


def reasons(*rules: tuple[Column, str | Column]) -> Column:
    """Names of the rules that hold, in order; a rule that is null doesn't hold."""
    return F.array_compact(F.array(*[F.when(c, n if isinstance(n, Column) else F.lit(n)) for c, n in rules]))


def hard_rules(s: Settings, bounds: dict[str, tuple[Column, Column]]) -> Column:
    """Reject reasons in their order. bounds: lower and upper limits of the four metrics that may vary by speaker."""

    def named(metric: str, sign: str, limit: Column) -> Column:
        return F.concat(F.lit(metric + sign), F.format_string("%.2f", limit))

    f0, rate, align = s.get("f0"), s.get("rate"), s.get("align")
    rules: list[tuple[Column, str | Column]] = [
        (number("voiced_ratio") < f0["min_voiced_ratio"], f"voiced_ratio<{f0['min_voiced_ratio']}"),
        (number("f0_confidence") < f0["min_f0_confidence"], f"f0_confidence<{f0['min_f0_confidence']}"),
        (number("f0_delta_p95_st") > f0["max_f0_delta_p95_st"], f"f0_delta_p95_st>{f0['max_f0_delta_p95_st']}"),
    ]
    for metric in ("f0_std_st", "f0_range_st", "global_rate_cps", "local_rate_cv"):
        lo, hi = bounds[metric]
        use = ~F.coalesce("local_rate_skipped", F.lit(False)) if metric == "local_rate_cv" else F.lit(True)
        rules += [(use & (number(metric) < lo), named(metric, "<", lo)), (use & (number(metric) > hi), named(metric, ">", hi))]
    rules.append((number("pause_ratio") > rate["max_pause_ratio"], f"pause_ratio>{rate['max_pause_ratio']}"))
    low, high = align["coverage"]
    rules += [
        (F.col("align_coverage") < low, f"align_coverage<{low}"), (F.col("align_coverage") > high, f"align_coverage>{high}"),
        (F.col("align_degenerate_char_ratio") > align["max_degenerate_char_ratio"], f"align_degenerate_char_ratio>{align['max_degenerate_char_ratio']}"),
        (F.col("align_char_match_ratio") < align["min_char_match_ratio"], f"align_char_match_ratio<{align['min_char_match_ratio']}"),
    ]
    legacy = F.coalesce("align_coverage", "align_degenerate_char_ratio", "align_char_match_ratio").isNull()
    rules.append((legacy & (F.coalesce("align_conf_mean", F.lit(1.0)) < align["min_char_confidence"]), f"align_conf_mean<{align['min_char_confidence']}"))
    rules.append((legacy & (F.col("high_conf_char_ratio") < align["min_high_conf_char_ratio"]), f"high_conf_char_ratio<{align['min_high_conf_char_ratio']}"))
    return reasons(*rules)
