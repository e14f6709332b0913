"""Settings: a tree with dotted lookup, the shipped profiles, and a file reader."""

from __future__ import annotations

import hashlib
import json
from copy import deepcopy
from pathlib import Path
from typing import Any

# The thresholds of the three shipped profiles.
DEFAULT: dict[str, Any] = {
    "qc": {
        "min_duration_sec": 30.0, "smoke_test": False, "lufs": [-35.0, -12.0],
        "studio": {"min_snr_db": 20.0, "max_clipping_ratio": 0.001, "min_bw_hz": 7500},
        "podcast": {"min_snr_db": 12.0, "max_clipping_ratio": 0.005, "min_bw_hz": 6000},
        "interview": {"min_snr_db": 10.0, "max_clipping_ratio": 0.005, "min_bw_hz": 6000},
        "field": {"min_snr_db": 8.0, "max_clipping_ratio": 0.01, "min_bw_hz": 6000},
    },
    "vad": {"min_silence_ms": 500, "min_segment_sec": 10.0, "max_segment_sec": 30.0, "snap_ms": 200, "min_diar_confidence": 0.6},
    "resample": {"train_sr": 24000, "align_sr": 16000},
    "asr": {"max_input_sec": 30.0},
    "segment": {"min_sec": 3.0, "max_sec": 20.0, "preferred_max_sec": 15.0},
    "mos": {"min_mos": 4.0},
    "speaker": {"window_sec": 1.5, "hop_sec": 0.25, "min_windows": 4, "silhouette": 0.35, "max_dist_to_center": 0.35, "max_neighbor_delta": 0.30, "consecutive_delta": 0.20, "ref_outlier_ratio": 0.10, "overlap_ratio": 0.02},
    "f0": {"f0_min": 60.0, "f0_max": 600.0, "frame_hop_ms": 10.0, "factor_low": 0.5, "factor_high": 2.0, "min_voiced_ratio": 0.45, "min_f0_confidence": 0.75, "max_f0_delta_p95_st": 6.0, "f0_std_st": [1.0, 10.0], "f0_range_st": [3.0, 20.0], "adaptive": True, "adaptive_min_utts": 200},
    "rate": {"global_rate_cps": [2.0, 8.0], "local_rate_cv": [0.06, 0.65], "max_pause_ratio": 0.45, "adaptive": False, "adaptive_min_utts": 200, "window_chars": 6, "hop_chars": 3, "min_chars": 12},
    "align": {"coverage": [0.35, 1.05], "max_degenerate_char_ratio": 0.30, "min_char_match_ratio": 0.85, "min_char_confidence": 0.6, "min_high_conf_char_ratio": 0.85, "latency_offset_ms": 0.0},
    "score": {
        "weights": {"audio": 0.25, "align": 0.20, "pitch": 0.25, "rate": 0.20, "text": 0.10},
        "grades": {"A": 0.85, "B": 0.75, "C": 0.60}, "cps": [3.5, 6.0], "cv": [0.12, 0.45], "std": [2.0, 6.0], "delta": [0.0, 4.0, 6.0],
    },
    "split": {"ratios": {"train": 0.92, "valid": 0.04, "test": 0.04}, "dedup_threshold": 0.9, "seed": 42, "speaker_holdout": False},
}
CHANGES: dict[str, dict[str, Any]] = {
    "default": {"qc.smoke_test": True},
    "conversation": {
        "qc.interview": {"min_snr_db": 8.0, "max_clipping_ratio": 0.005, "min_bw_hz": 1000}, "qc.lufs": [-45.0, -10.0], "vad.min_segment_sec": 3.0,
        "speaker.silhouette": 0.55, "speaker.max_dist_to_center": 0.75, "speaker.max_neighbor_delta": 0.75, "speaker.consecutive_delta": 0.55, "speaker.ref_outlier_ratio": 1.01,
        "f0.min_voiced_ratio": 0.35, "f0.min_f0_confidence": 0.65, "rate.global_rate_cps": [2.0, 9.0], "score.cps": [4.0, 7.5],
        "split.ratios": {"train": 0.90, "valid": 0.05, "test": 0.05},
    },
    "studio": {
        "qc.studio": {"min_snr_db": 25.0, "max_clipping_ratio": 0.001, "min_bw_hz": 1500}, "qc.podcast": {"min_snr_db": 12.0, "max_clipping_ratio": 0.005, "min_bw_hz": 1000},
        "qc.interview": {"min_snr_db": 8.0, "max_clipping_ratio": 0.005, "min_bw_hz": 1000}, "qc.field": {"min_snr_db": 8.0, "max_clipping_ratio": 0.01, "min_bw_hz": 1000},
        "qc.lufs": [-45.0, -10.0], "vad.min_segment_sec": 3.0, "speaker.silhouette": 0.55, "speaker.max_dist_to_center": 0.50, "speaker.max_neighbor_delta": 0.55,
        "speaker.consecutive_delta": 0.40, "speaker.ref_outlier_ratio": 1.01, "f0.min_voiced_ratio": 0.35, "f0.min_f0_confidence": 0.55,
        "split.ratios": {"train": 0.80, "valid": 0.10, "test": 0.10},
    },
}


class Settings:
    """Read-only tree; get("a.b.c", default) walks it."""

    def __init__(self, tree: dict[str, Any] | None = None) -> None:
        self.tree = deepcopy(DEFAULT if tree is None else tree)

    def get(self, dotted: str, default: Any = None) -> Any:
        node: Any = self.tree
        for part in dotted.split("."):
            if not isinstance(node, dict) or part not in node:
                return default
            node = node[part]
        return node

    def with_changes(self, changes: dict[str, Any]) -> Settings:
        out = Settings(self.tree)
        for dotted, value in changes.items():
            *path, last = dotted.split(".")
            node = out.tree
            for part in path:
                node = node.setdefault(part, {})
            node[last] = deepcopy(value)
        return out

    def digest(self) -> str:
        """First 16 hex digits of the SHA-256 of the settings as sorted JSON."""
        return hashlib.sha256(json.dumps(self.tree, sort_keys=True).encode()).hexdigest()[:16]


def profile(name: str = "default") -> Settings:
    return Settings().with_changes(CHANGES[name])


# Keys of settings files and what they are called here; a list stands for the ends of a range.
FILE_KEYS: dict[str, str | tuple[str, int]] = {
    **{f"audio_qc.{kind}.{a}": f"qc.{kind}.{b}" for kind in ("studio", "podcast", "interview", "field") for a, b in (("min_snr_db", "min_snr_db"), ("max_clipping_ratio", "max_clipping_ratio"), ("min_effective_bw_hz", "min_bw_hz"))},
    "audio_qc.loudness_lufs_range": "qc.lufs", "audio_qc.min_duration_sec": "qc.min_duration_sec", "audio_qc.smoke_test": "qc.smoke_test",
    "resample.training_sr": "resample.train_sr", "resample.alignment_sr": "resample.align_sr",
    "vad_coarse.min_silence_ms": "vad.min_silence_ms", "vad_coarse.min_segment_sec": "vad.min_segment_sec", "vad_coarse.max_segment_sec": "vad.max_segment_sec",
    "vad_coarse.diarization.snap_to_silence_ms": "vad.snap_ms", "vad_coarse.diarization.min_diar_confidence": "vad.min_diar_confidence",
    "asr.max_input_sec": "asr.max_input_sec", "align.latency_offset_ms": "align.latency_offset_ms", "align.min_char_confidence": "align.min_char_confidence",
    "align.min_high_conf_char_ratio": "align.min_high_conf_char_ratio", "align.min_coverage": ("align.coverage", 0), "align.max_coverage": ("align.coverage", 1),
    "align.max_degenerate_char_ratio": "align.max_degenerate_char_ratio", "align.min_char_match_ratio": "align.min_char_match_ratio",
    "fine_segment.min_duration": "segment.min_sec", "fine_segment.max_duration": "segment.max_sec", "fine_segment.preferred_max": "segment.preferred_max_sec",
    "mos.min_mos": "mos.min_mos", "spk_consistency.window_sec": "speaker.window_sec", "spk_consistency.hop_sec": "speaker.hop_sec", "spk_consistency.min_windows": "speaker.min_windows",
    **{f"spk_consistency.thresholds.{a}": f"speaker.{b}" for a, b in (("cluster_silhouette", "silhouette"), ("max_dist_to_center", "max_dist_to_center"), ("max_neighbor_delta", "max_neighbor_delta"), ("consecutive_neighbor_delta", "consecutive_delta"), ("ref_outlier_ratio", "ref_outlier_ratio"), ("overlap_ratio", "overlap_ratio"))},
    "f0.frame_hop_ms": "f0.frame_hop_ms", "f0.bootstrap.f0_min": "f0.f0_min", "f0.bootstrap.f0_max": "f0.f0_max", "f0.speaker_adaptive_range.factor_low": "f0.factor_low", "f0.speaker_adaptive_range.factor_high": "f0.factor_high",
    **{f"f0.filter.{k}": f"f0.{k}" for k in ("min_voiced_ratio", "min_f0_confidence", "max_f0_delta_p95_st")},
    **{f"{part}.filter.{end}_{m}": (f"{part}.{m}", i) for part, m in (("f0", "f0_std_st"), ("f0", "f0_range_st"), ("rate", "global_rate_cps"), ("rate", "local_rate_cv")) for i, end in enumerate(("min", "max"))},
    **{f"{part}.speaker_adaptive.{a}": f"{part}.{b}" for part in ("f0", "rate") for a, b in (("enabled", "adaptive"), ("min_samples_per_speaker", "adaptive_min_utts"))},
    "rate.window_chars": "rate.window_chars", "rate.step_chars": "rate.hop_chars", "rate.min_chars_for_local": "rate.min_chars", "rate.filter.max_pause_ratio": "rate.max_pause_ratio",
    **{f"score.weights.{k}": f"score.weights.{k}" for k in ("audio", "align", "pitch", "rate", "text")}, **{f"score.grade_thresholds.{k}": f"score.grades.{k}" for k in "ABC"},
    "score.rate_optimal_cps_range": "score.cps", "score.rate_optimal_cv_range": "score.cv", "score.pitch_optimal_std_st_range": "score.std",
    "score.pitch_delta_p95_full_score_range": ("score.delta", slice(0, 2)), "score.pitch_delta_p95_zero_at": ("score.delta", 2),
    **{f"split.ratios.{k}": f"split.ratios.{k}" for k in ("train", "valid", "test")}, "split.speaker_holdout": "split.speaker_holdout", "split.dedup_similarity": "split.dedup_threshold", "split.random_seed": "split.seed",
}
# Keys of settings files that name models, services and places, or that no step reads.
UNREAD = (
    "project", "paths", "input", "vad_coarse.diarization.enabled", "vad_coarse.diarization.model", "asr", "align.model", "align.granularity_ms", "align.audio_sample_rate", "align.batch_size", "align.base_url", "align.endpoint", "align.language", "align.timeout_sec",
    "align.device", "align.use_mock", "align.max_text_audio_duration_ratio", "align.min_text_audio_duration_ratio", "fine_segment.preferred_min", "fine_segment.punctuation_silence_ms", "mos.batch_size", "mos.use_mock", "spk_consistency.embedding_model",
    "spk_consistency.exclude_silence", "spk_consistency.enrollment", "spk_consistency.use_mock", "f0.speaker_adaptive.keep_percentile", "rate.speaker_adaptive.keep_percentile", "rate.filter.max_long_pause_count_per_15s",
)


def read_settings(path: str) -> Settings:
    """Settings from a JSON file, or a YAML file where a YAML reader is installed, over the defaults.

    Keys are those of settings files, or those used here; an unknown key is an error.
    """
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        tree = json.loads(text)
    else:
        import yaml

        tree = yaml.safe_load(text)

    def flat(node: dict, at: str) -> dict[str, Any]:
        out = {}
        for k, v in node.items():
            out |= flat(v, f"{at}{k}.") if isinstance(v, dict) else {f"{at}{k}": v}
        return out

    out, unknown = Settings(), object()
    for key, value in flat(tree or {}, "").items():
        if key in FILE_KEYS:
            name = FILE_KEYS[key]
            if isinstance(name, tuple):
                ends = list(out.get(name[0]))
                ends[name[1]] = value
                name, value = name[0], ends
            out = out.with_changes({name: value})
        elif Settings().get(key, unknown) is not unknown:
            out = out.with_changes({key: value})
        elif not any(key == u or key.startswith(u + ".") for u in UNREAD):
            raise KeyError(f"unknown setting {key}")
    return out
