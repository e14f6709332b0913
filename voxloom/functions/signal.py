"""Signal measures on mono samples in [-1, 1] (NumPy), and their vectorised wrappers."""

from __future__ import annotations

import io
import math
import wave

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Samples, averaged over channels, and sample rate of a PCM WAV file of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as w:
        rate, channels, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
        raw = np.frombuffer(w.readframes(w.getnframes()), np.uint8)
    if width == 1:
        x = (raw.astype(np.float32) - 128) / 128
    elif width == 3:
        b = raw.reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / (1 << 23)
    else:
        x = raw.view(np.int16 if width == 2 else np.int32).astype(np.float32) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(1).astype(np.float32), rate


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation to round(N x target / rate) samples; one sample or none gives none."""
    if rate == target or not len(x):
        return np.asarray(x, np.float32)
    n = round(len(x) * target / rate)
    if n <= 1:
        return np.zeros(0, np.float32)
    return np.interp(np.arange(n) * (len(x) / n), np.arange(len(x)), x).astype(np.float32)


def slice_audio(x: np.ndarray, rate: int, start: float, end: float) -> np.ndarray:
    """Samples from start to end seconds, bounds cut to whole samples and to the recording."""
    return x[max(0, int(start * rate)) : min(len(x), max(0, int(end * rate)))]


def lufs(x: np.ndarray, rate: int) -> float | None:
    """Integrated loudness by ITU-R BS.1770: K-weighted power of 400 ms blocks every 100 ms, those below -70 and those more
    than 10 below the mean of the rest left out. Null for less than a block. The weighting is taken from the filters'
    response at each frequency of a block's spectrum.
    """
    size, hop = int(0.4 * rate), int(0.1 * rate)
    if len(x) < size or hop < 1:
        return None
    response = np.abs(_k_response(rate, size)) ** 2
    response[1 : -1 if size % 2 == 0 else None] *= 2
    blocks = np.lib.stride_tricks.sliding_window_view(np.asarray(x, np.float64), size)[::hop]
    power = np.concatenate([(np.abs(np.fft.rfft(blocks[a : a + 256], axis=1)) ** 2 @ response) / size**2 for a in range(0, len(blocks), 256)])

    def level(p: np.ndarray) -> float:
        return -0.691 + 10 * float(np.log10(p.mean())) if len(p) and p.mean() > 0 else -math.inf

    loud = power[power > 10 ** ((-70 + 0.691) / 10)]
    if not len(loud):
        return -math.inf
    return level(loud[loud > 10 ** ((level(loud) - 10 + 0.691) / 10)])


def _k_response(rate: int, size: int) -> np.ndarray:
    """Response of the shelf and the high pass of BS.1770 at the frequencies of a spectrum."""
    z = np.exp(-2j * np.pi * np.arange(size // 2 + 1) / size)

    def ratio(b: tuple, a: tuple) -> np.ndarray:
        return (b[0] + b[1] * z + b[2] * z**2) / (a[0] + a[1] * z + a[2] * z**2)

    # Gain, quality and corner frequency of the standard's two stages.
    gain, q, corner = 3.999843853973347, 0.7071752369554196, 1681.974450955533
    k, v = math.tan(math.pi * corner / rate), 10 ** (gain / 20)
    w = v**0.4996667741545416
    shelf = ratio((v + w * k / q + k * k, 2 * (k * k - v), v - w * k / q + k * k), (1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k))
    q, corner = 0.5003270373238773, 38.13547087602444
    k = math.tan(math.pi * corner / rate)
    return shelf * ratio((1, -2, 1), (1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k))


def snr_db(x: np.ndarray) -> float:
    """Energy of frames at or above P70 over P30 of the quieter ones, in dB, 40 at most; 0 for silence."""
    if not len(x) or np.abs(x).max() < 1e-9:
        return 0.0
    size = max(1, len(x) // 1000)
    e = (np.asarray(x[: len(x) // size * size], np.float64).reshape(-1, size) ** 2).mean(1)
    p70 = np.percentile(e, 70)
    quiet = e[(e > 0) & (e < p70)]
    if not len(quiet):
        return 40.0
    return float(min(40.0, 10 * np.log10(e[e >= p70].mean() / (np.percentile(quiet, 30) + 1e-12))))


def peak_db(x: np.ndarray) -> float:
    top = float(np.abs(x).max()) if len(x) else 0.0
    return 20 * float(np.log10(top)) if top > 0 else -120.0


def clipping_ratio(x: np.ndarray) -> float:
    return float((np.abs(x) >= 0.99).mean()) if len(x) else 0.0


def bandwidth_hz(x: np.ndarray, rate: int, share: float = 0.95) -> float:
    """Frequency below which share of the power of the middle 8 s at most lies."""
    most = 8 * rate
    if len(x) > most:
        a = (len(x) - most) // 2
        x = x[a : a + most]
    if not len(x):
        return 0.0
    n = 1 << (len(x) - 1).bit_length() if len(x) > 1 else 1
    power = np.abs(np.fft.rfft(np.asarray(x, np.float64), n)) ** 2
    total = np.cumsum(power)
    if total[-1] <= 0:
        return 0.0
    return float(np.fft.rfftfreq(n, 1 / rate)[min(np.searchsorted(total, share * total[-1]), len(power) - 1)])


def speech_spans(x: np.ndarray, rate: int, frame_ms: float = 30.0, factor: float = 1.5, percentile: float = 5.0) -> list[tuple[float, float]]:
    """Runs of frames whose level is above factor x percentile (1e-4 at least), in seconds."""
    size = max(1, int(rate * frame_ms / 1000))
    n = len(x) // size
    if not n:
        return []
    level = np.sqrt((np.asarray(x[: n * size], np.float64).reshape(n, size) ** 2).mean(1) + 1e-12)
    on = np.r_[0, (level > max(factor * np.percentile(level, percentile), 1e-4)).astype(np.int8), 0]
    edges = np.flatnonzero(np.diff(on))
    return [(a * size / rate, b * size / rate) for a, b in edges.reshape(-1, 2)]


def overlapping_speech(x: np.ndarray, rate: int) -> list[tuple[float, float]]:
    """Runs of 25 ms frames every 10 ms whose level is above 1.2 x P30 (1e-4 at least), those below 200 ms left out."""
    size, hop = int(0.025 * rate), int(0.010 * rate)
    if len(x) < size:
        return []
    sums = np.r_[0, np.cumsum(np.asarray(x, np.float64) ** 2)]
    at = np.arange(1 + (len(x) - size) // hop) * hop
    level = np.sqrt((sums[at + size] - sums[at]) / size + 1e-12)
    on = np.r_[0, (level > max(1e-4, np.percentile(level, 30) * 1.2)).astype(np.int8), 0]
    edges = np.flatnonzero(np.diff(on)).reshape(-1, 2)
    # A run that lasts to the last frame lasts to the last sample.
    ends = np.where(edges[:, 1] == len(at), len(x), edges[:, 1] * hop)
    return [(a * hop / rate, b / rate) for a, b in zip(edges[:, 0], ends) if b - a * hop >= 0.2 * rate]


def pitch_track(x: np.ndarray, rate: int, low: float = 60.0, high: float = 600.0, hop_ms: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """F0 (0 where unvoiced) and confidence per hop, by the peak of the normalised autocorrelation of 40 ms windows.

    Frames below a tenth of the recording's level, or with a peak below 0.3, are unvoiced.
    """
    low, high = max(30.0, low), min(500.0, high)
    hop = max(1, round(rate * hop_ms / 1000))
    size = max(round(rate * 0.04), 2 * hop)
    none = np.zeros(1, np.float32)
    if len(x) < size:
        return none, none.copy()
    x = np.asarray(x, np.float64)
    quiet = max(1e-4, 0.1 * math.sqrt(float((x * x).mean()) + 1e-12))
    short, long_ = max(2, int(rate / high)), min(int(rate / low), size - 1)
    every = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    f0, confidence = np.zeros(len(every), np.float32), np.zeros(len(every), np.float32)
    if long_ <= short:
        return f0, confidence
    for a in range(0, len(every), 1024):
        frames = every[a : a + 1024]
        frames = frames - frames.mean(1, keepdims=True)
        ac = np.fft.irfft(np.abs(np.fft.rfft(frames, 2 * size, axis=1)) ** 2, axis=1)[:, : long_ + 1]
        at = ac[:, short:].argmax(1) + short
        peak = ac[np.arange(len(at)), at] / (ac[:, 0] + 1e-12)
        voiced = (peak >= 0.3) & (np.sqrt((frames**2).mean(1) + 1e-12) >= quiet)
        f0[a : a + 1024] = np.where(voiced, rate / at, 0.0)
        confidence[a : a + 1024] = np.where(voiced, np.clip(peak, 0, 1), 0.0)
    return f0, confidence


def octave_corrected(f0: np.ndarray, low: float, high: float) -> np.ndarray:
    """Octave errors undone, what can't be undone unvoiced: from four voiced frames on first those more than six semitones
    off the mode of log2 F0, then those as far off the voiced frame before; at last those outside the range."""
    out = np.asarray(f0, np.float64).copy()
    voiced = np.flatnonzero(out > 0)
    if len(voiced) >= 4:
        counts, edges = np.histogram(np.log2(out[voiced]), bins=120)
        mode = (edges[counts.argmax()] + edges[counts.argmax() + 1]) / 2
        far = voiced[np.abs(12 * (np.log2(out[voiced]) - mode)) > 6]
        tried = out[far, None] * np.array([1.0, 2.0, 0.5, 4.0, 0.25])
        off = np.abs(np.log2(tried) - mode)
        best = off.argmin(1)
        out[far] = np.where(12 * off[np.arange(len(far)), best] <= 6, tried[np.arange(len(far)), best], 0.0)
    before = 0.0
    for i in np.flatnonzero(out > 0):
        if before > 0 and abs(12 * math.log2(out[i] / before)) > 6:
            best = min((out[i] * k for k in (1.0, 2.0, 0.5)), key=lambda v: abs(math.log2(v / before)))
            out[i] = best if abs(12 * math.log2(best / before)) <= 4 else 0.0
        before = out[i] or before
    return np.where((out >= low) & (out <= high), out, 0.0).astype(np.float32)


MEASURES = StructType([
    StructField("duration_sec", DoubleType()), StructField("native_sr", IntegerType()), StructField("snr_db", DoubleType()), StructField("peak_db", DoubleType()),
    StructField("clipping_ratio", DoubleType()), StructField("effective_bw_hz", DoubleType()), StructField("lufs", DoubleType()), StructField("error", StringType()),
])


def measures(content: bytes) -> tuple:
    """One row of MEASURES."""
    try:
        x, rate = decode_wav(content)
        return len(x) / rate, rate, snr_db(x), peak_db(x), clipping_ratio(x), bandwidth_hz(x, rate), lufs(x, rate), None
    except Exception as e:
        return (None,) * 7 + (f"sf_info_failed:{type(e).__name__}",)


@F.pandas_udf(MEASURES)
def measured(content: pd.Series) -> pd.DataFrame:
    """Measures of WAV files; a file that can't be read gives nulls and an error, never a failed task."""
    return pd.DataFrame([measures(bytes(c)) for c in content], columns=MEASURES.names)
