"""Audio files read where they are needed: paths go in, measures, spans and tracks come out; samples never enter a row.

How a file's bytes are had is a function of its path, so that any shared storage will do; functions travel to the workers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions import signal as G

Load = Callable[[str], bytes]
SPANS = "array<struct<start:double,end:double>>"


def local_file(path: str) -> bytes:
    """The file's bytes from a folder that all workers share."""
    return Path(path.removeprefix("file://").removeprefix("file:")).read_bytes()


def _each(kind: str, empty: dict, load: Load, work: Callable):
    """A function of columns to a struct: work(bytes, the other values) of each row; its `error` tells what went wrong."""

    @F.pandas_udf(f"struct<{kind},error:string>")
    def run(*columns: pd.Series) -> pd.DataFrame:
        rows = []
        for path, *rest in zip(*columns, strict=True):
            try:
                rows.append(work(load(path), *rest) | {"error": None})
            except FileNotFoundError:
                rows.append(empty | {"error": "missing"})
            except Exception as e:
                rows.append(empty | {"error": f"{type(e).__name__}"})
        return pd.DataFrame(rows, columns=[*empty, "error"])

    return run


def hashed(load: Load = local_file):
    """(audio_hash, error) of a path: first 16 hex digits of the SHA-256."""
    return _each("audio_hash:string", {"audio_hash": ""}, load, lambda b: {"audio_hash": hashlib.sha256(b).hexdigest()[:16]})


def probed(load: Load = local_file):
    """The measures of a path; error as read_failed or sf_info_failed would have it."""
    names = [n for n in G.MEASURES.names if n != "error"]
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in G.MEASURES.fields if f.name != "error")

    def work(b: bytes) -> dict:
        *values, error = G.measures(b)
        if error:
            raise ValueError(error)
        return dict(zip(names, values, strict=True))

    return _each(kinds, dict.fromkeys(names), load, work)


def speech_of(load: Load = local_file, find: Callable = G.speech_spans):
    """(total, spans) of a path: its seconds, and its speech by find(samples, rate)."""

    def work(b: bytes) -> dict:
        x, rate = G.decode_wav(b)
        return {"total": len(x) / rate, "spans": [{"start": float(a), "end": float(e)} for a, e in find(x, rate)]}

    return _each(f"total:double,spans:{SPANS}", {"total": None, "spans": None}, load, work)


def resampled(folder: str, rates: tuple[int, int], load: Load = local_file):
    """(train, align) paths of a path and an id, written below folder at two sample rates; written again is written once."""

    def work(b: bytes, name: str) -> dict:
        x, rate = G.decode_wav(b)
        out = {}
        for key, target in zip(("train", "align"), rates, strict=True):
            at = Path(folder, f"audio_{key}", f"{name}.wav")
            at.parent.mkdir(parents=True, exist_ok=True)
            half = at.with_suffix(".part")
            half.write_bytes(G.encode_wav(G.resample(x, rate, target), target))
            half.replace(at)
            out[key] = str(at)
        return out

    return _each("train:string,align:string", {"train": None, "align": None}, load, work)


def pitch_of(low: float, high: float, hop_ms: float, load: Load = local_file, track: Callable = G.pitch_track):
    """(f0, confidence) per hop of a path, octave errors undone."""

    def work(b: bytes) -> dict:
        x, rate = G.decode_wav(b)
        f0, confidence = track(x, rate, low, high, hop_ms)
        return {"f0": G.octave_corrected(f0, low, high).tolist(), "confidence": np.asarray(confidence, np.float32).tolist()}

    return _each("f0:array<float>,confidence:array<float>", {"f0": None, "confidence": None}, load, work)


@F.pandas_udf(ArrayType(FloatType()))
def reclamped(f0: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
    """Tracks narrowed to a speaker's own range, with octave errors undone again."""
    out = []
    for x, a, b in zip(f0, low, high, strict=True):
        x = np.asarray(x if x is not None else [], np.float32)
        out.append(G.octave_corrected(np.where((x >= a) & (x <= b), x, 0), a, b).tolist())
    return pd.Series(out)


def on_slices(kind: str, work: Callable, load: Load = local_file):
    """A function of (path, start, end, text) columns: work(list of (samples, rate, text)) of all slices in a batch, one value
    of the given type each. A slice that can't be read, and all of a batch whose work fails, are null."""

    @F.pandas_udf(f"struct<value:{kind},error:string>")
    def run(path: pd.Series, start: pd.Series, end: pd.Series, text: pd.Series) -> pd.DataFrame:
        slices, errors, held = [], [], {}
        for p, a, b, t in zip(path, start, end, text, strict=True):
            try:
                if p not in held:
                    held = {p: G.decode_wav(load(p))}
                x, rate = held[p]
                slices.append((G.slice_audio(x, rate, a, b), rate, t))
                errors.append(None)
            except Exception as e:
                slices.append(None)
                errors.append("missing" if isinstance(e, FileNotFoundError) else type(e).__name__)
        good = [s for s in slices if s is not None]
        try:
            values = iter(work(good) if good else [])
            out = [next(values) if s is not None else None for s in slices]
        except Exception as e:
            out, errors = [None] * len(slices), [x or f"{type(e).__name__}" for x in errors]
        return pd.DataFrame({"value": pd.Series(out, dtype=object), "error": errors})

    return run
