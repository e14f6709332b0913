"""Manifests, splits and audio to files."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.signal import encode_wav


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder of JSON lines per split."""
    df.write.mode("overwrite").partitionBy("split").json(path)


def write_audio(df: DataFrame, path: str, samples: str, rate: str, folder: str) -> DataFrame:
    """Writes 16-bit WAV files to a folder that all workers share; returns (path, bytes). Written twice is written once."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sizes = []
            for name, x, r in zip(part["p"], part["x"], part["r"], strict=True):
                target = Path(folder, name)
                target.parent.mkdir(parents=True, exist_ok=True)
                content = encode_wav(np.asarray(x, np.float32), int(r))
                # Under another name first, so that a task that runs again never leaves half a file.
                half = target.with_suffix(".part")
                half.write_bytes(content)
                half.replace(target)
                sizes.append(len(content))
            yield pd.DataFrame({"path": part["p"], "bytes": sizes})

    return df.select(F.col(path).alias("p"), F.col(samples).alias("x"), F.col(rate).alias("r")).mapInPandas(run, "path string, bytes long")


def moved_paths(df: DataFrame, columns: list[str], old: str, new: str) -> DataFrame:
    """Paths below old as paths below new."""
    return df.withColumns({c: F.when(F.col(c).startswith(old), F.concat(F.lit(new), F.substring(c, len(old) + 1, 1 << 30))).otherwise(F.col(c)) for c in columns})
