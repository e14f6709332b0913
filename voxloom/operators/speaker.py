"""Speaker consistency over windows of embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from ..config import Settings


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-12)


def unit(a: Column) -> Column:
    norm = F.sqrt(dot(a, a)) + 1e-12
    return F.transform(a, lambda x: x.cast("double") / norm)


def mean_vectors(df: DataFrame, keys: list[str], vector: str, out: str) -> DataFrame:
    """(*keys, out): the normalised mean of vectors per key; sums per dimension are taken before the shuffle."""
    flat = df.select(*keys, F.posexplode(vector).alias("_i", "_x"))
    dims = flat.groupBy(*keys, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    rows = dims.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda p: p["_m"]).alias("_v"))
    return rows.select(*keys, unit(F.col("_v")).alias(out))


def silhouette(vectors: np.ndarray) -> float:
    """Mean silhouette of two clusters by cosine distance, seeded by the farthest pair, after up to 8 refinements; vectors
    alone in their cluster don't count; 0 if there are not two clusters."""
    n = len(vectors)
    if n < 4:
        return 0.0
    v = vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-12)
    d = 1.0 - v @ v.T
    a, b = np.unravel_index(np.argmax(np.triu(d, 1)), d.shape)
    centres = v[[a, b]]
    label = np.zeros(n, int)
    for turn in range(8):
        new = (1.0 - v @ (centres / (np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12)).T).argmin(1)
        if turn and (new == label).all():
            break
        label = new
        if not 0 < label.sum() < n:
            return 0.0
        centres = np.stack([v[label == k].mean(0) for k in (0, 1)])
    size = np.bincount(label, minlength=2)
    sums = np.stack([d[:, label == k].sum(1) for k in (0, 1)], 1)
    own, other = sums[np.arange(n), label], sums[np.arange(n), 1 - label]
    inner, outer = own / np.maximum(size[label] - 1, 1), other / size[1 - label]
    score = (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-12)
    counted = size[label] > 1
    return float(score[counted].mean()) if counted.any() else 0.0


@F.pandas_udf(DoubleType())
def silhouette_udf(windows: pd.Series) -> pd.Series:
    return pd.Series([silhouette(np.array([np.asarray(x, float) for x in w])) if w is not None and len(w) else 0.0 for w in windows])


def consistency(windows: DataFrame, utt: str, order: str, label: str, vector: str, s: Settings) -> DataFrame:
    """(utt, label, n_windows, silhouette, max_dist_to_center, max_neighbor_delta, ref_outlier_ratio, reasons) per utterance.

    windows: one row per window of an utterance. Centres of labels with one utterance don't count.
    """
    t = s.get("speaker")
    own = mean_vectors(windows, [utt, label], vector, "_own")
    several = own.groupBy(label).agg(F.count("*").alias("_u")).where("_u >= 2").select(label)
    centre = mean_vectors(own.join(several, label, "left_semi"), [label], "_own", "_centre")
    rows = windows.join(own, [utt, label]).join(centre, label, "left")
    w = Window.partitionBy(utt, label).orderBy(order)
    rows = rows.withColumn("_d", F.when(F.lag(vector).over(w).isNotNull(), cosine_distance(F.lag(vector).over(w), F.col(vector))))
    twice = (F.col("_d") > t["consecutive_delta"]) & (F.lag("_d").over(w) > t["consecutive_delta"])
    far = F.when(F.col("_centre").isNotNull(), (cosine_distance(F.col(vector), F.col("_centre")) > t["max_dist_to_center"]).cast("double"))
    rows = rows.withColumns({"_twice": twice, "_far": far, "_from": cosine_distance(F.col(vector), F.col("_own"))})
    per = rows.groupBy(utt, label).agg(
        F.count("*").alias("n_windows"), F.max("_from").alias("max_dist_to_center"), F.coalesce(F.max("_d"), F.lit(0.0)).alias("max_neighbor_delta"),
        F.coalesce(F.max("_twice"), F.lit(False)).alias("_two"), F.coalesce(F.avg("_far"), F.lit(0.0)).alias("ref_outlier_ratio"),
        F.transform(F.array_sort(F.collect_list(F.struct(order, vector))), lambda x: x[vector]).alias("_all"))
    per = per.withColumn("silhouette", silhouette_udf("_all")).drop("_all")
    few = F.col("n_windows") < t["min_windows"]
    rules = F.array_compact(F.array(
        F.when(F.col("silhouette") > t["silhouette"], "spk_A"), F.when(F.col("max_dist_to_center") > t["max_dist_to_center"], "spk_B"),
        F.when((F.col("max_neighbor_delta") > t["max_neighbor_delta"]) | F.col("_two"), "spk_C"), F.when(F.col("ref_outlier_ratio") > t["ref_outlier_ratio"], "spk_D")))
    per = per.withColumn("reasons", F.when(few, F.array(F.lit("spk_too_few_windows"))).otherwise(rules)).drop("_two")
    return per.withColumns({c: F.when(few, 0.0).otherwise(F.col(c)) for c in ("silhouette", "max_dist_to_center", "max_neighbor_delta", "ref_outlier_ratio")})
