"""Near-duplicate texts within a speaker, kept greedily by quality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.order import mixed
from ..functions.text import by_row, first_of, gram_jaccard, gram_sign, text_grams
from ..session import shuffle_parts, stored

#: Counters of the sketch of how often grams are, and the slices in which it is summed. They choose which grams of a text
#: meet, but no result.
COUNTERS, SLICES = 1 << 21, 64
#: Parity signs of a set of up to WIDE grams, of which a larger one has twice as many.
BITS, WIDE = 128, 100


def similar_pairs(df: DataFrame, ident: str, group: str, text: str, threshold: str = "0.9") -> DataFrame:
    """(group, a, b, jaccard), a < b: ids of one group whose 5-gram sets are more similar than threshold.

    Copies of one text enter as one class, so that they never pair up; ids are those of the classes' least
    members. Null and empty texts have no pairs.
    """
    rows = df.select(F.struct(F.col(group).alias("v")).alias("_gk"), F.struct(F.col(ident).alias("v")).alias("_ik"), F.col(text).alias("_t"), gram_sign(F.col(text)).alias("_s")).where("_s.n > 0")
    sets = rows.groupBy("_gk", "_s").agg(F.min(F.struct("_ik", "_t")).alias("_m")).select("_gk", "_m._ik", "_m._t", F.monotonically_increasing_id().alias("_at"))
    pairs = similar_sets(stored(sets), "_ik", "_gk", threshold)
    return pairs.select(F.col("_gk.v").alias(group), F.col("a.v").alias("a"), F.col("b.v").alias("b"), "jaccard")


def dedup(df: DataFrame, ident: str, group: str, text: str, quality: str, order: str, threshold: str = "0.9") -> DataFrame:
    """df without rows for which a kept row of their group is too similar; best quality first, then order.

    order must be unique in a group (the place in the input). Copies keep their best row. The greedy
    choice runs over the pairs of differing texts only, in rounds of joins.
    """
    best = F.coalesce(F.nanvl(F.col(quality).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    # The place in the order as one sortable key: copies fold to their best row.
    rows = df.withColumn("_k", F.struct((-best).alias("q"), F.col(order).alias("o"))).withColumn("_s", gram_sign(F.col(text)))
    # Null speakers and ids are values of their own, as members of structs are equal when both are null; texts tell
    # apart records of one id.
    rows = rows.withColumns({"_gk": F.struct(F.col(group).alias("v")), "_ik": F.struct(F.col(ident).alias("v"), F.xxhash64("_s").alias("s"))})
    leads = rows.where("_s.n > 0").groupBy("_gk", "_s").agg(F.min(F.struct("_k", F.col("_ik").alias("i"), F.col(text).alias("t"))).alias("_m"))
    lead = stored(leads.select("_gk", "_m._k", F.col("_m.i").alias("_ik"), F.col("_m.t").alias("_t"), F.monotonically_increasing_id().alias("_at")))
    pairs = similar_sets(lead, "_ik", "_gk", threshold)
    k = lead.select("_gk", "_ik", "_k")
    ka, kb = k.withColumnsRenamed({"_ik": "a", "_k": "_ka"}), k.withColumnsRenamed({"_ik": "b", "_k": "_kb"})
    ranked = pairs.join(ka, ["_gk", "a"]).join(kb, ["_gk", "b"])
    first = F.when(F.col("_ka") < F.col("_kb"), F.struct(F.col("a").alias("win"), F.col("b").alias("lose"))).otherwise(F.struct(F.col("b").alias("win"), F.col("a").alias("lose")))
    gone = drop_losers(stored(ranked.select(F.col("_gk").alias("_g"), first.alias("_x")).select("_g", "_x.win", "_x.lose")))
    keep = lead.join(gone.select(F.col("_g").alias("_gk"), F.col("lose").alias("_ik")), ["_gk", "_ik"], "left_anti").select("_gk", "_ik", "_k")
    kept = rows.where("_s.n > 0").join(keep, ["_gk", "_ik", "_k"], "left_semi").unionByName(rows.where("_s.n = 0"))
    return kept.drop("_k", "_s", "_gk", "_ik")


def similar_sets(sets: DataFrame, ident: str, group: str, threshold: str) -> DataFrame:
    """As similar_pairs(), for a stored table of one text _t per distinct set, numbered by _at.

    Only a few grams of each text meet: a pair above the threshold shares one of the first (1 - threshold) share + 1 grams
    of its larger set and of the first (1 - threshold) / (1 + threshold) share + 1 of its smaller one, in any order that all
    texts of a group have in common: by how often they are, rare ones first, so common phrases join nothing. Of the pairs
    that meet, those whose parity signs differ in more places than their sets may have differing grams are left out where
    they meet. Sets are made again from the texts of those that remain.
    """
    t = float(threshold)
    texts = sets.select(F.col("_at").alias("_id"), F.xxhash64(group).alias("_g"), "_t")
    keys = texts.mapInArrow(_keys(_ranks(texts), t), "_k bigint, _b bigint, _c bigint, _d bigint, _e bigint, _id bigint, _n int")
    left, right = (keys.select(*[F.col(c).alias(f"{c}{x}") for c in keys.columns]) for x in "ab")
    na, nb = F.col("_na"), F.abs("_nb")
    both = _least(na + nb, t / (1 + t))
    b, c, d, e = (F.col(f"_{x}a").bitwiseXOR(F.col(f"_{x}b")) for x in "bcde")
    # Twice as many signs fold into those of a smaller set, which has no others.
    folded = F.bit_count(b.bitwiseXOR(d)) + F.bit_count(c.bitwiseXOR(e))
    apart = F.when((na > WIDE) == (nb > WIDE), F.bit_count(b) + F.bit_count(c) + F.bit_count(d) + F.bit_count(e)).otherwise(folded)
    # A negative size on the left fails here too; a condition on the left alone would keep the sides from sharing one shuffle.
    met = ((na < nb) | ((na == nb) & (F.col("_ida") < F.col("_idb")))) & (na >= _least(nb, t)) & (apart <= na + nb - 2 * both)
    # Keys are more than their texts let the planner expect: never broadcast.
    near = stored(left.hint("merge").join(right, (F.col("_ka") == F.col("_kb")) & met).select(F.col("_ida").alias("_i"), F.col("_idb").alias("_j")).distinct())
    some = sets.join(near.select(F.col("_i").alias("_at")).unionByName(near.select(F.col("_j").alias("_at"))), "_at", "left_semi")
    one, two = (some.select(F.col("_at").alias(at), F.col(group).alias(f"_g{at}"), F.col(ident).alias(f"_d{at}"), F.col("_t").alias(f"_t{at}")) for at in ("_i", "_j"))
    # Hashes of grams in two groups may be the same; two texts of one id are no pair.
    out = near.join(one, "_i").join(two, "_j").where((F.col("_g_i") == F.col("_g_j")) & (F.col("_d_i") != F.col("_d_j")))
    # Not deterministic: else it would be taken twice, for the filter and for the result.
    out = out.withColumn("jaccard", gram_jaccard.asNondeterministic()("_t_i", "_t_j")).where(F.col("jaccard") > t)
    return out.select(F.col("_g_i").alias(group), F.least("_d_i", "_d_j").alias("a"), F.greatest("_d_i", "_d_j").alias("b"), "jaccard")


def _least(n, share: float):
    """The least whole number above a share of n, or one less where rounding leaves it open."""
    return (F.floor(n * (share * (1 - 1e-12))) + 1).cast("int") if not isinstance(n, np.ndarray) else np.floor(n * (share * (1 - 1e-12))).astype(np.int64) + 1


def _grams(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Texts in slices, with (row, key) of each gram: a hash of group and gram."""
    for a in range(0, b.num_rows, 4096):
        part = b.slice(a, 4096)
        row, h = text_grams(part.column("_t"))
        yield part, row, mixed(h ^ part.column("_g").to_numpy().view(np.uint64)[row])


def _counter(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def _ranks(texts: DataFrame) -> np.ndarray:
    """By counter, how often its grams are: 16 bits that sort as the counts do, 0 for a gram that stands in one place only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, size = np.zeros(COUNTERS, np.int64), [], 0
        for b in batches:
            for _, _, key in _grams(b):
                waiting.append(_counter(key))
                size += len(key)
                # As many at a time as there are counters, as each count touches all of them.
                if size > COUNTERS:
                    held += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, size = [], 0
        if size:
            held += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        if held.any():
            # In as few bytes as the largest count needs.
            part = [x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in held.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(part)], names=["_i", "_n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, n in zip(b.column("_i").to_pylist(), b.column("_n").to_pylist(), strict=True):
                x = np.frombuffer(n, f"u{len(n) * SLICES // COUNTERS}").astype(np.int64)
                held[i] = held[i] + x if i in held else x
        # Exponent and 11 bits of the fraction.
        part = [(np.maximum(x, 1).astype(np.float32).view(np.int32) - 0x3F800000 >> 12).clip(0, 0xFFFF).astype(np.uint16).tobytes() for x in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(part, pa.binary())], names=["_i", "_n"])

    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint16)
    parts = min(SLICES, shuffle_parts(texts.sparkSession))
    for r in texts.mapInArrow(count, "_i int, _n binary").repartition(parts, "_i").mapInArrow(add, "_i int, _n binary").collect():
        out[r["_i"]] = np.frombuffer(r["_n"], np.uint16)
    return out.reshape(-1)


def _keys(ranks: np.ndarray, t: float):
    """A function of texts: a row for each of their first grams that stands in another place too, with the set's parity signs
    and size; the size is negative where the gram is first enough for the larger set of a pair only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, row, key in _grams(b):
                order = ranks[_counter(key)].astype(np.uint64) << np.uint64(48) | key >> np.uint64(16)
                by = by_row(row, order)
                new = first_of(row[by], key[by])
                row, key, order = row[by][new], key[by][new], order[by][new]
                n = np.bincount(row, minlength=part.num_rows)
                at = row * (2 * BITS) + (key & np.where(n > WIDE, np.uint64(2 * BITS - 1), np.uint64(BITS - 1))[row]).astype(np.int64)
                odd = np.bincount(at, minlength=part.num_rows * 2 * BITS) & 1
                signs = np.packbits(odd.astype(bool).reshape(-1, 2 * BITS), axis=1).view(np.int64)
                place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                long, short = n - _least(n, t) + 1, n - _least(n, 2 * t / (1 + t)) + 1
                first = (place < long[row]) & (order >> np.uint64(48) > 0)
                row, place = row[first], place[first]
                size = np.where(place < short[row], n[row], -n[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), *(pa.array(signs[row, i]) for i in range(4)), part.column("_id").take(pa.array(row)), pa.array(size)], names=["_k", "_b", "_c", "_d", "_e", "_id", "_n"])

    return run


def drop_losers(edges: DataFrame) -> DataFrame:
    """(_g, lose) that a greedy pass over edges (_g, win, lose) drops: a row is kept if no kept row beats it.

    Rounds of joins instead of a pass over a group: rows that nobody undecided beats are kept, those they beat are
    dropped, and so on; as many rounds as the longest chain of alternating decisions.
    """
    live, gone = edges, None
    while not live.isEmpty():
        beaten = live.select("_g", F.col("lose").alias("win")).distinct()
        kept = live.join(beaten, ["_g", "win"], "left_anti").select("_g", "win").distinct()
        out = stored(live.join(kept, ["_g", "win"], "left_semi").select("_g", "lose").distinct())
        gone = out if gone is None else gone.unionByName(out)
        live = live.join(out, ["_g", "lose"], "left_anti").join(out.select("_g", F.col("lose").alias("win")), ["_g", "win"], "left_anti")
        live = stored(live.select("_g", "win", "lose"))
    return gone if gone is not None else edges.select("_g", "lose")
