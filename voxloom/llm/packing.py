"""Documents packed into training sequences of fixed length."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored

#: Items that one packing task holds. More items mean more tasks, never a larger one; the open sequences that
#: a task leaves are a vanishing share of those it fills.
SHARD = 50_000
#: Where the tokenizer's vocabulary lies, unless a parameter says otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the public byte-level tokenizer splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, ident: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(ident, n_tokens) of rows with a non-empty text. The file must be at one path on all machines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) for t in b.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_d"), pa.array(sizes, pa.int64())], names=[ident, "n_tokens"])

    rows = df.select(F.col(ident).alias("_d"), F.col(text).alias("_t")).where("_d IS NOT NULL AND _t <> ''")
    return rows.mapInArrow(run, f"`{ident}` {df.schema[ident].dataType.simpleString()}, n_tokens long")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container and offset of each item, in the order given; sizes are between 1 and capacity.

    Sum-of-squares packing: with N[h] open containers filled to level h, an item goes to the level (or into a
    new container) that makes the sum of the squares of N least. Among equals the fullest level wins.
    """
    n_at = np.zeros(capacity + 1, np.int64)  # containers filled to each level; 0 and capacity aren't open
    waiting: list[list[int]] = [[] for _ in range(capacity)]
    container, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    made = 0
    for i, s in enumerate(sizes.tolist()):
        top = capacity - s
        # Moving a container from h to h + s changes the sum by 2 (N[h + s] - N[h] + 1); the constant is left out.
        change = n_at[s:] - n_at[: top + 1]
        change[top] -= 1 if top else 0  # a full container leaves the sum
        change[n_at[: top + 1] == 0] = np.iinfo(np.int64).max
        change[0] = n_at[s] if top else -1  # a new container: N[s] grows, nothing shrinks
        level = top - int(change[::-1].argmin())
        if level:
            c = waiting[level].pop()
            n_at[level] -= 1
        else:
            c, made = made, made + 1
        container[i], offset[i] = c, level
        if level + s < capacity:
            waiting[level + s].append(c)
            n_at[level + s] += 1
    return container, offset


def pack(sizes: DataFrame, ident: str, size: str, capacity: int, shard: int = SHARD) -> DataFrame:
    """(ident, piece, container, offset, length): where each item's pieces lie.

    An item longer than the capacity is cut into full containers and a rest, any other stays whole, and no
    container holds more than its capacity. Rows with a null id, or a null or non-positive size, fill nothing;
    rows with one id are one item each time they occur; other columns aren't read. An empty input has an
    empty result. The result depends on ids and sizes only, not on how rows are partitioned: items are dealt to
    shards by a hash of the id (as many shards as `shard` rows each need) and packed in the order of hash, id and
    size. Full pieces never meet the packer.
    """
    rows = sizes.select(F.col(ident).alias("_d"), F.col(size).cast("long").alias("_n")).where("_d IS NOT NULL AND _n > 0")
    rows = stored(rows)
    shards = max(1, -(-rows.count() // shard))
    full, rest = F.expr(f"_n div {capacity}"), F.expr(f"_n % {capacity}")
    name = F.col("_d").cast("string")
    # Equal rows are interchangeable: they fold into one with a count, so that every full container has a name of its own.
    alike = rows.where(full > 0).groupBy("_d", "_n").agg(F.count("*").alias("_copies"))
    whole = alike.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))).select("_d", "_n", "_copy", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"))
    whole = whole.select("_d", "piece", F.concat_ws("-", F.lit("f"), name, "_n", "_copy", "piece").alias("container"), F.lit(0).cast("long").alias("offset"), F.lit(capacity).cast("long").alias("length"))
    kind = rows.schema["_d"].dataType.simpleString()
    mixed = F.xxhash64("_d")
    small = rows.where(rest > 0).select("_d", full.alias("piece"), rest.alias("length"), F.pmod(mixed, F.lit(shards)).cast("int").alias("_shard"), mixed.alias("_o"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One shard at a time, as they come in order.
        held: list[pa.RecordBatch] = []
        for b in batches:
            shard_of = b.column("_shard").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(shard_of)) + 1, len(shard_of)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column("_shard")[0].as_py() != shard_of[x]:
                    yield packed_shard(held)
                    held = []
                held.append(b.slice(x, y - x))
        if held:
            yield packed_shard(held)

    def packed_shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(held)
        container, offset = sum_of_squares(part.column("length").to_numpy(), capacity)
        shard_of = part.column("_shard")[0].as_py()
        names = pa.array([f"s-{shard_of}-{c}" for c in container])
        columns = [part.column("_d").combine_chunks(), part.column("piece").combine_chunks(), names, pa.array(offset), part.column("length").combine_chunks()]
        return pa.RecordBatch.from_arrays(columns, names=["_d", "piece", "container", "offset", "length"])

    packed = small.repartition(shards, "_shard").sortWithinPartitions("_shard", "_o", "_d", "length").mapInArrow(run, f"_d {kind}, piece long, container string, offset long, length long")
    return whole.unionByName(packed).withColumnRenamed("_d", ident)
