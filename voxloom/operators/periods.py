"""Continuous periods and gaps of many overlapping intervals (a mergeable aggregate of disjoint lists)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Length of a time block in the units of the bounds. A list of disjoint intervals with whole bounds that
#: start in one block has at most half as many entries, whatever the number of rows.
BLOCK = 3_600_000
FAN_IN = 32


def union_of_sorted(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint, non-touching intervals per group, in order. Groups are whole numbers from 0."""
    if not len(start):
        return group, start, end
    by = np.lexsort((start, group))
    group, start, end = group[by], start[by], end[by]
    head = np.r_[True, group[1:] != group[:-1]]
    # Shift every group behind the one before it, so that one running maximum serves all of them.
    low = np.minimum.reduceat(start, np.flatnonzero(head))
    high = np.maximum.reduceat(end, np.flatnonzero(head))
    shift = (np.r_[0, np.cumsum(high - low + 2)[:-1]] - low)[np.cumsum(head) - 1]
    s, e = start + shift, np.maximum.accumulate(end + shift)
    new = np.r_[True, s[1:] > e[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]
    return group[new], start[new], e[last] - shift[new]


def _merge_lists(keys: list[str], schema: pa.Schema):
    """A mapInArrow function: lists of one (key, block, salt) in a partition become one disjoint list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        names, enough = [*keys, "_block"], 2_000_000
        for batch in batches:
            part = pa.Table.from_batches([batch])
            starts, ends = part.column("_s").combine_chunks(), part.column("_e").combine_chunks()
            lengths = np.diff(starts.offsets.to_numpy())
            flat = part.select(names).take(pa.array(np.repeat(np.arange(len(lengths)), lengths)))
            flat = flat.append_column("_s", pa.chunked_array([starts.flatten()])).append_column("_e", pa.chunked_array([ends.flatten()]))
            held = flat if held is None else pa.concat_tables([held, flat])
            if held.num_rows > enough:
                # What is left may be as much: only twice that is folded again, so that the work stays in proportion.
                held = _disjoint(held, names)
                enough = max(2_000_000, 2 * held.num_rows)
        if held is None or not held.num_rows:
            return
        held = _disjoint(held, names)
        group = _group_ids(held, names)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        offsets = pa.array(np.r_[first, len(group)].astype(np.int32))
        out = held.select(names).take(pa.array(first))
        arrays = [out.column(n).combine_chunks().cast(schema.field(n).type) for n in names]
        arrays += [pa.ListArray.from_arrays(offsets, held.column(c).combine_chunks()) for c in ("_s", "_e")]
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, "_s", "_e"])

    return run


def _group_ids(table: pa.Table, names: list[str]) -> np.ndarray:
    ids = np.zeros(table.num_rows, np.int64)
    for n in names:
        codes = table.column(n).combine_chunks().dictionary_encode(null_encoding="encode")
        codes = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.unique(ids * (codes.max() + 1) + codes, return_inverse=True)[1]
    return ids


def _disjoint(table: pa.Table, names: list[str]) -> pa.Table:
    group = _group_ids(table, names)
    first = np.unique(group, return_index=True)[1]
    g, s, e = union_of_sorted(group, table.column("_s").to_numpy(), table.column("_e").to_numpy())
    return table.select(names).take(pa.array(first[g])).append_column("_s", pa.array(s)).append_column("_e", pa.array(e))


def speech_periods(df: DataFrame, keys: list[str], start: Column, end: Column, block: int = BLOCK) -> DataFrame:
    """The longest covered stretches per key, and the holes between them: keys, kind, start, end.

    start and end are whole numbers; touching intervals join. Rows with a null bound or key, or with
    end <= start, are ignored; an empty input has an empty result; repeated, nested and tied rows change
    nothing; other columns of df, whatever their names, are not read.

    Each input partition first folds its rows into one sorted list of disjoint intervals per key and time
    block, the lists merge in two levels (salted, then whole), and a scan over one row per key and
    block carries the running end across blocks. So a key that owns a third of all rows is spread over all
    tasks, and what any task holds of it is bounded by the block length, not by the rows.
    """
    plain = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(p) for k, p in zip(keys, plain)], start.cast("long").alias("_a"), end.cast("long").alias("_b"))
    rows = rows.where((F.col("_b") > F.col("_a")) & F.expr(" AND ".join(f"{p} IS NOT NULL" for p in plain)))
    rows = rows.select(*plain, F.floor(F.col("_a") / block).cast("long").alias("_block"), F.array("_a").alias("_s"), F.array("_b").alias("_e"))
    kinds = ", ".join(f"{p} {rows.schema[p].dataType.simpleString()}" for p in plain)
    ddl = f"{kinds}, _block long, _s array<long>, _e array<long>"
    from pyspark.sql.pandas.types import to_arrow_schema

    merge = _merge_lists(plain, to_arrow_schema(rows.schema))
    spark = df.sparkSession
    part = rows.mapInArrow(merge, ddl)
    salt = F.pmod(F.spark_partition_id(), F.lit(FAN_IN))
    part = part.withColumn("_salt", salt).repartition(*plain, "_block", "_salt").drop("_salt").mapInArrow(merge, ddl)
    part = part.repartition(*plain, "_block").mapInArrow(merge, ddl)

    over = Window.partitionBy(*plain).orderBy("_block")
    carry = F.max(F.array_max("_e")).over(over.rowsBetween(Window.unboundedPreceding, -1))
    part = part.withColumn("_carry", carry)
    # A block's pieces are sorted, so those that the carried end reaches are a prefix of the list.
    held = F.when(F.col("_carry").isNull(), F.lit(0)).otherwise(F.size(F.filter("_s", lambda x: x <= F.col("_carry"))))
    part = part.withColumn("_held", held)
    part = part.withColumn("_closed", F.when(F.col("_held") > 0, F.greatest("_carry", F.element_at("_e", F.col("_held")))).otherwise(F.col("_carry")))
    part = part.withColumn("_final", F.max(F.array_max("_e")).over(Window.partitionBy(*plain)))
    part = part.where(F.size("_s") > F.col("_held"))
    part = part.withColumn("_n", F.size("_s") - F.col("_held"))
    part = part.withColumn("_s", F.slice("_s", F.col("_held") + 1, F.col("_n"))).withColumn("_e", F.slice("_e", F.col("_held") + 1, F.col("_n")))
    close = F.coalesce(F.lead("_closed").over(over), F.col("_final"))
    part = part.withColumn("_next", F.lead(F.element_at("_s", 1)).over(over))
    part = part.withColumn("_e", F.concat(F.slice("_e", 1, F.col("_n") - 1), F.array(F.greatest(F.element_at("_e", -1), close))))
    periods = F.arrays_zip(F.col("_s").alias("s"), F.col("_e").alias("e"))
    periods = F.transform(periods, lambda x: F.struct(F.lit("period").alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    after = F.concat(F.slice("_s", 2, F.col("_n")), F.when(F.col("_next").isNotNull(), F.array("_next")).otherwise(F.array().cast("array<bigint>")))
    gaps = F.zip_with("_e", after, lambda e, s: F.struct(F.lit("gap").alias("kind"), e.alias("start"), s.alias("end")))
    gaps = F.filter(gaps, lambda g: g["end"].isNotNull())
    out = part.select(*plain, F.explode(F.concat(periods, gaps)).alias("_x"))
    return out.select(*[F.col(p).alias(k) for p, k in zip(plain, keys)], "_x.kind", "_x.start", "_x.end")
