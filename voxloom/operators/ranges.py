"""Range blocks: a globally sorted layout that later steps can address block by block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, shuffle_parts


def range_blocks(df: DataFrame, order: list[Column], parts: int | None = None, block: str = "_block") -> DataFrame:
    """df range-partitioned by order, each row with the number of its block; blocks follow the order.

    The result is cut, as block numbers depend on a sample and must not change when a task runs again.
    Rows that are equal in every order column share a block: aggregate such ties first.
    """
    n = parts or shuffle_parts(df.sparkSession)
    return cut(df.repartitionByRange(n, *order).withColumn(block, F.spark_partition_id()))


def running_total(blocks: DataFrame, order: list[Column], weight: str, out: str, keys: tuple[str, ...] = (), block: str = "_block") -> DataFrame:
    """Running total of weight in the order of range_blocks (per keys), this row included.

    No task sees more than one block: totals a block and key are summed over the preceding blocks
    (a table of at most blocks x keys rows) and added to the running total inside the block.
    """
    per = blocks.groupBy(*keys, block).agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, block, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hit = [blocks[k].eqNullSafe(per[k]) for k in keys] + [blocks[block] == per[block]]
    joined = blocks.join(per, hit, "inner").drop(*[per[k] for k in keys], per[block])
    return joined.withColumn(out, F.col("_before") + F.sum(weight).over(inside)).drop("_before")
