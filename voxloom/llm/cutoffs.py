"""Score cutoffs per source that keep a wanted fraction of its rows."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.ranges import range_blocks


def cutoffs(df: DataFrame, source: str, score: str, fraction: str) -> DataFrame:
    """source, cutoff, n (its rows), kept: the highest score t with at least fraction of the rows at or above t.

    fraction is a decimal as text, above 0 and at most 1, taken exactly. Rows with a null source or score
    are no rows here; NaN is the highest score; tied scores are kept together; other columns aren't read; an
    empty input gives no row.

    Ties fold into one row with a count first, so that neither a source nor a score that holds a third of all
    rows makes a large task. The distinct (source, score) rows are range-sorted, counts per block and
    source are summed up over the blocks, which names the one block that holds a source's cutoff, and only
    the rows of that block are read in order.
    """
    part = Fraction(fraction)
    rows = df.select(F.col(source).alias("_g"), F.col(score).cast("double").alias("_x")).where("_g IS NOT NULL AND _x IS NOT NULL")
    ties = rows.groupBy("_g", "_x").agg(F.count("*").alias("_n"))
    blocks = range_blocks(ties, [F.col("_g"), F.col("_x").desc()])
    per = blocks.groupBy("_g", "_block").agg(F.sum("_n").alias("_m"))
    whole = Window.partitionBy("_g")
    upto = F.sum("_m").over(whole.orderBy("_block"))
    per = per.withColumn("_upto", upto).withColumn("_all", F.sum("_m").over(whole))
    need = F.expr(f"(_all * {part.numerator} + {part.denominator - 1}) div {part.denominator}")
    per = per.withColumn("_need", need).withColumn("_before", F.col("_upto") - F.col("_m"))
    target = per.where((F.col("_before") < F.col("_need")) & (F.col("_upto") >= F.col("_need")))
    inside = blocks.join(target, ["_g", "_block"]).withColumn("_run", F.col("_before") + F.sum("_n").over(Window.partitionBy("_g", "_block").orderBy(F.col("_x").desc())))
    row = inside.where((F.col("_run") >= F.col("_need")) & (F.col("_run") - F.col("_n") < F.col("_need")))
    return row.select(F.col("_g").alias(source), F.col("_x").alias("cutoff"), F.col("_all").alias("n"), F.col("_run").alias("kept"))


def below_cutoff(df: DataFrame, source: str, score: str, fraction: str) -> DataFrame:
    """Rows of df below their source's cutoff; all of df's columns. Null sources and scores have no cutoff."""
    found = cutoffs(df, source, score, fraction).select(F.col(source).alias("_g"), F.col("cutoff").alias("_t"))
    return df.join(found, (df[source] == F.col("_g")) & (df[score].cast("double") < F.col("_t"))).drop("_g", "_t")
