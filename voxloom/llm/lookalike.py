"""One form for texts that look alike."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .codepoints import from_arrow, seen, to_arrow


def _free(name: str, taken: list[str]) -> str:
    """A column name that isn't taken."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column's texts become their forms."""
    for b in batches:
        t = b.columns[-1]
        form = to_arrow(*seen(*from_arrow(t)))
        if t.null_count:
            form = pc.if_else(t.is_null(), pa.scalar(None, pa.string()), form)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], form], names=b.schema.names)


def with_form(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with one more column: text's form, equal for texts that look alike and only for them.

    Null stays null; blanks at the ends and signs without visible shape go, so a text of nothing else becomes
    empty; letter case, accents, digits and double blanks stay. Very long texts are handled whole. A column
    named out is replaced.
    """
    made = _free("_form", df.columns)
    rows = df.withColumn(made, F.col(text).cast("string"))
    rows = rows.drop(out) if out in df.columns else rows
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_forms, ddl).withColumnRenamed(made, out)


def alike_classes(df: DataFrame, ident: str, text: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, class, id, text), distinct: records whose text looks like another one that isn't equal, within the same by; those
    of one class look alike. Copies and spellings are never expanded into pairs here; alike_pairs() does so.

    Null and empty texts, and texts of invisible signs only, are no cases; equal texts aren't either;
    repeated rows count once; null ids are left out. Forms with a single spelling are dropped by comparing the
    least and greatest hash of the spellings, before any row meets another. A class is named by 128 bits.
    """
    rows = df.select(*by, F.col(ident).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text <> ''")
    rows = with_form(rows, "text", "_form").where("_form <> ''")
    rows = stored(rows.select(*by, "id", "text", F.struct(F.xxhash64("_form").alias("a"), F.xxhash64(F.lit(1), "_form").alias("b")).alias("class")))
    spelled = F.xxhash64("text")
    twice = rows.groupBy(*by, "class").agg(F.min(spelled).alias("_a"), F.max(spelled).alias("_b")).where("_a <> _b").drop("_a", "_b")
    return rows.join(twice, [*by, "class"], "left_semi").distinct()


def alike_pairs(classes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, seg_a, seg_b), distinct, seg_a < seg_b: the pairs of a class with unequal texts."""
    some = stored(classes)
    a, b = (some.select(*by, "class", F.col("id").alias(f"seg_{x}"), F.col("text").alias(f"_t{x}")) for x in "ab")
    return a.join(b, [*by, "class"]).where("seg_a < seg_b AND _ta <> _tb").select(*by, "seg_a", "seg_b").distinct()
