"""Global numbers without a global task, and codes made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.storage import staged


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """rows with ``number``, from 1 in the given order (a column without equal values): counts of ranges and places in them."""
    ranged = staged(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(order))
    return ranged.withColumn("_at", place).join(starts, "_part").withColumn("number", F.col("_at") + F.col("_start")).drop("_part", "_at", "_start")


def previous(rows: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """rows, without equal ones, with the value of the row before it in its group, in this order; null for a group's first row.

    Rows are ranged by group and order, so that a group of any size spreads over ranges; a range's first row looks at the last rows
    of the ranges before it, of which there is one each."""
    by = [group, *order]
    ranged = staged(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "previous")
    inside = W.partitionBy("_part").orderBy(*by)
    ends = ranged.groupBy("_part").agg(F.max_by(F.struct(group, value), F.struct(*by)).alias("_end"))
    ends = ends.select("_part", F.lag("_end").over(W.orderBy("_part")).alias("_end"))
    here = F.lag(F.struct(group, value)).over(inside)
    d = ranged.withColumn("_before", here).join(ends, "_part", "left").withColumn("_before", F.coalesce("_before", "_end"))
    return d.withColumn(name, F.when(F.col(f"_before.{group}") == F.col(group), F.col(f"_before.{value}"))).drop("_part", "_before", "_end")


def highest(codes: DataFrame | None, column: str, letters: str) -> int:
    """The greatest number of codes made of these letters, in either case, and digits; 0 without any."""
    if codes is None:
        return 0
    return codes.agg(F.max(F.regexp_extract(column, f"(?i)^{letters}([0-9]+)$", 1).try_cast("long"))).first()[0] or 0


def code(letters: str, number: Column) -> Column:
    """Letters and at least six digits."""
    digits = number.cast("string")
    return F.concat(F.lit(letters), F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits))
