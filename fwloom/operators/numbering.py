"""Numbers of rows within groups by sorted ranges and prefix sums, for groups of any size.

A window over a group sorts it in one task. Here rows are dealt out in ranges of (group, order), each range is sorted
and numbered by itself, and the sizes of a group's earlier ranges are added: a group with a third of all rows is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fwloom import storage

#: Bits of ``monotonically_increasing_id`` below the number of the partition.
ROW_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str = "line_no") -> DataFrame:
    """``rows`` with their number in the group from 1, in ``order``, nulls first; the numbers of equal rows are interchangeable.

    The sorted rows are written once, in the shared folder, so every pass sees the same ranges.
    """
    # The last key parts rows that are equal in all others.
    told = rows.withColumn("__tie", F.monotonically_increasing_id())
    ready = told.repartitionByRange(*group, *order, "__tie").sortWithinPartitions(*group, *order).drop("__tie")
    held = storage.written(ready.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", ROW_BITS).alias("__part")
    # A row for each group and range that has rows of it.
    runs = held.groupBy(*group, part).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*(F.col(c).alias(f"__{c}") for c in group), "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    same = F.shiftright("__at", ROW_BITS) == F.col("__part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return held.join(runs, same).select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__before") + 1).alias(name))
