"""Comparison of layout versions: difference, union of columns, gaps and overlaps of windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fwloom.layouts import Layout, LayoutError

COLUMNS = "trade_type string, version string, position int, name string, physical_name string, start int, length int, dtype string, nullable boolean, parse string, description string, coerce boolean, computed boolean"


def columns_of(spark: SparkSession, layouts: list[Layout], dropped: bool = False) -> DataFrame:
    """A row for each column of each version; a version's position follows ``outputs``."""
    rows = []
    for x in layouts:
        for n, c in enumerate([*x.fields, *x.computed_columns]):
            if c.name in x.dropped_columns and not dropped:
                continue
            own = (getattr(c, "physical_name", None), getattr(c, "start", None), getattr(c, "length", None), c.dtype, c.nullable, getattr(c, "parse", None), getattr(c, "description", None), getattr(c, "coerce_invalid_to_null", None))
            rows.append((x.trade_type, x.version, n, c.name, *own, not hasattr(c, "start")))
    return spark.createDataFrame(rows, COLUMNS)


def diff(before: DataFrame, after: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """Full outer join on ``key``: change is added, removed or changed; equal rows are left out."""
    old = before.select(F.col(key).alias("old_key"), *(F.col(c).alias(f"old_{c}") for c in compared))
    new = after.select(F.col(key).alias("new_key"), *(F.col(c).alias(f"new_{c}") for c in compared))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    change = F.when(F.col("old_key").isNull(), "added").when(F.col("new_key").isNull(), "removed").when(~same, "changed")
    both = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")
    return both.withColumn("change", change).where("change IS NOT NULL").withColumn(key, F.coalesce("old_key", "new_key")).drop("old_key", "new_key")


def union_columns(columns: DataFrame) -> DataFrame:
    """Merged schema: name, dtype, nullable in order of first appearance; different dtypes of a name are an error."""
    first = F.min(F.struct("version", "position"))
    merged = columns.groupBy("name").agg(first.alias("first"), F.sort_array(F.collect_set("dtype")).alias("dtypes"), F.max("nullable").alias("nullable"))
    bad = merged.where(F.size("dtypes") > 1).orderBy("name").first()
    if bad:
        raise LayoutError(f"column {bad['name']!r} has different dtypes across versions: {', '.join(bad['dtypes'])}")
    return merged.orderBy("first").select("name", F.col("dtypes")[0].alias("dtype"), "nullable")


def window_problems(versions: DataFrame) -> DataFrame:
    """Gaps and overlaps between consecutive windows (trade_type, effective_from, effective_to): problem for each."""
    order = Window.partitionBy("trade_type").orderBy("effective_from")
    before = versions.withColumn("n", F.row_number().over(order)).withColumn("previous", F.lag("effective_to").over(order)).where("n > 1")
    following = F.date_format(F.add_months(F.to_date(F.concat("previous", F.lit("-01"))), 1), "yyyy-MM")
    problem = F.when(F.col("previous").isNull(), "open").when(F.col("previous") >= F.col("effective_from"), "overlap").when(following != F.col("effective_from"), "gap")
    return before.withColumn("problem", problem).where("problem IS NOT NULL").select("trade_type", "effective_from", "previous", "problem")
