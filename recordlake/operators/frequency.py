"""How often field names occur, raw and standardized."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import standard_name


def name_counts(rows: DataFrame, cols: list[str]) -> DataFrame:
    """name, n: over all the columns, trimmed, without nulls."""
    names = rows.select(F.explode(F.array(*[F.trim(c) for c in cols])).alias("name")).filter(F.col("name").isNotNull())
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def name_table(counts: DataFrame) -> DataFrame:
    """name, n, std_name, std_n, changed: each raw name with its standard form and how often that occurs in all."""
    std = counts.withColumn("std_name", standard_name("name"))
    return std.withColumns({"std_n": F.sum("n").over(Window.partitionBy("std_name")), "changed": F.col("name") != F.col("std_name")})
