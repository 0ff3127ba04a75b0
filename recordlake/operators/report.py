"""Reports: counts with totals, first rows, order, and files of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def manifest_counts(manifest: DataFrame, by: str = "series", hit: str = "hit") -> DataFrame:
    """attempted, obtained and missed of each series (level 0) and of all (level 1)."""
    got = F.count_if(F.col(hit))
    return manifest.rollup(by).agg(F.count(F.lit(1)).alias("attempted"), got.alias("obtained"), (F.count(F.lit(1)) - got).alias("missed"), F.grouping_id().cast("int").alias("level"))


def value_counts(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Rows for each combination of values, nulls too."""
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def first_rows(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def by_count(counts: DataFrame, n: str = "n", name: str = "name") -> DataFrame:
    return counts.orderBy(F.desc(n), name)


def by_coverage(report: DataFrame) -> DataFrame:
    """Series without gaps first, then by share."""
    return report.orderBy("has_gaps", F.desc("coverage_pct"), "series")


def by_format(report: DataFrame) -> DataFrame:
    return report.orderBy("predicted", F.desc("score"), "series")


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """A report as CSV with a header, or in another format; lists become text."""
    flat = report.select(*[F.array_join(F.col(f"`{c}`").cast("array<string>"), "; ").alias(c) if k.startswith("array") else F.col(f"`{c}`") for c, k in report.dtypes]) if fmt == "csv" else report
    flat.write.mode("overwrite").option("header", True).format(fmt).save(path)
