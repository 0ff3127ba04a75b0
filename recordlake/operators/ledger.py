"""Run ledgers: what was done, skipped and failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import if_few

LEDGER = "series string, file string, record_type string, status string, n long, error string"


def run_summary(ledger: DataFrame, by: str = "series") -> DataFrame:
    """By series: successful, failed, skipped, total, attempted and the success rate in percent, 0.0 if nothing was attempted."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = ledger.groupBy(by).agg(n("success").alias("successful"), n("failed").alias("failed"), n("skipped").alias("skipped"), F.count(F.lit(1)).alias("total"))
    tried = F.col("successful") + F.col("failed")
    return out.withColumns({"attempted": tried, "success_rate": F.when(tried > 0, F.col("successful") * 100.0 / tried).otherwise(0.0)})


def records_by_type(ledger: DataFrame) -> DataFrame:
    """Records by series and type, with totals: level is 0 for a type of a series, 1 for a series, 3 for all.

    A null type is a type like others, and told from a total by the level.
    """
    ok = ledger.filter("status = 'success'")
    return ok.rollup("series", "record_type").agg(F.sum("n").alias("records"), F.grouping_id().cast("int").alias("level"))


def to_do(found: DataFrame, ledger: DataFrame, on: list[str]) -> DataFrame:
    """Inputs that the ledger does not say are done."""
    return found.join(ledger.filter("status = 'success'").select(*on).distinct(), on, "left_anti")


def work_list(files: DataFrame, types: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Files by the record types of their series; requested codes that a series does not know are left out."""
    if requested is not None:
        types = types.filter(F.col("record_type").isin(requested))
    return files.join(if_few(types), "series")
