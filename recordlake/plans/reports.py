"""Reports over the layouts of all series, from one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import coverage
from ..operators.frequency import name_counts, name_table
from ..operators.layout import layout_profile
from ..operators.profile import format_score, layout_hints


def layout_reports(layouts: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """names (with their standard forms), coverage, formats (score, prediction, indicators, hints) and profile of combined layouts.

    layouts: what combine_layouts gives. Coverage is over the versions that have dates. Nothing is written in between.
    """
    layouts = layouts if "record_type" in {c.lower() for c in layouts.columns} else layouts.withColumn("record_type", F.lit(None).cast("string"))
    cols = [c for c in ("Data Item", "Data Element") if c in layouts.columns]
    ranges = layouts.filter("version_from IS NOT NULL AND version_to IS NOT NULL").select("series", F.col("version_from").alias("start"), F.col("version_to").alias("end"))
    used = lambda *names: F.max(F.coalesce(*[F.col(f"`{c}`") for c in names if c in layouts.columns], F.lit(None).cast("string")).isNotNull()).alias("_".join(names))
    groups = (("Max Length",), ("Begin",), ("End",), ("Format",), ("Description",), ("Definition",), ("Remarks",), ("Data Element",), ("Data Item",))
    has = layouts.groupBy("series").agg(*[used(*g) for g in groups])
    f = lambda c: F.col(f"`{c}`")
    score, predicted, indicators = format_score(f("Max Length"), f("Begin") & f("End"), f("Format"), f("Description"), f("Definition"), f("Remarks"), f("Data Element"), f("Data Item"))
    formats = has.select("series", score.alias("score"), predicted.alias("predicted"), indicators.alias("indicators")).join(layout_hints(layouts), "series", "left")
    return {"names": name_table(name_counts(layouts, [f"`{c}`" for c in cols])), "coverage": coverage(ranges, as_of), "formats": formats, "profile": layout_profile(layouts)}
