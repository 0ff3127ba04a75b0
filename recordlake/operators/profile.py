"""Which format a layout is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def format_rule(max_length: Column, fmt: Column, begin: Column, end: Column) -> Column:
    """DELIMITED, FIXED_WIDTH or UNKNOWN by the columns that a layout has."""
    return F.when(max_length & fmt, F.lit("DELIMITED")).when(begin & end, F.lit("FIXED_WIDTH")).otherwise(F.lit("UNKNOWN"))


def format_score(max_length: Column, begin_end: Column, fmt: Column, description: Column, definition: Column, remarks: Column, element: Column, item: Column) -> tuple[Column, Column, Column]:
    """(score, prediction, indicators) from the columns that a layout has."""
    both, alone = description & definition, remarks & ~(description | definition)
    # Weights and what they are called
    terms = [
        (max_length, 3, "Max Length column"), (begin_end, -3, "Begin/End columns"), (fmt, 2, "Format column"), (both, 1, "Description/Definition columns"),
        (alone, -1, "Remarks column only"), (element, 1, "Data Element naming"), (~element & item, -1, "Data Item naming"),
    ]
    score = sum((F.when(c, n).otherwise(0) for c, n, _ in terms), F.lit(0))
    predicted = F.when(score >= 3, F.lit("DELIMITED")).when(score <= -2, F.lit("FIXED-WIDTH")).otherwise(F.lit("UNCERTAIN"))
    return score, predicted, F.concat_ws("; ", *[F.when(c, F.lit(t)) for c, _, t in terms])


def delimiter_hints(text: Column, label: str) -> Column:
    """What a layout's own words say about its delimiter; None if nothing."""
    low = F.lower(text)
    # What is looked for and how it is told
    hints = [
        (low.contains("delimit"), f"'{label}' mentions delimiter"),
        (low.contains("fixed") & low.contains("width"), f"'{label}' mentions fixed width"),
        (low.contains("pipe") | text.contains("|"), f"'{label}' mentions pipe delimiter"),
        (low.contains("comma") & low.contains("separat"), f"'{label}' mentions comma separator"),
    ]
    found = F.concat_ws("; ", *[F.when(c, F.lit(t)) for c, t in hints])
    return F.when(found == "", F.lit("None")).otherwise(found)


def layout_hints(layout: DataFrame, by: str = "series", pos: str = "pos", columns: tuple[str, ...] = ("Format", "Description", "Definition", "Remarks"), first: int = 10) -> DataFrame:
    """by, hints: delimiter_hints of each text column of a series' layout, over its first rows that have a value there."""
    have = [c for c in columns if c in layout.columns]
    w = Window.partitionBy(by).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = layout.select(by, pos, *[F.col(f"`{c}`").alias(f"_t{k}") for k, c in enumerate(have)])
    seen = seen.withColumns({f"_n{k}": F.count(f"_t{k}").over(w) for k in range(len(have))})
    kept = seen.withColumns({f"_t{k}": F.when(F.col(f"_n{k}") <= first, F.col(f"_t{k}")) for k in range(len(have))})
    start = F.row_number().over(Window.partitionBy(by).orderBy(pos)) == 1  # a series without values stays
    kept = kept.withColumn("_keep", start | F.coalesce(*[F.col(f"_t{k}") for k in range(len(have))], F.lit(None).cast("string")).isNotNull()).filter("_keep") if have else kept
    told = []
    for k, c in enumerate(have):
        texts = F.transform(F.array_sort(F.collect_list(F.when(F.col(f"_t{k}").isNotNull(), F.struct(pos, F.col(f"_t{k}").alias("t"))))), lambda x: x["t"])  # of the first rows
        told.append(F.nullif(delimiter_hints(F.array_join(texts, " "), c), F.lit("None")))
    hints = F.concat_ws("; ", *told) if told else F.lit("")
    return kept.groupBy(by).agg(F.when(hints == "", F.lit("None")).otherwise(hints).alias("hints"))
