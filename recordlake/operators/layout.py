"""Layout tables: groups, record types, cleaning, versions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import distinct_names, record_type_code
from ..functions.text import item_number, item_prefix, one_line
from .profile import format_rule

LENGTH_ROW = "Length of Record"


def item_groups(rows: DataFrame, file: str = "file", pos: str = "pos", item: str = "item_no") -> DataFrame:
    """rows with group_id: it grows where an item is 1 and the one before is not; the first group is -1."""
    w = Window.partitionBy(file).orderBy(pos)
    reset = (F.col(item) == 1) & (F.lag(item, 1, 1).over(w) != 1)
    return rows.withColumn("_reset", F.coalesce(reset, F.lit(False)).cast("int")).withColumn("group_id", (F.sum("_reset").over(w) - 1).cast("int")).drop("_reset")


def propagate_types(rows: DataFrame, file: str = "file", pos: str = "pos", record_type: str = "record_type") -> DataFrame:
    """The first record type that is not null, in row order, holds for all of its group."""
    w = Window.partitionBy(file, "group_id").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(record_type, F.first(record_type, ignorenulls=True).over(w))


def group_conflicts(rows: DataFrame, file: str = "file", record_type: str = "record_type") -> DataFrame:
    """Record types, how many, and rows of each group."""
    types = F.array_join(F.array_sort(F.collect_set(record_type)), ",")
    return rows.groupBy(file, "group_id").agg(types.alias("record_types"), F.count_distinct(record_type).alias("n_types"), F.count(F.lit(1)).alias("n_rows"))


def mentions_type(*cols: Column) -> Column:
    """A cell speaks of a record type, and is not just these words."""
    out = F.lit(False)
    for c in cols:
        low = F.lower(F.trim(c))
        out = out | F.coalesce(low.contains("record type") & (low != "record type"), F.lit(False))
    return out


def retain_groups(rows: DataFrame, text_cols: list[str], file: str = "file") -> DataFrame:
    """Groups in which a row speaks of a record type; all groups of a file in which none does."""
    flag = mentions_type(*[F.col(c) for c in text_cols]).cast("int")
    rows = rows.withColumn("_m", flag)
    in_group = F.max("_m").over(Window.partitionBy(file, "group_id"))
    in_file = F.max("_m").over(Window.partitionBy(file))
    return rows.withColumns({"_g": in_group, "_f": in_file}).filter("_g = 1 or _f = 0").drop("_m", "_g", "_f")


def drop_length_rows(rows: DataFrame, name: str = "field_name") -> DataFrame:
    return rows.filter(~F.col(name).eqNullSafe(LENGTH_ROW))


def drop_empty_rows(rows: DataFrame, source_cols: list[str]) -> DataFrame:
    return rows.dropna(how="all", subset=source_cols)


def drop_auto_rows(rows: DataFrame, item: str = "item") -> DataFrame:
    """Rows whose label is a made-up column header."""
    return rows.filter(~F.coalesce(F.col(item).rlike(r"^Col\d+$"), F.lit(False)))


def group_type_bijection(rows: DataFrame, file: str = "file", record_type: str = "record_type") -> DataFrame:
    """By file: groups, most groups of a type, most types of a group, and whether group_id says nothing of its own."""
    known = rows.filter(F.col(record_type).isNotNull())
    per_type = known.groupBy(file, record_type).agg(F.count_distinct("group_id").alias("g")).groupBy(file).agg(F.max("g").alias("groups_per_type"))
    per_group = rows.groupBy(file, "group_id").agg(F.count_distinct(record_type).alias("t")).groupBy(file).agg(F.max("t").alias("types_per_group"), F.count(F.lit(1)).alias("n_groups"))
    out = per_group.join(per_type, file, "left").withColumn("groups_per_type", F.coalesce("groups_per_type", F.lit(0)))
    return out.withColumn("redundant", (F.col("n_groups") == 1) | ((F.col("groups_per_type") == 1) & (F.col("types_per_group") == 1)))


def without_redundant_groups(rows: DataFrame, file: str = "file", record_type: str = "record_type") -> DataFrame:
    """rows with group_id null in files where it says nothing of its own: one group, or one for each record type."""
    flags = group_type_bijection(rows, file, record_type).select(F.col(file).alias("_file"), "redundant")
    out = rows.join(flags, F.col(file).eqNullSafe(F.col("_file")), "left")
    return out.withColumn("group_id", F.when(~F.col("redundant"), F.col("group_id"))).drop("_file", "redundant")


def clean_layout(
    rows: DataFrame, source_cols: list[str], item: str = "item", name: str = "field_name", element: str | None = None, file: str = "file", pos: str = "pos", drop_auto_headers: bool = True,
    grouping: bool = True, record_types: bool = True, drop_redundant: bool = False, headers: bool = False,
) -> DataFrame:
    """A layout table as extracted, cleaned, by steps that can be left out.

    headers: column names come on one line with single spaces, and repeated ones get numbers; the columns that are named
    here are then meant by their new names. Texts come on one line and made-up headers go. grouping: labels with digits, groups of items, no length rows, and
    the groups that speak of record types. record_types: the type that a row states, for its whole group if there are
    groups. drop_redundant: group ids that say nothing of their own are null.
    """
    texts = [name] + ([element] if element else [])
    rows = rows.toDF(*distinct_names(rows.columns)) if headers else rows
    df = rows.withColumns({c: one_line(c) for c in texts})
    if drop_auto_headers:
        df = drop_auto_rows(df, item)
    if grouping:
        df = item_groups(df.withColumn("item_no", item_number(item)).filter("item_no is not null"), file, pos)
        df = drop_empty_rows(drop_length_rows(df, name), source_cols)
        df = retain_groups(df, texts, file)
    if record_types:
        df = df.withColumn("record_type", stated_type(*texts))
        df = propagate_types(df, file, pos) if grouping else df
        df = without_redundant_groups(df, file) if grouping and drop_redundant else df
    return df


def stated_type(*texts: str) -> Column:
    """The record type that the first of the columns that states one states."""
    return F.coalesce(*[record_type_code(c) for c in texts])


def with_offsets(layout: DataFrame, by: list[str], pos: str = "pos", length: str = "length") -> DataFrame:
    """layout with offset: the widths before each field."""
    w = Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return layout.withColumn("offset", F.coalesce(F.sum(length).over(w), F.lit(0)))


def item_order(layout: DataFrame, by: list[str], item: str = "item") -> DataFrame:
    """layout with ordinal: the place of each field by the number in its label."""
    w = Window.partitionBy(*by).orderBy(item_prefix(item), item_number(item), F.col(item))
    return layout.withColumn("ordinal", F.row_number().over(w))


def version_for(files: DataFrame, versions: DataFrame, series: str = "series", day: str = "day", latest_only: bool = True) -> DataFrame:
    """files with the layout version valid on their day: from and to count, a null bound is open.

    Where versions overlap the latest holds, and overlap says so. versions is metadata, a row for each layout file: it
    is cut into spans of days that do not overlap, so that a file meets at most one, and files are joined as they are,
    each row once; the spans are broadcast if they are few.
    """
    v = versions.withColumnRenamed(series, "_s")
    if not latest_only:
        ok = (F.col(series) == F.col("_s")) & (F.col("version_from").isNull() | (F.col("version_from") <= F.col(day))) & (F.col("version_to").isNull() | (F.col(day) <= F.col("version_to")))
        return files.join(if_few(v), ok, "left").drop("_s")
    spans = if_few(version_spans(v, "_s"))
    ok = (F.col(series) == F.col("_s")) & (F.col("_start") <= F.col(day)) & (F.col(day) < F.col("_end"))
    return files.join(spans, ok, "left").drop("_s", "_start", "_end").withColumn("overlap", F.coalesce("overlap", F.lit(False)))


#: Rows of metadata that are broadcast; more are joined by shuffle.
FEW_ROWS = 100_000


def if_few(rows: DataFrame) -> DataFrame:
    """rows, marked to be broadcast if a count says that they are few."""
    return F.broadcast(rows) if rows.limit(FEW_ROWS + 1).count() <= FEW_ROWS else rows


def version_spans(versions: DataFrame, series: str = "series") -> DataFrame:
    """versions with _start, _end (not in it) and overlap: spans of days of each series on which the same version holds."""
    first, last = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    v = versions.withColumns({"_a": F.coalesce("version_from", first), "_b": F.when(F.col("version_to").isNull(), last).otherwise(F.date_add("version_to", 1))})
    points = v.select(F.col(series).alias("_p"), F.explode(F.array("_a", "_b")).alias("_start")).distinct()
    points = points.withColumn("_end", F.lead("_start").over(Window.partitionBy("_p").orderBy("_start"))).filter(F.col("_end").isNotNull())
    cols = versions.columns
    met = points.join(v, (F.col("_p") == F.col(series)) & (F.col("_a") <= F.col("_start")) & (F.col("_start") < F.col("_b")))
    best = met.groupBy("_p", "_start", "_end").agg(F.max_by(F.struct(*cols), F.struct("_a", *[c for c in cols if c != series])).alias("v"), (F.count(F.lit(1)) > 1).alias("overlap"))
    return best.select("v.*", "_start", "_end", "overlap")


def reconcile(layouts: DataFrame, versions: list[str], version: str = "version", order: str = "version_order", name: str = "field_name") -> DataFrame:
    """A row for each (begin, end): rows in each version as has_<version>, and the last version's name."""
    flags = [F.count_if(F.col(version) == v).alias(f"has_{v}") for v in versions]
    return layouts.groupBy("begin", "end").agg(*flags, F.max_by(name, order).alias("field_name"))


def layout_profile(layout: DataFrame, by: str = "series", record_type: str = "record_type") -> DataFrame:
    """Rows, record types and their list for each series; the columns that it uses, in their order, and its format."""
    types = F.array_join(F.array_sort(F.collect_set(record_type)), ",")
    skip = {by, record_type, "pos", "layout_file", "version_from", "version_to"}
    used = {c: F.count(F.col(f"`{c}`")) > 0 for c in layout.columns if c not in skip}
    has = lambda *names: functools.reduce(lambda a, b: a | b, [used[n] for n in names if n in used], F.lit(False))
    columns = F.array_join(F.filter(F.array(*[F.when(u, F.lit(c)) for c, u in used.items()]) if used else F.array().cast("array<string>"), lambda x: x.isNotNull()), ",")
    fmt = format_rule(has("Max Length", "max_length"), has("Format", "format"), has("Begin", "begin"), has("End", "end"))
    return layout.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(record_type).alias("n_types"), types.alias("record_types"), columns.alias("column_names"), fmt.alias("format"))
