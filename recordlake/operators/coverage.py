"""Months that layouts or files cover, gaps, and expected files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import FORMATS, MONTHS, clamp_end, month_label, months_between, period_end


def covered_months(ranges: DataFrame, series: str = "series", start: str = "start", end: str = "end") -> DataFrame:
    """series, month: each month that a range touches, once."""
    return ranges.select(series, F.explode(months_between(start, end)).alias("month")).distinct()


def expected_months(ranges: DataFrame, series: str = "series", start: str = "start", end: str = "end") -> DataFrame:
    """series, month: all months from the first start to the last end."""
    span = ranges.groupBy(series).agg(F.min(start).alias("a"), F.max(end).alias("b"))
    return span.select(series, F.explode(months_between("a", "b")).alias("month"))


def missing_months(expected: DataFrame, covered: DataFrame, series: str = "series") -> DataFrame:
    return expected.join(covered, [series, "month"], "left_anti")


def gap_periods(missing: DataFrame, series: str = "series") -> DataFrame:
    """series, gap_start, gap_end, n_months: runs of consecutive missing months."""
    index = F.year("month") * 12 + F.month("month")
    island = index - F.row_number().over(Window.partitionBy(series).orderBy("month"))
    runs = missing.withColumn("island", island).groupBy(series, "island")
    return runs.agg(F.min("month").alias("gap_start"), F.max("month").alias("gap_end"), F.count(F.lit(1)).alias("n_months")).drop("island")


def coverage(ranges: DataFrame, as_of, series: str = "series", start: str = "start", end: str = "end") -> DataFrame:
    """By series: first, last, ranges, expected, covered and missing months, their share, whether and where there are gaps.

    An open end is taken as as_of, so that the report does not drift.
    """
    r = ranges.select(series, start, clamp_end(end, as_of).alias(end)).dropDuplicates()
    index = lambda d: F.year(d) * 12 + F.month(d)
    # one pass over the ranges of a series by start: a gap lies between the last month covered so far and the next start
    before = Window.partitionBy(series).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    some = r.withColumn("_touch", F.trunc(start, "month") <= F.trunc(end, "month"))
    some = some.withColumn("_last", F.max(F.when(F.col("_touch"), F.trunc(end, "month"))).over(before))
    begin = F.when(F.col("_touch"), F.trunc(start, "month"))
    gap = F.when(F.col("_touch") & (index(begin) > index("_last") + 1), F.struct(F.add_months("_last", 1).alias("a"), F.add_months(begin, -1).alias("b")))
    found = some.withColumn("_gap", gap).groupBy(series).agg(
        F.min(start).alias("min_start"), F.max(end).alias("max_end"), F.count(F.lit(1)).alias("n_ranges"),
        F.array_sort(F.collect_list("_gap")).alias("_gaps"), F.sum(F.coalesce(index(F.col("_gap.b")) - index(F.col("_gap.a")) + 1, F.lit(0))).alias("inner"),
        F.min(begin).alias("_low"), F.max(F.when(F.col("_touch"), F.trunc(end, "month"))).alias("_high"),
    )
    expected = F.greatest(index("max_end") - index("min_start") + 1, F.lit(0))
    # ranges that end before they start touch no month, but widen what is expected
    outer = F.array(F.struct(F.trunc("min_start", "month").alias("a"), F.add_months(F.coalesce("_low", F.add_months(F.trunc("max_end", "month"), 1)), -1).alias("b")), F.struct(F.add_months("_high", 1).alias("a"), F.trunc("max_end", "month").alias("b")))
    gaps = F.array_sort(F.concat("_gaps", F.filter(outer, lambda g: g["a"] <= g["b"])))
    found = found.withColumn("_gaps", gaps).withColumn("expected", expected.cast("long")).filter("expected > 0")
    miss = F.aggregate("_gaps", F.lit(0).cast("long"), lambda n, g: n + index(g["b"]) - index(g["a"]) + 1)
    told = F.array_join(F.transform("_gaps", lambda g: month_label(g["a"], g["b"])), "; ")
    out = found.withColumns({"missing": miss, "gaps": F.when(F.size("_gaps") > 0, told).otherwise(F.lit("None"))})
    return out.select(
        series, "min_start", "max_end", "n_ranges", "expected", (F.col("expected") - F.col("missing")).alias("covered"), "missing",
        F.round((F.col("expected") - F.col("missing")) * 100.0 / F.col("expected"), 1).alias("coverage_pct"), (F.col("missing") > 0).alias("has_gaps"), "gaps",
    )


def interval_sets(ranges: DataFrame, series: str = "series", start: str = "start", end: str = "end") -> DataFrame:
    """A row for each series with what its coverage follows from: min_start, max_end, seen (its ranges), spans (runs of covered months).

    Sets of parts of the ranges can be merged in any order, and kept as a table that new ranges change.
    """
    r = ranges.select(F.col(series).alias("series"), F.col(start).alias("start"), F.col(end).alias("end")).dropDuplicates()
    span = F.when(F.trunc("start", "month") <= F.trunc("end", "month"), F.struct(_month("start").alias("a"), _month("end").alias("b")))
    each = r.select("series", F.col("start").alias("min_start"), F.col("end").alias("max_end"), F.array(F.struct("start", "end")).alias("seen"), F.array_compact(F.array(span)).alias("spans"))
    return merge_sets(each)


def _month(d) -> Column:
    return F.year(d) * 12 + F.month(d) - 1


def _day(months: Column) -> Column:
    return F.make_date(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1))


def merge_sets(sets: DataFrame) -> DataFrame:
    """The sets of each series as one: ranges that were seen twice count once, and months that touch become one span."""
    every = F.array_sort(F.flatten(F.collect_list("spans")))
    out = sets.groupBy("series").agg(F.min("min_start").alias("min_start"), F.max("max_end").alias("max_end"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"), every.alias("spans"))

    def joined(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["b"] + 1 >= x["a"]), longer).otherwise(F.concat(done, F.array(x)))

    return out.withColumn("spans", F.aggregate("spans", F.array().cast("array<struct<a:int,b:int>>"), joined))


def coverage_of(sets: DataFrame) -> DataFrame:
    """coverage() from sets whose open ends are clamped already."""
    first, last = _month("min_start"), _month("max_end")
    expected = F.greatest(last - first + 1, F.lit(0)).cast("long")
    ends = F.concat(F.array(first - 1), F.transform("spans", lambda x: x["b"]))
    starts = F.concat(F.transform("spans", lambda x: x["a"]), F.array(last + 1))
    between = F.zip_with(ends, starts, lambda e, s: F.struct((e + 1).alias("a"), (s - 1).alias("b")))
    gaps = F.filter(between, lambda g: g["a"] <= g["b"])
    rows = sets.select("series", "min_start", "max_end", F.size("seen").cast("long").alias("n_ranges"), expected.alias("expected"), gaps.alias("_gaps")).filter("expected > 0")
    miss = F.aggregate("_gaps", F.lit(0).cast("long"), lambda n, g: n + g["b"] - g["a"] + 1)
    told = F.array_join(F.transform("_gaps", lambda g: month_label(_day(g["a"]), _day(g["b"]))), "; ")
    out = rows.withColumns({"missing": miss, "gaps": F.when(F.size("_gaps") > 0, told).otherwise(F.lit("None"))})
    covered = F.col("expected") - F.col("missing")
    return out.select("series", "min_start", "max_end", "n_ranges", "expected", covered.alias("covered"), "missing", F.round(covered * 100.0 / F.col("expected"), 1).alias("coverage_pct"), (F.col("missing") > 0).alias("has_gaps"), "gaps")


def expected_files(catalog: DataFrame, as_of) -> DataFrame:
    """series, step, day, file_name: the files that a series should have from its first date to its last or to as_of.

    A frequency or a date format that is not known is an error where its series is read, not a series without files.
    """
    own = lambda table: F.coalesce(*[F.when(F.col("frequency") == f, F.lit(x)) for f, x in table.items()])
    months = F.coalesce(own(MONTHS), F.raise_error(F.concat(F.lit("unknown frequency: "), F.coalesce("frequency", F.lit("null")))).cast("int"))
    end = F.coalesce("max_date", as_of)
    days = F.when(F.col("min_date") <= end, F.sequence("min_date", end, F.make_ym_interval(F.lit(0), months))).otherwise(F.array().cast("array<date>"))
    rows = catalog.select("series", "extension", "frequency", "date_format", F.posexplode(days).alias("step", "day"))
    last = F.coalesce(*[F.when(F.col("frequency") == f, period_end("day", f)) for f in MONTHS])
    suffix = F.coalesce(*[F.when(F.col("date_format") == name, F.date_format(last, java)) for _, name, java in FORMATS], F.raise_error(F.concat(F.lit("unknown date format: "), F.coalesce("date_format", F.lit("null")))).cast("string"))
    return rows.select("series", "step", "day", F.concat("series", F.lit("_"), suffix, F.lit("."), "extension").alias("file_name"))


def missing_files(expected: DataFrame, links: DataFrame, href: str = "href", within: bool = False) -> DataFrame:
    """Expected files that no link ends with; within: that no link holds anywhere."""
    if within:
        have = contained_names(expected.select("file_name"), links.select(href), href).select("file_name").distinct()
    else:
        have = links.select(F.element_at(F.split(href, "/"), -1).alias("file_name")).distinct()
    return expected.join(have, "file_name", "left_anti")


def contained_names(names: DataFrame, links: DataFrame, href: str = "href", name: str = "file_name", size: int = 8, few: int = 100_000) -> DataFrame:
    """name, href of each link that holds a name, each pair once. Empty names are in no link.

    Links are cut into all their runs of size characters, and a name is looked up by the one of its own runs that the
    fewest names have, so that no link meets every name; what is found is compared as a whole. Names shorter than size are
    looked up whole, by runs of their length. Up to few names are broadcast; more are joined by shuffle. Runs never
    are broadcast, however small texts look before they are cut.
    """
    texts = links.select(F.col(href).alias("href")).filter("href IS NOT NULL").distinct()
    own = names.select(F.col(name).alias("name")).filter("name <> ''").distinct()
    runs = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(F.col(c), i, F.lit(n))))
    long = own.filter(F.length("name") >= size).select("name", F.explode(runs("name", size)).alias("run"))
    common = long.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    found = [long.hint("merge").join(common, "run").groupBy("name").agg(F.min_by("run", F.struct("n", "run")).alias("run"))]
    lengths = [size]
    for n in sorted(r[0] for r in own.filter(F.length("name") < size).select(F.length("name")).distinct().collect()):  # below size
        found.append(own.filter(F.length("name") == n).select("name", F.col("name").alias("run")))
        lengths.append(n)
    broadcast = own.limit(few + 1).count() <= few
    out = None
    for n, keys in zip(lengths, found, strict=True):
        cut = texts.filter(F.length("href") >= n).select("href", F.explode(runs("href", n)).alias("run"))
        met = cut.join(F.broadcast(keys) if broadcast else keys.hint("merge"), "run").filter(F.contains("href", "name")).select(F.col("name").alias(name), F.col("href").alias(href))
        out = met if out is None else out.unionAll(met)
    return out


def miss_runs(files: DataFrame, threshold: int, series: str = "series", step: str = "step", hit: str = "hit") -> DataFrame:
    """files with misses (the run of misses up to each), as far as the first run of threshold misses; a hit ends a run."""
    w = Window.partitionBy(series).orderBy(step)
    run = F.sum(F.col(hit).cast("int")).over(w)
    files = files.withColumn("_run", run)
    misses = F.sum((~F.col(hit)).cast("int")).over(Window.partitionBy(series, "_run").orderBy(step))
    files = files.withColumn("misses", misses)
    stop = F.min(F.when(F.col("misses") >= threshold, F.col(step))).over(Window.partitionBy(series))
    return files.withColumn("_stop", stop).filter(F.col("_stop").isNull() | (F.col(step) <= F.col("_stop"))).drop("_run", "_stop")
