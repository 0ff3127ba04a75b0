"""Text and zip drops of records as tables of lines, and the sink of staged lines."""

from __future__ import annotations

import io
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_line, strip_line_end
from .archives import MEMBERS, SCHEMA, can_open, members, read_member, zip_lines
from .commits import FEW_PARTS, Commits, counted, local_frame

__all__ = ["MEMBERS", "emptied_files", "encoded_lines", "read_staged", "read_text", "read_zip", "stage", "staged_files", "unzip"]

#: Files of another encoding that are broadcast; more are joined.
FEW_FILES = 10_000
#: Where the errors of archives lie among staged lines; no series has this name.
BROKEN_SERIES = "__broken__"


def file_name(path: Column) -> Column:
    """Name of a file from its path or link, without escapes."""
    return F.element_at(F.split(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "/"), -1)


def _raw_text(spark: SparkSession, path: str | list[str], series: str | None) -> DataFrame:
    """(path, value) of text files, bytes as they are."""
    reader = spark.read.option("recursiveFileLookup", True)
    if series:
        reader = reader.option("pathGlobFilter", f"{series}_*.[tT][xX][tT]")
    return reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value"))


def read_text(spark: SparkSession, path: str, series: str | None = None) -> DataFrame:
    """(file, text_content) of text files, series_*.txt in any case if a series is given. Empty lines stay.

    A file that is not UTF-8 from end to end is ISO-8859-1 as a whole, so files are read once to see that. stage_series
    reads them once, by encoded_lines, and only those found bad again.
    """
    lines = _raw_text(spark, path, series)
    other = lines.filter(~F.is_valid_utf8("value")).select("path").distinct().withColumn("other", F.lit(True))
    if other.limit(FEW_FILES + 1).count() <= FEW_FILES:  # lines are not shuffled, and a file is as many tasks as it has splits
        other = F.broadcast(other)
    text = F.when(F.col("other"), F.decode(F.col("value").cast("binary"), "ISO-8859-1")).otherwise(F.col("value"))
    return lines.join(other, "path", "left").select(file_name(F.col("path")).alias("file"), strip_line_end(text).alias("text_content"))


def encoded_lines(spark: SparkSession, path: str | list[str], series: str | None = None, other: bool = False) -> DataFrame:
    """(file, text_content, invalid) of text files read as UTF-8, or as ISO-8859-1; invalid says that a line is no UTF-8."""
    lines = _raw_text(spark, path, series)
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1") if other else F.col("value")
    return lines.select(file_name(F.col("path")).alias("file"), strip_line_end(text).alias("text_content"), (F.lit(False) if other else ~F.is_valid_utf8("value")).alias("invalid"))


def drops(spark: SparkSession, path: str, series: str | None = None) -> DataFrame:
    """(path, file, source) of text files and archives: source says which state of the file it is. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{series or ''}{'_' if series else ''}*.[tTzZ][xXiI][tTpP]").load(path)
    state = found.select("path", F.col("length").cast("string").alias("size"), F.col("modificationTime").cast("string").alias("time"))
    every = local_frame(spark, [(p,) for p in found.inputFiles()], "path string")  # empty files too, which the source has no rows for
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    rows = every.withColumn("_p", plain(F.col("path"))).join(state.withColumn("_p", plain(F.col("path"))).drop("path"), "_p", "left")
    source = F.sha2(F.concat_ws("|", "_p", F.coalesce("size", F.lit("0")), F.coalesce("time", F.lit(""))), 256)
    return rows.select("path", file_name(F.col("path")).alias("file"), source.alias("source")).filter(F.lower("file").rlike(r"\.(txt|zip)$"))


def read_zip(spark: SparkSession, path: str, series: str | None = None, sure: bool = False, only: list[str] | None = None) -> DataFrame:
    """(file, member, member_no, line_no, text_content, error) of the text members of archives, series_*.zip if a series is given.

    Members are dealt over tasks and read by ranges, where pyarrow can open the archives; else a task reads an archive as
    a whole, which a cell must hold. sure: of a broken member no lines come at all, at the price of reading it twice.
    only: paths of the archives that are wanted.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{series}_*.[zZ][iI][pP]" if series else "*.[zZ][iI][pP]").load(path)
    paths = [r["path"] for r in found.select("path").collect()] if only is None else only  # a row for each archive
    if all(can_open(p) for p in paths[:1]):
        return _named(zip_lines(spark, paths, sure))
    return unzip(found if only is None else found.filter(F.col("path").isin(only)), sure)


def unzip(archives: DataFrame, sure: bool = False) -> DataFrame:
    """read_zip() of archives that cells hold (path, content), a task each.

    Members other than MEMBERS are left out. A line that is not UTF-8 is ISO-8859-1. An archive that cannot be opened, a
    member that breaks off, and an archive without members give a row with an error and no text.
    """

    def unzipped(batches):
        for batch in batches:
            for path, content in zip(*(batch.column(k) for k in (0, 1)), strict=True):
                file = io.BytesIO(content.as_py())
                for m in members(path.as_py(), file):
                    yield from read_member(file, m, sure)

    return _named(archives.select("path", "content").mapInArrow(unzipped, SCHEMA))


def _named(lines: DataFrame) -> DataFrame:
    return lines.select(file_name(F.col("path")).alias("file"), "member", "member_no", "line_no", decode_line("line").alias("text_content"), "error")


def stage(lines: DataFrame, path: str, series: str, period: str = "period", attempted: DataFrame | None = None, strict: bool = True) -> dict[str, tuple[int, str | None]]:
    """Write lines by series, period and file, the period taken from the file name: {file: (lines, error)}.

    lines: file, text_content, and maybe error and invalid. The files that are attempted (file, source), by default those
    that have lines, are replaced as wholes by what they have now, be it nothing. Rows with an error are no lines; strict:
    a file with one has none. Where a line is invalid, the file's error says so, and none of it is there. Lines are
    counted by the job that writes them. A write that breaks off changes nothing.
    """
    spark = lines.sparkSession
    for c, kind in (("error", "string"), ("invalid", "boolean")):
        if c not in lines.columns:
            lines = lines.withColumn(c, F.lit(None).cast(kind))
    batch = uuid.uuid4().hex
    if attempted is None:
        attempted = lines.select("file").distinct().withColumn("source", F.lit(batch))
    files = sorted(attempted.select("file", "source").dropDuplicates(["file"]).collect())  # a row for each file
    code = {r["file"]: k for k, r in enumerate(files)}
    known = local_frame(spark, list(code.items()), "file string, code int")
    rows = lines.join(F.broadcast(known) if len(files) <= FEW_PARTS else known, "file")
    kind = F.when(F.col("error").isNotNull(), 1).when(F.coalesce("invalid", F.lit(False)), 2).otherwise(0)
    rows, counts = counted(rows.withColumn("code", F.col("code") * 3 + kind), "code", 3 * len(files))
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    rows = rows.select(F.coalesce("error", "text_content").alias("text_content"), F.when(F.col("error").isNotNull(), F.lit(BROKEN_SERIES)).otherwise(F.lit(series)).alias("series"), F.substr(stem, F.lit(len(series) + 2)).alias(period), "file")
    at = f"{path}/batch={batch}"
    rows.write.partitionBy("series", period, "file").parquet(at)
    n = counts()
    errors: dict[str, str] = {}
    if any(n.get(3 * k + 1) for k in code.values()):
        bad = spark.read.schema(f"text_content string, series string, {period} string, file string").option("basePath", at).parquet(f"{at}/series={BROKEN_SERIES}")
        errors = {r["file"]: r["e"] for r in bad.groupBy("file").agg(F.min("text_content").alias("e")).collect()}  # a row for each broken file
    out: dict[str, tuple[int, str | None]] = {}
    for f, k in code.items():
        whole = not n.get(3 * k + 2) and not (strict and f in errors)
        out[f] = (n.get(3 * k, 0) if whole else 0, "not UTF-8" if n.get(3 * k + 2) else errors.get(f))
    written = sum(bool(n.get(3 * k, 0) + n.get(3 * k + 2, 0)) for k in code.values())
    kept = [(series, _period(r["file"], series), r["file"], out[r["file"]][0], r["source"]) for r in files]  # files without lines too, so that what was made of them before can go
    Commits(spark, path, "series").commit(batch, kept, [(f, [series], None) for f in code], written=written)
    return out


def _period(file: str, series: str) -> str:
    return file.rpartition(".")[0][len(series) + 1 :] if "." in file else file[len(series) + 1 :]


def read_staged(spark: SparkSession, path: str, period: str = "period") -> DataFrame:
    """Staged lines, of each file those of its newest commit; a period is text, whatever it looks like."""
    table = Commits(spark, path, "series")
    at = table.latest()
    if at["snapshot"] is None:
        raise FileNotFoundError(f"nothing is staged at {path}")
    rows = spark.read.schema(f"text_content string, batch string, series string, {period} string, file string").option("basePath", path).parquet(*[f"{path}/batch={b}" for b, _ in at["batches"]]) if at["batches"] else None
    if rows is None:
        return local_frame(spark, [], f"text_content string, series string, {period} string, file string")
    return table.alive(rows.filter(F.col("series") != BROKEN_SERIES), at, ("series", "file")).drop("batch")


def staged_files(spark: SparkSession, path: str, series: str) -> DataFrame:
    """file, period, n, source of the staged files of a series, without a look at their lines."""
    return Commits(spark, path, "series").entries().filter((F.col("series") == series) & (F.col("n") > 0)).select("file", "period", "n", "source")


def emptied_files(spark: SparkSession, path: str, series: str) -> DataFrame:
    """file of each file of a series that has no lines since it was last staged."""
    return Commits(spark, path, "series").entries().filter((F.col("series") == series) & (F.col("n") == 0)).select("file")
