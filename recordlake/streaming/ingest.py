"""New drops of a series, each parsed exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import period_date
from ..functions.text import decode_line, strip_line_end
from ..operators.layout import layout_profile, version_for
from ..operators.ledger import LEDGER
from ..operators.parse import ALL, Field, delimited, fixed_width
from ..plans.jobs import DELIMITED, FIXED_WIDTH, File, Options, layout_fields, transform_lines
from ..sources.commits import Commits, local_frame


def line_stream(spark: SparkSession, source: str, series: str, files_per_batch: int = 1000, glob: str | None = None) -> DataFrame:
    """Lines of the text files of a series as they arrive, with the file's name; a line that is not UTF-8 is ISO-8859-1."""
    reader = spark.readStream.option("pathGlobFilter", glob or f"{series}_*").option("maxFilesPerTrigger", files_per_batch)
    return reader.text(source).select(F.col("_metadata.file_name").alias("file"), strip_line_end(decode_line("value")).alias("text_content"))


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, series: str, fields: list[Field], record_type: str | None = None, delimiter: str | None = None, glob: str | None = None) -> None:
    """Parse what has arrived since the last run into target; the checkpoint knows which files are done."""
    lines = line_stream(spark, source, series, glob=glob)
    kw = {"record_type": record_type, "keep": ("file",)}
    parsed = delimited(lines, fields, delimiter=delimiter, **kw) if delimiter else fixed_width(lines, fields, **kw)
    query = parsed.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_versions(
    spark: SparkSession, source: str, clean: str, checkpoint: str, series: str, layout: DataFrame, date_format: str = "%Y%m", fmt: str | None = None, options: Options | None = None, files_per_batch: int = 1000,
    on_ledger: Callable[[DataFrame], None] | None = None,
) -> None:
    """Transform what has arrived since the last run, each file by the layout version of its period, each line exactly once.

    Files of a micro-batch meet the versions, then a batch is transformed as transform_versions does it, and committed
    with the stream's id and the micro-batch's: one that is there already is not written again, one that broke off
    before its commit leaves nothing that readers see. layout may grow between runs. on_ledger is given the ledger of each
    micro-batch, as transform_versions returns it.
    """
    options = options or Options()
    path = f"{clean}/{series}"
    name = lambda c: F.element_at(F.split(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "/"), -1)
    formats = {r["version"]: fmt or r["format"] for r in layout_profile(layout, "version").select("version", "format").collect()}
    versions = layout.select(F.lit(series).alias("series"), "version", "version_from", "version_to").distinct()

    def run(lines: DataFrame, batch_id: int) -> None:
        stream = (checkpoint, batch_id)
        if Commits(spark, path, "record_type").latest()["streams"].get(checkpoint, -1) >= batch_id:
            return
        arrived = lines.select("path", F.col("_time").alias("time")).distinct().withColumn("file", name(F.col("path")))
        stem = F.regexp_replace("file", r"\.[^.]*$", "")
        arrived = arrived.withColumn("period", F.substr(stem, F.lit(len(series) + 2))).withColumns({"day": period_date("period", date_format), "series": F.lit(series)})
        valid = sorted(version_for(arrived, versions).select("file", "period", "version", F.col("time").cast("string").alias("source")).collect())
        layouts = {v: layout_fields(layout.filter(F.col("version") == v)) for v in sorted({r["version"] for r in valid if r["version"] is not None})}
        ledger: list[tuple] = [(series, r["file"], None, "failed", 0, "no layout for the period" if r["version"] is None else "unknown format") for r in valid if formats.get(r["version"]) not in (DELIMITED, FIXED_WIDTH)]
        files = [File(r["file"], r["period"], r["version"], r["source"], tuple(c or ALL for c in layouts[r["version"]])) for r in valid if formats.get(r["version"]) in (DELIMITED, FIXED_WIDTH)]
        if files:
            rows = lines.select("text_content", name(F.col("path")).alias("file")).withColumn("period", F.substr(stem, F.lit(len(series) + 2)))
            n = transform_lines(rows, files, layouts, formats, path, options, stream=stream)
            ledger += [(series, f, None if c == ALL else c, "success", k, None) for (f, c), k in n.items()]
        if on_ledger:
            on_ledger(local_frame(spark, ledger, LEDGER))

    reader = spark.readStream.option("pathGlobFilter", f"{series}_*").option("maxFilesPerTrigger", files_per_batch)
    text = strip_line_end(decode_line("value")).alias("text_content")
    lines = reader.text(source).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("_time"), text)
    query = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
