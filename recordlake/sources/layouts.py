"""Layout tables and the catalog of series."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from typing import TextIO

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import known_date, validity_dates
from ..functions.names import distinct_names
from .archives import can_open, opened

#: Columns of the layout headers, by the column that they mean here; the first that has a value holds, row by row.
NAMES = {"field_name": ("Data Item", "Data Element"), "length": ("Length", "Max Length"), "notation": ("Remarks", "Format"), "definition": ("Definition", "Description")}
#: Rows, and cells, of a layout file that leave a reading task at a time.
BATCH_ROWS, BATCH_CELLS = 4096, 65_536
CATALOG = "series string, min_date date, max_date date, extension string, date_format string, frequency string, description string"


def read_layout_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of layout files as strings with the file's name and dates; cells may hold quoted newlines.

    Each file has a header of its own: its first row says what its columns are, however many; names that repeat, in
    whatever case, get numbers, and columns that a file lacks are null. Headers are metadata, and the different ones are
    collected. Files without rows bring nothing. A file is read as it is parsed, by ranges, some rows at a time, so that
    none is held as a whole, however long. A row with more cells than its header has names is an error.
    """

    found = spark.read.format("binaryFile").load(path).select("path", "_metadata.file_name")  # no contents
    first = found.select("path").first()
    ranges = first is not None and can_open(first["path"])
    if not ranges:  # where pyarrow cannot open the store, a layout is a cell
        found = spark.read.text(path, wholetext=True).select("value", "_metadata.file_name")
    name = F.url_decode(F.replace(F.col("file_name"), F.lit("+"), F.lit("%2B")))
    files = found.select(name.alias("layout_file"), F.col("path" if ranges else "value"))

    def lines(of: str):
        return io.TextIOWrapper(opened(of), encoding="utf-8", errors="replace", newline="") if ranges else io.StringIO(of, newline="")

    def headed(batches):
        for batch in batches:
            seen = []
            for of in batch.column(1).to_pylist():
                with lines(of) as text:
                    two = list(islice(records(text), 2))
                seen += [two[0]] if len(two) == 2 else []
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.list_(pa.string()))], ["_header"])

    headers = sorted((tuple(r["_header"]) for r in files.mapInArrow(headed, "_header array<string>").distinct().collect()), reverse=True)
    names = {h: distinct_names(list(h)) for h in headers}
    numbers = {h: k for k, h in enumerate(headers)}

    def parsed(batches):
        for batch in batches:
            for file, of in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                with lines(of) as text:
                    for header, rows in row_batches(file, text):
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([numbers[tuple(header)]] * n, pa.int32()), pa.array([[c or None for c in r] for r in rows], pa.list_(pa.string()))], ["layout_file", "_which", "_cells"])

    df = files.mapInArrow(parsed, "layout_file string, _which int, _cells array<string>").withColumn("pos", F.monotonically_increasing_id())
    spelled: dict[str, str] = {}
    for n in (n for ns in names.values() for n in ns):
        spelled.setdefault(n.lower(), n)
    out = []
    for key, n in spelled.items():
        at = [(k, [x.lower() for x in names[h]].index(key)) for k, h in enumerate(headers) if key in {x.lower() for x in names[h]}]
        out.append(F.coalesce(*[F.when(F.col("_which") == k, F.get("_cells", F.lit(i))) for k, i in at]).alias(n))
    a, b = validity_dates("layout_file")
    return df.select(*out, "layout_file", "pos").withColumns({"version_from": a, "version_to": b})


def records(text: TextIO) -> Iterator[list[str]]:
    """The records of a layout file that are not empty, without the empty cells at their ends."""
    return (_trimmed(r) for r in csv.reader(text) if any(r))


def row_batches(file: str, text: TextIO, rows: int = BATCH_ROWS, cells: int = BATCH_CELLS) -> Iterator[tuple[list[str], list[list[str]]]]:
    """(header, some rows) of a layout file as it is read, at most rows, or about cells, at a time."""
    every = records(text)
    header = next(every, [])
    most = max(1, min(rows, cells // max(len(header), 1)))
    k = 2
    while some := list(islice(every, most)):
        for i, r in enumerate(some):
            if len(r) > len(header):
                raise ValueError(f"{file}: record {k + i} has {len(r)} cells, its header {len(header)}")
        k += len(some)
        yield header, some


def _trimmed(cells: list[str]) -> list[str]:
    """Cells without the empty ones at the end."""
    n = len(cells)
    while n and not cells[n - 1]:
        n -= 1
    return cells[:n]


def canonical(layout: DataFrame) -> DataFrame:
    """layout with field_name, length, notation and definition coalesced from whichever headers it has."""
    have = {}
    for name, sources in NAMES.items():
        cols = [F.col(f"`{c}`") for c in sources if c in layout.columns]
        have[name] = F.coalesce(*cols) if cols else F.lit(None).cast("string")
    return layout.withColumns(have).withColumn("length", F.col("length").try_cast("int"))


def combine_layouts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """The layouts of several series, {series: folder}, canonical and with the series; folders that cannot be read or hold nothing are left out."""
    out = []
    for series, path in folders.items():
        try:
            out.append(canonical(read_layout_csv(spark, path)).withColumn("series", F.lit(series)))
        except AnalysisException:  # no such folder
            continue
    return union_layouts([t for t in out if not t.isEmpty()])


def union_layouts(tables: list[DataFrame]) -> DataFrame:
    """All rows of layouts with different columns; what a table lacks is null. No tables are an error."""
    if not tables:
        raise ValueError("no layout tables")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_catalog(spark: SparkSession, series: dict[str, dict]) -> DataFrame:
    """The series catalog from parsed entries {series: {min_date, ...}}; dates are text in any of the FORMATS.

    A date that is in none of them is an error when its series is read, not a series without files.
    """
    fields = ("min_date", "max_date", "extension", "date_format", "frequency", "description")
    rows = [(k, *(None if v.get(f) is None else str(v.get(f)) for f in fields)) for k, v in series.items()]
    df = spark.createDataFrame(rows, "series string, min_date string, max_date string, extension string, date_format string, frequency string, description string")
    return df.withColumns({"min_date": known_date("min_date"), "max_date": known_date("max_date"), "frequency": F.coalesce("frequency", F.lit("monthly"))})
