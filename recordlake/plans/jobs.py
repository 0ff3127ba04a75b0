"""Jobs over series: stage their drops, transform them by the layout versions of their periods, keep a ledger."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import period_date
from ..functions.kinds import common_types
from ..operators.layout import layout_profile, version_for
from ..operators.ledger import LEDGER, to_do
from ..operators.parse import ALL, LINE, Field, Layout, by_type, placed_columns
from ..sources.commits import FEW_PARTS, Commits, counted, local_frame
from ..sources.lines import drops, emptied_files, encoded_lines, read_staged, read_zip, stage, staged_files

DELIMITED, FIXED_WIDTH, UNKNOWN = "DELIMITED", "FIXED_WIDTH", "UNKNOWN"


def layout_fields(layout: DataFrame) -> Layout:
    """Fields by record type of one layout version (record_type, ordinal, field_name, length, notation).

    This collects a layout, some hundred rows, which the plan of the transform is built from. A layout without record
    types is one for all lines, under None.
    """
    out: Layout = {}
    for r in layout.select("record_type", "ordinal", "field_name", "length", "notation").orderBy("record_type", "ordinal").collect():
        out.setdefault(r["record_type"], []).append(Field(r["field_name"], r["length"], r["notation"]))
    return out


def chosen(series: list[str], include: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """The series that a run is about: all, or those included, less those excluded, each once."""
    return [s for s in dict.fromkeys(series) if (include is None or s in include) and s not in (exclude or [])]


def stage_series(spark: SparkSession, source: str, staged: str, series: str, done: DataFrame | None = None, strict: bool = True, changed_only: bool = False) -> DataFrame:
    """Stage the drops of a series that the ledger does not say are done; the ledger of this run is returned, as it is.

    A drop is replaced as a whole by what it has now. A file without lines is a failure. strict: an archive that breaks
    off anywhere is a failure, and nothing of it is staged; else a broken member fails alone, and the error tells of it.
    changed_only: drops that are staged in the state in which they lie there are skipped. Texts and archives are read
    once, in one write; only files that turn out not to be UTF-8 are read again, as ISO-8859-1.
    """
    found = drops(spark, source, series)
    skipped: list[str] = []
    if done is not None:
        new = to_do(found, done.filter(F.col("series") == series), ["file"])
        skipped += [r["file"] for r in found.join(new.select("file"), "file", "left_anti").select("file").collect()]
        found = new
    every = found.collect()  # a row for each drop: paths, no lines
    if changed_only:
        have = {r["file"]: r["source"] for r in staged_files(spark, staged, series).collect()}
        skipped += [r["file"] for r in every if have.get(r["file"]) == r["source"]]
        every = [r for r in every if have.get(r["file"]) != r["source"]]
    texts = [r["path"] for r in every if r["file"].lower().endswith(".txt")]
    zips = [r["path"] for r in every if r["file"].lower().endswith(".zip")]
    parts = []
    if texts:
        parts.append(encoded_lines(spark, texts).withColumn("error", F.lit(None).cast("string")))
    if zips:
        parts.append(read_zip(spark, source, series, sure=not strict, only=zips).select("file", LINE, F.lit(False).alias("invalid"), "error"))
    out: dict[str, tuple[int, str | None]] = {}
    if parts:
        attempted = local_frame(spark, [(r["file"], r["source"]) for r in every], "file string, source string")
        out = stage(reduce(DataFrame.unionByName, parts), staged, series, attempted=attempted, strict=strict)
        bad = [r for r in every if out[r["file"]][1] == "not UTF-8"]
        if bad:
            again = local_frame(spark, [(r["file"], r["source"]) for r in bad], "file string, source string")
            out |= stage(encoded_lines(spark, [r["path"] for r in bad], other=True), staged, series, attempted=again)
    rows = [(series, f, None, "success" if n else "failed", n, error if error or n else "no lines") for f, (n, error) in out.items()]
    return local_frame(spark, [*rows, *((series, f, None, "skipped", 0, None) for f in skipped)], LEDGER)


def stage_all(spark: SparkSession, source: str, staged: str, series: list[str], include: list[str] | None = None, exclude: list[str] | None = None, done: DataFrame | None = None, **options) -> DataFrame:
    """stage_series for each series of the catalog that is chosen; one ledger of all."""
    ran = [stage_series(spark, source, staged, s, done, **options) for s in chosen(series, include, exclude)]
    return reduce(DataFrame.unionByName, ran, local_frame(spark, [], LEDGER))


@dataclass(frozen=True)
class Options:
    """How lines become values."""

    delimiter: str = "|"
    typed_values: bool = False
    exact: bool = False


@dataclass(frozen=True)
class File:
    """A staged file, the layout version of its period, the state that it is in, and the record types that are wanted of it."""

    name: str
    period: str
    version: str
    source: str | None
    wanted: tuple[str, ...]


def _fingerprint(file: File, code: str | None, fields: list[Field], fmt: str, options: Options) -> str:
    """What the rows of a record type of a file depend on: the file's state, the layout's fields and the options."""
    return sha256(json.dumps([file.source, code, [astuple(f) for f in fields], fmt, astuple(options)]).encode()).hexdigest()


def transform_lines(lines: DataFrame, files: list[File], layouts: dict[str, Layout], formats: dict[str, str], clean: str, options: Options, full: bool = True, stream: tuple[str, int] | None = None) -> dict[tuple[str, str], int]:
    """Parse lines (file, period, text_content) of files, each by its version, for all record types at once: {(file, record type): rows}.

    One write, by record type, batch, period and file, in which each file is scanned once, whatever the record types: a
    version has a select of its own, which reads the partitions of its periods. Rows are counted by the write itself.
    What a file had before is replaced, also by nothing; full: also of record types that its layout has no more.
    """
    spark = lines.sparkSession
    columns = placed_columns([layouts[v] for v in sorted({f.version for f in files})], options.typed_values, options.exact)
    codes = sorted({c for f in files for c in f.wanted})
    batch = uuid.uuid4().hex
    parts = []
    for v in sorted({f.version for f in files}):
        own = [(f.name, k * len(codes), list(f.wanted)) for k, f in enumerate(files) if f.version == v]
        table = local_frame(spark, own, "file string, _at int, _wanted array<string>")
        mine = lines.filter(F.col("period").isin(sorted({f.period for f in files if f.version == v}))).join(F.broadcast(table) if len(own) <= FEW_PARTS else table, "file")
        need = {c for f in files if f.version == v for c in f.wanted}
        layout = {c: fields for c, fields in layouts[v].items() if (c or ALL) in need}
        rows = by_type(mine, layout, columns, options.delimiter if formats[v] == DELIMITED else None, options.typed_values, options.exact, ("period", "file", "_at", "_wanted"))
        parts.append(rows.filter(F.array_contains("_wanted", F.col("record_type"))).drop("_wanted"))
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("record_type")).cast("int") - 1
    rows, counts = counted(reduce(DataFrame.unionByName, parts).withColumn("_at", F.col("_at") + place), "_at", len(files) * len(codes))
    rows.drop("_at").withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("record_type", "batch", "period", "file").parquet(clean)
    n = counts()
    out = {(f.name, c): n.get(k * len(codes) + codes.index(c), 0) for k, f in enumerate(files) for c in f.wanted}
    of = lambda f, c: _fingerprint(f, None if c == ALL else c, layouts[f.version][None if c == ALL else c], formats[f.version], options)
    entries = [(c, f.period, f.name, out[f.name, c], of(f, c)) for f in files for c in f.wanted]
    gone = [(f.name, list(f.wanted), [c or ALL for c in layouts[f.version]] if full else None) for f in files]
    said = {c: [[p.name, p.column, p.kind.simpleString()] for p in own] for c, own in columns.items()}
    Commits(spark, clean, "record_type").commit(batch, entries, gone, said, stream)
    return out


def read_clean(spark: SparkSession, clean: str, series: str, record_type: str | None = None, number: int | None = None) -> DataFrame:
    """The rows of a record type of a series: its own fields by name, period and file, of each file those of its newest commit.

    Where fields have other types in other batches, they have the least type that holds all. number: the commit that is
    read, by default the newest.
    """
    path, code = f"{clean}/{series}", record_type or ALL
    table = Commits(spark, path, "record_type")
    at = table.latest(number)
    if at["snapshot"] is None:
        raise FileNotFoundError(f"nothing is there at {path}")
    with_rows = table.entries(at).filter((F.col("record_type") == code) & (F.col("n") > 0))
    batches = sorted(r["batch"] for r in with_rows.select("batch").distinct().collect())  # at most as many as commits
    said = {b: table.columns(b) for b, _ in at["batches"]}
    kinds: dict[str, tuple[str, list[T.DataType]]] = {}
    for b in said:
        for name, _, kind in said[b].get(code, []):
            kinds.setdefault(name.lower(), (name, []))[1].append(T._parse_datatype_string(kind))
    if not kinds:
        raise ValueError(f"no layout of {series} has the record type {record_type}")
    target = {key: (name, common_types(each)) for key, (name, each) in kinds.items()}
    groups: dict[str, list[str]] = {}
    for b in batches:
        groups.setdefault(json.dumps(said[b][code]), []).append(b)
    parts = []
    for own, of in groups.items():
        have = {name.lower(): (column, kind) for name, column, kind in json.loads(own)}
        schema = ", ".join(f"`{c}` {k}" for c, k in have.values()) + ", batch string, period string, file string"
        rows = spark.read.schema(schema).option("basePath", f"{path}/record_type={code}").parquet(*[f"{path}/record_type={code}/batch={b}" for b in of])
        parts.append(table.alive(rows, at, ("file",), code).select(*[(F.col(f"`{have[k][0]}`").cast(kind) if k in have else F.lit(None).cast(kind)).alias(name) for k, (name, kind) in target.items()], "period", "file"))
    if not parts:
        return spark.createDataFrame([], T.StructType([*[T.StructField(n, k) for n, k in target.values()], T.StructField("period", T.StringType()), T.StructField("file", T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def drop_emptied(spark: SparkSession, staged: str, clean: str, series: str, record_types: list[str] | None = None) -> list[tuple[str, str]]:
    """Commit that files which have been staged again without lines have no rows: (file, record type) of what went.

    Files that were never staged here, such as those of a stream, stay. record_types: those that may go, by default all.
    """
    table = Commits(spark, f"{clean}/{series}", "record_type")
    had = table.entries().filter("n > 0").join(emptied_files(spark, staged, series), "file", "left_semi")
    if record_types is not None:
        had = had.filter(F.col("record_type").isin([c or ALL for c in record_types]))
    gone = sorted(had.select("file", "record_type", "period", "batch").collect())  # names of files
    if gone:
        said = {b: table.columns(b) for b in {r["batch"] for r in gone}}
        columns = {r["record_type"]: said[r["batch"]][r["record_type"]] for r in gone}  # a type that has no rows left is still known
        of: dict[str, list[str]] = {}
        for r in gone:
            of.setdefault(r["file"], []).append(r["record_type"])
        table.commit(uuid.uuid4().hex, [(r["record_type"], r["period"], r["file"], 0, None) for r in gone], [(f, codes, None) for f, codes in of.items()], columns)
    return [(r["file"], r["record_type"]) for r in gone]


def _past(done: DataFrame | None, series: str) -> set[tuple[str, str]]:
    if done is None:
        return set()
    return {(r["file"], r["record_type"] or ALL) for r in done.filter((F.col("series") == series) & (F.col("status") == "success")).select("file", "record_type").distinct().collect()}


def transform_series(spark: SparkSession, staged: str, clean: str, series: str, layouts: Layout, fmt: str, delimiter: str = "|", typed_values: bool = False, record_types: list[str] | None = None) -> DataFrame:
    """Parse the staged lines of a series by one layout, all record types in one pass; the ledger has a row for each record type.

    Requested record types that the layout does not have are left out.
    """
    wanted = [c for c in layouts if record_types is None or c in record_types]
    if fmt == UNKNOWN or not wanted:
        return local_frame(spark, [(series, None, c, "failed", 0, "unknown format") for c in wanted], LEDGER)
    files = [File(r["file"], r["period"], "", r["source"], tuple(c or ALL for c in wanted)) for r in staged_files(spark, staged, series).collect()]
    n: dict[tuple[str, str], int] = {}
    drop_emptied(spark, staged, clean, series, record_types)
    if files:
        lines = read_staged(spark, staged).filter(F.col("series") == series)
        n = transform_lines(lines, files, {"": layouts}, {"": fmt}, f"{clean}/{series}", Options(delimiter, typed_values), record_types is None)
    return local_frame(spark, [(series, None, c, "success", sum(k for (_, t), k in n.items() if t == (c or ALL)), None) for c in wanted], LEDGER)


def transform_versions(
    spark: SparkSession, staged: str, clean: str, series: str, layout: DataFrame, date_format: str = "%Y%m", fmt: str | None = None, delimiter: str = "|", typed_values: bool = False,
    record_types: list[str] | None = None, done: DataFrame | None = None, exact: bool = False, changed_only: bool = False,
) -> DataFrame:
    """Parse the staged lines of a series, each file by the layout version that is valid on its period's date.

    layout: the rows of all versions of the series (version, version_from, version_to, record_type, ordinal, field_name,
    length, notation, and the columns that tell its format). Files, periods and versions are metadata and are collected;
    lines are read once, by transform_lines. The ledger that is returned has a row for each file and record type: files of
    a period that no version holds for, or of a version in no known format, are failures; those that done says are done
    are skipped. Rows of files that were staged again without lines go, and count as no records. changed_only: so are those whose state, layout and options are those of the rows that are there.
    """
    files = staged_files(spark, staged, series).withColumn("day", period_date("period", date_format)).withColumn("series", F.lit(series))
    versions = layout.select(F.lit(series).alias("series"), "version", "version_from", "version_to").distinct()
    valid = sorted(version_for(files, versions).select("file", "period", "version", "source").collect())
    formats = {r["version"]: fmt or r["format"] for r in layout_profile(layout, "version").select("version", "format").collect()}
    layouts = {v: layout_fields(layout.filter(F.col("version") == v)) for v in sorted({r["version"] for r in valid if r["version"] is not None})}
    options, path = Options(delimiter, typed_values, exact), f"{clean}/{series}"
    past = _past(done, series)
    have = {(r["file"], r["record_type"]): r["source"] for r in Commits(spark, path, "record_type").entries().collect()} if changed_only else {}
    ledger: list[tuple] = [(series, r["file"], None, "failed", 0, "no layout for the period") for r in valid if r["version"] is None]
    ledger += [(series, f, None if c == ALL else c, "success", 0, None) for f, c in drop_emptied(spark, staged, clean, series, record_types)]
    todo: list[File] = []
    for r in valid:
        v = r["version"]
        codes = [c for c in layouts.get(v, {}) if record_types is None or c in record_types]
        file = File(r["file"], r["period"], v, r["source"], ())
        known = formats.get(v) in (DELIMITED, FIXED_WIDTH)
        skipped = [c for c in codes if (r["file"], c or ALL) in past or (known and changed_only and have.get((r["file"], c or ALL)) == _fingerprint(file, c, layouts[v][c], formats[v], options))]
        ledger += [(series, r["file"], c, "skipped", 0, None) for c in skipped]
        codes = [c for c in codes if c not in skipped]
        if not known:
            ledger += [(series, r["file"], c, "failed", 0, "unknown format") for c in codes]
        elif codes:
            todo.append(File(r["file"], r["period"], v, r["source"], tuple(c or ALL for c in codes)))
    if todo:
        lines = read_staged(spark, staged).filter(F.col("series") == series)
        n = transform_lines(lines, todo, layouts, formats, path, options, record_types is None)
        ledger += [(series, f, None if c == ALL else c, "success", k, None) for (f, c), k in n.items()]
    return local_frame(spark, ledger, LEDGER)


def transform_all(spark: SparkSession, staged: str, clean: str, layouts: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, done: DataFrame | None = None, **options) -> DataFrame:
    """transform_versions for each series of layouts (which has the column series) that is chosen; one ledger of all."""
    series = sorted(r[0] for r in layouts.select("series").filter(F.col("series").isNotNull()).distinct().collect())
    ran = [transform_versions(spark, staged, clean, s, layouts.filter(F.col("series") == s), done=done, **options) for s in chosen(series, include, exclude)]
    return reduce(DataFrame.unionByName, ran, local_frame(spark, [], LEDGER))


def run_series(spark: SparkSession, source: str, staged: str, clean: str, series: str, layout: DataFrame, staging: bool = True, done: DataFrame | None = None, **options) -> tuple[list[tuple[str, str]], dict[str, DataFrame]]:
    """Stage a series, then transform it: (status of each step, up to the first that fails; the ledger of each that ran)."""
    ledgers: dict[str, DataFrame] = {}
    steps = [("stage", lambda: ledgers.update(stage=stage_series(spark, source, staged, series, done)))] if staging else []
    steps.append(("transform", lambda: ledgers.update(transform=transform_versions(spark, staged, clean, series, layout, done=done, **options))))
    return run_steps(steps), ledgers


def run_steps(steps: Iterable[tuple[str, Callable[[], object]]]) -> list[tuple[str, str]]:
    """(step, success or the error) of each step, up to the first that fails."""
    out = []
    for name, step in steps:
        try:
            step()
        except Exception as e:  # noqa: BLE001  the status is the result
            out.append((name, f"failed: {type(e).__name__}: {e}".strip().removesuffix(":")))
            break
        out.append((name, "success"))
    return out
