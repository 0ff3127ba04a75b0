"""Lines into fields: one select for a record type, whatever the width of its layout."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import common_types
from ..functions.names import unused
from ..functions.pic import spark_type, typed
from ..functions.text import strip

LINE = "text_content"


@dataclass(frozen=True)
class Field:
    name: str
    length: int | None = None
    notation: str | None = None


def disambiguated(fields: list[Field]) -> list[str]:
    """Names of the fields: a filler gets its place; names that repeat, whatever their case, get _1, _2 ..., and no name is there twice."""
    used: set[str] = set()
    return [unused(f"{f.name}_{i}" if "filler" in f.name.lower() else f.name, used) for i, f in enumerate(fields)]


def offsets(fields: list[Field]) -> list[int]:
    """Running sum of the widths before each field."""
    out, at = [], 0
    for f in fields:
        out.append(at)
        at += f.length or 0
    return out


def type_column(names: list[str]) -> int | None:
    """Place of the first field whose name holds Record Type."""
    return next((i for i, n in enumerate(names) if "record type" in n.lower().replace("_", " ")), None)


def fixed_width(lines: DataFrame, fields: list[Field], record_type: str | None = None, typed_values: bool = False, exact: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields sliced by characters and stripped; past the end of a line they are ''. Only lines of the record type stay.

    Where the type field is first and as wide as the code, the filter is a prefix test that reaches the Parquet scan.
    """
    names, at = disambiguated(fields), offsets(fields)
    cut = [strip(F.substring(LINE, o + 1, f.length or 0)) for o, f in zip(at, fields, strict=True)]
    out = lines
    k = type_column(names)
    if record_type is not None and k is not None:
        if at[k] == 0 and fields[k].length == len(record_type):
            out = out.filter(F.col(LINE).startswith(record_type))
        out = out.filter(cut[k] == record_type)
    return out.select(*keep, *_named(cut, names, fields, typed_values, exact))


def delimited(lines: DataFrame, fields: list[Field], record_type: str | None = None, delimiter: str = "|", typed_values: bool = False, exact: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields split at a delimiter, taken as they are; missing ones are null, extra ones go. No quoting."""
    names = disambiguated(fields)
    parts = F.split(LINE, r"\Q" + delimiter + r"\E", -1)
    cut = [F.get(parts, i) for i in range(len(fields))]
    out = lines
    k = type_column(names)
    if record_type is not None and k is not None:
        if k == 0:
            out = out.filter(F.col(LINE).startswith(record_type))
        out = out.filter(cut[k] == record_type)
    return out.select(*keep, *_named(cut, names, fields, typed_values, exact))


def _named(cut: list[Column], names: list[str], fields: list[Field], typed_values: bool, exact: bool) -> list[Column]:
    return [(typed(c, f.notation, exact) if typed_values else c).alias(n) for c, n, f in zip(cut, names, fields, strict=True)]


#: Record type of the lines of a layout that has none.
ALL = "ALL"
#: Fields by record type of a layout version.
Layout = dict[str | None, list[Field]]


@dataclass(frozen=True)
class Placed:
    """A field of a record type: its name, the column that holds it and the column's type."""

    name: str
    column: str
    kind: T.DataType


def placed_columns(layouts: list[Layout], typed_values: bool = False, exact: bool = False) -> dict[str, list[Placed]]:
    """By record type, the fields of all versions and the columns that they share in one table.

    A field whose type differs from version to version has the least type that holds all. Record types share a column
    where name and type agree; otherwise the later one's column has the record type in its name.
    """
    kinds: dict[str, dict[str, tuple[str, list[T.DataType]]]] = {}
    for by in layouts:
        for code, fields in by.items():
            own = kinds.setdefault(code or ALL, {})
            for name, f in zip(disambiguated(fields), fields, strict=True):
                own.setdefault(name.lower(), (name, []))[1].append(spark_type(f.notation, exact) if typed_values else T.StringType())
    used: dict[str, tuple[str, T.DataType]] = {}
    out: dict[str, list[Placed]] = {}
    for code, own in kinds.items():
        out[code] = []
        for key, (name, each) in own.items():
            kind = common_types(each)
            if used.get(key, (name, kind)) == (name, kind):
                column = name
            else:
                column = unused(f"{name} ({code})", set(used))
            used[column.lower()] = (name if column == name else column, kind)
            out[code].append(Placed(name, column, kind))
    return out


def by_type(lines: DataFrame, layout: Layout, columns: dict[str, list[Placed]], delimiter: str | None = None, typed_values: bool = False, exact: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, record_type and columns of the lines of all record types of a layout, in one select over one scan.

    A line is split once; it is a row for each record type that it is of, mostly one. A layout without record types, or
    without a field that says it, is one for all lines. Columns that are not a record type's own are null. delimiter:
    None for fixed widths. Where all types are said at the start of a line, lines of none are left out by the scan.
    """
    parts = F.split(LINE, r"\Q" + delimiter + r"\E", -1) if delimiter is not None else None
    place = lambda f, at, i: F.get("_parts", F.lit(i)) if parts is not None else strip(F.substring(LINE, at + 1, f.length or 0))
    tests, starts, values = [], [], {}
    for code, fields in layout.items():
        names, at = disambiguated(fields), offsets(fields)
        k = type_column(names)
        test = F.lit(True)
        if code is not None and k is not None:
            test = (F.get(parts, F.lit(k)) if parts is not None else place(fields[k], at[k], k)) == code
            first = k == 0 if parts is not None else at[k] == 0 and fields[k].length == len(code)
            starts.append(F.col(LINE).startswith(code) if first else F.lit(True))
        else:
            starts.append(F.lit(True))
        tests.append(F.when(test, F.lit(code or ALL)))
        columns_of = {p.name.lower(): p for p in columns[code or ALL]}
        for i, (name, f) in enumerate(zip(names, fields, strict=True)):
            p = columns_of[name.lower()]
            v = place(f, at[i], i)
            v, kind = (typed(v, f.notation, exact), spark_type(f.notation, exact)) if typed_values else (v, T.StringType())
            values.setdefault(p.column, []).append((code or ALL, v if kind == p.kind else v.cast(p.kind)))
    rows = lines.filter(reduce(lambda a, b: a | b, starts)) if starts else lines
    rows = rows.select(*keep, LINE, *([parts.alias("_parts")] if parts is not None else []), F.explode(F.array_compact(F.array(*tests))).alias("record_type"))
    out = []
    for p in {p.column: p for own in columns.values() for p in own}.values():
        have = values.get(p.column)
        value = reduce(lambda a, x: a.when(F.col("record_type") == x[0], x[1]), have[1:], F.when(F.col("record_type") == have[0][0], have[0][1])) if have else F.lit(None).cast(p.kind)
        out.append(value.alias(p.column))
    return rows.select(*keep, "record_type", *out)


def delimited_long(lines: DataFrame, layout: DataFrame, delimiter: str = "|", keep: tuple[str, ...] = (), names: list[str] | None = None) -> DataFrame:
    """A row for each field that a line has: record_type, pos, keep, value, field_name. The first part of a line is its record type.

    layout: record_type, pos (from 0), field_name; names: the fields that are wanted. The layout has as many rows as the
    layouts have fields; it is collected and becomes an array of places for each record type, so that only the fields
    that are wanted are taken out of a line, without a join.
    """
    if names is not None:
        layout = layout.filter(F.col("field_name").isin(names))
    places: dict[str, list[Column]] = {}
    for r in layout.select("record_type", "pos", "field_name").orderBy("record_type", "pos").collect():
        places.setdefault(r["record_type"], []).append(F.struct(F.lit(r["pos"]).alias("pos"), F.lit(r["field_name"]).alias("field_name")))
    parts = lines.select(*keep, F.split(LINE, r"\Q" + delimiter + r"\E", -1).alias("_p")).withColumn("record_type", F.get("_p", F.lit(0)))
    wanted = F.array().cast("array<struct<pos:int,field_name:string>>")
    for code, fields in places.items():
        wanted = F.when(F.col("record_type") == code, F.array(*fields)).otherwise(wanted)
    rows = parts.select("*", F.explode(wanted).alias("_f")).filter(F.col("_f.pos") < F.size("_p"))
    return rows.select("record_type", F.col("_f.pos").alias("pos"), *keep, F.get("_p", F.col("_f.pos")).alias("value"), F.col("_f.field_name").alias("field_name"))
